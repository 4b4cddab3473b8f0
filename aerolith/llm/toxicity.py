"""Operator 7: toxicity of texts restored by a noisy-channel decoder.

Words that may be disguised (digits or signs among letters, letters repeated, letters spaced out)
are decoded: each is a lattice whose arcs read a sign as itself or as the letters it may stand for,
a run of a letter as the run, two or one of it, and separators as nothing; letters with accents and
look-alikes of other scripts are read as plain ones beside themselves; the Viterbi path is the
most likely under a character n-gram model of the training texts' words, less a cost for each
change. What is restored is scored; words beyond doubt have one path, themselves. Words that are long
or have many separators, and runs of spaced letters, may hold several words: there the lattice also
has word ends, and every restored word is scored. It is read in overlapping windows of WINDOW signs.

Marks of toxicity are whole words and word beginnings and endings that stand in toxic training
documents far more often than in others (of copies, one document counts). A text's score is the share of toxic documents among the
training documents with as many marked words, smoothed and never falling with more of them; among texts with as many
it rises, towards the next share, with the sum of the marks' log odds.

Learning takes every labelled training row; counts come from Spark aggregations, and marks
and character n-grams are limited to the MARKS and GRAMS strongest. A mark stands in a hundredth of the toxic texts at least,
so features are first counted in these, and in the others only those that pass.

Most words can't be read as a mark in any way. A key that all readings of a word share (look-alikes as one letter, runs
as one, other signs left out) tells so; its first and last signs tell most of them so for many texts at once, in arrays
(Screen). The lattice is for the rest. Null and empty texts hold no
marks. Documents with several labels count once for each; null labels count not at all. Without
labels every score is the prior of 0.5. Repeated rows each give a row. Columns of docs named marks, odds or score give
way to the operator's.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
import uuid
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import column, materialise, per_chunk, remembered, ship_package, text_chunks, whole_text
from aerolith.llm.hashing import mix

MARKS, GRAMS, REMEMBERED, MOST = 20_000, 60_000, 150_000, 6
ORDER, CHANGE = 3, 1.0
#: Longer words are read as several; signs of a window, and those of its end that the next one reads again.
LONG, WINDOW, OVERLAP = 40, 256, 64
#: What signs may stand for (fixed values).
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}
#: Letters of other scripts that look like plain ones (fixed values).
LOOKS_LIKE = str.maketrans({
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i",
})
EDGES = " \t\r\n.,;:?!\"'()[]{}<>#$%&*-_=+|/\\~`^"
SPACED = re.compile(r"(?<!\S)(?:[^\W_][.\-_*]?\s{1,3}){2,}[^\W_](?![^\W_])")
DISGUISED = re.compile(r"(.)\1|[^\W\d_](?:[^\w\s]|_)+[^\W\d_]|[^\W_]*[\d@$!|+(€£*][^\W_]*", re.S)
JOINED = re.compile(r"(?:[^\W_](?:[^\w\s]|_)+){3}[^\W_]")
REPEATED = re.compile(r"(.)\1{3,}", re.S)
JUNK = re.compile(r"^[^\w\s]{2}|[^\w\s]{2}$")

#: Signs that are no letters or digits and yet may stand for letters: a word's key has them as letters or leaves them out.
UNSURE = re.compile("[" + re.escape("".join(c for c in STANDS_FOR if not c.isalnum())) + "]")
RUN = re.compile(r"(.)\1+", re.S)


class _Keys(dict):
    """For str.translate: each letter's or digit's representative among those that may be read as one another; other signs go."""

    def __init__(self, unsure: bool):
        kept = {c: x for c, x in STANDS_FOR.items() if unsure or c.isalnum()}
        super().__init__({ord(c): "i" if x[0] in "il" else x[0] for c, x in kept.items()} | {ord("l"): "i"})

    def __missing__(self, code: int) -> str:
        self[code] = chr(code) if chr(code).isalnum() else ""
        return self[code]


WITHOUT, WITH = _Keys(False), _Keys(True)


def key(word: str, signs: _Keys = WITHOUT) -> str:
    """What all readings of a word have in common, if its unsure signs are left out (or all read as letters)."""
    out = word.translate(signs)
    return RUN.sub(r"\1", out) if RUN.search(out) else out


def features(word: str) -> list[str]:
    """The word, its beginnings and its endings."""
    out = [f"={word}"]
    for n in (4, 5, 6):
        if len(word) > n:
            out += [f"<{word[:n]}", f">{word[-n:]}"]
    return out


def signature(text: str) -> int:
    """One number of five independent minimum hashes of two words in a row. Copies with a few changes mostly agree in all of
    them; texts that share a passage hardly ever."""
    words = text.lower().encode().split()
    pairs = np.fromiter((zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:])), np.uint64) if len(words) > 1 else np.array([zlib.crc32(b" ".join(words))], np.uint64)
    least = [int(mix(pairs + np.uint64(k << 32)).min()) for k in range(1, 6)]
    return zlib.crc32(repr(least).encode()) << 20 ^ least[0] >> 32


def plain(word: str) -> str:
    """The word with accents and look-alikes of other scripts as plain letters."""
    if word.isascii():
        return word
    return "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c)).translate(LOOKS_LIKE)


class CharacterModel:
    """Log probabilities of letters after ORDER - 1 others, backing off to shorter contexts."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        self.totals: dict[str, int] = defaultdict(int)
        for g, n in counts.items():
            self.totals[g[:-1]] += n
        self.memo: dict[tuple[str, str], float] = {}

    def log_probability(self, context: str, letter: str) -> float:
        key = (context, letter)
        out = self.memo.get(key)
        if out is None:
            p = 1 / 100
            for k in range(len(context), -1, -1):
                own = context[k:]
                total = self.totals.get(own, 0)
                p = (self.counts.get(own + letter, 0) + 5 * p) / (total + 5)
            if len(self.memo) > REMEMBERED:
                self.memo.clear()
            out = self.memo[key] = math.log(p)
        return out


def arcs(word: str) -> list[list[tuple[int, str, float]]]:
    """From each place of a word: (next place, letters, cost) of every reading."""
    out: list[list[tuple[int, str, float]]] = [[] for _ in word]
    for i, c in enumerate(word):
        out[i].append((i + 1, c, 0.0))
        out[i] += [(i + 1, x, CHANGE) for x in STANDS_FOR.get(c, "")]
        if not c.isalnum() and 0 < i < len(word) - 1:
            out[i].append((i + 1, "", CHANGE))
        run = i
        while run < len(word) and word[run] == c:
            run += 1
        if c.isalpha() and run - i > 1:
            out[i].append((run, c, CHANGE))
            if run - i > 2:
                out[i].append((run, c + c, CHANGE))
    return out


def viterbi(word: str, model: CharacterModel) -> str:
    """The most likely reading of a word; ties go to the first in order."""
    states: list[dict[str, tuple[float, str]]] = [{} for _ in range(len(word) + 1)]
    states[0][" " * (ORDER - 1)] = (0.0, "")
    for i, leaving in enumerate(arcs(word)):
        for context, (cost, text) in states[i].items():
            for to, letters, extra in leaving:
                own, now = cost + extra, context
                for x in letters:
                    own -= model.log_probability(now, x)
                    now = (now + x)[-(ORDER - 1) :]
                if now not in states[to] or (own, text + letters) < states[to][now]:
                    states[to][now] = (own, text + letters)
    closed = [(cost - model.log_probability(context, " "), text) for context, (cost, text) in states[-1].items()]
    return min(closed)[1]


def window_words(window: str, model: CharacterModel) -> list[tuple[str, int]]:
    """The words of the most likely reading of a window as several words, each with the place where it ends."""
    start = " " * (ORDER - 1)
    # A state is (cost, letters since the last place, word ended here, state before, place).
    states: list[dict[str, tuple]] = [{} for _ in range(len(window) + 1)]
    states[0][start] = (0.0, "", False, None, 0)
    for i, leaving in enumerate(arcs(window)):
        for context, state in [*states[i].items()]:
            if i and context != start:
                cost = state[0] - model.log_probability(context, " ")
                if start not in states[i] or cost < states[i][start][0]:
                    states[i][start] = (cost, "", True, state, i)
        for context, state in states[i].items():
            for to, letters, extra in leaving:
                own, now = state[0] + extra, context
                for x in letters:
                    own -= model.log_probability(now, x)
                    now = (now + x)[-(ORDER - 1) :]
                if now not in states[to] or own < states[to][now][0]:
                    states[to][now] = (own, letters, False, state, to)
    state = min(((s[0] - model.log_probability(c, " "), k) for k, (c, s) in enumerate(states[-1].items())))[1]
    state = list(states[-1].values())[state]
    out, letters, end = [], [], len(window)
    while state is not None:
        if state[2]:
            out.append(("".join(reversed(letters)), end))
            letters, end = [], state[4]
        letters.append(state[1])
        state = state[3]
    out.append(("".join(reversed(letters)), end))
    return out[::-1]


def segmented(word: str, model: CharacterModel) -> list[str]:
    """The words that a run of signs is most likely to hold, in time linear in its length."""
    word = REPEATED.sub(r"\1\1\1", word)
    out, at = [], 0
    while len(word) - at > WINDOW:
        found = window_words(word[at : at + WINDOW], model)
        # What ends in the overlap is read again by the next window; a word as long as that is cut.
        kept = [x for x in found if x[1] <= WINDOW - OVERLAP] or [found[0]]
        out += [x for x, _ in kept]
        at += kept[-1][1] if kept[-1][1] < WINDOW else WINDOW - OVERLAP
    return out + [x for x, _ in window_words(word[at:], model)]


#: Signs as five bits: letters that any reading or key may take for one another are one; IGNORED has no part in keys, ODD
#: asks for a closer look at its word.
IGNORED, ODD, SPACE, BITS, KNOWN = 0, 30, 31, 5, 4


def _sign(char: str) -> int:
    if char.isspace():
        return SPACE
    simple = plain(char)
    if len(simple) > 1 or UNSURE.match(char) or UNSURE.match(simple) or simple > "\uffff":
        return ODD
    # As WITHOUT has them, without filling it.
    own, other = (WITHOUT.get(ord(c)) or (c if c.isalnum() else "") for c in (char, simple or " "))
    if bool(own) != bool(other):
        return ODD
    if not other:
        return IGNORED
    return ord(other) - ord("a") + 1 if "a" <= other <= "z" else 27 + ord(other) % 3


@functools.cache
def _signs() -> np.ndarray:
    """Each code point's sign; those beyond the first plane share the last place."""
    return np.array([*(_sign(chr(c)) for c in range(1 << 16)), ODD], np.uint8)


class Screen:
    """Tells most words of many texts at once from those that may be marked: by the first and the last KNOWN signs of their
    keys. It has no say where Model.may_be_marked() would look at more than a key's beginning and end (unsure signs, long
    words, several separators): those words stay."""

    def __init__(self, keys: dict[str, frozenset[str]]):
        self.all = any("" in own for own in keys.values())
        self.heads, self.tails = (np.zeros((1 << BITS,) * KNOWN, bool) for _ in range(2))
        for kind, own in keys.items():
            for word in own:
                signs = [_signs()[min(ord(c), 1 << 16)] for c in word]
                if ODD in signs:
                    continue  # only words with that sign have this key, and they stay
                signs = [x for i, x in enumerate(signs) if not i or x != signs[i - 1]]
                if kind == ">":
                    self.tails[tuple(signs[: -KNOWN - 1 : -1])] = True
                else:
                    self.heads[tuple([*signs, *([SPACE] if kind == "=" else [])][:KNOWN])] = True
        self.heads, self.tails = self.heads.ravel(), self.tails.ravel()

    def left(self, texts: list[str]) -> tuple[list[list[str]], list[bool]]:
        """Of lower-case texts: the words that may be marked, in order, and whether two words of one letter follow one another."""
        joined = "\n".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        signs = _signs()[np.minimum(codes, 1 << 16)]
        spaces = np.flatnonzero(signs == SPACE)
        starts, ends = np.concatenate(([0], spaces + 1)), np.concatenate((spaces, [len(signs)]))
        lengths = ends - starts
        ignored = np.bincount(np.searchsorted(spaces, np.flatnonzero(signs == IGNORED)), minlength=len(starts))
        stays = (lengths > LONG) | (ignored > 2) | self.all
        stays[np.searchsorted(spaces, np.flatnonzero(signs == ODD))] = True
        # Keys on end: runs are one sign, and words without a key are gone with their spaces.
        kept = signs[signs != IGNORED]
        around = np.full(KNOWN, SPACE, np.uint8)
        kept = np.concatenate((around, kept[:1], kept[1:][kept[1:] != kept[:-1]], around)).astype(np.int32)
        edges = np.flatnonzero(kept == SPACE)
        filled = np.diff(edges) > 1
        first, last = edges[:-1][filled] + 1, edges[1:][filled] - 1
        head, tail = np.zeros(len(first), np.int32), np.zeros(len(first), np.int32)
        for k in range(KNOWN):
            head, tail = head << BITS | kept[first + k], tail << BITS | kept[last - k]
        stays[np.flatnonzero(lengths > ignored)[self.heads[head] | self.tails[tail]]] = True

        firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])  # where each text begins
        words: list[list[str]] = [[] for _ in texts]
        chosen = np.flatnonzero(stays & (lengths > 0))
        for text, a, b in zip((np.searchsorted(firsts, starts[chosen], "right") - 1).tolist(), starts[chosen].tolist(), ends[chosen].tolist()):
            words[text].append(joined[a:b])
        # One letter, with a separator at most.
        real = np.flatnonzero(lengths > 0)
        single = lengths[real] == 1
        two = np.flatnonzero(lengths[real] == 2)
        single[two] = np.isin(codes[starts[real[two]] + 1], [ord(c) for c in ".-_*"])
        both = np.flatnonzero(single[1:] & single[:-1])
        one, next_one = (np.searchsorted(firsts, starts[real[both + k]], "right") - 1 for k in (0, 1))
        spaced = np.zeros(len(texts), bool)
        spaced[one[one == next_one]] = True
        return words, spaced.tolist()


class Model:
    def __init__(self, marks: dict[str, float], characters: CharacterModel, shares: list[float]):
        self.marks, self.characters, self.shares, self.name = marks, characters, shares, uuid.uuid4().hex
        # A mark's own unsure signs were read as themselves, so its key leaves them out; as letters they would be another mark's.
        self.keys = {kind: frozenset(key(f[1:]) for f in marks if f[0] == kind) for kind in "=<>"}
        self.every = frozenset().union(*self.keys.values())
        self.lengths = {kind: sorted({len(k) for k in own}) for kind, own in (*self.keys.items(), ("", self.every))}

    def fits(self, own: str, inside: bool) -> bool:
        """Whether a word with this key may be read as a marked one, or hold one inside."""
        if inside:
            return any(own[i : i + n] in self.every for n in self.lengths[""] for i in range(len(own) - n + 1))
        if own in self.keys["="]:
            return True
        for n in self.lengths["<"]:
            if own[:n] in self.keys["<"]:
                return True
        for n in self.lengths[">"]:
            if own[-n:] in self.keys[">"]:
                return True
        return "" in self.every

    def may_be_marked(self, word: str) -> bool:
        """False only if no reading of the word, or of a part of it where it may hold several, has a mark."""
        if len(word) <= LONG and JUNK.search(word):
            word = word.strip(EDGES)  # as toxic_word() reads it then
        unsure = UNSURE.findall(word)
        if len(unsure) > 1 or "*" in unsure:
            return True
        bare = word.translate(WITHOUT)
        inside = len(word) > LONG or len(word) - len(bare) > 2  # as JOINED asks for at least
        if self.fits(RUN.sub(r"\1", bare) if RUN.search(bare) else bare, inside):
            return True
        return bool(unsure) and self.fits(key(word, WITH), inside)

    def marked(self, word: str) -> float:
        """The log odds of the word's strongest mark (0: none)."""
        get, n = self.marks.get, len(word)
        best = get("=" + word, 0.0)
        for k in (4, 5, 6):  # as features() has them
            if n > k:
                for f in ("<" + word[:k], ">" + word[-k:]):
                    if (odds := get(f)) and odds > best:
                        best = odds
        return best

    def toxic_word(self, raw: str) -> float:
        """The log odds of a lower-case word's mark, as it stands, with plain letters or as restored (0: none)."""
        simple = plain(raw)
        if not self.may_be_marked(raw) and (simple is raw or not self.may_be_marked(simple)):
            return 0.0
        for form in (raw, simple) if simple is not raw else (raw,):
            word = form.strip(EDGES)
            if word and (odds := self.marked(word)):
                return odds
        raw, word = simple, simple.strip(EDGES)
        if not DISGUISED.search(raw):
            return 0.0
        if len(raw) > LONG:
            return max(self.marked_words(raw), default=0.0)
        # A single sign at an end may stand for a letter; more are punctuation.
        forms = (word, raw.rstrip(".,;:?\"'")) if not JUNK.search(raw) else (word,)
        for form in dict.fromkeys(forms):
            if form and (odds := self.marked(viterbi(form, self.characters).strip(EDGES))):
                return odds
        return max(self.marked_words(word), default=0.0) if JOINED.search(word) else 0.0

    def marked_words(self, run: str) -> list[float]:
        """The log odds of the marked ones of the words that a run of signs holds."""
        return [odds for w in (x.strip(EDGES) for x in segmented(run, self.characters)) if w and (odds := self.marked(w))]

    @functools.cached_property
    def screen(self) -> Screen:
        return Screen(self.keys)

    def found(self, texts: list[str], memo: dict[str, float]) -> list[tuple[int, float]]:
        """Marked words of each whole text, and the sum of their log odds."""
        texts = [t.lower() for t in texts]
        out = []
        for text, words, spaced in zip(texts, *self.screen.left(texts)):
            total, strength = 0, 0.0
            for word, n in Counter(words).items():
                odds = memo.get(word)
                if odds is None:
                    odds = memo[word] = self.toxic_word(word)
                if odds:
                    total, strength = total + n, strength + odds * n
            # Spaced letters begin with two words of one letter in a row, each with a separator at most.
            for m in SPACED.finditer(text) if spaced else ():
                letters = plain(re.sub(r"[\s.\-_*]", "", m[0]))
                own = self.marked_words(letters)
                if not own and len(letters) <= LONG:
                    own = [odds for odds in (self.marked(letters) or self.marked(viterbi(letters, self.characters)),) if odds]
                total, strength = total + len(own), strength + sum(own)
            out.append((total, strength))
        return out

    def count(self, text: str, memo: dict[str, float]) -> int:
        return self.found([text], memo)[0][0]


def _restored(model: Model) -> dict[str, float]:
    """What the worker knows of words: the log odds of each one's mark."""
    return remembered("toxicity", model.name, dict, lambda held: len(held) > REMEMBERED)


def learn(docs: DataFrame, labels: DataFrame, trains) -> Model:
    """From all labelled training documents."""
    spark = docs.sparkSession
    ship_package(spark)
    marks = labels.where("toxic is not null").select("doc_id", (F.col("toxic") != 0).cast("int").alias("label")).where(trains)
    # Labels may be as many as documents, so they aren't broadcast; the training texts are shuffled once to meet them.
    chosen = materialise(marks.distinct())
    found = docs.where(trains).select("doc_id", whole_text().alias("text")).join(chosen.hint("shuffle_hash"), "doc_id")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signatures = [signature(t) for t in column(batch, "text").to_pylist()]
            yield pa.record_batch([column(batch, "text"), column(batch, "label"), pa.array(signatures, pa.int64())], names=["text", "label", "signature"])

    # Copies of a document, near or exact, would make its every word a mark; one of them stays.
    rows = materialise(found.select("text", "label").mapInArrow(sign, "text string, label int, signature long").dropDuplicates(["label", "signature"]))

    def document_features(texts: list[str]) -> Iterator[set[str]]:
        memo: dict[str, list[str]] = {}
        for text in texts:
            words = {w for w in (x.strip(EDGES) for x in {*text.lower().split()}) if w}
            memo.update((w, features(w)) for w in words if w not in memo)
            yield {f for w in words for f in memo[w]}

    def counted_batch(counts: Counter, name: str) -> pa.RecordBatch:
        return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=[name, "n"])

    def count_toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A few documents at a time: their features are many, and Spark adds the counts up.
        for batch in (b.slice(i, 64) for b in batches for i in range(0, b.num_rows, 64)):
            counts = Counter()
            for own in document_features(column(batch, "text").to_pylist()):
                counts.update(own)
            yield counted_batch(counts, "feature")

    def count_clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, memo = shared.value, {}
        for batch in batches:
            counts = Counter()
            for text in column(batch, "text").to_pylist():
                own: set[str] = set()
                for word in {*text.lower().split()}:
                    if (known := memo.get(word)) is None:
                        bare = word.strip(EDGES)
                        # What stands in too few texts as four signs does so as five: most words end here.
                        likely = len(bare) < 5 or "<" + bare[:4] in asked or ">" + bare[-4:] in asked
                        known = memo[word] = tuple(f for f in features(bare) if f in asked) if bare and likely else ()
                    if known:
                        own.update(known)
                counts.update(own)
                if len(memo) > REMEMBERED:
                    memo.clear()
            yield counted_batch(counts, "feature")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            raw, words = Counter(), Counter()
            for text in column(batch, "text").to_pylist():
                raw.update(text.lower().split())
            for x, n in raw.items():
                if (w := x.strip(EDGES)).isalpha():
                    words[w] += n
            yield counted_batch(words, "word")

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = Counter()
            for w, n in zip(column(batch, "word").to_pylist(), column(batch, "n").to_pylist()):
                padded = " " * (ORDER - 1) + w + " "
                for i in range(ORDER - 1, len(padded)):
                    for k in range(ORDER):
                        grams[padded[i - k : i + 1]] += n
            yield counted_batch(grams, "gram")

    def summed(df: DataFrame, count, name: str) -> DataFrame:
        return df.mapInArrow(count, f"{name} string, n long").groupBy(name).agg(F.sum("n").alias("n"))

    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    support = max(3, math.ceil(0.01 * n_toxic))
    toxic = summed(rows.where("label = 1").select("text"), count_toxic, "feature").where(F.col("n") >= support)
    # Each stands in so many toxic texts, so there are at most a hundred times as many as one text has features.
    often = {r["feature"]: r["n"] for r in toxic.collect()}
    shared = spark.sparkContext.broadcast(frozenset(often))
    others = {r["feature"]: r["n"] for r in summed(rows.where("label = 0").select("text"), count_clean, "feature").collect()}
    odds = {f: math.log(((a + 0.5) / (n_toxic + 1.0)) / ((others.get(f, 0) + 0.5) / (n_clean + 1.0))) for f, a in often.items()}
    strongest = sorted((f for f, x in odds.items() if x > math.log(50)), key=lambda f: (-odds[f], -often[f], f))[:MARKS]
    marks_found = {f: odds[f] for f in strongest}
    words = summed(rows.select("text"), count_words, "word")
    grams = {r["gram"]: r["n"] for r in summed(words, count_grams, "gram").orderBy(F.desc("n"), "gram").limit(GRAMS).collect()}
    model = Model(marks_found, CharacterModel(grams), [])
    table = {(r["label"], r["marks"]): r["n"] for r in counts(rows, model).groupBy("label", F.least("marks", F.lit(MOST)).alias("marks")).agg(F.count("*").alias("n")).collect()}
    best = 0.0
    for k in range(MOST + 1):
        # A bin without rows takes after the one before.
        toxic, clean = table.get((1, k), 0), table.get((0, k), 0)
        seen = toxic + clean
        share = (toxic + 0.5) / (seen + 1) if seen else (0.9 if k else 0.5)
        best = max(best, share)
        model.shares.append(best)
    if not n_toxic or not n_clean:
        model.shares = [0.5] * (MOST + 1)
    return model


def counts(docs: DataFrame, model: Model, keep_text: bool = False) -> DataFrame:
    """docs' columns (text only if it is to be kept), marks and odds: the number of marked words of every whole text and the
    sum of their log odds."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MARKS marks and GRAMS n-grams
    others = [c for c in docs.columns if c not in ("marks", "odds", "score") and (keep_text or c != "text")]

    def work(texts: pa.Array, *fixed: pa.Array) -> pa.RecordBatch:
        model = shared.value
        memo = _restored(model)
        found = []
        for a, b in text_chunks(texts, 1 << 20):
            found += model.found([t or "" for t in texts.slice(a, b - a).to_pylist()], memo)
        return pa.record_batch([*fixed, pa.array([n for n, _ in found], pa.int32()), pa.array([x for _, x in found], pa.float64())], names=[*others, "marks", "odds"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in others), "marks int, odds double"])
    return docs.select(*others, *([] if keep_text else ["text"])).mapInArrow(per_chunk(work, *others), schema)


def score(docs: DataFrame, model: Model, keep_text: bool = False) -> DataFrame:
    """docs' columns (text only if it is to be kept), marks, odds and score (0 to 1)."""
    shares = F.array(*[F.lit(s) for s in [*model.shares, 1.0]])
    place = F.least("marks", F.lit(MOST))
    own, following = F.element_at(shares, place + 1), F.element_at(shares, place + 2)
    within = F.when(F.lit(bool(model.marks)), F.col("odds") / (F.col("odds") + 100.0)).otherwise(0.0)
    return counts(docs, model, keep_text).withColumn("score", own + (following - own) * within)
