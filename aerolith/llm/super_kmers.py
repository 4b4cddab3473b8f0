"""Operator 13: removal of word windows that occur earlier, by super-k-mers.

The minimiser of a window of WINDOW words is the GRAM-word string in it with the least hash. Consecutive windows that share
it travel as one packed string (a super-k-mer) to the minimiser's bucket, so that neighbouring windows don't send their
common words again; equal windows have equal minimisers and meet there, where sorting finds each window's occurrences.

1. Each shard of documents asks about its distinct minimisers, with the number of distinct packed strings under each.
   A minimiser with a single string in the corpus can't hold a window twice, so nothing is sent for it.
2. Strings under shared minimisers travel, each distinct one once for each shard with its first place there. A minimiser
   with over CROWD strings would make a large bucket: its windows travel alone, by their own hash, so that what stands
   around a very common passage doesn't meet in one place.
3. A bucket gives its words numbers, names its windows by doubling (names of 2, 4, 8, 16 and WINDOW words, each by sorting pairs
   of names) and sorts the windows by name and place. Its answer has one bit for each window of each string: whether the
   window also starts before the string's first place.
4. The shard marks these windows, and all windows of a string's later places, and removes the words that they cover.

Words are compared themselves; hashes deal them out only. Places are ordered by id (null first), then by a hash of the text
where rows share an id, then by position; of rows alike in all one is the first. Windows never cross documents; null
texts have no words; texts under WINDOW words lose nothing. A long text's words are taken in steps of STEP words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import forget, ragged, utf8_data
from aerolith.llm.hashing import Ranges, word_spans
from aerolith.llm.repeats import LOW, sliding_min
from aerolith.llm.shards import SHARD_BYTES, answer, answered, ask, by_bucket, rows, sharded, text_bytes

WINDOW, GRAM, CROWD = 20, 6, 4096
#: Words taken at once.
STEP = 1 << 16
SINGLE, SHARED, CROWDED = 0, 1, 2
#: Keys and counts, or strings (with a line end each) and their first places.
QUESTION = "bucket int, shard int, kind int, keys binary, counts binary, docs binary, ties binary, starts binary"
ANSWER = "shard int, bucket int, kind int, codes binary"
MINIMISERS, STRINGS = 1, 2


class Words:
    """A shard's words in order of its places: row, number in the row, and the text with one blank between words."""

    def __init__(self, table: pa.Table, id_: str):
        texts = table["text"].combine_chunks()
        ids = table[id_].combine_chunks()
        known = np.asarray(ids.is_valid())
        numbers = np.where(known, np.asarray(ids.fill_null(0)).astype(np.int64), np.iinfo(np.int64).min)
        ties = np.array([xxhash.xxh64_intdigest(t.as_buffer() or b"") >> 1 for t in texts], np.uint64) | (known.astype(np.uint64) << np.uint64(63))
        self.order = np.lexsort((ties, numbers))
        self.ids, self.ties = numbers[self.order], ties[self.order]
        self.data, offsets = utf8_data(texts.take(pa.array(self.order)))
        self.starts, self.ends, self.rows = word_spans(self.data, offsets)
        self.counts = np.bincount(self.rows, minlength=len(texts)).astype(np.int64)
        firsts = np.cumsum(self.counts) - self.counts
        self.number = np.arange(len(self.rows)) - firsts[self.rows]
        # Rows alike in id and text are told apart by a count, the high part of a word's place.
        same = np.append(False, (self.ids[1:] == self.ids[:-1]) & (self.ties[1:] == self.ties[:-1])) if len(self.ids) else np.zeros(0, bool)
        run = np.arange(len(same))
        copies = run - np.maximum.accumulate(np.where(same, 0, run)) if len(same) else run
        self.place = (copies[self.rows] << 40) + self.number

    def joined(self, a: int, b: int) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Words a to b with one blank between, and their starts and ends there."""
        sizes = self.ends[a:b] - self.starts[a:b]
        at = np.cumsum(sizes + 1) - sizes - 1
        out = np.full(int(sizes.sum() + len(sizes)), 0x20, np.uint8)
        out[ragged(at, sizes)] = self.data[ragged(self.starts[a:b], sizes)]
        return out.tobytes(), at, at + sizes

    def super_kmers(self, window: int, gram: int) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By step: the number of its first word, its joined words with their starts and ends, and of each super-k-mer the
        minimiser's hash and the first words of its first and last window (in the step)."""
        for a in range(0, max(0, len(self.rows) - window + 1), STEP):
            b = min(len(self.rows), a + STEP + window - 1)
            text, ws, we = self.joined(a, b)
            strings = Ranges(np.frombuffer(text, np.uint8))(ws[: b - a - gram + 1], we[gram - 1 :])
            picks = (sliding_min((strings & ~LOW) | np.arange(len(strings), dtype=np.uint64), window - gram + 1) & LOW).astype(np.int64)
            own = self.rows[a:b]
            valid = np.flatnonzero(own[: b - a - window + 1] == own[window - 1 :])
            if not len(valid):
                continue
            picked = picks[valid]
            new = np.append(True, (picked[1:] != picked[:-1]) | (valid[1:] != valid[:-1] + 1))
            first = valid[new]
            last = valid[np.append(np.flatnonzero(new)[1:] - 1, len(valid) - 1)]
            yield a, text, ws, we, strings[picked[new]], first, last

    def strings(self, window: int, gram: int) -> dict[bytes, list]:
        """Every distinct packed string: its minimiser's hash, its first word, its windows, and the first words of its later places."""
        found: dict[bytes, list] = {}
        for a, text, ws, we, keys, first, last in self.super_kmers(window, gram):
            for key, f, n, s, e in zip(keys.tolist(), (first + a).tolist(), (last - first + 1).tolist(), ws[first].tolist(), we[last + window - 1].tolist()):
                known = found.setdefault(text[s:e], [key, f, n])
                if known[1] != f:
                    known.append(f)
        return found


def asked(strings: dict[bytes, list], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct minimisers by bucket, how many strings each has, and each string's place among them."""
    keys, back, counts = np.unique(np.array([f[0] for f in strings.values()], np.uint64), return_inverse=True, return_counts=True)
    order = np.argsort(keys % np.uint64(n), kind="stable")
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    return keys[order], counts[order], place[back]


def travelling(strings: dict[bytes, list], codes: np.ndarray, window: int) -> tuple[list[bytes], list[list]]:
    """Of strings with their codes: the shared ones, and the windows of crowded ones under hashes of their own."""
    alone: dict[bytes, list] = {}
    for own, fact in (x for x, c in zip(strings.items(), codes.tolist()) if c == CROWDED):
        words = own.split(b" ")
        for j in range(fact[2]):
            one = b" ".join(words[j : j + window])
            known = alone.setdefault(one, [xxhash.xxh64_intdigest(one, 5), fact[1] + j, 1])
            if known[1] != fact[1] + j:
                known.append(fact[1] + j)
    shared = [x for x, c in zip(strings.items(), codes.tolist()) if c == SHARED]
    return [*(s for s, _ in shared), *alone], [*(f for _, f in shared), *alone.values()]


def named_windows(numbers: np.ndarray, window: int) -> np.ndarray:
    """A name for the window that starts at each place: equal names, equal words. Names of a power of two are paired."""
    n = len(numbers)
    names, width = numbers.astype(np.int64), 1
    while width < window:
        step = min(width, window - width)
        pairs = names[: n - width - step + 1] * (int(names.max(initial=0)) + 1) + names[step : n - width + 1]
        names, width = np.unique(pairs, return_inverse=True)[1].astype(np.int64), width + step
    return names


def later_windows(blobs: list[bytes], docs: np.ndarray, ties: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the strings' windows, in order: whether each also starts elsewhere before its string's first place; and the number of
    windows of each string."""
    text = b"".join(blobs)
    dictionary: dict[bytes, int] = {}
    numbers = np.array([dictionary.setdefault(w, len(dictionary)) for w in text.split()], np.int64)
    sizes = np.array([s.count(b" ") + 1 for s in text.split(b"\n")[:-1]], np.int64) - window + 1
    firsts = np.cumsum(sizes + window - 1) - sizes - window + 1
    names = named_windows(numbers, window)[ragged(firsts, sizes)]
    string = np.repeat(np.arange(len(sizes)), sizes)
    place = starts[string] + ragged(np.zeros(len(sizes), np.int64), sizes)
    order = np.lexsort((place, ties[string], docs[string], names))
    later = np.zeros(len(names), bool)
    later[order[1:]] = names[order][1:] == names[order][:-1]
    return later, sizes


def removal(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, crowd: int = CROWD, id_: str = "doc_id") -> DataFrame:
    """docs' columns but text, and n_words, n_removed, kept: the remaining words with one blank between. Columns of docs that
    have one of these names give way; any other name may occur."""
    if not 0 < gram <= window:
        raise ValueError("a minimiser is part of its window")
    n = max(1, -(-text_bytes(docs) // shard_bytes))
    shown = [c for c in docs.columns if c not in ("text", "n_words", "n_removed", "kept")]
    docs = docs.select(*(F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(shown)), "text")
    others = docs.columns[:-1]
    key = others[shown.index(id_)]
    documents = sharded(docs, n, key)

    def ask_minimisers(table: pa.Table) -> pa.Table:
        forget()
        keys, counts, _ = asked(Words(table, key).strings(window, gram), n)
        shard, counts = table["shard"][0].as_py(), counts.astype(np.uint32)
        return rows(QUESTION, [(b, shard, MINIMISERS, keys[x].tobytes(), counts[x].tobytes(), b"", b"", b"") for b, x in by_bucket((keys % np.uint64(n)).astype(np.int64))])

    def parts(table: pa.Table, codes: np.ndarray, sizes: list[int], kind: int, packed: bool = False) -> pa.Table:
        """The codes dealt to the shards that asked, as many as each asked for."""
        ends, bucket = np.cumsum([0, *sizes]).tolist(), table["bucket"][0].as_py()
        own = [codes[a:b] for a, b in zip(ends[:-1], ends[1:])]
        return rows(ANSWER, [(s, bucket, kind, (np.packbits(c) if packed else c).tobytes()) for s, c in zip(table["shard"].to_pylist(), own)])

    def count_strings(table: pa.Table) -> pa.Table:
        blobs = table["keys"].to_pylist()
        keys, back = np.unique(np.frombuffer(b"".join(blobs), np.uint64), return_inverse=True)
        total = np.bincount(back, np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint32), len(keys))
        codes = np.where(total == 1, SINGLE, np.where(total <= crowd, SHARED, CROWDED)).astype(np.uint8)
        return parts(table, codes[back], [len(b) // 8 for b in blobs], MINIMISERS)

    def sent(strings: dict[bytes, list], answers: pa.Table) -> tuple[list[bytes], list[list], list[tuple[int, slice]]]:
        """The strings that travel, in the order of their buckets, and each bucket's part of them."""
        codes = answered(answers, MINIMISERS, "codes", np.uint8)[asked(strings, n)[2]]
        own, facts = travelling(strings, codes, window)
        bucket = (np.array([f[0] for f in facts], np.uint64) % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return [own[i] for i in order.tolist()], [facts[i] for i in order.tolist()], list(by_bucket(bucket[order]))

    def ask_strings(table: pa.Table, answers: pa.Table) -> pa.Table:
        forget()
        words = Words(table, key)
        strings, facts, buckets = sent(words.strings(window, gram), answers)
        first = np.array([f[1] for f in facts], np.int64)
        docs, ties, starts = words.ids[words.rows[first]], words.ties[words.rows[first]], words.place[first]
        shard = table["shard"][0].as_py() if table.num_rows else 0
        return rows(QUESTION, [(b, shard, STRINGS, b"\n".join(strings[x]) + b"\n", b"", docs[x].tobytes(), ties[x].tobytes(), starts[x].tobytes()) for b, x in buckets])

    def compare_strings(table: pa.Table) -> pa.Table:
        whole = lambda c, dtype: np.frombuffer(b"".join(table[c].to_pylist()), dtype)
        blobs = table["keys"].to_pylist()
        later, windows = later_windows(blobs, whole("docs", np.int64), whole("ties", np.uint64), whole("starts", np.int64), window)
        strings = np.cumsum([0, *(b.count(b"\n") for b in blobs)])
        ends = np.append(0, np.cumsum(windows))[strings]
        return parts(table, later, np.diff(ends).tolist(), STRINGS, packed=True)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        forget()
        words = Words(table, key)
        strings = words.strings(window, gram)
        _, facts, buckets = sent(strings, answers)
        told = answers.filter(pc.equal(answers["kind"], STRINGS))
        bits = dict(zip(told["bucket"].to_pylist(), told["codes"].to_pylist()))
        sizes, first = (np.array([f[i] for f in facts], np.int64) for i in (2, 1))
        later = [np.unpackbits(np.frombuffer(bits[b], np.uint8))[: sizes[x].sum()] for b, x in buckets]
        found = ragged(first, sizes)[np.concatenate(later).astype(bool)] if later else first
        # All windows of a string's later places go, whether or not other shards have them.
        both = [*strings.values(), *(f for f in facts if f[2] == 1)]
        again, wide = (np.array(x, np.int64) for x in ([p for f in both for p in f[3:]], [f[2] for f in both for _ in f[3:]]))
        change = np.zeros(len(words.rows) + 1, np.int32)
        for at, size in ((found, 1), (again, wide)):
            np.add.at(change, at, 1)
            np.add.at(change, at + size + window - 1, -1)
        gone = np.cumsum(change[:-1]) > 0
        removed = np.bincount(words.rows, gone, len(words.counts)).astype(np.int64)
        ends, kept = np.cumsum(words.counts).tolist(), []
        for a, b in zip([0, *ends[:-1]], ends):
            stay = np.flatnonzero(~gone[a:b]) + a
            sizes = words.ends[stay] - words.starts[stay]
            out = np.full(max(0, int(sizes.sum()) + len(stay) - 1), 0x20, np.uint8)
            out[ragged(np.cumsum(sizes + 1) - sizes - 1, sizes)] = words.data[ragged(words.starts[stay], sizes)]
            kept.append(out.tobytes().decode())
        own = table.take(pa.array(words.order))
        made = [*(own[c].combine_chunks() for c in others), pa.array(words.counts), pa.array(removed), pa.array(kept, pa.string())]
        return pa.table(made, names=[*others, "n_words", "n_removed", "kept"])

    about_minimisers = answer(ask(documents, ask_minimisers, QUESTION), count_strings, ANSWER)
    about_strings = answer(ask(documents, ask_strings, QUESTION, about_minimisers), compare_strings, ANSWER)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"), "n_words long, n_removed long, kept string"])
    found = ask(documents, remove, schema, about_minimisers.union(about_strings))
    return found.select(*(F.col(o).alias(c) for o, c in zip(others, shown)), "n_words", "n_removed", "kept")
