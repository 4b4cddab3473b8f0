"""Operator 2: language identification by words first, then shorter character n-grams.

Learning counts the words of a bounded sample of labelled documents, and the n-grams inside them
(those of a word once, times the word's count). A known word scores its smoothed log frequency in each language. A word
that isn't known is read n-gram by n-gram: at each position the longest known n-gram counts, from
LONGEST characters down to one. The scores of a text's words add up; the softmax of the sums is the
score. Every word and n-gram of the sample counts, and the sample's documents are the model's bound.

Null texts and texts without a letter are `und` with score 0, and so is everything if nothing could
be learnt. Ties go to the language that comes first by name. Repeated rows each give a row.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import column, materialise, per_chunk, remembered, ship_package, whole_text
from aerolith.llm.samples import labelled_sample

LONGEST, SAMPLE, REMEMBERED = 4, 3_000, 250_000
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def ngrams(word: str) -> list[str]:
    marked = f" {word} "
    return [marked[i : i + n] for n in range(1, LONGEST + 1) for i in range(len(marked) - n + 1)]


class Scores:
    """Per-language smoothed log frequencies of features."""

    def __init__(self, features: list[str], counts: np.ndarray):
        self.number = {f: i for i, f in enumerate(features)}
        self.table = np.log((counts + 0.1) / (counts.sum(axis=0) + 0.1 * (len(features) + 1)))

    def get(self, feature: str) -> np.ndarray | None:
        i = self.number.get(feature)
        return None if i is None else self.table[i]

    def __getitem__(self, feature: str) -> np.ndarray:
        return self.table[self.number[feature]]


class Model:
    """Scores of words and n-grams in each language."""

    def __init__(self, languages: list[str], words: Scores, grams: Scores, name: str):
        self.languages, self.words, self.grams, self.name = languages, words, grams, name
        self.longest = max(map(len, grams.number), default=0)

    def word_scores(self, word: str) -> np.ndarray:
        own = self.words.get(word)
        if own is not None:
            return own
        marked, at, total = f" {word} ", 0, np.zeros(len(self.languages))
        while at < len(marked):
            for n in range(min(self.longest, len(marked) - at), 0, -1):
                own = self.grams.get(marked[at : at + n])
                if own is not None:
                    total += own
                    break
            at += 1
        return total / len(marked)


def learn(docs: DataFrame, trains: Column, sample: int = SAMPLE) -> Model:
    """From at most about sample training documents of each language, chosen by a hash of their ids."""
    ship_package(docs.sparkSession)
    rows = labelled_sample(docs.select("doc_id", "lang", whole_text().alias("text")).where(trains), F.col("lang"), F.col("doc_id"), sample)

    schema = "lang string, feature string, n long"
    kinds = (pa.string(), pa.string(), pa.int64())

    def batch_of(counts: dict[str, Counter]) -> pa.RecordBatch:
        made = [(lang, f, n) for lang, c in counts.items() for f, n in c.items()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*made) if made else [()] * 3, kinds)], names=["lang", "feature", "n"])

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = defaultdict(Counter)
            for text, lang in zip(column(batch, "text").to_pylist(), column(batch, "label").to_pylist()):
                words[lang].update(WORD.findall(text.lower()))
            yield batch_of(words)

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Words of one count together, so that their n-grams are counted by Counter and weighted once.
            alike: dict[tuple[str, int], list[str]] = defaultdict(list)
            for lang, word, n in zip(*(column(batch, c).to_pylist() for c in ("lang", "feature", "n"))):
                alike[lang, n] += ngrams(word)
            grams: dict[str, Counter] = defaultdict(Counter)
            for (lang, n), found in alike.items():
                own = grams[lang]
                for g, times in Counter(found).items():
                    own[g] += n * times
            yield batch_of(grams)

    def scores(counted: DataFrame) -> Scores:
        found = counted.toArrow()  # the sample's distinct features
        features = found["feature"].combine_chunks().dictionary_encode()
        counts = np.zeros((len(features.dictionary), len(languages)))
        counts[np.asarray(features.indices), np.asarray(pc.index_in(found["lang"].combine_chunks(), pa.array(languages, found["lang"].type)))] = np.asarray(found["n"])
        return Scores(features.dictionary.to_pylist(), counts)

    summed = lambda df: df.groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    words = materialise(summed(rows.select("label", "text").mapInArrow(count_words, schema)))
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    return Model(languages, scores(words), scores(summed(words.mapInArrow(count_grams, schema))), name=uuid.uuid4().hex)


def identify(docs: DataFrame, model: Model, keep_text: bool = False) -> DataFrame:
    """docs' columns (text only if it is to be kept), lang_pred and score of every whole text. Columns of docs named
    lang_pred or score give way to the operator's."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the features of a bounded sample
    others = [c for c in docs.columns if c not in ("lang_pred", "score") and (keep_text or c != "text")]

    def work(texts: pa.Array, *fixed: pa.Array) -> pa.RecordBatch:
        m = shared.value
        number, table = _remembered(m)
        langs, scores = [], []
        for text in texts.to_pylist():
            found = WORD.findall((text or "").lower())
            if not found or not m.languages:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            at = [number.get(w, -1) for w in found]
            if -1 in at:
                at = [_number(m, number, table, w) for w in found]
            sums = table[0].take(at, axis=0).sum(axis=0)
            best = int(np.argmax(sums))
            langs.append(m.languages[best])
            scores.append(float(1 / np.exp(sums - sums[best]).sum()))
        return pa.record_batch([*fixed, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*others, "lang_pred", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in others), "lang_pred string, score double"])
    return docs.select(*others, *([] if keep_text else ["text"])).mapInArrow(per_chunk(work, *others), schema)


def _remembered(model: Model) -> tuple[dict[str, int], list[np.ndarray]]:
    """The worker's numbers of words and their rows."""
    return remembered("language", model.name, lambda: ({}, [np.zeros((1024, len(model.languages)), np.float64)]), lambda held: len(held[0]) > REMEMBERED)


def _number(model: Model, number: dict[str, int], table: list[np.ndarray], word: str) -> int:
    i = number.get(word)
    if i is None:
        i = number[word] = len(number)
        if i >= len(table[0]):
            table[0] = np.vstack([table[0], np.zeros_like(table[0])])
        table[0][i] = model.word_scores(word)
    return i
