"""Operator 5: three-word language model scores from Elias-Fano tries.

The model is learnt from all training documents: a word's probability after the two words before it is
its discounted share of their continuations; what the discount takes goes to the word's probability after
one word, from there to its discounted unigram probability, and the unigrams' discount to unknown words. First words are dealt
to buckets by hash; each bucket builds the trie of its words, pairs and triples and answers what shards of documents ask
about their distinct triples, which hold their pairs: every token stands between the one before and the one behind it, the last
one before PAD. The beginning of texts and words with over 1/2048 of all bytes (at most 1024 can be) are
first words dealt to all buckets by what follows them, pairs as frequent as that are dealt by their third words. Totals of
both come with the corpus counts, and the numbers of their distinct continuations from aggregations over the whole corpus.

Null and empty texts are one end token. A document's rows are scored each. Without training
documents every text scores 0. Hashes are of 62 bits (first words) and 32 bits (among the successors of one word or pair).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import CHUNK_BYTES, column, forget, ship_package, text_chunks, utf8_data, whole_text
from aerolith.llm.hashing import lower_ascii, mix, range_hashes, word_spans
from aerolith.llm.ngram_trie import CONTEXT_BITS, SUCCESSOR_BITS, Trie, probability, quantise
from aerolith.llm.shards import SHARD_BYTES, answer, ask, by_bucket, rows, sharded, text_bytes

DISCOUNT, UNIGRAM_DISCOUNT = 0.8, 0.75
BEGIN, END, PAD = np.uint64(1), np.uint64(2), np.uint64(3)
CONTEXT_MASK, SUCCESSOR_MASK = np.uint64((1 << CONTEXT_BITS) - 1), np.uint64((1 << SUCCESSOR_BITS) - 1)
HALF = np.uint64(32)
QUESTION = "bucket int, shard int, contexts binary, context_runs binary, seconds binary, pair_runs binary, thirds binary, counts binary"
ANSWER = "shard int, bucket int, totals binary, kinds binary, pair_codes binary, backs binary, codes binary"


def packed(values: np.ndarray, dtype: str) -> bytes:
    """Numbers as byte planes, compressed: most of them are small."""
    raw = np.ascontiguousarray(values.astype(dtype)).view(np.uint8).reshape(-1, np.dtype(dtype).itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def unpacked(held: bytes, dtype: str) -> np.ndarray:
    raw = pa.Codec("zstd").decompress(held[8:], int.from_bytes(held[:8], "little"), asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0x9E3779B97F4A7C15) ^ mix(second & SUCCESSOR_MASK))


def places(listed: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is in the sorted list, and where."""
    if not len(listed):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(listed, keys), len(listed) - 1)
    return listed[at] == keys, at


def merged(keys: np.ndarray) -> np.ndarray:
    """First places of equal neighbours."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first) if len(first) else np.zeros(0, np.int64)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word of the rows."""
    out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    at = 0
    while at < len(offsets) - 1:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES // 4, side="right")) - 1)
        own, bounds = lower_ascii(data[offsets[at] : offsets[stop]]), offsets[at : stop + 1] - offsets[at]
        starts, ends, row = word_spans(own, bounds)
        out.append((range_hashes(own, starts, ends) & CONTEXT_MASK, row + at))
        at = stop
    return tuple(np.concatenate(x) for x in zip(*out))


def sequences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, token and row of every token of the rows, the end tokens included."""
    word, row = words(data, offsets)
    n = len(offsets) - 1
    token = np.full(len(word) + n, END, np.uint64)
    token[np.arange(len(word)) + row] = word
    last = np.cumsum(np.bincount(row, minlength=n) + 1) - 1
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[np.append(0, last[:-1] + 1)[:n]] = BEGIN
    return context, token, np.repeat(np.arange(n), np.diff(np.append(-1, last)))


def following(token: np.ndarray) -> np.ndarray:
    """The token behind each one; PAD behind an end."""
    return np.where(token == END, PAD, np.append(token[1:], PAD))


def corpus_counts(docs: DataFrame, limit: int) -> tuple[int, int, dict[int, int]]:
    """Words in the training documents, distinct ones, and the counts of those with more than limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "text")
            for a, b in text_chunks(texts, CHUNK_BYTES * 2):
                keys, counts = np.unique(words(*utf8_data(texts.slice(a, b - a)))[0], return_counts=True)
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())], names=["word", "n"])

    counted = docs.where("trains").select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = counted.agg(F.sum("n").alias("total"), F.count("*").alias("distinct"), F.collect_list(F.when(F.col("n") > limit, F.struct("word", "n"))).alias("frequent")).first()
    return found["total"] or 0, found["distinct"], {r["word"]: r["n"] for r in found["frequent"]}


def continuation_counts(docs: DataFrame, keys: np.ndarray, order: int, limit: int) -> tuple[np.ndarray, dict[int, int]]:
    """How many distinct tokens follow each of the sorted keys (words, or the keys of pairs if order is 2) in the training
    documents, and the key and count of each continued key with more than limit. keys: those of counts over limit, so both are few."""
    out, frequent = np.zeros(len(keys), np.int64), {}
    if not len(keys):
        return out, frequent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "text")
            for a, b in text_chunks(texts, CHUNK_BYTES * 2):
                context, token, _ = sequences(*utf8_data(texts.slice(a, b - a)))
                if order == 2:
                    context, token = pair_keys(context, token), following(token)
                own, at = places(keys, context)
                continued, first, n = np.unique(pair_keys(context[own], token[own]), return_index=True, return_counts=True)
                yield pa.record_batch([pa.array(at[own][first], pa.int64()), pa.array(continued.view(np.int64)), pa.array(n, pa.int64())], names=["place", "continued", "n"])

    counted = docs.where("trains").select("text").mapInArrow(run, "place long, continued long, n long").groupBy("place", "continued").agg(F.sum("n").alias("n"))
    over = F.collect_list(F.when(F.col("n") > limit, F.struct("continued", "n")))
    for r in counted.groupBy("place").agg(F.count("*").alias("n"), over.alias("over")).collect():  # at most one row for each key
        out[r["place"]] = r["n"]
        frequent |= {x["continued"] & (2**64 - 1): x["n"] for x in r["over"]}
    return out, frequent


def score(docs: DataFrame, trains, shard_bytes: int = 2 * SHARD_BYTES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every document; trains: column that marks training documents."""
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", whole_text().alias("text"), F.coalesce(trains, F.lit(False)).alias("trains"))
    size = text_bytes(docs)
    n = max(1, -(-size // shard_bytes))
    limit = max(1000, size // 2048)
    total, n_distinct, hot = corpus_counts(docs, limit)
    ends = docs.where("trains").count()
    n_all, v_all = total + ends, n_distinct + (ends > 0)
    if ends:
        hot[int(BEGIN)] = ends  # the context of every training document's first token
    hot_words = np.array(sorted(hot), np.uint64)
    hot_counts = np.array([hot[w] for w in sorted(hot)], np.int64)
    hot_kinds, hot = continuation_counts(docs, hot_words, 1, limit)
    hot_pairs = np.array(sorted(hot), np.uint64)
    pair_counts = np.array([hot[p] for p in sorted(hot)], np.int64)
    pair_kinds, _ = continuation_counts(docs, hot_pairs, 2, limit)
    documents = sharded(docs, n)

    def triples(table: pa.Table):
        """The shard's tokens, the number of each one's triple (before, token, behind), and the distinct triples in the
        order of its questions."""
        forget()
        data, offsets = utf8_data(table["text"].combine_chunks())
        context, token, row = sequences(data, offsets)
        vocabulary, number = np.unique(np.append(token, [BEGIN, PAD]), return_inverse=True)
        number = number.astype(np.uint64)
        begin, pad, number = number[-2], number[-1], number[:-2]
        before = np.where(context == BEGIN, begin, np.append(begin, number[:-1]))
        behind = np.where(token == END, pad, np.append(number[1:], pad))
        pair, inverse = np.unique(before << HALF | number, return_inverse=True)
        triple, inverse = np.unique(inverse.astype(np.uint64) << HALF | behind, return_inverse=True)
        first, second = vocabulary[pair >> HALF], vocabulary[pair & (1 << 32) - 1]
        spread = mix(first) + np.where(places(hot_words, first)[0], mix(second), np.uint64(0))
        own, third = (triple >> HALF).astype(np.int64), vocabulary[triple & (1 << 32) - 1]
        frequent = places(hot_pairs, pair_keys(first, second))[0][own]
        bucket = ((spread[own] + np.where(frequent, mix(third), np.uint64(0))) % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        own = own[order]
        return token, row, len(offsets) - 1, place[inverse], first[own], second[own], third[order], bucket[order]

    def starts(first: np.ndarray, second: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a first word's triples, and a pair's, start at each of the questions."""
        new = np.append(True, (first[1:] != first[:-1]) | (bucket[1:] != bucket[:-1]))
        return new, new | np.append(True, second[1:] != second[:-1])

    def ask_triples(table: pa.Table) -> pa.Table:
        _, row, _, which, first, second, third, bucket = triples(table)
        trains = np.asarray(table["trains"].combine_chunks())
        counts = np.bincount(which[trains[row]], minlength=len(first))
        new_word, new_pair = starts(first, second, bucket)
        shard, made = table["shard"][0].as_py(), []
        for b, x in by_bucket(bucket):
            w, p = np.flatnonzero(new_word[x]), np.flatnonzero(new_pair[x])
            context_runs = np.diff(np.append(np.searchsorted(p, w), len(p)))
            pair_runs = np.diff(np.append(p, x.stop - x.start))
            short = [(y & SUCCESSOR_MASK).astype("<u4").tobytes() for y in (second[x][p], third[x])]
            made.append((b, shard, first[x][w].tobytes(), packed(context_runs, "<u4"), short[0], packed(pair_runs, "<u4"), short[1], packed(counts[x], "<u4")))
        return rows(QUESTION, made)

    def unpack(r: dict) -> list[np.ndarray]:
        runs = [unpacked(r[k], "<u4").astype(np.int64) for k in ("context_runs", "pair_runs", "counts")]
        return [np.frombuffer(r["contexts"], np.uint64), runs[0], np.frombuffer(r["seconds"], "<u4"), runs[1], np.frombuffer(r["thirds"], "<u4"), runs[2]]

    def build(asked: list[list[np.ndarray]]) -> Trie:
        parts = []
        for contexts, context_runs, seconds, pair_runs, thirds, counts in asked:
            trained = counts > 0
            pair = np.repeat(np.arange(len(seconds)), pair_runs)[trained]
            parts.append((np.repeat(contexts, context_runs)[pair], seconds[pair], thirds[trained], counts[trained]))
        first, second, third, k = (np.concatenate(x) for x in zip(*parts))
        contexts, inverse = np.unique(first, return_inverse=True)
        pairs, inverse = np.unique(inverse.astype(np.uint64) << HALF | second, return_inverse=True)
        keys = inverse.astype(np.uint64) << HALF | third
        order = np.argsort(keys)
        keys = keys[order]
        new = merged(keys)
        keys, k = keys[new], sums(k[order], new)
        pair_of, context_of = (keys >> HALF).astype(np.int64), (pairs >> HALF).astype(np.int64)
        from_pair, from_context = merged(pair_of), merged(context_of)
        k2, kinds2 = sums(k, from_pair), np.diff(np.append(from_pair, len(keys)))
        frequent, at = places(hot_pairs, pair_keys(contexts[context_of], pairs & SUCCESSOR_MASK))
        k2[frequent], kinds2[frequent] = pair_counts[at[frequent]], pair_kinds[at[frequent]]
        totals, kinds = sums(k2, from_context), np.diff(np.append(from_context, len(pairs)))
        frequent, at = places(hot_words, contexts)
        totals[frequent], kinds[frequent] = hot_counts[at[frequent]], hot_kinds[at[frequent]]
        fields = {
            "totals": totals.astype(np.int64),
            "kinds": kinds.astype(np.int64),
            "pair_codes": quantise((k2 - DISCOUNT) / totals[context_of]),
            "backs": quantise(DISCOUNT * kinds2 / k2),
            "codes": quantise((k - DISCOUNT) / k2[pair_of]),
        }
        return Trie(contexts, [(from_context, pairs & SUCCESSOR_MASK), (from_pair, keys & SUCCESSOR_MASK)], fields)

    def look_up(table: pa.Table) -> pa.Table:
        listed = table.to_pylist()
        asked = [unpack(r) for r in listed]
        trie, made = build(asked), []

        def field(name: str, at: np.ndarray) -> np.ndarray:
            out = np.zeros(len(at), trie.fields[name].dtype)
            out[at >= 0] = trie.fields[name][at[at >= 0]]
            return out

        for r, (contexts, context_runs, seconds, pair_runs, thirds, _) in zip(listed, asked):
            number = trie.find_contexts(contexts)
            totals, kinds = field("totals", number), field("kinds", number)
            frequent, word = places(hot_words, contexts)
            totals[frequent], kinds[frequent] = hot_counts[word[frequent]], hot_kinds[word[frequent]]
            pair = trie.find(0, np.repeat(number, context_runs), seconds)
            pair_codes, backs = field("pair_codes", pair), field("backs", pair)
            # A hot pair's share is known here even where none of its triples was dealt to this bucket.
            frequent, at = places(hot_pairs, pair_keys(np.repeat(contexts, context_runs), seconds.astype(np.uint64)))
            at = at[frequent]
            pair_codes[frequent] = quantise((pair_counts[at] - DISCOUNT) / np.repeat(totals, context_runs)[frequent])
            backs[frequent] = quantise(DISCOUNT * pair_kinds[at] / pair_counts[at])
            codes = field("codes", trie.find(1, np.repeat(pair, pair_runs), thirds))
            made.append((r["shard"], r["bucket"], packed(totals, "<i8"), packed(kinds, "<i8"), packed(pair_codes, "u1"), packed(backs, "u1"), packed(codes, "u1")))
        return rows(ANSWER, made)

    def score_shard(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not table.num_rows:
            return pa.table([table["doc_id"], *[pa.array([], pa.int64())] * 3, *[pa.array([], pa.float64())] * 2], names=names)
        token, row, n_rows, which, first, second, _, bucket = triples(table)
        answers = answers.sort_by("bucket")
        totals, kinds, pair_codes, backs, codes = (
            np.concatenate([unpacked(x, t) for x in answers[c].to_pylist()]) for c, t in (("totals", "<i8"), ("kinds", "<i8"), ("pair_codes", "u1"), ("backs", "u1"), ("codes", "u1"))
        )
        new_word, new_pair = starts(first, second, bucket)
        # Every word is the first one of a triple, so the shard knows the counts of all its words.
        seen, at = np.unique(first[new_word], return_index=True)
        count_of, known = totals[at], second[new_pair]
        found, place = places(seen, known)
        count = np.where(known == END, ends, np.where(found, count_of[place], 0))
        if n_all:
            base = np.log10((count + 0.1) / (n_all + 0.1 * (v_all + 1)))
            unigram = np.where(count > 0, (count - UNIGRAM_DISCOUNT) / n_all, UNIGRAM_DISCOUNT * v_all / n_all)
        else:
            base, unigram = np.zeros(len(known)), np.ones(len(known))
        back_off = np.where(totals > 0, np.minimum(1, DISCOUNT * np.maximum(kinds, 1) / np.maximum(totals, 1)), 1.0)
        after_one = probability(pair_codes) + back_off[(np.cumsum(new_word) - 1)[new_pair]] * unigram
        pair = (np.cumsum(new_pair) - 1)[which]
        value = after_one[pair]
        inner = np.flatnonzero(np.append(False, row[1:] == row[:-1]))  # tokens with two before them, the beginning included
        back = backs[pair[inner - 1]]
        value[inner] = probability(codes[which[inner - 1]]) + np.where(back > 0, probability(back), 1.0) * value[inner]
        summed = lambda x: np.bincount(row, x, minlength=n_rows)
        made = [np.bincount(row, minlength=n_rows), summed((count > 0).astype(np.float64)[pair]).astype(np.int64), np.full(n_rows, n_all)]
        return pa.table([table["doc_id"].combine_chunks(), *(pa.array(x.astype(np.int64)) for x in made), pa.array(summed(base[pair])), pa.array(summed(np.log10(value)))], names=names)

    answers = answer(ask(documents, ask_triples, QUESTION), look_up, ANSWER)
    return ask(documents, score_shard, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, n_known long, train_tokens long, base_score double, score double", answers)
