"""Operator 10: removal of byte strings that occur elsewhere.

The suffix array of the corpus by difference covers moves a record of at least 16 bytes for each
text byte several times, which is beyond the disk that this operator may use (figures in the
README). Like a difference cover, this operator works on a sample of positions that any two equal
strings of LENGTH bytes must share, but picks it by content: the position of the least hashed
GRAM-byte string in each window of LENGTH bytes. Equal windows pick the same string in the same
place, so only occurrences of the same string can be equal windows.

1. Runs of windows that pick one position are named by the hash of the bytes they span. For each
   picked string, all runs alike and more than one: all their windows repeat. A single run: none.
2. Where runs of one string differ, each of their windows is named by its own hash, and repeats if
   that name occurs twice.

Names are 64-bit hashes. Windows never cross documents; overlapping occurrences count. Null texts
are empty. Repeated rows are occurrences of each other. Texts under LENGTH bytes lose nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import forget, utf8_data
from aerolith.llm.hashing import Ranges
from aerolith.llm.shards import SHARD_BYTES, answer, answered, ask, by_bucket, rows, segments, sharded, text_bytes

LENGTH, GRAM = 200, 50
#: Bytes of text hashed at once (positions must fit in the low 24 bits of a key).
STEP = 1 << 19
LOW = np.uint64((1 << 24) - 1)
SINGLE, ALIKE, DIFFERENT = 0, 1, 2
QUESTION = "bucket int, shard int, kind int, keys binary, spans binary, flags binary"
ANSWER = "shard int, bucket int, kind int, codes binary"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each width consecutive values."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def picked_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """For chunks of the rows: (shift, hashes, first window, last window, picked string's hash, span's hash)."""
    for chunk in segments(offsets, length - 1, STEP):
        own = np.concatenate([data[a:b] for a, b in chunk])
        if len(own) < length:
            continue
        hashes = Ranges(own)
        p = np.arange(len(own) - gram + 1)
        strings = hashes(p, p + gram)
        picks = sliding_min((strings & ~LOW) | p.astype(np.uint64), length - gram + 1) & LOW
        valid = np.zeros(len(own), bool)
        shift = np.zeros(len(own), np.int32)
        at = 0
        for a, b in chunk:
            valid[at : max(at, at + b - a - length + 1)] = True
            shift[at : at + b - a] = a - at
            at += b - a
        windows = np.flatnonzero(valid)
        if not len(windows):
            continue
        picks = picks[windows].astype(np.int64)
        new = np.append(True, (picks[1:] != picks[:-1]) | (windows[1:] != windows[:-1] + 1))
        first = windows[new]
        last = windows[np.append(np.flatnonzero(new)[1:] - 1, len(windows) - 1)]
        yield shift, hashes, first, last, strings[picks[new]], hashes(first, last + length)


def distinct(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by bucket and key: order of the keys, starts of the distinct ones, these, and their buckets."""
    own = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((keys, own))
    keys, own = keys[order], own[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return order, starts, keys[starts], own[starts]


def statuses(keys: np.ndarray, answers: pa.Table, kind: int, buckets: int) -> np.ndarray:
    """The answer to each key."""
    order, starts, _, _ = distinct(keys, buckets)
    out = np.zeros(len(keys), np.uint8)
    if len(keys):
        out[order] = np.repeat(answered(answers, kind, "codes", np.uint8), np.diff(np.append(starts, len(keys))))
    return out


def removal(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, as_text: bool = False) -> DataFrame:
    """docs' columns but text, and n_bytes, n_removed, n_spans, kept: the remaining bytes, or as_text the
    characters of which every byte remains. Columns of docs that have one of these names give way; any other name may occur."""
    n = max(1, -(-text_bytes(docs) // shard_bytes))
    shown = [c for c in docs.columns if c not in ("text", "n_bytes", "n_removed", "n_spans", "kept")]
    # Own names for the caller's columns, so that none clashes with the operator's.
    docs = docs.select(*(F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(shown)), "text")
    others = docs.columns[:-1]
    documents = sharded(docs, n, others[shown.index("doc_id")])

    def shard_data(table: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
        forget()
        data, offsets = utf8_data(table["text"].combine_chunks())
        return table["shard"][0].as_py(), data, offsets

    def ask_runs(table: pa.Table) -> pa.Table:
        shard, data, offsets = shard_data(table)
        found = [(g, s) for *_, g, s in picked_runs(data, offsets, length, gram)]
        if not found:
            return rows(QUESTION, [])
        strings, spans = (np.concatenate(x) for x in zip(*found))
        order, starts, keys, buckets = distinct(strings, n)
        spans = spans[order]
        low, high = np.minimum.reduceat(spans, starts), np.maximum.reduceat(spans, starts)
        several = np.diff(np.append(starts, len(strings))) > 1
        flags = np.where(low != high, DIFFERENT, np.where(several, ALIKE, SINGLE)).astype(np.uint8)
        return rows(QUESTION, [(b, shard, 1, keys[x].tobytes(), low[x].tobytes(), flags[x].tobytes()) for b, x in by_bucket(buckets)])

    def gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
        """A bucket's keys and flags on end, and the shards that asked with the number of their keys."""
        blobs = table["keys"].to_pylist()
        keys = np.frombuffer(b"".join(blobs), np.uint64)
        flags = np.frombuffer(b"".join(table["flags"].to_pylist()), np.uint8)
        return keys, flags, list(zip(table["shard"].to_pylist(), (len(b) // 8 for b in blobs)))

    def reply(table: pa.Table, codes: np.ndarray, asked: list[tuple[int, int]], kind: int) -> pa.Table:
        ends = np.cumsum([0, *(k for _, k in asked)])
        bucket = table["bucket"][0].as_py()
        return rows(ANSWER, [(shard, bucket, kind, codes[a:b].tobytes()) for (shard, _), a, b in zip(asked, ends[:-1], ends[1:])])

    def compare_runs(table: pa.Table) -> pa.Table:
        keys, flags, asked = gathered(table)
        spans = np.frombuffer(b"".join(table["spans"].to_pylist()), np.uint64)
        order = np.argsort(keys)
        starts = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
        spans, sizes = spans[order], np.diff(np.append(starts, len(keys)))
        most = np.maximum.reduceat(flags[order], starts)
        differ = (most == DIFFERENT) | (np.minimum.reduceat(spans, starts) != np.maximum.reduceat(spans, starts))
        status = np.where(differ, DIFFERENT, np.where((sizes > 1) | (most == ALIKE), ALIKE, SINGLE)).astype(np.uint8)
        codes = np.empty(len(keys), np.uint8)
        codes[order] = np.repeat(status, sizes)
        return reply(table, codes, asked, 1)

    def open_windows(data: np.ndarray, offsets: np.ndarray, answers: pa.Table):
        """The runs with their status: shift, hashes, first and last windows, status."""
        runs = list(picked_runs(data, offsets, length, gram))
        if not runs:
            return
        status = statuses(np.concatenate([r[4] for r in runs]), answers, 1, n)
        at = 0
        for shift, hashes, first, last, strings, _ in runs:
            yield shift, hashes, first, last, status[at : at + len(strings)]
            at += len(strings)

    def windows_of(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        sizes = last - first + 1
        return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))

    def ask_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return rows(QUESTION, [])
        shard, data, offsets = shard_data(table)
        names = []
        for _, hashes, first, last, status in open_windows(data, offsets, answers):
            w = windows_of(first[status == DIFFERENT], last[status == DIFFERENT])
            names.append(hashes(w, w + length))
        if not names:
            return rows(QUESTION, [])
        names = np.concatenate(names)
        _, starts, keys, buckets = distinct(names, n)
        flags = (np.diff(np.append(starts, len(names))) > 1).astype(np.uint8)
        return rows(QUESTION, [(b, shard, 2, keys[x].tobytes(), b"", flags[x].tobytes()) for b, x in by_bucket(buckets)])

    def compare_windows(table: pa.Table) -> pa.Table:
        keys, flags, asked = gathered(table)
        order = np.argsort(keys)
        starts = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
        sizes = np.diff(np.append(starts, len(keys)))
        twice = (sizes > 1) | (np.maximum.reduceat(flags[order], starts) > 0)
        codes = np.empty(len(keys), np.uint8)
        codes[order] = np.repeat(twice, sizes)
        return reply(table, codes, asked, 2)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        shard, data, offsets = shard_data(table) if table.num_rows else (0, np.zeros(0, np.uint8), np.zeros(1, np.int64))
        begins, names = [], []
        change = np.zeros(len(data) + 1, np.int32)
        for shift, hashes, first, last, status in open_windows(data, offsets, answers):
            alike = status == ALIKE
            np.add.at(change, first[alike] + shift[first[alike]], 1)
            np.add.at(change, last[alike] + shift[last[alike]] + length, -1)
            w = windows_of(first[status == DIFFERENT], last[status == DIFFERENT])
            begins.append(w + shift[w])
            names.append(hashes(w, w + length))
        if names:
            repeated = np.concatenate(begins)[statuses(np.concatenate(names), answers, 2, n) > 0]
            np.add.at(change, repeated, 1)
            np.add.at(change, repeated + length, -1)
        gone = np.cumsum(change[:-1]) > 0
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        opens[offsets[:-1][offsets[:-1] < len(data)]] = gone[offsets[:-1][offsets[:-1] < len(data)]]
        count = lambda flags: np.diff(np.append(0, np.cumsum(flags))[offsets])
        kept_ends = np.append(0, np.cumsum(~gone))[offsets]
        kept = data[~gone].tobytes()
        made = [table[c].combine_chunks() for c in others]
        made += [pa.array(x, pa.int64()) for x in (np.diff(offsets), count(gone), count(opens))]
        parts = [kept[a:b] for a, b in zip(kept_ends[:-1].tolist(), kept_ends[1:].tolist())]
        made.append(pa.array([p.decode(errors="ignore") for p in parts] if as_text else parts, pa.string() if as_text else pa.binary()))
        return pa.table(made, names=[*others, "n_bytes", "n_removed", "n_spans", "kept"])

    about_runs = answer(ask(documents, ask_runs, QUESTION), compare_runs, ANSWER)
    about_windows = answer(ask(documents, ask_windows, QUESTION, about_runs), compare_windows, ANSWER)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"), f"n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}"])
    found = ask(documents, remove, schema, about_runs.union(about_windows))
    return found.select(*(F.col(o).alias(c) for o, c in zip(others, shown)), "n_bytes", "n_removed", "n_spans", "kept")
