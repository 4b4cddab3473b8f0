"""Operator 6: byte-level BPE by prefix dynamic programming.

For every prefix of a byte string exactly one token can end its encoding. The encoder stores that
token per prefix, so appending bytes never changes what is stored, and an edit invalidates only the
prefixes behind it. A token may end prefix i if it fits behind the last token of the prefix before
it: no merge across the joint may come earlier than the merges that made the two.

Texts are cut into matches of the pre-tokenizer's pattern by class changes over whole chunks of
text; the distinct matches of a chunk are encoded once, all of about one length side by side. Very
long texts are read in segments that end where a match ends whatever follows.

Nulls are empty texts; an empty text has no ids. Repeated rows each give a row. Ids of documents
pass through unchanged, null included.
"""

from __future__ import annotations

import base64
import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from aerolith.llm.common import CHUNK_BYTES, per_chunk, ragged, remembered, ship_package, utf8_data, whole_text

OTHER, LETTER, NUMBER, SPACE = range(4)
#: Matches of at most so many bytes are encoded side by side; longer ones one by one.
WIDTHS = (8, 16, 32, 64)
#: Whether two tokens fit is remembered in a table of this many places, a new pair in the place of an old one.
PLACES = 1 << 20
NEVER = 1 << 60


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point under the pattern's three sets."""
    points = np.r_[0:0xD800, 0xE000:0x110000].astype(np.uint32)
    everything = points.tobytes().decode("utf-32-le")
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, of in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(of, everything):
            out[points[m.start() : m.end()]] = kind
    return out


def match_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where a match of the pattern begins; matches cover every byte of each row."""
    if not len(data):
        return np.zeros(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    cps = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    cls = classes()[cps]
    n = len(cps)
    row_first = np.zeros(n + 1, bool)
    row_first[np.searchsorted(at, offsets)] = True
    row_first[n] = True
    run = row_first[:n].copy()
    run[1:] |= cls[1:] != cls[:-1]
    run_end = np.append(run[1:], True)
    begins = run.copy()
    # The last white space before something else is a match of its own, or belongs to what follows if it is a space.
    last_ws = np.flatnonzero((cls == SPACE) & run_end & ~row_first[1:])
    begins[last_ws] = True
    blank = last_ws[cps[last_ws] == 0x20]
    begins[blank + 1] = False
    # A quote that begins a match takes s, t, m, d, re, ve or ll with it.
    quote = np.flatnonzero((cps == 0x27) & begins)
    quote = quote[(quote + 1 < n)]
    quote = quote[~row_first[quote + 1]]
    one = cps[quote + 1]
    short = np.isin(one, np.array([ord(c) for c in "stmd"], np.uint32))
    two = np.where(row_first[np.minimum(quote + 2, n)], 0, cps[np.minimum(quote + 2, n - 1)])
    long = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l")))
    for which, size in ((short, 2), (long & ~short, 3)):
        q = quote[which]
        begins[q + 1] = False
        q = q[q + size < n]
        begins[q + size] |= cls[q + size] == LETTER
    return at[begins]


def safe_cuts(data: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Places about every half chunk where white space follows something else: a match begins there in any context.
    Only the first such place after each half chunk counts; a stretch without one stays whole."""
    step, cuts, at = CHUNK_BYTES // 2, [], start
    while stop - at > CHUNK_BYTES:
        at += step
        for a in range(at, stop, 1 << 16):
            part = data[a - 1 : min(a + (1 << 16), stop)]
            blank = (part == 0x20) | (part == 0x0A)
            found = np.flatnonzero(blank[1:] & (part[:-1] > 0x20) & (part[:-1] < 0x7F))
            if len(found):
                at = a + int(found[0])
                cuts.append(at)
                break
        else:
            break
    return np.array(cuts, np.int64)


class PrefixEncoder:
    """Prefix tables over one vocabulary. ranks: bytes to id; order: bytes to the place of their merge.

    The tokens that may end a prefix are found by an automaton over all tokens: delta gives the state after one more
    byte, head a state's longest token that is a suffix of what was read (as a state of its own), link the next shorter.
    """

    def __init__(self, ranks: dict[bytes, int], order: dict[bytes, int] | None = None, whole_first: bool = True):
        self.ranks, self.order = ranks, order or ranks
        self.longest = max(map(len, ranks))
        size = max(ranks.values()) + 1
        self.bytes_of = [b""] * size
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.size_of = np.array([len(x) for x in self.bytes_of], np.int64)
        parts = np.full((3, size), -1, np.int64)
        reached = {t: i for t, i in ranks.items() if self._reached(t, i, parts)}
        self.left, self.right, self.place = parts
        #: Tokens that plain merging of their bytes doesn't give; a match that is one is one token all the same.
        self.whole = {t: i for t, i in ranks.items() if t not in reached} if whole_first else {}
        self._automaton(reached)
        joints = {ranks[t[:k]] << 20 | ranks[t[k:]]: r for t, r in self.order.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.joints = np.array(sorted(joints), np.int64)
        self.joint_order = np.array([joints[j] for j in self.joints.tolist()], np.int64)
        self.pairs, self.fitting = np.full(PLACES, -1, np.int64), np.zeros(PLACES, bool)

    def _automaton(self, tokens: dict[bytes, int]) -> None:
        children: dict[int, int] = {}
        token_at, parent, byte_of, depth = [-1], [0], [0], [0]
        for token, i in tokens.items():
            state = 0
            for byte in token:
                key = state << 8 | byte
                child = children.get(key)
                if child is None:
                    child = children[key] = len(token_at)
                    token_at.append(-1)
                    parent.append(state)
                    byte_of.append(byte)
                    depth.append(depth[state] + 1)
                state = child
            token_at[state] = i
        n = len(token_at)
        self.token_at, self.depth = np.array(token_at, np.int64), np.array(depth, np.int64)
        parents, bytes_, delta = np.array(parent), np.array(byte_of), np.zeros((n, 256), np.int32)
        fail, link = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for d in range(max(depth) + 1):
            level = np.flatnonzero(self.depth == d)
            if d > 1:
                fail[level] = delta[fail[parents[level]], bytes_[level]]
            if d:
                link[level] = np.where(self.token_at[fail[level]] >= 0, fail[level], link[fail[level]])
                delta[level] = delta[fail[level]]
            below = np.flatnonzero(self.depth == d + 1)
            delta[parents[below], bytes_[below]] = below
        self.link, self.delta = link, delta.ravel()
        self.head = np.where(self.token_at >= 0, np.arange(n), link)

    def _reached(self, token: bytes, i: int, parts: np.ndarray) -> bool:
        """Whether plain merging of the token's own bytes gives the token; notes the halves and the place of its last merge."""
        pieces = [token[k : k + 1] for k in range(len(token))]
        order = self.order
        while len(pieces) > 1:
            rank, k = min((order.get(pieces[k] + pieces[k + 1], NEVER), k) for k in range(len(pieces) - 1))
            if rank == NEVER:
                return False
            if len(pieces) == 2:
                parts[:, i] = self.ranks[pieces[0]], self.ranks[pieces[1]], rank
            pieces[k : k + 2] = [pieces[k] + pieces[k + 1]]
        return True

    def fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the encoding of a's and b's bytes keeps the joint: no merge across it precedes those inside."""
        out = np.zeros(len(a), bool)
        open_, limit = np.arange(len(a)), np.full(len(a), NEVER)
        while len(open_):
            key = a << 20 | b
            at = np.minimum(np.searchsorted(self.joints, key), len(self.joints) - 1)
            joint = np.where(self.joints[at] == key, self.joint_order[at], NEVER)
            place_a, place_b = self.place[a], self.place[b]
            done = (joint >= limit) | (joint == NEVER)
            plain = (place_a < 0) & (place_b < 0)
            out[open_[done & plain]] = True
            on = done & ~plain
            first = place_a > place_b  # the later of the two merges is undone first
            limit = np.where(first, place_a, place_b + 1)[on]
            a, b = np.where(first, self.right[a], a)[on], np.where(first, b, self.left[b])[on]
            open_ = open_[on]
        return out

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """fit(), remembered."""
        key = a << 20 | b
        place = (key * 0x9E3779B97F4A7C1 >> 24) % PLACES
        known = self.pairs[place] == key
        if not known.all():
            new, at = np.unique(key[~known], return_index=True)
            at = place[~known][at]
            self.fitting[at] = good = self.fit(new >> 20, new & 0xFFFFF)
            self.pairs[at] = new
            out = self.fitting[place]
            lost = self.pairs[place] != key  # two new pairs in one place
            out[lost] = good[np.searchsorted(new, key[lost])] if not known[lost].any() else self.fit(a[lost], b[lost])
            return out
        return self.fitting[place]

    def _block(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids on end, and their numbers, of matches of the lengths, which don't rise; each has a column of last tokens."""
        width, n = int(lengths[0]), len(starts)
        stored = np.full((width + 1, n), -1, np.int32)
        state = np.zeros(n, np.int64)
        left = np.searchsorted(-lengths, -np.arange(1, width + 1), side="right")
        for end in range(1, width + 1):
            m = left[end - 1]
            state[:m] = self.delta[state[:m] << 8 | data[starts[:m] + (end - 1)]]
            todo, at = np.arange(m), self.head[state[:m]]
            while len(todo):
                token, size = self.token_at[at], self.depth[at]
                good = size == end
                inner = np.flatnonzero(~good)
                good[inner] = self.fits(stored[end - size[inner], todo[inner]].astype(np.int64), token[inner])
                stored[end, todo[good]] = token[good]
                todo, at = todo[~good], self.link[at[~good]]
        steps, at, active, counts = [], lengths.copy(), np.arange(n), np.zeros(n, np.int64)
        while len(active):
            token = stored[at[active], active]
            steps.append((active, token))
            counts[active] += 1
            at[active] -= self.size_of[token]
            active = active[at[active] > 0]
        out, last = np.empty(int(counts.sum()), np.uint32), np.cumsum(counts) - 1
        for k, (active, token) in enumerate(steps):
            out[last[active] - k] = token
        return out, counts

    def last_tokens(self, data: bytes, stored: list[int], keep: int = 0) -> list[int]:
        """stored[i]: the last token of prefix i (at 0: none). Extends the table of the first keep bytes to all of data."""
        del stored[keep + 1 :]
        if not stored:
            stored.append(-1)
        delta, state, begin = self.delta, 0, max(0, keep - self.longest)
        for end, byte in enumerate(data[begin:], begin + 1):
            state = int(delta[state << 8 | byte])
            if end <= keep:
                continue
            at = int(self.head[state])
            while True:
                token, size = int(self.token_at[at]), int(self.depth[at])
                if size == end or self._fits_one(stored[end - size], token):
                    break
                at = int(self.link[at])
            stored.append(token)
        return stored

    def _fits_one(self, a: int, b: int) -> bool:
        key = a << 20 | b
        place = (key * 0x9E3779B97F4A7C1 >> 24) % PLACES
        return bool(self.fitting[place]) if self.pairs[place] == key else bool(self.fits(np.array([a]), np.array([b]))[0])

    def walk(self, data: bytes, stored: list[int]) -> list[int]:
        """The ids of data, read back from its last prefix."""
        out, i, of = [], len(data), self.bytes_of
        while i:
            out.append(token := stored[i])
            i -= len(of[token])
        return out[::-1]

    def append(self, data: bytes, stored: list[int], more: bytes) -> tuple[bytes, list[int]]:
        """The table of data + more; what is stored of data stays valid."""
        return data + more, self.last_tokens(data + more, stored, len(data))

    def edit(self, data: bytes, stored: list[int], at: int, removed: int, put: bytes) -> tuple[bytes, list[int]]:
        """The table after an edit; prefixes that end before it are kept."""
        new = data[:at] + put + data[at + removed :]
        return new, self.last_tokens(new, stored, at)

    def encode_matches(self, matches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids on end, and their numbers, of matches: byte strings that are encoded apart from others."""
        n = len(matches)
        _, bounds, raw = matches.buffers()
        bounds = np.frombuffer(bounds, np.int32 if pa.types.is_binary(matches.type) else np.int64)[matches.offset : matches.offset + n + 1].astype(np.int64)
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        lengths = np.diff(bounds)
        order = np.argsort(-lengths, kind="stable")
        cuts = np.searchsorted(-lengths[order], [-w for w in reversed(WIDTHS)], side="left").tolist()
        ids, counts = [], []
        for i in order[: cuts[0]].tolist():
            match = data[bounds[i] : bounds[i + 1]].tobytes()
            ids.append(np.array(self.walk(match, self.last_tokens(match, [])), np.uint32))
            counts.append(np.array([len(ids[-1])]))
        for a, b in zip(cuts, [*cuts[1:], n]):
            if b > a:
                own = order[a:b]
                made = self._block(data, bounds[own], lengths[own])
                ids.append(made[0])
                counts.append(made[1])
        # Back into the order of the matches.
        flat, sizes = np.concatenate([np.zeros(0, np.uint32), *ids]), np.concatenate([np.zeros(0, np.int64), *counts])
        first = np.empty(n, np.int64)
        first[order] = np.cumsum(sizes) - sizes
        number = np.empty(n, np.int64)
        number[order] = sizes
        flat = flat[ragged(first, number)]
        if self.whole:
            found = [(i, self.whole[m]) for i, m in enumerate(matches.to_pylist()) if m in self.whole]
            if found:
                parts = np.split(flat, np.cumsum(number)[:-1])
                for i, token in found:
                    parts[i], number[i] = np.array([token], np.uint32), 1
                flat = np.concatenate(parts)
        return flat, number

    def encode_rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end and the rows' offsets in them."""
        data, offsets = utf8_data(texts)
        if len(data) <= 2 * CHUNK_BYTES:
            return self._encode_bytes(data, offsets)
        # Pieces of long rows are rows of their own for a while.
        bounds = np.unique(np.concatenate([offsets, *(safe_cuts(data, a, b) for a, b in zip(offsets[:-1], offsets[1:]) if b - a > CHUNK_BYTES)]))
        parts, ends, at, done = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)], 0, 0
        while at < len(bounds) - 1:
            stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK_BYTES, side="right")) - 1)
            ids, own = self._encode_bytes(data[bounds[at] : bounds[stop]], bounds[at : stop + 1] - bounds[at])
            parts.append(ids)
            ends.append(own[1:] + done)
            at, done = stop, done + len(ids)
        return np.concatenate(parts), np.concatenate(ends)[np.searchsorted(bounds, offsets)]

    def _encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = match_starts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        bounds = np.append(starts, len(data)).astype(np.int32 if len(data) < 1 << 31 else np.int64)
        kind = pa.binary() if bounds.dtype == np.int32 else pa.large_binary()
        coded = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        flat, sizes = self.encode_matches(coded.dictionary)
        which = np.asarray(coded.indices)
        lengths = sizes[which]
        out = flat[ragged((np.cumsum(sizes) - sizes)[which], lengths)]
        ends = np.append(0, np.cumsum(lengths))
        return out, ends[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def from_ranks(path: str) -> PrefixEncoder:
    """From a file of base64 tokens and ranks; remembered."""
    return remembered("bpe", path, lambda: _read_ranks(path))


def from_json(path: str) -> tuple[PrefixEncoder, dict[str, int]]:
    """From a byte-level BPE tokenizer's JSON file: the encoder and the special tokens; remembered."""
    return remembered("bpe", path, lambda: _read_json(path))


def _read_ranks(path: str) -> PrefixEncoder:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return PrefixEncoder(ranks)


def _read_json(path: str) -> tuple[PrefixEncoder, dict[str, int]]:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    raw = lambda s: bytes(byte_of[c] for c in s)
    ranks = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    order = {t: -1 for t in ranks if len(t) == 1}
    for i, m in enumerate(spec["model"]["merges"]):
        a, b = m.split(" ") if isinstance(m, str) else m
        order.setdefault(raw(a) + raw(b), i)
    return PrefixEncoder(ranks, order, whole_first=False), special


def encode_like_library(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each row as the tokenizer file gives them, its special strings being single ids."""
    encoder, special = from_json(path)
    ids, ends = encoder.encode_rows(texts)
    if not special:
        return ids, ends
    pattern = "|".join(map(regex.escape, special))
    marked = np.flatnonzero(np.asarray(pc.match_substring_regex(pc.fill_null(texts, ""), pattern)))
    if not len(marked):
        return ids, ends
    parts = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
    for row in marked.tolist():
        found = regex.split(f"({pattern})", texts[row].as_py())
        own, bounds = encoder.encode_rows(pa.array(found[::2], pa.string()))
        pieces = [own[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for i, name in enumerate(found[1::2]):
            pieces[i] = np.append(pieces[i], np.uint32(special[name]))
        parts[row] = np.concatenate(pieces)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.concatenate(parts).astype(np.uint32), np.append(0, np.cumsum(sizes))


def encode_documents(docs: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, ids (array), decoded (binary) of every whole text."""
    ship_package(docs.sparkSession)

    def work(texts: pa.Array, doc_id: pa.Array) -> pa.RecordBatch:
        encoder = from_ranks(ranks_path)
        ids, ends = encoder.encode_rows(texts)
        decoded = [encoder.decode(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
        return pa.record_batch([doc_id, lists, pa.array(decoded, pa.binary())], names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(per_chunk(work, "doc_id"), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")


def encode_digests(docs: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, hashed where it is encoded."""
    ship_package(docs.sparkSession)

    def work(texts: pa.Array, doc_id: pa.Array) -> pa.RecordBatch:
        encoder = from_ranks(ranks_path)
        ids, ends = encoder.encode_rows(texts)
        spans = list(zip(ends[:-1].tolist(), ends[1:].tolist()))
        raw = ids.astype("<u4")
        return pa.record_batch(
            [
                doc_id,
                pa.array(np.diff(ends)),
                pa.array([hashlib.sha256(raw[a:b].tobytes()).hexdigest() for a, b in spans], pa.string()),
                pa.array([hashlib.sha256(encoder.decode(ids[a:b])).hexdigest() for a, b in spans], pa.string()),
            ],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(per_chunk(work, "doc_id"), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
