"""Operator 4: packing token streams into windows by Karmarkar-Karp multiway differencing.

Documents are encoded where they are read and gathered into groups of about GROUP windows. What a
document holds in whole windows fills windows of its own; the rest of a longer document is cut into
small items, any other document is one item. Differencing merges partial partitions of a group's
items with opposing imbalances until one partition is left, whose windows are nearly equal. Where
one of them exceeds the capacity, the number of windows rises and the group is divided anew, as long
as the group's padding stays under the stated share (a fiftieth of its windows, or one window).
Beyond that whole documents would cost more padding: each window that is still over capacity loses
the end of one document, is then full and closed, and what was cut off is divided over the windows
that are left. A document is cut a second time only where a window holds no other.

A task packs the rows of its own partition, so no rows are shuffled; sequence_id holds the
partition number and a counter. Only a task's last group isn't filled on purpose; partitions of
little text are joined first (coalesce), so such groups don't count. Null texts are empty documents
of one token (the closing id). Repeated rows are packed each. An empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from aerolith.llm.bpe import encode_like_library
from aerolith.llm.common import column, ship_package, text_chunks, whole_text
from aerolith.llm.shards import text_bytes

PIECE_SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Windows of a group; tokens of an item of a document that is longer than a window; bytes of text of a task, at least.
GROUP, ITEM, TASK_BYTES = 64, 256, 4 << 20
#: One window in so many may be added for padding's sake before documents are cut.
PADDING = 50


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: item numbers of each window. The two partitions with the largest spread are merged, large on small."""
    if windows == 1 or not sizes:
        return [list(range(len(sizes))), *([] for _ in range(windows - 1))]
    heap = [(-s, i, [0] * (windows - 1) + [s], [()] * (windows - 1) + [(i,)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, low, low_items = heapq.heappop(heap)
        _, _, high, high_items = heap[0]
        sums = [a + b for a, b in zip(low, reversed(high))]
        items = [(a, b) if a and b else a or b for a, b in zip(low_items, reversed(high_items))]
        places = sorted(range(windows), key=sums.__getitem__)
        least = sums[places[0]]
        sums = [sums[p] - least for p in places]
        heapq.heapreplace(heap, (-sums[-1], i, sums, [items[p] for p in places]))
    return [_leaves(x) for x in heap[0][3]]


def _leaves(pairs: tuple) -> list[int]:
    out, todo = [], [pairs]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            todo.extend(x)
        else:
            out.append(x)
    return out


def partition(items: list[tuple[int, int, int]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of items (document, start, length), none over capacity. Their number rises from the least possible one
    to 1/PADDING more (one, at least). Where that doesn't do, each window over capacity gives off its excess and is closed at
    exactly its capacity, and the rest is divided anew over the other windows; they always have room for it."""
    items = list(items)
    least = max(1, -(-sum(x[2] for x in items) // capacity))
    most = least + max(1, least // PADDING)
    # Items over half a window need a window each, so fewer windows needn't be tried.
    count = min(most, max(least, sum(2 * x[2] > capacity for x in items)))
    pieces = {doc for doc, n in Counter(x[0] for x in items).items() if n > 1}
    torn: set[int] = set()
    closed: list[list[tuple[int, int, int]]] = []
    while True:
        windows = [[items[i] for i in w] for w in differencing([x[2] for x in items], count) if w]
        sums = [sum(x[2] for x in w) for w in windows]
        if max(sums, default=0) <= capacity:
            return closed + windows
        if not closed and count < most:
            count += 1
            continue
        items = []
        for w, total in zip(windows, sums):
            if total <= capacity:
                items += w
            else:
                items += give_off(w, total - capacity, pieces, torn)
                closed.append(w)
                count -= 1


def give_off(window: list[tuple[int, int, int]], excess: int, pieces: set[int], torn: set[int]) -> list[tuple[int, int, int]]:
    """Takes excess tokens out of the window: an item of that length, or the end of a longer one; of a document in pieces
    anyway if there is one, of one that was torn before only if there is no other. Without a longer item, whole ones go."""
    out = []
    while excess:
        rank = lambda x: (x[2] != excess, x[2] < excess, x[0] not in pieces, x[0] in torn, abs(x[2] - excess), x)
        x = min(window, key=rank)
        window.remove(x)
        doc, start, length = x
        moved = min(length, excess)
        if moved < length:
            torn.add(doc)
            window.append((doc, start, length - moved))
        out.append((doc, start + length - moved, moved))
        excess -= moved
    return out


def joined(windows: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Windows with pieces that follow each other in their document made one."""
    out = []
    for w in windows:
        own: list[tuple[int, int, int]] = []
        for doc, start, length in sorted(w):
            if own and own[-1][0] == doc and own[-1][1] + own[-1][2] == start:
                own[-1] = (doc, own[-1][1], own[-1][2] + length)
            else:
                own.append((doc, start, length))
        out.append(own)
    return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, group: int = GROUP, item: int = ITEM) -> DataFrame:
    """doc_id and the pieces of every document: (start, length) in the document, its place (sequence_id, offset)."""
    ship_package(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *(x.split()[0] for x in PIECE_SCHEMA.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[object, np.ndarray]] = []  # documents of the open group
        items: list[tuple[int, int, int]] = []
        filled, doc_type = 0, None

        def placed(windows: list[list[tuple[int, int, int]]]) -> pa.RecordBatch:
            nonlocal made
            rows = []
            for w in windows:
                offset = 0
                for d, start, length in w:
                    doc_id, ids = held[d]
                    rows.append((doc_id, start, length, zlib.crc32(ids[start : start + length]), len(ids), base + made, offset))
                    offset += length
                made += 1
            return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), [doc_type, *[pa.int64()] * 6])], names=names)

        for batch in batches:
            texts, doc_ids = column(batch, "text"), column(batch, "doc_id")
            doc_type = doc_ids.type
            for a, b in text_chunks(texts):
                ids, ends = encode_like_library(tokenizer_path, texts.slice(a, b - a))
                for i, doc_id in enumerate(doc_ids.slice(a, b - a).to_pylist()):
                    own = np.append(ids[ends[i] : ends[i + 1]], np.uint32(end_id)).astype("<u4")
                    whole = len(own) // capacity * capacity if len(own) > capacity else 0
                    rest = len(own) - whole
                    # A little room in each window lets the differencing end without another window.
                    if items and filled + rest > group * (capacity - capacity // 85):
                        yield placed(joined(partition(items, capacity)))
                        held, items, filled = [], [], 0
                    held.append((doc_id, own))
                    d, filled = len(held) - 1, filled + rest
                    if whole:
                        yield placed([[(d, at, capacity)] for at in range(0, whole, capacity)])
                        items += [(d, at, min(item, len(own) - at)) for at in range(whole, len(own), item)]
                    else:
                        items.append((d, 0, rest))
        if items:
            yield placed(joined(partition(items, capacity)))

    few = docs.select("doc_id", whole_text().alias("text")).coalesce(max(1, text_bytes(docs) // TASK_BYTES))
    return few.mapInArrow(run, f"doc_id {id_type}, {PIECE_SCHEMA}")
