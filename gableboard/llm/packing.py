"""Packing of tokenised documents into windows of equal capacity by multiway differencing.

A document's ids, closed by an end id, fill as many whole windows as they can. What remains is cut into
pieces of at most a quarter window, and pieces are gathered until they would fill `windows` windows. The
Karmarkar-Karp method then divides them: each piece starts as a partition of its own into m windows, the
two partitions with the largest imbalance are merged again and again, the fullest windows of one with the
emptiest of the other, until one partition is left. Its windows are near-equal. Should one exceed the
capacity, the number of windows m rises by one and the pieces are divided anew.

Tasks pack the rows of their own partition, so nothing is shuffled; the padding of a task's last group
is the only cost. A null text is empty: its document is the end id alone. Rows that repeat are packed one
by one. An empty table gives no pieces. Ids are those of the `tokenizers` library for the same vocabulary;
the tokeniser here reads it as ranks, which is several times faster (the tests compare the two).
"""

from __future__ import annotations

import base64
import heapq
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY, END, WINDOWS = 1024, 0, 256
SPECIAL = {"<|endoftext|>": 50256}


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str):
    """Text to ids by the byte-level BPE whose ranks stand in the file at `path`."""
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in Path(path).read_bytes().splitlines() if x)}
    coding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return lambda text: coding.encode_to_numpy(text, allowed_special="all").astype("<u4")


def differencing(sizes: np.ndarray, m: int) -> np.ndarray:
    """The window, 0 to m - 1, of each piece: near-equal sums by Karmarkar-Karp multiway differencing."""
    n = len(sizes)
    owner = np.arange(n)  # of a piece: a piece in the same window, or itself
    heap = []
    for i, size in enumerate(sizes):
        sums, ids = np.zeros(m, np.int64), np.full(m, -1)
        sums[0], ids[0] = size, i
        heap.append((-int(size), i, sums, ids))
    heapq.heapify(heap)
    turn = n
    while len(heap) > 1:
        _, _, sums, ids = heapq.heappop(heap)
        _, _, more, others = heapq.heappop(heap)
        sums, others = sums + more[::-1], others[::-1]
        both = (ids >= 0) & (others >= 0)
        owner[others[both]] = ids[both]
        ids = np.where(ids >= 0, ids, others)
        order = np.argsort(-sums, kind="stable")
        sums, ids = sums[order], ids[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), turn, sums, ids))
        turn += 1
    root = owner[owner]
    while (root != owner).any():
        owner, root = root, root[root]
    _, window = np.unique(owner, return_inverse=True)
    return window


def divided(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """As `differencing`, with the least number of windows, from the sum's on, that all hold."""
    m = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, m)
        if np.bincount(window, sizes).max() <= capacity:
            return window
        m += 1


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END,
         windows: int = WINDOWS, path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and ids of every piece."""
    path = path or vocabulary_path()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())]

    def run(batches):
        encode, finish = encoder(path), np.array([end], "<u4")
        sequence = TaskContext.get().partitionId() << 40
        held, total = [], 0

        def batch_of(rows):
            columns = list(zip(*rows, strict=True)) or [()] * 8
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        def divide():
            nonlocal sequence
            window = divided(np.array([len(p[2]) for p in held]), capacity)
            filled = np.zeros(window.max() + 1, np.int64)
            rows = []
            for (doc, start, ids, tokens), w in zip(held, window, strict=True):
                rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), tokens, sequence + int(w), int(filled[w]), ids))
                filled[w] += len(ids)
            sequence += len(filled)
            return batch_of(rows)

        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([encode(text.as_py() or ""), finish])
                whole = len(ids) // capacity * capacity
                for a in range(0, whole, capacity):
                    piece = ids[a:a + capacity]
                    rows.append((doc, a, capacity, zlib.crc32(piece.tobytes()), len(ids), sequence, 0, piece))
                    sequence += 1
                for a in range(whole, len(ids), capacity // 4 or 1):
                    held.append((doc, a, ids[a:a + (capacity // 4 or 1)], len(ids)))
                total += len(ids) - whole
                if total >= windows * capacity - capacity // 2:
                    yield divide()
                    held, total = [], 0
            yield batch_of(rows)
        if held:
            yield divide()

    schema = ", ".join(f"{n} long" for n in names[:7]) + ", ids array<int>"
    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, schema)
