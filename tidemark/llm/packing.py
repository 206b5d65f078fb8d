"""Token ids packed into rows of fixed width by best-fit decreasing."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import bounded_batches, pieces

#: Ids per row, and texts (in bytes) that are packed together.
WIDTH, BLOCK_BYTES = 2048, 8 << 20

# fixed value: how the byte-level vocabulary cuts texts into words
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

ROWS = "block long, row int, doc_ids array<long>, parts array<int>, cu_seqlens array<int>, n_ids int, ids binary, position_ids binary"


class Capacities:
    """Open rows by the room they have left, under a segment tree that finds the least room that is enough."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """A row with the least room of at least ``least``, taken out; with that room."""
        at = least + self.leaves
        while not self.count[at]:  # up to the first subtree to the right that has rows
            while at & 1:
                at >>= 1
                if at <= 1:
                    return None
            at += 1
            if at == 1:
                return None
        while at < self.leaves:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        row = self.rows[room].pop()
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, row


def packed(lengths: list[int], width: int) -> list[list[tuple[int, int, int]]]:
    """Rows of segments (text, start, stop) with at most ``width`` ids.

    Longer texts are cut into whole rows and a rest; the rests and the shorter texts follow, longest
    first, each into the row with the least room that is enough, or a new one. Empty texts have no
    segment.
    """
    rows = [[(k, at, at + width)] for k, n in enumerate(lengths) for at in range(0, n - width + 1, width)]
    rests = [(n % width, k, n - n % width) for k, n in enumerate(lengths) if n % width]
    open_rows = Capacities(width)
    for n, k, start in sorted(rests, key=lambda r: (-r[0], r[1])):
        found = open_rows.take(n)
        if found is None:
            rows.append([])
            found = width, len(rows) - 1
        room, row = found
        rows[row].append((k, start, start + n))
        if room > n:
            open_rows.add(room - n, row)
    return rows


def _encoder(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def packed_rows(docs: DataFrame, vocabulary: str, width: int = WIDTH, pad: int | None = None) -> DataFrame:
    """Packed rows: doc_ids and parts of the segments, cu_seqlens (0 and the end of each), ids and position_ids.

    ids is a row of ``width`` little-endian unsigned integers, filled up with ``pad`` (the first
    free id by default); position_ids has as many, starting anew at 0 with each segment and with
    the filling. They have 16 bits if the vocabulary allows, else 32; positions always have 32.
    A document's parts, one after another, are its ids: no id is lost or repeated. Texts are packed
    in blocks of some BLOCK_BYTES within a task, so that nothing is shuffled; ``block`` numbers them
    within the run and ``row`` the rows within a block. So the rows depend on how the texts lie in
    partitions, the ids of each document don't; a task's last block may be small. BLOCK_BYTES counts
    characters here. Segments of equal length are placed in the order of their texts; of rows of equal
    room the one filled last is taken. The vocabulary's path is read on the driver.

    Null and empty texts have no segments; null ids stay null in doc_ids; rows that repeat an id are
    packed each; extra columns are ignored; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    ranks = ranks_of(vocabulary)
    fill = len(ranks) if pad is None else pad
    kind = np.dtype("<u2") if max(len(ranks), fill) < 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, block = _encoder(ranks).encode_to_numpy, TaskContext.get().partitionId() << 32
        names, coded, size = [], [], 0

        def flush():
            rows = packed([len(c) for c in coded], width)
            ids = np.full((len(rows), width), fill, kind)
            places = np.zeros((len(rows), width), np.dtype("<u4"))
            ends = []
            for k, row in enumerate(rows):
                upto = np.cumsum([0, *(b - a for _, a, b in row)])
                for (text, a, b), at in zip(row, upto):
                    ids[k, at : at + b - a] = coded[text][a:b]
                for a, b in pairwise([*upto, width]):
                    places[k, a:b] = np.arange(b - a)
                ends.append(upto.tolist())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(rows), pa.int64()), pa.array(range(len(rows)), pa.int32()),
                    pa.array([[names[t] for t, _, _ in r] for r in rows], pa.list_(pa.int64())),
                    pa.array([[a // width for _, a, _ in r] for r in rows], pa.list_(pa.int32())),
                    pa.array(ends, pa.list_(pa.int32())), pa.array([e[-1] for e in ends], pa.int32()),
                    pa.array([i.tobytes() for i in ids], pa.binary()), pa.array([p.tobytes() for p in places], pa.binary()),
                ],
                names=["block", "row", "doc_ids", "parts", "cu_seqlens", "n_ids", "ids", "position_ids"],
            )

        for batch in pieces(batches, "text", 1 << 20):
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if text:
                    names.append(name)
                    coded.append(encode(text, disallowed_special=()).astype(kind))
                    size += len(text)
            if size >= BLOCK_BYTES:
                yield flush()
                names, coded, size, block = [], [], 0, block + 1
        if names:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ROWS)


def write_packed(docs: DataFrame, vocabulary: str, path: str, width: int = WIDTH) -> None:
    """The packed rows as Parquet, one row of the id matrix each."""
    packed_rows(docs, vocabulary, width).write.mode("overwrite").parquet(path)
