"""Product codes of integer vectors: Lloyd rounds in which settled parts meet only the entries that moved."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.text import bounded_batches, staged
from tidemark.operators.skew import spread_join

#: Parts of a vector, entries of a part's codebook, rounds, and integers per unit of a component.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Integers beyond this are held at it, so that distances, and sums over any table, fit a decimal of 38 digits.
WIDEST = 1 << 54


def integers(vector: Column) -> Column:
    """floor(SCALE * x) of each component, held at WIDEST."""
    return F.transform(vector, lambda v: F.greatest(F.least(F.floor(v.cast("double") * SCALE), F.lit(WIDEST)), F.lit(-WIDEST)).cast("long"))


def _kept(vectors: DataFrame) -> DataFrame:
    """The rows with finite vectors, as integers; all have the length of the first such vector by id."""
    vector = F.col("embedding")
    finite = vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(finite & (F.size(vector) > 0) & (F.size(vector) % PARTS == 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), integers(vector).alias("x")
    )
    return staged(rows, "vectors")


def exact(*arrays: np.ndarray) -> type:
    """A type in which squared distances between rows of these integers are exact: floats, 64-bit integers, Python's."""
    most = max(max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size)
    reach = 4 * max(a.shape[-1] for a in arrays) * most * most
    return np.float64 if reach < 2**53 else np.int64 if reach < 2**63 else object


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries; exact, whatever the type."""
    kind = exact(x, entries)
    x, entries = x.astype(kind), entries.astype(kind)
    return (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None]


def assigned(x: np.ndarray, book: np.ndarray, moved: np.ndarray | None, codes: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, distances) of the nearest entries, the lower index on ties.

    Rows whose entry stayed where it was hold the least (distance, index) of all entries that
    stayed, so that only the moved entries can come before it. Rows of moved entries meet all.
    """
    settled = np.zeros(len(x), bool) if moved is None else ~moved[codes]
    codes, near = codes.copy(), near.copy()
    for at in np.array_split(np.flatnonzero(~settled), len(x) // 4096 + 1):
        if len(at):
            every = distances(x[at], book)
            codes[at] = every.argmin(1)
            near[at] = every[np.arange(len(at)), codes[at]]
    changed = np.flatnonzero(moved) if moved is not None else np.zeros(0, int)
    for at in np.array_split(np.flatnonzero(settled), len(x) // 4096 + 1) if len(changed) else []:
        if len(at):
            every = distances(x[at], book[changed])
            first = every.argmin(1)
            other, least = changed[first], every[np.arange(len(at)), first]
            better = (least < near[at]) | ((least == near[at]) & (other < codes[at]))
            codes[at[better]], near[at[better]] = other[better], least[better]
    return codes, near


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy()
    return flat.reshape(batch.num_rows, -1)


def _state(wide: bool) -> str:
    return f"vec_id long, label string, x array<long>, codes array<short>, distances array<{'decimal(38,0)' if wide else 'long'}>"


def _listed(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Lists of PARTS values."""
    flat = pa.array([int(v) for v in rows.reshape(-1)] if rows.dtype == object else rows.reshape(-1), kind)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, PARTS), pa.int32()), flat)


def _assigning(books: list[np.ndarray], moved: list[np.ndarray] | None, wide: bool):
    kind, store = (object, pa.decimal128(38, 0)) if wide else (np.int64, pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, found = np.split(_vectors(batch), PARTS, axis=1), []
            old, near = (np.zeros((batch.num_rows, PARTS), k) for k in (int, kind))
            if moved:
                old, near = (batch.column(c).flatten() for c in ("codes", "distances"))
                near = np.array([int(d) for d in near.to_pylist()], object) if wide else near.to_numpy()
                old, near = old.to_numpy().astype(int).reshape(-1, PARTS), near.reshape(-1, PARTS)
            for p in range(PARTS):
                found.append(assigned(x[p], books[p], moved and moved[p], old[:, p], near[:, p]))
            codes, near = (np.stack([f[k] for f in found], 1) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "label", "x")), _listed(codes.astype(np.int16), pa.int16()), _listed(near, store)],
                names=["vec_id", "label", "x", "codes", "distances"],
            )

    return run


def _summing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, part and entry in use: the rows and the sums of their components."""
    sums: dict[tuple[int, int], list] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column("codes").flatten().to_numpy().reshape(batch.num_rows, PARTS)
        whole = _vectors(batch)
        wide = int(np.abs(whole).max()) * batch.num_rows >= 2**63
        for p, x in enumerate(np.split(whole.astype(object) if wide else whole, PARTS, axis=1)):
            order = np.argsort(codes[:, p], kind="stable")
            used, first, count = np.unique(codes[order, p], return_index=True, return_counts=True)
            for entry, n, total in zip(used, count, np.add.reduceat(x[order], first, axis=0)):
                held = sums.setdefault((p, int(entry)), [0, [0] * x.shape[1]])
                held[0] += int(n)
                held[1] = [a + int(b) for a, b in zip(held[1], total)]
    keys = list(sums)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([sums[k][0] for k in keys], pa.int64()),
            pa.array([sums[k][1] for k in keys], pa.list_(pa.decimal128(38, 0))),
        ],
        names=["part", "entry", "n", "total"],
    )


def _moved(state: DataFrame, books: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The next codebooks, floor(sum / count) of each entry's parts, and which entries are new. Unused entries stay."""
    partial = state.select("x", "codes").mapInArrow(_summing, "part int, entry int, n long, total array<decimal(38,0)>")
    one = partial.select("part", "entry", "n", F.posexplode("total").alias("at", "t"))
    whole = one.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("t").cast("decimal(38,0)").alias("t"))
    after = [b.copy() for b in books]
    for r in whole.collect():  # PARTS x ENTRIES x components of a part
        after[r.part][r.entry, r.at] = int(r.t) // r.n
    return after, [(a != b).any(1) for a, b in zip(after, books)]


def trained(vectors: DataFrame) -> tuple[DataFrame, list[np.ndarray]]:
    """Rows with the codes and distances under the last codebooks, and these (one array of entries by components a part).

    Each part's codebook begins as that part of the ENTRIES rows of smallest vec_id (null ids last,
    equal ids by vector). Every round assigns all parts and moves the entries; a row's codes and
    distances are kept from round to round in a written table. Only the codebooks and their sums pass
    through the driver: their size is PARTS x ENTRIES times the components, whatever the rows.
    """
    bounded_batches(vectors.sparkSession)
    rows = _kept(vectors)
    order = (F.col("vec_id").asc_nulls_last(), "x")
    head = rows.orderBy(*order).limit(1).select(F.size("x").alias("d")).collect()
    if not head:
        return rows.select("*", F.lit(None).cast("array<short>").alias("codes"), F.lit(None).cast("array<long>").alias("distances")), []
    rows = rows.where(F.size("x") == head[0].d)
    most = rows.agg(F.max(F.greatest(F.array_max("x"), -F.array_min("x")))).first()[0]
    wide = 4 * head[0].d * most * most >= 2**63
    seeds = np.array([r.x for r in rows.orderBy(*order).limit(ENTRIES).select("x").collect()], np.int64)
    books, moved, state = [np.ascontiguousarray(b) for b in np.split(seeds, PARTS, axis=1)], None, rows
    for _ in range(ROUNDS):
        state = staged(state.mapInArrow(_assigning(books, moved, wide), _state(wide)), "codes")
        books, moved = _moved(state, books)
    return state.mapInArrow(_assigning(books, moved, wide), _state(wide)), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimals, by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.reshape(-1).tolist()).encode()).hexdigest()


def compressed(vectors: DataFrame) -> DataFrame:
    """One row per vector: vec_id, code, error, label_error, codebooks_sha256.

    Components become floor(1024 * x). ``code`` holds the indexes of the nearest entries in part
    order, two hex digits each; ``error`` the squared distances to them, ``label_error`` its sum over
    the rows of equal labels (nulls together). Integers are exact up to 2^54, where larger ones are held; an
    error beyond the largest long is held at that. Rows with a null vector, or one with null or non-finite components, drop
    out, and so do vectors without components, of a length that four does not divide, or of another length
    than the first vector by id. Equal rows are rows of their own. With fewer than 256 vectors a
    codebook has as many entries as there are vectors. Extra columns are ignored; an empty table
    gives no rows.
    """
    state, books = trained(vectors)
    held = lambda c: F.least(c, F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    total = F.aggregate("distances", F.lit(0).cast("decimal(38,0)"), lambda a, d: (a + d).cast("decimal(38,0)"))
    rows = staged(state.select("vec_id", "label", "codes", held(total).alias("error")), "coded")
    sums = rows.groupBy("label").agg(held(F.sum(F.col("error").cast("decimal(38,0)")).cast("decimal(38,0)")).alias("label_error"))
    name = lambda df: df.withColumn("label", F.struct(F.col("label").isNull().alias("none"), F.coalesce("label", F.lit("")).alias("label")))
    joined = spread_join(name(rows), name(sums), "label")
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0"))), "")
    return joined.select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
