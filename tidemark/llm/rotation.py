"""Near-duplicate vectors from binary codes under random rotations, with estimates, bounds and exact recomputation."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.graph import components
from tidemark.llm.text import bounded_batches, staged

#: Bits of a code at least, and coordinates of a rotated vector at least. Two rotations at least make a code.
CODE_BITS, LEAST_SIDE = 256, 64
#: Vectors that a bucket holds on average at most, buckets that count as crowded, and rows of a block of those.
MEAN, FEW, BLOCK = 16, 64, 512
#: A pair at the limit shares no bucket with this probability at most.
MISS = 1e-6
#: Pairs go on to the exact test unless their estimate is so many deviations below the limit.
DEVIATIONS = 6.0
#: Bits of the largest part of a bucket's name.
WIDEST_PART = 7

# The chance that vectors of cosine 0.9 agree in the sign and place of the largest of
# 2^(w-1) Gaussian projections, for w = 1 to 7. It doesn't depend on the vectors' length.
AGREE = (0.8563, 0.7325, 0.660, 0.600, 0.547, 0.502, 0.464)

CODED = "node long, keys array<long>, bits binary, factors binary"


def side_of(d: int) -> int:
    """Coordinates that vectors of d components are padded to: a power of two."""
    return max(LEAST_SIDE, 1 << (d - 1).bit_length())


def rotations_of(side: int) -> int:
    return max(2, CODE_BITS // side)


def _signs(k: int, turn: int, side: int) -> np.ndarray:
    return np.random.default_rng([17, k, turn, side]).choice(np.array([-1.0, 1.0], np.float32), side)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The orthogonal Hadamard transform of each row; its own inverse."""
    n, side = x.shape
    step = 1
    while step < side:
        x = x.reshape(n, -1, 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2)
        step *= 2
    return x.reshape(n, side) / np.float32(math.sqrt(side))


def rotated(x: np.ndarray, k: int, back: bool = False) -> np.ndarray:
    """Rows under the k-th random rotation, or back from it: three random sign changes, each followed by the transform."""
    for turn in (2, 1, 0) if back else (0, 1, 2):
        x = _mixed(x) * _signs(k, turn, x.shape[1]) if back else _mixed(x * _signs(k, turn, x.shape[1]))
    return x


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length one, at any scale of the components."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])
    return x / np.sqrt((x * x).sum(1))[:, None]


def coded(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits, factors): the signs of each row under each rotation, packed, and the cosine between the row and its signs.

    Dividing by the factor makes the code an unbiased stand-in for the row.
    """
    side = side_of(unit.shape[1])
    padded = np.zeros((len(unit), side), np.float32)
    padded[:, : unit.shape[1]] = unit
    bits, factors = [], []
    for k in range(rotations_of(side)):
        turned = rotated(padded, k)
        bits.append(turned >= 0)
        factors.append(np.abs(turned).sum(1) / math.sqrt(side))
    return np.packbits(np.concatenate(bits, 1), 1), np.stack(factors, 1).astype(np.float32)


class Codes:
    """Codes of rows, unpacked: estimates of cosines between them, and what the estimates may be off by."""

    def __init__(self, bits: np.ndarray, factors: np.ndarray):
        count = factors.shape[1]
        side = bits.shape[1] * 8 // count
        signs = np.unpackbits(bits, axis=1).astype(np.float32).reshape(len(bits), count, side) * 2 - 1
        signs /= np.float32(math.sqrt(side)) * factors[:, :, None]
        self.pairs, self.side, self.count = count * (count - 1), side, count
        self.turned = signs.reshape(len(bits), -1)
        self.whole = sum(rotated(signs[:, k], k, back=True) for k in range(count))
        self.loss = (1 / factors**2 - 1).mean(1)

    def estimates(self, a: slice, b: slice) -> np.ndarray:
        """Cosines of the rows a with the rows b: the mean over all pairs of different rotations, whose errors are independent."""
        return (self.whole[a] @ self.whole[b].T - self.turned[a] @ self.turned[b].T) / self.pairs

    def deviation(self, a: slice, b: slice, cosine: float) -> np.ndarray:
        """At least the standard deviation of the estimates of pairs of this cosine or a larger one."""
        x, y = self.loss[a][:, None], self.loss[b][None]
        one = (1 - cosine**2) * (x + y + 2 * np.sqrt(x * y)) / ((self.side - 1) * self.count)
        return np.sqrt(one + 2 * x * y / ((self.side - 1) * self.pairs))

    def possible(self, a: slice, b: slice, cosine: float) -> np.ndarray:
        """Pairs that the confidence bound doesn't rule out."""
        return self.estimates(a, b) >= cosine - DEVIATIONS * self.deviation(a, b, cosine)


def plan(classes: int) -> tuple[list[int], int]:
    """(parts of a bucket's name in bits, tables) for so many vectors: MEAN a bucket, MISS at cosine 0.9."""
    bits = max(1, math.ceil(math.log2(max(2, classes / MEAN))))
    parts = [WIDEST_PART] * (bits // WIDEST_PART) + [bits % WIDEST_PART] * (bits % WIDEST_PART > 0)
    agree = math.prod(AGREE[w - 1] for w in parts)
    return parts, math.ceil(math.log(MISS) / math.log1p(-agree))


def bucket_names(unit: np.ndarray, parts: list[int], tables: int) -> np.ndarray:
    """The name of each row's bucket in every table; it begins with the vector's length and the table."""
    out, d = np.empty((len(unit), tables), np.int64), unit.shape[1]
    for t in range(tables):
        name = np.full(len(unit), d * tables + t, np.int64)
        for k, w in enumerate(parts):
            rng = np.random.default_rng([29, d, t, k])
            seen = unit @ rng.standard_normal((d, 1 << (w - 1)))
            place = np.abs(seen).argmax(1)
            name = (name << w) | (place << 1) | (seen[np.arange(len(unit)), place] > 0)
        out[:, t] = name
    return out


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _coding(parts: list[int], tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _lists(batch.column("x"))
            lengths = np.array(list(map(len, rows)), int)
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                unit = units(np.stack([rows[k] for k in at]))
                bits, factors = coded(unit)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node").take(pa.array(at)), pa.array(list(bucket_names(unit, parts, tables)), pa.list_(pa.int64())),
                        pa.array([r.tobytes() for r in bits], pa.binary()), pa.array([r.tobytes() for r in factors], pa.binary()),
                    ],
                    names=["node", "keys", "bits", "factors"],
                )

    return run


def _whole_groups(batches: Iterator[pa.RecordBatch], names: list[str], least: int = 20_000) -> Iterator[pa.Table]:
    """Tables of so many rows and more that end between groups of equal ``names``; the rows come sorted by them."""
    held, rows = [], 0
    for batch in batches:
        held, rows = [*held, batch], rows + batch.num_rows
        if rows < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cut = int(np.argmax(np.all([x == x[-1] for x in (table.column(c).to_numpy() for c in names)], axis=0)))
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
        held, rows = rest.to_batches(), rest.num_rows
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _groups(table: pa.Table, names: list[str]) -> Iterator[slice]:
    """The rows of each group of equal ``names``."""
    changes = np.any([x[1:] != x[:-1] for x in (table.column(c).to_numpy() for c in names)], axis=0)
    ends = [0, *(np.flatnonzero(changes) + 1), table.num_rows]
    return (slice(a, b) for a, b in zip(ends[:-1], ends[1:]))


def _codes(table: pa.Table, rows: slice) -> Codes:
    part = table.slice(rows.start, rows.stop - rows.start)
    packed = lambda c, kind: np.frombuffer(b"".join(part.column(c).to_pylist()), kind).reshape(part.num_rows, -1)
    return Codes(packed("bits", np.uint8), packed("factors", np.float32))


def _likely(cosine: float):
    """Pairs of each bucket that their codes don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, ["key"]):
            node, widths = table.column("node").to_numpy(), np.array([len(x) for x in table.column("bits").to_pylist()])
            groups = [g for g in _groups(table, ["key"]) if g.stop - g.start > 1]
            for width in np.unique(widths):
                mine = [g for g in groups if widths[g.start] == width]
                at = np.concatenate([np.arange(g.start, g.stop) for g in mine]) if mine else np.zeros(0, int)
                if not len(at):
                    continue
                codes, begin, found = _codes(table.take(pa.array(at)), slice(0, len(at))), 0, []
                for g in mine:
                    rows = slice(begin, begin + g.stop - g.start)
                    i, j = np.nonzero(np.triu(codes.possible(rows, rows, cosine), 1))
                    found.append((node[g.start + i], node[g.start + j]))
                    begin = rows.stop
                a, b = (np.concatenate([f[k] for f in found]) for k in (0, 1))
                both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    return run


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of rows with rows, in double precision."""
    x, y = (np.ldexp(v, -np.frexp(np.abs(v).max(1))[1][:, None]) for v in (x, y))
    return (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))


def _linked(cosine: float):
    """Pairs that reach the limit and don't share a crowded bucket, where they are counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            xs, ys = (_lists(batch.column(c)) for c in ("xa", "xb"))
            keep = np.array([cosines(x[None], y[None])[0] >= cosine if len(x) == len(y) else False for x, y in zip(xs, ys)], bool)
            crowds = ((set(a or ()), b or ()) for a, b in zip(batch.column("ka").to_pylist(), batch.column("kb").to_pylist()))
            alone = np.array([a.isdisjoint(b) for a, b in crowds], bool)
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(keep & alone))

    return run


def _smallest_reached(link: np.ndarray) -> np.ndarray:
    """The smallest row that each row of a symmetric matrix of links reaches."""
    root, at = np.arange(len(link)), np.arange(len(link))
    while True:
        least = np.minimum(root, np.where(link, root[None], len(link)).min(1, initial=len(link)))
        least = np.minimum(least, least[least])
        if (least == root).all():
            return root[at]
        root = least


def _crowded(cosine: float):
    """Of a tile of a crowded bucket: how many copies each vector is linked with, and the smallest vector that it reaches.

    A pair counts in the first crowded bucket that both vectors lie in. Off the diagonal the rows
    of the lower block meet those of the higher one.
    """
    names = ["key", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, names, 2 * BLOCK):
            for g in _groups(table, names):
                tile = table.slice(g.start, g.stop - g.start).combine_chunks()
                n, node, copies = tile.num_rows, tile.column("node").to_numpy(), tile.column("copies").to_numpy()
                key, low, high = (tile.column(c)[0].as_py() for c in names)
                own, x = tile.column("own").to_numpy(), np.stack(_lists(tile.column("x").combine_chunks()))
                crowds = tile.column("crowds").to_pylist()
                every = slice(0, n)
                open_ = np.triu(_codes(tile, every).possible(every, every, cosine), 1)
                if low != high:
                    open_ &= own[:, None] != own[None]
                i, j = np.nonzero(open_)
                sure = np.concatenate([cosines(x[i[k : k + 20_000]], x[j[k : k + 20_000]]) >= cosine for k in range(0, len(i), 20_000)] or [np.zeros(0, bool)])
                i, j = i[sure], j[sure]
                link = np.zeros((n, n), bool)
                link[i, j] = link[j, i] = True
                names_of = {c: k for k, c in enumerate(sorted({c for row in crowds for c in row if c < key}))}
                earlier = np.zeros((n, len(names_of)), np.float32)
                for k, row in enumerate(crowds):
                    earlier[k, [names_of[c] for c in row if c < key]] = 1
                first = link & (earlier @ earlier.T < 0.5)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array((first @ copies.astype(np.float64)).astype(np.int64)), pa.array(node[_smallest_reached(link)])], names=["node", "links", "root"]
                )

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors of this cosine and more), component_id (smallest vec_id reachable), kept.

    1. Equal vectors form one class with its number of copies; classes are numbered in a written table.
    2. A class has a bucket in each table, by the largest of Gaussian projections, and a binary code:
       the signs under several random rotations, with the factor that makes them unbiased.
    3. In a bucket of up to FEW classes, the codes alone estimate all cosines. Pairs whose
       confidence bound reaches the limit are recomputed from the vectors.
    4. A crowded bucket is dealt out as pairs of blocks, which hold vectors. The codes decide there
       as well; links are counted and contracted inside the tile, so that only one row per vector and
       tile leaves it. A pair that shares several crowded buckets counts in the first one.

    A pair at the limit is missed with probability MISS by the buckets (whose number follows the
    number of classes) and by some 1e-9 by the bounds; what is linked is exact. MISS holds for a
    limit of 0.9 and more.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do
    vectors of different lengths. Equal rows are links of each other. Null ids never name a
    component; a component of null ids only has a null one, and its rows are kept. Extra columns
    are ignored; an empty table gives no rows.
    """
    if cosine < 0.9:
        raise ValueError("the tables are laid out for limits of 0.9 and more")
    bounded_batches(vectors.sparkSession)
    x = F.col("embedding").cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable, x).alias("x"))
    grouped = rows.where("x IS NOT NULL").groupBy("x").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = staged(grouped.select(F.monotonically_increasing_id().alias("node"), "x", "least", "copies"), "vectors")
    parts, tables = plan(classes.count())
    codes = staged(classes.select("node", "x").mapInArrow(_coding(parts, tables), CODED), "codes")

    sizes = codes.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > FEW)
    crowded = staged(sizes, "crowded")
    spread = codes.select("node", "bits", "factors", F.explode("keys").alias("key"))
    small = spread.join(crowded, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    likely = staged(small.mapInArrow(_likely(cosine), "a long, b long").distinct(), "likely")

    held = staged(codes.select("node", F.explode("keys").alias("key")).join(crowded, "key"), "held")
    crowds = staged(held.groupBy("node").agg(F.collect_list("key").alias("crowds")), "crowds")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    tiles = (
        held.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node")
        .join(classes.select("node", "x", "copies"), "node").join(codes.select("node", "bits", "factors"), "node").join(crowds, "node")
        .repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    )
    dense = staged(tiles.mapInArrow(_crowded(cosine), "node long, links long, root long"), "dense")

    side = lambda s: classes.join(crowds, "node", "left").select(F.col("node").alias(s), F.col("x").alias(f"x{s}"), F.col("copies").alias(f"n{s}"), F.col("crowds").alias(f"k{s}"))
    links = staged(likely.join(side("a"), "a").join(side("b"), "b").mapInArrow(_linked(cosine), "a long, b long, na long, nb long"), "links")

    ends = links.select(F.col("a").alias("node"), F.col("nb").alias("links")).unionAll(links.select("b", "na")).unionAll(dense.select("node", "links"))
    counted = ends.groupBy("node").agg(F.sum("links").alias("links"))
    whole = components(links.select("a", "b").unionAll(dense.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    named = staged(classes.drop("x").join(counted, "node", "left").join(whole, "node", "left").withColumn("root", F.coalesce("root", "node")), "named")
    names = named.groupBy("root").agg(F.min("least").alias("name"))
    known = named.join(names, "root").select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "name")
    found = classes.select("node", "x").join(known, "node").select(F.col("x").alias("same"), "n_links", "name")
    return (
        rows.join(found, F.col("x") == F.col("same"), "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("same").isNotNull(), F.col("name")).otherwise(F.col("vec_id")).alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
