"""Near-duplicate classes from SetSketch registers: bands, joint likelihood, then full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.graph import components
from tidemark.llm.text import WordHashes, bounded_batches, chained, mixed, pieces, raw, staged

#: Registers: BANDS bands of ROWS. At similarity 0.85 a pair shares no band with probability 4e-7,
#: at 0.8 with 5e-5.
BANDS, ROWS = 25, 5
#: Sketch parameters: the base of the exponential spacing, the rate, and the last register value.
BASE, RATE, LAST = 1.001, 20.0, 65535
#: Pairs go on to the exact test unless their estimate is this many deviations below the limit.
DEVIATIONS = 5.0
#: Buckets of so many classes are small, and shingles that so many classes of a group have are rare.
FEW = 32

SKETCH = "doc_id long, mark long, n int, set_id binary, registers binary, bands array<long>"


def shingles(text: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text with words is one shingle as a whole."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = hashes.of(words)
    if len(words) < size:
        return mixed(chained(codes, len(words))[:1] + np.uint64(len(words)))
    return np.unique(chained(codes, size)[: len(words) - size + 1])


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers of non-empty sets of hashes, one row each.

    Each element has an exponential value per register; the smallest one is what counts, truncated
    to the exponents of BASE. Hashes order the elements as their values do, so that only the
    minima are turned into values. Registers of a union are the larger ones of both.
    """
    every, n = np.concatenate(sets), BANDS * ROWS
    starts = np.cumsum([0, *map(len, sets[:-1])])
    keys = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    out = np.empty((len(sets), n), np.uint16)
    work = np.empty_like(every)
    for k in range(n):
        np.bitwise_xor(every, keys[2 * k], out=work)
        np.multiply(work, keys[2 * k + 1], out=work)
        least = (np.minimum.reduceat(work, starts).astype(np.float64) + 0.5) / 2.0**64
        value = -np.log1p(-np.minimum(least, 1 - 2.0**-53)) / RATE
        out[:, k] = np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, LAST)
    return out


def band_keys(found: np.ndarray) -> np.ndarray:
    """A 64-bit key per band of registers, different between bands."""
    parts = found.reshape(len(found), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for k in range(ROWS):
        key = mixed(key + parts[:, :, k] * np.uint64(0x9E3779B97F4A7C15))
    return key.astype(np.int64)


def similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from two rows of registers and the two set sizes.

    The likelihood counts the registers that are larger in either sketch and those that are equal;
    it is concave in the similarity, and a golden-section search finds its maximum.
    """
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u, v = na / (na + nb), nb / (na + nb)
    share = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        p, q = share(np.maximum(u - v * j, 0)), share(np.maximum(v - u * j, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            terms = [np.where(k > 0, k * np.log(np.maximum(x, 1e-300)), 0) for k, x in ((more, p), (less, q), (same, 1 - p - q))]
        return sum(terms)

    low, high, cut = np.zeros(len(a)), np.minimum(u / v, v / u), (5**0.5 - 1) / 2
    for _ in range(30):
        x, y = high - cut * (high - low), low + cut * (high - low)
        left = likelihood(x) >= likelihood(y)
        low, high = np.where(left, low, x), np.where(left, y, high)
    return (low + high) / 2


def _sketched(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces(batches, "text", 2 << 20):
            sets = [shingles(t, size, hashes) for t in raw(batch, "text")]
            filled = [k for k, s in enumerate(sets) if len(s)]
            held, keys = [None] * len(sets), [None] * len(sets)
            if filled:
                found = registers([sets[k] for k in filled])
                for k, row, bands in zip(filled, found, band_keys(found)):
                    held[k], keys[k] = row.tobytes(), bands
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("mark"), pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array(held, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "mark", "n", "set_id", "registers", "bands"],
            )

    return run


def _likely(limit: float):
    """Pairs whose estimate doesn't rule out the limit."""
    lowest = limit - DEVIATIONS * (limit * (1 - limit) / (BANDS * ROWS)) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("ra", "rb"))
            na, nb = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            keep = pa.array(similarity(a, b, na, nb) >= lowest)
            yield batch.select(["a", "b"]).filter(keep)

    return run


def _linked(size: int, percent: int):
    """Pairs whose full sets reach the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, kept = WordHashes(), None, None
        for batch in pieces(batches, "ta", 4 << 20):
            keep = []
            for node, x, y in zip(batch.column("a").to_pylist(), raw(batch, "ta"), raw(batch, "tb")):
                if node != last:
                    last, kept = node, shingles(x, size, hashes)
                other = shingles(y, size, hashes)
                both = len(np.intersect1d(kept, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(kept) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _compared(size: int):
    """Pairs with the sizes of both sets and of what they share, and the shingles that only b has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, kept = WordHashes(), None, None
        for batch in pieces(batches, "ta", 4 << 20):
            both, outside = [], []
            for node, x, y in zip(batch.column("a").to_pylist(), raw(batch, "ta"), raw(batch, "tb")):
                if node != last:
                    last, kept = node, shingles(x, size, hashes)
                other = shingles(y, size, hashes)
                alone = np.setdiff1d(other, kept, assume_unique=True)
                both.append(len(other) - len(alone))
                outside.append(alone.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("group", "a", "b", "na", "nb")] + [pa.array(both, pa.int32()), pa.array(outside, pa.list_(pa.int64()))],
                names=["group", "a", "b", "na", "nb", "both", "outside"],
            )

    return run


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that the registers and then the full sets confirm, written."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("registers").alias(f"r{x}"))
    likely = staged(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_likely(percent / 100), "a long, b long"), "likely")
    text = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"t{x}"))
    return staged(likely.join(text("b"), "b").join(text("a"), "a").mapInArrow(_linked(size, percent), "a long, b long"), "linked")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept (it is that one).

    Words are split at ASCII white space, A-Z lower-cased; a document's set holds its distinct
    shingles of ``size`` words, or all words as one if there are fewer. Documents are linked if
    ``percent`` of the union of their sets is shared.

    1. Equal sets form one class; the classes are numbered in a written table.
    2. Classes that agree in a band of registers share a bucket. In a small bucket one class is
       compared with all others, a star, and what lies in different components after that is
       compared pair by pair, FEW partners each at most.
    3. Large buckets that share classes form a group, with the class that lies in most of them as
       its centre; the others are compared with the centre, which also tells what each has besides
       it. What two classes of different components share is at most what both share with the
       centre, the rare shingles outside it that a join finds them to share (FEW classes each at
       most), and the smaller number of other shingles outside it: they are compared if that is
       enough for the limit. So each pair of a bucket is
       joined, ruled out exactly or compared, and the copies of one text cost a few pairs each.
    4. Pairs of small buckets are estimated from the registers before their full sets are compared.

    Null and word-free texts have an empty set and are linked with nothing. Null ids never name a
    component; a component of null ids only has a null one, and its rows are kept. Rows that
    repeat an id are rows of one document. Extra columns are ignored; an empty table gives no rows.
    """
    return _marked(docs, size, percent).drop("mark")


def _marked(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """near_duplicates() with the hash of each row's text, as ``mark``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    sketches = staged(docs.mapInArrow(_sketched(size), SKETCH), "sketches")
    classes = staged(
        sketches.where("n > 0").groupBy("set_id")
        .agg(F.min("doc_id").alias("least"), F.any_value(F.struct("n", "registers", "bands")).alias("s"))
        .select(F.monotonically_increasing_id().alias("node"), "set_id", "least", "s.*"),
        "classes",
    )
    banded = classes.select("node", "n", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = staged(banded.join(shared, "band"), "buckets")
    texts = _texts(docs, sketches, classes.join(buckets.select("node").distinct(), "node", "left_semi"))
    small, large = buckets.where(F.col("size") <= FEW), buckets.where(F.col("size") > FEW)
    text = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"t{x}"))

    heads = small.groupBy("band").agg(F.min("node").alias("a"))
    stars = staged(small.join(heads, "band").where("a <> node").select("a", F.col("node").alias("b")).distinct(), "stars")
    first = _confirmed(stars, classes, texts, size, percent)

    pull = staged(large.groupBy("node").agg(F.sum("size").alias("pull"), F.first("n").alias("n")), "pull")
    top = F.min(F.struct((-F.col("pull")).alias("p"), F.col("node").alias("c"), F.col("n").alias("na"))).alias("t")
    heads = large.select("band", "node").join(pull, "node").groupBy("band").agg(top).select("band", F.col("t.c").alias("head"))
    touching = staged(large.select("band", "node").join(heads, "band").select("node", "head").distinct(), "touching")
    merged = components(touching.join(touching.groupBy("node").agg(F.min("head").alias("b")), "node").select(F.col("head").alias("a"), "b"))
    merged = merged.select(F.col("node").alias("head"), "root")
    grouped = staged(touching.join(merged, "head", "left").select("node", F.coalesce("root", "head").alias("group")).distinct(), "grouped")
    centre = staged(grouped.join(pull, "node").groupBy("group").agg(top).select("group", F.col("t.c").alias("a"), "t.na"), "centres")
    others = grouped.join(pull, "node").join(centre, "group").where("a <> node").select("group", "a", F.col("node").alias("b"), "na", F.col("n").alias("nb"))
    compared = others.join(text("b"), "b").join(text("a"), "a").mapInArrow(_compared(size), "group long, a long, b long, na int, nb int, both int, outside array<long>")
    compared = staged(compared, "compared")
    close = compared.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")
    roots = staged(components(first.unionAll(close)), "roots")
    root = lambda df, node, name: df.join(roots.select(F.col("node").alias(node), F.col("root").alias(name)), node, "left").withColumn(name, F.coalesce(name, node))

    apart = root(small.select("band", "node"), "node", "root").join(root(small.groupBy("band").agg(F.min("node").alias("a")), "a", "root_c").drop("a"), "band")
    apart = staged(apart, "apart")
    side = lambda df, x: df.select(*(F.col(c).alias(c + x if c not in ("band", "group", "shingle") else c) for c in df.columns))
    ends = lambda df: df.select(F.least("nodea", "nodeb").alias("a"), F.greatest("nodea", "nodeb").alias("b"))
    near = ends(side(apart.where("root <> root_c"), "a").join(side(apart.drop("root_c"), "b"), "band").where("roota <> rootb"))

    postings = staged(compared.select("group", F.col("b").alias("node"), F.explode("outside").alias("shingle")), "postings")
    scarce = postings.groupBy("group", "shingle").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") <= FEW)
    rare = staged(postings.join(scarce, ["group", "shingle"]), "rare")
    counted = rare.groupBy("node").agg(F.count(F.lit(1)).alias("u"))
    free = compared.join(counted, compared.b == counted.node, "left").select(
        "group", F.col("b").alias("node"), F.col("nb").alias("n"), "both", (F.size("outside") - F.coalesce("u", F.lit(0))).alias("free")
    )
    inside = root(centre, "a", "root_c").select("group", "root_c")
    held = staged(root(free.unionAll(centre.select("group", "a", "na", "na", F.lit(0))), "node", "root").join(inside, "group"), "held")
    limit = lambda n, m, shared: 100 * shared >= percent * (n + m - shared)
    best = held.groupBy("group").agg(F.min("n").alias("n0"), F.max("both").alias("both0"), F.max("free").alias("free0"))
    hopeful = limit(F.col("n"), F.col("n0"), F.least("n", F.least("both", "both0") + F.least("free", "free0")))
    hoping = held.join(best, "group").where(hopeful).select(held.columns)
    apart_of = (F.least("botha", "bothb") + F.least("freea", "freeb"), F.col("roota") != F.col("rootb"))
    met = side(hoping.where("root <> root_c"), "a").join(side(hoping.drop("root_c"), "b"), "group")
    within = ends(met.where(apart_of[1] & limit(F.col("na"), F.col("nb"), apart_of[0])))
    shared = rare.where("c > 1").select("group", "node", "shingle").join(held, ["group", "node"])
    met = side(shared.where("root <> root_c"), "a").join(side(shared.drop("root_c"), "b"), ["group", "shingle"]).where(apart_of[1])
    firsts = [F.first(c).alias(c) for c in ("na", "nb", "botha", "bothb", "freea", "freeb")]
    common = met.groupBy("group", "nodea", "nodeb").agg(F.count(F.lit(1)).alias("rare"), *firsts)
    across = ends(common.where(limit(F.col("na"), F.col("nb"), apart_of[0] + F.col("rare"))))

    left = near.unionAll(within).unionAll(across).distinct()
    tested = stars.unionAll(compared.select("a", "b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second = _confirmed(left.join(tested, ["a", "b"], "left_anti"), classes, texts, size, percent)
    whole = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(second))

    named = classes.join(whole, "node", "left").select("set_id", "least", F.coalesce("root", "node").alias("root"))
    named = staged(named, "named")
    names = named.groupBy("root").agg(F.min("least").alias("name"))
    named = named.join(names, "root").select("set_id", "name")
    return (
        sketches.select("doc_id", "mark", "n", F.when(F.col("n") > 0, F.col("set_id")).alias("set_id")).join(named, "set_id", "left")
        .select("doc_id", "mark", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _texts(docs: DataFrame, sketches: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) with a text of each wanted class, written. Rows are found by id and a hash of the text."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("h")
    holders = sketches.join(wanted.select("set_id", "node"), "set_id").groupBy("node").agg(first).select("node", F.col("h.doc_id").alias("id"), "h.mark")
    found = docs.join(holders, (docs.mark == holders.mark) & docs.doc_id.eqNullSafe(F.col("id")))
    return staged(found.select("node", "text").dropDuplicates(["node"]), "texts")


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents that are the smallest id of their component; columns as they were. Rows of one id are told apart by text."""
    gone = _marked(docs, size, percent).where("NOT kept AND doc_id IS NOT NULL").select("doc_id", "mark").distinct()
    same = (F.col("d.doc_id").cast("long") == F.col("g.doc_id")) & (F.xxhash64(F.col("d.text")) == F.col("g.mark"))
    return docs.alias("d").join(gone.alias("g"), same, "left_anti")
