"""Shapley attributions of a forest, tree by tree, over partitions of the scored rows.

A leaf whose path tests d features plays a product game: feature j lets a row through (1) or
not (0) when it is known, and lets through the share z_j of the training rows when it is not.
With weights s!(d-1-s)!/d! = ∫ t^s (1-t)^(d-1-s) dt, the attribution of feature i is

    leaf value * (o_i - z_i) * ∫ prod_{j != i} (z_j (1-t) + o_j t) dt,

a polynomial of degree d-1 that Gauss-Legendre nodes integrate exactly. A leaf has at most 2^d different
games, so that rows only carry the number of their game down the tree and look up its attributions.

A feature that has failed a row on the path can't change its games any more, and of the others a subtree only asks
between which of its thresholds they lie. Rows that agree in that are one below: the deeper, the fewer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.moments import safe_corr
from tidemark.functions.parse import rows_of
from tidemark.operators import forest as trees_of
from tidemark.operators.forest import Forest, _lots, _matrix, _opened, _spread, _table, held_points, on_rows, points_of, summed
from tidemark.session import written

TOP_FEATURES = 5
#: Points of a slot, which share the walk through a part; nodes of a lot of parts at most; what a walk needs of a node.
SLOT, NODES = 250_000, 1_000_000
NEEDED = ("left", "right", "feature", "threshold", "value", "cover")
#: Rows are made one where the leaves below have become so many times fewer, as long as there are FEW of them or more.
FEWER, FEW = 8, 32


def _games(number: np.ndarray, features: list[int], shares: list[float], value: float, width: int, t: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Attributions by a leaf in the games of these numbers, whose bits say which of its features let the row through."""
    known, share = (number[:, None] >> np.arange(len(features))) & 1, np.array(shares)
    factor = share[:, None] * (1 - t) + known[:, :, None] * t
    rest = factor.prod(1)[:, None] / factor
    phi = np.zeros((len(number), width))
    phi[:, features] = value * (known - share) * (rest @ w)
    return phi


def _ahead(left: list[int], right: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes in the order of a walk, each node's place there, and how many nodes its subtree has); children have higher numbers."""
    n = len(left)
    size, place = [1] * n, [0] * n
    for k in range(n - 1, -1, -1):
        if left[k] >= 0:
            size[k] += size[left[k]] + size[right[k]]
    for k in range(n):
        if left[k] >= 0:
            place[left[k]], place[right[k]] = place[k] + 1, place[k] + 1 + size[left[k]]
    order = np.empty(n, np.int64)
    order[place] = np.arange(n)
    return order, np.array(place), np.array(size)


def _alike(columns: np.ndarray, number: np.ndarray, features: list[int], asked: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one row of each kind, the kind of each row): rows of a kind have one number and pass the same tests of features that have not failed them."""
    kind, kinds = number, 1 << len(features)
    for f in np.unique(asked):
        limits = np.unique(thresholds[asked == f])
        at = np.searchsorted(limits, columns[f], "left")
        if f in features:
            at *= (number >> features.index(f)) & 1
        if kinds * (len(limits) + 1) >= 2**62:
            met, kind = np.unique(kind, return_inverse=True)
            kinds = len(met)
        kind, kinds = kind * (len(limits) + 1) + at, kinds * (len(limits) + 1)
    if kinds > 8 * len(number):
        return np.unique(kind, return_index=True, return_inverse=True)[1:]
    one = np.full(kinds, -1)
    one[kind] = np.arange(len(kind))
    met = np.flatnonzero(one >= 0)
    which = np.empty(kinds, np.int64)
    which[met] = np.arange(len(met))
    return one[met], which[kind]


def _attributed(x: np.ndarray, path: list[tuple[int, float, bool, float]], nodes: dict[str, np.ndarray]) -> np.ndarray:
    """Attributions of the rows by the leaves of one part, in one walk that begins with the path from the tree's root.

    A feature takes the next bit of the rows' numbers where a path tests it first; a later test can only
    clear it. ``shares`` holds, in the order of the bits, what part of the training rows passes all tests of the feature.
    """
    left, right, feature, threshold, value, cover = (nodes[c].tolist() for c in ("left", "right", "feature", "threshold", "value", "cover"))
    width = x.shape[1]
    every: dict[int, np.ndarray] = {}
    order, place, size = _ahead(left, right)
    walked = {c: np.asarray(nodes[c])[order] for c in ("left", "feature", "threshold")}

    def rule(d: int):
        t, w = np.polynomial.legendre.leggauss(max(1, (d + 1) // 2))
        return (t + 1) / 2, w / 2

    rules = [rule(d) for d in range(width + 1)]

    def leaf(phi: np.ndarray, at: int, number: np.ndarray, features: list[int], shares: list[float]) -> None:
        d = len(features)
        if not d:
            return
        if 2**d <= max(64, len(phi)):
            if d not in every:
                every[d] = np.arange(2**d)
            phi += _games(every[d], features, shares, value[at], width, *rules[d]).take(number, axis=0)
        else:
            met, which = np.unique(number, return_inverse=True)
            phi += _games(met, features, shares, value[at], width, *rules[d]).take(which, axis=0)

    def passed(number: np.ndarray, features: list[int], shares: list[float], f: int, goes: np.ndarray, share: float):
        """Numbers, features and shares below a test of feature f."""
        if f not in features:
            return number | (goes.astype(np.int64) << len(features)), [*features, f], [*shares, share]
        bit = features.index(f)
        return number & ~((~goes).astype(np.int64) << bit), features, [s * share if k == bit else s for k, s in enumerate(shares)]

    def below(root: int, columns: np.ndarray, state: tuple) -> np.ndarray:
        """Attributions of the rows by the leaves under a node, for one row of each kind."""
        below_ = slice(place[root], place[root] + size[root])
        inner = walked["left"][below_] >= 0
        first, kind = _alike(columns, state[0], state[1], walked["feature"][below_][inner], walked["threshold"][below_][inner])
        columns, phi = columns[:, first], np.zeros((len(first), width))
        open_ = [(root, state[0][first], *state[1:])]
        while open_:
            at, *state = open_.pop()
            if left[at] < 0:
                leaf(phi, at, *state)
            elif size[at] * FEWER <= size[root] and len(phi) >= FEW and size[at] >= FEWER:
                phi += below(at, columns, state)
            else:
                f, low = feature[at], columns[feature[at]] <= threshold[at]
                for child, goes in ((right[at], ~low), (left[at], low)):
                    open_.append((child, *passed(*state, f, goes, cover[child] / cover[at])))
        return phi.take(kind, axis=0)

    columns, state = np.ascontiguousarray(x.T), (np.zeros(len(x), np.int64), [], [])
    for f, limit, to_left, share in path:
        state = passed(*state, f, (columns[f] <= limit) == to_left, share)
    return below(0, columns, state)


def shap_values(forest: Forest, df: DataFrame, key: str) -> DataFrame:
    """Per row: key, features, ``phi_<feature>``, and ``base``, the forest's mean prediction.

    base + sum of phi is the raw prediction. Rows that repeat a key keep their own. Blocks of rows, equal ones once, meet
    lots of parts of the written node table in tasks, and what the lots say is summed. Rows with a null
    feature have null attributions.
    """
    features, trees = forest.features, len(forest.tops)
    kept = df.select(key, *[F.col(f"`{f}`").cast("double").alias(f) for f in features])
    rows, points = points_of(forest, kept)
    sums = summed(_by_lots(forest, points)).select("point", (F.col("base") / trees).alias("base"), *((F.col(f"p{k}") / trees).alias(f"phi_{f}") for k, f in enumerate(features)))
    return on_rows(rows, points, sums).select(key, *(F.col(f"`{f}`") for f in features), *(F.col(f"`phi_{f}`") for f in features), "base")


def _by_lots(forest: Forest, points: DataFrame) -> DataFrame:
    """base and attributions p0, p1 ... by the trees, in some rows a point that have to be summed.

    Each point meets each part. A task holds a slot of points and a lot of parts, which it adds up: points are copied once
    a lot, parts once a slot, and a point has a row per lot. A pass takes as many lots as deal out some DEALT bytes; its rows are summed and written.
    """
    spark, tops, width = points.sparkSession, forest.tops, len(forest.features)
    cores, n = spark.sparkContext.defaultParallelism, points.count()
    slots = max(1, -(-n // SLOT))
    sizes = sorted((r.tree, r.part, r.n) for r in forest.parts.select("tree", "part", (F.octet_length("left") / 4).cast("long").alias("n")).collect())  # a number per part
    held = max(1, min(NODES, sum(n for *_, n in sizes) // (4 * cores)))
    ends = np.cumsum([n for *_, n in sizes])
    lots = np.unique((ends - 1) // held, return_inverse=True)[1]
    count = int(lots[-1]) + 1
    listed = _table(spark, {"tree": pa.int32(), "part": pa.int32(), "lot": pa.int32()}, [(t, p, int(lot)) for (t, p, _), lot in zip(sizes, lots)])
    columns, keys = [f"p{k}" for k in range(width)], ["lot", "slot"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _lots(batches):
            x, point = _matrix(batch), batch.column("point").to_numpy()
            met = [(int(s), np.flatnonzero(point % slots == s)) for s in np.unique(point % slots)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in met], pa.int32()), pa.array([point[k].tobytes() for _, k in met], pa.binary()), pa.array([x[k].tobytes() for _, k in met], pa.binary())],
                names=["slot", "points", "block"],
            )

    def run(key, rows: pa.Table, parts: pa.Table) -> pa.Table:
        x, point = held_points(rows, width)
        base, phi = 0.0, np.zeros((len(x), width))
        place = sorted((t, p, k) for k, (t, p) in enumerate(zip(parts.column("tree").to_pylist(), parts.column("part").to_pylist())))
        for tree, part, k in place if len(x) else ():  # in one order, whatever the partitions
            nodes = _opened({c: parts.column(c)[k] for c in NEEDED}, NEEDED)
            path, leaf = tops[tree].path(part), nodes["left"] < 0
            base += float(np.prod([p[3] for p in path])) * float((nodes["value"] * nodes["cover"])[leaf].sum() / nodes["cover"][0])
            phi += _attributed(x, path, nodes)
        return pa.table({"point": pa.array(point), "base": pa.array(np.full(len(point), base)), **{c: pa.array(phi[:, k]) for k, c in enumerate(columns)}})

    schema, whole = "point long, base double" + "".join(f", {c} double" for c in columns), None
    at_once = max(1, -(-2 * cores // slots), trees_of.DEALT // (16 * (width + 2) * max(1, n)))
    for begin in range(0, count, at_once):
        end = min(count, begin + at_once)
        tasks = (end - begin) * slots
        dealt = _spread(points).mapInArrow(blocks, "slot int, points binary, block binary").withColumn("lot", F.explode(F.sequence(F.lit(begin), F.lit(end - 1)))).repartition(tasks, *keys)
        parts = forest.parts.select("tree", "part", *NEEDED).join(F.broadcast(listed.where(F.col("lot").between(begin, end - 1))), ["tree", "part"])
        parts = parts.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).repartition(tasks, *keys)
        one = written(summed(dealt.groupBy(*keys).cogroup(parts.groupBy(*keys)).applyInArrow(run, schema)), "attributed")
        whole = one if whole is None else whole.unionAll(one)
    return whole


def shap_rank(values: DataFrame, features: list[str], k: int = TOP_FEATURES) -> DataFrame:
    """Top features by mean absolute attribution, with the direction of their effect.

    The direction is the sign of the correlation of feature and attribution, or of the mean
    attribution for a constant feature.
    """
    aggs, cells = [], []
    for i, f in enumerate(features):
        x, phi = F.col(f"`{f}`"), F.col(f"`phi_{f}`")
        varied = F.stddev_pop(x) > 0
        sign = F.when(varied, F.coalesce(safe_corr(x, phi), F.lit(0.0))).otherwise(F.avg(phi))
        aggs += [F.avg(F.abs(phi)).alias(f"m{i}"), sign.alias(f"s{i}")]
        direction = F.when(F.col(f"s{i}") >= 0, "positive").otherwise("negative")
        cells.append(F.struct(F.lit(f).alias("feature"), F.col(f"m{i}").alias("mean_abs_shap"), direction.alias("direction")))
    rows = values.agg(*aggs).select(rows_of(*cells))
    return rows.orderBy(F.desc("mean_abs_shap"), "feature").limit(k)
