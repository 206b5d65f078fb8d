"""A bootstrapped regression forest as Spark jobs, its node table, predictions and importances.

Training rows are written once with a number; rows of equal features and label become one item with
the numbers of its rows, which is drawn as often as they are. Nodes with more items than a task may hold are split by
Spark, all nodes of a level and of some trees in two passes over the rows: histograms per node and
feature, summed by a shuffle, and the values of the bins that may hold the best split. What is left of a tree are parts that fit into one task each; every
row is dealt to its part of every tree that drew it, and a task grows its part level by level, all
nodes of a level at once, with exact splits. The result is a written table with a row per part,
that scoring joins with the rows: no model is collected, broadcast or held in a closure, except
the few nodes above the parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.skew import SALTS, spread_join
from tidemark.session import tidied, written

#: Values (rows x features) of a part that a task grows, and rows that a task scores with a part at once.
CELLS, SLOT = 2_000_000, 50_000
#: Trees that are split above the parts together; bins of a feature with more than VALUES values there.
TREES_AT_ONCE, BINS, VALUES = 50, 256, 256
#: Parts of these trees, and bytes of items that are dealt out together; of few trees it may be more, so that many tasks grow.
PARTS_AT_ONCE, DEALT, FEWEST = 10_000, 2_000_000_000, 4
#: Rows of an item that are a list of their own: what one task finds in a batch is not gathered further.
ALONE = 64

#: Items of neighbouring nodes that a growing task looks at together: what they need stays in its core's cache.
RUN = 32_768

#: Bytes of items, and of histograms, that a task looks at together.
LOT, HISTOGRAMS = 32_000_000, 256_000_000

#: What a part holds per node, each as the bytes of one array; behind them, what its splits on each feature take away.
NODE = {"left": np.int32, "right": np.int32, "feature": np.int32, "threshold": np.float64, "value": np.float64, "cover": np.float64, "gain": np.float64}
PART = "tree int, part int" + "".join(f", {c} binary" for c in NODE) + ", gains binary"
# The cumulated Poisson distribution of mean 1.
POISSON = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880, 3628800, 39916800)])
#: The number that the first twelve bits of a draw lead to; -1 where the rest of it decides.
_ENDS = np.searchsorted(POISSON, np.arange(4097) / 4096, side="right")
DRAWN = np.where(_ENDS[:-1] == np.append(_ENDS[1:-1], len(POISSON) + 1), _ENDS[:-1], -1).astype(np.float64)


@dataclass
class Top:
    """The nodes of a tree above its parts, by number; a node without children is the part of that number."""

    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])
    value: dict[int, float] = field(default_factory=dict)  # of parts that can't be split

    def add(self, cover: float, depth: int) -> int:
        for values, v in ((self.left, -1), (self.right, -1), (self.feature, -1), (self.threshold, 0.0), (self.cover, cover), (self.gain, 0.0), (self.depth, depth)):
            values.append(v)
        return len(self.left) - 1

    def parts(self) -> list[int]:
        return [k for k, child in enumerate(self.left) if child < 0]

    def path(self, part: int) -> list[tuple[int, float, bool, float]]:
        """(feature, threshold, left, share of the cover) of each step from the root to a part."""
        up = {c: k for k in range(len(self.left)) if self.left[k] >= 0 for c in (self.left[k], self.right[k])}
        steps = []
        while part in up:
            k = up[part]
            steps.append((self.feature[k], self.threshold[k], part == self.left[k], self.cover[part] / self.cover[k]))
            part = k
        return steps[::-1]


@dataclass
class Forest:
    """``parts`` is the written node table; ``tops`` what lies above it, one entry a tree."""

    parts: DataFrame
    tops: list[Top]
    features: list[str]

    def nodes(self) -> DataFrame:
        """One row per node of the parts: tree, part, id, left, right, feature, threshold, value, cover, gain."""
        kinds = "".join(f", {c} {'int' if kind is np.int32 else 'double'}" for c, kind in NODE.items())
        return self.parts.select("tree", "part", *NODE).mapInArrow(_each_part(_nodes_of), f"tree int, part int, id int{kinds}")

    def first_splits(self) -> DataFrame:
        """One row per tree: feature, threshold, and value and cover on both sides of its root's split; nulls without one."""
        spark, columns = self.parts.sparkSession, "tree int, part int, root int, threshold_above double, side int"
        rows = []  # a row per part: what the root does, if it lies above the parts, and on which side the part is
        for tree, top in enumerate(self.tops):
            split = top.left[0] >= 0
            for part in top.parts():
                path = top.path(part)
                rows.append((tree, part, top.feature[0] if split else None, top.threshold[0] if split else None, (0 if path[0][2] else 1) if split else None))
        sides = "".join(f", {c}{k} double" for k in range(2) for c in ("value", "cover"))
        first = self.parts.select("tree", "part", *NODE).mapInArrow(_each_part(_first_of), f"tree int, part int, feature int, threshold double, value double, cover double{sides}")
        placed = first.join(F.broadcast(spark.createDataFrame(rows, columns)), ["tree", "part"])
        above = F.col("root").isNotNull()
        sums = []
        for k, name in enumerate(("left", "right")):
            cover = F.sum(F.when(above, F.when(F.col("side") == k, F.col("cover"))).otherwise(F.col(f"cover{k}")))
            total = F.sum(F.when(above, F.when(F.col("side") == k, F.col("cover") * F.col("value"))).otherwise(F.col(f"cover{k}") * F.col(f"value{k}")))
            sums += [F.try_divide(total, cover).alias(f"{name}_value"), cover.alias(f"{name}_rows")]
        root = [F.max(F.when(above, F.col(a)).otherwise(F.col(b))).alias(b) for a, b in (("root", "feature"), ("threshold_above", "threshold"))]
        return placed.groupBy("tree").agg(*root, *sums)


def _opened(packed: dict[str, bytes | pa.Scalar], columns=tuple(NODE)) -> dict[str, np.ndarray]:
    return {c: np.frombuffer(packed[c].as_buffer(), NODE[c]) for c in columns}


def _each_part(found):
    """What ``found`` returns for the nodes of each part, as columns behind its tree and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                columns = found(_opened({c: batch.column(c)[k] for c in NODE}))
                n = len(next(iter(columns.values())))
                own = {c: pa.array(np.full(n, batch.column(c)[k].as_py()), pa.int32()) for c in ("tree", "part")}
                yield pa.RecordBatch.from_pydict(own | {c: pa.array(v) for c, v in columns.items()})

    return run


def _nodes_of(nodes: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {"id": np.arange(len(nodes["left"]), dtype=np.int32)} | nodes


def _first_of(nodes: dict[str, np.ndarray]) -> dict[str, pa.Array]:
    """The first node, with value and cover of both children; without any, nulls."""
    split = nodes["left"][0] >= 0
    some = lambda v, kind: pa.array([v if split else None], kind)
    out = {"feature": some(int(nodes["feature"][0]), pa.int32()), "threshold": some(float(nodes["threshold"][0]), pa.float64())}
    out |= {c: pa.array([float(nodes[c][0])]) for c in ("value", "cover")}
    return out | {f"{c}{k}": some(float(nodes[c][nodes[side][0]]), pa.float64()) for k, side in enumerate(("left", "right")) for c in ("value", "cover")}


def _gains_of(nodes: dict[str, np.ndarray]) -> np.ndarray:
    """What the splits on each feature take away, up to the last one met."""
    inner = np.flatnonzero(np.asarray(nodes["left"]) >= 0)
    return np.bincount(np.asarray(nodes["feature"])[inner], np.asarray(nodes["gain"])[inner])


def _by_feature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The gains of each part, a row per feature."""
    for batch in batches:
        gains = [np.frombuffer(g.as_buffer()) for g in batch.column("gains")]
        sizes = [len(g) for g in gains]
        yield pa.RecordBatch.from_pydict({
            "tree": batch.column("tree").take(pa.array(np.repeat(np.arange(len(gains)), sizes))),
            "feature": pa.array(np.concatenate([np.arange(n) for n in sizes] or [np.zeros(0)]).astype(np.int32)), "gain": pa.array(np.concatenate(gains or [np.zeros(0)])),
        })


def draws(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree draws each row: Poisson numbers that only row, tree and seed determine."""
    out = np.empty(len(row))
    for begin in range(0, len(row), RUN):
        with np.errstate(over="ignore"):
            x = row[begin : begin + RUN].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tree + 1) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(seed)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
        drawn = DRAWN.take((x >> np.uint64(52)).astype(np.int64))
        close = np.flatnonzero(drawn < 0)
        drawn[close] = np.searchsorted(POISSON, (x[close] >> np.uint64(11)).astype(np.float64) / 2.0**53, side="right")
        out[begin : begin + RUN] = drawn
    return out


def _index_kind(n: int):
    """Numbers under n as integers that sort in one pass over their bits, where they fit."""
    return np.uint16 if n <= 65_536 else np.int64


def _key(column: np.ndarray) -> np.ndarray:
    """The column, as short integers where it holds nothing else: those sort faster, in the same order."""
    with np.errstate(invalid="ignore"):
        short = column.astype(np.int16)
    return short if (short == column).all() else column


def _ordered(rows: np.ndarray) -> np.ndarray:
    """The rows sorted by their first column, among equals by the second and so on: each column looks only at rows that agree so far."""
    order = np.argsort(_key(rows[:, 0]), kind="stable")
    tied, group = np.arange(len(rows)), np.zeros(len(rows), np.int64)  # places of rows that agree so far, and with which others
    for c in range(rows.shape[1]):
        if c:
            order[tied] = order[tied][np.lexsort((_key(rows[order[tied], c]), group))]
        column = rows[order[tied], c]
        new = np.concatenate(([True], (group[1:] != group[:-1]) | ((column[1:] != column[:-1]) & ~(np.isnan(column[1:]) & np.isnan(column[:-1])))))
        group = np.cumsum(new) - 1
        several = np.flatnonzero(np.bincount(group)[group] > 1)
        tied, group = tied[several], group[several]
        if not len(tied):
            break
    return rows[order]


def reached(x: np.ndarray, left, right, feature, threshold) -> np.ndarray:
    """The node without children that each row ends in."""
    left, right, feature, threshold = (np.asarray(v) for v in (left, right, feature, threshold))
    at = np.zeros(len(x), np.int64)
    while True:
        go = np.flatnonzero(left[at] >= 0)
        if not len(go):
            return at
        k = at[go]
        at[go] = np.where(x[go, feature[k]] <= threshold[k], left[k], right[k])


def _between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Thresholds between neighbouring values: their middle, which is under the upper one."""
    middle = a / 2 + b / 2
    return np.where(middle < b, middle, a)


def _coded(column: np.ndarray, order: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column, ascending, and which of them each item has; ``order`` sorts it, without one there are two values."""
    if order is None:
        ends = np.array([column.min(), column.max()])
        return ends, column == ends[1]
    moved = column[order]
    new = np.concatenate(([True], (moved[1:] != moved[:-1]) & (moved[:-1] == moved[:-1])))  # a NaN is above all, and equal to others
    code = np.empty(len(column), np.int32)
    code[order] = np.cumsum(new) - 1
    return moved[new], code


def grown(x: np.ndarray, y: np.ndarray, w: np.ndarray, max_depth: int | None = None, min_rows: int = 1, m: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """The nodes of a regression tree, in levels: children, feature, threshold, value, cover and gain of each.

    A node is split where that lowers the squared error most, between two neighbouring values, at
    their middle. Nodes of one label, or without two values that leave ``min_rows`` on both sides, stay whole; an item stands for ``m`` rows. Items
    lie as records in the order of their nodes, and are listed by node and value for each feature of more than two values. A level is looked at in
    runs of nodes with some RUN items, whose sums go on from run to run.
    """
    n, mean, counted = len(y), float(np.average(y, weights=w)), min_rows > 1
    names, values, codes, orders, paired = [], [], [], [], []  # those of more values first
    for f, column in enumerate(np.ascontiguousarray(x.T)):
        low, high = column.min(), column.max()
        if low == high:
            continue
        if ((column == low) | (column == high)).all():
            paired.append((f, *_coded(column, None)))
            continue
        orders.append(np.argsort(_key(column), kind="stable"))
        names.append(f)
        for all_, v in zip((values, codes), _coded(column, orders[-1])):
            all_.append(v)
    wide, pairs, width = len(orders), len(paired), len(orders) + len(paired)
    rarer = np.array([int(2 * np.count_nonzero(high) < n) for _, _, high in paired], np.int8).reshape(pairs, 1)
    names += [f for f, _, _ in paired]
    values += [v for _, v, _ in paired]
    asked = np.argsort(names)  # where several features are as good, the first one splits
    begins_of = np.cumsum([0, *map(len, values)])[:-1]
    named, value_of = np.array(names, np.int64), np.concatenate([*values, np.zeros(0)])
    # a record: weight, label, rows, a number per feature of more values, a byte per feature of two
    numbers = 2 + counted
    flags = numbers + -(-wide // 2)
    records = np.zeros((n, flags + -(-pairs // 8)), np.int64)
    plain = records.view(np.float64)
    plain[:, 0], plain[:, 1] = w, y - mean
    if counted:
        plain[:, 2] = 1.0 if m is None else m
    for j, code in enumerate(codes):
        records.view(np.int32)[:, 2 * numbers + j] = code
    for j, (_, _, high) in enumerate(paired):
        records.view(np.int8)[:, 8 * flags + j] = high
    here, there = (records, orders), (np.empty_like(records), [np.empty_like(o) for o in orders])
    moved_to, sizes, depth, out, nodes = np.empty(n, np.int64), np.array([n]), 0, [], 0
    while len(sizes):
        (records, orders), k, n = here, len(sizes), int(sizes.sum())
        plain, coded, flagged = (records.view(kind) for kind in (np.float64, np.int32, np.int8))
        starts = np.cumsum(sizes) - sizes
        level = {"left": np.full(k, -1), "right": np.full(k, -1), "feature": np.full(k, -1), "threshold": np.zeros(k), "value": np.empty(k), "cover": np.empty(k), "gain": np.zeros(k)}
        out.append(level)
        nodes += k
        last = max_depth is not None and depth >= max_depth
        carried = [[0j, 0.0] for _ in orders]
        begins = np.concatenate(([0], np.flatnonzero(np.diff(starts // RUN)) + 1, [k]))
        moves, children = [], []
        for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
            s, e = int(starts[a]), int(starts[b]) if b < k else n
            one, first_of, count = sizes[a:b], starts[a:b] - s, b - a
            seg = np.repeat(np.arange(count), one)
            weight, label = (np.ascontiguousarray(plain[s:e, c]) for c in range(2))
            wz = weight * label
            tw, ts = np.add.reduceat(weight, first_of), np.add.reduceat(wz, first_of)
            level["value"][a:b], level["cover"][a:b] = ts / tw + mean, tw
            if last:
                continue
            mixed = np.maximum.reduceat(label, first_of) > np.minimum.reduceat(label, first_of)
            if counted:
                rows = np.ascontiguousarray(plain[s:e, 2])
                tm = np.add.reduceat(rows, first_of)
                mixed &= tm >= 2 * min_rows
            both = np.empty(e - s, np.complex128)  # summed in one pass, each part as if alone
            both.real, both.imag = weight, wz
            together, whole = (seg[:-1] == seg[1:]) & mixed.take(seg[:-1]), ts * ts / tw
            code_of = np.empty((width, e - s), np.int32)
            found, cut, above = np.full((width, count), -np.inf), np.zeros((width, count), np.int32), np.ones((width, count), np.int32)
            for j, (list_, carry) in enumerate(zip(orders, carried)):
                code_of[j] = coded[s:e, 2 * numbers + j]
                order = list_[s:e] - s
                code = code_of[j].take(order)
                inside = np.flatnonzero((code[:-1] != code[1:]) & together)
                at, since = seg.take(inside), []
                for q, sums in enumerate((both, rows) if counted else (both,)):
                    upto = np.empty(e - s + 1, sums.dtype)  # before each item, and behind the last
                    upto[0] = carry[q]
                    sums.take(order, out=upto[1:], mode="clip")
                    np.cumsum(upto, out=upto)
                    carry[q] = upto[-1]
                    since.append(upto[1:].take(inside) - upto.take(first_of).take(at))
                if not len(inside):
                    continue
                lw, ls = since[0].real.copy(), since[0].imag.copy()
                rs = ts.take(at) - ls
                score = ls * ls / lw + rs * rs / np.maximum(tw.take(at) - lw, 1e-300) - whole.take(at)
                if counted:
                    score[(since[1] < min_rows) | (tm.take(at) - since[1] < min_rows)] = -np.inf
                first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
                best, who = np.maximum.reduceat(score, first), at.take(first)
                found[j][who] = best
                places = np.flatnonzero(score == found[j].take(at))  # the first best place of each node
                in_ = at.take(places)
                place = inside.take(places.take(np.flatnonzero(np.concatenate(([True], in_[1:] != in_[:-1])))))
                cut[j][who], above[j][who] = code.take(place), code.take(place + 1)
            if pairs:
                code_of[wide:] = flagged[s:e, 8 * flags : 8 * flags + pairs].T
                some = np.flatnonzero(code_of[wide:] == rarer)
                j = some // (e - s)
                some -= j * (e - s)
                at, every = seg.take(some) + j * count, pairs * count
                hw, hs = np.bincount(at, weight.take(some), every), np.bincount(at, wz.take(some), every)
                fits = (mixed & (np.bincount(at, minlength=every).reshape(pairs, count) < one)).ravel() & (hw > 0)
                if counted:
                    hm = np.bincount(at, rows.take(some), every).reshape(pairs, count)
                    fits &= ((hm >= min_rows) & (tm - hm >= min_rows)).ravel()
                at = np.flatnonzero(fits)
                hw, hs, who = hw.take(at), hs.take(at), at % count
                rs = ts.take(who) - hs
                found[wide:].ravel()[at] = hs * hs / hw + rs * rs / np.maximum(tw.take(who) - hw, 1e-300) - whole.take(who)
            gain, by = np.full(count, -np.inf), np.zeros(count, np.int64)
            for j in asked:
                better = found[j] > gain
                np.copyto(gain, found[j], where=better)
                np.copyto(by, j, where=better)
            splits = np.isfinite(gain)
            who = np.flatnonzero(splits)
            if not len(who):
                continue
            j = by.take(who)
            low, high = (value_of.take(begins_of.take(j) + v.ravel().take(j * count + who)) for v in (cut, above))
            level["feature"][a + who], level["threshold"][a + who], level["gain"][a + who] = named.take(j), _between(low, high), np.maximum(gain.take(who), 0)
            # items of the nodes that were split move, in their order: first those of all left children, then those of the right ones
            live = np.arange(e - s) if len(who) == count else np.flatnonzero(splits.take(seg))
            at = seg.take(live)
            lefts = code_of.ravel().take(by.take(at) * (e - s) + live) <= cut.ravel().take(by * count + np.arange(count)).take(at)
            live += s
            sides = live.take(np.flatnonzero(lefts)), live.take(np.flatnonzero(~lefts))
            left = np.bincount(at, lefts, count).astype(np.int64).take(who)
            moves.append((s, e, sides))
            children.append((left, one.take(who) - left))
        who = np.flatnonzero(level["feature"] >= 0)
        if not len(who):
            break
        level["left"][who], level["right"][who] = nodes + np.arange(len(who)), nodes + len(who) + np.arange(len(who))
        sizes = np.concatenate([c[side] for side in range(2) for c in children])
        n_left, n_live = int(sizes[: len(who)].sum()), int(sizes.sum())
        begin = [0, n_left]
        for s, e, sides in moves:
            moved_to[s:e] = n_live
            spans = []
            for side, some in enumerate(sides):
                spans.append(slice(begin[side], begin[side] + len(some)))
                begin[side] += len(some)
                moved_to[some] = np.arange(spans[-1].start, spans[-1].stop)
                records.take(some, axis=0, out=there[0][spans[-1]], mode="clip")
            for list_, to in zip(orders, there[1]):
                at = moved_to.take(list_[s:e])
                lefts = at < n_left
                rights = ~lefts if sum(map(len, sides)) == e - s else (at >= n_left) & (at < n_live)
                for mine, span in zip((lefts, rights), spans):
                    at.take(np.flatnonzero(mine), out=to[span], mode="clip")
        here, there = there, here
        depth += 1
    return {c: np.concatenate([level[c] for level in out]) for c in out[0]}


def _matrix(batch: pa.RecordBatch | pa.Table, column: str = "x") -> np.ndarray:
    values = batch.column(column)
    flat = values.flatten() if isinstance(values, pa.Array) else values.combine_chunks().flatten()
    return flat.to_numpy().reshape(batch.num_rows, -1)


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of some LOT bytes, none of them empty."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= LOT:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with equal features and label as one, with their numbers."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y, row = _matrix(batch) + 0.0, batch.column("y").to_numpy() + 0.0, batch.column("row").to_numpy()  # no negative zero
        x[np.isnan(x)], y[np.isnan(y)] = np.nan, np.nan  # one form, of equal bytes
        order = np.lexsort((y, *x.T))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.concatenate(([True], (y[1:] != y[:-1]) | (x[1:] != x[:-1]).any(1))))
        bytes_ = np.column_stack([x[first], y[first]]).tobytes()
        keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * x.shape[1] + 8), len(first), [None, pa.py_buffer(bytes_)]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.append(first, len(y)).astype(np.int32)), pa.array(row[order])), keys], names=["rows", "bytes"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features and label of the bytes, with the numbers."""
    for batch in batches:
        if batch.num_rows:
            rows = np.frombuffer(b"".join(batch.column("bytes").to_pylist())).reshape(batch.num_rows, -1)
            ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] - 1)
            x = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows[:, :-1]).reshape(-1)))
            yield pa.RecordBatch.from_arrays([x, pa.array(rows[:, -1].copy()), batch.column("rows")], names=["x", "y", "rows"])


def _items(rows: DataFrame) -> DataFrame:
    """Rows of equal features and label gathered with their numbers; many of them stay several items."""
    # by the bytes of features and label: arrays sort slowly
    found = rows.mapInArrow(_merged, "rows array<long>, bytes binary")
    alone = F.when(F.size("rows") >= ALONE, F.col("rows")[0]).otherwise(F.lit(-1))
    same = found.groupBy("bytes", alone.alias("alone")).agg(F.flatten(F.collect_list("rows")).alias("rows"))
    return same.select("bytes", "rows").mapInArrow(_unpacked, "x array<double>, y double, rows array<long>")


def _spread(rows: DataFrame) -> DataFrame:
    """The rows on as many tasks as there are cores, where few files would keep some idle."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


class _Drawing:
    """How often trees draw the items of a batch, and how many of their rows."""

    def __init__(self, batch: pa.RecordBatch, seed: int, bootstrap: bool):
        rows = batch.column("rows")
        self.sizes = np.diff(rows.offsets.to_numpy())
        self.single = bool((self.sizes == 1).all())  # every item drawn is one row
        self.row, self.starts, self.seed, self.bootstrap = rows.flatten().to_numpy(), np.cumsum(self.sizes) - self.sizes, seed, bootstrap

    def of(self, tree: int) -> tuple[np.ndarray, np.ndarray]:
        if not self.bootstrap:
            return self.sizes.astype(np.float64), self.sizes.astype(np.float64)
        w = draws(self.row, tree, self.seed)
        if self.single:
            return w, (w > 0).astype(np.float64)
        return np.add.reduceat(w, self.starts), np.add.reduceat((w > 0).astype(np.float64), self.starts)


def _record(kind: str) -> np.dtype:
    """A record of features, a letter each (``h``: all are short integers, else ``d``), label, weight and rows."""
    return np.dtype([*((f"x{f}", c) for f, c in enumerate(kind)), ("y", "d"), ("w", np.uint32), ("m", np.uint32)])


def _kind_of(records: np.ndarray) -> str:
    return "".join(records.dtype[f].char for f in range(len(records.dtype) - 3))


def _records(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    columns = [_key(c) for c in x.T]
    records = np.empty(len(y), _record("".join(c.dtype.char for c in columns)))
    for name, column in zip(records.dtype.names, [*columns, y]):
        records[name] = column
    return records


def _plain(kinds: pa.ChunkedArray, blocks: pa.ChunkedArray) -> np.ndarray:
    """The records of all blocks as rows of numbers."""
    found = [np.frombuffer(b.as_buffer(), _record(kind.as_py())) for kind, b in zip(kinds, blocks)]
    rows, begin = np.empty((sum(map(len, found)), len(found[0].dtype))), 0
    for records in found:
        for c, name in enumerate(records.dtype.names):
            rows[begin : begin + len(records), c] = records[name]
        begin += len(records)
    return rows


def _blocks(tops: dict[int, Top], seed: int, bootstrap: bool):
    """A block of values, label, weight and rows per batch, tree and part, of the items that the tree drew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _lots(batches):
            x, y, drawing = _matrix(batch), batch.column("y").to_numpy(), _Drawing(batch, seed, bootstrap)
            records = _records(x, y)
            kind = _kind_of(records)
            for tree, top in tops.items():
                (w, m), part = drawing.of(tree), reached(x, top.left, top.right, top.feature, top.threshold)
                grows = np.ones(len(top.left), bool)
                grows[list(top.value)] = False
                mine = np.flatnonzero((w > 0) & grows[part])
                mine = mine[np.argsort(part[mine].astype(_index_kind(len(grows))), kind="stable")]
                block = records.take(mine)
                block["w"], block["m"] = w.take(mine), m.take(mine)
                found, first = np.unique(part[mine], return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * len(found), pa.int32()), pa.array(found, pa.int32()), pa.array([kind] * len(found), pa.string()), pa.array([b.tobytes() for b in np.split(block, first[1:])] if len(found) else [], pa.binary())],
                    names=["tree", "part", "kind", "block"],
                )

    return run


def _packed(tree: int, part: int, nodes: dict[str, np.ndarray]) -> dict:
    return {"tree": tree, "part": part} | {c: np.asarray(nodes[c], kind).tobytes() for c, kind in NODE.items()} | {"gains": _gains_of(nodes).astype(np.float64).tobytes()}


def _listed(tree: int, part: int, nodes: dict[str, np.ndarray]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * (len(NODE) + 1)]
    row = _packed(tree, part, nodes)
    return pa.table([pa.array([v], kind) for v, kind in zip(row.values(), kinds)], names=list(row))


def _growing(width: int, tops: dict[int, Top], max_depth: int | None, min_rows: int):
    def run(table: pa.Table) -> pa.Table:
        tree, part = table.column("tree")[0].as_py(), table.column("part")[0].as_py()
        rows = _plain(table.column("kind"), table.column("block"))
        rows = _ordered(rows)  # whatever the partitions
        left = None if max_depth is None else max_depth - tops[tree].depth[part]
        return _listed(tree, part, grown(rows[:, :width], rows[:, width], rows[:, width + 1], left, min_rows, rows[:, width + 2]))

    return run


@dataclass
class Cuts:
    """Per feature all its values but the last, where they are ``few``, else the upper ends of bins: quantiles, and infinity."""

    edges: list[np.ndarray]
    values: list[np.ndarray]
    few: list[bool]
    mean: float  # of the labels, which are summed from there

    def wide(self) -> tuple[int, ...]:
        return tuple(f for f, few in enumerate(self.few) if not few)


def _places(bins: list[int], wide: tuple[int, ...]) -> dict[int, slice]:
    """Where each feature of many values has its bins, one behind the other."""
    ends = np.cumsum([bins[f] for f in wide])
    return {f: slice(int(end) - bins[f], int(end)) for f, end in zip(wide, ends)}


def _blank(bins: list[int], wide: tuple[int, ...]) -> np.ndarray:
    """Sums of nothing: items, rows, weight and weighted label of all bins; of those of ``wide`` least and largest label and value; least and largest label."""
    n, least = sum(bins[f] for f in wide), [np.inf, -np.inf]
    return np.concatenate([np.zeros(4 * sum(bins)), np.repeat(least * 2, n), least])


def _added(sums: np.ndarray, more: np.ndarray, n: int, wide: int) -> None:
    """Sums of the same n bins, ``wide`` of them with what is least and largest, put together in place."""
    sums[..., : 4 * n] += more[..., : 4 * n]
    at = 4 * n
    for size in (wide, wide, 1):
        for one in (np.minimum, np.maximum):
            part = (..., slice(at, at + size))
            one(sums[part], more[part], out=sums[part])
            at += size


def _histograms(tops: dict[int, Top], open_: dict[int, list[int]], edges: list[np.ndarray], seed: int, bootstrap: bool, mean: float = 0.0, wide: tuple[int, ...] = ()):
    """Per task and open node the sums of the bins of all features (``_blank``), one feature behind the other."""
    bins = [len(e) + 1 for e in edges]
    ends, places, blank = np.cumsum(bins), _places(bins, wide), _blank(bins, wide)
    total, inner = int(ends[-1]), sum(bins[f] for f in wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for tree, s in sums.items():
                met = np.flatnonzero(s[:, : bins[0]].any(1))
                ids = pa.array(np.full(len(met), tree), pa.int32()), pa.array(np.array(open_[tree])[met], pa.int32())
                yield pa.RecordBatch.from_arrays([*ids, pa.array([s[k].tobytes() for k in met], pa.binary())], names=["tree", "node", "sums"])
            sums.clear()

        for batch in _lots(batches):
            x, y, drawing = _matrix(batch), batch.column("y").to_numpy() - mean, _Drawing(batch, seed, bootstrap)
            codes = [np.searchsorted(e, x[:, f], "left").astype(_index_kind(bins[f])) for f, e in enumerate(edges)]
            for tree, nodes in open_.items():
                top, k = tops[tree], len(nodes)
                place = np.full(len(top.left), -1)
                place[nodes] = np.arange(k)
                (w, m), at = drawing.of(tree), place[reached(x, top.left, top.right, top.feature, top.threshold)]
                mine = np.flatnonzero((at >= 0) & (w > 0))
                at, w, m, label = at[mine], w[mine], None if drawing.single else m[mine], y[mine]
                wy = w * label
                if tree not in sums:
                    sums[tree] = np.tile(blank, (k, 1))
                one = sums[tree]
                for f, n in enumerate(bins):
                    bin_ = at * n + codes[f][mine]
                    items = np.bincount(bin_, None, k * n)
                    for q, v in enumerate((items, items if m is None else np.bincount(bin_, m, k * n), np.bincount(bin_, w, k * n), np.bincount(bin_, wy, k * n))):
                        one[:, q * total + ends[f] - n : q * total + ends[f]] += v.reshape(k, n)
                    if f in places:
                        for q, v in enumerate((label, x[mine, f])):
                            for c, (of, none) in enumerate(((np.fmin, np.inf), (np.fmax, -np.inf))):
                                found = np.full(k * n, none)
                                of.at(found, bin_, v)
                                begin = 4 * total + (2 * q + c) * inner + places[f].start
                                of(one[:, begin : begin + n], found.reshape(k, n), out=one[:, begin : begin + n])
                for c, (of, none) in enumerate(((np.minimum, np.inf), (np.maximum, -np.inf))):
                    found = np.full(k, none)
                    of.at(found, at, label)
                    of(one[:, c - 2], found, out=one[:, c - 2])
                if sum(s.nbytes for s in sums.values()) > HISTOGRAMS:
                    yield from told()
        yield from told()

    return run


#: A bin inside of which a node may have a better split than between bins, with the items it has and the sums before it.
INSIDE = np.dtype([("feature", np.int32), ("bin", np.int32), ("held", "d"), ("items", "d"), ("rows", "d"), ("w", "d"), ("s", "d")])


def _gain(lw: np.ndarray, ls: np.ndarray, w: float, s: float) -> np.ndarray:
    """By how much a split lowers the squared error; nothing on one side counts as nothing."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(lw > 0, ls * ls / lw, 0.0) + np.where(w - lw > 0, (s - ls) * (s - ls) / (w - lw), 0.0) - s * s / w


def _most(w0: np.ndarray, s0: np.ndarray, w1: np.ndarray, s1: np.ndarray, low: np.ndarray, high: np.ndarray, w: float, s: float) -> np.ndarray:
    """What a split inside a bin gains at most, from the sums before and behind it and its least and largest label.

    The gain is convex in weight and sum of the left side. They lie in a parallelogram, whose sides rise by the
    least or the largest label: no point of it gains more than the best of its corners.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        first = np.where(high > low, np.clip((s1 - s0 - (w1 - w0) * low) / (high - low), 0, w1 - w0), 0.0)  # the weight with the largest label
    corners = ((w0, s0), (w1, s1), (w0 + first, s0 + first * high), (w1 - first, s1 - first * high))
    return np.max([_gain(a, b, w, s) for a, b in corners], axis=0)


def _best_split(bins: list[int], min_rows: int, wide: tuple[int, ...] = ()):
    """The sums of a node and, where it can be split, the best feature and bin with the sums to the left, the next bin that it has, and bins to look into."""
    total, places = sum(bins), _places(bins, wide)
    inner = sum(bins[f] for f in wide)

    def run(table: pa.Table) -> pa.Table:
        sums = _blank(bins, wide)
        for packed in table.column("sums"):
            _added(sums, np.frombuffer(packed.as_buffer()), total, inner)
        planes = sums[: 4 * total].reshape(4, total)
        best, whole, lefts = None, planes[:, : bins[0]].sum(1), []
        least = sums[4 * total : -2].reshape(4, inner)  # label from, to, value from, to
        for f, (n, end) in enumerate(zip(bins, np.cumsum(bins))):
            used = np.flatnonzero(planes[0, end - n : end])
            left = np.cumsum(planes[:, end - n + used], 1)
            lefts.append((used, left))
            (e, n_, w, s), (le, ln, lw, ls) = left[:, -1], left
            fits = np.flatnonzero((ln[:-1] >= min_rows) & (n_ - ln[:-1] >= min_rows))
            if not len(fits):
                continue
            gain = _gain(lw[fits], ls[fits], w, s)
            k = int(np.argmax(gain))
            if best is None or gain[k] > best[0]:
                k_ = fits[k]
                low, high = (least[3, places[f]][used[k_]], least[2, places[f]][used[k_ + 1]]) if f in places else (None, None)
                best = (gain[k], f, used[k_], le[k_], lw[k_], ls[k_], e, w, s, used[k_ + 1], low, high)
        best = best or (None, 0, 0, 0.0, 0.0, 0.0, whole[0], whole[2], whole[3], 0, None, None)
        into = []
        for f, place in places.items():
            used, left = lefts[f]
            _, _, w, s = left[:, -1]
            before = np.concatenate((np.zeros((4, 1)), left[:, :-1]), 1)
            label_low, label_high, low, high = least[:, place][:, used]
            enough = best[0] is None or _most(before[2], before[3], left[2], left[3], label_low, label_high, w, s) > best[0] - 1e-9 * (abs(best[0]) + s * s / w)
            some = np.flatnonzero((low < high) & (used < bins[f] - 1) & enough)
            one = np.zeros(len(some), INSIDE)
            one["feature"], one["bin"], one["held"] = f, used[some], left[0, some] - before[0, some]
            one["items"], one["rows"], one["w"], one["s"] = before[:, some]
            into.append(one)
        kinds = [pa.float64(), pa.int32(), pa.int32(), *[pa.float64()] * 6, pa.int32(), pa.float64(), pa.float64()]
        names = ("gain", "feature", "bin", "le", "lw", "ls", "e", "w", "s", "next", "low", "high")
        found = {c: pa.array([v if v is None else v.item() if isinstance(v, np.generic) else v], kind) for c, v, kind in zip(names, best, kinds)}
        found |= {"n": pa.array([float(whole[1])]), "mixed": pa.array([bool(sums[-2] < sums[-1])]), "inside": pa.array([np.concatenate(into).tobytes() if into else b""], pa.binary())}
        return pa.table({c: table.column(c).slice(0, 1) for c in ("tree", "node")} | found)

    return run


def _values_inside(tops: dict[int, Top], lots: dict[int, tuple[list[int], np.ndarray]], edges: list[np.ndarray], wide: tuple[int, ...], mean: float, seed: int, bootstrap: bool):
    """Per task, open node and lot of bins: feature, value, items, rows, weight and weighted label of each value in these bins."""
    places = _places([len(e) + 1 for e in edges], wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _lots(batches):
            x, y, drawing = _matrix(batch), batch.column("y").to_numpy() - mean, _Drawing(batch, seed, bootstrap)
            codes = {f: np.searchsorted(edges[f], x[:, f], "left") for f in wide}
            for tree, (nodes, lot_of) in lots.items():
                top = tops[tree]
                place = np.full(len(top.left), -1)
                place[nodes] = np.arange(len(nodes))
                (w, m), at = drawing.of(tree), place[reached(x, top.left, top.right, top.feature, top.threshold)]
                mine = np.flatnonzero((at >= 0) & (w > 0))
                key, rows = [], []
                for f in wide:
                    lot = lot_of[at[mine], places[f].start + codes[f][mine]]
                    some = mine[lot >= 0]
                    key.append(np.column_stack([at[some], lot[lot >= 0]]))
                    rows.append(np.column_stack([np.full(len(some), f), x[some, f], np.ones(len(some)), m[some], w[some], w[some] * y[some]]))
                key, rows = np.concatenate(key), np.concatenate(rows)
                if not len(rows):
                    continue
                order = np.lexsort((rows[:, 1], rows[:, 0], key[:, 1], key[:, 0]))
                key, rows = key[order], rows[order]
                new = np.concatenate(([True], (key[1:] != key[:-1]).any(1) | (rows[1:, :2] != rows[:-1, :2]).any(1)))
                rows = _merged_values(rows, new)
                key = key[new]
                first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(1))))
                blocks = [b.tobytes() for b in np.split(rows, first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * len(first), pa.int32()), pa.array(np.array(nodes)[key[first, 0]], pa.int32()), pa.array(key[first, 1], pa.int32()), pa.array(blocks, pa.binary())],
                    names=["tree", "node", "lot", "block"],
                )

    return run


def _merged_values(rows: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Rows (feature, value, sums) as one from each new one to the next."""
    first = np.flatnonzero(new)
    return np.column_stack([rows[first, :2], np.add.reduceat(rows[:, 2:], first)])


def _best_inside(edges: list[np.ndarray], looked: dict[tuple[int, int], tuple[np.ndarray, float, float, float, float]], min_rows: int):
    """The best split between two values of one bin, if there is any, of the bins in a lot."""
    schema = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("gain", pa.float64()), ("feature", pa.int32()), *((c, pa.float64()) for c in ("low", "high", "le", "lw", "ls"))])

    def run(table: pa.Table) -> pa.Table:
        tree, node = (table.column(c)[0].as_py() for c in ("tree", "node"))
        inside, n, w, s = looked[tree, node]
        rows = np.concatenate([np.frombuffer(b.as_buffer()).reshape(-1, 6) for b in table.column("block")])
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        rows = _merged_values(rows, np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(1))))
        best = None
        for f in np.unique(rows[:, 0]).astype(int):
            mine = rows[rows[:, 0] == f]
            bin_ = np.searchsorted(edges[f], mine[:, 1], "left")
            for first, end in zip(*_spans(bin_)):
                before = inside[(inside["feature"] == f) & (inside["bin"] == bin_[first])][0]
                left = np.cumsum(mine[first : end - 1, 2:], 0) if end - first > 1 else np.zeros((0, 4))
                ln, lw, ls = left[:, 1] + before["rows"], left[:, 2] + before["w"], left[:, 3] + before["s"]
                fits = np.flatnonzero((ln >= min_rows) & (n - ln >= min_rows))
                if not len(fits):
                    continue
                gain = _gain(lw[fits], ls[fits], w, s)
                k = int(np.argmax(gain))
                if best is None or gain[k] > best[2]:
                    at = fits[k]
                    best = (tree, node, gain[k], f, mine[first + at, 1], mine[first + at + 1, 1], left[at, 0] + before["items"], lw[at], ls[at])
        return pa.table([pa.array([v] if best else [], kind) for v, kind in zip(best or schema.names, schema.types)], schema=schema)

    return run


def _spans(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin and end."""
    begins = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return begins, np.append(begins[1:], len(values))


def _best_splits(rows: DataFrame, tops: dict[int, Top], open_: dict[int, list[int]], cuts: Cuts, most: int, seed: int, bootstrap: bool, min_rows: int) -> list[dict]:
    """Per open node its sums and its best split, between all the values that it has.

    A first pass sums bins; of a feature of many values it compares the splits between bins, and says inside of which bins a better one
    may lie. A second pass looks at their values, in lots of some ``most`` items.
    """
    edges, wide = cuts.edges, cuts.wide()
    bins = [len(e) + 1 for e in edges]
    places = _places(bins, wide)
    sums = rows.mapInArrow(_histograms(tops, open_, edges, seed, bootstrap, cuts.mean, wide), "tree int, node int, sums binary")
    schema = "tree int, node int, gain double, feature int, bin int, le double, lw double, ls double, e double, w double, s double, next int, low double, high double, n double, mixed boolean, inside binary"
    with tidied(rows.sparkSession):
        listed = sums.groupBy("tree", "node").applyInArrow(_best_split(bins, min_rows, wide), schema).collect()  # one row per open node
    found, looked, lots = {}, {}, {}
    for r in listed:
        one = found[r.tree, r.node] = r.asDict()
        inside = np.frombuffer(one.pop("inside"), INSIDE)
        if r.gain is not None and cuts.few[r.feature]:
            one["low"], one["high"] = (float(cuts.values[r.feature][k]) for k in (r.bin, r.next))
        if r.mixed and len(inside):
            looked[r.tree, r.node] = inside, r.n, r.w, r.s
            if r.tree not in lots:
                lots[r.tree] = open_[r.tree], np.full((len(open_[r.tree]), sum(bins[f] for f in wide)), -1, np.int32)
            begins = np.array([places[f].start for f in inside["feature"].tolist()])
            lots[r.tree][1][open_[r.tree].index(r.node), begins + inside["bin"]] = (np.cumsum(inside["held"]) - inside["held"]) // most
    if looked:
        values = rows.mapInArrow(_values_inside(tops, lots, edges, wide, cuts.mean, seed, bootstrap), "tree int, node int, lot int, block binary")
        schema = "tree int, node int, gain double, feature int, low double, high double, le double, lw double, ls double"
        with tidied(rows.sparkSession):
            inner = values.groupBy("tree", "node", "lot").applyInArrow(_best_inside(edges, looked, min_rows), schema).collect()  # a row per node and lot
        for r in inner:
            one = found[r.tree, r.node]
            rank = lambda d: (-d["gain"], d["feature"], d["low"])
            if one["gain"] is None or rank(r.asDict()) < rank(one):
                one |= r.asDict()
    return list(found.values())


def _raised(rows: DataFrame, tops: dict[int, Top], n: int, cuts: Cuts | None, most: int, seed: int, bootstrap: bool, max_depth: int | None, min_rows: int) -> None:
    """Split the nodes of more than ``most`` items, a level in a pass, by the rule of ``grown``: all values are tried, whatever the number of items."""
    open_ = {t: [0] for t in tops} if n > most else {}
    # where all values are bins: those of each feature that a node may hold; one bin each: its rows agree in all features and are a leaf
    boxes = {(t, 0): [(0, len(e)) for e in cuts.edges] for t in open_} if open_ and all(cuts.few) else {}
    while open_:
        found = _best_splits(rows, tops, open_, cuts, most, seed, bootstrap, min_rows)
        open_ = {}
        for r in found:
            top, node = tops[r["tree"]], r["node"]
            top.cover[node] = r["w"]
            if r["gain"] is None or not r["mixed"] or (max_depth is not None and top.depth[node] >= max_depth):
                top.value[node] = r["s"] / r["w"] + cuts.mean
                continue
            threshold = float(_between(np.array([r["low"]]), np.array([r["high"]]))[0])
            top.feature[node], top.threshold[node], top.gain[node] = r["feature"], threshold, max(r["gain"], 0.0)
            top.left[node], top.right[node] = (top.add(w, top.depth[node] + 1) for w in (r["lw"], r["w"] - r["lw"]))
            box = boxes.pop((r["tree"], node), None)
            for child, size, right, mean in ((top.left[node], r["le"], False, r["ls"] / r["lw"]), (top.right[node], r["e"] - r["le"], True, (r["s"] - r["ls"]) / (r["w"] - r["lw"]))):
                inside = box and [*box]
                if box:
                    low, high = box[r["feature"]]
                    inside[r["feature"]] = (r["next"], high) if right else (low, r["bin"])
                if inside and all(a == b for a, b in inside):
                    top.value[child] = mean + cuts.mean
                elif size > most:
                    open_.setdefault(r["tree"], []).append(child)
                    if box:
                        boxes[r["tree"], child] = inside


def _cuts(rows: DataFrame, width: int) -> Cuts:
    """Per feature its values, if there are VALUES of them or so at most, or else quantiles; and the mean label."""
    shares = [k / BINS for k in range(1, BINS)]
    one = [F.col("x")[f] for f in range(width)]
    with tidied(rows.sparkSession):
        sizes = rows.agg(*(F.approx_count_distinct(c).alias(f"c{f}") for f, c in enumerate(one))).first()
        few = [size <= VALUES for size in sizes]
        found = rows.agg(F.avg("y").alias("mean"), *(F.collect_set(c).alias(f"c{f}") if few[f] else F.percentile_approx(c, shares, 10_000).alias(f"c{f}") for f, c in enumerate(one))).first()
    values = [np.unique(np.array(c, float)) for c in found[1:]]
    ends = [v[:-1] if few[f] else np.append(v[np.isfinite(v)], np.inf) for f, v in enumerate(values)]
    return Cuts(ends, values, few, found[0] if np.isfinite(found[0]) else 0.0)


def grow(train: DataFrame, features: list[str], target: str, trees: int, max_depth: int | None, seed: int, min_rows: int = 1, bootstrap: bool = True) -> Forest:
    """A forest over all features per split, on rows without nulls; every tree draws its rows anew.

    Parts hold CELLS values at most, unless rows agree in all features; those become one leaf. Rows that agree in
    features and label are drawn one by one, but held once.
    Trees are split above the parts TREES_AT_ONCE at a time, fewer where the nodes there would be many, and dealt out some DEALT bytes at a time.
    """
    spark = train.sparkSession
    x = F.array(*(F.col(f"`{f}`").cast("double") for f in features))
    single = written(train.select(F.monotonically_increasing_id().alias("row"), x.alias("x"), F.col(target).cast("double").alias("y")), "train")
    rows = written(_items(single), "items")
    n = rows.count()
    if not n:
        raise ValueError("no complete training row")
    most = max(1, CELLS // len(features))
    cuts = _cuts(single, len(features)) if n > most else None
    tops, tables = [Top() for _ in range(trees)], []
    at_once, dealt_at_once = max(1, min(TREES_AT_ONCE, PARTS_AT_ONCE * most // n)), max(FEWEST, DEALT // (n * (8 * len(features) + 16)))
    for begin in range(0, trees, at_once):
        raised = {t: tops[t] for t in range(begin, min(trees, begin + at_once))}
        _raised(rows, raised, n, cuts, most, seed, bootstrap, max_depth, min_rows)
        for first in range(begin, begin + len(raised), dealt_at_once):
            some = {t: top for t, top in raised.items() if first <= t < first + dealt_at_once}
            count = sum(len(t.parts()) - len(t.value) for t in some.values())
            dealt = rows.mapInArrow(_blocks(some, seed, bootstrap), "tree int, part int, kind string, block binary").repartition(max(1, min(count, 2000)), "tree", "part")
            grown_ = dealt.groupBy("tree", "part").applyInArrow(_growing(len(features), some, max_depth, min_rows), PART)
            alone = {"left": [-1], "right": [-1], "feature": [-1], "threshold": [0.0], "gain": [0.0]}
            whole = [tuple(_packed(t, p, alone | {"value": [v], "cover": [top.cover[p]]}).values()) for t, top in some.items() for p, v in top.value.items()]
            tables.append(written(grown_.unionByName(spark.createDataFrame(whole, PART)) if whole else grown_, "trees"))
    parts = tables[0]
    for more in tables[1:]:
        parts = parts.unionAll(more)
    return Forest(parts, tops, features)


def _met(x: np.ndarray, top: Top) -> np.ndarray:
    return reached(x, top.left, top.right, top.feature, top.threshold)


def _counted(tops: list[Top]):
    """How many points fall into each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(len(top.left), np.int64) for top in tops]
        for batch in _lots(batches):
            x = _matrix(batch)
            for k, top in enumerate(tops):
                sums[k] += np.bincount(_met(x, top), minlength=len(top.left))
        for tree, s in enumerate(sums):
            part = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), tree), pa.int32()), pa.array(part, pa.int32()), pa.array(s[part])], names=["tree", "part", "n"])

    return run


def _scoring_blocks(tops: dict[int, Top], slots: dict[tuple[int, int], int]):
    """A block of point numbers and values per batch, slot and part: of each tree the part a point falls in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _lots(batches):
            x, point = _matrix(batch), batch.column("point").to_numpy()
            for tree, top in tops.items():
                part, held = _met(x, top), []
                for p in np.unique(part):
                    mine = np.flatnonzero(part == p)
                    slot = point[mine] % slots[tree, int(p)]
                    for s in np.unique(slot):
                        some = mine[slot == s]
                        held.append((int(p), int(s), point[some].tobytes(), x[some].tobytes()))
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * len(held), pa.int32()), *(pa.array([h[k] for h in held], kind) for k, kind in enumerate(kinds))],
                    names=["tree", "part", "slot", "points", "block"],
                )

    return run


def _table(spark, kinds: dict[str, pa.DataType], rows: list[tuple]) -> DataFrame:
    """A few rows of the driver, which no Python worker has to unpack."""
    return spark.createDataFrame(pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], names=list(kinds)))


def points_of(forest: Forest, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their features ``_x``, features ``x`` by ``point``), both written: rows of equal features are one point, rows with a null none."""
    x = F.array(*(F.col(f"`{f}`").cast("double") for f in forest.features))
    rows = written(df.withColumn("_x", x), "scored")
    # numbers of a partition follow each other, so that their remainders spread evenly
    return rows, written(rows.where(~F.exists("_x", lambda v: v.isNull())).select(F.col("_x").alias("x")).distinct().select(F.monotonically_increasing_id().alias("point"), "x"), "points")


def held_points(rows: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, numbers) of the points in all blocks of a task."""
    whole = [np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in rows.column(c)]) if rows.num_rows else np.zeros(0, kind) for c, kind in (("points", np.int64), ("block", np.float64))]
    return whole[1].reshape(-1, width), whole[0]


def summed(found: DataFrame) -> DataFrame:
    """Sums of all columns by point, named alike."""
    return found.groupBy("point").agg(*(F.sum(c).alias(c) for c in found.columns if c != "point"))


def scored_parts(
    forest: Forest, df: DataFrame, score, schema: str, needed: tuple[str, ...] = ("left", "right", "feature", "threshold", "value", "cover"), slot: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with their features ``_x``, features ``x`` by ``point``, what ``score(x, points, tree, part, nodes)`` returns for points and parts that meet).

    Rows of equal features are one point. Points are dealt to the parts in blocks and meet the node table there, by tree, part and a slot of
    some ``slot`` points (SLOT without it), so that neither a part's points nor the forest lie in one task. A part has the slots that its own points need,
    and its ``needed`` columns are copied to each of them. Where that would deal out more than some DEALT bytes, it is done for a few trees at a time,
    whose findings are summed by point and written.
    """
    spark, width = df.sparkSession, len(forest.features)
    rows, points = points_of(forest, df)
    dealing = _spread(points)
    with tidied(spark):
        found = dealing.mapInArrow(_counted(forest.tops), "tree int, part int, n long").groupBy("tree", "part").agg(F.sum("n").alias("n")).collect()  # a number per part
    sizes = {(r.tree, r.part): r.n for r in found}
    slots = {k: max(1, -(-n // (slot or SLOT))) for k, n in sizes.items()}
    keys = ["tree", "part", "slot"]

    def run(key, rows: pa.Table, nodes: pa.Table) -> pa.Table:
        one = _opened({c: nodes.column(c)[0] for c in needed}, needed)
        return score(*held_points(rows, width), key[0].as_py(), key[1].as_py(), one)

    def met(trees: range) -> DataFrame:
        mine = {k: n for k, n in slots.items() if k[0] in trees}
        listed, tasks = _table(spark, {"tree": pa.int32(), "part": pa.int32(), "slots": pa.int32()}, [(*k, n) for k, n in mine.items()]), max(1, min(2000, sum(mine.values())))
        dealt = dealing.mapInArrow(_scoring_blocks({t: forest.tops[t] for t in trees}, mine), "tree int, part int, slot int, points binary, block binary").repartition(tasks, *keys)
        parts = forest.parts.where(F.col("tree").between(trees[0], trees[-1])).select("tree", "part", *needed).join(F.broadcast(listed), ["tree", "part"])
        parts = parts.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1))).repartition(tasks, *keys)
        return dealt.groupBy(*keys).cogroup(parts.groupBy(*keys)).applyInArrow(run, schema)

    trees = len(forest.tops)
    at_once = max(FEWEST, DEALT // (8 * (width + 3) * max(1, sum(sizes.values()) // trees)))
    passes = [range(t, min(trees, t + at_once)) for t in range(0, trees, at_once)]
    whole = met(passes[0]) if len(passes) == 1 else None
    for some in passes if whole is None else ():
        one = written(summed(met(some)), "met")
        whole = one if whole is None else whole.unionAll(one)
    return rows, points, whole


def on_rows(rows: DataFrame, points: DataFrame, sums: DataFrame) -> DataFrame:
    """What was found for each point (of ``sums``, by ``point``) on all rows of its features, without numbers and ``_x``."""
    # by a digest first: arrays sort slowly. Points are copied as often as rows repeat them at most
    digest = lambda df, x: df.withColumn("_digest", F.xxhash64(x))
    salts = max(1, min(SALTS, rows.count() // max(1, points.count())))
    return spread_join(digest(rows, "_x"), digest(points.join(sums, "point").drop("point"), "x"), "_digest", also=F.col("_x") == F.col("x"), salts=salts).drop("_x", "x", "_digest")


def predicted(forest: Forest, df: DataFrame, name: str = "raw_prediction") -> DataFrame:
    """The rows with the forest's mean prediction; null where a feature is null."""
    trees = len(forest.tops)

    def score(x, point, tree, part, nodes):
        leaf = reached(x, nodes["left"], nodes["right"], nodes["feature"], nodes["threshold"])
        return pa.table({"point": pa.array(point), "value": pa.array(nodes["value"][leaf])})

    needed = ("left", "right", "feature", "threshold", "value")
    rows, points, values = scored_parts(forest, df, score, "point long, value double", needed=needed, slot=max(1, CELLS // max(1, len(forest.features))))
    return on_rows(rows.drop(name), points, values.groupBy("point").agg((F.sum("value") / trees).alias(name)))


def importances(forest: Forest) -> DataFrame:
    """(feature, importance): how much of a tree's error its splits on a feature take away, on average over the trees."""
    spark, names = forest.parts.sparkSession, forest.features
    inner = forest.parts.select("tree", "gains").mapInArrow(_by_feature, "tree int, feature int, gain double")
    above = [(t, top.feature[k], top.gain[k]) for t, top in enumerate(forest.tops) for k in range(len(top.left)) if top.left[k] >= 0]
    gains = inner.unionByName(_table(spark, {"tree": pa.int32(), "feature": pa.int32(), "gain": pa.float64()}, above)).groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    total = F.sum("gain").over(Window.partitionBy("tree"))
    share = gains.select("feature", F.try_divide(F.col("gain"), total).alias("share")).groupBy("feature").agg(F.sum("share").alias("share"))
    every = _table(spark, {"feature": pa.int32(), "name": pa.string()}, list(enumerate(names))).join(F.broadcast(share), "feature", "left")
    part = F.coalesce("share", F.lit(0.0))
    return every.select(F.col("name").alias("feature"), part.alias("share")).withColumn("importance", F.coalesce(F.try_divide("share", F.sum("share").over(Window.partitionBy(F.lit(0)))), F.lit(0.0))).drop("share")
