"""Quality rules: base rules and robust multivariate outliers per language and source."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.llm.text import WordHashes, bounded_batches, chained, pieces, raw, staged
from tidemark.operators.skew import spread_join

#: Counts of a text, in the order of the columns.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks"]
#: The statistics of a text that are compared, each on a scale of order 1.
VECTOR = ["x_length", "x_symbols", "x_repeats", "x_upper", "x_marks"]
#: Least standard deviation of each statistic, so that one which hardly varies in a cell does not
#: turn a single symbol or repeated phrase into an outlier.
FLOORS = [0.06, 0.04, 0.12, 0.08, 0.08]

_WHITE, _SYMBOL, _UPPER, _LETTER, _MARK, _REST, _LATER = range(7)


def _classes() -> np.ndarray:
    """The class of each byte: white space, symbol, letter, other mark; bytes inside a code point apart."""
    out = np.full(256, _REST, np.uint8)
    out[[0x20, *range(0x09, 0x0E)]] = _WHITE
    out[[ord(c) for c in "#*$%&|<>"]] = _SYMBOL
    out[[ord(c) for c in "!\"'()+,-./:;=?@[\\]^_`{}~"]] = _MARK
    out[ord("A") : ord("Z") + 1] = _UPPER
    out[ord("a") : ord("z") + 1] = _LETTER
    out[0xC0:] = _LETTER
    out[0x80:0xC0] = _LATER
    return out


_CLASS = _classes()


def _repeated(words: list[bytes], hashes: WordHashes) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    windows = chained(hashes.of(words), 3)[:n]
    order = np.argsort(windows)
    same = windows[order[1:]] == windows[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(n + 2, bool)
    for k in range(3):
        covered[k : k + n] |= twice
    return int(covered.sum())


def counts_of(texts: list[bytes], hashes: WordHashes) -> np.ndarray:
    """COUNTS of each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    kinds = _CLASS[np.frombuffer(b"".join(texts), np.uint8)]
    ends = np.cumsum(sizes)
    totals = lambda mask: np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(mask)])[ends]]))
    white, symbols, upper, marks = (totals(kinds == k) for k in (_WHITE, _SYMBOL, _UPPER, _MARK))
    letters, points = totals((kinds == _LETTER) | (kinds == _UPPER)), totals(kinds != _LATER)
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    for k, text in enumerate(texts):
        words = text.split()
        lines = [x for x in text.split(b"\n") if x.strip()]
        out[k, 0], out[k, 3], out[k, 4], out[k, 5] = len(words), len(lines) - len(set(lines)), _repeated(words, hashes), len(lines)
    out[:, 1], out[:, 2], out[:, 6], out[:, 7], out[:, 8] = points - white, symbols, upper, letters, marks
    return out


def with_counts(rows: DataFrame, key: list[str]) -> DataFrame:
    """COUNTS of ``text`` beside the key columns."""
    bounded_batches(rows.sparkSession)
    schema = T.StructType([*rows.select(*key).schema.fields, *(T.StructField(c, T.LongType()) for c in COUNTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces(batches, "text"):
            found = counts_of(raw(batch, "text"), hashes)
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in key] + [pa.array(found[:, k]) for k in range(len(COUNTS))], names=key + COUNTS)

    return rows.select(*key, "text").mapInArrow(run, schema)


def base_failed() -> Column:
    """Under 50 words, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector() -> list[Column]:
    """Logarithms of ratios and arcsines of shares; short texts lean to the usual value."""
    share = lambda n, of, usual, weight: F.asin(F.sqrt(F.least(F.lit(1.0), (F.col(n) + usual * weight) / (F.col(of) + weight))))
    return [
        F.log((F.col("word_chars") + 275) / (F.col("n_words") + 50)).alias("x_length"), share("n_symbols", "word_chars", 0, 60).alias("x_symbols"),
        share("n_repeat_words", "n_words", 0, 50).alias("x_repeats"), share("n_upper", "n_letters", 0.02, 200).alias("x_upper"),
        share("n_marks", "word_chars", 0.02, 200).alias("x_marks"),
    ]


#: Distinct texts that the estimates of all texts count for in those of a language, and these in those of a language and source.
PRIOR = 20
#: Part of the texts that determines the estimates (with (p + 1) / 2 more, for the highest breakdown
#: point), and steps for all starts and for the best one.
SHARE, STEPS, MORE_STEPS = 0.5, 4, 6
#: Chi-square quantile 0.975 with five degrees of freedom, for the reweighted estimates.
INNER = 12.83
#: Squared distance beyond which a text is rejected; a clean text stays under 10.
CUTOFF = 25.0

_PAIRS = list(combinations_with_replacement(range(len(VECTOR)), 2))
_PARAMS = "cell string, start int, m array<double>, p array<double>, size double"


def _named(vectors: DataFrame) -> DataFrame:
    """The rows with the names of their cells, one of language and source within one of the language within one of all."""
    label = lambda *c: F.to_json(F.array(*(F.coalesce(F.concat(F.lit("="), x), F.lit("null")) for x in c)))
    return vectors.withColumns({"own": label(F.col("lang"), F.col("source")), "of_lang": label(F.col("lang")), "of_all": F.lit("[]")})


def _chi_square(x: float, k: int) -> float:
    """Distribution function of chi-square with an odd number of degrees of freedom."""
    out = math.erf(math.sqrt(x / 2))
    for d in range(1, k, 2):
        out -= (x / 2) ** (d / 2) * math.exp(-x / 2) / math.gamma(d / 2 + 1)
    return out


def _consistency(share: float) -> float:
    """What makes the scatter of the nearest ``share`` of normal rows that of all of them."""
    if share >= 1:
        return 1.0
    low, high, k = 0.0, 200.0, len(VECTOR)
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi_square(mid, k) < share else (low, mid)
    return share / _chi_square(high, k + 2)


def _estimate(n: float, first: np.ndarray, second: np.ndarray, origin: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Mean, precision (upper triangle, off-diagonal entries doubled) and log-determinant from sums about an origin.

    On scales where each floor is 1, no direction has a standard deviation under 1.
    """
    mean, cov = first / n, np.zeros((len(VECTOR),) * 2)
    for (i, j), v in zip(_PAIRS, second):
        cov[i, j] = cov[j, i] = v / n - mean[i] * mean[j]
    values, axes = np.linalg.eigh(factor * cov / np.outer(FLOORS, FLOORS))
    values = np.maximum(values, 1)
    inverse = (axes / values) @ axes.T / np.outer(FLOORS, FLOORS)
    return origin + mean, np.array([inverse[i, j] * (1 if i == j else 2) for i, j in _PAIRS]), float(np.log(values).sum())


def _starts(cells: DataFrame) -> DataFrame:
    """Four starts per cell: medians with quartile ranges, all rows, rows drawn in to the medians, and shortest halves.

    With over a quarter of junk on one side a quartile lies in the junk; the shortest half does not.
    """
    grid = 256.0
    parts = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.floor(F.col(c) * grid).alias("bin")) for k, c in enumerate(VECTOR))))
    bins = cells.select("cell", parts.alias("v")).groupBy("cell", "v.k", "v.bin").agg(F.count(F.lit(1)).alias("n"))

    def quartiles(pdf: pd.DataFrame) -> pd.DataFrame:
        middle, width, centre, narrow = [], [], [], []
        for k in range(len(VECTOR)):
            own = pdf[pdf.k == k].sort_values("bin")
            upto = own.n.cumsum().to_numpy()
            low, mid, high = ((own.bin.to_numpy()[np.searchsorted(upto, q * upto[-1])] + 0.5) / grid for q in (0.25, 0.5, 0.75))
            middle.append(mid)
            width.append(max((high - low) / 1.349, FLOORS[k]))
            at, before = own.bin.to_numpy(), upto - own.n.to_numpy()
            froms = np.flatnonzero(before <= upto[-1] / 2)
            tos = np.searchsorted(upto, before[froms] + upto[-1] / 2)
            best = np.argmin(at[tos] - at[froms])
            low, high = at[froms[best]] / grid, (at[tos[best]] + 1) / grid
            centre.append((low + high) / 2)
            narrow.append(max((high - low) / 1.349, FLOORS[k]))
        p, q = ([1 / w[i] ** 2 if i == j else 0.0 for i, j in _PAIRS] for w in (width, narrow))
        return pd.DataFrame({"cell": [pdf.cell.iloc[0]] * 2, "start": [0, 3], "m": [middle, centre], "p": [p, q], "size": [0.0] * 2})

    first = staged(bins.groupBy("cell").applyInPandas(quartiles, _PARAMS), "start")
    near = cells.join(first.where("start = 0").drop("start"), "cell")
    y = [F.col(c) - F.col("m")[k] for k, c in enumerate(VECTOR)]
    wide = [2 / F.sqrt(F.col("p")[k]) for k in (_PAIRS.index((i, i)) for i in range(len(VECTOR)))]
    both = near.select("cell", "m", F.explode(F.array(
        F.struct(F.lit(1).alias("start"), F.array(*y).alias("y")),
        F.struct(F.lit(2).alias("start"), F.array(*(F.greatest(-w, F.least(w, v)) for v, w in zip(y, wide))).alias("y")),
    )).alias("s")).select("cell", "m", "s.*")
    sums = _sums(both, [F.col("y")[k] for k in range(len(VECTOR))], "cell", "start").withColumn("bin", F.lit(0))
    return first.unionAll(_updated(sums, 1.0, None))


def _sums(rows: DataFrame, y: list[Column], *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.any_value("m").alias("m"), F.array(*(F.sum(v) for v in y)).alias("first"),
        F.array(*(F.sum(y[i] * y[j]) for i, j in _PAIRS)).alias("second"),
    )


#: Bins of the distances for each doubling.
_FINE = 16


def _updated(sums: DataFrame, share: float, limit: float | None) -> DataFrame:
    """New estimates per cell and start from the nearest bins: those of ``share`` of the rows, or under ``limit``.

    Of the last bin for ``share`` only the part that is needed counts, so that copies in one bin do not raise the share.
    """

    def update(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        upto = pdf.n.cumsum().to_numpy()
        n = upto[-1]
        rows = min(n, share * n + (len(VECTOR) + 1) / 2)
        last = np.searchsorted(upto, rows - 1e-9) if limit is None else max(0, (pdf.bin <= np.log2(limit) * _FINE).sum() - 1)
        own, weight = pdf.iloc[: last + 1], np.ones(last + 1)
        if limit is None:
            weight[-1] -= (upto[last] - rows) / own.n.iloc[-1]
        total = lambda c: weight @ np.array(own[c].tolist())
        m, p, size = _estimate(total("n"), total("first"), total("second"), np.array(own.m.iloc[0]), _consistency(rows / n) if limit is None else 1.0)
        return pd.DataFrame({"cell": [pdf.cell.iloc[0]], "start": [int(pdf.start.iloc[0])], "m": [m], "p": [p], "size": [size]})

    return sums.groupBy("cell", "start").applyInPandas(update, _PARAMS)


def _distance() -> Column:
    y = [F.col(c) - F.col("m")[k] for k, c in enumerate(VECTOR)]
    return sum(F.col("p")[k] * y[i] * y[j] for k, (i, j) in enumerate(_PAIRS))


def _step(cells: DataFrame, params: DataFrame, limit: float | None = None) -> DataFrame:
    """A concentration step: one pass that sums the rows by cell, start and bin of distance, pre-aggregated."""
    near = cells.join(params, "cell").withColumn("bin", F.floor(F.log2(_distance() + 1e-9) * _FINE).cast("int"))
    sums = _sums(near, [F.col(c) - F.col("m")[k] for k, c in enumerate(VECTOR)], "cell", "start", "bin")
    return staged(_updated(sums, SHARE, limit), "step")


def estimates(cells: DataFrame) -> DataFrame:
    """Reweighted minimum-covariance-determinant estimates per cell: location ``m`` and precision ``p``.

    Rows with equal statistics (copies) count once: else a text copied for a third of the rows is the tightest half.
    """
    cells = staged(cells.select("cell", *VECTOR).distinct(), "texts")
    params = staged(_starts(cells), "starts")
    for _ in range(STEPS):
        params = _step(cells, params)
    best = Window.partitionBy("cell").orderBy("size", "start")
    params = params.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank")
    for _ in range(MORE_STEPS):
        params = _step(cells, params)
    return _step(cells, params, INNER).select("cell", "m", "p")


def _matrix(p: np.ndarray) -> np.ndarray:
    """The symmetric matrix of an upper triangle whose off-diagonal entries are doubled."""
    out = np.zeros((len(VECTOR),) * 2)
    for (i, j), v in zip(_PAIRS, p):
        out[i, j] = out[j, i] = v if i == j else v / 2
    return out


def leaning(n: float, m: np.ndarray, p: np.ndarray, m0: np.ndarray, p0: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The estimates of ``n`` texts drawn to those of their pool, which count for PRIOR texts: of the mixture of both."""
    w, d = n / (n + PRIOR), m - m0
    scatter = w * np.linalg.inv(_matrix(p)) + (1 - w) * np.linalg.inv(_matrix(p0)) + w * (1 - w) * np.outer(d, d)
    inverse = np.linalg.inv(scatter)
    return m0 + w * d, np.array([inverse[i, j] * (1 if i == j else 2) for i, j in _PAIRS])


def cell_estimates(named: DataFrame) -> DataFrame:
    """(own, m, p) of each language and source: its estimates, drawn to those of the language, and these to those of all texts."""
    distinct = staged(named.select("own", "of_lang", "of_all", *VECTOR).distinct(), "vectors")
    found = staged(estimates(distinct.select(F.explode(F.array("own", "of_lang", "of_all")).alias("cell"), *VECTOR)), "estimates")
    sizes = distinct.groupBy("own", "of_lang", "of_all").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.join(sizes.groupBy("of_lang").agg(F.sum("n").alias("n_lang")), "of_lang")
    for k, cell in enumerate(("own", "of_lang", "of_all")):
        sizes = sizes.join(found.select(F.col("cell").alias(cell), F.col("m").alias(f"m{k}"), F.col("p").alias(f"p{k}")), cell)

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                m, p = leaning(r.n_lang, np.array(r.m1), np.array(r.p1), np.array(r.m2), np.array(r.p2))
                rows.append((r.own, *leaning(r.n, np.array(r.m0), np.array(r.p0), m, p)))
            yield pd.DataFrame(rows, columns=["own", "m", "p"])

    return staged(sizes.mapInPandas(drawn, "own string, m array<double>, p array<double>"), "cells")


def judged(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: doc_id, mark (hash of the text), COUNTS, base_failed, distance, kept.

    A text fails the base rules with under 50 words or with more than half of its words in 3-word
    windows found twice. Of the others, the statistics of VECTOR are compared within language and
    source. Estimates come from all distinct texts of a cell: concentration steps from four starts,
    each a pre-aggregated sum per cell and bin of distance, keep the half of the texts with the
    smallest covariance determinant, scaled to the scatter of all, and one step reweights. A row goes
    if its squared Mahalanobis distance is over ``cutoff``. However small a cell is, it has estimates of
    its own; they are mixed with those of its language, which count for PRIOR texts, and these
    with those of all texts, so that a few texts do not judge each other alone.

    Null texts have no words, and fail. Null languages and sources are cells of their own. Repeated
    rows are each judged, and count once in the estimates. The distance is null where the base rules fail. Extra columns are ignored; an
    empty table gives no rows.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "text")
    stats = staged(with_counts(rows, ["doc_id", "mark", "lang", "source"]).withColumn("base_failed", base_failed()).select("*", *_vector()), "statistics")
    passed = _named(stats.where("NOT base_failed"))
    distances = spread_join(passed, cell_estimates(passed), "own").select(*stats.columns, _distance().alias("distance"))
    failed = stats.where("base_failed").withColumn("distance", F.lit(None).cast("double"))
    return distances.unionAll(failed).select("doc_id", "mark", *COUNTS, "base_failed", "distance", (~F.col("base_failed") & (F.col("distance") <= cutoff)).alias("kept"))


def accepted(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The documents that are kept, columns as they were. Rows equal in id and text stand or fall together."""
    bad = judged(docs, cutoff).where("NOT kept OR kept IS NULL").select("doc_id", "mark").distinct()
    same = F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & F.xxhash64(F.col("d.text")).eqNullSafe(F.col("b.mark"))
    return docs.alias("d").join(bad.alias("b"), same, "left_anti")
