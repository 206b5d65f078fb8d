"""Language identification by nearest centroid over TF-IDF vectors of hashed byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.text import bounded_batches, pieces, raw, staged

#: Vector entries; trigrams of bytes are hashed to them.
SIZE = 4096
#: Centroids per language; rows per language, at the mean, that the clustering looks at.
CLUSTERS, SAMPLE = 4, 1000
#: A text is rejected if its cosine lies under this part of what nearly all sampled texts of the language reach.
REJECT = 0.5

_FOLD = np.array([c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)], np.uint8)


def term_counts(texts: list[bytes]) -> np.ndarray:
    """Counts of the hashed trigrams of each text, lower-cased, all but letters read as spaces."""
    joined = np.frombuffer(b"".join(b" " + t + b" " for t in texts), np.uint8)
    codes = _FOLD[joined].astype(np.uint32)
    stops = np.cumsum([len(t) + 2 for t in texts])
    of = np.repeat(np.arange(len(texts), dtype=np.int64), [len(t) + 2 for t in texts])[:-2]
    gram = codes[:-2] << np.uint32(16) | codes[1:-1] << np.uint32(8) | codes[2:]
    keep = (gram != 0x202020) & (np.arange(len(gram)) + 2 < stops[of])
    term = (gram * np.uint32(2654435761)) >> np.uint32(20)
    return np.bincount(of[keep] * SIZE + term[keep], minlength=len(texts) * SIZE).reshape(len(texts), SIZE)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of damped counts times inverse document frequencies; a text without terms is all zeros."""
    out = np.zeros(counts.shape, np.float32)
    row, term = np.nonzero(counts)
    out[row, term] = (1 + np.log(counts[row, term])) * idf[term]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def _document_frequencies(rows: DataFrame) -> np.ndarray:
    """Inverse document frequencies over all rows: partial counts per task, summed per entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(SIZE, np.int64), 0
        for batch in pieces(batches, "text"):
            total += (term_counts(raw(batch, "text")) > 0).sum(0)
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([[n, *total.tolist()]], pa.list_(pa.int64()))], names=["df"])

    sums = rows.select("text").mapInArrow(run, "df array<long>").select(F.posexplode("df")).groupBy("pos").agg(F.sum("col").alias("n"))
    found = np.zeros(SIZE + 1)
    for r in sums.collect():
        found[r.pos] = r.n
    return np.log((1 + found[0]) / (1 + found[1:])) + 1


def cluster(points: np.ndarray, k: int, steps: int = 20) -> np.ndarray:
    """Unit centroids by spherical k-means; the first is nearest to the mean, each next one farthest from those before."""
    mean = points.mean(0)
    chosen = [int(np.argmax(points @ mean))]
    while len(chosen) < min(k, len(points)):
        chosen.append(int(np.argmin((points @ points[chosen].T).max(1))))
    centres = points[chosen]
    for _ in range(steps):
        own = (points @ centres.T).argmax(1)
        sums = np.stack([points[own == j].sum(0) if (own == j).any() else centres[j] for j in range(len(centres))])
        new = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, centres, atol=1e-6):
            break
        centres = new
    return centres


class Model:
    def __init__(self, idf: np.ndarray, languages: list[str], centres: np.ndarray, least: np.ndarray):
        self.idf, self.languages, self.centres, self.least = idf, languages, centres, least

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine with its nearest centroid, and whether that is too far away."""
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        near = vectors(term_counts(texts), self.idf) @ self.centres.T
        best = near.argmax(1)
        score = np.clip(near[np.arange(len(texts)), best].astype(float), 0, 1)
        lettered = np.array([any(map(str.isalpha, t.decode("utf-8", "ignore"))) for t in texts], bool)
        return (
            [self.languages[b] if ok else "und" for b, ok in zip(best, lettered)], np.where(lettered, score, 0.0),
            ~lettered | (score < self.least[best]),
        )


def fit(labelled: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model:
    """A model from ``text`` and ``lang`` of all rows where neither is null.

    Document frequencies count every row. The centroids come from at most ``sample`` distinct texts
    of each language, those whose hash is small enough, clustered in one task per language; the counts
    that the draw needs, a number per language, are broadcast, so that only drawn texts are shuffled,
    copies of one text as one.
    What is sent to the driver are the frequencies and the centroids, whose size, thousands of
    times that of the counts, follows the number of languages alone.
    """
    bounded_batches(labelled.sparkSession)
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang"))
    idf = _document_frequencies(rows)
    rows = rows.withColumn("h", F.xxhash64(F.lit("langid"), "text"))
    counts = rows.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    drawn = F.pmod("h", F.lit(1 << 32)) * F.col("n") < F.lit(sample) * F.lit(1 << 32)

    def centres(pdf: pd.DataFrame) -> pd.DataFrame:
        points = vectors(term_counts([t.encode() for t in sorted(pdf.text)]), idf)
        found = cluster(points, clusters)
        least = float(np.quantile((points @ found.T).max(1), 0.005)) * REJECT
        return pd.DataFrame({"lang": pdf.lang.iloc[0], "least": least, "c": [c.tolist() for c in found]})

    near = rows.join(F.broadcast(counts), "lang").where(drawn).groupBy("lang", "h").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 32)), "h")
    near = near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= sample).select("lang", "text")
    found = sorted(near.groupBy("lang").applyInPandas(centres, "lang string, least double, c array<float>").collect(), key=lambda r: (r.lang, r.c))
    return Model(idf, [r.lang for r in found], np.array([r.c for r in found], np.float32), np.array([r.least for r in found]))


def predicted(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score, rejected) for every row, from the whole text.

    ``lang_pred`` is the language of the nearest centroid and ``score`` its cosine; ``rejected``
    says that even this one is too far away. Null texts and texts without a letter are ``und``
    with score 0, rejected. Ties go to the language that sorts first; a model without languages
    says ``und``. Repeated rows get equal results; extra columns are ignored.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            names, score, rejected = model.predict(raw(batch, "_text"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)], names=["key", "lang_pred", "score", "rejected"])

    kind = docs.schema[key].dataType.simpleString()
    found = docs.select(F.col(key).alias("key"), F.col("text").alias("_text")).mapInArrow(run, f"key {kind}, lang_pred string, score double, rejected boolean")
    return found.withColumnRenamed("key", key)
