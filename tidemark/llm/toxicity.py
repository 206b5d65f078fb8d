"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.text import bounded_batches, pieces, raw, staged

#: Labelled rows that are looked at, at most; a half of them finds the lexicon, three tenths fit the
#: trees and two tenths calibrate. No row serves two ends.
SAMPLE = 12_000
#: Entries of the lexicon, texts that an entry needs, and the least log-odds.
ENTRIES, LEAST_TEXTS, LEAST_ODDS = 300, 3, 3.0
#: Bytes of the word beginnings that are tried as entries, next to whole words.
SHORT, LONG = 4, 8
#: Words up to which an entry counts as near to an address.
NEAR = 5

# fixed values: words of address in the languages covered
ADDRESS = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu toi te ton ta tes vous votre vos "
    "usted ustedes ti tuyo vosotros os".encode().split()
)

FEATURES = ["density", "hits", "strongest", "near", "capitals", "marks", "shouts", "symbols", "mixed", "stretched", "length"]

_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A or 0x30 <= c <= 0x39 else 0x20 for c in range(256))
_KIND = np.zeros(256, np.uint8)
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[[*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]] = 2
_KIND[[ord(c) for c in ".,;:'\"()-"]] = 3
_KIND[[ord(c) for c in "!?"]] = 4
_KIND[[ord(c) for c in "#*$%&@|<>^~_+=/\\"]] = 5
_KIND[ord("0") : ord("9") + 1] = 6
_KIND[[0x20, *range(0x09, 0x0E)]] = 7


def entries_of(text: bytes) -> set[bytes]:
    """What of a text can be a lexicon entry: words of SHORT bytes and more, closed by a zero byte, and their beginnings."""
    out = set()
    for word in set(text.translate(_FOLD).split()):
        if len(word) >= SHORT:
            out.add(word + b"\0")
            out.update(word[:k] for k in range(SHORT, min(LONG, len(word)) + 1))
    return out


def lexicon_of(rows: list[tuple[bytes, int, int]], toxic: int, clean: int) -> dict[bytes, float]:
    """Entries with their log-odds from (entry, toxic texts, clean texts); none lies within a shorter one that is kept."""
    odds = lambda p, n: math.log((p + 0.5) / (toxic - p + 0.5)) - math.log((n + 0.5) / (clean - n + 0.5))
    good = [(e, p, odds(p, n)) for e, p, n in rows if p >= LEAST_TEXTS and odds(p, n) >= LEAST_ODDS]
    kept: dict[bytes, float] = {}
    for e, _, z in sorted(good, key=lambda x: (-x[1] * x[2], len(x[0]), x[0])):
        if len(kept) < ENTRIES and not any(e[:k] in kept for k in range(SHORT, len(e) + 1)):
            kept[e] = z
    return kept


def features(texts: list[bytes], lexicon: dict[bytes, float]) -> np.ndarray:
    """FEATURES of each text; an empty text has zeros."""
    gate, longest = {e[:SHORT] for e in lexicon}, max(map(len, lexicon), default=0)
    sizes = np.array([len(t) for t in texts], np.int64)
    joined = np.frombuffer(b"".join(texts), np.uint8)
    kinds, ends = _KIND[joined], np.cumsum(sizes)
    inside = np.ones(len(joined), bool)
    inside[(ends - sizes)[sizes > 0]] = False
    total = lambda mask: np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(mask)])[ends]]))
    after = np.concatenate([[0], kinds[:-1]])
    letter = lambda k: (k == 1) | (k == 2)
    again = np.concatenate([[False], joined[1:] == joined[:-1]])
    twice = np.concatenate([[False], again[:-1]])
    counts = {
        "upper": total(kinds == 1), "letters": total(letter(kinds)), "marks": total(kinds == 3), "shouts": total(kinds == 4),
        "symbols": total(kinds == 5), "mixed": total((((kinds == 5) | (kinds == 6)) & letter(after) | letter(kinds) & ((after == 5) | (after == 6))) & inside),
        "stretched": total(again & twice & letter(kinds) & inside),
    }
    out = np.zeros((len(texts), len(FEATURES)))
    for k, text in enumerate(texts):
        words = text.translate(_FOLD).split()
        found = {}
        for word in set(words):
            if word[:SHORT] in gate:
                closed = word + b"\0"
                z = max((lexicon.get(closed[:n], 0.0) for n in range(SHORT, min(longest, len(closed)) + 1)), default=0.0)
                if z > 0:
                    found[word] = z
        n = max(1, len(words))
        if found:
            places = [i for i, w in enumerate(words) if w in found]
            address = np.array([i for i, w in enumerate(words) if w in ADDRESS])
            near = sum(bool(len(address)) and np.abs(address - i).min() <= NEAR for i in places)
            out[k, :4] = len(places) / n, math.log1p(len(places)), max(found.values()), near / len(places)
        out[k, 10] = math.log1p(len(words))
    for j, (name, of) in enumerate((("upper", "letters"), ("marks", None), ("shouts", None), ("symbols", None), ("mixed", None), ("stretched", "letters"))):
        out[:, 4 + j] = counts[name] / np.maximum(1, counts[of] if of else sizes)
    return out


def with_features(docs: DataFrame, lexicon: dict[bytes, float], keep: list[str]) -> DataFrame:
    """The kept columns with FEATURES of ``text``."""
    bounded_batches(docs.sparkSession)
    schema = T.StructType([*docs.select(*keep).schema.fields, *(T.StructField(f, T.DoubleType()) for f in FEATURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            found = features(raw(batch, "_text"), lexicon)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(found[:, j]) for j in range(len(FEATURES))], names=keep + FEATURES)

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)


def _learn_lexicon(rows: DataFrame) -> dict[bytes, float]:
    """The lexicon from (_text, toxic) rows; texts per entry are counted in Spark."""
    bounded_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", 1 << 20):
            found = [[e.decode("latin-1") for e in entries_of(t)] for t in raw(batch, "_text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.string()))], names=["toxic", "entries"])

    counted = (
        rows.select("toxic", "_text").mapInArrow(run, "toxic int, entries array<string>").select("toxic", F.explode("entries").alias("entry"))
        .groupBy("entry").agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n")).where(F.col("p") >= LEAST_TEXTS)
    )
    sums = rows.agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n")).first()
    toxic, clean = sums.p or 0, sums.n or 0
    odds = F.log((F.col("p") + 0.5) / (toxic - F.col("p") + 0.5)) - F.log((F.col("n") + 0.5) / (clean - F.col("n") + 0.5))
    best = counted.where(odds >= LEAST_ODDS).orderBy(F.desc(F.col("p") * odds), "entry").limit(20 * ENTRIES)
    return lexicon_of([(r.entry.encode("latin-1"), r.p, r.n) for r in best.collect()], toxic, clean)


class Scorer:
    """A fitted lexicon, trees and calibration, or a constant where the labels have one class only."""

    def __init__(self, lexicon, trees, calibration, constant: float):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def scores(self, rows: DataFrame) -> DataFrame:
        """The rows with FEATURES replaced by ``score``."""
        if self.trees is None:
            return rows.drop(*FEATURES).withColumn("score", F.lit(self.constant))
        margin = _margin(self.trees, rows)
        if self.calibration is not None:
            margin = self.calibration.transform(margin.withColumn("_margin", F.col("score"))).withColumn("score", F.col("_calibrated")).drop("_margin", "_calibrated")
        return margin.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")))


def _margin(trees, rows: DataFrame) -> DataFrame:
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)
    return trees.transform(assembled).withColumn("score", vector_to_array("_probability")[1]).drop("_features", "_raw", "_probability", "_class", *FEATURES)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = 20, depth: int = 3, seed: int = 11) -> Scorer:
    """A scorer from the labelled documents: ``labels`` has doc_id and toxic, ``docs`` doc_id and text.

    Of the labels, at most ``sample`` are used, those with the smallest hash of their id; this
    bounded list is joined to the documents by a broadcast, so that their texts aren't shuffled.
    Null labels, and labels of documents that are null or not there, are left out; a document with
    several labels counts as toxic if one says so; copies of a text count once for the lexicon.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("_draw", F.xxhash64(F.lit(seed), "doc_id")).orderBy("_draw", "doc_id").limit(sample)
    )
    rows = docs.where("text IS NOT NULL").select("doc_id", F.col("text").alias("_text")).join(F.broadcast(chosen), "doc_id")
    rows = staged(rows.withColumn("_part", F.pmod(F.xxhash64(F.lit(seed + 1), "_text"), F.lit(10))), "labelled")
    lexicon = _learn_lexicon(rows.where("_part < 5").dropDuplicates(["_text"]))
    known = staged(with_features(rows.withColumnRenamed("_text", "text"), lexicon, ["toxic", "_part"]), "features")
    counts = {(r.c, r.toxic): r.n for r in known.groupBy(F.when(F.col("_part") < 5, 0).when(F.col("_part") < 8, 1).otherwise(2).alias("c"), "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n, toxic = sum(counts.values()), sum(v for (_, t), v in counts.items() if t)
    if not all(counts.get((1, t)) for t in (0, 1)):
        return Scorer(lexicon, None, None, toxic / n if n else 0.0)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(known.where("_part BETWEEN 5 AND 7"))
    trees = GBTClassifier(
        featuresCol="_features", labelCol="toxic", predictionCol="_class", maxIter=rounds, maxDepth=depth, stepSize=0.3, minInstancesPerNode=3, seed=seed
    ).setRawPredictionCol("_raw").setProbabilityCol("_probability").fit(assembled)
    if not all(counts.get((2, t)) for t in (0, 1)):
        return Scorer(lexicon, trees, None, 0.0)
    margins = staged(_margin(trees, known.where("_part > 7")), "margins")
    calibration = IsotonicRegression(featuresCol="_margin", labelCol="toxic", predictionCol="_calibrated").fit(margins.withColumn("_margin", F.col("score")))
    return Scorer(lexicon, trees, calibration, 0.0)


def scored(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, score) of every row from its whole text alone. Null and empty texts have all features 0; repeated rows equal scores."""
    return scorer.scores(with_features(docs, scorer.lexicon, ["doc_id"]))
