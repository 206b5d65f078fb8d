"""Queries of this subpackage over the given tables, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from tidemark.llm import blocks, codes, decontaminate, langid, lattice, licenses, outliers, packing, rotation, setsketch, toxicity, variants, winnow

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": corpus_pipeline.run}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: The byte-level vocabulary of the packed ids; the variable names another file.
VOCABULARY = os.environ.get("TIDEMARK_BYTE_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")


@query
def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical digest of every document past titles and copyrights, and the licences that are this text."""
    return licenses.scanned(table(spark, sf, "documents"), licenses.known_texts(spark), headed=True)


ORACLES["op1_license_scan"] = licenses.oracle(headed=True)

#: A folder with further full licence texts, one a file, by a path that Spark can read.
LICENSES = os.environ.get("TIDEMARK_LICENSES")


@query
def op1_license_files(spark: SparkSession, sf: str) -> DataFrame:
    """As op1_license_scan, with the texts of LICENSES."""
    return licenses.scanned(table(spark, sf, "documents"), licenses.known_texts(spark, LICENSES), headed=True)


if not LICENSES:  # without a folder it is the same scan
    ORACLES["op1_license_files"] = licenses.oracle(headed=True)


@query
def op2_token_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's ids in packed rows, by digests of the rows of ids and positions."""
    rows = packing.packed_rows(table(spark, sf, "documents"), VOCABULARY)
    return rows.select("doc_ids", "parts", "cu_seqlens", "n_ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("position_ids", 256).alias("positions_sha256"))


@query
def op4_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Contamination of every document by the 13-word windows of all benchmark items."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.with_scan(docs, table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", F.col("scan.n_words").alias("n_words"), decontaminate.n_hit().alias("n_hit"),
        F.size("scan.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("scan.items"), ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
        F.coalesce("scan.longest.n", F.lit(0)).cast("long").alias("longest_words"), F.col("scan.longest.doc_start").cast("long").alias("longest_start"), F.col("scan.longest.item_id").alias("longest_item"),
    )


def remainder(of: int):
    """The fold of a document: the CRC-32 of its id as text, by remainder."""
    return F.crc32(F.col("doc_id").cast("string")) % of


@query
def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Calibrated toxicity of every document, learned from the labels outside the held-out fold."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scorer = toxicity.fit(docs, table(spark, sf, "labels").where(remainder(3) != 1))
    found = toxicity.scored(docs, scorer)
    return found.select(
        "doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """The language of every document, learned from those outside the held-out fold."""
    docs = table(spark, sf, "documents")
    model = langid.fit(docs.where(remainder(4) != 2).select("text", "lang"))
    found = langid.predicted(docs, model)
    return found.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf, "pages")
    return blocks.extracted(pages, blocks.fit(pages))


@query
def op8_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate classes of all documents: 3-word shingles, similarity 0.85."""
    return setsketch.near_duplicates(table(spark, sf, "documents"), size=3, percent=85)


@query
def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the runs of lines of 50 words and more that an earlier place has."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return winnow.without_repeated_runs(docs, counts=True)


@query
def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Base rules and robust outliers per language and source, for every document."""
    found = outliers.judged(table(spark, sf, "documents"))
    return found.select("doc_id", *outliers.COUNTS, "base_failed", "distance", "kept")


@query
def op10_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """Sampled piece ids of every document, and whether they decode to its text."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return lattice.encoded(docs, corpus_pipeline.MODEL).select("doc_id", "n_ids", "ids", "lossless")


@query
def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of all documents with its near words, form and root."""
    return variants.grouped(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    """The code of every vector after four rounds, and its errors."""
    return codes.compressed(table(spark, sf, "embeddings"))


@query
def op13_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.9."""
    return rotation.near_vectors(table(spark, sf, "embeddings"))


ORACLES["op9_line_dedup"] = """
WITH split AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
               FROM documents),
filled AS (SELECT doc_id, pos, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM split),
lines AS (SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^ \\t\\r\\x0B\\x0C]+')) AS words,
                 row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r
          FROM filled WHERE line <> ''),
sums AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY r) AS upto FROM lines),
windows AS (
  SELECT a.doc_id, a.r AS r1, min(b.r) AS r2 FROM sums a JOIN sums b ON a.doc_id = b.doc_id AND b.r BETWEEN a.r AND a.r + 49
  WHERE b.upto - a.upto + a.words >= 50 GROUP BY ALL
  UNION
  SELECT a.doc_id, max(b.r), a.r FROM sums a JOIN sums b ON a.doc_id = b.doc_id AND b.r BETWEEN a.r - 49 AND a.r
  WHERE a.upto - b.upto + b.words >= 50 GROUP BY a.doc_id, a.r),
contents AS (SELECT w.doc_id, min(l.pos) AS lo, max(l.pos) AS hi, string_agg(l.line, chr(10) ORDER BY l.r) AS content
             FROM windows w JOIN lines l ON w.doc_id = l.doc_id AND l.r BETWEEN w.r1 AND w.r2 GROUP BY w.doc_id, w.r1, w.r2),
later AS (SELECT doc_id, lo, hi FROM contents QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, lo) > 1),
gone AS (SELECT DISTINCT s.doc_id, s.pos FROM split s JOIN later w ON s.doc_id = w.doc_id AND s.pos BETWEEN w.lo AND w.hi),
kept AS (SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.pos) AS text
         FROM split s ANTI JOIN gone g ON s.doc_id = g.doc_id AND s.pos = g.pos GROUP BY s.doc_id)
SELECT d.doc_id, coalesce(k.text, '') AS text, CAST(len(string_split(d.text, chr(10))) AS BIGINT) AS n_lines,
       (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op4_benchmark_decontamination"] = rf"""
WITH texts AS (SELECT doc_id, NULL AS item_id, text FROM documents UNION ALL SELECT NULL, item_id, text FROM benchmark),
words AS (SELECT doc_id, item_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM texts),
items AS (SELECT item_id, row_number() OVER () AS item, w, least(13, len(w)) AS n FROM words WHERE item_id IS NOT NULL AND len(w) > 0),
standing AS (SELECT item_id, item, n, unnest(range(1, len(w) - n + 2)) AS q, unnest(list_transform(range(1, len(w) - n + 2), lambda p: array_to_string(w[p:p + n - 1], ' '))) AS x FROM items),
wanted AS (SELECT DISTINCT item_id, n, x FROM standing),
places AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p,
                  unnest(list_transform(range(1, len(w) - n + 2), lambda p: array_to_string(w[p:p + n - 1], ' '))) AS x
           FROM words, (SELECT DISTINCT n FROM wanted) WHERE doc_id IS NOT NULL AND len(w) >= n),
found AS (SELECT doc_id, p, n, item_id FROM places JOIN wanted USING (n, x)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM found)) GROUP BY doc_id),
steps AS (SELECT doc_id, p, n, item, item_id, p - q AS slant FROM places JOIN standing USING (n, x)),
runs AS (SELECT doc_id, item_id, min(p) - 1 AS first, n + count(*) - 1 AS long
         FROM (SELECT *, p - row_number() OVER (PARTITION BY doc_id, item, slant ORDER BY p) AS run FROM steps) GROUP BY doc_id, item, item_id, slant, run, n),
longest AS (SELECT doc_id, first, long, CAST(item_id AS VARCHAR) AS item FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY long DESC, first, CAST(item_id AS VARCHAR)) = 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       CAST(coalesce(long, 0) AS BIGINT) AS longest_words, CAST(first AS BIGINT) AS longest_start, longest.item AS longest_item
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN longest USING (doc_id) WHERE words.doc_id IS NOT NULL
"""

ORACLES["op8_minhash_near_dedup"] = rf"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda p: array_to_string(w[p:p + 2], ' '))) END AS s FROM words),
classes AS (SELECT md5(array_to_string(list_sort(s), '|')) AS set_id, min(doc_id) AS least, any_value(s) AS s FROM sets WHERE len(s) > 0 GROUP BY set_id),
ranked AS (SELECT least, len(s) AS n, unnest(s) AS x FROM classes),
spread AS (SELECT x FROM ranked GROUP BY x HAVING count(*) > 1),
shared AS (SELECT a.least AS a, b.least AS b, count(*) AS n_both, any_value(a.n) AS na, any_value(b.n) AS nb
           FROM (SELECT * FROM ranked SEMI JOIN spread USING (x)) a JOIN (SELECT * FROM ranked SEMI JOIN spread USING (x)) b ON a.x = b.x AND a.least <> b.least
           WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY a.least, b.least),
links AS (SELECT a, b FROM shared WHERE 100 * n_both >= 85 * (na + nb - n_both)),
reach AS (SELECT least AS a, least AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a),
named AS (SELECT s.doc_id, root FROM sets s JOIN classes c ON md5(array_to_string(list_sort(s.s), '|')) = c.set_id JOIN roots ON roots.a = c.least WHERE len(s.s) > 0)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(root, doc_id) AS component_id, coalesce(root, doc_id) = doc_id AS kept
FROM sets LEFT JOIN named USING (doc_id)
"""

ORACLES["op11_spelling_variants"] = rf"""
WITH RECURSIVE found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
runs AS (SELECT row_number() OVER () AS id, run, c, CAST(doc_id AS VARCHAR) || ':' || run AS named
         FROM (SELECT doc_id, run, count(*) AS c FROM found GROUP BY ALL) WHERE length(run) >= 5),
bytes AS (SELECT id, hex(encode(named)) AS h FROM runs),
polynomial AS (SELECT i, list_reduce([CAST(i AS BIGINT)] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)),
crc AS (
  SELECT id, h, 0 AS pos, CAST(4294967295 AS BIGINT) AS c FROM bytes
  UNION ALL
  SELECT id, h, pos + 1, xor(v, c >> 8) FROM crc JOIN polynomial
    ON i = xor(c & 255, CAST('0x' || substr(h, 2 * pos + 1, 2) AS BIGINT)) WHERE 2 * pos < length(h)),
hashes AS (SELECT id, xor(c, 4294967295) AS h FROM crc WHERE 2 * pos = length(h)),
changed AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, c FROM runs JOIN hashes USING (id)),
words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cut AS (SELECT word, n, length(word) AS m, p, left(word, CAST(p AS INT)) || substr(word, CAST(p AS INT) + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS n_other FROM cut a JOIN cut b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n_other DESC, other) AS form, max(n_other) AS form_n FROM pairs GROUP BY word),
forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
          FROM words LEFT JOIN best USING (word)),
led AS (SELECT word, word AS root FROM forms UNION ALL SELECT led.word, f.form FROM led JOIN forms f ON led.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, led.root, f.n, f.n_near, f.form_n FROM forms f JOIN led ON f.word = led.word JOIN forms r ON led.root = r.word AND r.form IS NULL
"""


def _codes_sql() -> str:
    """Rounds of assignment and floor(sum / count), each a step of common table expressions."""
    steps = []
    for r in range(codes.ROUNDS + 1):
        steps.append(f"""gaps{r} AS MATERIALIZED (SELECT a.vec_id, a.part, b.entry, CAST(sum((a.x - b.x) * (a.x - b.x)) AS BIGINT) AS d FROM parts a JOIN book{r} b ON a.part = b.part AND a.pos = b.pos GROUP BY ALL),
near{r} AS MATERIALIZED (SELECT vec_id, part, first(entry ORDER BY d, entry) AS entry, min(d) AS d FROM gaps{r} GROUP BY ALL)""")
        if r < codes.ROUNDS:
            steps.append(f"""book{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN
  (SELECT part, entry, pos, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM near{r} JOIN parts USING (vec_id, part) GROUP BY ALL) m USING (part, entry, pos))""")
    last = codes.ROUNDS
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(floor(CAST(v AS DOUBLE) * {codes.SCALE}) AS BIGINT)) AS v FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
parts AS MATERIALIZED (SELECT vec_id, (i - 1) // w AS part, (i - 1) % w AS pos, x
  FROM (SELECT vec_id, len(v) // {codes.PARTS} AS w, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM kept)),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {codes.ENTRIES}),
book0 AS MATERIALIZED (SELECT part, entry, pos, x FROM parts JOIN seeds USING (vec_id)),
{(","+chr(10)).join(steps)},
sums AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{last} GROUP BY vec_id),
sha AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM book{last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN sums USING (vec_id), sha
"""


ORACLES["op12_vector_codes"] = _codes_sql()

ORACLES["op13_embedding_near_dedup"] = """
WITH RECURSIVE kept AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0 AS good
  FROM embeddings),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM kept a JOIN kept b ON a.vec_id <> b.vec_id AND a.good AND b.good AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM kept UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM roots
"""
