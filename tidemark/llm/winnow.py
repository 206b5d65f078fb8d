"""Line deduplication by winnowing over line hashes, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.text import staged
from tidemark.operators.skew import spread_join

#: White space inside a line; a line of nothing else is blank.
BLANK = " \t\r\x0b\x0c"
WORD = r"[^ \t\r\x0B\x0C]+"
#: What names a text: whether its id is null, the id, a hash of the text.
PLACE = ["none", "id", "mark"]


def _lines(docs: DataFrame) -> DataFrame:
    """Per text the lines that aren't blank, without white space at their ends: numbers in the text, two hashes, words."""
    numbered = F.transform(F.split("text", "\n"), lambda line, at: F.struct(at.alias("at"), F.btrim(line, F.lit(BLANK)).alias("line")))
    lines = docs.where("text IS NOT NULL").select(
        F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("mark"), F.filter(numbered, lambda x: x["line"] != "").alias("lines")
    )
    each = lambda f: F.transform("lines", f)
    return lines.select(
        *PLACE, each(lambda x: x["at"]).alias("at"), each(lambda x: F.xxhash64(x["line"])).alias("hash"),
        each(lambda x: F.xxhash64(F.lit("other"), x["line"])).alias("other"), each(lambda x: F.regexp_count(x["line"], F.lit(WORD))).alias("words"),
    )


def _reach(words: Column, least: int) -> Column:
    """How many of the first entries are needed for ``least`` words; null if all are not enough."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
    step = lambda a, w: F.when(a["sum"] >= least, a).otherwise(F.struct((a["sum"] + w).alias("sum"), (a["n"] + 1).alias("n")))
    return F.aggregate(words, start, step, lambda a: F.when(a["sum"] >= least, a["n"]))


def _windows(least: int) -> Column:
    """From each line on, and up to each line, the shortest window of ``least`` words: first, n and the line of its least hash.

    Every line has a word, so that a window has ``least`` lines at most and a text's windows cost
    as much as its length.
    """
    places = F.when(F.size("words") > 0, F.sequence(F.lit(1), F.size("words"))).otherwise(F.array().cast("array<int>"))
    window = lambda first, n: F.struct(first.cast("int").alias("first"), n.cast("int").alias("n"))
    ahead = F.transform(places, lambda i: window(i, _reach(F.slice("words", i, F.lit(least)), least)))

    def behind(i: Column) -> Column:
        begin = F.greatest(F.lit(1), i - (least - 1))
        n = _reach(F.reverse(F.slice("words", begin, i - begin + 1)), least)
        return window(i - n + 1, n)

    def fingerprint(w: Column) -> Column:
        hashes = F.transform(F.slice("hash", w["first"], w["n"]), lambda h, k: F.struct(h.alias("hash"), (w["first"] + k).alias("place")))
        return F.struct(w["first"].alias("first"), w["n"].alias("n"), F.array_min(hashes)["place"].alias("place"))

    both = F.array(F.struct(ahead.alias("ahead"), F.transform(places, behind).alias("behind")))
    new = lambda s: F.filter(s["behind"], lambda w: w["n"].isNotNull() & ~F.element_at(s["ahead"], w["first"])["n"].eqNullSafe(w["n"]))
    whole = F.transform(both, lambda s: F.concat(F.filter(s["ahead"], lambda w: w["n"].isNotNull()), new(s)))[0]
    return F.transform(whole, fingerprint)


def _exploded(lines: DataFrame, entries: Column) -> DataFrame:
    """A row per entry with the text's names; the arrays of the text stay behind."""
    return lines.select(*PLACE, F.explode(entries).alias("e")).select(*PLACE, "e.*")


def repeated_runs(docs: DataFrame, least: int = 50) -> DataFrame:
    """(none, id, mark, runs): runs of line numbers (first, last) of each document that repeat an earlier run.

    The windows of a text are the shortest runs of lines with ``least`` words, one from each line
    on and one up to each line; the line with the smallest hash of a window is selected as its
    fingerprint. Any common run of ``least`` words contains whole windows, and so selected lines that
    both texts have. Only the selected lines are dealt out and counted by their hash. Those with
    two places and more are matches; each is extended to both sides over the windows that selected
    it, by their lines' hashes (128 bits of every line), and the first place of a
    window's lines, by doc_id and line, stays. Windows that overlap or touch join up to runs, so that a run
    reaches as far as the lines agree with earlier places. Counts and first places are
    pre-aggregated and written, so that the joins with them can split the rows of a passage that a
    third of the documents have.

    Blank lines are not compared, and belong to a run inside of which they lie. White space at the
    ends of a line doesn't count. Rows equal in doc_id and text are one place: neither repeats the
    other. Null ids come last, among each other by a hash of their text. Null texts have no lines.
    """
    lines = staged(_lines(docs), "lines").withColumn("windows", _windows(least))
    lines = staged(lines.drop("words").where(F.size("windows") > 0), "windows")
    chosen = F.transform(F.array_distinct(F.transform("windows", lambda w: w["place"])), lambda p: F.struct(F.element_at("hash", p).alias("print"), p.alias("place")))
    selected = _exploded(lines, chosen)
    ends = [f(c).alias(f"{c}{n}") for c in (*PLACE, "place") for n, f in ((0, F.min), (1, F.max))]
    repeated = selected.groupBy("print").agg(*ends).where(" OR ".join(f"{c}0 <> {c}1" for c in (*PLACE, "place"))).select("print")
    matches = staged(spread_join(selected, staged(repeated, "prints"), "print", "left_semi").drop("print").distinct(), "matches")

    part = lambda c, w: F.slice(c, w["first"], w["n"])
    named = lambda w: F.struct(
        w["place"].alias("place"), F.xxhash64(part("hash", w)).alias("content"), F.xxhash64(part("other", w)).alias("check"),
        F.element_at("at", w["first"]).alias("first"), F.element_at("at", w["first"] + w["n"] - 1).alias("last"),
    )
    touched = lines.join(matches.select(*PLACE).distinct(), PLACE, "left_semi")
    candidates = staged(_exploded(touched, F.transform("windows", named)).join(matches, [*PLACE, "place"], "left_semi").drop("place"), "candidates")
    place = F.struct(*PLACE, "first")
    firsts = staged(candidates.groupBy("content", "check").agg(F.min(place).alias("least"), F.max(place).alias("most")).where("least <> most").drop("most"), "firsts")
    later = candidates.join(firsts, ["content", "check"]).where(place > F.col("least"))
    per_doc = Window.partitionBy(*PLACE).orderBy("first", "last")
    reached = F.max("last").over(per_doc.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached.isNull() | (F.col("first") > reached + 1), 1).otherwise(0)
    runs = (
        later.select(*PLACE, "first", "last", opens.alias("opens"))
        .withColumn("run", F.sum("opens").over(per_doc.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*PLACE, "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )
    return runs.groupBy(*PLACE).agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))


def without_repeated_runs(docs: DataFrame, least: int = 50, counts: bool = False) -> DataFrame:
    """The documents with later repeated runs of lines deleted from ``text``; rows and columns stay.

    With ``counts`` the columns n_lines and n_removed (lines of the old text, and of those the
    deleted ones) are added, in place of columns of these names. A text whose lines all repeat
    earlier ones becomes empty. Null texts stay null and count no lines.
    """
    found = repeated_runs(docs.select("doc_id", "text"), least)
    doc_id, text = F.col("d.doc_id"), F.col("d.text")
    same = (doc_id.isNull() == F.col("f.none")) & (F.coalesce(doc_id, F.lit(0)) == F.col("f.id")) & (F.xxhash64(text) == F.col("f.mark"))
    joined = docs.alias("d").join(found.alias("f"), same, "left")
    runs = F.col("f.runs")
    lines = F.split(text, "\n")
    ends = F.concat(F.array(F.lit(-1)), F.transform(runs, lambda r: r["last"]))
    begins = F.concat(F.transform(runs, lambda r: r["first"]), F.array(F.size(lines)))
    between = F.transform(F.arrays_zip(ends.alias("e"), begins.alias("b")), lambda g: F.slice(lines, g["e"] + 2, g["b"] - g["e"] - 1))
    columns = {"text": F.when(runs.isNull(), text).otherwise(F.array_join(F.flatten(between), "\n"))}
    if counts:
        gone = F.coalesce(F.aggregate(runs, F.lit(0), lambda a, r: a + r["last"] - r["first"] + 1), F.lit(0))
        columns |= {"n_lines": F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long"), "n_removed": gone.cast("long")}
    names = [*docs.columns, *(c for c in columns if c not in docs.columns)]
    return joined.select(*(columns.get(c, F.col(f"d.`{c}`")).alias(c) for c in names))
