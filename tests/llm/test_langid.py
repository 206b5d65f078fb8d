import numpy as np
from data import clashing, prose

from tidemark.llm import langid

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = {"aa": "abcdefg", "bb": "hijklmn", "cc": "éèüöñ"}


def corpus():
    rng, rows = np.random.default_rng(6), []
    for k in range(600):
        lang = ["aa", "aa", "bb", "cc"][k % 4]
        words = ["".join(rng.choice(list(LETTERS[lang]), rng.integers(1, 8))) for _ in range(rng.integers(3, 200))]
        rows.append((k, " ".join(words), lang, "s", 0))
    return rows


def hard():
    return [(1000, None, "aa", None, 0), (1001, "", "aa", "s", 0), (1002, "123 ... !?", None, "s", 0), (1003, "x", "aa", "s", 0), (None, "hij klm", None, "s", 0), (1004, " ".join(prose(1, 30000)), None, "s", 0)]


def test_held_out_texts_are_named_and_hard_ones_defined(spark):
    rows = corpus()
    model = langid.fit(clashing(spark.createDataFrame(rows[:400] + hard(), SCHEMA)), sample=100, clusters=3)
    assert sorted(set(model.languages)) == ["aa", "bb", "cc"] and len(model.languages) == 9
    found = langid.predicted(clashing(spark.createDataFrame(rows[400:] + hard() + rows[400:401], SCHEMA)), model).collect()
    named = {r.doc_id: r for r in found}
    assert len(found) == 200 + 7
    right = sum(named[r[0]].lang_pred == r[2] for r in rows[400:])
    assert right >= 198
    for k in (1000, 1001, 1002):
        assert (named[k].lang_pred, named[k].score, named[k].rejected) == ("und", 0.0, True)
    assert named[1003].lang_pred in model.languages and named[None].lang_pred == "bb" and named[1004].rejected
    assert all(0 <= r.score <= 1 for r in found)


def test_counts_against_plain_python():
    texts = ["Ab, cé 1d".encode(), b"", b"a", b"  ", b"aaaa aaaa"]
    found = langid.term_counts(texts)
    for row, text in zip(found, texts):
        folded = [c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in b" " + text + b" "]
        wanted = np.zeros(langid.SIZE, int)
        for a, b, c in zip(folded, folded[1:], folded[2:]):
            if (a, b, c) != (32, 32, 32):
                wanted[((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 20] += 1
        assert (row == wanted).all()


def test_document_frequencies_count_all_rows(spark):
    rows = corpus()[:50]
    idf = langid._document_frequencies(spark.createDataFrame(rows, SCHEMA).repartition(5))
    df = (langid.term_counts([r[1].encode() for r in rows]) > 0).sum(0)
    assert np.allclose(idf, np.log(51 / (1 + df)) + 1)


def test_nothing_to_learn_and_empty_tables(spark):
    model = langid.fit(spark.createDataFrame(hard()[:1], SCHEMA))
    found = langid.predicted(spark.createDataFrame(corpus()[:3], SCHEMA), model).collect()
    assert [r.lang_pred for r in found] == ["und"] * 3
    assert langid.predicted(spark.createDataFrame([], SCHEMA), model).collect() == []


def test_copies_of_one_text_are_drawn_once(spark, monkeypatch):
    """All rows of a language but a few are one text; what is clustered are distinct texts, at most as many as stated."""
    sizes = spark.sparkContext.accumulator(0)
    plain = langid.term_counts

    def counted(texts, *rest):
        sizes.add(len(texts))
        return plain(texts, *rest)

    monkeypatch.setattr(langid, "_document_frequencies", lambda rows, f=langid._document_frequencies: (f(rows), monkeypatch.setattr(langid, "term_counts", counted))[0])
    for copies, different, sample in ((900, 60, 40), (0, 400, 40)):
        rows = [("one text that is copied everywhere", "en")] * copies + [(f"words {k} of {k * 7} letters", "en") for k in range(different)]
        before = sizes.value
        langid.fit(spark.createDataFrame(rows, "text string, lang string"), sample)
        assert 0 < sizes.value - before <= sample
        monkeypatch.setattr(langid, "term_counts", plain)


def test_texts_without_a_letter_are_undetermined(spark):
    """Digits, powers, fractions and other numerals are no letters; letters of any script are."""
    model = langid.fit(spark.createDataFrame(corpus()[:200], SCHEMA), sample=50)
    rows = [(k, t, None, "s", 0) for k, t in enumerate(["²", "½ ³", "① Ⅷ 7", "_-_", "\u0301", "ª", "日", "7 é", "a²"])]
    found = {r.doc_id: r.lang_pred for r in langid.predicted(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert [found[k] == "und" for k in range(9)] == [True, True, True, True, True, False, False, False, False]


def test_predictions_against_plain_python(spark):
    """The nearest of all centroids by cosine of damped, weighted counts, text by text."""
    import math
    from collections import Counter

    rows = corpus()
    model = langid.fit(spark.createDataFrame(rows[:300], SCHEMA), sample=60)
    for r in langid.predicted(spark.createDataFrame(rows[300:400], SCHEMA), model).collect():
        text = b" " + rows[r.doc_id][1].encode() + b" "
        folded = [c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in text]
        grams = Counter(((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 20 for a, b, c in zip(folded, folded[1:], folded[2:]) if (a, b, c) != (32, 32, 32))
        weight = {t: (1 + math.log(n)) * model.idf[t] for t, n in grams.items()}
        norm = math.sqrt(sum(w * w for w in weight.values()))
        cosines = [sum(w * float(centre[t]) for t, w in weight.items()) / norm for centre in model.centres]
        best = max(range(len(cosines)), key=lambda k: (cosines[k], -k))
        assert abs(r.score - cosines[best]) < 1e-4 and r.rejected == (r.score < model.least[best])
        assert r.lang_pred == model.languages[best]
