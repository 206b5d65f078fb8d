import duckdb
import pytest
from data import clashing, frame, prose

from tidemark.llm import licenses


def texts():
    mit = licenses.KNOWN["MIT"]
    return [
        (1, mit), (2, "MIT License\n" + mit), (3, "Copyright (c) 2020 Some One\nAll rights reserved.\n\n" + mit.upper()), (4, mit.replace(" ", "  \n").replace(",", ";")),
        (5, licenses.KNOWN["ISC"] + "\n(c) 1999 Else"), (6, licenses.KNOWN["ISC"] + " more"), (7, licenses.KNOWN["Apache-2.0-notice"].replace("License", "Licence")),
        (8, licenses.KNOWN["Apache-2.0-notice"].replace("http:", "https:")), (9, None), (10, ""), (11, "*** !!! ---"), (12, "© 2001"), (13, " ".join(prose(1, 30000))),
        (14, "licensed under the apache licence version 2 0"), (14, "licensed under the apache licence version 2 0"), (None, mit), (15, "// " + mit.replace("\n", "\n// ")),
    ]


def test_canonical_forms(spark):
    rows = licenses.scanned(clashing(frame(spark, texts())), licenses.known_texts(spark)).collect()
    found = {r.doc_id: r.licenses for r in rows}
    assert len(rows) == len(texts())
    assert [found[k] for k in (1, 3, 4, 15, None)] == ["MIT"] * 5
    assert found[5] == "ISC" and found[7] == found[8] == "Apache-2.0-notice" and found[14] == "Apache-2.0-line"
    assert all(found[k] is None for k in (2, 6, 9, 10, 11, 12, 13))
    assert all(r.digest is None for r in rows if r.doc_id in (9, 10, 11, 12))


def planted():
    """Every known text: as it is, under a title and a copyright, in capitals with other marks, with bullets, and with a word too many."""
    rows = []
    for k, (name, text) in enumerate(sorted(licenses.KNOWN.items())):
        spoilt = text.upper().replace("LICENSE", "LICENCE").replace(", ", " ,\n\t")
        forms = [text, f"The MIT License (MIT)\n\nCopyright Some Names and Others\n\n{text}", f"(c) 2020 Who Ever\n{spoilt}", licenses.re.sub(r"(?m)^[0-9]\. ", "  * ", text), text + " extra"]
        rows += [(100 * k + j, form, name if j < 4 else None) for j, form in enumerate(forms)]
    return rows


def test_every_known_text_is_found(spark):
    rows = planted()
    found = licenses.scanned(frame(spark, [r[:2] for r in rows]), licenses.known_texts(spark), headed=True).collect()
    assert {r.doc_id: r.licenses for r in found} == {k: name for k, _, name in rows}


@pytest.mark.parametrize("headed", [False, True])
def test_against_sql(spark, headed):
    docs = texts() + [r[:2] for r in planted()] + [(5000, "MIT License\n"), (5001, "the above\nCopyright holders of Acme\n"), (5002, "x\nCOPYRIGHT Notice\nCopyright Notes Inc")]
    rows = licenses.scanned(frame(spark, docs), licenses.known_texts(spark), headed=headed).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    wanted = con.execute(licenses.oracle(headed)).fetchall()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, wanted))


def test_hard_known_tables(spark):
    docs = frame(spark, texts())
    empty = spark.createDataFrame([], "license string, text string")
    assert licenses.scanned(docs, empty).where("licenses IS NOT NULL").count() == 0
    shared = spark.createDataFrame([("b", "One text"), ("a", "one  TEXT!"), (None, "one text"), ("c", None), ("d", "?")], "license string, text string")
    found = licenses.scanned(frame(spark, [(1, "one text"), (2, None), (3, "")]), shared).collect()
    assert {r.doc_id: r.licenses for r in found} == {1: "a,b", 2: None, 3: None}
    assert licenses.scanned(frame(spark, []), shared).collect() == []


def test_headed_texts_and_a_folder_of_licences(spark, tmp_path):
    own = "Redistribution and use in source and binary forms are permitted.\nIN NO EVENT SHALL THE\nCOPYRIGHT HOLDERS BE LIABLE."
    (tmp_path / "BSD like+1.txt").write_text("BSD 3-Clause License\n\n" + own)
    mit, isc = licenses.KNOWN["MIT"], licenses.KNOWN["ISC"]
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 Some One\n\n" + mit), (2, "# The MIT License (MIT)\nCopyright The X Authors\n" + mit), (3, "Copyright Acme Inc.\n\nISC License\n" + isc),
        (4, 'BSD 3-Clause "New" or "Revised" License\nCopyright Acme Inc.\n' + own), (5, "MIT License"), (6, "MIT License\nmore words\n" + mit), (7, None), (8, mit.replace("COPYRIGHT HOLDERS", "\nCOPYRIGHT HOLDERS")),
        (9, own.replace("COPYRIGHT HOLDERS ", "")), (10, "MIT License\n" + own.replace("Redistribution", "Use")), (11, mit),
    ]
    found = {r.doc_id: r for r in licenses.scanned(frame(spark, rows), licenses.known_texts(spark, str(tmp_path)), headed=True).collect()}
    assert [found[k].licenses for k in (1, 2, 3, 4, 8, 11)] == ["MIT", "MIT", "ISC", "BSD like+1", "MIT", "MIT"]
    assert all(found[k].licenses is None for k in (5, 6, 7, 9, 10))
    assert found[5].digest is not None and found[7].digest is None
