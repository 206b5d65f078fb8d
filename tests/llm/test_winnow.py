import random
import time

import pytest
from data import clashing, frame, prose

from tidemark.llm import winnow


def brute(docs, least):
    """Texts without the lines of windows whose lines an earlier place has."""
    first, out = {}, {}
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0] or 0))
    cut = {}
    for k in order:
        lines = [(i, x.strip(winnow.BLANK)) for i, x in enumerate((docs[k][1] or "").split("\n")) if x.strip(winnow.BLANK)]
        sizes = [len(x.split()) for _, x in lines]
        windows = set()
        for i in range(len(lines)):
            ahead = next((j for j in range(i, len(lines)) if sum(sizes[i : j + 1]) >= least), None)
            behind = next((j for j in range(i, -1, -1) if sum(sizes[j : i + 1]) >= least), None)
            windows |= {(i, ahead)} if ahead is not None else set()
            windows |= {(behind, i)} if behind is not None else set()
        cut[k] = [(lines[a][0], lines[b][0], tuple(x for _, x in lines[a : b + 1])) for a, b in sorted(windows)]
        for a, _, content in cut[k]:
            place = (docs[k], a)
            if content not in first:
                first[content] = place
    for k in order:
        gone = {i for a, b, content in cut[k] if first[content] != (docs[k], a) for i in range(a, b + 1)}
        lines = None if docs[k][1] is None else docs[k][1].split("\n")
        text = None if lines is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out[k] = (docs[k][0], text, 0 if lines is None else len(lines), len(gone))
    return sorted(out.values(), key=str)


def corpus():
    rng = random.Random(3)
    pool = [" ".join(prose(k, rng.choice([1, 3, 8, 20, 30, 60]))) for k in range(40)]
    docs = [(k, "\n".join(rng.choice(pool) if rng.random() < 0.7 else " ".join(prose(900 + 50 * k + j, 12)) for j in range(rng.randint(0, 14)))) for k in range(50)]
    passage = "\n".join(pool[:8])
    docs += [(100 + k, f"own {k}\n{passage}\n\n tail {k}") for k in range(5)]
    docs += [(200, None), (201, ""), (202, "\n\n"), (203, "same line\n" * 300), (204, "same line\n" * 300), (205, docs[7][1]), (205, docs[7][1])]
    docs += [(206, passage.replace("\n", " \r\n\t")), (None, passage), (207, "word " * 20000), (208, "word " * 20000)]
    return docs


@pytest.mark.parametrize("least", [50, 10])
def test_texts_against_brute_force(spark, least):
    docs = corpus()
    found = winnow.without_repeated_runs(clashing(frame(spark, docs)), least, counts=True)
    assert sorted((tuple(r) for r in found.select("doc_id", "text", "n_lines", "n_removed").collect()), key=str) == brute(docs, least)


def test_columns_and_empty_table(spark):
    df = clashing(frame(spark, corpus()))
    found = winnow.without_repeated_runs(df)
    assert found.columns == df.columns and found.count() == df.count()
    assert winnow.without_repeated_runs(df.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = winnow.without_repeated_runs(frame(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_time_follows_the_length_of_a_text(spark):
    """A text of 5 MB and 50 000 lines, and its copy: seconds, not the square of its length."""
    lines = [" ".join(prose(k, 14)) for k in range(500)]
    rng = random.Random(1)
    text = "\n".join(f"{rng.choice(lines)} {k}" for k in range(50_000))
    assert len(text) > 3_000_000
    docs = [(1, text), (2, "own line\n" + text), (3, "other")]
    begin = time.perf_counter()
    found = {r.doc_id: (r.text, r.n_removed) for r in winnow.without_repeated_runs(frame(spark, docs), counts=True).collect()}
    assert found == {1: (text, 0), 2: ("own line", 50_000), 3: ("other", 0)}
    assert time.perf_counter() - begin < 60
