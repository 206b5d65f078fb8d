import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import forest, model, shap
from tidemark.plans.price import price_study


def rows_of(spark, n=600):
    cell = lambda k, m: (F.hash("id", F.lit(k)) % m).cast("double")
    df = spark.range(n).select("id", cell(1, 40).alias("a"), cell(2, 9).alias("b"), F.when(F.hash("id") % 2 == 0, 1.0).otherwise(0.0).alias("c"))
    return df.withColumn("y", F.col("a") * (10 + F.col("b")) + F.col("c"))


def test_attributions_walk_rows_of_a_kind_once(monkeypatch):
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.normal(size=(1500, 3)), rng.integers(0, 2, (1500, 2))])
    nodes = forest.grown(x[:400], x[:400, 0] * (3 + x[:400, 1]) + x[:400, 3], np.ones(400))
    path, walked, games = [(1, 0.5, True, 0.7)], [], shap._games

    def counted(number, features, *more):
        walked.append(len(number))
        return games(number, features, *more)

    alone = np.concatenate([shap._attributed(x[k : k + 1], path, nodes) for k in range(0, 1500, 50)])
    monkeypatch.setattr(shap, "_games", counted)
    found = shap._attributed(x, path, nodes)
    np.testing.assert_allclose(found[::50], alone, rtol=1e-9, atol=1e-9)
    leaves = int((nodes["left"] < 0).sum())
    kinds = shap._alike(np.ascontiguousarray(x.T), np.zeros(1500, np.int64), [0, 1], np.array([0, 1, 3]), np.array([0.1, 0.2, 0.5]))
    assert len(walked) == leaves and len(kinds[0]) == 2  # features 0 and 1 have failed all rows, 3 is asked once


def test_kinds_are_told_apart_beyond_the_range_of_a_number():
    x = np.arange(40.0)[:, None] + np.zeros(16)
    asked, limits = np.repeat(np.arange(16), 40), np.tile(np.arange(40.0), 16)
    first, kind = shap._alike(np.ascontiguousarray(x.T), np.zeros(40, np.int64), [], asked, limits)
    assert len(first) == 40 and (x[first][kind] == x).all()


def test_predictions_meet_their_rows_by_a_digest(spark):
    df = rows_of(spark)
    grown = model.rf_regress(df, ["a", "b", "c"], "y", trees=1, bootstrap=False)
    odd = df.withColumns({"a": F.when(F.col("id") < 50, -0.0).otherwise(F.col("a")), "b": F.when(F.col("id") % 90 == 3, None).when(F.col("id") % 90 == 4, float("nan")).otherwise(F.col("b"))})
    found = model.predict(grown, odd)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_digest" in plan and "Join [_x" not in plan
    got, plain = found.toPandas().set_index("id"), model.predict(grown, odd.withColumn("a", F.col("a") + 0.0)).toPandas().set_index("id")
    assert len(got) == 600 and (got.raw_prediction.isna() == got.index.isin(odd.where("b IS NULL").toPandas().id)).all()
    assert got.raw_prediction.fillna(-1).to_dict() == plain.raw_prediction.fillna(-1).to_dict()


def test_node_table_holds_a_part_in_few_values(spark):
    df = rows_of(spark)
    grown = model.rf_regress(df, ["a", "b", "c"], "y", trees=3)
    assert all(f.dataType.simpleString() in ("int", "binary") for f in grown.parts.schema)
    nodes = grown.nodes().toPandas()
    gains = nodes[nodes.left >= 0].groupby(["tree", "feature"]).gain.sum()
    share = (gains / gains.groupby("tree").sum()).groupby("feature").sum() / 3
    got = {r.feature: r.importance for r in forest.importances(grown).collect()}
    assert [got[f] for f in "abc"] == pytest.approx([share.get(k, 0.0) for k in range(3)])


def test_a_node_tells_its_histograms_in_one_row():
    rng = np.random.default_rng(1)
    n, top = 500, forest.Top()
    top.feature[0], top.threshold[0], top.left[0], top.right[0] = 0, 0.0, top.add(0, 1), top.add(0, 1)
    x, y = rng.normal(size=(n, 2)), rng.normal(size=n)
    lists = lambda v, kind: pa.array(v.tolist(), pa.list_(kind))
    batch = pa.RecordBatch.from_arrays([lists(x, pa.float64()), pa.array(y), lists(np.arange(n)[:, None], pa.int64())], names=["x", "y", "rows"])
    edges = [np.array([-1.0, 0.0, 1.0]), np.array([0.0])]
    out = pa.Table.from_batches(forest._histograms({7: top}, {7: [1, 2]}, edges, 42, False)(iter([batch.slice(0, 200), batch.slice(200)])))
    assert out.num_rows == 2
    best = [forest._best_split([4, 2], 1)(out.slice(k, 1)).to_pylist()[0] for k in range(2)]
    for node, mine in zip(best, (x[:, 0] <= 0, x[:, 0] > 0)):
        assert node["w"] == mine.sum() and node["s"] == pytest.approx(y[mine].sum())
        gains = {}
        for f, e in enumerate(edges):
            for k, limit in enumerate(e):
                low = x[mine, f] <= limit
                if 0 < low.sum() < len(low):
                    gains[f, k] = sum(y[mine][r].sum() ** 2 / r.sum() for r in (low, ~low)) - y[mine].sum() ** 2 / mine.sum()
        assert node["gain"] == pytest.approx(max(gains.values())) and gains[node["feature"], node["bin"]] == pytest.approx(max(gains.values()))


def test_price_study_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = rows_of(spark)
    study = price_study(df.mapInArrow(passing, df.schema), "id", "y", ["a", "b"], ["c"], trees=2, max_depth=3)
    assert study.improvement.count() == 1 and study.facts.first().n_rows == 600
    assert seen.value == 600


@pytest.mark.parametrize(("least", "depth"), [(1, None), (5, None), (1, 4)])
def test_trees_are_the_same_whatever_the_runs(monkeypatch, least, depth):
    rng = np.random.default_rng(3)
    n = 700
    x = np.column_stack([rng.integers(0, 30, (n, 2)), rng.normal(size=n), rng.integers(0, 2, (n, 2)), np.zeros(n)]).astype(float)
    x[rng.random(n) < 0.05, 2] = np.nan
    y, w = np.round(x[:, 0] * (3 + x[:, 3]) + rng.integers(0, 4, n), 1), rng.integers(1, 4, n).astype(float)
    monkeypatch.setattr(forest, "RUN", n)
    whole = forest.grown(x, y, w, depth, least)
    monkeypatch.setattr(forest, "RUN", 16)
    for c, values in forest.grown(x, y, w, depth, least).items():
        assert values.tobytes() == whole[c].tobytes()
    leaf = forest.reached(x, *(whole[c] for c in ("left", "right", "feature", "threshold")))
    assert (np.bincount(leaf, w, len(whole["cover"]))[whole["left"] < 0] == whole["cover"][whole["left"] < 0]).all()


def test_rows_are_ordered_column_by_column():
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 3, (400, 5)) / 2
    rows[rng.random(rows.shape) < 0.1] = np.nan
    np.testing.assert_array_equal(forest._ordered(rows), rows[np.lexsort(rows.T[::-1])])


def test_items_are_dealt_in_few_bytes():
    rng = np.random.default_rng(5)
    n, top = 300, forest.Top()
    x, y = np.column_stack([rng.integers(0, 2, (n, 6)), rng.normal(size=n)]).astype(float), rng.normal(size=n)
    lists = lambda v, kind: pa.array(v.tolist(), pa.list_(kind))
    batch = pa.RecordBatch.from_arrays([lists(x, pa.float64()), pa.array(y), lists(np.arange(n)[:, None], pa.int64())], names=["x", "y", "rows"])
    out = pa.Table.from_batches(forest._blocks({0: top}, 42, True)(iter([batch])))
    w = forest.draws(np.arange(n), 0, 42)
    assert len(out["block"][0].as_py()) <= 40 * (w > 0).sum()
    np.testing.assert_array_equal(forest._plain(out["kind"], out["block"]), np.column_stack([x, y, w, np.ones(n)])[w > 0])


def test_importances_read_no_nodes(spark):
    grown = model.rf_regress(rows_of(spark), ["a", "b", "c"], "y", trees=3)
    plan = forest.importances(grown)._jdf.queryExecution().executedPlan().toString()
    assert "gains" in plan and "threshold" not in plan


@pytest.mark.parametrize("least", [1, 40])
def test_splits_do_not_depend_on_what_a_task_holds(spark, monkeypatch, least):
    """Above the parts as below: all values are tried, thresholds lie between values of the node, splits that gain nothing are made."""
    rng = np.random.default_rng(8)
    n = 3000
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 3, n), np.round(rng.exponential(size=n), 3)])
    y = np.round(40 * np.sin(3 * x[:, 0])) + x[:, 1] * 5 + rng.normal(size=n)
    df = spark.createDataFrame([(k, *map(float, r), float(t)) for k, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, y double")
    made = []
    for cells in (10**6, 900):
        monkeypatch.setattr(forest, "CELLS", cells)
        made.append(model.rf_regress(df, ["a", "b", "c"], "y", trees=3, min_rows=least))
    assert all(len(t.parts()) == 1 for t in made[0].tops) and all(len(t.parts()) > 4 for t in made[1].tops)
    if least > 1:  # nodes of a few rows have equally good splits, among which rounding decides
        one, other = ({r.id: r.raw_prediction for r in model.predict(f, df).collect()} for f in made)
        assert other == pytest.approx(one)
    whole = made[0].nodes().where("part = 0 AND left >= 0").toPandas().set_index(["tree", "id"])
    for t, top in enumerate(made[1].tops):
        inner, at = [k for k in range(len(top.left)) if top.left[k] >= 0], {0: 0}
        for k in inner:
            node = whole.loc[t, at[k]]
            assert (top.feature[k], top.threshold[k]) == (node.feature, node.threshold)
            at |= {top.left[k]: int(node.left), top.right[k]: int(node.right)}


def test_large_nodes_without_gain_are_split(spark, monkeypatch):
    rows = [(float(a), float(b), float(a ^ b)) for a in (0, 1) for b in (0, 1)]
    df = spark.createDataFrame(rows * 5, "a double, b double, y double")
    monkeypatch.setattr(forest, "CELLS", 2)
    got = model.predict(model.rf_regress(df, ["a", "b"], "y", trees=1, bootstrap=False), df).collect()
    assert len(got) == 20 and all(r.raw_prediction == r.y for r in got)


def test_bins_are_bounded_from_above():
    """No split inside a bin gains more than its bound, so that none is missed."""
    rng = np.random.default_rng(9)
    for _ in range(200):
        y, w, (a, b) = rng.normal(size=60).round(2), rng.integers(1, 4, 60).astype(float), np.sort(rng.choice(61, 2, False))
        sw, ss = (np.concatenate(([0.0], np.cumsum(v))) for v in (w, w * y))
        gains = forest._gain(sw, ss, sw[-1], ss[-1])
        bound = forest._most(*(np.array([v]) for v in (sw[a], ss[a], sw[b], ss[b], y[a:b].min(), y[a:b].max())), sw[-1], ss[-1])
        assert gains[a : b + 1].max() <= bound[0] + 1e-9


def test_attributions_are_added_up_in_lots_of_parts(spark, monkeypatch):
    """A point leaves a row per pass, not one per part; lots, slots and passes change nothing."""
    df, names = rows_of(spark), ["a", "b", "c"]
    monkeypatch.setattr(forest, "CELLS", 300)
    grown = model.rf_regress(df, names, "y", trees=4)
    _, points = forest.points_of(grown, df)
    n, parts = points.count(), sum(len(t.parts()) for t in grown.tops)
    assert parts > 12 and shap._by_lots(grown, points).count() == n
    plain = {r.id: tuple(r) for r in shap.shap_values(grown, df, "id").collect()}
    for name, value in (("SLOT", 100), ("NODES", 200)):
        monkeypatch.setattr(shap, name, value)
    monkeypatch.setattr(forest, "DEALT", 1)
    assert n < shap._by_lots(grown, points).count() < n * parts
    found = shap.shap_values(grown, df, "id").join(model.predict(grown, df).select("id", "raw_prediction"), "id").toPandas()
    assert len(found) == 600 and (found.base + found.phi_a + found.phi_b + found.phi_c).tolist() == pytest.approx(found.raw_prediction.tolist())
    assert all(tuple(r)[:8] == pytest.approx(plain[r.id]) for r in found.itertuples(index=False))


def test_predictions_are_summed_over_passes(spark, monkeypatch):
    df, names = rows_of(spark), ["a", "b", "c"]
    grown = model.rf_regress(df, names, "y", trees=5)
    plain, made, written = model.predict(grown, df).toPandas(), [], forest.written
    monkeypatch.setattr(forest, "DEALT", 1)
    monkeypatch.setattr(forest, "FEWEST", 2)
    monkeypatch.setattr(forest, "written", lambda rows, label: made.append(label) or written(rows, label))
    found = model.predict(grown, df).toPandas()
    assert made.count("met") == 3  # two trees at a time
    again = model.rf_regress(df, names, "y", trees=5)
    assert made.count("trees") == 3 and model.predict(again, df).count() == 600
    key = lambda p: p.set_index("id").raw_prediction.to_dict()
    assert key(found) == pytest.approx(key(plain))


def test_points_are_copied_as_often_as_rows_repeat(spark, monkeypatch):
    df, names, made, joined = rows_of(spark), ["id"], [], forest.spread_join
    grown = model.rf_regress(df, names, "y", trees=1)
    monkeypatch.setattr(forest, "spread_join", lambda *given, **named: made.append(named["salts"]) or joined(*given, **named))
    assert model.predict(grown, df).count() == 600 and model.predict(grown, df.unionAll(df).unionAll(df)).count() == 1800
    assert made == [1, 3]


def test_written_tables_leave_no_shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        found = blocks.getAllFiles()
        return {name for k in range(found.size()) if (name := found.apply(k).getName()).startswith("shuffle_")}

    before = held()
    made = forest.written(spark.range(1000).groupBy((F.col("id") % 7).alias("g")).count(), "test")
    assert not {f for f in held() - before if f.endswith(".data")}
    assert made.count() == 7
