"""Forests against a plain version, MLlib's own on a small table, saving and chunks of trees."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tidewise.operators import forest as FO
from tidewise.operators import models as M


def plain_tree(bins, y, weight, depth, least):
    """Predictions of all rows: every node tries every feature and cut."""
    out = np.zeros(len(y))

    def sse(rows):
        return sum(weight[i] * y[i] ** 2 for i in rows) - sum(weight[i] * y[i] for i in rows) ** 2 / sum(weight[i] for i in rows)

    def build(rows, everyone, level):
        best = (1e-9, None)
        if level < depth:
            for f in range(len(bins)):
                for cut in sorted({bins[f, i] for i in rows})[:-1]:
                    left, right = [i for i in rows if bins[f, i] <= cut], [i for i in rows if bins[f, i] > cut]
                    gain = (sse(rows) - sse(left) - sse(right)) / sum(weight[i] for i in rows)
                    if min(sum(weight[i] for i in x) for x in (left, right)) >= least and gain > best[0] + 1e-12:
                        best = (gain, (f, cut, left, right))
        if best[1]:
            f, cut, left, right = best[1]
            build(left, [i for i in everyone if bins[f, i] <= cut], level + 1)
            build(right, [i for i in everyone if bins[f, i] > cut], level + 1)
            return
        out[everyone] = sum(weight[i] * y[i] for i in rows) / sum(weight[i] for i in rows)

    build([i for i in range(len(y)) if weight[i]], list(range(len(y))), 0)
    return out


@pytest.mark.parametrize("depth, least", [(0, 1), (3, 1), (30, 1), (30, 4)])
def test_a_tree_equals_the_plain_version(depth, least):
    rng = np.random.default_rng(5)
    bins = rng.integers(0, [[9], [4], [12]], (3, 150)).astype(np.uint8)
    y = 3.0 * (bins[0] > 4) - bins[1] * (bins[2] > 3) + rng.normal(0, 0.3, 150)
    weight = rng.poisson(1.0, 150).astype(np.uint8)
    tree = FO.unpacked(FO.packed(FO.grow_tree(bins, y, weight, depth, least, 0.0)))
    drawn = weight > 0  # nodes of two rows have equal splits, which part the other rows differently
    assert tree.value[tree.place(bins.T)][drawn] == pytest.approx(plain_tree(bins, y, weight, depth, least)[drawn], rel=1e-9)


def test_a_tree_without_rows_and_one_of_equal_labels():
    bins = np.arange(4, dtype=np.uint8)[None]
    assert len(FO.grow_tree(bins, np.ones(4), np.zeros(4, np.uint8), 5, 1, 0.0).value) == 1
    assert FO.grow_tree(bins, np.full(4, 0.1), np.ones(4, np.uint8), 5, 1, 0.0).value.tolist() == [0.1]


def table(spark, n=600):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 7, n), rng.normal(size=(n, 2))])
    y = 2 * x[:, 0] + 3 * x[:, 1] + rng.normal(0, 0.2, n)
    return spark.createDataFrame([(i, *map(float, x[i]), float(y[i])) for i in range(n)], "id long, a double, b double, c double, y double")


def test_the_reference_forest_is_not_grown_by_mllib(spark, monkeypatch, tmp_path):
    df = table(spark).repartition(3)
    small = M.RF_REFERENCE | {"numTrees": 12}
    with monkeypatch.context() as m:
        m.setattr(RandomForestRegressor, "fit", lambda *a: pytest.fail("MLlib's forest of deep trees does not end"))
        fitted = M.regression_pipeline(["a", "b", "c"], "y", "rf", params=small).fit(df)
    got = {r["id"]: r["prediction"] for r in fitted.transform(df).select("id", "prediction").collect()}
    # no null, the order of the rows does not matter, and trees may come in chunks
    assert len(got) == 600
    again = M.regression_pipeline(["a", "b", "c"], "y", "rf", params=small).fit(df.orderBy(F.desc("b")))
    monkeypatch.setattr(FO, "CHUNK_BYTES", 20_000)
    assert {r["id"]: pytest.approx(r["prediction"]) for r in again.transform(df).select("id", "prediction").collect()} == got
    path = str(tmp_path / "rf")
    M.save_model(fitted, path)
    assert {r["id"]: pytest.approx(r["prediction"]) for r in M.load_model(path).transform(df).select("id", "prediction").collect()} == got
    assert isinstance(M.load_model(path), PipelineModel)


def test_errors_are_those_of_mllib_on_the_same_bins(spark):
    df = table(spark)
    train, test = df.where("id < 400"), df.where("id >= 400")

    def rmse(est):
        p = M.regression_pipeline(["a", "b", "c"], "y", "linear")
        p.setStages([p.getStages()[0], est])
        return p.fit(train).transform(test).agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]

    own = dict(featuresCol="features", labelCol="y", numTrees=20, maxDepth=8, featureSubsetStrategy="all", seed=42)
    assert rmse(FO.Forest(**own)) == pytest.approx(rmse(RandomForestRegressor(**own)), rel=0.1)


def test_other_settings_and_larger_tables_go_to_mllib(spark, monkeypatch):
    assert isinstance(M.regression_pipeline(["a"], "y", "rf", params={"subsamplingRate": 0.5}).getStages()[-1], RandomForestRegressor)
    assert isinstance(M.regression_pipeline(["a"], "y", "rf").getStages()[-1], RandomForestRegressor)
    monkeypatch.setattr(FO, "FOREST_BYTES", 0)
    fitted = M.regression_pipeline(["a", "b"], "y", "rf", params=M.RF_REFERENCE | {"numTrees": 2, "maxDepth": 2}).fit(table(spark, 80))
    assert fitted.stages[-1].getNumTrees == 2
    monkeypatch.undo()
    with pytest.raises(ValueError, match="no row"):
        M.regression_pipeline(["a", "b"], "y", "rf", params=M.RF_REFERENCE).fit(table(spark, 5).where("false"))


def test_edges_are_the_middles_of_few_values_and_quantiles_of_many(spark):
    df = spark.range(1000).selectExpr("cast(if(id < 998, 1, id) AS double) AS rare", "cast(id AS double) AS many", "1.0D AS one")
    rare, many, one = FO.split_edges(df, ["rare", "many", "one"], 32)
    assert rare.tolist() == [499.5, 998.5] and len(many) == 31 and many[0] == pytest.approx(999 / 32) and len(one) == 0
