"""Forests grown on all rows: cuts, draws, splits, upper levels, scores."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lodestay.operators import forest, modelling
from lodestay.session import durable

SPEC = modelling.ModelSpec(key="id", target="y", numerical=("x", "late"), categorical=("c",), trees=8, depth=4)


def late_rows(spark, n=3200):
    """Prices depend on ``late`` alone, which the 2,000 training rows with the smallest key hashes never have."""
    rows = spark.range(n).withColumn("hash", modelling.sample_order(SPEC))
    train = modelling.with_split(rows, "id", SPEC.seed).where(~F.col("is_test"))
    last = train.orderBy("hash").limit(2000).agg(F.max("hash")).first()[0]
    late = F.when(F.col("hash") > last, 1.0).otherwise(0.0)
    return rows.select(
        "id", (F.col("id") % 37).cast("double").alias("x"), late.alias("late"), F.concat(F.lit("c"), F.col("id") % 3).alias("c"),
        F.when(late > 0, 900.0).otherwise(100.0).alias("y"))


def test_importance_is_that_of_all_rows(spark):
    found = {r.feature: r.importance for r in modelling.forest_importance(late_rows(spark), SPEC).collect()}
    assert found["late"] > 0.99 and sum(found.values()) == pytest.approx(1)


def test_prices_are_predicted_from_all_rows(spark):
    df = durable(late_rows(spark))
    result = modelling.run_price_experiment(df, SPEC)
    rows = result.predictions.collect()
    assert {r.actual_price for r in rows} == {100.0, 900.0} and len(rows) == len({r.id for r in rows})
    assert all(r.random_forest_regressor_prediction == pytest.approx(r.actual_price, rel=1e-6) for r in rows)
    scores = {r.model: r for r in result.results.collect()}
    assert scores[modelling.FOREST].mae_eur == 0 and scores[modelling.FOREST].r2 == 1 and scores[modelling.DUMMY].mae_eur > 50


def test_all_rows_are_taken_unless_a_sample_is_asked_for(spark):
    rows = spark.range(5000)
    assert modelling.forest_sample(rows, SPEC).count() == modelling.around_sample(rows, SPEC).count() == 5000
    assert modelling.forest_sample(rows, replace(SPEC, forest_rows=7)).count() == 7


def vectors(spark, x, y, keys=None, parts=3):
    keys = range(len(x)) if keys is None else keys
    df = spark.createDataFrame([(k, [float(v) for v in a], float(b)) for k, a, b in zip(keys, x, y)], "id bigint, values array<double>, label double")
    return df.repartition(parts).select("id", array_to_vector("values").alias("features"), "label")


def test_cuts_come_from_all_values(spark):
    rng = np.random.default_rng(5)
    n = 15_000
    x = np.c_[rng.normal(size=n), rng.integers(0, 6, n), rng.random(n) < 0.5, np.ones(n), np.zeros(n)]
    x[77, 4] = 3.0  # one row in 15,000
    df = spark.createDataFrame([(a.tolist(),) for a in x], "values array<double>").repartition(5)
    layout = forest.fit_layout(df, 5, 16)
    values = np.sort(x[:, 0])
    low = values[[int(np.floor((n - 1) * k / 16)) for k in range(1, 16)]]
    assert layout.cuts[0].tolist() == [a / 2 + b / 2 for a, b in zip(low, values[np.searchsorted(values, low, side="right")])]
    assert layout.cuts[1].tolist() == [0.5, 1.5, 2.5, 3.5, 4.5] and layout.cuts[2].tolist() == [0.5]
    assert layout.cuts[3].tolist() == [] and layout.cuts[4].tolist() == [1.5]
    assert (layout.numbers, layout.flags, layout.width) == ([0, 1, 4], [2], 4)


def brute(x, cuts, weight, label, depth, minimum):
    """A tree by trying all cuts of all features: (feature, cut, left, right) or a mean."""
    whole, total = weight.sum(), (weight * label).sum()
    best = (0.0,)
    if depth and whole >= 2 * minimum:
        for f, bounds in enumerate(cuts):
            for cut in bounds:
                left = x[:, f] <= cut
                w, s = weight[left].sum(), (weight * label)[left].sum()
                if min(w, whole - w) >= minimum:
                    score = (s * whole - total * w) ** 2 / (w * (whole - w))
                    if score > best[0]:
                        best = (score, f, cut, left)
    if best[0] <= 0:
        return total / whole
    _, f, cut, left = best
    sides = [brute(x[rows], cuts, weight[rows], label[rows], depth - 1, minimum) for rows in (left, ~left)]
    return f, cut, *sides


def value_of(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def odd_rows(n, seed):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.normal(size=n), rng.integers(0, 5, n), rng.integers(0, 90, n) / 7, rng.random(n) < 0.3, rng.random(n) < 0.6, np.ones(n)]
    return x.astype(float), x[:, 0] + 2 * x[:, 3] + rng.normal(size=n)


@pytest.mark.parametrize("unit", [1 << 15, 16])
def test_trees_equal_those_by_trying_all_cuts(monkeypatch, unit):
    monkeypatch.setattr(forest, "UNIT_ROWS", unit)  # nodes grown together or a few at a time
    x, y = odd_rows(500, 1)
    cuts = [np.unique(np.quantile(c, np.arange(1, 12) / 12)) if len(np.unique(c)) > 12 else np.unique(c)[:-1] + 0.01 for c in x.T]
    layout = forest.Layout(cuts, [0, 1, 2], [3, 4])
    raw, label = layout.rows(x), np.round(y * 2 ** 20).astype(np.int32)
    weight = forest.drawn(np.arange(500, dtype=np.uint64), 3)
    assert weight.max() > 2 and abs(weight.mean() - 1) < 0.15 and (weight == 0).any()
    some = weight > 0
    grown = forest._Grower(layout, 7, 2).grown(
        [np.ascontiguousarray(layout.numeric(raw).T)[:, some], layout.slots(raw)[:, some], weight[some], label[some]], 0)
    nodes = forest._nodes(grown[0].astype(np.int16).tobytes(), grown[1].tobytes(), grown[2].tobytes(), layout)
    total = np.zeros(500)
    assert forest._walk(forest._Plan(layout, 1, 7, 2, {}, {}), 0, 1, nodes, raw.tobytes(), 500, total) == 500
    tree = brute(x[some], cuts, weight[some].astype(float), label[some].astype(float), 7, 2)
    assert total.tolist() == [value_of(tree, r) for r in x] and len(nodes[0]) > 60


def test_upper_levels_from_all_blocks_give_the_same_trees(spark):
    x, y = odd_rows(900, 2)
    key = modelling.sample_order(SPEC)
    whole = forest.grow_forest(vectors(spark, x, y), key, 4, 7, 2, 16, 512)
    cut = forest.grow_forest(vectors(spark, x, y, parts=5), key, 4, 7, 2, 16, 0, local_rows=60)  # a node in each pass
    assert not whole.plan.upper and sum(map(len, cut.plan.upper.values())) > 20
    assert whole.toDebugString == cut.toDebugString and whole.nodes == cut.nodes
    assert np.allclose(whole.featureImportances.toArray(), cut.featureImportances.toArray())
    df = vectors(spark, np.r_[x, x[:5]], np.r_[y, y[:5]], [*range(900), *[None] * 5]).withColumn("also", F.col("label") + 1)
    rows = [f.setPredictionCol("p").transform(df).orderBy("id", "label").collect() for f in (whole, cut)]
    assert rows[0] == rows[1] and len(rows[0]) == 905 and rows[0][0].also == rows[0][0].label + 1
    walk = modelling.forest_scores(cut)
    assert [r.p for r in cut.setPredictionCol("p").transform(df).withColumn("q", walk(F.col("features"))).where("p <> q").collect()] == []


def test_large_nodes_that_cannot_be_split_end_above(spark):
    x = np.c_[np.arange(300) % 2, np.zeros(300)]
    grown = forest.grow_forest(vectors(spark, x, x[:, 0] * 4), F.col("id"), 3, 5, 1, 16, 512, local_rows=50)
    assert len(grown.plan.ended) == 6 and grown.nodes == 9
    assert {r.prediction for r in grown.transform(vectors(spark, x, x[:, 0])).collect()} == {0.0, 4.0}
    assert grown.featureImportances.toArray().tolist() == [1.0, 0.0]


def test_equal_rows_are_drawn_each_for_itself(spark):
    x = np.zeros((400, 1))
    grown = forest.grow_forest(vectors(spark, x, np.arange(400) // 200, [None] * 400), F.col("id"), 30, 5, 1, 16, 512)
    means = [float(t.toDebugString.split(": ")[1]) for t in grown.trees]  # two sorts of rows, 200 of each
    assert len(set(means)) > 20 and abs(np.mean(means) - 0.5) < 0.05 and max(abs(m - 0.5) for m in means) < 0.2


def test_a_forest_needs_rows(spark):
    with pytest.raises(ValueError, match="training rows"):
        forest.grow_forest(vectors(spark, np.zeros((1, 1)), [1.0]).where("id < 0"), F.col("id"), 3, 5, 1, 16, 512)
