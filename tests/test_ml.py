from __future__ import annotations

import pytest
from conftest import rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderloom.ml import encode, metrics, models, score, split
from orderloom.plans.queries import STRONG
from orderloom.sources import standin


@pytest.fixture(scope="module")
def signal(spark):
    """Assembled rows whose label follows one feature with some noise."""
    df = spark.range(2000).selectExpr(
        "id AS order_id",
        "double(id % 17) AS strong",
        "double(id * 7 % 13) AS weak",
        "int(CASE WHEN id % 29 = 0 THEN id % 17 <= 8 ELSE id % 17 > 8 END) AS label",
    )
    return encode.fit_formula(df).transform(df).select("order_id", "label", "features").cache()


def test_index_order_and_indicators(spark):
    data = [("b",), ("b",), ("a",), ("a",), ("c",), ("c",), ("c",), ("d",)]
    df = spark.createDataFrame(data, "payment_type string")
    fitted = encode.encoder({"payment_type": "payment_type"}).fit(df)
    assert fitted.stages[0].labels == ["c", "a", "b", "d"]
    encoded = fitted.transform(df).select("payment_type", vector_to_array("payment_type_dum").alias("v"))
    assert dict(map(tuple, encoded.distinct().collect())) == {
        "c": [1, 0, 0], "a": [0, 1, 0], "b": [0, 0, 1], "d": [0, 0, 0],
    }


def test_unseen_value_keeps_the_vector_size(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "payment_type string")
    fitted = encode.encoder({"payment_type": "payment_type"}, unseen="keep").fit(train)
    later = spark.createDataFrame([("b",), ("new",)], "payment_type string")
    got = fitted.transform(later).select("payment_type", vector_to_array("payment_type_dum").alias("v"))
    assert dict(map(tuple, got.collect())) == {"b": [0, 1], "new": [0, 0]}


def test_numbers_are_indexed_by_count_then_text(spark):
    df = spark.createDataFrame([(10,), (9,), (2,), (2,)], "max_payment_installments int")
    fitted = encode.encoder({"max_payment_installments": "payment_installments"}).fit(df)
    assert fitted.stages[0].labels == ["2", "10", "9"]
    assert encode.encode(df, fitted).columns == ["payment_installments_dum"]


def test_model_column_lists():
    assert len(encode.model_columns()) == 95
    assert len(encode.RETAIL_CATEGORIES) == len(set(encode.RETAIL_CATEGORIES)) == 70
    assert len(encode.strong_columns()) == 12
    assert set(encode.strong_columns()) <= set(encode.model_columns())


def test_split_is_a_partition_by_key(spark):
    df = spark.range(5000).selectExpr("id % 2500 AS order_id", "id AS n")
    train, test = split.split_by_key(df)
    assert train.count() + test.count() == 5000
    assert train.join(test, "order_id").count() == 0
    assert abs(train.count() / 5000 - 0.7) < 0.03
    again, _ = split.split_by_key(df.repartition(7))
    assert rows(again) == rows(train)
    other, _ = split.split_by_key(df, seed=5)
    assert rows(other) != rows(train)


def test_random_split_is_a_partition(spark):
    df = spark.range(1000).cache()
    train, test = split.split_at_random(df)
    assert sorted(r.id for r in train.collect() + test.collect()) == list(range(1000))


def test_tree_finds_the_signal(signal):
    train, test = split.split_by_key(signal)
    model = models.fit_tree(train)
    scored = model.transform(test)
    majority = max(r["count"] for r in test.groupBy("label").count().collect()) / test.count()
    assert metrics.share(scored, "accuracy") > 0.9 > majority
    top = models.feature_importance(model, train, top=1).first()
    assert top["name"] == "strong" and top["score"] > 0.9
    every = models.feature_importance(model, train)
    assert abs(every.agg(F.sum("score")).first()[0] - 1) < 1e-9
    report = {r.metric: r.value for r in metrics.evaluate(scored).collect()}
    assert set(report) == {"area_under_roc", "area_under_pr", "accuracy", "f1"}


def test_logistic_regression_solves_its_equations(signal, spark):
    model = models.fit_logistic(signal)
    scored = model.transform(signal).select(
        "label", vector_to_array("probability")[1].alias("p"), vector_to_array("features")[0].alias("x")
    )
    left, weighted = scored.agg(F.avg(F.col("p") - F.col("label")), F.avg((F.col("p") - F.col("label")) * F.col("x"))).first()
    assert abs(left) < 1e-3 and abs(weighted) < 1e-2
    report = models.logistic_report(model, signal)
    assert {r.part: r["count"] for r in report.groupBy("part").count().collect()}["coefficient"] == 2
    losses = [r.value for r in report.where("part = 'objective'").orderBy("idx").collect()]
    assert losses == sorted(losses, reverse=True)
    curves = models.logistic_curves(model, signal)
    assert curves.where("x < 0 OR x > 1 OR y < 0 OR y > 1").count() == 0
    summary = {r.metric: r.value for r in models.training_summary(model, spark).collect()}
    assert summary["area_under_roc"] > 0.9


def test_cross_validation_picks_the_better_depth(signal, spark):
    fitted = models.cross_validate_tree(signal)
    report = models.cross_validation_report(fitted, spark)
    assert sorted(r.max_depth for r in report.collect()) == [2, 5]
    best = report.where("best").first()
    assert best.average_auc == report.agg(F.max("average_auc")).first()[0]
    assert models.CV_FOLDS == fitted.getNumFolds() == 2


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 0.9, 1.0), (0.0, 0.8, 1.0), (1.0, 0.8, 1.0), (0.0, 0.1, 0.0)], "label double, s double, prediction double")
    # positive above negative in 3 of 4 pairs, one of them tied
    assert abs(metrics.area(df, score="s", bins=0) - 0.875) < 1e-12
    assert metrics.share(df, "accuracy") == 0.75
    # class 1: precision 2/3, recall 1; class 0: precision 1, recall 1/2
    assert abs(metrics.share(df, "f1") - (0.8 + 2 / 3) / 2) < 1e-12


def test_curves_hold_every_score(spark):
    df = spark.range(5000).selectExpr("(id * 7 % 3001) / 3000 AS score", "int(id % 3 = 0) AS label")
    points = metrics.curves(df)
    assert points.where("curve = 'roc'").count() == points.where("curve = 'pr'").count() == 3001
    last = points.where("curve = 'roc' AND threshold = 0").first()
    assert (last["x"], last["y"]) == (1.0, 1.0)
    roc = sorted((r["x"], r["y"]) for r in points.where("curve = 'roc'").collect())
    area = sum((x - x0) * (y + y0) / 2 for (x0, y0), (x, y) in zip([(0.0, 0.0), *roc], roc))
    assert abs(area - metrics.area(df.withColumn("label", F.col("label").cast("double")), score="score")) < 1e-9


def test_the_scorer_is_the_evaluated_model(spark, folder):
    scorer, test = score.fit_with_test(standin.training_tables(spark, folder), standin.TRAINING, STRONG)
    again = score.fit_scorer(standin.training_tables(spark, folder), standin.TRAINING, STRONG)
    assert again.tree.toDebugString.split("\n")[1:] == scorer.tree.toDebugString.split("\n")[1:]
    holdout = score.holdout_basetable(standin.holdout_tables(spark, folder), scorer.stats, standin.HOLDOUT)
    size = lambda df: df.select(F.size(vector_to_array("features"))).first()[0]
    assert size(scorer.features(holdout)) == size(test) == scorer.tree.numFeatures


def test_holdout_scores(spark, folder):
    scorer = score.fit_scorer(standin.training_tables(spark, folder), standin.TRAINING, STRONG)
    scores = scorer.score(standin.holdout_tables(spark, folder), standin.HOLDOUT)
    assert scores.columns == ["order_id", "prediction"]
    from orderloom.operators.basetable import holdout_basetable

    base = holdout_basetable(standin.holdout_tables(spark, folder), scorer.stats, standin.HOLDOUT)
    assert rows(scores, "order_id") == rows(base, "order_id")
    assert {r.prediction for r in scores.select("prediction").distinct().collect()} <= {0.0, 1.0}


def test_crowded_scores_spread_over_ranges(spark):
    """All scores within a thousandth of each other: ranges follow their quantiles."""
    df = spark.range(0, 60_000, 1, 4).select((0.5 + F.col("id") / 60_000_000).alias("threshold"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    sizes = [r["count"] for r in metrics.score_ranges(df, 200).groupBy("place").count().collect()]
    assert len(sizes) > 150 and max(sizes) < 2 * 60_000 / len(sizes)
    points = metrics.curve_points(df, "threshold", ranges=200).orderBy(F.desc("threshold")).collect()
    tp = fp = 0
    for r in points[:2000] + points[-1:]:
        assert r is points[-1] or (r["tp"], r["fp"]) == (tp := tp + r["pos"], fp := fp + r["neg"])
    assert (points[-1]["tp"], points[-1]["fp"]) == (20_000, 40_000)


def test_rank_sum_equals_the_evaluator(spark):
    df = spark.range(3000).select((F.col("id") * 37 % 101 / 10).alias("score"), (F.col("id") * 13 % 7 < 3).cast("double").alias("label"))
    assert abs(metrics.rank_sum_area(df) - metrics.area(df, score="score")) < 1e-12
    one = df.where("label = 1.0")
    assert metrics.rank_sum_area(one) == 0.0 and metrics.rank_sum_area(df.limit(0)) == 0.0


def test_tables_of_folds_splits_and_equations(spark, signal):
    fitted = models.cross_validate_tree(signal)
    predictions = models.fold_predictions(fitted, signal)
    assert predictions.count() == 2 * signal.count()
    again = models.recomputed_averages(predictions)
    assert all(abs(again[d] - a) < 1e-9 for d, a in zip(models.CV_DEPTHS, fitted.avgMetrics))
    tree = models.fit_tree(signal)
    splits = models.tree_splits(tree, signal)
    own = {r["idx"]: r["score"] for r in models.importance_of_splits(splits).collect()}
    assert all(abs(own.get(i, 0.0) - float(w)) < 1e-9 for i, w in enumerate(tree.featureImportances.toArray()))
    root = splits.where("node = 0").first()
    assert (root["name"], root["rows"]) == ("strong", 2000.0) and 8 <= root["threshold"] < 9
    equations = models.score_equations(models.fit_logistic(signal, tol=1e-12, maxIter=200), signal).collect()
    assert {r["name"] for r in equations} == {"intercept", "strong", "weak"} and all(abs(r["gradient"]) < 1e-6 for r in equations)


def test_a_saved_scorer_says_the_same(spark, folder, tmp_path):
    given = standin.training_tables(spark, folder)
    scorer = score.fit_scorer(given, standin.TRAINING, STRONG)
    scorer.save(str(tmp_path / "scorer"))
    loaded = score.load_scorer(spark, str(tmp_path / "scorer"))
    assert loaded.stats == scorer.stats and tuple(loaded.categories) == tuple(scorer.categories)
    holdout = standin.holdout_tables(spark, folder)
    assert rows(loaded.score(holdout, standin.HOLDOUT)) == rows(scorer.score(holdout, standin.HOLDOUT))
