"""Model gates at their exact boundaries and deterministic refits."""

import pytest

from playlens.operators import ml

COLS = ("hypes int, follows int, rating_count int, franchise_count int, platform_count int,"
        " genre_count int, total_rating double, aggregated_rating double,"
        " community_sentiment_score double, rating double, longevity_score double,"
        " success_level int")


def history(spark, total, positive_counts):
    rows = []
    for i in range(total):
        rc = (i % 50) + 1 if i < positive_counts else 0
        rows.append((i % 7, i * 3 % 11, rc, i % 3, i % 4, i % 5, float(i % 9), float(i % 13),
                     50.0, float(40 + i % 50), float(i % 30), i % 3))
    return spark.createDataFrame(rows, COLS)


@pytest.mark.parametrize("positives,expected", [(30, False), (31, True)])
def test_rating_count_gate(spark, positives, expected):
    models = ml.train_models(history(spark, 101, positives), ["rating_count"])
    assert ("rating_count" in models) is expected


@pytest.mark.parametrize("total,expected", [(100, False), (101, True)])
def test_total_gate(spark, total, expected):
    models = ml.train_models(history(spark, total, total), ["longevity"])
    assert bool(models) is expected


def test_success_gate_counts_imputed_labels(spark):
    # with imputed labels every row trains the classifier (nulls become class 0)
    h = history(spark, 101, 101).withColumn("success_level", ml.F.lit(None).cast("int"))
    counts = ml.gate_counts(ml.training_frame(h), [ml.SPEC_BY_NAME["success"]])
    assert counts["success"] == 101
    strict = ml.gate_counts(ml.training_frame(h, impute_labels=False),
                            [ml.SPEC_BY_NAME["success"]])
    assert strict["success"] == 0


def test_random_forest_refit_is_deterministic(spark):
    h = history(spark, 150, 150)
    a = ml.train_models(h, ["longevity"])["longevity"]
    b = ml.train_models(h, ["longevity"])["longevity"]
    pa = [r[0] for r in a.transform(h).select("predicted_longevity").collect()]
    pb = [r[0] for r in b.transform(h).select("predicted_longevity").collect()]
    assert pa == pb


def test_published_versions_and_registry(spark, tmp_path):
    from playlens.plans import jobs
    root = str(tmp_path / "models")
    reg = ml.ModelRegistry(root, refresh_seconds=10, spark=spark)
    assert reg.get(0.0) == {}                      # nothing published yet
    h = history(spark, 150, 150)
    jobs.train(h, root, "v1", ["longevity"])
    assert set(reg.get(1.0)) == {"longevity"} and reg.version == "v1"
    jobs.train(h, root, "v2", ["longevity", "rating_count"])
    assert reg.get(5.0) and reg.version == "v1"    # still fresh
    assert set(reg.get(12.0)) == {"longevity", "rating_count"} and reg.version == "v2"
