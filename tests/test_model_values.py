"""Fitted models by value: exported nodes against ``pyspark.ml``, and against plain Python."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from playlens.operators import ml
from playlens.operators import model_values as mv

from .test_ml_gates import history


def walk(nodes, values):
    """Leaf reached in each tree, by plain Python."""
    out = []
    for tree in sorted({n["tree"] for n in nodes}):
        by_id = {n["node"]: n for n in nodes if n["tree"] == tree}
        at = by_id[0]
        while at["left"] >= 0:
            at = by_id[at["left"] if values[at["feature"]] <= at["threshold"] else at["right"]]
        out.append(at)
    return out


@pytest.mark.parametrize("name", ["rating", "rating_count"])
def test_nodes_score_like_the_model(spark, name):
    rows = history(spark, 300, 300)
    model, spec = ml.train_models(rows, [name])[name], ml.SPEC_BY_NAME[name]
    nodes = mv.tree_nodes(spark, model)
    mean = spec.kind == "rf"
    got = mv.score_trees(ml._apply(rows, spec, model), nodes, spec.features, "by_nodes", mean).collect()
    held = nodes.collect()
    assert len(got) == 300 and len({r["by_nodes"] for r in got}) > 10
    for r in got:
        assert r["by_nodes"] == pytest.approx(r[spec.prediction], rel=1e-9)
        leaves = walk(held, [float(r[c]) for c in spec.features])
        want = sum(n["value"] * (1 / len(leaves) if mean else n["weight"]) for n in leaves)
        assert r["by_nodes"] == pytest.approx(want, rel=1e-9)


def test_leaf_means_and_a_changed_node(spark):
    rows = history(spark, 300, 300)
    model, spec = ml.train_models(rows, ["rating"])["rating"], ml.SPEC_BY_NAME["rating"]
    nodes = mv.tree_nodes(spark, model)
    for r in mv.leaf_means(rows, nodes, spec.features, spec.label).collect():
        assert r["rows"] == r["seen"] and r["value"] == pytest.approx(r["mean"], rel=1e-9)
    wrong = nodes.withColumn("threshold", F.when(F.col("node") == 0, -1e9).otherwise(F.col("threshold")))
    off = mv.leaf_means(rows, wrong, spec.features, spec.label).where("NOT rows <=> seen").count()
    assert off > 0                      # the check sees a tree that was not fitted on these rows


def test_tree_of_one_leaf_and_no_rows(spark):
    rows = history(spark, 120, 120).withColumn("longevity_score", F.lit(4.0))
    model, spec = ml.train_models(rows, ["longevity"])["longevity"], ml.SPEC_BY_NAME["longevity"]
    nodes = mv.tree_nodes(spark, model)
    out = mv.score_trees(rows, nodes, spec.features, "v", mean=True)
    assert {round(r["v"], 9) for r in out.collect()} == {4.0}
    assert mv.score_trees(rows.limit(0), nodes, spec.features, "v", mean=True).count() == 0


def test_too_many_nodes_is_an_error(spark, monkeypatch):
    rows = history(spark, 120, 120)
    model = ml.train_models(rows, ["longevity"])["longevity"]
    monkeypatch.setattr(mv, "MOST_NODES", 3)
    with pytest.raises(ValueError, match="more than 3 nodes"):
        mv.score_trees(rows, mv.tree_nodes(spark, model), ["hypes"], "v")


def test_softmax_is_the_models_probability(spark):
    from pyspark.ml.functions import vector_to_array
    rows = history(spark, 300, 300)
    model, spec = ml.train_models(rows, ["success"])["success"], ml.SPEC_BY_NAME["success"]
    assert isinstance(model, PipelineModel)
    out = model.transform(rows).select(vector_to_array("probability").alias("p"),
                                       mv.softmax(model.stages[-1], spec.features).alias("q"))
    for r in out.collect():
        assert list(r["q"]) == pytest.approx(list(r["p"]), abs=1e-9)
