"""Exported tree nodes walked in Arrow batches: no lambda per node, nulls as before."""

from pyspark.sql import functions as F

from playlens.operators import ml
from playlens.operators import model_values as mv

from .test_ml_gates import history


def test_nodes_are_walked_without_lambdas_and_nulls_go_right(spark):
    rows = history(spark, 200, 200)
    model, spec = ml.train_models(rows, ["rating"])["rating"], ml.SPEC_BY_NAME["rating"]
    nodes = mv.tree_nodes(spark, model)
    known = rows.where(F.greatest(*[F.col(c).isNull().cast("int") for c in spec.features]) == 0)
    empty = known.withColumns({c: F.lit(None).cast("double") for c in spec.features})
    out = mv.score_trees(empty, nodes, spec.features, "v")
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
    high = known.withColumns({c: F.lit(float("inf")) for c in spec.features})
    want = {r.v for r in mv.score_trees(high, nodes, spec.features, "v").collect()}
    assert {r.v for r in out.collect()} == want and len(want) == 1
