"""A fit that fails is an error, not a model that is missing."""

import pytest

from playlens.operators import ml
from playlens.plans import jobs, queries

from .test_ml_gates import history


@pytest.fixture
def failing(monkeypatch):
    """Only the fit of ``rating`` fails."""
    whole = ml.ModelSpec.pipeline

    def pipeline(self):
        made = whole(self)
        if self.name == "rating":
            def fit(rows):
                raise ValueError("executor lost")
            made.fit = fit
        return made

    monkeypatch.setattr(ml.ModelSpec, "pipeline", pipeline)


def test_a_failed_fit_is_an_error(spark, failing, tmp_path):
    h = history(spark, 150, 150)
    with pytest.raises(RuntimeError, match="rating") as e:
        ml.train_models(h, ["success", "rating"])
    assert isinstance(e.value.__cause__, ValueError)
    assert set(ml.train_models(h, ["success"])) == {"success"}
    with pytest.raises(RuntimeError, match="rating"):       # no version without the model is published
        jobs.train(h, str(tmp_path / "models"), "v1", ["success", "rating"])
    assert ml.latest_version(spark, str(tmp_path / "models")) is None


def test_predictions_of_a_failed_fit_are_an_error(spark, failing, monkeypatch):
    monkeypatch.setattr(queries, "history_of", lambda spark, sf: history(spark, 150, 150))
    with pytest.raises(RuntimeError, match="rating"):
        queries.trained(spark, "no folder", ["success", "rating"])
    assert not any(sf == "no folder" for _, sf, _ in queries._MODELS)


def test_a_gate_that_does_not_pass_is_no_failure(spark, failing):
    assert ml.train_models(history(spark, 100, 100), ["rating"]) == {}
    unrated = history(spark, 150, 150).withColumn("rating", ml.F.lit(None).cast("double"))
    assert ml.train_models(unrated, ["rating"]) == {}
