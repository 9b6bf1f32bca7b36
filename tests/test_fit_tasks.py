"""Tasks of a training pass follow the rows and cores, not the partitions that a shuffle left."""

from playlens.operators import ml

from .test_ml_gates import history


def test_fits_run_in_as_many_tasks_as_the_rows_need(spark, monkeypatch):
    seen, whole = [], ml.ModelSpec.pipeline

    def spied(self):
        made = whole(self)
        fit = made.fit

        def noted(rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))
            return fit(rows)

        made.fit = noted
        return made

    monkeypatch.setattr(ml.ModelSpec, "pipeline", spied)
    rows = history(spark, 200, 200).repartition(150)
    assert set(ml.train_models(rows, ["longevity", "success"])) == {"longevity", "success"}
    cores = spark.sparkContext.defaultParallelism
    assert seen == [(min(150, 2 * cores), 200)] * 2         # fewer tasks, all rows


def test_tasks_grow_with_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert ml.fit_tasks(spark, 10) == 2 * cores
    assert ml.fit_tasks(spark, 1000 * cores * ml.ROWS_PER_TASK + 1) == 1000 * cores + 1


def test_a_pass_over_many_rows_has_few_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    assert ml.fit_tasks(spark, 54_000_000) == max(2 * cores, 54)
