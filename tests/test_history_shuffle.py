"""Reading the stored history sorts no full rows before its shuffle."""

from playlens.sinks import history as H


def test_parts_are_dealt_before_they_are_combined(spark, tmp_path):
    def load(ids, at, name):
        return spark.createDataFrame([(i, f"{name}{i}", at, 0, f"{i}_{at}") for i in ids],
                                     "game_id int, name string, processed_timestamp long, batch_id long, doc_id string")

    path = str(tmp_path / "history")
    H.fold_documents(load(range(10), 100, "a").union(load([1, 1], 90, "x")), path, 0)
    H.fold_documents(load(range(5, 12), 200, "b").union(load([None], 300, "n")), path, 1)
    H.fold_documents(load([6], 150, "c"), path, 2)
    got = H.read_newest(spark, path)
    assert {r.game_id: r["name"] for r in got.collect()} == {**{i: f"a{i}" for i in range(5)}, **{i: f"b{i}" for i in range(5, 12)}}
    plan = H.read_newest(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Sort" not in plan.split("Exchange hashpartitioning")[1]
