"""The newest of each game: shuffled as compressed blocks, without a sort of full rows."""

import random

import pyarrow as pa

from playlens.sinks import history as H

COLS = "game_id int, tags array<string>, processed_timestamp long, batch_id long, doc_id string"


def some_docs(seed, n):
    r = random.Random(seed)
    out = []
    for i in range(n):
        game = r.choice([None, 7, 7, 7, r.randrange(40)])           # game 7 holds most rows
        out.append((game, [f"t{i}"] * r.randrange(3) if i % 5 else None, r.choice([None, -1, 3, 4]),
                    r.choice([None, 0, 1]), r.choice([None, "", "a", "B", "é", f"z{i}"])))
    return out


def order(row):
    at, batch, doc = row[2:]
    return (-1 if at is None else at, -1 if batch is None else batch, (doc or "").encode())


def newest_by_force(rows):
    best = {}
    for row in rows:
        if row[0] is not None:
            best[row[0]] = max(best.get(row[0], order(row)), order(row))
    return best


def test_newest_matches_brute_force(spark):
    rows = some_docs(1, 600)
    got = [tuple(r) for r in H.newest(spark.createDataFrame(rows, COLS).repartition(5)).collect()]
    assert {r[0]: order(r) for r in got} == newest_by_force(rows) and len(got) == len(newest_by_force(rows))
    assert all(r in rows for r in got)                       # whole rows, nulls as they were
    few = H.newest(spark.createDataFrame(rows, COLS), keep=["tags", "game_id"])
    assert few.columns == ["tags", "game_id"] and few.count() == len(got)
    assert H.newest(spark.createDataFrame([], COLS)).collect() == []


def test_rows_dealt_by_game_are_not_shuffled_again(spark):
    rows = some_docs(3, 300)
    dealt = H.newest(spark.createDataFrame(rows, COLS).repartition("game_id"))
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {r[0]: order(r) for r in dealt.collect()} == newest_by_force(rows)


def test_loads_sort_no_rows(spark):
    plan = H.newest(spark.createDataFrame(some_docs(2, 50), COLS))._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_reads_shuffle_blocks(spark, tmp_path):
    path = str(tmp_path / "history")
    for version in range(3):
        rows = spark.createDataFrame(some_docs(version, 200), COLS.replace("tags", "genres"))
        H.fold_documents(rows.withColumn("processed_timestamp", H.F.lit(version)), path, version)
    read = H.read_newest(spark, path)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange hashpartitioning(block" in plan
    assert sorted(r.game_id for r in read.collect()) == sorted(
        {r[0] for v in range(3) for r in some_docs(v, 200) if r[0] is not None})


def test_a_hot_game_costs_a_task_one_row_a_block(monkeypatch):
    monkeypatch.setattr(H, "PACK_BYTES", 1)                  # every batch is a block
    batches = [pa.RecordBatch.from_pydict({"_block": pa.array([0] * 100, pa.int32()), "_key": [7] * 100,
                                           "_a": [k] * 100, "_b": list(range(100)), "_c": ["x"] * 100,
                                           "name": [f"{k}-{i}" for i in range(100)]}) for k in (1, 3, 2)]
    blocks = list(H._packed(iter(batches)))
    assert len(blocks) == 3
    assert all(pa.ipc.open_stream(b.column(1)[0].as_buffer()).read_all().num_rows == 1 for b in blocks)
    assert [r for b in H._unpacked(iter(blocks)) for r in b.to_pylist()] == [{"name": "3-99"}]
