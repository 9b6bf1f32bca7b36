"""Versioned folders: the memo's value store and the newest-document history."""

import os

from pyspark.sql import functions as F

from playlens import constants as C
from playlens.sinks import history
from playlens.sinks.snapshots import Snapshots
from playlens.sources import stream as st
from playlens.streaming.pipeline import MEMO_VALUES, _kept_values, start_enrichment
from tests.test_stream_ml_plans import _memo_env


def _files(path):
    return sum(n.endswith(".parquet") for _, _, names in os.walk(path) for n in names)


def test_a_reader_sees_one_version_or_the_next(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "s"))
    assert store.state() == {"parts": []} and store.read([], "id int").count() == 0
    rows = lambda n: spark.createDataFrame([(n,)], "id int")
    a = store.write_part(rows(1), "a")
    store.commit(0, {"parts": [a]})
    reading = store.read(store.state()["parts"], "id int")
    b = store.write_part(rows(2), "b")
    assert [r.id for r in store.read(store.state()["parts"], "id int").collect()] == [1]     # written, not committed
    store.commit(1, {"parts": [b]})
    assert [r.id for r in reading.collect()] == [1]                                           # the old folder is still there
    assert [r.id for r in store.read(store.state()["parts"], "id int").collect()] == [2]
    store.commit(1, {"parts": [b], "again": True})                                            # a replay replaces its own
    assert store.state()["again"] and store.state(0)["parts"] == [a]
    store.commit(2, {"parts": [b]})
    assert store.versions() == [1, 2] and os.listdir(tmp_path / "s" / "parts") == ["b"]


def _docs(spark, rows):
    return spark.createDataFrame(rows, "game_id int, name string, hypes int, processed_timestamp long, batch_id long, doc_id string")


def test_newest_document_of_each_game_over_many_loads(spark, tmp_path):
    path = str(tmp_path / "h")
    for v in range(12):
        rows = [(1, f"one {v}", v, 100 + v, v, f"1_{v}"), (v + 10, f"own {v}", None, 50, v, None), (None, "no game", 1, 999, v, "x")]
        history.fold_documents(_docs(spark, rows + [(2, "late", v, 1000 - v, v, f"2_{v}")]), path, v, most=4)
    got = {r.game_id: r.name for r in history.read_newest(spark, path).collect()}
    assert got == {1: "one 11", 2: "late", **{v + 10: f"own {v}" for v in range(12)}}
    assert len(Snapshots(spark, path).state()["parts"]) <= 4 and _files(path) < 40
    two = history.read_newest(spark, path).where("game_id = 2").first()
    assert two.hypes == 0 and two.community_sentiment_score == 50.0                           # load 0 is the newest of game 2; filled
    history.fold_documents(_docs(spark, [(1, "replayed", 1, 500, 11, "1_11")]), path, 11, most=4)
    assert history.read_newest(spark, path).where("game_id = 1").first().name == "replayed"
    assert history.read_newest(spark, path).where("game_id = 21").count() == 0                # its only load was replaced


def test_ties_and_both_writers(spark, tmp_path):
    path = str(tmp_path / "h")
    bulk = spark.sql("""select 1 as game_id, 'bulk' as name, 7 as hypes, 86400L as release_date, '1970-01-02T00:00:00' as release_date_formatted,
                        10L as processed_timestamp, '1_10' as doc_id union all select 2, 'bulk', 1, null, null, 10L, '2_10'""")
    history.fold_documents(bulk, path, 0)
    history.fold_documents(_docs(spark, [(1, "a", 1, 10, 3, "a"), (1, "b", 2, 10, 3, "b")]), path, 1)
    got = {r.game_id: (r.name, r.release_date) for r in history.read_newest(spark, path).collect()}
    assert got == {1: ("b", None), 2: ("bulk", None)}
    assert history.read_newest(spark, path, 0).where("game_id = 1").first().release_date == "1970-01-02T00:00:00"


def _sources(spark):
    return (spark.createDataFrame([], "game_id int, title string, score int, rank int, posted_at timestamp"),
            spark.createDataFrame([], "game_id int, slug string, html string"))


def test_the_value_store_of_a_long_stream_stays_small(spark, tmp_path):
    """A hundred micro-batches: the files read, and the files kept, do not grow with them."""
    store = Snapshots(spark, str(tmp_path / "values"), most=8)
    base = spark.range(1).select(F.lit("k").alias("_memo_key"), F.lit(0.5).alias("community_sentiment_score"),
                                 F.lit("neutral").alias("community_sentiment_label"), F.lit(1).alias("community_data_volume"),
                                 F.lit("s").alias("sentiment_source")).cache()
    read, step, ttl = [], 600, 3600
    for n in range(100):
        at, before = n * step, store.state(n - 1)
        new = store.write_part(base.select(base["_memo_key"], F.lit(at).cast("long").alias("_memo_at"), *base.columns[1:]).coalesce(1),
                               f"batch-{n}", high=at)
        live = [p for p in [*before["parts"], new] if p["high"] >= at - ttl]
        read.append(len(store.read(live, MEMO_VALUES).inputFiles()))
        store.commit(n, _kept_values(store, before, new, at, ttl, n))
    assert max(read) <= 9 and _files(tmp_path / "values") <= 27
    kept = sorted(r._memo_at for r in store.read(store.state()["parts"], MEMO_VALUES).collect())
    assert kept[-1] == 99 * step and set(range(99 * step - 2 * ttl, 99 * step, step)) <= set(kept)


def test_a_late_row_still_has_a_value(spark, tmp_path):
    """Values are dropped after two TTLs; a row later than that computes its own."""
    t0, src = C.AS_OF_EPOCH, tmp_path / "in"
    _memo_env(spark, src, [(t0, "Old", 10), (t0 + 30_000, "New", 20), (t0 + 30_001, "New", 500), (t0 + 5, "Old", 10)])
    start_enrichment(st.file_stream(spark, str(src) + "/*", max_files_per_trigger=1), *_sources(spark),
                     str(tmp_path / "out"), str(tmp_path / "ck"), as_of_fn=lambda b: t0, available_now=True,
                     memo_ttl=3600).awaitTermination()
    got = [round(r.community_sentiment_score, 6) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("batch_id").collect()]
    assert len(got) == 4 and got[0] == got[3] and got[1] == got[2]
