"""SQL functions, memo key and the batch jobs."""

from pyspark.sql import functions as F

from playlens import constants as C
from playlens.functions import scores as S
from playlens.functions.sentiment import memo_key
from playlens.functions.sql_functions import register_sql_functions
from playlens.plans import jobs
from playlens.plans import queries as Q
from playlens.sources import fixtures as fx

from .conftest import SF_SMALL


def test_sql_functions_equal_column_functions(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([(["Action", "RPG", "X"], ["PlayStation 5", "Mac"]),
                                ([], None)], "genres array<string>, platforms array<string>")
    df.createOrReplaceTempView("lists")
    got = spark.sql("SELECT genre_popularity_score(genres) g, "
                    "platform_reach_score(platforms) p FROM lists").collect()
    want = df.select(S.genre_popularity_score("genres").alias("g"),
                     S.platform_reach_score("platforms").alias("p")).collect()
    assert got == want


def test_memo_key(spark):
    df = spark.createDataFrame([("Game 1", 13), ("Game 1", 7), ("Game 2", 0)],
                               "name string, days_to_release int")
    assert [r[0] for r in df.select(memo_key()).collect()] == ["Game 1_1", "Game 1_1", "Game 2_0"]


def test_bulk_import_and_crawl(spark, tmp_path):
    raw_path = str(tmp_path / "raw")
    Q.raw_games(spark, SF_SMALL).write.json(raw_path)
    raw = jobs.read_raw_games(spark, raw_path)
    out = str(tmp_path / "bulk")
    stats = jobs.bulk_import(raw, fx.dimension_maps(), out, C.AS_OF_EPOCH,
                             bound_epoch=Q.PAGE_BOUND).collect()[0]
    assert stats["documents"] == raw.where(F.col("first_release_date") >= Q.PAGE_BOUND).count()
    msgs = jobs.crawl(raw, fx.dimension_maps(), C.AS_OF_EPOCH)
    assert msgs.count() == C.RECENT_TOP_K
    assert set(msgs.columns) == {"key", "value"}


def test_keyset_pages_equal_offset_pages(spark):
    from playlens.operators import selection as sel
    g = Q.raw_games(spark, SF_SMALL).select("id", "first_release_date").cache()
    size, after = 40, None
    for page in range(3):
        by_offset = [tuple(r) for r in sel.release_page(g, Q.PAGE_BOUND, page, size).collect()]
        by_key = [tuple(r) for r in
                  sel.release_page_after(g, Q.PAGE_BOUND, after, size).collect()]
        assert by_key == by_offset
        after = (by_key[-1][1], by_key[-1][0])
    g.unpersist()


def test_history_of_both_writers(spark, tmp_path):
    from playlens.operators import enrich
    from playlens.sinks import documents as sinks
    docs = Q.documents_of(spark, SF_SMALL)
    sinks.write_documents(docs, str(tmp_path / "stream"))
    bulk = enrich.bulk_document(Q.raw_games(spark, SF_SMALL), fx.dimension_maps(), C.AS_OF_EPOCH)
    sinks.append_documents(bulk, str(tmp_path / "bulk"))
    both = sinks.read_history(spark, str(tmp_path / "stream"), str(tmp_path / "bulk"))
    stored = sinks.read_history(spark, str(tmp_path / "stream"))
    assert both.count() == docs.count() + bulk.count()
    assert sorted(map(str, stored.collect())) == sorted(map(str, Q.history_of(spark, SF_SMALL).collect()))
    dated = both.groupBy("game_id").agg({"release_date": "count"}).where("`count(release_date)` = 1")
    assert dated.count() == 0          # both writers give a game's release, or neither does
