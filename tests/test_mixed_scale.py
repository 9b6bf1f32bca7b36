"""The join strategy reads the games as often as it must: for the distinct arrays, and for the rows."""

from playlens.operators import dimensions as D
from playlens.sources import fixtures as fx


def test_mixed_join_plan_reads_the_games_twice(spark):
    games = spark.range(40).selectExpr("cast(id as int) id", "array(cast(id % 3 as int), 7) genres", "array(cast(1 as int)) platforms")
    mixed = games.selectExpr("id", "parse_json(to_json(genres))::array<variant> genres", "parse_json(to_json(platforms))::array<variant> platforms")
    out = D.translate_game(mixed, fx.dimensions(spark), "join")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 40") == 2


def test_many_rows_without_elements_are_spread_and_kept(spark):
    games = spark.range(3000).selectExpr("cast(id as int) id", "cast(if(id % 100 = 0, array(0, 1), if(id % 2 = 0, array(), null)) as array<int>) genres")
    mixed = games.selectExpr("id", "parse_json(to_json(genres))::array<variant> genres")
    for raw in (games, mixed):
        got = D.translate_game(raw, fx.dimensions(spark), "join")
        want = D.translate_game(raw, fx.dimension_maps(), "map")
        cols = ["id", "genres"] if raw is games else ["id", "genre_ids", "genres"]
        assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(map(tuple, want.select(cols).collect()), key=str)
        assert got.count() == 3000
