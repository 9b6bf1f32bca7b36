"""Arrays that mix ids and names, through both strategies and the jobs."""

import json

import pytest

from playlens import constants as C
from playlens.operators import dimensions as D
from playlens.plans import jobs
from playlens.schemas import RAW_MIXED_GAME
from playlens.sources import fixtures as fx

NAMES = C.DIM_GENRES
CASES = [
    # (raw list, ids, names)
    ([0, 1], [0, 1], [NAMES[0], NAMES[1]]),
    ([NAMES[0], 2], [0, 2], [NAMES[0], NAMES[2]]),                    # id 0 is kept
    (["No such", NAMES[1]], [1], ["No such", NAMES[1]]),
    ([9999, NAMES[3]], [9999, 3], ["Unknown_9999", NAMES[3]]),
    ([True, None, 1.5, {"a": 1}, [2], 2], [2], [NAMES[2]]),           # neither ids nor names
    (["12"], [], ["12"]),                                             # a name of digits stays a name
    ([1, 1, NAMES[1]], [1, 1, 1], [NAMES[1]] * 3),
    ([], [], []),
    (None, [], []),
]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("mixed") / "games.json"
    rows = [{"id": i, "name": f"g{i}", "first_release_date": 1_900_000_000, "hypes": i, "genres": g, "platforms": [NAMES[0]]}
            for i, (g, _, _) in enumerate(CASES)]
    path.write_text("\n".join(json.dumps({k: v for k, v in r.items() if v is not None}) for r in rows))
    return jobs.read_raw_games(spark, str(path), mixed=True)


@pytest.mark.parametrize("strategy", ["map", "join"])
def test_ids_and_names_of_mixed_arrays(spark, raw, strategy):
    dims = fx.dimension_maps() if strategy == "map" else fx.dimensions(spark)
    got = {r.id: (r.genre_ids, r.genres) for r in D.translate_game(raw, dims, strategy).collect()}
    assert got == {i: (ids, names) for i, (_, ids, names) in enumerate(CASES)}


@pytest.mark.parametrize("strategy", ["map", "join"])
def test_arrays_of_names_alone_and_whole_variants(spark, strategy):
    rows = spark.sql("""select 1 as id, array('Adventure', 'x', null) as genres, parse_json('["Linux", 3, 0]') as platforms
                        union all select 2, null, parse_json('"no list"')""")
    dims = {"genres": {0: "Shooter", 5: "Adventure"}, "platforms": {0: "PC", 3: "Mac", 9: "Linux"}}
    if strategy == "join":
        dims = {k: D.as_frame(v, spark) for k, v in dims.items()}
    got = D.translate_game(rows, dims, strategy).orderBy("id").select("genre_ids", "genres", "platform_ids", "platforms").collect()
    assert [tuple(r) for r in got] == [([5], ["Adventure", "x"], [9, 3, 0], ["Linux", "Mac", "PC"]), ([], [], [], [])]


def test_jobs_accept_mixed_arrays(spark, raw, tmp_path):
    out = str(tmp_path / "bulk")
    assert jobs.bulk_import(raw, fx.dimension_maps(), out, C.AS_OF_EPOCH).first()["documents"] == len(CASES)
    docs = {r.game_id: (r.genre_ids, r.genres, r.genre_count) for r in spark.read.parquet(out).collect()}
    assert docs == {i: (ids, names, len(names)) for i, (_, ids, names) in enumerate(CASES)}
    messages = {r.key: json.loads(r.value) for r in jobs.crawl(raw, fx.dimension_maps(), C.AS_OF_EPOCH).collect()}
    assert messages["1"]["genre_ids"] == [0, 2] and messages["1"]["genres"] == [NAMES[0], NAMES[2]]


def test_rows_without_elements_bypass_the_join(spark):
    rows = spark.createDataFrame([(i, None if i % 2 else []) for i in range(6)] + [(9, [1])], "id int, genres array<int>")
    out = D.translate(rows, "genres", D.as_frame({1: "a"}, spark), "names", "join")
    assert {r.id: r.names for r in out.collect()} == {**{i: [] for i in range(6)}, 9: ["a"]}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("size(genres") >= 3        # both sides of the split, and the keys


def test_schema_names_the_mixed_fields():
    kinds = {f.name: f.dataType.simpleString() for f in RAW_MIXED_GAME.fields}
    assert kinds["genres"] == "array<variant>" and kinds["franchises"] == "array<int>"
