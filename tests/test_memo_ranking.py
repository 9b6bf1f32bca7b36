"""TTL memo and balanced rankings against brute force on small fixtures."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from playlens.operators.memo import ttl_memo
from playlens.operators.ranking import row_number_by, top_k_per_group
from playlens.streaming.memo_state import stream_memo


def brute_memo(rows, ttl):
    out = {}
    by_key = {}
    for k, t, i, v in rows:
        by_key.setdefault(k, []).append((t, i, v))
    for k, evs in by_key.items():
        at = val = None
        for t, i, v in sorted(evs):
            if at is None or t - at >= ttl:
                at, val = t, v
            out[i] = (at, val)
    return out


def _events(seed, n=400, keys=3, span=20000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one hot key holding most rows, plus tied timestamps
        k = 0 if rnd.random() < 0.6 else rnd.randrange(1, keys)
        t = rnd.randrange(0, span) // 7 * 7
        rows.append((k, t, i, float(rnd.randrange(100))))
    return rows


def test_ttl_memo_matches_brute_force(spark):
    for seed, ttl in [(1, 600), (2, 3600), (3, 7)]:
        rows = _events(seed)
        df = spark.createDataFrame(rows, "k int, t long, id long, v double")
        got = {r["id"]: (r["memo_at"], r["memo_value"])
               for r in ttl_memo(df, "k", "t", "id", "v", ttl, split_seconds=50).collect()}
        assert got == brute_memo(rows, ttl)


def test_ttl_memo_boundary(spark):
    rows = [(0, 0, 1, 1.0), (0, 3599, 2, 2.0), (0, 3600, 3, 3.0), (0, 7199, 4, 4.0),
            (0, 7200, 5, 5.0)]
    df = spark.createDataFrame(rows, "k int, t long, id long, v double")
    got = {r["id"]: (r["memo_at"], r["memo_value"])
           for r in ttl_memo(df, "k", "t", "id", "v", 3600).collect()}
    assert got == {1: (0, 1.0), 2: (0, 1.0), 3: (3600, 3.0), 4: (3600, 3.0), 5: (7200, 5.0)}


@pytest.mark.parametrize("watermark", [None, "0 seconds"])
def test_stream_memo_equals_batch(spark, tmp_path, watermark):
    rows = _events(7, n=200, span=9000)
    ttl = 1000
    pdf = pd.DataFrame(rows, columns=["k", "t", "event_id", "score"])
    pdf = pdf.sort_values(["t", "event_id"])
    src = tmp_path / "in"
    # three files in time order, one per micro-batch
    for j, part in enumerate([pdf.iloc[:70], pdf.iloc[70:140], pdf.iloc[140:]]):
        spark.createDataFrame(part, "k int, t long, event_id long, score double") \
            .coalesce(1).write.mode("overwrite").parquet(str(src / f"p{j}"))
    stream = (spark.readStream.schema("k int, t long, event_id long, score double")
              .option("maxFilesPerTrigger", 1).parquet(str(src) + "/*"))
    name = "memo_out_wm" if watermark else "memo_out"
    q = (stream_memo(stream, ttl, watermark).writeStream.format("memory").queryName(name)
         .outputMode("append").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r["event_id"]: (r["memo_at"], r["memo_value"])
           for r in spark.sql(f"select * from {name}").collect()}
    assert got == brute_memo(rows, ttl)


def test_row_number_by_matches_window(spark):
    rnd = random.Random(5)
    rows = [(0 if rnd.random() < 0.5 else rnd.randrange(1, 4), rnd.randrange(0, 5000), i)
            for i in range(500)]
    df = spark.createDataFrame(rows, "g int, t long, id long")
    got = row_number_by(df, ["g"], ["t", "id"], F.floor(F.col("t") / 300), "rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")))
    assert sorted(map(tuple, got.select("id", "rn").collect())) == \
        sorted(map(tuple, want.select("id", "rn").collect()))


def test_top_k_per_group(spark):
    rows = [(i % 3 if i % 5 else 0, i * 7 % 101, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, v long, id long")
    got = top_k_per_group(df, ["g"], [F.col("v").desc(), "id"], 4, "pos", salts=8)
    want = df.withColumn("pos", F.row_number().over(
        Window.partitionBy("g").orderBy(F.col("v").desc(), "id"))).where("pos <= 4")
    assert sorted(map(tuple, got.select("g", "id", "pos").collect())) == \
        sorted(map(tuple, want.select("g", "id", "pos").collect()))


def test_row_number_by_two_level(spark):
    rnd = random.Random(9)
    rows = [(rnd.randrange(0, 40) * 1000, i) for i in range(600)]
    df = spark.createDataFrame(rows, "t long, id long")
    got = row_number_by(df, [], ["t", "id"],
                        F.struct(F.col("t").alias("t"), F.shiftright("id", 6).alias("b")),
                        "rn", coarse=F.floor(F.col("t") / 7000))
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("t", "id")))
    assert sorted(map(tuple, got.select("id", "rn").collect())) == \
        sorted(map(tuple, want.select("id", "rn").collect()))
