"""The two list scores as SQL functions, for use from ``spark.sql``.

They are SQL UDFs (``CREATE TEMPORARY FUNCTION ... RETURN <expression>``),
so the optimizer inlines them: no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import constants as C


def _map_sql(weights: dict) -> str:
    parts = []
    for k, v in weights.items():
        parts += ["'" + k.replace("'", "''") + "'", f"CAST({v} AS DOUBLE)"]
    return "map(" + ", ".join(parts) + ")"


def _sum_sql(arg: str, weights: dict, default: float) -> str:
    return (f"aggregate({arg}, CAST(0 AS DOUBLE), (acc, x) -> acc + "
            f"coalesce(try_element_at({_map_sql(weights)}, x), CAST({default} AS DOUBLE)))")


def register_sql_functions(spark: SparkSession) -> None:
    g = _sum_sql("genres", C.GENRE_WEIGHTS, C.GENRE_DEFAULT_WEIGHT)
    p = _sum_sql("platforms", C.PLATFORM_WEIGHTS, C.PLATFORM_DEFAULT_WEIGHT)
    spark.sql(f"""
      CREATE OR REPLACE TEMPORARY FUNCTION genre_popularity_score(genres ARRAY<STRING>)
      RETURNS DOUBLE RETURN
        CASE WHEN genres IS NULL OR size(genres) = 0 THEN CAST(0 AS DOUBLE)
             ELSE least(CAST(100 AS DOUBLE), {g} / size(genres) * {C.GENRE_SCALE}) END""")
    spark.sql(f"""
      CREATE OR REPLACE TEMPORARY FUNCTION platform_reach_score(platforms ARRAY<STRING>)
      RETURNS DOUBLE RETURN
        CASE WHEN platforms IS NULL OR size(platforms) = 0 THEN CAST(0 AS DOUBLE)
             ELSE least(CAST(100 AS DOUBLE), {p} * {C.PLATFORM_SCALE}) END""")
