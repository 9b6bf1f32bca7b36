"""id <-> name translation against dimension tables.

Two strategies with equal results, chosen by a checked size (the bound changes
speed only):

* ``map``  - a dimension of at most ``MAP_MAX_ROWS`` rows (verified with a
  ``limit(n+1)`` collect) becomes a literal MAP applied with ``transform``: no
  join and no shuffle.  A map is searched entry by entry, hence the low bound.
* ``join`` - for larger dimensions: the *distinct* arrays are exploded with
  positions, equi-joined to the dimension (Spark/AQE pick broadcast or
  sort-merge from measured sizes), regrouped by the array they came from and
  joined back on it.  Rows need no key of their own.

Elements may be ids, names or both mixed (VARIANT, as ``parse_json`` and the
JSON reader give them): an id is kept and named, a name is kept and its id
looked up, id 0 included; a name without an id lends none, and elements that
are neither (null, booleans, objects) drop out.

An id that a dimension lists twice has the least of its names; a name listed
twice has its lowest id; null ids and names of a dimension are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, IntegerType, StringType, VariantType

from ..functions.scores import literal_map

MAP_MAX_ROWS = 1_000

# raw id-array column -> (ids column, names column) of the translated game
TRANSLATED = {
    "genres": ("genre_ids", "genres"),
    "platforms": ("platform_ids", "platforms"),
    "game_modes": ("game_mode_ids", "game_modes"),
    "themes": ("theme_ids", "themes"),
    "player_perspectives": ("player_perspective_ids", "player_perspectives"),
}


def bounded_rows(dim: DataFrame, max_rows: int = MAP_MAX_ROWS):
    """The dimension's ``(id, name)`` rows if it has at most ``max_rows``."""
    rows = dim.select("id", "name").limit(max_rows + 1).collect()
    return None if len(rows) > max_rows else rows


def id_name_map(rows) -> Column:
    """Literal map; an id listed twice has the least of its names."""
    names: dict[int, str] = {}
    for r in rows:
        if r["id"] is not None and r["name"] is not None:
            i = int(r["id"])
            names[i] = min(names.get(i, r["name"]), r["name"])
    return literal_map(names)


def name_id_map(rows) -> Column:
    """Inverse map; a name listed twice resolves to its lowest id."""
    inv: dict[str, int] = {}
    known = (r for r in rows if r["id"] is not None and r["name"] is not None)
    for r in sorted(known, key=lambda r: r["id"]):
        inv.setdefault(r["name"], int(r["id"]))
    return literal_map(inv)


def unknown_name(x: Column) -> Column:
    return F.concat(F.lit("Unknown_"), x.cast("string"))


def names_expr(ids: Column, m: Column) -> Column:
    """Order-preserving translation; unknown ids -> ``Unknown_<id>``; null -> []."""
    tr = F.transform(ids, lambda x: F.coalesce(F.try_element_at(m, x), unknown_name(x)))
    return F.when(ids.isNull(), F.array().cast(ArrayType(StringType()))).otherwise(tr)


def ids_expr(names: Column, inv: Column) -> Column:
    """Reverse translation: known names -> ids (first = lowest id, id 0 kept),
    unknown names dropped; null -> []."""
    tr = F.filter(F.transform(names, lambda n: F.try_element_at(inv, n)),
                  lambda x: x.isNotNull())
    return F.when(names.isNull(), F.array().cast(ArrayType(IntegerType()))).otherwise(tr)


def as_rows(dim: dict) -> list[dict]:
    return [{"id": k, "name": v} for k, v in dim.items()]


def as_frame(dim, spark) -> DataFrame:
    """A dimension as a table ``(id, name)``."""
    return spark.createDataFrame(list(dim.items()), "id int, name string") if isinstance(dim, dict) else dim


def _known_rows(dim):
    """The rows of a dimension within the map bound, else None."""
    if isinstance(dim, dict):
        return as_rows(dim) if len(dim) <= MAP_MAX_ROWS else None
    return bounded_rows(dim)


def _looked_up(df: DataFrame, specs: list[tuple[str, DataFrame, str]], missing, kind) -> DataFrame:
    """Replace the elements of array columns by table lookups, in one pass.

    ``specs`` lists (array column, table ``(x, y)`` with unique ``x``, output
    column); ``missing(x)`` stands for elements without a match (null elements
    and null results drop out only if ``missing`` is None).  Work is done once
    for each distinct combination of arrays, which is also the join key back,
    so rows need no key and repeated rows are translated alike.
    """
    empty, none = F.array(), F.array().cast(ArrayType(kind))
    arrays = F.struct(*[F.coalesce(F.col(c), empty.cast(df.schema[c].dataType)).alias(f"c{i}")
                        for i, (c, _, _) in enumerate(specs)])
    # rows without any element need no table: they would all share one join key
    some = F.greatest(F.lit(0), *[F.coalesce(F.size(F.col(c)), F.lit(0)) for c, _, _ in specs]) > 0
    bare = df.where(~some).withColumns({out_col: none for _, _, out_col in specs})
    df = df.where(some)
    keys = df.select(arrays.alias("_key")).distinct()

    def tagged(i):
        return F.transform(F.col(f"_key.c{i}"), lambda x, pos: F.struct(
            F.lit(i).alias("_k"), pos.alias("_pos"), x.alias("_x")))

    elements = F.flatten(F.array(*[tagged(i) for i in range(len(specs))]))
    ex = keys.select("_key", F.explode(elements).alias("_e")).select("_key", "_e.*")
    table = None
    for i, (_, t, _) in enumerate(specs):
        part = t.select(F.lit(i).alias("_k"), F.col("x").alias("_x"), F.col("y").alias("_y"))
        table = part if table is None else table.unionByName(part)
    found = ex.join(table, ["_k", "_x"], "left")
    y = F.col("_y") if missing is None else F.coalesce("_y", missing(F.col("_x")))
    found = found.select("_key", "_k", "_pos", y.alias("_y"))
    if missing is None:
        found = found.where(F.col("_y").isNotNull())
    back = found.groupBy("_key").agg(*[
        F.sort_array(F.collect_list(F.when(F.col("_k") == i, F.struct("_pos", "_y")))).alias(f"_s{i}")
        for i in range(len(specs))])
    back = back.select("_key", *[F.transform(f"_s{i}", lambda s: s["_y"]).alias(f"_n{i}")
                                 for i in range(len(specs))])
    out = df.withColumn("_key", arrays).join(back, "_key", "left")
    found = out.withColumns({out_col: F.coalesce(F.col(f"_n{i}"), none) for i, (_, _, out_col) in enumerate(specs)})
    return found.drop("_key", *[f"_n{i}" for i in range(len(specs))]).unionByName(bare)


def has_names(df: DataFrame, col: str) -> bool:
    """Whether the elements of an array column are, or may be, names."""
    kind = df.schema[col].dataType
    kind = kind.elementType if isinstance(kind, ArrayType) else kind
    return isinstance(kind, (VariantType, StringType))


def split_elements(df: DataFrame, col: str) -> Column:
    """Elements of an array of ids, names or VARIANT as structs (id, name), of which one is null."""
    kind = df.schema[col].dataType
    items = F.col(col)
    if isinstance(kind, VariantType):                    # a whole list as one value
        items = F.expr(f"try_variant_get(`{col}`, '$', 'array<variant>')")
    elif isinstance(kind.elementType, StringType):
        return F.transform(F.filter(items, lambda x: x.isNotNull()),
                           lambda x: F.struct(F.lit(None).cast("int").alias("id"), x.alias("name")))
    elif not isinstance(kind.elementType, VariantType):
        return F.transform(F.filter(items, lambda x: x.isNotNull()),
                           lambda x: F.struct(x.cast("int").alias("id"), F.lit(None).cast("string").alias("name")))

    def one(x):
        of = F.schema_of_variant(x)                      # tells the id 12 from the name "12"
        whole = F.when(of == "BIGINT", F.try_variant_get(x, "$", "int"))
        return F.struct(whole.alias("id"), F.when(of == "STRING", F.try_variant_get(x, "$", "string")).alias("name"))

    return F.filter(F.transform(items, one), lambda e: e["id"].isNotNull() | e["name"].isNotNull())


def mixed_exprs(elements: Column, by_id: Column, by_name: Column) -> tuple[Column, Column]:
    """(ids, names) of split elements, from two literal maps."""
    ids = F.filter(F.transform(elements, lambda e: F.coalesce(e["id"], F.try_element_at(by_name, e["name"]))), lambda x: x.isNotNull())
    names = F.transform(elements, lambda e: F.coalesce(e["name"], F.try_element_at(by_id, e["id"]), unknown_name(e["id"])))
    return (F.coalesce(ids, F.array().cast(ArrayType(IntegerType()))), F.coalesce(names, F.array().cast(ArrayType(StringType()))))


def _by_arrays(df: DataFrame, cols: list[str], looked_up) -> DataFrame:
    """``df`` left-joined to ``looked_up(keys)``, which has the column ``_key``.

    ``keys`` are the distinct combinations of some array columns (``_key.c0``,
    ``_key.c1``, ...; null as empty), so rows need no key and repeated rows are
    translated alike.  A combination without any element must not come back;
    its rows are dealt by a hash of their own, not all by one key."""
    arrays = F.struct(*[F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType)).alias(f"c{i}") for i, c in enumerate(cols)])

    def some(key):
        return F.greatest(F.lit(0), *[F.size(key[f"c{i}"]) for i in range(len(cols))]) > 0

    own = F.xxhash64(F.lit(0), *[F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)])
    keys = df.select(arrays.alias("_key")).distinct()       # one of them may be empty; its explode gives nothing
    back = looked_up(keys).withColumn("_deal", F.when(some(F.col("_key")), F.lit(0).cast("long")))
    out = df.withColumn("_key", arrays)
    out = out.withColumn("_deal", F.when(some(F.col("_key")), F.lit(0).cast("long")).otherwise(own))
    return out.join(back, ["_key", "_deal"], "left").drop("_key", "_deal")


def _each(keys: DataFrame, elements: Column) -> DataFrame:
    """``_key`` and the fields of each element.  Not by a plain explode: the optimizer would
    filter on its array before, down to the scan, and compute the arrays once more for that."""
    return keys.select("_key", F.explode_outer(elements).alias("_e")).where(F.col("_e").isNotNull()).select("_key", "_e.*")


def mixed_by_join(df: DataFrame, specs: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Join strategy for (elements column, dimension, ids column, names column), in one lookup pass for both kinds.

    An element is looked up once: an id finds its name, a name its id.
    """
    def table(k, dim):
        known = dim.where(F.col("id").isNotNull() & F.col("name").isNotNull())
        return known.groupBy(F.lit(2 * k).alias("_k"), F.col("id").cast("string").alias("_x")).agg(F.min("name").alias("_y")) \
            .unionByName(known.groupBy(F.lit(2 * k + 1).alias("_k"), F.col("name").alias("_x")).agg(F.min("id").cast("string").alias("_y")))

    def tagged(k):
        return F.transform(F.col(f"_key.c{k}"), lambda e, pos: F.struct(
            (F.lit(2 * k) + e["name"].isNotNull().cast("int")).alias("_k"), pos.alias("_pos"),
            F.coalesce(e["name"], e["id"].cast("string")).alias("_x")))

    def looked_up(keys):
        elements = F.flatten(F.array(*[tagged(k) for k in range(len(specs))]))
        ex = _each(keys, elements)
        tables = functools.reduce(DataFrame.unionByName, [table(k, d) for k, (_, d, _, _) in enumerate(specs)])
        named = F.col("_k") % 2 == 1
        one = F.struct(F.floor(F.col("_k") / 2).cast("int").alias("k"), F.col("_pos").alias("pos"),
                       F.when(named, F.col("_y")).otherwise(F.col("_x")).try_cast("int").alias("id"),
                       F.when(named, F.col("_x")).otherwise(F.coalesce("_y", unknown_name(F.col("_x")))).alias("name"))
        return ex.join(tables, ["_k", "_x"], "left").groupBy("_key").agg(F.sort_array(F.collect_list(one)).alias("_found"))

    out = _by_arrays(df, [c for c, *_ in specs], looked_up)
    found = {}
    for k, (_, _, ids_col, names_col) in enumerate(specs):
        number = F.lit(k)
        of = F.filter("_found", lambda e: e["k"] == number)       # noqa: B023 - called at once
        found[ids_col] = F.coalesce(F.filter(F.transform(of, lambda e: e["id"]), lambda x: x.isNotNull()), F.array().cast(ArrayType(IntegerType())))
        found[names_col] = F.coalesce(F.transform(of, lambda e: e["name"]), F.array().cast(ArrayType(StringType())))
    return out.withColumns(found).drop("_found")


def translate_by_join(df: DataFrame, specs: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Join strategy: (ids column, dimension, names column) of several dimensions in one pass."""
    def table(dim):
        known = dim.where(F.col("id").isNotNull() & F.col("name").isNotNull())
        return known.groupBy(F.col("id").alias("x")).agg(F.min("name").alias("y"))

    return _looked_up(df, [(c, table(d), out) for c, d, out in specs], unknown_name, StringType())


def translate(df: DataFrame, ids_col: str, dim, out_col: str, strategy: str = "auto") -> DataFrame:
    """Add ``out_col`` = names of ``ids_col`` looked up in ``dim`` (a
    DataFrame ``(id, name)`` or a ``{id: name}`` dict)."""
    rows = _known_rows(dim) if strategy in ("auto", "map") else None
    if rows is not None:
        return df.withColumn(out_col, names_expr(F.col(ids_col), id_name_map(rows)))
    if strategy == "map":
        raise ValueError(f"dimension larger than {MAP_MAX_ROWS} rows; use 'join'")
    return translate_by_join(df, [(ids_col, as_frame(dim, df.sparkSession), out_col)])


def translate_game(raw: DataFrame, dims: dict, strategy: str = "auto") -> DataFrame:
    """Raw arrays -> ``*_ids`` (ids kept as given, single pass) and name arrays
    for the five dimensions; elements may be ids, names, or VARIANT of both.
    Bounded dimensions become literal maps; the others are translated together
    in one join pass for each direction."""
    present = [c for c in TRANSLATED if c in raw.columns]
    mixed = {c: f"_elements_{c}" for c in present if has_names(raw, c)}
    out = raw.withColumns({m: split_elements(raw, c) for c, m in mixed.items()}) if mixed else raw
    out = out.withColumns({TRANSLATED[c][0]: F.col(c) for c in present if c not in mixed})
    mapped, joined, mixed_joined = {}, [], []
    for c in present:
        ids_col, names_col = TRANSLATED[c]
        rows = _known_rows(dims[c]) if strategy in ("auto", "map") else None
        if rows is not None and c in mixed:
            mapped[ids_col], mapped[names_col] = mixed_exprs(F.col(mixed[c]), id_name_map(rows), name_id_map(rows))
        elif rows is not None:
            mapped[names_col] = names_expr(F.col(ids_col), id_name_map(rows))
        elif strategy == "map":
            raise ValueError(f"dimension {c} larger than {MAP_MAX_ROWS} rows; use 'join'")
        elif c in mixed:
            mixed_joined.append((mixed[c], as_frame(dims[c], raw.sparkSession), ids_col, names_col))
        else:
            joined.append((ids_col, as_frame(dims[c], raw.sparkSession), names_col))
    if mapped:
        out = out.withColumns(mapped)
    if joined:
        out = translate_by_join(out, joined)
    if mixed_joined:
        out = mixed_by_join(out, mixed_joined)
    return out.drop(*mixed.values())


def reverse_translate(df: DataFrame, names_col: str, dim, out_col: str,
                      strategy: str = "auto") -> DataFrame:
    """Add ``out_col`` = ids of ``names_col``; unknown names are dropped."""
    rows = _known_rows(dim) if strategy in ("auto", "map") else None
    if rows is not None:
        return df.withColumn(out_col, ids_expr(F.col(names_col), name_id_map(rows)))
    if strategy == "map":
        raise ValueError(f"dimension larger than {MAP_MAX_ROWS} rows; use 'join'")
    known = as_frame(dim, df.sparkSession).where(F.col("id").isNotNull() & F.col("name").isNotNull())
    table = known.groupBy(F.col("name").alias("x")).agg(F.min("id").alias("y"))
    return _looked_up(df, [(names_col, table, out_col)], None, IntegerType())
