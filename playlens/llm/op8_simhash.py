"""SimHash near copies: 64-bit fingerprints, linked through BK-trees of small shards.

1. A fingerprint bit is set if more than half of the text's shingle hashes
   (XXH64, seed 42) have it.
2. Two fingerprints that differ in at most two bits agree in two of four 16-bit
   blocks (pigeonhole), so distinct fingerprints go to six shards each, one per
   pair of blocks. A shard with more than ``SHARD_MOST`` members is dealt again
   by the parts of its other bits, of which one must agree; nothing is dropped.
3. Each shard makes a BK-tree: a child hangs at its Hamming distance from the
   parent, and a search follows only the edges within the radius. A shard
   reports its parts as stars around their least members, which keeps
   reachability and never writes out all pairs of a group.
4. Links give components (``components``); a component is named by its least id.

Trees stay where their shard lies and the searches are sent to them: a shard's
size has no bound that would allow a broadcast.

Edge cases: a text without words (or null) has fingerprint zero and is linked
like any other; rows with a null id take part, but name no component (null if
all ids of a component are null); repeated rows are linked to each other; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm import common as C
from playlens.llm.components import components

SHINGLE, RADIUS = 3, 2
BLOCKS = 4                     # RADIUS + 2 blocks, so that two of them agree
SHARD_MOST = 4096


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()                       # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    width = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - width + 1].tolist()
    stops = (ends[width - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)], "<u8")
    count = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):          # bounds the memory of a very long text
        bits = np.unpackbits(hashes[lo: lo + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text_col: str, *keep, shingle: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns and ``fp`` (the fingerprint as a signed long)."""
    slim = docs.select(*keep, F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "utf-8").alias("__text"))
    schema = slim.drop("__text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches):
        for batch in batches:
            fp = [fingerprint(x.as_buffer().to_pybytes(), shingle) for x in batch.column(batch.num_columns - 1)]
            columns = [*batch.columns[:-1], pa.array(np.array(fp, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return slim.mapInArrow(run, schema)


class BKTree:
    """Fingerprints by Hamming distance: children are keyed by their distance to the parent."""

    def __init__(self, root: int):
        self.root = (root, {})

    def add(self, value: int) -> None:
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            child = node[1].get(d)
            if child is None:
                node[1][d] = (value, {})
                return
            node = child

    def near(self, value: int, radius: int):
        """Members within ``radius``; follows only edges whose distance can lead there."""
        stack = [self.root]
        while stack:
            member, children = stack.pop()
            d = (member ^ value).bit_count()
            if d <= radius:
                yield member
            if children:
                for edge in range(max(0, d - radius), d + radius + 1):
                    if edge in children:
                        stack.append(children[edge])


def shard_links(members: list[int], radius: int) -> list[tuple[int, int]]:
    """Links of distinct fingerprints within ``radius`` that join parts of the shard not joined before."""
    parent = {m: m for m in members}

    def top(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    tree, links = BKTree(members[0]), []
    for m in members[1:]:
        for other in tree.near(m, radius):
            a, b = top(m), top(other)
            if a != b:
                parent[a] = b
                links.append((m, other))
        tree.add(m)
    return links


def shard_stars(members: list[int], radius: int) -> list[tuple[int, int]]:
    """Each part of the shard as links to its least member: what the links reach, in one step."""
    groups: dict[int, set[int]] = {}
    for a, b in shard_links(members, radius):
        one, two = groups.get(a, {a}), groups.get(b, {b})
        if len(one) < len(two):
            one, two = two, one
        one |= two
        groups.update(dict.fromkeys(two, one))
        groups[a] = groups[b] = one
    stars = {id(g): g for g in groups.values()}.values()
    return [(m, least) for g in stars for least in [min(g, key=_signed)] for m in g if m != least]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _parts(bits: int, pieces: int) -> list[tuple[int, int]]:
    """(shift, mask) of so many adjoining pieces of a word."""
    edges = [round(i * bits / pieces) for i in range(pieces + 1)]
    return [(lo, (1 << (hi - lo)) - 1) for lo, hi in zip(edges[:-1], edges[1:], strict=True)]


def links(prints: DataFrame, radius: int = RADIUS, most: int = SHARD_MOST) -> DataFrame:
    """(a, b): pairs of distinct values of ``fp`` that give the reachability of all links within the radius."""
    blocks = _parts(64, radius + 2)
    fp = F.col("fp")

    def bits(shift, mask):
        return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit(mask))

    shards = F.array(*(F.struct(F.lit(n).alias("kind"), bits(*blocks[i]).alias("x"), bits(*blocks[j]).alias("y"))
                       for n, (i, j) in enumerate(combinations(range(radius + 2), 2))))
    keyed = prints.select("fp").distinct().select("fp", F.explode(shards).alias("s")).select("fp", "s.*")
    sizes = keyed.groupBy("kind", "x", "y").count().where("count > 1")
    # the blocks that a shard's members need not share: of radius + 1 pieces, one agrees
    finer = [F.when(F.col("kind") == n, F.array(*(
        F.struct(F.lit(p).alias("piece"), F.concat_ws(",", *(bits(*x) for x in group)).alias("value"))
        for p, group in enumerate(_rest(blocks, i, j, radius + 1)))))
        for n, (i, j) in enumerate(combinations(range(radius + 2), 2))]
    whole = F.array(F.struct(F.lit(-1).alias("piece"), F.lit("").alias("value")))
    members = (keyed.join(sizes, ["kind", "x", "y"])
               .select("fp", "kind", "x", "y", F.explode(F.when(F.col("count") <= most, whole).otherwise(F.coalesce(*finer))).alias("f"))
               .select("fp", F.concat_ws("/", "kind", "x", "y", "f.piece", "f.value").alias("shard")))
    dealt = members.repartition("shard").sortWithinPartitions("shard")

    def search(batches):
        name, held = None, []
        for batch in batches:
            out = []
            for shard, value in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True):
                if shard != name:
                    out += shard_stars(held, radius) if len(held) > 1 else []
                    name, held = shard, []
                held.append(value & 0xFFFFFFFFFFFFFFFF)
            if out:
                yield _batch(out)
        if len(held) > 1 and (out := shard_stars(held, radius)):
            yield _batch(out)

    return dealt.mapInArrow(search, "a long, b long").distinct()


def _rest(blocks, i, j, pieces):
    """The bits outside blocks i and j in so many groups, each a list of (shift, mask)."""
    single = [(shift + k, 1) for n, (shift, mask) in enumerate(blocks) if n not in (i, j) for k in range(mask.bit_length())]
    size = -(-len(single) // pieces)
    out = []
    for p in range(pieces):
        runs: list[list[int]] = []
        for at, _ in single[p * size: (p + 1) * size]:
            if runs and runs[-1][0] + runs[-1][1] == at:
                runs[-1][1] += 1
            else:
                runs.append([at, 1])
        out.append([(at, (1 << width) - 1) for at, width in runs])
    return out


def _batch(pairs):
    a, b = np.array(pairs, np.uint64).view(np.int64).T
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a)), pa.array(np.ascontiguousarray(b))], names=["a", "b"])


def _grouped(prints: DataFrame, radius: int) -> DataFrame:
    """``prints`` (cut) with the root fingerprint of each row's component."""
    roots = components(links(prints, radius))
    return prints.join(roots, prints["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp")).drop("node")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    prints = C.cut(fingerprints(docs, text_col, F.col(f"`{id_col}`").cast("long").alias("doc_id"), shingle=shingle))
    rows = C.cut(_grouped(prints, radius))
    named = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(named, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component, with all its columns: that of the least id.

    A document is known by a hash of its id and text; of repeated rows one stays.
    """
    key = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("__key")
    prints = C.cut(fingerprints(docs, text_col, F.col(f"`{id_col}`").cast("long").alias("id"), key, shingle=shingle))
    least = F.min(F.struct(F.col("id").isNull().alias("late"), "id", "__key"))
    kept = _grouped(prints, radius).groupBy("root").agg(least.alias("k")).select(F.col("k.__key").alias("__kept"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    once = Window.partitionBy("__key").orderBy(F.lit(0))
    rows = docs.select(key, row)
    return (rows.join(kept, rows["__key"] == kept["__kept"], "left_semi")
            .withColumn("__n", F.row_number().over(once)).where("__n = 1").select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_copies(C.read_documents(spark, sf_dir))
