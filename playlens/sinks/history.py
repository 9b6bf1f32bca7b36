"""The stored history: the newest document of each game, from all writers.

Each load of documents is one delta: the newest document of each of its games.
Deltas are folded into a base when there are more than a few of them, and a
reader takes the newest over the base and the deltas of one version (see
``snapshots``), so it reads the games once or a few times however many loads
there were.  The newest is the one with the latest processing time, then the
higher batch, then the greater document id.  A document without a game id names
no game and is not kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .. import constants as C
from ..schemas import HISTORY, conform
from .snapshots import Snapshots

ORDER = ["processed_timestamp", "batch_id", "doc_id"]
STORED = StructType([*HISTORY.fields, StructField("processed_timestamp", LongType()),
                     StructField("batch_id", LongType()), StructField("doc_id", StringType())])


def _dealt(docs: DataFrame, key: str) -> bool:
    """Whether all rows of a key lie in one partition already, so that grouping by it shuffles nothing."""
    plan = docs._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.initialPlan()       # the adaptive node itself tells nothing of its rows before they are made
    return plan.outputPartitioning().toString().startswith(f"hashpartitioning({key}#")


def _order() -> list[Column]:
    return [F.coalesce(F.col(c), F.lit("" if c == "doc_id" else -1)).alias(f"_{c}") for c in ORDER]


def newest(docs: DataFrame, key: str = "game_id", keep: list[str] | None = None) -> DataFrame:
    """One row for each game, with the columns ``keep`` (all).

    Rows are combined before the shuffle, so a game with many documents costs each task a few, and are shuffled
    as compressed column blocks (less than half of what they take one by one); no task sorts or spills full rows.
    A task after the shuffle finds the newest by key and order alone and unpacks one block at a time."""
    docs = docs.where(F.col(key).isNotNull())
    if _dealt(docs, key):
        return _grouped(docs, key, keep)
    names = keep or docs.columns
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.pmod(F.xxhash64(key), F.lit(tasks)).cast("int").alias("_block"), F.col(key).alias("_key"),
                       *_order(), *names)
    return rows.mapInArrow(_packed, _BLOCKS).repartition("block").mapInArrow(
        _unpacked, StructType([docs.schema[c] for c in names]))


def _grouped(rows: DataFrame, key: str, keep: list[str] | None) -> DataFrame:
    """The newest of rows that are dealt by key."""
    row = F.struct(*[F.col(c) for c in keep or rows.columns])
    return rows.groupBy(key).agg(F.max_by(row, F.struct(*_order())).alias("_row")).select("_row.*")


_BLOCKS = "block int, rows binary"
#: Places of the block's number, and of the key and order, before the columns of a row.
_KEY, _NARROW = 1, 1 + len(ORDER)
#: Bytes of rows that a task combines and packs at a time; bounds its memory.
PACK_BYTES = 64 << 20


def _last(narrow: pa.Table) -> np.ndarray:
    """Places of one row for each key, in order: the greatest by the columns after the key."""
    if not narrow.num_rows:
        return np.zeros(0, np.int64)
    key, at, batch, doc = (c.combine_chunks() for c in narrow.columns)
    key, at, batch = key.dictionary_encode().indices.to_numpy(), at.to_numpy(), batch.to_numpy()
    order = np.lexsort((batch, at, key))
    same = (np.diff(key[order]) == 0) & (np.diff(at[order]) == 0) & (np.diff(batch[order]) == 0)
    tied = order[np.append(same, False) | np.append(False, same)]
    if len(tied):                       # the document's id decides, in the order of its bytes
        rank = np.zeros(len(order), np.int64)
        rank[tied] = pc.rank(doc.take(pa.array(tied)), tiebreaker="dense").to_numpy()
        order = np.lexsort((rank, batch, at, key))
    return np.sort(order[np.append(np.diff(key[order]) != 0, True)])


def _packed(batches):
    """Compressed blocks of the newest of every so many rows, one for each task of the shuffle."""
    options = pa.ipc.IpcWriteOptions(use_threads=False, compression=pa.Codec("zstd", compression_level=1))

    def blocks(held):
        table = pa.Table.from_batches(held)
        last = _last(table.select(range(_KEY, _KEY + _NARROW)))
        block = table.column(0).to_numpy()[last]
        dealt = np.argsort(block, kind="stable")
        table = table.select(range(_KEY, table.num_columns)).take(pa.array(last[dealt])).combine_chunks()
        edges = np.flatnonzero(np.diff(block[dealt], prepend=-1, append=-1)).tolist()
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=options) as out:
                out.write_table(table.slice(lo, hi - lo))
            yield pa.RecordBatch.from_arrays([pa.array([block[dealt[lo]]], pa.int32()),
                                              pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "rows"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= PACK_BYTES:
            yield from blocks(held)
            held, size = [], 0
    if size:
        yield from blocks(held)


def _unpacked(batches):
    """The newest rows of the blocks of one task."""
    blocks = [rows.as_buffer() for batch in batches for rows in batch.column(1)]
    if not blocks:
        return
    first = pa.ipc.IpcReadOptions(use_threads=False, included_fields=list(range(_NARROW)))
    narrow = [pa.ipc.open_stream(b, options=first).read_all() for b in blocks]
    ends = np.cumsum([n.num_rows for n in narrow])
    last = _last(pa.concat_tables(narrow))
    del narrow
    for b, end, some in zip(blocks, ends, np.split(last, np.searchsorted(last, ends[:-1])), strict=True):
        if len(some):
            table = pa.ipc.open_stream(b, options=pa.ipc.IpcReadOptions(use_threads=False)).read_all()
            wanted = table.take(pa.array(some - (end - table.num_rows)))
            yield from wanted.select(range(_NARROW, table.num_columns)).combine_chunks().to_batches()


def stored_form(docs: DataFrame) -> DataFrame:
    """Documents of either writer in the stored form.

    Bulk documents keep the release as epoch seconds next to its ISO text; the
    stream keeps the text, which is the form history has."""
    if "release_date_formatted" in docs.columns:
        docs = docs.drop("release_date").withColumnRenamed("release_date_formatted", "release_date")
    return conform(docs, STORED)


def fold_documents(docs: DataFrame, path: str, version: int, most: int = 8) -> None:
    """Add one load; a load that runs again under its version replaces its own."""
    store = Snapshots(docs.sparkSession, path, most)
    before = store.state(version - 1)["parts"]
    parts = [*before, store.write_part(newest(stored_form(docs)), f"delta-{version}")]
    if len(parts) > most:
        parts = [store.write_part(newest(store.read(parts, STORED)), f"base-{version}")]
    store.commit(version, {"parts": parts})


def read_newest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest document of each game in the history's form (HISTORY, filled)."""
    store = Snapshots(spark, path)
    rows = newest(store.read(store.state(version)["parts"], STORED), keep=HISTORY.names)
    return rows.select(*HISTORY.names).na.fill(C.HISTORY_FILLS)
