"""Repeated passages across documents: seed and extend on winnowed anchors.

A window is ``WINDOW`` consecutive words. It is removed if the same words also
start in a document with a smaller id. The method:

1. *Seed.* Every window has one anchor, the least hash of its ``SEED``-word
   seeds (winnowing). Equal windows have equal anchors at equal places, so
   documents that share a window meet at the bucket of the anchor.
2. *Extend.* Around its anchor an occurrence extends left and right over all
   windows that have this anchor. Occurrences with equal extension are one
   entry (of its least id) before anything is shuffled, so thousands of copies
   cost a chunk one entry. Where an anchor has different extensions, the first
   occurrence of each extends to the threshold in every way (so many words left,
   the rest right), and each way meets the other documents under its own hash.
   This finds what extending all pairs finds, without making the pairs.
3. *Keep maximal repeats.* Overlapping matched windows unite.

Work moves between chunks of documents and buckets of hashes as packed arrays;
no task holds more than a chunk or a bucket, whose number grows with the text.

Edge cases: a null text has no words; a text below ``WINDOW`` words has no
window and stays whole; a null id counts as later than every id (two null ids
are not earlier than each other); rows that share an id do not remove each
other; an empty table gives an empty result; other columns, whatever their
names, do not matter (and pass through ``remove_repeats``).
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.llm import common as C

WINDOW, SEED = 13, 5
CHUNK_BYTES = 8 << 20

_ENTRIES = "bucket int, chunk int, f binary, c binary, id binary"
_FIRSTS = "chunk int, c binary, first binary, many binary"
_ASKS = "bucket int, chunk int, h binary, id binary"
_SEEN = "chunk int, h binary, least binary"


class _Windows:
    """Words, anchors and extensions of one slice of texts."""

    def __init__(self, data, at, ids, window: int, seed: int):
        self.start, self.end, self.row = C.word_spans(data, at)
        n = len(self.start)
        self.n, self.window = n, window
        words = C.word_hashes(data, self.start, self.end)
        self.range = C.RangeHash(words)
        here = np.arange(max(0, n - seed + 1))
        seeds = self.range(here, here + seed)
        valid = np.zeros(len(seeds), bool)
        full = max(0, n - window + 1)
        valid[:full] = self.row[:full] == self.row[window - 1:][:full]
        anchor, self.first, self.last = C.anchors(seeds, valid, window - seed + 1)
        self.f = seeds[anchor]
        lead = (anchor - self.first).astype(np.uint64)
        self.c = C.mix(self.range(self.first, self.last + window) + lead * np.uint64(0x9E3779B97F4A7C15))
        self.id = ids[self.row[self.first]] if n else np.zeros(0, np.int64)

    def hashes(self, runs: np.ndarray):
        """(run, window, hash) of all windows of the chosen runs."""
        run, at = C.within(self.first[runs], self.last[runs])
        return runs[run], at, self.range(at, at + self.window)


def _slices(payloads, id_col, text_col, window, seed):
    for table in C.unpack(payloads):
        ids = C.ids_of(table.column(id_col))
        for row, data, at in C.text_slices(table.column(text_col)):
            yield table, row, data, at, _Windows(data, at, ids[row: row + len(at) - 1], window, seed)


class _Firsts:
    """For each extension of a chunk: its first document of all, and whether its anchor has others."""

    def __init__(self, runs: list[_Windows], answers: pa.Table):
        c = np.concatenate([*(w.c for w in runs), np.zeros(0, np.uint64)])
        ids = np.concatenate([*(w.id for w in runs), np.zeros(0, np.int64)])
        best = C.least_by((c,), ids)
        self.c, self.first = c[best], ids[best]
        self.many = np.zeros(len(best), bool)
        got, first, many, _ = C.gather(answers, c=np.uint64, first=np.int64, many=np.bool_)
        at, _ = C.lookup(got, self.c)
        if len(got):
            np.minimum.at(self.first, at, first)
            self.many[at] = many

    def __call__(self, w: _Windows):
        """(runs with an earlier copy, runs that are first but share their anchor)."""
        at, _ = C.lookup(w.c, self.c)
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.flatnonzero(w.id > self.first[at]), np.flatnonzero((w.id == self.first[at]) & self.many[at])


def _asked(runs, firsts):
    """Hashes that a chunk's first occurrences extend to, each with its least id."""
    h, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for w in runs:
        run, _, hashes = w.hashes(firsts(w)[1])
        h.append(hashes)
        ids.append(w.id[run])
    h, ids = np.concatenate(h), np.concatenate(ids)
    best = C.least_by((h,), ids)
    return h[best], ids[best]


def _repeats(docs: DataFrame, id_col: str, text_col: str, window: int, seed: int, finish, schema) -> DataFrame:
    n = C.chunk_count(docs, text_col, CHUNK_BYTES)
    packed = C.pack(docs, n, [id_col, text_col])
    by_chunk = packed.groupBy("chunk")

    def entries(key, table):
        f, c, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for *_, w in _slices(table.column("payload"), id_col, text_col, window, seed):
            f.append(w.f), c.append(w.c), ids.append(w.id)
        f, c, ids = map(np.concatenate, (f, c, ids))
        best = C.least_by((f, c), ids)
        return C.scatter(key[0].as_py(), f[best], n, f=f[best], c=c[best], id=ids[best])

    def firsts(table):
        f, c, ids, row = C.gather(table, f=np.uint64, c=np.uint64, id=np.int64)
        order = np.lexsort((ids, c, f))
        f, c, ids, row = f[order], c[order], ids[order], row[order]
        same = C.groups(f, c)
        head = np.flatnonzero(np.diff(same, prepend=-1))
        first = ids[head][same] if len(head) else ids
        extensions = np.bincount(C.groups(f)[head]) if len(head) else np.zeros(0, int)
        many = (extensions > 1)[C.groups(f)] if len(head) else np.zeros(0, bool)
        return C.answer(table, row, (first < ids) | many, c=c, first=first, many=many)

    def asks(key, left, right):
        runs = [w for *_, w in _slices(left.column("payload"), id_col, text_col, window, seed)]
        h, ids = _asked(runs, _Firsts(runs, right))
        return C.scatter(key[0].as_py(), h, n, h=h, id=ids)

    def seen(table):
        h, ids, row = C.gather(table, h=np.uint64, id=np.int64)
        order = np.lexsort((ids, h))
        h, ids, row = h[order], ids[order], row[order]
        same = C.groups(h)
        least = ids[np.flatnonzero(np.diff(same, prepend=-1))][same] if len(h) else ids
        return C.answer(table, row, least < ids, h=h, least=least)

    def judged(left, right):
        """Yields (table, first row, data, offsets, windows, removed words) slice by slice."""
        parts = list(_slices(left.column("payload"), id_col, text_col, window, seed))
        firsts_of = _Firsts([p[-1] for p in parts], right.filter(pa.compute.is_valid(right.column("c"))))
        h, least = _asked([p[-1] for p in parts], firsts_of)
        got, early, _ = C.gather(right.filter(pa.compute.is_valid(right.column("h"))), h=np.uint64, least=np.int64)
        at, there = C.lookup(got, h)
        np.minimum.at(least, at[there], early[there])
        for *where, w in parts:
            later, shared = firsts_of(w)
            _, starts = C.within(w.first[later], w.last[later])
            run, more, hashes = w.hashes(shared)
            if len(more):
                more = more[w.id[run] > least[C.lookup(hashes, h)[0]]]
            yield *where, w, C.covered(np.concatenate([starts, more]), window, w.n)

    def last(left, right):
        return finish(judged(left, right), left, id_col, text_col)

    sent = by_chunk.applyInArrow(entries, _ENTRIES)
    known = sent.groupBy("bucket").applyInArrow(firsts, _FIRSTS)
    asked = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(asks, _ASKS)
    found = asked.groupBy("bucket").applyInArrow(seen, _SEEN)
    replies = known.unionByName(found, allowMissingColumns=True)
    return by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(last, schema)


def _digest(parts, left, id_col, text_col):
    out = {"id": [], "n_words": [], "n_removed": [], "kept": []}
    for table, row, data, at, w, gone in parts:
        raw = data.tobytes()
        rows = len(at) - 1
        edge = np.searchsorted(w.row, np.arange(rows + 1))
        lost = np.add.reduceat(np.append(gone, False).astype(np.int64), edge[:-1]) if rows else []
        lost = np.where(edge[1:] > edge[:-1], lost, 0)
        out["id"].append(table.column(id_col).slice(row, rows).combine_chunks())
        out["n_words"].append(np.diff(edge))
        out["n_removed"].append(lost)
        for i in range(rows):
            words = raw[at[i]: at[i + 1]].split()
            if lost[i]:
                words = compress(words, ~gone[edge[i]: edge[i + 1]])
            out["kept"].append(hashlib.sha256(b" ".join(words)).hexdigest())
    flat = lambda k: np.concatenate([*out[k], np.zeros(0, np.int64)])
    ids = pa.concat_arrays(out["id"]) if out["id"] else pa.array([], pa.int64())
    return pa.table({"doc_id": ids.cast(pa.int64()), "n_words": pa.array(flat("n_words"), pa.int64()),
                     "n_removed": pa.array(flat("n_removed"), pa.int64()), "kept_sha256": pa.array(out["kept"], pa.string())})


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row; see the module's text."""
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return _repeats(slim, "id", "text", window, seed, _digest,
                    "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _rewrite(parts, left, id_col, text_col):
    texts, tables = [], []
    for table, row, data, at, w, gone in parts:
        if not tables or tables[-1] is not table:
            tables.append(table)
        raw = data.tobytes()
        rows = len(at) - 1
        edge = np.searchsorted(w.row, np.arange(rows + 1))
        whole = table.column(text_col).slice(row, rows)
        for i in range(rows):
            lost = gone[edge[i]: edge[i + 1]]
            if not lost.any():
                texts.append(whole[i].as_py())
                continue
            starts = np.append(w.start[edge[i]: edge[i + 1]], at[i + 1])
            starts[0] = at[i]
            kept = np.flatnonzero(~lost)
            texts.append(b"".join(raw[starts[j]: starts[j + 1]] for j in kept).decode())
    if not tables:
        tables = [t.slice(0, 0) for t in C.unpack(left.column("payload"))][:1]
    whole = pa.concat_tables(tables)
    place = whole.schema.get_field_index(text_col)
    return whole.set_column(place, whole.schema.field(place), pa.array(texts, whole.schema.field(place).type))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """The rows with all their columns; removed words are cut from the text.

    A removed word goes with the white space after it; what is kept stays as it
    was. A text of which nothing is kept becomes empty; its row stays.
    """
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema.fields])
    return _repeats(docs, id_col, text_col, window, seed, _rewrite, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(C.read_documents(spark, sf_dir))


SQL = rf"""
with d as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as ws
  from documents),
win as (
  select doc_id, p, list_slice(ws, p, p + {WINDOW - 1}) as g
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - {WINDOW - 2}, 1))) as p from d)),
hit as (select doc_id, p from (select doc_id, p, min(doc_id) over (partition by g) as f from win) where f < doc_id),
gone as (select distinct doc_id, unnest(range(p, p + {WINDOW})) as k from hit),
words as (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as k from d),
kept as (
  select doc_id, string_agg(w, ' ' order by k) as t
  from (select words.* from words anti join gone on words.doc_id = gone.doc_id and words.k = gone.k) group by doc_id),
lost as (select doc_id, count(*) as n from gone group by doc_id)
select d.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(lost.n, 0) as bigint) as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from d left join lost on d.doc_id = lost.doc_id left join kept on d.doc_id = kept.doc_id
"""
