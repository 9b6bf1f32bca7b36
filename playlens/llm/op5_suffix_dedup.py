"""Repeated byte strings: suffix arrays by induced sorting over shards of equal content.

Every byte is removed that lies in a ``WIDTH``-byte string which also starts
earlier (in a document with a smaller id, or earlier in the same document).

1. *Shards.* Each string has one anchor, the least hash of its ``SEED``-byte
   seeds, so equal strings fall into the shard of the same anchor. The bytes
   around an anchor that its strings cover make a segment. Equal segments are
   one entry (that of the earliest place) before anything is shuffled.
2. *Suffix arrays.* Where an anchor has one segment only, every later place
   repeats it whole. The others go, one copy of each segment, to the anchor's
   shard, which sorts their suffixes by induced sorting (``induced_sort``) and
   finds strings with permuted common prefixes of ``WIDTH`` or more.
3. *Answers* return to the chunk of the document as (segment, offset).

Edge cases: a null text is empty; a text below ``WIDTH`` bytes stays whole; a
null id is later than every id; rows that share an id are taken as one document
(an equal start in both removes nothing, a later start does); an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm import common as C
from playlens.llm.induced_sort import permuted_prefixes, suffix_array

WIDTH, SEED = 100, 32
CHUNK_BYTES = 8 << 20
#: Shards for each chunk; keeps a shard's segments near a tenth of a chunk at most.
SHARDS = 4

_ENTRIES = "bucket int, chunk int, f binary, c binary, id binary, a binary"
_FIRSTS = "chunk int, c binary, first binary, a binary, many binary"
_SEGMENTS = "bucket int, chunk int, c binary, id binary, a binary, length binary, text binary"
_DOUBLES = "chunk int, twice binary, offset binary"


class _Strings:
    """Anchors and segments of one slice of texts."""

    def __init__(self, data, at, ids, width: int, seed: int):
        self.data, self.at = data, at
        n = len(data)
        hashed = C.RangeHash(C.BYTE_VALUES[data])
        seeds = hashed.windows(seed)
        valid = np.ones(len(seeds), bool)
        valid[max(0, n - width + 1):] = False
        change = np.zeros(len(seeds) + 1, np.int32)     # no start in the last width - 1 bytes of a text
        lo = np.minimum(np.maximum(at[1:] - width + 1, at[:-1]), len(seeds))
        np.add.at(change, lo, 1)
        np.add.at(change, np.minimum(at[1:], len(seeds)), -1)
        valid &= np.cumsum(change[:-1]) == 0
        anchor, self.first, self.last = C.anchors(seeds, valid, width - seed + 1)
        self.f = seeds[anchor]
        lead = (anchor - self.first).astype(np.uint64)
        self.c = C.mix(hashed(self.first, self.last + width) + lead * np.uint64(0x9E3779B97F4A7C15))
        row = np.searchsorted(at, self.first, "right") - 1
        self.id = ids[row]
        self.a = self.first - at[row]                   # the segment's place in its text


def _slices(payloads, width, seed):
    for table in C.unpack(payloads):
        ids = C.ids_of(table.column("id"))
        for row, data, at in C.text_slices(table.column("text")):
            yield table, row, data, at, _Strings(data, at, ids[row: row + len(at) - 1], width, seed)


class _Firsts:
    """For each segment of a chunk: its earliest place of all, and whether its anchor has others."""

    def __init__(self, runs, answers: pa.Table):
        c = np.concatenate([*(w.c for w in runs), np.zeros(0, np.uint64)])
        ids = np.concatenate([*(w.id for w in runs), np.zeros(0, np.int64)])
        a = np.concatenate([*(w.a for w in runs), np.zeros(0, np.int64)])
        best = C.least_by((c,), ids, a)
        self.c, self.id, self.a = c[best], ids[best], a[best]
        self.many = np.zeros(len(best), bool)
        got, first, place, many, _ = C.gather(answers, c=np.uint64, first=np.int64, a=np.int64, many=np.bool_)
        at, _ = C.lookup(got, self.c)
        if len(got):                                   # an answer is never later than the chunk's own
            self.id[at], self.a[at], self.many[at] = first, place, many

    def __call__(self, w):
        """(runs with an earlier copy, runs that are first but share their anchor)."""
        if not len(w.c):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, _ = C.lookup(w.c, self.c)
        first = (w.id == self.id[at]) & (w.a == self.a[at])
        return np.flatnonzero(~first), np.flatnonzero(first & self.many[at])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row; see the module's text."""
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    n = C.chunk_count(slim, "text", CHUNK_BYTES)
    by_chunk = C.pack(slim, n, ["id", "text"]).groupBy("chunk")

    def entries(key, table):
        parts = [(w.f, w.c, w.id, w.a) for *_, w in _slices(table.column("payload"), width, seed)]
        empty = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        f, c, ids, a = map(np.concatenate, zip(*parts, empty, strict=True))
        best = C.least_by((f, c), ids, a)
        return C.scatter(key[0].as_py(), f[best], n, f=f[best], c=c[best], id=ids[best], a=a[best])

    def firsts(table):
        f, c, ids, a, row = C.gather(table, f=np.uint64, c=np.uint64, id=np.int64, a=np.int64)
        order = C.order_by(f, c, ids, a)
        f, c, ids, a, row = f[order], c[order], ids[order], a[order], row[order]
        if not len(f):
            return C.answer(table, row, np.zeros(0, bool), c=c, first=ids, a=a, many=np.zeros(0, bool))
        same = C.groups(f, c)
        head = np.flatnonzero(np.diff(same, prepend=-1))
        first, place = ids[head][same], a[head][same]
        many = (np.bincount(C.groups(f)[head]) > 1)[C.groups(f)]
        return C.answer(table, row, (first != ids) | (place != a) | many, c=c, first=first, a=place, many=many)

    def segments(key, left, right):
        runs = [w for *_, w in _slices(left.column("payload"), width, seed)]
        firsts_of = _Firsts(runs, right)
        parts = []
        for w in runs:
            chosen = firsts_of(w)[1]
            parts += [(w.f[r], w.c[r], w.id[r], w.a[r], w.data[w.first[r]: w.last[r] + width]) for r in chosen]
        found = {x[1]: x for x in parts}                # one copy of each segment
        parts = sorted(found.values(), key=lambda x: x[0] % np.uint64(SHARDS * n))
        f = np.array([x[0] for x in parts], np.uint64)
        bucket = (f % np.uint64(SHARDS * n)).astype(np.int32)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        out = {k: [] for k in ("bucket", "chunk", "c", "id", "a", "length", "text")}
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            some = parts[lo:hi]
            out["bucket"].append(int(bucket[lo]))
            out["chunk"].append(key[0].as_py())
            for name, place, kind in (("c", 1, np.uint64), ("id", 2, np.int64), ("a", 3, np.int64)):
                out[name].append(np.array([x[place] for x in some], kind).tobytes())
            out["length"].append(np.array([len(x[4]) for x in some], np.int64).tobytes())
            out["text"].append(np.concatenate([x[4] for x in some]).tobytes())
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))

    def doubles(table):
        c, ids, a, length, row = C.gather(table, c=np.uint64, id=np.int64, a=np.int64, length=np.int64)
        text = np.frombuffer(b"".join(table.column("text").to_pylist()), np.uint8)
        # one string: bytes as 2..257, a 1 after each segment, a 0 at the end
        segment = np.repeat(np.arange(len(length)), length)
        s = np.ones(len(text) + len(length) + 1, np.int64)
        s[np.arange(len(text)) + segment] = text.astype(np.int64) + 2
        s[-1] = 0
        order = suffix_array(s, 258)
        group = np.cumsum(permuted_prefixes(s, order)[order] < width)
        start = np.concatenate([[0], np.cumsum(length + 1)])
        of = np.append(np.repeat(np.arange(len(length)), length + 1), len(length) - 1)[order]
        offset = order - start[of]
        full = (offset + width <= length[of]) & (order < len(s) - 1)
        of, offset, group = of[full], offset[full], group[full]
        place = a[of] + offset
        head = np.flatnonzero(np.diff(group, prepend=-1))      # groups lie together: the least of each is first
        size = np.diff(head, append=len(group))
        holder = ids[of]
        later = np.zeros(0, bool)
        if len(head):
            later = holder != np.repeat(np.minimum.reduceat(holder, head), size)
            own = np.where(later, np.iinfo(np.int64).max, place)
            later |= place != np.repeat(np.minimum.reduceat(own, head), size)
        return C.answer(table, row[of], later, twice=c[of], offset=offset.astype(np.int16))

    def last(left, right):
        parts = list(_slices(left.column("payload"), width, seed))
        firsts_of = _Firsts([p[-1] for p in parts], right.filter(pa.compute.is_valid(right.column("c"))))
        twice, offset, _ = C.gather(right.filter(pa.compute.is_valid(right.column("twice"))), twice=np.uint64, offset=np.int16)
        known = np.sort(_spot(twice, offset.astype(np.int64)))
        out = {"doc_id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        for table, row, data, at, w in parts:
            later, shared = firsts_of(w)
            _, starts = C.within(w.first[later], w.last[later])
            run, more = C.within(w.first[shared], w.last[shared])
            if len(more):
                spots = _spot(w.c[shared][run], more - w.first[shared][run])
                starts = np.concatenate([starts, more[C.lookup(spots, known)[1]]])
            gone = C.covered(starts, width, len(data))
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            heads = at[:-1][at[:-1] < len(data)]
            begins[heads] = gone[heads]
            lost, spans = (np.searchsorted(np.flatnonzero(x), at) for x in (gone, begins))
            rows = len(at) - 1
            out["doc_id"].append(table.column("id").slice(row, rows).combine_chunks())
            out["n_bytes"].append(np.diff(at))
            out["n_removed"].append(np.diff(lost))
            out["n_spans"].append(np.diff(spans))
            for i in range(rows):
                kept = data[at[i]: at[i + 1]]
                if out["n_removed"][-1][i]:
                    kept = kept[~gone[at[i]: at[i + 1]]]
                out["kept_sha256"].append(hashlib.sha256(np.ascontiguousarray(kept)).hexdigest())
        ids = pa.concat_arrays(out["doc_id"]) if out["doc_id"] else pa.array([], pa.int64())
        counts = {k: pa.array(np.concatenate([*out[k], np.zeros(0, np.int64)]), pa.int64())
                  for k in ("n_bytes", "n_removed", "n_spans")}
        return pa.table({"doc_id": ids, **counts, "kept_sha256": pa.array(out["kept_sha256"], pa.string())})

    known = by_chunk.applyInArrow(entries, _ENTRIES).groupBy("bucket").applyInArrow(firsts, _FIRSTS)
    sent = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(segments, _SEGMENTS)
    found = sent.groupBy("bucket").applyInArrow(doubles, _DOUBLES)
    replies = known.unionByName(found, allowMissingColumns=True)
    return by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(
        last, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _spot(c: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return C.mix(c + offset.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def query(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(C.read_documents(spark, sf_dir))


#: Bytes are two hexadecimal digits each.
SQL = f"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as t from documents),
win as (
  select doc_id, p, substr(t, 2 * p - 1, {2 * WIDTH}) as g
  from (select doc_id, t, unnest(range(1, greatest(len(t) // 2 - {WIDTH - 2}, 1))) as p from d)),
hit as (select doc_id, p from (select doc_id, p, row_number() over (partition by g order by doc_id, p) as n from win) where n > 1),
spans as (
  select doc_id, min(p) as a, max(p) + {WIDTH} as b
  from (select doc_id, p, sum(fresh) over (partition by doc_id order by p) as s
        from (select doc_id, p, case when p - lag(p) over (partition by doc_id order by p) <= {WIDTH} then 0 else 1 end as fresh
              from hit))
  group by doc_id, s),
ends as (
  select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 1) as before from spans),
parts as (
  select d.doc_id, before as k, substr(t, 2 * before - 1, 2 * (a - before)) as x from ends join d on d.doc_id = ends.doc_id
  union all
  select d.doc_id, last.b, substr(t, 2 * last.b - 1, len(t)) from d
  join (select doc_id, max(b) as b from spans group by doc_id) last on d.doc_id = last.doc_id),
kept as (select doc_id, string_agg(x, '' order by k) as x from parts group by doc_id),
lost as (select doc_id, sum(b - a) as n, count(*) as spans from spans group by doc_id)
select d.doc_id, cast(len(t) // 2 as bigint) as n_bytes, cast(coalesce(n, 0) as bigint) as n_removed,
       cast(coalesce(spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(x, t))) as kept_sha256
from d left join lost on d.doc_id = lost.doc_id left join kept on d.doc_id = kept.doc_id
"""
