"""Benchmark decontamination by spaced-seed hashing.

Test items and documents are token sequences (ASCII letters in lower case,
punctuation parts tokens). A fixed mask lays over ``8`` neighbouring tokens and
ignores two of them, so a hash survives substitutions at ignored places. Hashes
of the documents that equal a test hash give an alignment of document and item;
along it and around the hit, ``WINDOW`` consecutive tokens with at least
``SHARE`` of them equal verify the overlap. For the two masks below every window
with so few substitutions has a hit (checked for all pairs of places in the tests).

The test hashes are the stated query set: blocks of ``BLOCK`` hashes at most
are broadcast and each block meets all documents where they lie, with no
shuffle. A larger benchmark makes more blocks.

Edge cases: null or empty texts and items have no tokens and no overlap; an
item shorter than the window is compared whole, and found by its longest run
that must be free of substitutions; items that repeat are reported each, rows
that repeat too; null ids pass through; empty tables give an empty result;
other columns pass through ``drop_contaminated``; very long texts, also of one
token over and over, are worked on ``PAIRS`` pairs at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm import common as C

WINDOW, SHARE = 13, 0.8
#: Fixed masks; 1 is compared, 0 ignored.
MASKS = ("11101011", "11001111")
BLOCK = 1 << 20
#: Pairs of a document place and an item that are verified at a time.
PAIRS = 1 << 16
_SIEVE_BITS = 22


def tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every token."""
    start, end, row = C.word_spans(data, at, C.PUNCTUATED)
    return C.word_hashes(C.LOWER[data], start, end), row


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the compared tokens under the mask at every place."""
    places = [i for i, c in enumerate(mask) if c == "1"]
    n = max(0, len(words) - len(mask) + 1)
    total = np.full(n, len(mask), np.uint64)
    for power, place in zip(C.powers(len(places) + 1)[1:], places, strict=True):
        total = total + words[place: place + n] * power
    return C.mix(total)


def _window(length: int, window: int, share: float) -> tuple[int, int]:
    """(tokens of a window, how many must be equal) for an item of so many tokens."""
    width = min(window, length)
    return width, math.ceil(share * width - 1e-9)


def _masks(length: int, window: int, share: float) -> tuple[str, ...]:
    """Masks that find an item: the fixed ones, or for a short item a run that stays free of substitutions."""
    if length >= window:
        return MASKS
    width, need = _window(length, window, share)
    return ("1" * max(1, -(-need // (width - need + 1))),)


class Block:
    """Seeds of some test items, grouped by hash and item, with the items' tokens."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], window: int, share: float):
        self.ids = [i for i, _ in items]
        self.words = np.concatenate([w for _, w in items])
        self.edge = np.concatenate([[0], np.cumsum([len(w) for _, w in items])])
        self.width, self.need = (np.array(x) for x in zip(*(_window(len(w), window, share) for _, w in items), strict=True))
        self.by_mask: dict[str, tuple] = {}
        found: dict[str, list] = {}
        for n, (_, words) in enumerate(items):
            for mask in _masks(len(words), window, share):
                h = seeds(words, mask)
                found.setdefault(mask, []).append((h, np.full(len(h), n), self.edge[n] + np.arange(len(h))))
        for mask, parts in found.items():
            h, item, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")             # the entries of a hash stay in the order of items and places
            h, item = h[order], item[order]
            new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (item[1:] != item[:-1]))[: len(h)])
            sieve = np.zeros(1 << _SIEVE_BITS, bool)
            sieve[h >> np.uint64(64 - _SIEVE_BITS)] = True
            self.by_mask[mask] = (h[new], item[new], new, np.diff(np.append(new, len(h))), place[order], sieve)

    def meets(self, words: np.ndarray, row: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document places whose seed is an item's, with the range of groups (hash, item) of that hash."""
        hashes, *_, sieve = self.by_mask[mask]
        h = seeds(words, mask)
        at = np.flatnonzero(sieve[h >> np.uint64(64 - _SIEVE_BITS)])
        at = at[row[at] == row[at + len(mask) - 1]]
        lo, hi = np.searchsorted(hashes, h[at]), np.searchsorted(hashes, h[at], "right")
        return at[hi > lo], lo[hi > lo], hi[hi > lo]

    def verify(self, words, at, place, item, begin, end, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys (item, token) in good windows that hold a hit, and of the equal tokens among them.

        Seeds of ``size`` tokens are equal at ``at`` in the document, which has
        the tokens from ``begin`` to ``end``, and at ``place`` in the item.
        """
        cover, same = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        widths = self.width[item]
        for width in np.unique(widths).tolist():
            p, q, i, lo, hi = (x[widths == width][:, None] for x in (at, place, item, begin, end))
            near = np.arange(size - width, width)            # what a window that holds the hit may reach
            inside = (p + near >= lo) & (p + near < hi) & (q + near >= self.edge[i]) & (q + near < self.edge[i + 1])
            equal = inside & (words[np.where(inside, p + near, 0)] == self.words[np.where(inside, q + near, 0)])

            def sums(x, width=width):
                total = np.cumsum(np.pad(x, ((0, 0), (1, 0))), axis=1)
                return total[:, width:] - total[:, :-width]

            good = (sums(equal) >= self.need[i]) & (sums(inside) == width)
            some = good.any(axis=1)
            starts = np.cumsum(np.pad(good[some], ((0, 0), (1, 0))), axis=1)
            column = np.arange(len(near))
            held = starts[:, np.minimum(column + 1, good.shape[1])] > starts[:, np.maximum(0, column - width + 1)]
            keys = i[some] * len(words) + p[some] + near
            cover.append(keys[held])
            same.append(keys[held & equal[some]])
        return np.unique(np.concatenate(cover)), np.unique(np.concatenate(same))

    def found(self, words: np.ndarray, row: np.ndarray, edge: np.ndarray) -> dict[tuple[int, int], list[int]]:
        """(row, item) -> [tokens in good windows, equal ones, first, last], for rows with tokens edge[r]..edge[r + 1].

        A hit is passed over where all that its windows could reach is known
        to be covered and equal, so repetitive texts do not cost every pair of
        places; ``PAIRS`` places and items are held at a time.
        """
        out: dict[tuple[int, int], list[int]] = {}
        n = len(words)
        met = {mask: self.meets(words, row, mask) for mask in self.by_mask}
        load = np.zeros(n, np.int64)
        for at, lo, hi in met.values():
            load[at] += hi - lo
        total = np.cumsum(load)
        if not n or not total[-1]:
            return out
        cuts = np.unique(np.searchsorted(total, np.arange(0, total[-1], PAIRS)))
        cover = same = np.zeros(0, np.int64)
        for a, b in zip(cuts, np.append(cuts[1:], n), strict=True):
            for mask, (at, lo, hi) in met.items():
                _, items, first, count, place, _ = self.by_mask[mask]
                i, j = np.searchsorted(at, [a, b])
                which, group = C.within(lo[i:j], hi[i:j] - 1)
                p, turn, size = at[i:j][which], 0, len(mask)
                while len(p):                                # the next entry of each group, where one is still of use
                    item, r = items[group], row[p]
                    left = item * n + np.maximum(edge[r], p + size - self.width[item])
                    right = item * n + np.minimum(edge[r + 1], p + self.width[item])
                    use = (turn < count[group]) & (np.searchsorted(same, right) - np.searchsorted(same, left) < right - left)
                    p, group, item, r = p[use], group[use], item[use], r[use]
                    more, equal = self.verify(words, p, place[first[group] + turn], item, edge[r], edge[r + 1], size)
                    if len(more):
                        cover, same = np.union1d(cover, more), np.union1d(same, equal)
                    turn += 1
            # later hits do not reach further back than a window
            bound = n if b == n else b - self.width.max()
            done, equal = cover[cover % n < bound], same[same % n < bound]
            cover, same = cover[cover % n >= bound], same[same % n >= bound]
            rows = len(edge)
            pair, at, counts = np.unique(done // n * rows + row[done % n], return_index=True, return_counts=True)
            equals = np.zeros(len(pair), np.int64)
            which, k = np.unique(equal // n * rows + row[equal % n], return_counts=True)
            equals[np.searchsorted(pair, which)] = k
            ends = zip(pair.tolist(), counts.tolist(), equals.tolist(), (done[at] % n).tolist(),
                       (done[at + counts - 1] % n).tolist(), strict=True)
            for key, covered, alike, head, last in ends:
                held = out.setdefault((key % rows, key // rows), [0, 0, head, last])
                held[0] += covered
                held[1] += alike
                held[3] = last
        return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, share: float, size: int = BLOCK) -> Iterator[Block]:
    """Test items in blocks of about ``size`` seeds; the driver holds one block at a time."""
    held, seeds_held = [], 0
    items = benchmark.select(F.col(f"`{id_col}`").cast("long"), F.encode(F.col(f"`{text_col}`"), "utf-8"))
    for item, text in items.toLocalIterator():
        data = np.frombuffer(bytes(text or b""), np.uint8)
        words, _ = tokens(data, np.array([0, len(data)]))
        if len(words):
            held.append((item, words))
            seeds_held += len(MASKS) * len(words)
        if seeds_held >= size:
            yield Block(held, window, share)
            held, seeds_held = [], 0
    if held:
        yield Block(held, window, share)


def overlaps(block: Block, texts: pa.Array) -> Iterator[tuple]:
    """(row, item, tokens in verified windows, equal tokens, first token, last token) of each overlap."""
    for first_row, data, at in C.text_slices(texts):
        words, row = tokens(data, at)
        edge = np.searchsorted(row, np.arange(len(at)))
        for (r, item), (covered, equal, first, last) in block.found(words, row, edge).items():
            yield first_row + r, block.ids[item], covered, equal, first - int(edge[r]), last - int(edge[r])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """One row for each document and item that overlap: doc_id, item_id, n_tokens, n_equal, first_token, last_token."""
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = "doc_id long, item_id long, n_tokens long, n_equal long, first_token long, last_token long"
    names = [x.split()[0] for x in schema.split(", ")]
    out = spark.createDataFrame([], schema)
    for block in blocks(benchmark, item_id, item_text, window, share):
        shared = spark.sparkContext.broadcast(block)            # at most BLOCK seeds

        def run(batches, shared=shared):
            for batch in batches:
                rows = list(overlaps(shared.value, batch.column(1)))
                if rows:
                    row, *rest = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in rest)], names=names)

        out = out.union(slim.mapInArrow(run, schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text", window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """The rows without an overlap with any item, with all their columns."""
    place = docs.columns.index(text_col)
    for block in blocks(benchmark, item_id, item_text, window, share):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[x[0] for x in overlaps(shared.value, batch.column(place))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def query(spark, sf_dir: str) -> DataFrame:
    return contaminated(C.read_documents(spark, sf_dir), C.read_documents(spark, sf_dir, "benchmark"))


_TOKENS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
SQL = f"""
with d as (select doc_id, ts, len(ts) as n from (select doc_id, {_TOKENS} as ts from documents)),
i as (
  select item_id, ts, n, least(n, {WINDOW}) as width,
         cast(ceil({SHARE} * least(n, {WINDOW}) - 1e-9) as bigint) as need
  from (select item_id, ts, len(ts) as n from (select item_id, {_TOKENS} as ts from benchmark)) where n > 0),
dt as (select doc_id, unnest(ts) as w, generate_subscripts(ts, 1) - 1 as p from d),
it as (select item_id, unnest(ts) as w, generate_subscripts(ts, 1) - 1 as p from i),
met as (select doc_id, item_id, dt.p - it.p as shift, dt.p as p from dt join it on dt.w = it.w),
many as (
  select doc_id, item_id, shift from met group by doc_id, item_id, shift
  having count(*) >= (select min(need) from i)),
m as (select met.* from met join many using (doc_id, item_id, shift)),
s as (
  select distinct doc_id, item_id, shift, unnest(range(p - width + 1, p + 1)) as s
  from m join i using (item_id)),
good as (
  select s.doc_id, s.item_id, s.shift, s.s, any_value(i.width) as width
  from s join i using (item_id) join d using (doc_id)
  join m on m.doc_id = s.doc_id and m.item_id = s.item_id and m.shift = s.shift and m.p between s.s and s.s + i.width - 1
  where s.s >= greatest(0, s.shift) and s.s + i.width <= least(d.n, s.shift + i.n)
  group by s.doc_id, s.item_id, s.shift, s.s having count(*) >= any_value(i.need)),
places as (
  select doc_id, item_id, count(*) as n_tokens, min(p) as first_token, max(p) as last_token
  from (select distinct doc_id, item_id, unnest(range(s, s + width)) as p from good) group by doc_id, item_id),
same as (
  select doc_id, item_id, count(*) as n_equal from (
    select distinct m.doc_id, m.item_id, m.p from m join good using (doc_id, item_id, shift)
    where m.p between s and s + width - 1) group by doc_id, item_id)
select doc_id, item_id, cast(n_tokens as bigint) as n_tokens, cast(n_equal as bigint) as n_equal,
       cast(first_token as bigint) as first_token, cast(last_token as bigint) as last_token
from places join same using (doc_id, item_id)
"""
