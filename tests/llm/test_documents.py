"""Sharding, SimHash, quality rules and decontamination against brute force."""

import itertools
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from playlens.llm import common as C
from playlens.llm import op2_sharding as sharding
from playlens.llm import op8_simhash as simhash
from playlens.llm import op9_quality_rules as rules
from playlens.llm import op10_decontamination as leaks
from playlens.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- sharding

def fills(sizes, capacity, shards):
    n, held = 1, 0
    for s in sizes:
        if s > capacity:
            return False
        if held + s > capacity:
            n, held = n + 1, 0
        held += s
    return n <= shards


def check_shards(df, shards=16):
    rows = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.shiftrightunsigned(
        F.xxhash64(F.encode(F.coalesce("text", F.lit("")), "utf-8")), 64 - sharding.KEY_BITS).alias("key")).collect()
    got = sharding.shard_documents(df, shards=shards).collect()
    assert Counter((r.doc_id, zlib.crc32(r.text.encode()), len(r.text.encode()) + 1) for r in rows) == Counter(
        (r.doc_id, r.text_crc32, r["size"]) for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    groups = Counter()
    for r in rows:
        groups[r.key] += len(r.text.encode()) + 1
    sizes = [groups[k] for k in sorted(groups)]
    capacity = next((c for c in range(1, sum(sizes) + 1) if fills(sizes, c, shards)), 0) if sum(sizes) < 4000 else None
    if capacity is None:
        low, high = 1, sum(sizes)
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if fills(sizes, middle, shards) else (middle + 1, high)
        capacity = low
    shard, held, want = 0, 0, {}
    for k in sorted(groups):
        if held + groups[k] > capacity:
            shard, held = shard + 1, 0
        held += groups[k]
        want[k] = shard
    of_text = {(zlib.crc32(r.text.encode()), len(r.text.encode()) + 1): r.key for r in rows}
    assert all(want[of_text[r.text_crc32, r["size"]]] == r.shard for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_shards_are_the_minimax_partition(frame, monkeypatch, seed):
    monkeypatch.setattr(sharding, "FIRST_BITS", [4, 12, 4][seed])      # few first units: several rounds of splitting
    r = random.Random(seed)
    make = [lambda: str(r.randint(0, 30)) * r.randint(1, 300), lambda: "ab" * r.randint(0, 900) + str(r.random()),
            lambda: r.choice(["q" * 3000, str(r.random())])][seed]
    rows = [(i, make()) for i in range(400)] + [(None, None), (None, ""), (5, "é" * 50), (5, "é" * 50)]
    check_shards(frame(rows))


def test_shards_of_few_and_no_documents(frame):
    check_shards(frame([(1, "only"), (2, "two texts")]))
    assert sharding.shard_documents(frame([])).count() == 0


# ---- SimHash

def fingerprint_by_force(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(frame):
    r = random.Random(2)
    base = [" ".join(f"w{r.randint(0, 300)}" for _ in range(80)) for _ in range(25)]
    rows = []
    for i in range(150):
        words = r.choice(base).split()
        if r.random() < 0.7:
            words[r.randrange(80)] = r.choice(["X", "Éa", "other"])
        rows.append((i, " ".join(words)))
    rows += [(200, None), (201, ""), (202, "One"), (203, "one"), (204, "a b"), (None, base[0]), (None, "alone here now"), (3, rows[3][1])]
    prints = [fingerprint_by_force(t) for _, t in rows]
    near = [[j for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 2] for i in range(len(rows))]
    name = [None] * len(rows)
    for i in range(len(rows)):
        if name[i] is None:
            members, queue = {i}, [i]
            while queue:
                new = set(near[queue.pop()]) - members
                members |= new
                queue += new
            ids = [rows[m][0] for m in members if rows[m][0] is not None]
            for m in members:
                name[m] = min(ids, default="none")
    want = Counter((i, f"{p:016x}", None if n == "none" else n) for (i, _), p, n in zip(rows, prints, name, strict=True))
    assert Counter(map(tuple, simhash.near_copies(frame(rows)).collect())) == want
    kept = simhash.keep_one(frame(rows))
    assert kept.columns == frame(rows).columns
    named = {n for n in name if n != "none"}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([*map(str, named), "None"])
    assert simhash.near_copies(frame([])).count() == 0


@pytest.mark.parametrize("most", [4096, 2])
def test_links_reach_what_all_pairs_reach(spark, most):
    r = random.Random(5)
    values = {r.getrandbits(64) for _ in range(40)}
    for v in list(values):
        for _ in range(r.randint(0, 12)):
            v ^= 1 << r.randrange(64)
            values.add(v)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = simhash.links(spark.createDataFrame(signed, "fp long"), most=most).collect()
    mask = (1 << 64) - 1
    assert all((a ^ b).bit_count() <= 2 for a, b in simhash.shard_links(sorted(values), 2))

    def parts(pairs):
        top = {v: v for v in values}

        def find(x):
            while top[x] != x:
                x = top[x]
            return x
        for a, b in pairs:
            top[find(a & mask)] = find(b & mask)
        return Counter(frozenset(v for v in values if find(v) == t) for t in {find(v) for v in values})

    every = [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 2]
    assert parts(found) == parts(every)


def test_bk_tree_finds_what_a_scan_finds():
    r = random.Random(7)
    members = list({r.getrandbits(12) for _ in range(200)})
    tree = simhash.BKTree(members[0])
    for m in members[1:]:
        tree.add(m)
    for q in range(0, 4096, 37):
        assert sorted(tree.near(q, 2)) == sorted(m for m in members if (m ^ q).bit_count() <= 2)


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (300, 200), (7, 7)]
    random.Random(1).shuffle(chain)
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 200: 100, 300: 100}


# ---- quality rules

def test_rules_match_sql_on_edge_texts(spark):
    r = random.Random(3)
    texts = [None, "", " \n\t", "one", "a b " * 40, "x\n\nx\nx\n y", "é ß # * $ % & | < >", "w " * 19, "w " * 20]
    texts += [" ".join(r.choice("abcdefgh") for _ in range(r.randint(0, 120))) for _ in range(150)]
    texts += [" ".join(f"w{r.randint(0, 9999)}" for _ in range(60)) + "\nsame line\nsame line" for _ in range(60)]
    rows = [(i, t, [None, "bad", "ok", "mixed"][i % 4] if i < 100 else "ok") for i, t in enumerate(texts)]
    rows += [(1000 + i, "junk", "spam") for i in range(60)] + [(2000, " ".join(f"v{i}" for i in range(50)), "spam")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("host", F.lit(1)).withColumn("n_words", F.lit("x"))
    got = rules.quality_rules(docs).drop("host_rate")
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toArrow())
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(rules.SQL).fetchall())
    verdicts = {r.doc_id: r for r in got.collect()}
    assert not verdicts[2000].base_failed and not verdicts[2000].kept          # its host has failed
    kept = rules.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, v in verdicts.items() if v.kept}
    assert rules.quality_rules(docs.limit(0)).count() == 0 == rules.keep_good(docs.limit(0)).count()


@pytest.mark.parametrize("clean", [0, 20, 2_000, 10_000])
def test_host_verdict_does_not_depend_on_how_many_hosts_are_clean(spark, clean):
    def host(name, n, failed):
        return spark.range(n).select(F.lit(name).alias("host"), (F.col("id") < failed).alias("failed"))

    # the clean hosts have 500 documents each and fail at 13 %
    rows = spark.range(clean * 500).select(F.concat(F.lit("clean"), (F.col("id") % clean if clean else F.col("id")).cast("string")).alias("host"),
                                           (F.floor(F.col("id") / max(clean, 1)) < 65).alias("failed"))
    for x in [host("most", 500, 450), host("all", 100, 100), host("few", 3, 3), host("half", 500, 250)]:
        rows = rows.union(x)
    got = {r.host: r.host_ok for r in rules.host_verdicts(rows).where("not host like 'clean%' or not host_ok").collect()}
    if clean:
        assert got == {"most": False, "all": False, "few": True, "half": True}
    else:
        assert not got["most"] and not got["all"] and got["half"]


def test_rules_run_no_python(spark, sf_dir):
    plan = rules.keep_good(C.read_documents(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---- decontamination

def leaks_by_force(docs, items, window=13, share=0.8):
    def tokens(t):
        return re.findall(rb"[a-z0-9\x80-\xff]+", (t or "").encode().lower())

    out = Counter()
    for d, text in docs:
        a = tokens(text)
        for i, item in items:
            b = tokens(item)
            width = min(window, len(b))
            need = math.ceil(share * width - 1e-9)
            places, same = set(), set()
            for shift in range(-len(b), len(a)) if b else ():
                for s in range(max(0, shift), min(len(a), shift + len(b)) - width + 1):
                    equal = [k for k in range(s, s + width) if a[k] == b[k - shift]]
                    if len(equal) >= need:
                        places |= set(range(s, s + width))
                        same |= set(equal)
            if places:
                out[d, i, len(places), len(same), min(places), max(places)] += 1
    return out


@pytest.mark.parametrize("block", [leaks.BLOCK, 30])
def test_overlaps_match_brute_force(spark, frame, monkeypatch, block):
    monkeypatch.setattr(leaks.blocks, "__defaults__", (block,))
    r = random.Random(block)
    words = [f"w{k}" for k in range(12)] + ["Ünder", "x-y"]
    items = [(i, " ".join(r.choice(words) for _ in range(n))) for i, n in enumerate([0, 1, 3, 6, 9, 12, 13, 15, 30, 40])] + [(99, None)]
    docs = []
    for i in range(40):
        part = r.choice(items[:-1])[1].split() if r.random() < 0.7 else []
        part = [w if r.random() > 0.1 else "other" for w in part]
        docs.append((i, " ".join([r.choice(words) for _ in range(r.randint(0, 15))] + part + ["end", "tail"]).upper()))
    docs += [(50, None), (51, ""), (None, items[8][1]), (None, items[8][1])]
    benchmark = spark.createDataFrame([(*x, "n") for x in items], "item_id long, text string, doc_id string")
    got = Counter(map(tuple, leaks.contaminated(frame(docs), benchmark).collect()))
    assert got == leaks_by_force(docs, items)
    clean = leaks.drop_contaminated(frame(docs), benchmark)
    hit = {(d, i) for d, i, *_ in got}
    assert clean.columns == frame(docs).columns
    assert sorted(str(x.doc_id) for x in clean.collect()) == sorted(str(d) for d, _ in docs if all(d != h for h, _ in hit))


def test_masks_find_every_window_with_allowed_substitutions():
    width, need = leaks._window(100, leaks.WINDOW, leaks.SHARE)
    for lost in itertools.combinations(range(width), width - need):
        assert any(all(s + k not in lost for k, c in enumerate(m) if c == "1")
                   for m in leaks.MASKS for s in range(width - len(m) + 1))
    for length in range(1, leaks.WINDOW):
        width, need = leaks._window(length, leaks.WINDOW, leaks.SHARE)
        (mask,) = leaks._masks(length, leaks.WINDOW, leaks.SHARE)
        for lost in itertools.combinations(range(width), width - need):
            assert any(all(s + k not in lost for k in range(len(mask))) for s in range(width - len(mask) + 1))


def block_of(items):
    held = []
    for i, text in items:
        data = np.frombuffer(text.encode(), np.uint8)
        held.append((i, leaks.tokens(data, np.array([0, len(data)]))[0]))
    return leaks.Block(held, leaks.WINDOW, leaks.SHARE)


@pytest.mark.parametrize("pairs", [1, 7, leaks.PAIRS])
def test_repetitive_texts_match_brute_force(monkeypatch, pairs):
    monkeypatch.setattr(leaks, "PAIRS", pairs)
    r = random.Random(pairs)
    for words in ("a", "ab", "abc"):
        items = [(k, " ".join(r.choice(words) for _ in range(n))) for k, n in enumerate([3, 9, 13, 20, 40])]
        docs = [(k, " ".join(r.choice(words + "z") for _ in range(n)) + " q " + items[k % 5][1]) for k, n in enumerate([0, 5, 13, 40, 60])]
        got = Counter((docs[row][0], *x) for row, *x in leaks.overlaps(block_of(items), pa.array([t for _, t in docs])))
        assert got == leaks_by_force(docs, items)


def test_a_megabyte_of_one_token():
    tracemalloc.start()
    found = list(leaks.overlaps(block_of([(1, "a " * 300)]), pa.array(["a " * 500_000])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(0, 1, 500_000, 500_000, 0, 499_999)] and most < 300e6


def test_decontamination_of_empty_tables(spark, frame):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert leaks.contaminated(frame([(1, "a")]), nothing).count() == 0
    assert leaks.drop_contaminated(frame([(1, "a")]), nothing).count() == 1
    assert leaks.contaminated(frame([]), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
