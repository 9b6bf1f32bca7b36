"""Importance resampling, URL filter and tokenizer alignment against brute force and SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from playlens.llm import op11_importance as importance
from playlens.llm import op12_url_filter as urls
from playlens.llm import op13_token_alignment as alignment

JSON, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# ---- importance resampling ----

def brute_features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % 10_000 for g in grams]


def brute_resample(rows, target, percent=5, least=20):
    made = [(i, *brute_features(t)) for i, t in rows]
    source, wanted = Counter(b for _, _, f in made for b in f), Counter(b for t in target for b in brute_features(t)[1])
    s, t = float(sum(source.values())), float(sum(wanted.values()))
    gain = [math.floor(1000 * math.log((wanted[b] + 1.0) * (s + 10_000) / ((source[b] + 1.0) * (t + 10_000)))) for b in range(10_000)]
    out = []
    for i, n, f in made:
        weight = sum(gain[b] for b in f)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, n])
    may = sorted((r for r in out if r[5] >= least and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(may[: percent * len(may) // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in out), key=str)


def prose(n, seed, vocabulary=60):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéñ漢Z0") for _ in range(r.randint(1, 9))) for _ in range(vocabulary)]
    return ["".join(r.choice(words) + r.choice([" ", ", ", "\n", "--", "\x00"]) for _ in range(r.randint(0, 80))) for _ in range(n)]


def test_resample_matches_brute_force(frame):
    rows = list(enumerate(prose(400, 3))) + [(900, None), (901, ""), (902, "a" * 500 + " b"), (None, "x " * 30), (7, "same id"), (903, "--")]
    target = prose(20, 4)
    docs, items = frame(rows), frame(list(enumerate(target)))
    got = importance.resample(docs, items, percent=30).collect()
    assert sorted(map(tuple, got), key=str) == brute_resample(rows, target, percent=30)


def test_equal_scores_go_to_the_smaller_id_and_repeats_count(spark, frame):
    rows = [(5, "a b " * 10)] * 4 + [(i, "c d " * 10) for i in range(40)]
    got = sorted(map(tuple, importance.resample(frame(rows), frame([]), percent=20).collect()), key=str)
    assert got == brute_resample(rows, [], percent=20)
    assert importance.resample(frame([]), frame([]), percent=20).count() == 0


def test_a_very_long_text_is_read_whole(frame):
    text = " ".join(f"w{n % 997}" for n in range(300_000))
    got = importance.resample(frame([(1, text), (2, "x y z")]), frame([(0, "x y")])).collect()
    assert sorted(map(tuple, got), key=str) == brute_resample([(1, text), (2, "x y z")], ["x y"])


def test_crcs_are_joined_by_length():
    advance, r = importance.Advance(), random.Random(1)
    heads = [r.randbytes(r.randint(0, 30)) for _ in range(200)]
    tails = [r.randbytes(r.choice([0, 1, 5, 300, 70_000])) for _ in range(200)]
    crc = np.array([zlib.crc32(x) for x in heads], np.uint32)
    got = advance(crc, np.array([len(x) for x in tails])) ^ np.array([zlib.crc32(x) for x in tails], np.uint32)
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(heads, tails, strict=True)]


# ---- URL filter ----

def by_sql(pages):
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": pa.array([p for p, _ in pages], pa.int64()), "url": pa.array([u for _, u in pages], pa.string())}))
    names = ["page_id", "host", "path", "rule", "verdict"]
    return sorted(con.execute(f"select {', '.join(names)} from ({urls.SQL})").fetchall(), key=str)


def pages_frame(spark, pages):
    return spark.createDataFrame([(p, u, "h", "r", "t", 1.0) for p, u in pages],
                                 "page_id long, url string, host string, rule string, tokens string, confidence double")


def made_urls(n, seed):
    r = random.Random(seed)
    return ["".join([r.choice(["http", "https", "HTTP"]), "://", r.choice(["", "www.", "m.", "M."]), r.choice(["a", "bet-win", "x9", "Shop"]),
                     r.choice([".net", ".com", ".org", ".example.net", ".example.com", ".Example.COM"]),
                     r.choice(["", "/", "/en/", "/de/", "/fr/", "/en", "/de/win/cash", "/fr/Été/7"]), r.choice(["", "5", "12.html"]),
                     r.choice(["", "?page=2&ref=x", "?utm=1", "#top", "?a=b?c/d#e?f=1"])]) for _ in range(n)]


ODD_URLS = [None, "", "no scheme.net/x", "://net/", "http://net", "http://net/", "http://xnet/", "http://a.NET/fr/", "a://b://org/fr/",
            "http://net?x/", "http://net#/", "http://.net/", "http://example.net/en/", "http://example.net/en", "http://u:p@q.net:80/",
            "http://a.net/\nline", "http://a.org/fr/" + "p/" * 3000, "http://EXAMPLE.com/de/"]


def test_filter_matches_sql_on_odd_urls(spark):
    pages = list(enumerate(ODD_URLS + made_urls(500, 8) + made_urls(20, 8))) + [(None, "http://x.net/"), (3, "http://a.com/fr/")]
    got = urls.filter_urls(pages_frame(spark, pages)).collect()
    assert sorted(map(tuple, got), key=str) == by_sql(pages)


def test_filter_without_labels_allows_the_rest(spark):
    pages = [(1, "http://a.com/x"), (2, None)]
    got = urls.filter_urls(pages_frame(spark, pages)).collect()
    assert sorted(map(tuple, got)) == [(1, "a.com", "/x", None, "allow"), (2, "", "", None, "allow")]
    assert urls.filter_urls(pages_frame(spark, [])).count() == 0
    assert {r.verdict for r in urls.filter_urls(pages_frame(spark, [(1, "http://a.net/")]), listed=()).collect()} == {"allow"}


def test_mined_rules_are_kept_by_support_confidence_and_size(spark):
    rows = [(["a", "b"], "block")] * 40 + [(["a", "c"], "allow")] * 40 + [(["b", "d"], "block")] * 20 + [(["e"], "block")]
    found = urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.05, 0.9)
    assert sorted((tuple(r.antecedent), r.verdict) for r in found.collect()) == [(("b",), "block"), (("c",), "allow"), (("d",), "block")]


def test_filter_plan_has_no_python(spark, sf_dir):
    plan = urls.query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


# ---- tokenizer alignment ----

@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES), alignment.Tokenizers(open(JSON, encoding="utf-8").read(), open(PIECES, "rb").read())


def brute_links(text, libraries):
    """(ids A, ids B, groups, linked pairs) with the libraries on the whole text, or None."""
    a, b, both = libraries
    if not text:
        return None
    raw = (" " + text).encode()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    words_a, words_b = [both.a_bytes[i] for i in ids_a], [both.b_bytes[i] for i in ids_b]
    if b"".join(words_a) != raw or b"".join(words_b) != raw:
        return None
    ends = [np.cumsum([len(w) for w in words]).tolist() for words in (words_a, words_b)]
    groups, done = [], [0, 0]
    for end in sorted(set(ends[0]) & set(ends[1])):
        upto = [e.index(end) + 1 for e in ends]
        groups.append(",".join(map(str, ids_a[done[0]:upto[0]])) + "|" + ",".join(map(str, ids_b[done[1]:upto[1]])))
        done = upto
    spans = [list(zip([0, *e[:-1]], e, strict=True)) for e in ends]
    links = [(x, y) for x, (lo, hi) in zip(ids_a, spans[0], strict=True) for y, (lo2, hi2) in zip(ids_b, spans[1], strict=True) if lo < hi2 and lo2 < hi]
    return ids_a, ids_b, groups, links


def brute_alignment(rows, libraries):
    found = [(i, brute_links(t, libraries)) for i, t in rows]
    count = Counter(p for _, f in found if f for p in set(f[3]))
    top: dict[int, int] = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    return sorted(((i, 0, 0, 0, 0, 0, 0, "") if f is None else (
        i, len(f[0]), len(f[1]), len(f[2]), len(f[3]), sum(count[p] == top[p[0]] for p in f[3]), sum(count[p] for p in f[3]),
        hashlib.sha256(";".join(f[2]).encode()).hexdigest()) for i, f in found), key=str)


LETTERS = " \n\t.,;:!?'\"-_()ab Zé ñ3 　 \x85▁中😀\x1cst\u200b\u0301"
ODD_TEXTS = [None, "", " x", "x ", "  ", "\n", "a  b", "a \n b\n\nc", "don't stop. It's\nfine ,x", "<|endoftext|> a<s></s>", "▁", "a\xa0 b\xa0.c", "é.x é, E.x"]


def odd_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(LETTERS) for _ in range(r.randint(1, 50))) for _ in range(n)]


def test_alignment_matches_brute_force(frame, libraries):
    texts = ODD_TEXTS + odd_texts(300, 5) + ["the cat sat on the mat. " * 9] * 30 + ["a b"] * 5
    rows = list(enumerate(texts)) + [(None, "the cat"), (2, "the cat")]
    got = alignment.alignment(frame(rows), JSON, PIECES).collect()
    assert sorted(map(tuple, got), key=str) == brute_alignment(rows, libraries)
    assert alignment.alignment(frame([]), JSON, PIECES).count() == 0


def test_alignment_on_given_documents(spark, sf_dir, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.length("text") < 1500).collect()]
    assert len(rows) > 50
    got = alignment.alignment(spark.createDataFrame(rows, "doc_id long, text string"), JSON, PIECES).collect()
    assert sorted(map(tuple, got), key=str) == brute_alignment(rows, libraries)


def test_blocks_and_memory_do_not_change_results(spark, frame, libraries, monkeypatch):
    seen = alignment.SeenUnits(libraries[2])
    texts = pa.array(odd_texts(60, 6) + ["one two one. " * 40])
    times = np.arange(1, len(texts) + 1)
    whole = alignment.make_block(0, texts, times, seen)
    monkeypatch.setattr(alignment, "SEEN", 0)
    again = alignment.make_block(0, texts, times, seen)
    assert whole.equals(again)


def test_a_long_text_without_spaces(frame, libraries):
    rows = [(1, "ab" * 3000), (2, "x" * 2000 + " y")]
    got = alignment.alignment(frame(rows), JSON, PIECES).collect()
    assert sorted(map(tuple, got), key=str) == brute_alignment(rows, libraries)
