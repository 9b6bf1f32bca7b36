"""Rules mined from all tokens of the labelled URLs, by FP-growth and by size."""

import itertools
import random

import pytest

from playlens.llm import op12_url_filter as urls

KIND = "tokens array<string>, verdict string"


def kept(found):
    return sorted((tuple(r.antecedent), r.verdict, round(r.confidence, 9), round(r.support, 9), r.token) for r in found.collect())


def brute(rows, support, confidence, longest):
    sets = {}
    for tokens, verdict in rows:
        for k in range(1, longest + 1):
            for a in itertools.combinations(sorted(tokens), k):
                of = sets.setdefault(a, {})
                of[verdict] = of.get(verdict, 0) + 1
    found = {(a, v): (f / sum(of.values()), f / len(rows)) for a, of in sets.items() for v, f in of.items()
             if f >= support * len(rows) and f / sum(of.values()) >= confidence}
    freq = {a[0]: sum(of.values()) for a, of in sets.items() if len(a) == 1}
    return sorted((a, v, round(c, 9), round(s, 9), min(a, key=lambda t: (freq[t], t))) for (a, v), (c, s) in found.items()
                  if not any(set(b) < set(a) and w == v and d >= c for (b, w), (d, _) in found.items()))


def test_a_token_beyond_the_tenth_decides(spark):
    many = [f"p:{c}" for c in "abcdefghijkl"]                # sorted, the deciding token comes 13th
    rows = [([*many, "p:x"], "block")] * 30 + [([*many, "p:y"], "allow")] * 30
    found = kept(urls.mine_rules(spark.createDataFrame(rows, KIND), 0.05, 0.9))
    assert [(a, v) for a, v, *_ in found] == [(("p:x",), "block"), (("p:y",), "allow")]


@pytest.mark.parametrize("width", [0, 40])
def test_both_ways_find_the_rules_of_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(urls, "WIDTH", width)
    r = random.Random(5)
    rows = []
    for _ in range(300):
        tokens = [f"t{k}" for k in range(9) if r.random() < 0.5]
        sure = {"t1", "t4"} <= set(tokens) or {"t0", "t2", "t7"} <= set(tokens)
        rows.append((tokens, "block" if sure and r.random() < 0.97 else "allow"))
    assert kept(urls.mine_rules(spark.createDataFrame(rows, KIND), 0.01, 0.9)) == brute(rows, 0.01, 0.9, urls.LONGEST)


def test_forty_frequent_tokens_together(spark):
    rows = []
    for i in range(120):                                    # 2 ** 40 combinations are frequent with either verdict
        rows.append(([f"a{k:02d}" for k in range(26)] + ([f"z{i % 3}"] if i % 2 else []), "block" if i % 2 else "allow"))
    found = kept(urls.mine_rules(spark.createDataFrame(rows, KIND), 0.1, 0.9, longest=2))
    assert [(a, v) for a, v, *_ in found] == [((f"z{k}",), "block") for k in range(3)]
