"""Classifier chain (held-out accuracy, edge cases) and transcript parsing (whole Viterbi)."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from playlens.llm import op3_toxicity as toxicity
from playlens.llm import op7_transcripts as transcripts

BAD = ["vile", "rotten", "hateful", "nasty"]


def labelled(seed, n=600):
    """Documents with three categories: rude words, threats (which need rude words), and long texts."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        rude, threat = r.random() < 0.4, r.random() < 0.5
        words = [f"w{r.randint(0, 400)}" for _ in range(r.randint(10, 60))]
        if rude:
            words += r.sample(BAD, 2)
        if threat:
            words += ["watch-out"]
        r.shuffle(words)
        rows.append((i, " ".join(words), int(rude), int(rude and threat)))
    return rows


def test_chain_on_held_out_documents(spark):
    rows = labelled(1)
    docs = spark.createDataFrame([(i, t, "x") for i, t, *_ in rows], "doc_id long, text string, fold string")
    labels = spark.createDataFrame([(i, a, b) for i, _, a, b in rows if i < 400], "doc_id long, rude int, threat int")
    models = toxicity.train(docs, labels, ["rude", "threat"])
    assert [len(m[2]) for m in models] == [1, 2]                 # the second has a weight for the first's log-odds
    got = {r.doc_id: r for r in toxicity.score(docs, models, ["rude", "threat"]).collect()}
    held = [x for x in rows if x[0] >= 400]
    assert np.mean([(got[i].p_rude >= 0.5) == bool(a) for i, _, a, _ in held]) > 0.97
    assert np.mean([(got[i].p_threat >= 0.5) == bool(b) for i, _, _, b in held]) > 0.93


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "vile thing"), (None, "vile thing"), (3, "vile thing"), (4, "w " * 50000)],
                                 "doc_id long, text string")
    schema = "doc_id long, quality int, toxic int"
    nothing = toxicity.toxic_documents(docs, spark.createDataFrame([], schema)).collect()
    assert len(nothing) == 6 and not any(r.toxic for r in nothing)
    one_kind = spark.createDataFrame([(3, 1, 1), (1, None, 1), (77, 0, 0)], schema)
    assert toxicity.toxic_documents(docs, one_kind).count() == 6
    assert toxicity.toxic_documents(docs.limit(0), one_kind).count() == 0


def test_fit_recovers_the_telling_word():
    r = np.random.default_rng(3)
    rows, words, label = [], [], (np.arange(200) % 2).astype(float)
    for i in range(200):
        have = list(r.choice(500, 20, replace=False)) + [1000] * int(label[i])
        rows += [i] * len(have)
        words += have
    chosen, w, v = toxicity.fit(np.array(rows), np.array(words), np.zeros((200, 0)), label)
    assert chosen[np.argmax(w)] == 1000


# ---- transcripts

def talk(seed, turns):
    r = random.Random(seed)
    rows = []
    for t in range(turns):
        role = "system" if t == 0 and r.random() < 0.3 else ["user", "assistant"][t % 2]
        lines = [" ".join(["word"] * r.randint(1, 12)) for _ in range(r.randint(1, 3) if role == "assistant" else 1)]
        rows.append((seed, t, role, "\n".join(lines)))
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    rows = [x for s in range(30) for x in talk(s, 8)] + talk(99, 700)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def paths_by_force(model, messages):
    """The turns of every best path over one-line messages, by trying all paths."""
    lines = [x for _, x in messages]
    shown = model.shown(lines)
    scores = {}
    for path in itertools.product(range(len(transcripts.STATES)), repeat=len(lines)):
        steps = sum(model.step[a, b] for a, b in itertools.pairwise(path))
        scores[path] = model.start[path[0]] + steps + sum(shown[i, s] for i, s in enumerate(path))
    for path in (p for p, x in scores.items() if x == pytest.approx(max(scores.values()))):
        turns = []
        for (turn, _), line, s in zip(messages, lines, path, strict=True):
            role, first = transcripts.STATES[s]
            if first:
                turns.append((turn, 0, role, line))
            else:
                turns[-1] = (*turns[-1][:3], f"{turns[-1][3]}\n{line}".strip())
        yield turns


def path_scores(model, messages, turns_found):
    """(score of the best path of the whole conversation, score of the path found); paths may tie."""
    lines, turns, places = transcripts._lines([{"turn": t, "text": x} for t, x in messages])
    shown = model.shown(lines)
    begins = {(t, line): role for t, line, role in turns_found}
    path, role = [], None
    for at in zip(turns, places, strict=True):
        role = begins.get(at, role)
        path.append(transcripts.STATES.index((role, at in begins)))
    v, found = model.start + shown[0], (model.start + shown[0])[path[0]]
    for before, now, e in zip(path, path[1:], shown[1:], strict=False):
        v = (v[:, None] + model.step).max(axis=0) + e
        found += model.step[before, now] + e[now]
    return v.max(), found


@pytest.mark.parametrize("block", [128, 2])
def test_whole_path_crosses_block_edges(spark, talks, monkeypatch, block):
    monkeypatch.setattr(transcripts, "BLOCK", block)
    raw = transcripts.transcripts(talks)
    model = transcripts.learn(raw)
    got, texts, crossed = {}, {}, 0
    for r in transcripts.parse(raw.drop("role"), model).collect():
        got.setdefault(r.conv_id, []).append((r.turn, r.line, r.role, r.text))
    for r in raw.collect():
        texts.setdefault(r.conv_id, []).append((r.turn, r.text))
    for conv, messages in texts.items():
        turns = sorted(got[conv])
        best, found = path_scores(model, sorted(messages), [x[:3] for x in turns])
        assert found == pytest.approx(best)
        lines = transcripts._lines([{"turn": t, "text": x} for t, x in sorted(messages)])[0]
        model.shown(lines)                                     # takes the markers off
        assert " ".join(x[3] for x in turns).split() == " ".join(lines).split()
        crossed += sum(t and t % block == 0 and (t, 0) not in {x[:2] for x in turns} for t, _ in messages)
    assert crossed or block > 2


def test_roles_are_recovered(talks):
    raw = transcripts.transcripts(talks)
    truth = {(r.conv_id, r.turn): (r.role, r.text) for r in talks.collect()}
    turns = transcripts.parse(raw.drop("role"), transcripts.learn(raw)).collect()
    right = sum(truth[r.conv_id, r.turn] == (r.role, r.text) for r in turns)
    assert right > 0.85 * len(truth)
    assert all(r.rendered == f"<|{r.role}|>\n{r.text}\n" for r in turns)


def test_repeated_turns_are_counted_before_they_meet(spark):
    known = spark.createDataFrame([(1, 0, 1, "a")] * 200 + [(1, 1, 2, "b\nc")] * 300, "conv_id long, turn long, r int, text string")
    rows = transcripts.follows(known).collect()
    assert sorted((r.turn, r.r, r.long, r.next, r.pairs) for r in rows) == [(0, 1, False, 2, 60000), (1, 2, True, None, 300)]


def test_transcript_edge_cases(spark, talks):
    model = transcripts.learn(transcripts.transcripts(talks))
    odd = spark.createDataFrame([(1, None, "User: hi"), (1, 0, None), *[(None, 0, "Bot: a")] * 3, (None, 0, "Bot: b"),
                                 (None, None, "User: c"), (2, 0, ""), (2, 0, ""), (3, 5, "Assistant: " + "long " * 20000)],
                                "conv_id long, turn long, text string")
    odd = odd.withColumn("block", F.lit("x")).withColumn("copies", F.lit(7)).withColumn("talk", F.lit(None).cast("string"))
    out = transcripts.parse(odd, model).collect()
    lone = [(r.turn, r.role, r.text) for r in out if r.conv_id is None]
    assert Counter(lone) == {(0, "assistant", "a"): 3, (0, "assistant", "b"): 1, (None, "user", "c"): 1}
    assert [(r.role, r.text) for r in out if r.conv_id == 3] == [("assistant", ("long " * 20000).strip())]
    for conv, messages in ((1, [(0, ""), (None, "User: hi")]), (2, [(0, ""), (0, "")])):
        got = [(r.turn, r.line, r.role, r.text) for r in out if r.conv_id == conv]
        assert any(sorted(map(str, got)) == sorted(map(str, x)) for x in paths_by_force(model, messages))
    assert transcripts.parse(odd.limit(0), model).count() == 0
    assert transcripts.learn(transcripts.transcripts(talks.limit(0))).step.shape == (6, 6)


@pytest.mark.parametrize("role, name", [(r, n) for r, names in transcripts.MARKER_NAMES.items() for n in names])
def test_a_marker_on_a_lone_message_decides(talks, role, name):
    model = transcripts.learn(transcripts.transcripts(talks))
    lines = [f"{name}: x"]
    shown = model.shown(lines)
    assert transcripts.STATES[int((model.start + shown[0]).argmax())] == (role, True) and lines == ["x"]


def test_blocks_are_bounded_and_in_order(spark, talks, monkeypatch):
    monkeypatch.setattr(transcripts, "BLOCK", 4)
    rows = [(1, 0, f"User: {i}") for i in range(30)] + [(1, None, f"Bot: {i}") for i in range(10)] + [(1, 1 << 62, "late"), (1, -(1 << 62), "early")]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    found = sorted(transcripts._blocks(messages).collect(), key=lambda r: r.block)
    assert max(len(r.messages) for r in found) <= 4
    order = [(m.turn, m.text) for r in found for m in r.messages]
    assert order == sorted(((t, x) for _, t, x in rows), key=lambda m: (m[0] is None, m[0] or 0, m[1]))
    turns = transcripts.parse(messages, transcripts.learn(transcripts.transcripts(talks))).collect()
    said = Counter(w for r in turns for w in r.text.split())
    assert said == Counter(w for _, _, x in rows for w in x.replace("User: ", "").replace("Bot: ", "").split())


@pytest.mark.parametrize("line, role", [("User: hi", 2), ("### Response:", 3), ("<|assistant|> x", 3), ("[System] x", 1),
                                        ("Q: why", 2), ("a cat sat", 0), ("Userland: x", 0), ("", 0), ("Human > go", 2)])
def test_markers(line, role):
    assert transcripts.marker(line)[0] == role
