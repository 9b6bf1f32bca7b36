"""Transcript parsing: a hidden Markov model recovers who speaks, then turns are rendered.

A transcript is a conversation's messages as lines of text, with speaker
markers of many styles on some first lines. Hidden states are (role, first or
further line of a turn). A line shows a marker class and a length class; their
probabilities and the transitions are counted from conversations with known
roles. The Viterbi path gives each line's role and where turns begin.

A conversation may be of any length, so it is cut into blocks of ``BLOCK``
messages. A block is first reduced to the best score between any two states (a
matrix in the max-plus sense, which is associative); the matrices of a
conversation give the states at the block edges, and each block is then decoded
between its edges. The result is the Viterbi path of the whole conversation: a
turn may go on over block edges, and its pieces are put together afterwards.
Blocks are cut by the message's number in its conversation (turn, then text;
null turns last), so a block is bounded whatever turns repeat or are missing.

A transcript may be an excerpt: it can begin with any role (``EXCERPTS``), so
that a marker on its first line decides.

Edge cases: a null text is one empty line; a null turn comes last; messages
without a conversation id are a transcript each, repeated ones too; repeated
rows of a conversation are repeated messages; equal best paths take the first
role of ``ROLES``; an unknown role does not train; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm import common as C

ROLES = ("system", "user", "assistant")
#: Names that speaker markers use for each role (fixed values).
MARKER_NAMES = {
    "system": ("system", "sys", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q", "instruction", "prompt"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a", "response"),
}
#: Line lengths at which the next class begins.
LENGTHS = (1, 40, 80, 160, 320, 640, 1280)
BLOCK = 128
#: Share of transcripts that may begin with each role, beside those counted.
EXCERPTS = 0.01
STATES = [(role, first) for role in ROLES for first in (True, False)]
_FIRST = np.array([first for _, first in STATES])

_ROLE_OF = {name: n for n, role in enumerate(ROLES) for name in MARKER_NAMES[role]}
_MARKER = regex.compile(
    r"\s*(?:#{1,4}\s*|<\|(?:im_start\|>)?|\[|\*\*)?(?P<name>" + "|".join(sorted(_ROLE_OF, key=len, reverse=True))
    + r")(?:\|>|\]|\*\*)?\s*(?:[:>]|(?<=[\]>*])|$)\s*", regex.IGNORECASE)


def marker(line: str) -> tuple[int, str]:
    """(marker class: 0 for none, else 1 + role; the line without it)."""
    m = _MARKER.match(line)
    return (1 + _ROLE_OF[m["name"].lower()], line[m.end():]) if m else (0, line)


class Model:
    """Log probabilities: ``start`` and ``step`` of states, ``marks`` and ``lengths`` of what they show."""

    def __init__(self, start, step, marks, lengths):
        log = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
        start = np.asarray(start, float)
        self.start = log(start + EXCERPTS * start.sum() + 1e-3)
        self.step = log(np.asarray(step, float) + 1e-3)
        self.marks = log(np.asarray(marks, float) + 1e-3)
        self.lengths = log(np.asarray(lengths, float) + 1e-3)
        self.start[~_FIRST] = -np.inf                      # a transcript begins a turn
        for a, (role, _) in enumerate(STATES):             # a further line keeps the speaker
            for b, (other, first) in enumerate(STATES):
                if not first and role != other:
                    self.step[a, b] = -np.inf

    def shown(self, lines: list[str]) -> np.ndarray:
        """Log probability of each line under each state; lines without their markers are put back in place."""
        out = np.empty((len(lines), len(STATES)))
        for i, line in enumerate(lines):
            mark, lines[i] = marker(line)
            out[i] = self.marks[:, mark] + self.lengths[:, length_class(lines[i])]
        return out

    def reduce(self, shown: np.ndarray) -> np.ndarray:
        """Best score from the state before the block to the state of its last line."""
        m = self.step + shown[0]
        for e in shown[1:]:
            m = (m[:, :, None] + self.step[None]).max(axis=1) + e
        return m

    def decode(self, shown: np.ndarray, before: int, last: int) -> list[int]:
        """The best states of the lines from the state before them (-1: the start) to the last state."""
        v = (self.start if before < 0 else self.step[before]) + shown[0]
        back = []
        for e in shown[1:]:
            ways = v[:, None] + self.step
            back.append(ways.argmax(axis=0))
            v = ways.max(axis=0) + e
        path = [last]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]

    def edges(self, first_row: np.ndarray, matrices: list[np.ndarray]) -> list[int]:
        """The state of the last line of each block of a conversation."""
        v, back = first_row, []
        for m in matrices:
            ways = v[:, None] + m
            back.append(ways.argmax(axis=0))
            v = ways.max(axis=0)
        path = [int(v.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


def length_class(line: str) -> int:
    return int(np.searchsorted(LENGTHS, len(line), "right"))


def learn(messages: DataFrame) -> Model:
    """Counts over messages (conv_id, turn, role, text) with known roles; a few dozen numbers reach the driver."""
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")) - 1
    known = messages.where(F.col("role").isin(*ROLES)).select("conv_id", "turn", role.alias("r"), F.coalesce("text", F.lit("")).alias("text"))
    counts = known.mapInArrow(_line_counts, "r int, first boolean, mark int, length int")
    seen = counts.groupBy("r", "first", "mark", "length").agg(F.count("*").alias("n")).collect()
    marks, lengths = np.zeros((len(STATES), len(ROLES) + 1)), np.zeros((len(STATES), len(LENGTHS) + 1))
    for x in seen:
        s = 2 * x["r"] + (not x["first"])
        marks[s, x["mark"]] += x["n"]
        lengths[s, x["length"]] += x["n"]
    start, step = np.zeros(len(STATES)), np.zeros((len(STATES), len(STATES)))
    for x in follows(known).groupBy("r", "long", "next").agg(F.sum("pairs").alias("count")).collect():
        if x["next"] is not None:
            step[2 * x["r"] + x["long"], 2 * x["next"]] += x["count"]
        if x["long"]:                                      # its first line is followed by a further one
            step[2 * x["r"], 2 * x["r"] + 1] += x["count"]
    for r in range(len(ROLES)):                            # and all its further lines but one follow another
        lines = sum(x["n"] for x in seen if x["r"] == r and not x["first"])
        step[2 * r + 1, 2 * r + 1] = max(0, lines - step[2 * r, 2 * r + 1])
    for x in known.where("turn = 0").groupBy("r").count().collect():
        start[2 * x["r"]] += x["count"]
    return Model(start, step, marks, lengths)


def follows(known: DataFrame) -> DataFrame:
    """conv_id, turn, r, long, next and pairs: how many pairs of a message and one of the next turn.

    Repeats of a turn are counted before the join, so they do not multiply its rows.
    """
    ends = (known.select("conv_id", "turn", "r", (F.size(F.split("text", "\n", -1)) > 1).alias("long"))
            .groupBy("conv_id", "turn", "r", "long").agg(F.count("*").alias("n")))
    after = (ends.groupBy("conv_id", (F.col("turn") - 1).alias("turn"), F.col("r").alias("next"))
             .agg(F.sum("n").alias("m")))
    return ends.join(after, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "r", "long", "next", (F.col("n") * F.coalesce("m", F.lit(1))).alias("pairs"))


def _line_counts(batches):
    for batch in batches:
        out = []
        for r, text in zip(batch.column("r").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for i, line in enumerate(text.split("\n")):
                mark, rest = marker(line)
                out.append((r, i == 0, mark, length_class(rest)))
        cols = list(zip(*out, strict=True)) or [[]] * 4
        kinds = [pa.int32(), pa.bool_(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                         names=["r", "first", "mark", "length"])


def _lines(messages) -> tuple[list[str], list[int | None], list[int]]:
    """(lines, the message's turn, the line's place in its message) of a block's messages."""
    lines, turns, places = [], [], []
    for m in messages:
        for i, line in enumerate((m["text"] or "").split("\n")):
            lines.append(line)
            turns.append(m["turn"])
            places.append(i)
    return lines, turns, places


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text.strip()}\n"


#: Blocks whose last turn heads are searched by one task.
SLICE = 256
#: A block's order is the one of its turns (as far as ``_MOST`` either way, null turns after) and, in so many bits, of its part.
_MOST, _PARTS = 1 << 37, 24
_TALK = ["talk", "copies"]
_PIECE = "talk long, copies long, block long, at int, open boolean, turn long, line int, role string, text string"


def _rows(messages: DataFrame) -> DataFrame:
    """talk, copies, turn, text: no copies in a conversation; equal lone messages are one talk, with their count."""
    message = [F.col("turn").cast("long").alias("turn"), "text"]
    named = messages.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("talk"),
                                                         F.lit(0).cast("long").alias("copies"), *message)
    # numbered after they are written, so that a lost executor cannot change the numbers
    lone = C.cut(messages.where("conv_id is null").select(*message).groupBy("turn", "text").agg(F.count("*").alias("copies")))
    return named.union(lone.select(F.monotonically_increasing_id(), "copies", "turn", "text"))


def _blocks(messages: DataFrame) -> DataFrame:
    """talk, copies, block (their order) and the messages, sorted: ``BLOCK`` at most."""
    turns = F.greatest(F.least(F.floor(F.col("turn") / BLOCK), F.lit(_MOST - 1)), F.lit(-_MOST))
    near = _rows(messages).withColumn("turns", F.when(F.col("turn").isNull(), _MOST).otherwise(turns))
    order = Window.partitionBy(*_TALK, "turns").orderBy("turn", "text")
    block = F.shiftleft("turns", _PARTS) + F.floor((F.row_number().over(order) - 1) / BLOCK)
    return (near.withColumn("block", block).groupBy(*_TALK, "turns", "block")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("messages")).drop("turns"))


def parse(messages: DataFrame, model: Model) -> DataFrame:
    """conv_id, turn and line (where the turn begins), role, text, rendered; one row for each recovered turn.

    ``messages`` has conv_id, turn and text (with or without a speaker marker).
    """
    shared = messages.sparkSession.sparkContext.broadcast(model)
    key = [*_TALK, "block"]
    blocks = C.cut(_blocks(messages))

    def reduced(batches):
        model = shared.value
        for batch in batches:
            first, rest = [], []
            for messages in batch.column("messages"):
                shown = model.shown(_lines(messages.as_py())[0])
                rest.append(model.reduce(shown).tobytes())
                v = model.start + shown[0]
                for e in shown[1:]:
                    v = (v[:, None] + model.step).max(axis=0) + e
                first.append(v.tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in key),
                                              pa.array(first, pa.binary()), pa.array(rest, pa.binary())],
                                             names=[*key, "first", "rest"])

    scores = blocks.mapInArrow(reduced, "talk long, copies long, block long, first binary, rest binary")
    chains = scores.groupBy(*_TALK).agg(F.sort_array(F.collect_list(F.struct("block", "first", "rest"))).alias("chain"))

    def linked(batches):
        model = shared.value
        for batch in batches:
            out = {k: [] for k in (*key, "before", "last", "final")}
            for talk, copies, chain in zip(*(batch.column(c).to_pylist() for c in (*_TALK, "chain")), strict=True):
                n = len(STATES)
                path = model.edges(np.frombuffer(chain[0]["first"]), [np.frombuffer(x["rest"]).reshape(n, n) for x in chain[1:]])
                for x, before, last in zip(chain, [-1, *path], path):  # noqa: B905
                    for k, v in zip(out, (talk, copies, x["block"], before, last, x is chain[-1]), strict=True):
                        out[k].append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))

    ends = chains.mapInArrow(linked, "talk long, copies long, block long, before int, last int, final boolean")
    joined = blocks.join(ends, key).select(*key, "messages", "before", "last", "final")

    def pieces(batches):
        """Turns of a block; open: the lines before its first head (at -1), or a last turn that may go on."""
        model = shared.value
        names = [x.split()[0] for x in _PIECE.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.string(), pa.string()]
        for batch in batches:
            out = {k: [] for k in names}
            for *at, messages, before, last, final in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                lines, of, places = _lines(messages)
                path = model.decode(model.shown(lines), before, last)
                heads = [i for i, s in enumerate(path) if _FIRST[s]]
                for lo, hi in zip([0, *heads], [*heads, len(path)], strict=True):
                    if lo == hi:
                        continue
                    tail = not _FIRST[path[lo]]
                    opened = tail or (hi == len(path) and not final)
                    row = (*at, -1 if tail else lo, opened, of[lo], places[lo], STATES[path[lo]][0], "\n".join(lines[lo:hi]))
                    for k, v in zip(out, row, strict=True):
                        out[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=names)

    only = (F.col("before") < 0) & F.col("final")
    whole = joined.where(only).mapInArrow(pieces, _PIECE)
    parts = C.cut(joined.where(~only).mapInArrow(pieces, _PIECE))
    found = whole.unionByName(parts.where("not open")).select(*_TALK, "turn", "line", "role", "text").unionByName(_put_together(parts.where("open")))

    def rendered(batches):
        for batch in batches:
            text = [x.strip() for x in batch.column("text").to_pylist()]
            full = [render(r, x) for r, x in zip(batch.column("role").to_pylist(), text, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "turn", "line", "role")),
                                              pa.array(text, pa.string()), pa.array(full, pa.string())],
                                             names=["conv_id", "turn", "line", "role", "text", "rendered"])

    conv = F.when(F.col("copies") == 0, F.col("talk")).alias("conv_id")
    each = F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1))))
    return found.select(conv, "turn", "line", "role", "text", each).drop("col").mapInArrow(
        rendered, "conv_id long, turn long, line int, role string, text string, rendered string")


def _put_together(parts: DataFrame) -> DataFrame:
    """Open pieces as turns: lines before a block's first head belong to the last head of an earlier block."""
    cut = F.floor(F.col("block") / (SLICE << _PARTS)).alias("cut")
    heads = (parts.groupBy(*_TALK, "block").agg(F.max(F.when(F.col("at") >= 0, F.col("block"))).alias("head"))
             .select("*", cut))
    near = Window.partitionBy(*_TALK, "cut").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy(*_TALK).orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    earlier = heads.groupBy(*_TALK, "cut").agg(F.max("head").alias("h")).select(*_TALK, "cut", F.max("h").over(far).alias("far"))
    owner = (heads.select(*_TALK, "cut", "block", F.max("head").over(near).alias("near")).join(earlier, [*_TALK, "cut"])
             .select(*_TALK, "block", F.coalesce("near", "far").alias("owner")))
    piece = F.struct("block", "turn", "line", "role", "text")
    return (parts.join(owner, [*_TALK, "block"])
            .withColumn("owner", F.when(F.col("at") < 0, F.col("owner")).otherwise(F.col("block")))
            .groupBy(*_TALK, "owner").agg(F.sort_array(F.collect_list(piece)).alias("p"))
            .select(*_TALK, F.col("p")[0]["turn"].alias("turn"), F.col("p")[0]["line"].alias("line"),
                    F.col("p")[0]["role"].alias("role"), F.array_join(F.col("p.text"), "\n").alias("text")))


def transcripts(conversations: DataFrame) -> DataFrame:
    """Messages as raw transcripts have them: a marker in the conversation's style, missing on some messages."""
    def pick(options: list[str], by: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, options)), by)

    style = F.pmod(F.xxhash64("conv_id"), F.lit(4)).cast("int") + 1
    user = pick(["User: ", "Human: ", "### Instruction:\n", "Q: "], style)
    assistant = pick(["Assistant: ", "AI: ", "### Response:\n", "A: "], style)
    mark = F.when(F.col("role") == "system", F.lit("System: ")).when(F.col("role") == "user", user).when(
        F.col("role") == "assistant", assistant).otherwise(F.lit(""))
    bare = F.pmod(F.xxhash64("conv_id", "turn", F.lit(5)), F.lit(10)) == 0
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role",
        F.concat(F.when(bare, F.lit("")).otherwise(mark), F.coalesce("text", F.lit(""))).alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    messages = transcripts(C.read_documents(spark, sf_dir, "conversations"))
    return parse(messages.drop("role"), learn(messages))
