"""Toxicity by a classifier chain with out-of-fold training.

Categories are predicted one after the other. A text's features are its distinct
words and the beginnings of long words (hashed, lower case, parted by white
space and punctuation); the model of a later category also gets the log-odds of the earlier ones. While training,
those come from models that have not seen the document (``FOLDS`` folds), so a
later model learns from predictions as good as it will get.

Models are fitted on at most ``SAMPLE`` labelled documents, those of least hash
of the id, a documented bound; the folds of a category are fitted side by side
in Spark tasks. All documents are then scored where they lie: the models are a
few arrays of ``FEATURES`` weights at most.

The categories of the query are the two columns of ``labels``: low quality
(quality = 0), then toxic.

Edge cases: a null or empty text has no words and gets the prior odds; labels
without a document or with a null label do not train; a category with labels of
one kind only predicts that kind; with no labels at all nothing is flagged;
repeated rows train and are scored each; null ids pass through; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm import common as C

SAMPLE, FOLDS = 20_000, 5
#: Words are hashed to so many bits; so many of them, the most telling, have a weight.
HASH_BITS, FEATURES = 20, 2048
#: Longer words also count by their first so many bytes, which stand for their stem.
PREFIXES = (6, 8)
RIDGE, THRESHOLD, STEPS = 1.0, 0.5, 200


def text_features(column: pa.Array):
    """(row, hashed word) of the distinct words of each text, slice by slice."""
    for first, data, at in C.text_slices(column):
        start, end, row = C.word_spans(data, at, C.PUNCTUATED)
        ranges = C.RangeHash(C.BYTE_VALUES[C.LOWER[data]])
        hashes, rows = [ranges(start, end)], [row]
        for width in PREFIXES:
            long = end - start > width
            hashes.append(C.mix(ranges(start[long], start[long] + width) + np.uint64(width)))
            rows.append(row[long])
        hashed = np.concatenate(hashes) >> np.uint64(64 - HASH_BITS)
        yield first, len(at) - 1, np.unique((np.concatenate(rows).astype(np.uint64) << np.uint64(HASH_BITS)) | hashed)


def _split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(HASH_BITS)).astype(np.int64), (keys & np.uint64((1 << HASH_BITS) - 1)).astype(np.int64)


def _probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(rows: np.ndarray, words: np.ndarray, extra: np.ndarray, label: np.ndarray,
        features: int = FEATURES, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by damped Newton steps: (word features, their weights, [bias, weights of ``extra``])."""
    n, total = len(label), label.sum()
    prior = np.log((total + 0.5) / (n - total + 0.5))
    if not 0 < total < n:
        return np.zeros(0, np.int64), np.zeros(0), np.append(prior, np.zeros(extra.shape[1]))
    # the most telling words by their chi-square with the label
    have = np.bincount(words, minlength=1 << HASH_BITS).astype(float)
    both = np.bincount(words, weights=label[rows], minlength=1 << HASH_BITS)
    chi = (both * n - have * total) ** 2 / np.maximum(have * (n - have), 1)
    chosen = np.sort(np.argsort(-chi, kind="stable")[: min(features, int((have > 1).sum()))])
    place = np.full(1 << HASH_BITS, -1)
    place[chosen] = np.arange(len(chosen))
    use = place[words] >= 0
    r, c = rows[use], place[words[use]]
    x = np.column_stack([np.ones(n), extra])
    weak = np.append(1e-6, np.full(extra.shape[1], ridge))
    w, v = np.zeros(len(chosen)), np.append(prior, np.zeros(extra.shape[1]))

    def state(w, v):
        odds = np.bincount(r, weights=w[c], minlength=n) + x @ v
        loss = np.sum(np.logaddexp(0, odds) - label * odds) + ridge / 2 * (w @ w) + weak @ (v * v) / 2
        return loss, _probability(odds)

    loss, p = state(w, v)
    rate = 0.5
    for _ in range(STEPS):              # Newton steps by the diagonal for words, exact for bias and extras
        g, h = p - label, p * (1 - p) + 1e-9
        dw = (np.bincount(c, weights=g[r], minlength=len(w)) + ridge * w) / (np.bincount(c, weights=h[r], minlength=len(w)) + ridge)
        dv = np.linalg.solve((x * h[:, None]).T @ x + np.diag(weak), x.T @ g + weak * v)
        tried, q = state(w - rate * dw, v - rate * dv)
        if tried > loss:                # words are correlated: a step that went too far is made shorter
            rate /= 2
            if rate < 1e-4:
                break
            continue
        w, v, p = w - rate * dw, v - rate * dv, q
        if loss - tried < 1e-6 * loss:
            break
        loss, rate = tried, min(1.0, 1.5 * rate)
    return chosen, w, v


def _odds(count: int, rows, words, model, extra) -> np.ndarray:
    weight = np.zeros(1 << HASH_BITS)
    weight[model[0]] = model[1]
    return np.bincount(rows, weights=weight[words], minlength=count) + model[2][0] + extra @ model[2][1:]


def train(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text",
          sample: int = SAMPLE, folds: int = FOLDS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The final model of each category of the chain, in order."""
    spark = docs.sparkSession
    known = labels.select(F.col(f"`{id_col}`").alias("id"), *(F.col(f"`{c}`").cast("double").alias(f"y{n}") for n, c in enumerate(categories)))
    known = known.where(F.col("id").isNotNull()).na.drop().orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = texts.join(F.broadcast(known), "id")                  # at most ``sample`` labels

    def featured(batches):
        for batch in batches:
            lists: list[np.ndarray] = [np.zeros(0, np.int32)] * batch.num_rows
            for first, count, keys in text_features(batch.column(1)):
                row, words = _split(keys)
                edge = np.searchsorted(row, np.arange(count + 1))
                for i in range(count):
                    lists[first + i] = words[edge[i]: edge[i + 1]].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in lists], pa.binary()),
                                              *batch.columns[2:]], names=["id", "words", *batch.schema.names[2:]])

    ys = [f"y{n}" for n in range(len(categories))]
    sampled = C.cut(rows.select("id", "text", *ys).mapInArrow(
        featured, "id long, words binary, " + ", ".join(f"{y} double" for y in ys)))
    fold = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(folds)).cast("int")
    models: list[tuple] = []
    by_fold: list[dict[int, tuple]] = []

    def matrix(table):
        blobs = [np.frombuffer(x.as_buffer(), np.int32) for x in table.column("words")]
        words = np.concatenate([*blobs, np.zeros(0, np.int32)]).astype(np.int64)
        return np.repeat(np.arange(len(blobs)), [len(b) for b in blobs]), words

    def earlier(table, rows, words):
        """Out-of-fold log-odds of the earlier categories."""
        own = table.column("fold").to_numpy()
        extra = np.zeros((table.num_rows, len(by_fold)))
        for j, fitted in enumerate(by_fold):
            for f in np.unique(own):
                mine = own == f
                extra[mine, j] = _odds(table.num_rows, rows, words, fitted[f], extra[:, :j])[mine]
        return extra

    for n in range(len(categories)):
        # task f fits without fold f; the last task, without any fold left out, is the final model
        tasks = F.explode(F.sequence(F.lit(0), F.lit(folds)))
        dealt = sampled.withColumn("fold", fold).withColumn("task", tasks).where("task <> fold")

        def fit_task(key, table):  # used up within this turn of the loop
            table = table.sort_by("id")
            rows, words = matrix(table)
            label = table.column(f"y{n}").to_numpy()  # noqa: B023
            chosen, w, v = fit(rows, words, earlier(table, rows, words), label)
            return pa.table({"task": [key[0].as_py()], "at": [chosen.astype(np.int64).tobytes()],
                             "w": [w.tobytes()], "v": [v.tobytes()]},
                            schema=pa.schema([("task", pa.int32()), ("at", pa.binary()), ("w", pa.binary()), ("v", pa.binary())]))

        got = {r["task"]: (np.frombuffer(r["at"], np.int64), np.frombuffer(r["w"]), np.frombuffer(r["v"]))
               for r in dealt.groupBy("task").applyInArrow(fit_task, "task int, at binary, w binary, v binary").collect()}
        empty = (np.zeros(0, np.int64), np.zeros(0), np.append(-10.0, np.zeros(n)))
        by_fold.append({f: got.get(f, empty) for f in range(folds)})
        models.append(got.get(folds, empty))
    return models


def score(docs: DataFrame, models: list[tuple], categories: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the probability of each category of the chain, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(models)    # a few arrays of FEATURES numbers
    names = ["doc_id", *(f"p_{c}" for c in categories)]
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, len(shared.value)))
            for first, count, keys in text_features(batch.column(1)):
                rows, words = _split(keys)
                odds = np.zeros((count, 0))
                for model in shared.value:
                    odds = np.column_stack([odds, _odds(count, rows, words, model, odds)])
                out[first: first + count] = _probability(odds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in out.T)], names=names)

    return slim.mapInArrow(run, ", ".join([f"{names[0]} long", *(f"{x} double" for x in names[1:])]))


def toxic_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, p_low_quality, p_toxic, toxic) of every document."""
    categories = ["low_quality", "toxic"]
    known = labels.select(F.col(f"`{id_col}`"), (F.col("quality") == 0).cast("int").alias("low_quality"), "toxic")
    models = train(docs, known, categories, id_col, text_col)
    return score(docs, models, categories, id_col, text_col).withColumn("toxic", F.col("p_toxic") >= threshold)


def query(spark, sf_dir: str) -> DataFrame:
    """The documents found toxic, with their probabilities."""
    return toxic_documents(C.read_documents(spark, sf_dir), C.read_documents(spark, sf_dir, "labels")).where("toxic")
