"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]), which is all
pairwise interactions in linear time. Words are hashed into BUCKETS features that hold their share of
the text; statistics of the structure (case, signs, repeats, lines, lengths) and the metadata that the
table gives about the text itself (n_chars) follow, in fixed steps, as one active feature each. Labels,
language, source and doc_id are not features.

Training uses at most TRAIN_ROWS labelled rows, drawn by a hash of the id, the same ones in every run; it
takes place in numpy on the driver with a fixed seed. Scoring streams over whole texts.

Nulls: a null text is empty and gets a score from its structure alone; a null label is no label; a null
n_chars is a step of its own. Very long texts are read whole, in pieces of words. Repeated rows are scored alike; several labels of one id are all used.
An empty table gives an empty result; without labels the score is the prior 0.5. Extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm import common

BITS = 13
BUCKETS = 1 << BITS
FACTORS = 6
STEPS = 24
#: Labelled rows of each class that a model is fitted on, at most.
TRAIN_ROWS = 6_000
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.05, 1e-5
THRESHOLD = 0.3
FOLDS = 5

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in "#*$%&|<>"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?"]] = True
#: Statistics of structure(), in order, with the value that falls into the last step.
SCALES = (1.0, 1.0, 0.4, 0.4, 0.4, 1.0, 1.0, 1.0, 12.0, 16.0, 14.0, 1.0, 1.0)
STATS = len(SCALES) + 1
SIZE = BUCKETS + STATS * STEPS


def structure(text: bytes, words: np.ndarray) -> list[float]:
    """Shares of capitals, repeats, signs, stops and digits, and logarithms of lengths."""
    data = np.frombuffer(text, np.uint8)
    n, m = max(1, len(data)), max(1, len(words))
    letters = max(1, int(_LETTER[data].sum()))
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = words[1:] ^ (words[:-1] * np.uint64(3)) if len(words) > 1 else words[:0]
    kinds, counts = np.unique(words, return_counts=True)
    return [
        int(_UPPER[data].sum()) / letters,
        1 - len(kinds) / m,
        int(_SIGN[data].sum()) / n,
        int(_STOP[data].sum()) / n,
        int(_DIGIT[data].sum()) / n,
        1 - len(np.unique(pairs)) / max(1, len(pairs)) if len(pairs) else 0.0,
        float((words[1:] == words[:-1]).mean()) if len(words) > 1 else 0.0,
        1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(len(words))),
        n / m,
        float(np.log1p(n / max(1, len(lines)))),
        int(counts.max()) / m if len(counts) else 0.0,
        text.count(b"!") / m,
    ]


def features(text: bytes, words: np.ndarray, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Active features and their values: hashed words with shares of the text (unit length), and one step of each statistic."""
    bucket, count = np.unique((words >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    value = count / np.sqrt(max(1.0, float((count.astype(float) ** 2).sum())))
    stats = np.minimum(np.array(structure(text, words)) / SCALES, 1.0)
    step = np.minimum((stats * (STEPS - 1)).astype(np.int64), STEPS - 2)
    meta = STEPS - 1 if n_chars is None else min(STEPS - 2, int(np.log1p(max(0, n_chars)) * 1.5))
    step = np.append(step, meta)
    at = BUCKETS + np.arange(STATS) * STEPS + step
    return np.concatenate([bucket, at]), np.concatenate([value, np.full(STATS, 0.5)])


class Machine:
    """Weights of a factorisation machine; rows are given as concatenated features with their row numbers."""

    def __init__(self, size: int = SIZE, factors: int = FACTORS, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.bias, self.w = 0.0, np.zeros(size)
        self.v = rng.normal(0, 0.02, (size, factors))

    def raw(self, at: np.ndarray, x: np.ndarray, starts: np.ndarray):
        """Scores before the sigmoid, and the factor sums. starts: where each row's features begin; no row is empty."""
        vx = self.v[at] * x[:, None]
        total = np.add.reduceat(vx, starts)
        pairs = 0.5 * ((total**2).sum(1) - np.add.reduceat((vx**2).sum(1), starts))
        return self.bias + np.add.reduceat(self.w[at] * x, starts) + pairs, total

    def score(self, at, x, starts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(at, x, starts)[0], -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 0) -> Machine:
        """Adagrad on the logistic loss, both classes with the same total weight up to a factor of four."""
        if not len(rows):
            return self
        rng = np.random.default_rng(seed)
        positive = labels.mean()
        self.bias = float(np.log((positive + 0.01) / (1 - positive + 0.01)))
        weight = np.where(labels > 0, 1.0, min(4.0, max(1.0, positive / max(1e-9, 1 - positive))))
        gw, gv, gb = np.full(self.w.shape, 1e-2), np.full(self.v.shape, 1e-2), 1e-2
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for i in range(0, len(order), BATCH):
                pick = order[i : i + BATCH]
                at = np.concatenate([rows[k][0] for k in pick])
                x = np.concatenate([rows[k][1] for k in pick])
                n = np.array([len(rows[k][0]) for k in pick])
                starts = np.cumsum(n) - n
                raw, total = self.raw(at, x, starts)
                wrong = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[pick]) * weight[pick] / len(pick)
                each = np.repeat(wrong, n) * x
                slot, inverse = np.unique(at, return_inverse=True)
                dw = np.bincount(inverse, each) + DECAY * self.w[slot]
                whole = np.repeat(total, n, axis=0) - self.v[at] * x[:, None]
                dv = np.stack([np.bincount(inverse, each * whole[:, f]) for f in range(self.v.shape[1])], 1) + DECAY * self.v[slot]
                gw[slot] += dw**2
                gv[slot] += dv**2
                gb += wrong.sum() ** 2
                self.w[slot] -= RATE * dw / np.sqrt(gw[slot])
                self.v[slot] -= RATE * dv / np.sqrt(gv[slot])
                self.bias -= RATE * wrong.sum() / np.sqrt(gb)
        return self


def _rows(batch):
    texts = common.byte_rows(batch.column(1))
    chars = batch.column(2).to_pylist()
    out: list = [None] * len(texts)
    for i, text in enumerate(texts):
        out[i] = features(text, common.words(text), chars[i])
    return out


def _inputs(docs: DataFrame) -> DataFrame:
    chars = F.col("n_chars").cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), chars.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, train_rows: int = TRAIN_ROWS, seed: int = 0) -> Machine:
    """Fit a machine on labelled rows outside fold 0, at most train_rows of each class."""
    common.tune(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y")).filter((common.fold("doc_id", folds) != 0) & F.col("y").isin(0, 1)).distinct()
    order = F.xxhash64(F.lit(17), "doc_id")
    # At most two times train_rows small rows, so they may be broadcast.
    picked = [known.filter(F.col("y") == y).orderBy(order, "doc_id").limit(train_rows) for y in (0, 1)]
    drawn = F.broadcast(picked[0].unionByName(picked[1]))

    def run(batches):
        for batch in batches:
            found = _rows(batch)
            yield pa.record_batch([batch.column(3), pa.array([a.astype(np.int32) for a, _ in found], pa.list_(pa.int32())), pa.array([x.astype(np.float32) for _, x in found], pa.list_(pa.float32())), batch.column(0)], names=["y", "at", "x", "doc_id"])

    rows = _inputs(docs).join(drawn, "doc_id").select("doc_id", "text", "n_chars", "y").mapInArrow(run, "y int, at array<int>, x array<float>, doc_id bigint").toArrow()
    data = sorted(zip(rows["doc_id"].to_pylist(), rows["y"].to_pylist(), range(len(rows))))
    at, x = rows["at"].combine_chunks(), rows["x"].combine_chunks()
    pick = [(at[i].values.to_numpy().astype(np.int64), x[i].values.to_numpy().astype(float)) for _, _, i in data]
    return Machine(seed=seed).fit(pick, np.array([y for _, y, _ in data], float), seed=seed)


def score(docs: DataFrame, machine: Machine, folds: int = FOLDS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    common.tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # its size is fixed by BUCKETS and FACTORS

    def run(batches):
        for batch in batches:
            found = _rows(batch)
            out = np.zeros(0)
            if found:
                n = np.array([len(a) for a, _ in found])
                out = shared.value.score(np.concatenate([a for a, _ in found]), np.concatenate([x for _, x in found]), np.cumsum(n) - n)
            yield pa.record_batch([batch.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])

    scored = _inputs(docs).mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", F.coalesce(common.fold("doc_id", folds) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return score(docs, train(docs, common.read(spark, sf_dir, "labels")))


def accepted(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, that score at least the threshold."""
    common.tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    names = docs.columns
    at = [names.index("text"), names.index("n_chars") if "n_chars" in names else None]

    def run(batches):
        for batch in batches:
            chars = pa.nulls(len(batch), pa.int64()) if at[1] is None else batch.column(at[1])
            found = _rows(pa.record_batch([chars, batch.column(at[0]), chars], names=["a", "b", "c"]))
            if found:
                n = np.array([len(a) for a, _ in found])
                good = shared.value.score(np.concatenate([a for a, _ in found]), np.concatenate([x for _, x in found]), np.cumsum(n) - n) >= threshold
                yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
