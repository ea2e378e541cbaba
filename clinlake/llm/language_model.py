"""Language-model scoring with a log-bilinear model trained in numpy by noise-contrastive estimation.

Words are lower-cased (A-Z); every text ends with one end token, the empty word. Exact counts of all
training words are kept in a table of the shared folder. A word that makes up at least one in FREQUENT of the
training tokens has a context vector, a target vector and a bias of its own, so there are FREQUENT such words
at most, at any size of the data. All other words, seen or not, fall into SUFFIX rows by their last three
bytes; a row has vectors too, and a word its smoothed share of the row's counts, with one share for unseen words.

The score of a word after another is the product of the other's context vector and its own target vector, plus
its bias; its probability is normalised over all rows. The normalisers of all contexts are batched matrix
products, made once, in parallel, and broadcast as one number for each row.

Training texts are dealt into groups by a hash, so that a group's tokens, and their order, do not depend on the
partitions of the table. Each group trains on all its texts, once, from the same start, by noise-contrastive
estimation; then every row becomes the mean over the groups, weighted by how often each has met the row. The number of
groups grows with the tokens.

Every text is cut into words once; its rows (4 bytes for each token) are written to the shared folder,
and training and scoring read them from there. Words outside the broadcast lexicon are joined with the table
of counts, in which none of them is common, so that no key is hot.

Nulls: a null text is empty (one token); a text with a null doc_id is not trained on and not held out.
Repeated rows are counted and scored each. Very long texts are cut into words whole. An empty table gives an empty
result. Extra columns are left out, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm import common

FOLDS, HELD_OUT = 7, 2
#: Words in the lexicon, and the share of the tokens (one in FREQUENT) that gives a word vectors of its own.
FREQUENT = 200_000
SUFFIX = 1_024
WIDTH = 16
BATCH, NOISE, RATE = 4_096, 128, 0.05
#: Tokens of a group, and tokens that are put into random order together.
GROUP_TOKENS, CHUNK = 4_000_000, 200_000
#: Rows whose parameters are averaged in one piece, and contexts that are normalised together.
PIECE_ROWS, BLOCK = 4_096, 128
#: Words that a task counts before it hands them on.
COUNTED = 300_000
END = b""


def suffix_row(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SUFFIX


class Lexicon:
    """Frequent words with their counts, the most frequent first. Rows of the model: suffixes, the end, words of their own."""

    def __init__(self, words: list[bytes], counts: list[int], tokens: int, share: int = FREQUENT):
        self.words, self.at = words, {w: i for i, w in enumerate(words)}
        self.own = 1 + sum(c * share >= tokens for c in counts[1:])
        self.log = np.log10(np.array(counts, float) + 1)
        self.row = np.array([SUFFIX + i if i < self.own else suffix_row(w) for i, w in enumerate(words)], np.int32)
        self.known = np.array([c > 0 for c in counts], bool)

    @property
    def rows(self) -> int:
        return SUFFIX + self.own


def tokens(text: bytes) -> list[bytes]:
    words = text.lower().split()
    words.append(END)
    return words


def indexed(words: list[bytes], lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Places in the lexicon (-1: none), rows of the model, and the words without a place."""
    at = np.fromiter(map(lexicon.at.get, words, repeat(-1)), np.int64, len(words))
    row = lexicon.row[at]
    missing = np.flatnonzero(at < 0)
    rare = [words[i] for i in missing]
    if rare:
        row[missing] = [suffix_row(w) for w in rare]
    return at, row, rare


class Model:
    """Parameters of the log-bilinear model: a context vector, a target vector and a bias for each row."""

    def __init__(self, total: np.ndarray, seed: int = 0):
        rng = np.random.default_rng(seed)
        shape = (len(total), WIDTH)
        self.context = rng.normal(0, 0.1, shape).astype(np.float32)
        self.target = rng.normal(0, 0.1, shape).astype(np.float32)
        self.bias = np.log((total + 1) / (total + 1).sum()).astype(np.float32)

    def log_norm(self, rows: np.ndarray) -> np.ndarray:
        """log of the normaliser after each of these contexts, by batched matrix products."""
        out = np.empty(len(rows))
        for at in range(0, len(rows), BLOCK):
            s = self.context[rows[at : at + BLOCK]] @ self.target.T
            s += self.bias
            top = s.max(1, keepdims=True)
            s -= top
            np.exp(s, out=s)
            out[at : at + BLOCK] = top[:, 0] + np.log(s.sum(1, dtype=np.float64))
        return out

    def log_prob(self, rows: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """log10 of the probability of each row in a sequence, given the one before it."""
        before = contexts(rows)
        return (np.einsum("ij,ij->i", self.context[before], self.target[rows]) + self.bias[rows] - norm[before]) / np.log(10)


def contexts(rows: np.ndarray) -> np.ndarray:
    """The row before each; before the text stands the end of another."""
    return np.concatenate([[SUFFIX], rows[:-1]]).astype(rows.dtype)


class Trainer:
    """Noise-contrastive estimation with Adagrad. The noise of a batch is drawn by the unigram counts and shared by its words."""

    def __init__(self, model: Model, total: np.ndarray, seed: int):
        self.m, self.rng = model, np.random.default_rng(seed)
        share = (total + 1) / (total + 1).sum()
        self.cum = np.cumsum(share)
        self.shift = np.log(NOISE * share).astype(np.float32)
        self.sums = {k: np.full(getattr(model, k).shape, 0.1, np.float32) for k in ("context", "target", "bias")}
        self.met = np.zeros((2, len(total)), np.int64)

    def _step(self, name: str, rows: np.ndarray, grad: np.ndarray) -> None:
        """Add up the gradients of equal rows and go one step."""
        order = np.argsort(rows, kind="stable")
        sorted_ = rows[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        grad, rows = np.add.reduceat(grad[order], first), sorted_[first]
        sums = self.sums[name][rows] + grad**2
        self.sums[name][rows] = sums
        getattr(self.m, name)[rows] -= RATE * grad / np.sqrt(sums)

    def batch(self, c: np.ndarray, t: np.ndarray) -> None:
        m = self.m
        h, r = m.context[c], m.target[t]
        noise = np.minimum(np.searchsorted(self.cum, self.rng.random(NOISE)), len(self.cum) - 1)
        rn = m.target[noise]
        good = 1 / (1 + np.exp(-(np.einsum("ij,ij->i", h, r) + m.bias[t] - self.shift[t]))) - 1
        bad = 1 / (1 + np.exp(-(h @ rn.T + (m.bias[noise] - self.shift[noise]))))
        dh = good[:, None] * r + bad @ rn
        targets = np.concatenate([t, noise])
        self._step("target", targets, np.concatenate([good[:, None] * h, bad.T @ h]))
        self._step("bias", targets, np.concatenate([good, bad.sum(0)]))
        self._step("context", c, dh)

    def train(self, sequences: list[np.ndarray]) -> None:
        """All words of some texts, in random order."""
        if not sequences:
            return
        c, t = np.concatenate([contexts(s) for s in sequences]), np.concatenate(sequences)
        for side, rows in enumerate((c, t)):
            self.met[side] += np.bincount(rows, minlength=self.met.shape[1])
        order = self.rng.permutation(len(t))
        for i in range(0, len(order), BATCH):
            pick = order[i : i + BATCH]
            self.batch(c[pick], t[pick])


def _text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _training(docs: DataFrame, folds: int, held_out: int) -> DataFrame:
    return _text(docs).filter(common.fold("doc_id", folds) != held_out)


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c) of all training tokens; tasks count in memory, up to COUNTED words at a time."""

    def run(batches):
        held: Counter = Counter()
        give = lambda: pa.record_batch([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])
        for batch in batches:
            for text in common.byte_rows(batch.column(1)):
                held.update(tokens(text))
                if len(held) > COUNTED:
                    yield give()
                    held.clear()
        yield give()

    return train.mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, tokens: int, most: int = FREQUENT) -> Lexicon:
    rows = counts.filter(F.col("word") != F.lit(END)).orderBy(F.desc("c"), "word").limit(most).toArrow()
    ends = counts.filter(F.col("word") == F.lit(END)).toArrow()["c"].to_pylist()
    return Lexicon([END, *rows["word"].to_pylist()], [sum(ends), *rows["c"].to_pylist()], tokens, most)


def row_totals(counts: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each row. Words of their own are told by their counts, which all words of a row of suffixes are below."""
    total, kinds = np.zeros(lexicon.rows), np.zeros(lexicon.rows)
    total[SUFFIX:] = np.round(10 ** lexicon.log[: lexicon.own] - 1)
    kinds[SUFFIX:] = lexicon.known[: lexicon.own]
    own = counts.sparkSession.sparkContext.broadcast(frozenset(lexicon.words[: lexicon.own]))  # FREQUENT words at most

    def run(batches):
        c, n = np.zeros(SUFFIX, np.int64), np.zeros(SUFFIX, np.int64)
        for batch in batches:
            for word, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word not in own.value:
                    at = suffix_row(word)
                    c[at] += k
                    n[at] += 1
        yield pa.record_batch([pa.array(np.arange(SUFFIX)), pa.array(c), pa.array(n)], names=["at", "c", "n"])

    for r in counts.select("word", "c").mapInArrow(run, "at bigint, c bigint, n bigint").groupBy("at").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).collect():
        total[r["at"]], kinds[r["at"]] = r.c, r.n
    return total, kinds


def sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, "<i4") for b in column.to_pylist()]


def train_model(texts: DataFrame, total: np.ndarray, tokens: int, seed: int = 0) -> Model:
    """A model trained on the rows of all texts of a table (key, seq)."""
    spark = texts.sparkSession
    model = Model(total, seed)
    groups = max(1, math.ceil(tokens / GROUP_TOKENS))
    counts = spark.sparkContext.broadcast(total)  # one number for each row
    size = len(total)

    def run(batches):
        trainer, now, held, chars = None, None, [], 0

        def pieces():
            context, target = trainer.m.context, np.column_stack([trainer.m.target, trainer.m.bias])
            for at in range(0, size, PIECE_ROWS):
                cut = slice(at, at + PIECE_ROWS)
                yield pa.record_batch([pa.array([at // PIECE_ROWS], pa.int32()), pa.array([now], pa.int32()), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (trainer.met[:, cut].astype("<i8"), context[cut], target[cut].astype(np.float32)))], names=["piece", "g", "met", "context", "target"])

        for batch in batches:
            for g, seq in zip(batch.column(0).to_pylist(), sequences(batch.column(1))):
                if g != now:
                    if trainer is not None:
                        trainer.train(held)
                        yield from pieces()
                    trainer, now, held, chars = Trainer(Model(counts.value, seed), counts.value, seed + 1 + g), g, [], 0
                held.append(seq)
                chars += len(seq)
                if chars >= CHUNK:
                    trainer.train(held)
                    held, chars = [], 0
        if trainer is not None:
            trainer.train(held)
            yield from pieces()

    def mean(batches):
        """Rows as means over the groups, in the order of the groups, weighted by how often each has met the row."""
        held: dict[int, list] = {}
        for batch in batches:
            for piece, met, context, target in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4))):
                w = np.frombuffer(met, "<i8").reshape(2, -1).astype(float)
                c, t = np.frombuffer(context, "<f4").reshape(-1, WIDTH), np.frombuffer(target, "<f4").reshape(-1, WIDTH + 1)
                # Noise moves targets that a group has not met; they count as one meeting.
                w[1] += 1
                mine = [w, c * w[0][:, None], t * w[1][:, None]]
                held[piece] = mine if piece not in held else [a + b for a, b in zip(held[piece], mine)]
        rows = [(p, (c / np.maximum(w[0], 1)[:, None]).astype("<f4"), w[0] > 0, (t / w[1][:, None]).astype("<f4")) for p, (w, c, t) in held.items()]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in (1, 2, 3))], names=["piece", "context", "seen", "target"])

    dealt = texts.select(F.pmod(F.xxhash64("key", "seq"), F.lit(groups)).cast("int").alias("g"), "seq", "key").repartitionById(groups, F.col("g")).sortWithinPartitions("g", "key", F.xxhash64("seq")).select("g", "seq")
    parts = dealt.mapInArrow(run, "piece int, g int, met binary, context binary, target binary")
    means = parts.repartition(max(1, size // PIECE_ROWS), "piece").sortWithinPartitions("piece", "g").mapInArrow(mean, "piece int, context binary, seen binary, target binary")
    for r in means.collect():  # FREQUENT rows at most
        at = slice(r.piece * PIECE_ROWS, min(size, (r.piece + 1) * PIECE_ROWS))
        seen, target = np.frombuffer(r.seen, bool), np.frombuffer(r.target, "<f4").reshape(-1, WIDTH + 1)
        model.context[at] = np.where(seen[:, None], np.frombuffer(r.context, "<f4").reshape(-1, WIDTH), model.context[at])
        model.target[at], model.bias[at] = target[:, :WIDTH], target[:, WIDTH]
    return model


def normalisers(spark, model: Model) -> np.ndarray:
    """log_norm of every row, in parallel."""
    net, size = spark.sparkContext.broadcast(model), len(model.bias)  # FREQUENT rows at most
    step = 8 * BLOCK

    def run(batches):
        for batch in batches:
            for at in batch.column(0).to_pylist():
                yield pa.record_batch([pa.array([at]), pa.array([net.value.log_norm(np.arange(at, min(size, at + step))).tobytes()], pa.binary())], names=["at", "norm"])

    out = np.empty(size)
    blocks = spark.range(0, size, step, max(1, min(size // step, 4 * spark.sparkContext.defaultParallelism)))
    for r in blocks.mapInArrow(run, "at bigint, norm binary").collect():
        part = np.frombuffer(r.norm)
        out[r["at"] : r["at"] + len(part)] = part
    return out


PARTS = "doc_id bigint, n_tokens bigint, n_known bigint, logs double, seq binary, rare array<binary>, rare_n array<int>"


def read_texts(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """What a text gives without the counts of its rare words; the rows of its tokens; and these words."""
    words = docs.sparkSession.sparkContext.broadcast(lexicon)  # FREQUENT words at most

    def run(batches):
        lex = words.value
        for batch in batches:
            out = []
            for text in common.byte_rows(batch.column(1)):
                found = tokens(text)
                at, seq, rare = indexed(found, lex)
                many = Counter(rare)
                known = at[at >= 0]
                out.append((len(found), int(lex.known[known].sum()), float(lex.log[known].sum()), seq.astype("<i4").tobytes(), list(many), list(many.values())))
            n, k, logs, seq, rare, rare_n = zip(*out) if out else ((),) * 6
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(logs, pa.float64()), pa.array(seq, pa.binary()), pa.array(rare, pa.list_(pa.binary())), pa.array(rare_n, pa.list_(pa.int32()))], names=["doc_id", "n_tokens", "n_known", "logs", "seq", "rare", "rare_n"])

    return _text(docs).mapInArrow(run, PARTS)


SCORED = "uid bigint, doc_id bigint, n_tokens bigint, n_known bigint, logs double, net double"


def net_scores(parts: DataFrame, model: Model, norm: np.ndarray, total: np.ndarray, kinds: np.ndarray, lexicon: Lexicon) -> DataFrame:
    """The texts with log10 of the probability of their rows, and of an even share in each row of suffixes.

    A word of its own is its row; other words share theirs, by (count + 1) / (tokens + words + 1).
    """
    size = np.log10(total + kinds + 1)
    size[SUFFIX:] = lexicon.log[: lexicon.own]  # cancels the word's own count
    shared = parts.sparkSession.sparkContext.broadcast((model, norm, size))  # FREQUENT rows at most

    def run(batches):
        net, z, log_size = shared.value
        for batch in batches:
            value = [float(net.log_prob(s, z).sum() - log_size[s].sum()) for s in sequences(batch.column(5))]
            yield pa.record_batch([*batch.columns[:5], pa.array(value, pa.float64())], names=["uid", "doc_id", "n_tokens", "n_known", "logs", "net"])

    return parts.select("uid", "doc_id", "n_tokens", "n_known", "logs", "seq").mapInArrow(run, SCORED)


def score(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, most: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    common.tune(docs.sparkSession)
    train = _training(docs, folds, held_out)
    counts = common.materialize(word_counts(train), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    lexicon = frequent(counts, n, most)
    total, kinds = row_totals(counts, lexicon)
    parts = common.materialize(read_texts(docs, lexicon).withColumn("uid", F.monotonically_increasing_id()), "rows")
    model = train_model(parts.filter(common.fold("doc_id", folds) != held_out).select(F.col("doc_id").alias("key"), "seq"), total, n)
    norm = normalisers(docs.sparkSession, model)
    rare = parts.select("uid", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select("uid", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("k"))
    found = rare.join(counts, "word").groupBy("uid").agg(F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("more_logs"))
    rows = net_scores(parts, model, norm, total, kinds, lexicon).join(found, "uid", "left")
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    return rows.select(
        "doc_id",
        F.coalesce(common.fold("doc_id", folds) == held_out, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (logs + F.col("net")).alias("score"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return score(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
