"""Exact deduplication with a log-structured merge index.

Every task fills a memtable of normalised-text digests, which flushes as a sorted run. A run is cut into one
sorted slice for each shard of the index, and slices travel whole, so a group of copies arrives with one entry
per flush, however large it is. A shard takes its runs into levels: each run has a Bloom filter, FANOUT runs of
a level are merged into one of the next, and the smallest (or largest) identifier and the number of rows stay
for each digest. In a merge the filters tell which entries no other run can hold; only the others are grouped.

Digests with more than one row are hits. Texts whose digest the filter of the hits does not hold need no byte
verification; the others are compared byte for byte, and where a digest covers different texts, these rows are
grouped by the text itself.

Nulls: a null text is empty; a null doc_id sorts below all. Repeated rows: one of equal rows stays. Very long
texts are hashed and compared whole. An empty table gives an empty result. Extra columns are left out by
exact_dedup() and pass through kept_documents().
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.llm import common

MEMTABLE = 50_000
FANOUT = 4
#: Digests in one shard of the index; the number of shards grows with the rows.
SHARD_ROWS = 500_000
#: Bytes of text that a task remembers for the local part of the byte check.
SEEN_BYTES = 64 << 20

ENTRY = pa.schema([("digest", pa.binary()), ("has_id", pa.bool_()), ("doc_id", pa.int64()), ("uid", pa.int64()), ("n", pa.int64())])
ENTRY_SQL = "digest binary, has_id boolean, doc_id bigint, uid bigint, n bigint"
SLICE_SQL = "shard int, entries binary"


def entry_type(width: int) -> np.dtype:
    return np.dtype([("digest", f"S{width}"), ("has_id", "?"), ("doc_id", "<i8"), ("uid", "<i8"), ("n", "<i8")])


def _halves(digests: np.ndarray) -> np.ndarray:
    """Digests as rows of two numbers, as common.halves() makes them."""
    raw = np.ascontiguousarray(digests).view(np.uint8).reshape(len(digests), -1)[:, :16]
    out = np.zeros((len(digests), 16), np.uint8)
    out[:, : raw.shape[1]] = raw
    return out.view(np.uint64)


class Run:
    """Entries sorted by digest, one for each, and their filter."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.bloom = common.Bloom(10 * len(rows))
        if len(rows):
            self.bloom.add(_halves(rows["digest"]))

    def __len__(self):
        return len(self.rows)


def merge_runs(runs: list[Run], smallest: bool) -> Run:
    """Merge sorted runs: one entry for each digest, with the best identifier and the sum of counts."""
    parts, shared = [], []
    for at, run in enumerate(runs):
        may = np.zeros(len(run), bool)
        for other in (r for n, r in enumerate(runs) if n != at):
            may |= other.bloom.may_hold(_halves(run.rows["digest"]))
        parts.append(run.rows[~may])  # no other run holds these
        shared.append(run.rows[may])
    rows = np.concatenate(shared)
    if len(rows):
        sign = 1 if smallest else -1
        order = np.lexsort((sign * rows["uid"], sign * rows["doc_id"], ~rows["has_id"], rows["digest"]))
        rows = rows[order]
        first = np.flatnonzero(np.concatenate([[True], rows["digest"][1:] != rows["digest"][:-1]]))
        best = rows[first]
        best["n"] = np.add.reduceat(rows["n"], first)
        parts.append(best)
    whole = np.concatenate(parts)
    # The parts are sorted, so a stable sort merges them.
    return Run(whole[np.argsort(whole["digest"], kind="stable")])


class DigestIndex:
    """A log-structured merge index from digest to (identifier that stays, number of rows)."""

    def __init__(self, width: int, smallest: bool = True, memtable: int = MEMTABLE, fanout: int = FANOUT):
        self.width, self.smallest, self.limit, self.fanout = width, smallest, memtable, fanout
        self.memtable: dict[bytes, tuple] = {}
        self.levels: list[list[Run]] = []

    def _better(self, a: tuple, b: tuple) -> tuple:
        if a[0] != b[0]:
            return a if a[0] else b
        return min(a, b) if self.smallest else max(a, b)

    def put(self, digest: bytes, has_id: bool, doc_id: int, uid: int, n: int = 1) -> Run | None:
        """Take an entry into the memtable; a full one comes out as a run."""
        new = (has_id, doc_id, uid)
        old = self.memtable.get(digest)
        self.memtable[digest] = (new, n) if old is None else (self._better(old[0], new), old[1] + n)
        return self.frozen() if len(self.memtable) >= self.limit else None

    def add(self, digest: bytes, has_id: bool, doc_id: int, uid: int, n: int = 1) -> None:
        if (run := self.put(digest, has_id, doc_id, uid, n)) is not None:
            self.add_run(run)

    def frozen(self) -> Run | None:
        """The memtable as a run; the memtable is then empty."""
        if not self.memtable:
            return None
        rows = [(k, *who, n) for k, (who, n) in sorted(self.memtable.items())]
        self.memtable = {}
        return Run(np.array(rows, entry_type(self.width)))

    def add_run(self, run: Run | None) -> None:
        """Take a sorted run into the first level; full levels are merged into the next."""
        level = 0
        while run is not None:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            run = None
            if len(self.levels[level]) >= self.fanout:
                run = merge_runs(self.levels[level], self.smallest)
                self.levels[level] = []
                level += 1

    def get(self, digest: bytes) -> tuple[int | None, int, int] | None:
        """(doc_id, uid, rows) of a digest, through the filters of the runs."""
        found = [self.memtable[digest]] if digest in self.memtable else []
        key = np.array([digest], f"S{self.width}")
        for run in (r for level in self.levels for r in level):
            if run.bloom.may_hold(_halves(key))[0]:
                at = int(np.searchsorted(run.rows["digest"], key[0]))
                if at < len(run) and run.rows["digest"][at] == key[0]:
                    row = run.rows[at]
                    found.append(((bool(row["has_id"]), int(row["doc_id"]), int(row["uid"])), int(row["n"])))
        if not found:
            return None
        who, n = found[0]
        for other, m in found[1:]:
            who, n = self._better(who, other), n + m
        return (who[1] if who[0] else None, who[2], n)

    def compact(self) -> Run | None:
        """Everything as one run."""
        self.add_run(self.frozen())
        runs = [r for level in self.levels for r in level]
        if not runs:
            return None
        out = merge_runs(runs, self.smallest)
        self.levels = [[out]]
        return out


def _hits(run: Run, width: int) -> pa.RecordBatch:
    """The entries with more than one row."""
    rows = run.rows[run.rows["n"] > 1]
    raw = np.ascontiguousarray(rows["digest"]).tobytes()
    digest = pa.array([raw[i : i + width] for i in range(0, len(raw), width)], pa.binary())
    return pa.record_batch([digest, *(pa.array(np.ascontiguousarray(rows[k])) for k in ("has_id", "doc_id", "uid", "n"))], schema=ENTRY)


def _slices(run: Run, shards: int) -> pa.RecordBatch:
    """A run cut by the leading bits of the digests: one sorted slice for each shard."""
    which = (_halves(run.rows["digest"])[:, 0].byteswap() >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
    at = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
    ends = [*at[1:].tolist(), len(run)]
    return pa.record_batch([pa.array(which[at].astype(np.int32)), pa.array([run.rows[a:b].tobytes() for a, b in zip(at.tolist(), ends)], pa.binary())], names=["shard", "entries"])


def _fingerprint(batches):
    for batch in batches:
        texts = [t.lower() for t in common.byte_rows(batch.column(1))]
        yield pa.record_batch([batch.column(0), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())], names=["doc_id", "sha"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, sha, uid) of every row, kept in the shared folder. uid tells equal rows apart."""
    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_fingerprint, "doc_id bigint, sha binary")
    return common.materialize(out.withColumn("uid", F.monotonically_increasing_id()), "digests")


def build_index(prints: DataFrame, width: int = 32, keep: str = "smallest", memtable: int = MEMTABLE) -> DataFrame:
    """(digest, has_id, doc_id, uid, n) for every digest with more than one row: the row that stays, and the rows.

    Tasks that read fill memtables and flush sorted runs; the task of a shard merges the slices of these runs.
    """
    smallest = keep == "smallest"
    spark = prints.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), prints.count() // SHARD_ROWS + 1)

    def flush_runs(batches):
        index = DigestIndex(width, smallest, memtable)
        for batch in batches:
            for doc_id, sha, uid in zip(*(c.to_pylist() for c in batch.columns)):
                if (run := index.put(sha[:width], doc_id is not None, doc_id or 0, uid)) is not None:
                    yield _slices(run, shards)
        if (run := index.frozen()) is not None:
            yield _slices(run, shards)

    def merge_shards(batches):
        now, index = None, None
        for batch in batches:
            for shard, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if shard != now:
                    if index is not None:
                        yield _hits(index.compact(), width)
                    now, index = shard, DigestIndex(width, smallest, memtable)
                index.add_run(Run(np.frombuffer(entries, entry_type(width))))
        if index is not None:
            yield _hits(index.compact(), width)

    runs = prints.select("doc_id", "sha", "uid").mapInArrow(flush_runs, SLICE_SQL)
    return runs.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(merge_shards, ENTRY_SQL)


def suspects(docs: DataFrame, hits: DataFrame, width: int = 32) -> DataFrame:
    """(digest, body) of the texts whose digest the filter of the hits holds; texts that a task has just given are left out."""
    filter_ = docs.sparkSession.sparkContext.broadcast(common.bloom_of(hits.select("digest")))  # common.FILTER_BITS at most

    def run(batches):
        seen: OrderedDict[bytes, bytes] = OrderedDict()
        held = 0
        for batch in batches:
            bodies = [t.lower() for t in common.byte_rows(batch.column(0))]
            digests = [hashlib.sha256(t).digest()[:width] for t in bodies]
            keys, texts = [], []
            for at in np.flatnonzero(filter_.value.may_hold(common.halves(digests))).tolist():
                key, text = digests[at], bodies[at]
                if seen.get(key) == text:
                    continue
                held += len(text) - len(seen.pop(key, b""))
                seen[key] = text
                while held > SEEN_BYTES and len(seen) > 1:
                    held -= len(seen.popitem(last=False)[1])
                keys.append(key)
                texts.append(text)
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(texts, pa.binary())], names=["digest", "body"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "digest binary, body binary")


def collisions(docs: DataFrame, hits: DataFrame, width: int = 32) -> DataFrame:
    """The digests among the hits whose rows are not all equal, byte for byte."""
    same = suspects(docs, hits, width).join(hits.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.min("body").alias("low"), F.max("body").alias("high"))
    return same.filter(F.col("low") != F.col("high")).select("digest")


def exact_dedup(docs: DataFrame, keep: str = "smallest", width: int = 32, memtable: int = MEMTABLE) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. keep: 'smallest' or 'largest' doc_id of
    equal texts stays. width: bytes of the digest that the index keys on.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    common.tune(docs.sparkSession)
    prints = fingerprints(docs)
    key = F.substring("sha", 1, width)
    hits = common.materialize(build_index(prints, width, keep, memtable), "hits")
    bad = common.materialize(collisions(docs, hits, width), "collisions")
    groups = hits.select("digest", F.when(F.col("has_id"), F.col("doc_id")).alias("keep_id"), F.col("uid").alias("keep_uid"), F.col("n").alias("group_size"))
    if not bad.isEmpty():  # different texts share a digest: their full digests tell them apart, as their bytes do
        split = _by_text(docs, prints, bad, key, keep)
        groups = groups.join(bad, "digest", "left_anti").withColumn("full", F.lit(None).cast("binary"))
        rows = prints.withColumn("digest", key).join(bad.withColumn("bad", F.lit(True)), "digest", "left")
        rows = rows.withColumn("full", F.when(F.col("bad"), F.col("sha")))
        groups = groups.unionByName(split)
        groups = groups.select(F.col("digest").alias("g_digest"), F.col("full").alias("g_full"), "keep_id", "keep_uid", "group_size")
        joined = common.keyed_join(rows, groups, [("digest", "g_digest"), ("full", "g_full")], "group_size", prints.count())
    else:
        joined = common.keyed_join(prints.withColumn("digest", key), groups.withColumnRenamed("digest", "g_digest"), [("digest", "g_digest")], "group_size", prints.count())
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("uid") == F.col("keep_uid"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "uid",
    )


def normalised_digest() -> Column:
    """text_sha256 of a row, without Python."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.sha2(F.translate(common.text_of(), upper, upper.lower()).cast("binary"), 256)


def kept_documents(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The rows that stay, with all their columns. Rows are known by id and text; of repeated rows one stays.

    A filter of fixed size lets the rows pass that are surely kept, so only texts that probably go are shuffled.
    """
    verdict = common.materialize(exact_dedup(docs, keep), "verdicts")
    gone = verdict.groupBy(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).agg(F.count("*").alias("__rows"), F.count_if("kept").alias("__kept")).filter("__rows > __kept")
    gone = common.materialize(gone, "gone")
    keys, names = [F.col("doc_id").cast("bigint"), normalised_digest()], ["__id", "__sha"]
    left = common.without(docs, gone, keys, names, "__rows")
    again = gone.filter("__kept > 0").select(*names)
    if again.isEmpty():  # no row is repeated with its id
        return left
    columns = docs.columns
    one = F.first(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("__row")
    repeated = common.within(docs, again, keys, names).groupBy(*[k.alias(f"__by{n}") for n, k in enumerate(keys)]).agg(one)
    return left.unionByName(repeated.select("__row.*"))


def _by_text(docs: DataFrame, prints: DataFrame, bad: DataFrame, key, keep: str) -> DataFrame:
    """Groups of the rows whose digests collide, by their full digest; full digests were checked against the texts."""
    best = F.min if keep == "smallest" else F.max
    order = F.struct(F.col("doc_id").isNull().alias("none") if keep == "smallest" else F.col("doc_id").isNotNull().alias("some"), "doc_id", "uid")
    rows = prints.withColumn("digest", key).join(bad, "digest", "left_semi")
    out = rows.groupBy("digest", F.col("sha").alias("full")).agg(best(order).alias("b"), F.count("*").alias("group_size"))
    if not collisions(docs, out.select(F.col("full").alias("digest")), 32).isEmpty():
        raise ValueError("two different texts have the same SHA-256")
    return out.select("digest", F.col("b.doc_id").alias("keep_id"), F.col("b.uid").alias("keep_uid"), F.col("group_size").cast("bigint").alias("group_size"), "full")


def query(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(common.read(spark, sf_dir, "documents"), keep="largest").drop("uid")


ORACLE = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
