"""What the operators share: shared-folder tables, joins that no hot key stops, filters and word hashing.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, which is what ``bytes.split()``
yields on UTF-8. Null texts count as empty everywhere in this subpackage.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_digest

#: Rows that may be broadcast; a side is counted before it is broadcast.
MAX_BROADCAST_ROWS = 20_000
#: Rows and bytes in an Arrow batch sent to Python, unless the session sets other numbers.
ARROW_ROWS, ARROW_BYTES = 500, 8 << 20
#: White space between words, as a pattern for Java and SQL.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

_ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": ARROW_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": ARROW_BYTES}
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_KEY = 0x9E3779B97F4A7C15
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir.

    Where it is unset, a temporary folder is set in local mode, as in tests; on a cluster that is an error, as
    executors would write to folders of their own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="clinlake-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def tune(spark: SparkSession) -> None:
    """Small Arrow batches, so that long texts stay within a worker's memory: a batch ends at either limit."""
    for key, value in _ARROW.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, str(value))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/clinlake-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the tables written so far. Results that still read them must have been written before."""
    while _written:
        owner, path = _written.pop()
        try:
            jvm = owner._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(owner._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session may have ended; the folder is scratch space
            return


atexit.register(release, None)


def is_small(df: DataFrame, rows: int = MAX_BROADCAST_ROWS) -> bool:
    return df.limit(rows + 1).count() <= rows


def checked_broadcast(df: DataFrame, rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the table has few rows; otherwise the table as it is, for a shuffled join."""
    return F.broadcast(df) if is_small(df, rows) else df


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fold(doc_id: str = "doc_id", mod: int = 5) -> Column:
    """crc32 of the id as text, modulo a number; ids that are null fall into no fold."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod


# -- bytes and words ---------------------------------------------------------------------------


def byte_rows(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null is empty."""
    if column.type != pa.binary():
        column = column.cast(pa.large_binary())
    return [x or b"" for x in column.to_pylist()]


#: Bytes of a text whose words are held at once; a longer text is cut at white space.
PIECE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(text: bytes) -> Iterator[bytes]:
    """A text cut at white space into pieces of about PIECE bytes; a longer word stays whole."""
    at = 0
    while len(text) - at > PIECE:
        found = _GAP.search(text, at + PIECE)
        cut = found.start() if found else len(text)
        yield text[at:cut]
        at = cut
    yield text[at:]


def words(text: bytes, lower: bool = True) -> np.ndarray:
    """The words of a text, in order, as keyed 64-bit hashes (XXH3), which tell words of any length and form apart."""
    return np.frombuffer(b"".join(b"".join(map(xxh3_64_digest, (p.lower() if lower else p).split(), repeat(_KEY))) for p in pieces(text)), np.uint64)


# -- filters and joins ----------------------------------------------------------------------------


class Bloom:
    """A Bloom filter over digests of at least 16 bytes, which are random bits already. Its size is fixed when it is made."""

    def __init__(self, bits: int, probes: int = 6):
        self.bits, self.probes = max(64, bits + -bits % 8), probes
        self.table = np.zeros(self.bits // 8, np.uint8)

    def _places(self, digests: np.ndarray) -> Iterator[np.ndarray]:
        one, two = digests.T
        for k in range(self.probes):
            yield mix(one + np.uint64(k) * (two | np.uint64(1))) % np.uint64(self.bits)

    def add(self, digests: np.ndarray) -> None:
        for at in self._places(digests):
            np.bitwise_or.at(self.table, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def may_hold(self, digests: np.ndarray) -> np.ndarray:
        out = np.ones(len(digests), bool)
        for at in self._places(digests):
            out &= (self.table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def halves(digests: list[bytes]) -> np.ndarray:
    """Digests as rows of two numbers, from their first 16 bytes (shorter ones are filled up)."""
    return np.frombuffer(b"".join(d[:16].ljust(16, b"\0") for d in digests), np.uint64).reshape(-1, 2)


#: Bits of a filter that is broadcast: 8 MB at any size of the data. Beyond some ten million keys it lets more
#: rows through to the exact join that follows it.
FILTER_BITS = 1 << 26


def bloom_of(keys: DataFrame, bits: int = FILTER_BITS) -> Bloom:
    """A filter of all rows of one binary column. Tasks make filters of their own, which are joined by tasks and at last on the driver."""
    rows = keys.count()
    bits = min(bits, max(1 << 13, 16 * rows))

    def fill(batches):
        own = Bloom(bits)
        for batch in batches:
            own.add(halves(batch.column(0).to_pylist()))
        raw = own.table.tobytes()
        for at in range(0, len(raw), 1 << 20):
            yield pa.record_batch([pa.array([at], pa.int64()), pa.array([raw[at : at + (1 << 20)]], pa.binary())], names=["at", "part"])

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new = np.frombuffer(part, np.uint8)
                held[at] = new.copy() if at not in held else np.bitwise_or(held[at], new)
        yield pa.record_batch([pa.array(list(held), pa.int64()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["at", "part"])

    schema = "at bigint, part binary"
    few = keys.coalesce(max(1, min(64, rows // 100_000)))
    out = Bloom(bits)
    for r in few.mapInArrow(fill, schema).repartition(8, "at").mapInArrow(merge, schema).collect():
        part = np.frombuffer(r.part, np.uint8)
        out.table[r["at"] : r["at"] + len(part)] = part
    return out


def held(bloom: Bloom, digests: pa.Array) -> pa.Array:
    """Whether the filter may hold these values. Nulls are not held."""
    found = digests.to_pylist()
    return pa.array(bloom.may_hold(halves([d or b"" for d in found])) & np.array([d is not None for d in found], bool))


def shared(bloom: Bloom):
    """The filter as a broadcast variable, of FILTER_BITS at most."""
    return SparkSession.getActiveSession().sparkContext.broadcast(bloom)


def maybe_in(bloom: Bloom):
    """A function of a binary column: whether the filter may hold its values. Nulls are not held."""

    @F.arrow_udf("boolean")
    def maybe(digests: pa.Array) -> pa.Array:
        return held(known.value, digests)

    known = shared(bloom)
    return maybe


def _keyed(docs: DataFrame, keys: list[Column]) -> DataFrame:
    return docs.withColumns({f"__key{n}": k for n, k in enumerate(keys)})


def _digest(names: list[str]) -> Column:
    return F.unhex(F.md5(F.concat_ws("|", *[F.coalesce(F.col(n).cast("string"), F.lit("-")) for n in names]).cast("binary")))


def within(docs: DataFrame, table: DataFrame, keys: list[Column], names: list[str]) -> DataFrame:
    """The rows of docs whose keys are among the rows of a table (columns `names`). A filter of fixed size lets most
    other rows go before anything is shuffled. Keys are compared null-safe."""
    own = [f"__key{n}" for n in range(len(keys))]
    maybe = maybe_in(bloom_of(table.select(_digest(names))))
    return _keyed(docs, keys).filter(maybe(_digest(own))).join(table, [F.col(o).eqNullSafe(F.col(n)) for o, n in zip(own, names)], "left_semi").drop(*own)


def without(docs: DataFrame, gone: DataFrame, keys: list[Column], names: list[str], weight: str) -> DataFrame:
    """The rows of docs whose keys are not among the rows of gone (columns `names`; weight: the rows that hold the key).

    Rows that a filter of fixed size does not hold pass as they are; only the others are joined, and of these only
    rows without a heavy key are shuffled. Keys are compared null-safe.
    """
    own = [f"__key{n}" for n in range(len(keys))]
    maybe = maybe_in(bloom_of(gone.select(_digest(names))))(_digest(own))
    same = [F.col(o).eqNullSafe(F.col(n)) for o, n in zip(own, names)]
    total = gone.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    hot = F.col(weight) * MAX_BROADCAST_ROWS > total
    marked = _keyed(docs, keys)
    exact = marked.filter(maybe).join(F.broadcast(gone.filter(hot)), same, "left_anti").join(gone.filter(~hot), same, "left_anti")
    return marked.filter(~maybe).unionByName(exact).drop(*own)


def keyed_join(rows: DataFrame, table: DataFrame, on: list[tuple[str, str]], weight: str, total: int, how: str = "left") -> DataFrame:
    """Join rows (left or inner) with a table that has one row for each key, however many rows share a key.

    on: (column of rows, column of the table); weight: a column of the table, the rows that hold its key; total: all
    rows. Keys with more than one in MAX_BROADCAST_ROWS of all rows number fewer than MAX_BROADCAST_ROWS, so they are
    broadcast, and only rows with other keys are shuffled. Keys are compared null-safe; weight stays a column.
    """
    hot = (F.col(weight) * MAX_BROADCAST_ROWS > total) | (F.lit(total) <= MAX_BROADCAST_ROWS)
    keys = lambda a, b: [a[f"`{x}`"].eqNullSafe(b[f"`{y}`"]) for x, y in on]
    heavy, light = F.broadcast(table.filter(hot)), table.filter(~hot)
    found = rows.join(heavy, keys(rows, heavy), "inner")
    if total <= MAX_BROADCAST_ROWS:
        return found if how == "inner" else rows.join(heavy, keys(rows, heavy), "left")
    rest = rows.join(heavy, keys(rows, heavy), "left_anti")
    return found.unionByName(rest.join(light, keys(rest, light), how))
