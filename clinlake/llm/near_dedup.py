"""Near-duplicate detection with circulant MinHash, banding and exact Jaccard verification.

Two permutations make the whole signature: the first spreads the shingles over POSITIONS places, the
second gives each place its rank, and coordinate k reads it shifted circularly by k. All coordinates of a
document are therefore minima over slices of one table. Bands of coordinates give candidates; their shape
follows the limit, so that a pair just at it shares no band with probability MISSED at most: at 85 %,
32 bands of 8 coordinates, (1 - 0.85**8)**32 < 4e-5; at 80 %, 34 bands of 6, (1 - 0.8**6)**34 < 4e-5.

Documents with equal shingle sets form a class. In each bucket, candidates are not all pairs: members are
first compared with one centre, which joins most of a large group; buckets that still hold several
components get another centre, chosen by hash. What is left after CENTRES rounds is compared through an index
of rare shingles: two sets that share the limit share one of the rarest (100 - limit) % of their shingles,
so sets meet only there, and only if another component has the shingle too and what is left of both sets allows a
link. Links are confirmed on full sets, fetched for the classes that have candidates.

Buckets, centres and shingles that many sets share are broadcast or cut (`common.keyed_join`, SALT_ROWS).

Nulls: a null or wordless text has no shingles and is linked with nothing; a row with a null doc_id is
left alone (component_id null, kept). Rows that repeat a doc_id are documents of their own, each in the component of its own
text; equal rows are kept or dropped together. Very long texts are cut into words piece by piece. An empty
table gives an empty result. Extra columns are left out by near_dedup() and pass through kept_documents().
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinlake.llm import common
from clinlake.llm.graph import components

WORDS = 5
#: Least similarity that links, unless a caller gives another; the query of op5 gives CONTRACT.
PERCENT = 80
CONTRACT = 85
#: Coordinates of a signature and rows of a band at most, and the share of pairs at the limit that may share no band.
COORDINATES, ROWS, MISSED = 256, 8, 4e-5
POSITIONS = 1 << 22
#: Rounds in which each unresolved bucket gets one more centre.
CENTRES = 2
#: Pairs of one centre, and sets with one rare shingle, that meet in one task; more are dealt out to several.
SALT_ROWS = 2_000
#: Shingles whose table slices are held at once.
SLICES = 512

_SEEDS = np.random.Generator(np.random.PCG64(5)).integers(1, 2**62, 2 * WORDS + ROWS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_table: dict[int, np.ndarray] = {}


def shape(percent: int) -> tuple[int, int]:
    """Bands and rows for a limit: as many rows as COORDINATES allow for the bands that MISSED asks for; one row at least."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent must be above 0 and at most 100: {percent}")
    best = None
    for rows in range(1, ROWS + 1):
        hit = (percent / 100) ** rows
        count = 1 if hit == 1 else math.ceil(math.log(MISSED) / math.log1p(-hit))
        if best is None or count * rows <= COORDINATES:
            best = count, rows
    return best


def shingles(words: np.ndarray, width: int = WORDS) -> np.ndarray:
    """The set of a text's shingles, sorted, as 64-bit hashes of its word hashes; fewer words make one shingle."""
    n = len(words)
    if n == 0:
        return words
    if n < width:
        one = np.uint64(n)
        for k in range(n):
            one = common.mix((one ^ words[k : k + 1]) * _SEEDS[WORDS + k])
        return one
    total = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        total += words[k : n - width + 1 + k] * _SEEDS[WORDS + k]
    return np.unique(common.mix(total))


def _ranks(count: int) -> np.ndarray:
    """The second permutation, continued circularly, as slices of `count` coordinates by place."""
    if count not in _table:
        # Made in place: each worker of an executor makes it at the same time, and a copy in 64 bits is four times as large.
        ranks = np.arange(POSITIONS + count - 1, dtype=np.uint32)
        np.random.Generator(np.random.PCG64(23)).shuffle(ranks[:POSITIONS])
        ranks[POSITIONS:] = ranks[: count - 1]
        _table.clear()
        _table[count] = sliding_window_view(ranks, count)
    return _table[count]


def signature(found: np.ndarray, count: int) -> np.ndarray:
    """Circulant MinHash, of `count` coordinates, of a set of shingles, which must not be empty."""
    places = (common.mix(found * _SEEDS[-1]) >> np.uint64(42)).astype(np.int64)
    table = _ranks(count)
    low = table[places[:SLICES]].min(0)
    for at in range(SLICES, len(places), SLICES):
        np.minimum(low, table[places[at : at + SLICES]].min(0), out=low)
    return low


def bands(low: np.ndarray, count: int, rows: int) -> np.ndarray:
    each = low.reshape(count, rows).astype(np.uint64)
    total = np.arange(count, dtype=np.uint64)
    for k in range(rows):
        total = common.mix((total ^ each[:, k]) * _SEEDS[2 * WORDS + k])
    return total.view(np.int64)


def _sets(batches, more, held=None):
    """held: a filter of the digests in the fourth column; rows that it does not hold are left out before their texts are cut."""
    for batch in batches:
        if held is not None:
            batch = batch.filter(common.held(held.value, batch.column(3)))
        rows = []
        for text in common.byte_rows(batch.column(1)):
            found = shingles(common.words(text))
            rows.append((len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None, more(found)))
        n, key, extra = zip(*rows) if rows else ((), (), ())
        yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(extra, pa.list_(pa.int64())), batch.column(2)], names=["doc_id", "n", "set_id", "extra", "text_hash"])


def _with_sets(docs: DataFrame, more, held=None) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), text_hash().alias("text_hash"), *([] if held is None else [_id_digest(F.col("doc_id").cast("bigint"))]))
    return rows.mapInArrow(lambda batches: _sets(batches, more, held), "doc_id bigint, n bigint, set_id binary, extra array<bigint>, text_hash bigint")


def _id_digest(doc_id: Column) -> Column:
    return F.unhex(F.md5(doc_id.cast("string").cast("binary")))


def text_hash() -> Column:
    """A number by which rows of one doc_id with different texts are told apart."""
    return F.xxhash64(common.text_of())


def sketches(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n, set_id, extra, text_hash: the size and a 128-bit name of each shingle set, and its band hashes."""
    count, rows = shape(percent)
    return _with_sets(docs, lambda found: bands(signature(found, count * rows), count, rows) if len(found) else None)


def shingle_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, n, set_id, extra, text_hash: as sketches, with the set itself in extra, for all rows with one of these ids (doc_id) and
    perhaps a few others. A filter of fixed size tells them in the worker that makes the sets, so no text is shuffled, and a task has one worker."""
    shared = common.shared(common.bloom_of(ids.select(_id_digest(F.col("doc_id")))))
    return _with_sets(docs, lambda found: found.view(np.int64), shared)


def _close(a, b, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (u, v) whose sets have 100 * intersection >= percent * union. The pairs of a centre meet its set in as many tasks as they need."""
    total = pairs.count()
    held = pairs.groupBy(F.col("u").alias("d_u")).agg(F.count("*").alias("d_rows"))
    held = held.withColumn("salts", F.expr(f"cast(ceil(d_rows / {SALT_ROWS}) as int)"))
    dealt = common.keyed_join(pairs.select("u", "v"), held, [("u", "d_u")], "d_rows", total, "inner").select("u", "v", F.pmod(F.xxhash64("v"), "salts").cast("int").alias("salt"))
    copies = sets.join(held, sets["node"] == held["d_u"]).select(F.col("node").alias("l_u"), F.col("n").alias("nu"), F.col("extra").alias("su"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("l_salt"))
    right = sets.select(F.col("node").alias("r_v"), F.col("n").alias("nv"), F.col("extra").alias("sv"))
    both = dealt.join(right, F.col("v") == F.col("r_v")).join(copies, (F.col("u") == F.col("l_u")) & (F.col("salt") == F.col("l_salt"))).filter(_close("nu", "nv", percent))
    shared = F.size(F.array_intersect("su", "sv"))
    return both.select("u", "v", "nu", "nv", shared.alias("shared")).filter(100 * F.col("shared") >= percent * (F.col("nu") + F.col("nv") - F.col("shared"))).select("u", "v").distinct()


def _roots(members: DataFrame, comp: DataFrame | None) -> DataFrame:
    """The members of buckets with their roots: the components found so far."""
    if comp is None:
        return members.withColumn("root", F.col("node"))
    return members.join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))


def by_rare_shingles(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v, nu, nv, ru, rv) of different components that may reach the limit. open_: node, root.

    Only shingles that several components hold can be shared; let a set of n have m of them. It shares at least
    need = ceil(percent * n / 100) with a partner, so both hold a common one among their m - need + 1 rarest, in one
    order for all, and sets with m < need have no partner. At the first such shingle, the i-th of the one and the
    j-th of the other, they can share min(m - i, m' - j) + 1 at most, which must be what their sizes ask for. No
    pair at the limit is lost.
    """
    each = common.materialize(sets.join(open_, "node").select("node", "n", "root", F.explode("extra").alias("shingle")), "shingles")
    held = each.groupBy(F.col("shingle").alias("h_shingle")).agg(F.count("*").alias("c"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").drop("low", "high")
    mixed = common.keyed_join(each, held, [("shingle", "h_shingle")], "c", each.count(), "inner")
    own = Window.partitionBy("node")
    ranked = mixed.withColumn("m", F.count("*").over(own)).withColumn("need", F.ceil(percent * F.col("n") / 100)).filter("m >= need")
    rare = ranked.withColumn("i", F.row_number().over(own.orderBy("c", "shingle"))).filter("i <= m - need + 1")
    rare = common.materialize(rare.select("node", "n", "root", "shingle", (F.col("m") - F.col("i") + 1).alias("left")), "rare")
    met = rare.groupBy(F.col("shingle").alias("m_shingle")).agg(F.count("*").alias("met"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    met = met.withColumn("salts", F.expr(f"cast(ceil(met / {SALT_ROWS}) as int)")).drop("low", "high")
    rare = common.keyed_join(rare, met, [("shingle", "m_shingle")], "met", rare.count(), "inner")
    one = rare.select("shingle", F.pmod(F.xxhash64("node"), "salts").cast("int").alias("salt"), F.col("node").alias("u"), F.col("n").alias("nu"), F.col("root").alias("ru"), F.col("left").alias("lu"))
    two = rare.select("shingle", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("node").alias("v"), F.col("n").alias("nv"), F.col("root").alias("rv"), F.col("left").alias("lv"))
    same = (one["shingle"] == two["shingle"]) & (one["salt"] == two["salt"])
    enough = (100 + percent) * F.least("lu", "lv") >= percent * (F.col("nu") + F.col("nv"))
    return one.join(two, same & (F.col("u") < F.col("v")) & (F.col("ru") != F.col("rv")) & _close("nu", "nv", percent) & enough).select("u", "v", "nu", "nv", "ru", "rv")


def links(docs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, root) for the classes that are linked with others. classes: node, doc_id, set_id, n, extra (band hashes)."""
    spread = classes.select("node", "n", F.explode("extra").alias("band"))
    shared = spread.groupBy("band").agg(F.count("*").alias("c")).filter("c > 1").withColumnRenamed("band", "s_band")
    total = classes.count() * shape(percent)[0]
    members = common.materialize(common.keyed_join(spread, shared, [("band", "s_band")], "c", total, "inner").drop("s_band"), "buckets")
    # A text that others were made from is in the largest bucket of every band: it is the centre to begin with.
    weight = members.groupBy(F.col("node").alias("w_node")).agg(F.sum("c").alias("weight"))
    members = common.materialize(members.join(weight, F.col("node") == F.col("w_node")).select("node", "n", "band", "weight", "c"), "members")
    wanted = common.materialize(classes.join(members.select("node").distinct(), "node", "left_semi").select("doc_id", F.col("set_id").alias("c_set"), F.col("node").alias("c_node")), "wanted")
    found = shingle_sets(docs, wanted.select("doc_id").distinct())
    sets = found.join(wanted.drop("doc_id"), F.col("set_id") == F.col("c_set")).select(F.col("c_node").alias("node"), "n", "extra").dropDuplicates(["node"])
    sets = common.materialize(sets, "sets")
    found, tried, comp = None, None, None
    for turn in range(CENTRES + 1):
        rows = _roots(members, comp)
        if turn:
            mixed = rows.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("m")).filter("a != b").select(F.col("band").alias("m_band"), "m")
            members = common.materialize(common.keyed_join(rows.drop("root"), mixed, [("band", "m_band")], "m", total, "inner").select("node", "n", "band", "weight", F.col("m").alias("c")), "members")
            rows = _roots(members, comp)
        if turn < CENTRES:
            order = F.struct("weight", -F.col("node")) if turn == 0 else F.struct(F.xxhash64(F.lit(turn), F.col("node")), "node")
            centre = rows.groupBy(F.col("band").alias("c_band")).agg(F.max_by(F.struct("node", "n", "root"), order).alias("one"), F.count("*").alias("held"))
            pairs = common.keyed_join(rows, centre, [("band", "c_band")], "held", total, "inner")
            pairs = pairs.select(F.col("one.node").alias("u"), F.col("node").alias("v"), F.col("one.n").alias("nu"), F.col("n").alias("nv"), F.col("one.root").alias("ru"), F.col("root").alias("rv"))
        else:
            open_ = common.materialize(rows.select("node", "root").distinct(), "open")
            if open_.isEmpty():
                break
            pairs = by_rare_shingles(open_, sets, percent)
        pairs = pairs.filter((F.col("ru") != F.col("rv")) & _close("nu", "nv", percent)).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), "u", "v").dropDuplicates(["a", "b"])
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = common.materialize(pairs.select("u", "v", "a", "b"), "pairs")
        if not pairs.isEmpty():
            seen = pairs.select("a", "b")
            tried = seen if tried is None else tried.unionByName(seen)
            new = common.materialize(verified(pairs, sets, percent), "links")
            found = new if found is None else found.unionByName(new)
            comp = common.materialize(components(found), "components")
    if comp is None:
        return docs.sparkSession.createDataFrame([], "node bigint, root bigint")
    return comp


def _components(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, n, text_hash, component_id for every row."""
    common.tune(docs.sparkSession)
    drawn = common.materialize(sketches(docs, percent).withColumn("uid", F.monotonically_increasing_id()), "sketches")
    usable = drawn.filter(F.col("set_id").isNotNull() & F.col("doc_id").isNotNull())
    classes = usable.groupBy("set_id").agg(F.min("uid").alias("node"), F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("extra").alias("extra"), F.count("*").alias("rows"))
    classes = common.materialize(classes, "classes")
    linked = classes.select("node", "doc_id", "set_id", "rows").join(links(docs, classes, percent), "node", "left")
    # Only classes with more than one row or a link need a lookup; other rows are their own component.
    linked = common.materialize(linked.filter((F.col("rows") > 1) | F.col("root").isNotNull()).withColumn("root", F.coalesce("root", "node")), "linked")
    least = linked.groupBy(F.col("root").alias("l_root")).agg(F.min("doc_id").alias("component_id"), F.count("*").alias("l_rows"))
    named = common.keyed_join(linked, least, [("root", "l_root")], "l_rows", classes.count(), "inner").select(F.col("set_id").alias("k_set"), "component_id", "rows")
    rows = drawn.select("doc_id", "n", "set_id", "text_hash")
    shown = F.col("set_id").isNotNull() & F.col("doc_id").isNotNull()
    out = common.keyed_join(rows.filter(shown), common.materialize(named, "named"), [("set_id", "k_set")], "rows", drawn.count()).select("doc_id", "n", "text_hash", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.unionByName(rows.filter(~shown).select("doc_id", "n", "text_hash", F.col("doc_id").alias("component_id")))


def _kept() -> Column:
    return F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))


def near_dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that can be reached), kept, for every row."""
    return _components(docs, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id", _kept().alias("kept"))


def kept_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows that stay, with all their columns. Rows are known by doc_id and text; a filter of fixed size lets
    most of those that stay pass without a shuffle of their texts."""
    gone = _components(docs, percent).filter(~_kept()).groupBy(F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__hash")).agg(F.count("*").alias("__rows"))
    return common.without(docs, common.materialize(gone, "gone"), [F.col("doc_id").cast("bigint"), text_hash()], ["__gone", "__hash"], "__rows")


def query(spark, sf_dir: str) -> DataFrame:
    return near_dedup(common.read(spark, sf_dir, "documents").select("doc_id", "text"), CONTRACT)


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM d WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), e AS (
  SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), r(doc_id, reach) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.v FROM r JOIN e ON e.u = r.reach
), c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, c.doc_id = c.component_id AS kept
FROM c LEFT JOIN n ON c.doc_id = n.doc_id
"""
