"""Benchmark decontamination: a prefix-filtered set join of documents with the windows of benchmark items, with DataFrame functions only.

A window is `window` consecutive words of an item; an item of fewer words is one window. A document is contaminated
where a window stands in it word for word. A window is a set of shingles (`shingle` words each, or the whole window where it
is shorter), and a document's window that contains all of them must contain any one: so of the shingles, ordered by
their number of occurrences in the documents, the rarest alone is the prefix that has to be joined. A window of which
a shingle is nowhere in the documents is given up before the join. From the place of its rarest shingle a candidate's bounds
follow: it must not begin before the document nor end after it, and it is then compared word by word.

The documents' words are exploded once, against the hashes of all shingles of the items; what is met, with the words
around it, is a table from which counts, prefixes and candidates are made. The hashes are broadcast, BLOCK of them
at most: more are dealt into blocks by value, and each block reads the documents again. Windows are broadcast if they
are few (counted), and joined by a shuffle otherwise. A hash that two shingles share costs a comparison, not a wrong result.

Equal texts are known by their SHA-256, and hits are kept once for each, so copies add nothing; results go back to rows by
`common.keyed_join`. Hits of one text are in one task when they are counted; they are fewer than its words times `window`.

Words are lower-cased for A-Z only; every character beyond ASCII belongs to words. Nulls: a null text has no words; a null doc_id is
a document; an item without an id counts as one whose id is empty. Repeated rows are judged alike, repeated items
count once. Very long texts are read whole. An empty table of documents gives an empty result, one of items no hits. Extra columns
are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.llm import common

WINDOW, SHINGLE = 10, 5
#: Hashes of shingles that are broadcast at once, 8 bytes each.
BLOCK = 1 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space, punctuation and control characters between words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str = "text") -> Column:
    return F.array_remove(F.split(F.translate(common.text_of(text), UPPER, UPPER.lower()), GAP), "")


def _joined(parts: Column) -> Column:
    """Words of a window as one text; words hold no spaces."""
    return F.array_join(parts, " ")


def _hash(held: str, at: str, size: int) -> Column:
    """The hash of `size` words from place `at` (from 0)."""
    return F.expr(f"xxhash64({', '.join(f'get({held}, {at} + {k})' for k in range(size))})")


def windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, win, size): the distinct windows of every item, as joined words, and their number of words."""
    held = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words().alias("w"))
    held = held.withColumn("size", F.least(F.size("w"), F.lit(window))).filter("size > 0")
    each = held.select("item", "size", "w", F.explode(F.expr("sequence(0, size(w) - size)")).alias("i"))
    return each.select("item", _joined(F.slice("w", F.col("i") + 1, F.col("size"))).alias("win"), "size").distinct()


def shingles(wins: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(win, size, n, at, hash): the n shingles of every distinct window and their places."""
    held = wins.select("win", "size").distinct().withColumn("w", F.split("win", " ")).withColumn("k", F.least("size", F.lit(shingle)))
    each = held.select("win", "size", "w", "k", F.explode(F.expr("sequence(0, size - k)")).alias("at"))
    key = F.coalesce(*[F.when(F.col("k") == k, _hash("w", "at", k)) for k in range(1, shingle + 1)])
    return each.select("win", "size", (F.col("size") - F.col("k") + 1).alias("n"), "at", key.alias("hash"))


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n_words) of every row."""
    w = words()
    return docs.select("doc_id", F.unhex(F.sha2(common.text_of().cast("binary"), 256)).alias("digest"), F.size(w).cast("bigint").alias("n_words"))


def occurrences(docs: DataFrame, hashes: DataFrame, sizes: list[int], window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(digest, n_words, pos, hash, before, around): the places of texts where one of the hashes is met.

    sizes: the numbers of words that shingles have. around: the words that a window over the place can hold, of which `before` stand before it.
    """
    held = docs.select(F.unhex(F.sha2(common.text_of().cast("binary"), 256)).alias("digest"), words().alias("w")).withColumn("n_words", F.size("w"))
    rows = held.select("digest", "n_words", "w", F.posexplode("w").alias("pos", "word"))
    keys = [F.when(F.col("pos") + k <= F.col("n_words"), _hash("w", "pos", k)) for k in sizes]
    rows = rows.withColumn("key", keys[0] if len(keys) == 1 else F.explode(F.array(*keys)))
    count = hashes.count()
    blocks = max(1, -(-count // block))
    out = None
    for n in range(blocks):
        mine = rows if blocks == 1 else rows.filter(F.pmod("key", F.lit(blocks)) == n)
        some = hashes if blocks == 1 else hashes.filter(F.pmod("hash", F.lit(blocks)) == n)
        met = mine.join(F.broadcast(some), F.col("key") == F.col("hash"))  # about BLOCK hashes
        before = F.least("pos", F.lit(window - 1))
        met = met.select("digest", "n_words", "pos", "hash", before.alias("before"), F.slice("w", F.col("pos") - before + 1, before + window).alias("around"))
        out = met if out is None else out.unionByName(met)
    return out


def prefixes(shingled: DataFrame, counts: DataFrame) -> DataFrame:
    """(win, size, hash, at): the rarest shingle of every window all of whose shingles occur. counts: (hash, n_occurrences)."""
    known = shingled.join(counts, "hash")
    rarest = known.groupBy("win", "size", "n").agg(F.count("*").alias("found"), F.min(F.struct("n_occurrences", "hash", "at")).alias("r"))
    return rarest.filter("found = n").select("win", "size", F.col("r.hash").alias("hash"), F.col("r.at").alias("at"))


def hits(docs: DataFrame, wins: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame | None:
    """(digest, start, size, win): where windows stand in texts, once for each text. None where there are no windows."""
    shingled = common.materialize(shingles(wins, shingle), "shingles")
    sizes = sorted(r.k for r in shingled.select(F.least("size", F.lit(shingle)).alias("k")).distinct().collect())  # `shingle` numbers at most
    if not sizes:
        return None
    met = common.materialize(occurrences(docs, shingled.select("hash").distinct(), sizes, window, block), "met")
    counts = met.groupBy("hash").agg(F.count("*").alias("n_occurrences"))
    prefix = common.materialize(prefixes(shingled, counts), "prefixes")
    found = met.join(common.checked_broadcast(prefix), "hash").withColumn("start", F.col("pos") - F.col("at"))
    found = found.filter((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))
    same = _joined(F.slice("around", F.col("before") - F.col("at") + 1, F.col("size"))) == F.col("win")
    return found.filter(same).select("digest", "start", "size", "win").distinct()


def _covered(found: DataFrame) -> DataFrame:
    """(digest, n_hit): words inside any hit, each once."""
    spans = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("stop"))))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(a["upto"], s["start"]))).alias("n"), F.greatest(a["upto"], s["stop"]).alias("upto")), lambda a: a["n"],
    )
    return found.groupBy("digest").agg(spans.alias("spans")).select("digest", covered.alias("n_hit"))


def judge(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids as text), contaminated for every row of docs (doc_id, text); items: item_id, text."""
    rows = common.materialize(identified(docs), "identified")
    wins = common.materialize(windows(items, window), "windows")
    found = hits(docs, wins, window, shingle, block)
    none = F.array().cast("array<string>")
    if found is None:
        return rows.select("doc_id", "n_words", F.lit(0).cast("bigint").alias("n_hit"), none.alias("items"), F.lit(False).alias("contaminated"))
    found = common.materialize(found, "hits")
    named = found.select("digest", "win").distinct().join(common.checked_broadcast(wins.select("item", "win")), "win")
    ids = named.groupBy("digest").agg(F.array_sort(F.collect_set("item")).alias("items"))
    copies = rows.groupBy(F.col("digest").alias("c_digest")).agg(F.count("*").alias("copies"))
    texts = _covered(found).join(ids, "digest").join(copies, F.col("digest") == F.col("c_digest")).select(F.col("digest").alias("h_digest"), "n_hit", "items", "copies")
    texts = common.materialize(texts, "contaminated")
    out = common.keyed_join(rows, texts, [("digest", "h_digest")], "copies", rows.count())
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))


def query(spark, sf_dir: str) -> DataFrame:
    docs, items = common.read(spark, sf_dir, "documents").select("doc_id", "text"), common.read(spark, sf_dir, "benchmark").select("item_id", "text")
    ids = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return judge(docs, items).select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), ids.alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark
), win AS (
  SELECT DISTINCT item, l, array_to_string(list_slice(words, i, i + l - 1), ' ') AS win
  FROM (SELECT item, words, least(len(words), 10) AS l, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i FROM b WHERE len(words) > 0)
), hit AS (
  SELECT r, i, l, win FROM (
    SELECT r, i, l, array_to_string(list_slice(words, i, i + l - 1), ' ') AS win
    FROM (SELECT r, words, l, unnest(range(1, len(words) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM win) WHERE len(words) >= l)
  ) WHERE win IN (SELECT win FROM win)
), cov AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM hit, range(10) t(k) WHERE k < l GROUP BY r
), its AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit JOIN win USING (win)) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
"""
