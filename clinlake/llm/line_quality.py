"""Quality rules from cross-document line frequency, with DataFrame functions only.

Lines are normalised (white space squeezed, letters of all scripts lower-cased by SQL `lower`, digits as 0) and hashed.
On each host, the documents that hold a line are counted; exact copies of a text count as one document.
A line in more documents than the limit is boilerplate and is removed (`cleaned` gives the text that is
left); a document that loses more than DEPLETED of its words is rejected. The limit is MIN_DOCS documents, or SHARE of the host's documents if
that is more. Hosts are the values of `source`.

All of it is decided for each distinct (host, text), which keeps large groups of copies small: they are
merged in the tasks that read them. Lines of one text are counted once for each text.

Lines, texts and hosts that many rows share are broadcast, as they are few, and other joins are shuffled
(`common.keyed_join`). The rows of base() are written once, as both sides of such a join read them.

Nulls: a null text has no words and fails the base rules; a null host is a host. Repeated rows are
judged alike. Very long texts and lines are read whole. An empty table gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.llm import common

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
MIN_DOCS = 20
SHARE = 0.001
DEPLETED = 0.75


def words(text: str = "text") -> Column:
    return F.expr(rf"filter(split(coalesce(`{text}`, ''), r'[{common.SPACE}]+'), w -> w != '')")


def window_hashes(words: str) -> str:
    """SQL for the 64-bit hashes of the windows of WINDOW words, in order."""
    spots = f"if(size({words}) < {WINDOW}, cast(array() as array<int>), sequence(0, size({words}) - {WINDOW}))"
    return f"transform({spots}, i -> xxhash64({', '.join(f'{words}[i + {k}]' for k in range(WINDOW))}))"


def base(docs: DataFrame) -> DataFrame:
    """The rows with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = common.text_of()
    rows = docs.withColumn("__words", words()).withColumn("__windows", F.expr(window_hashes("__words")))
    lines = F.expr(rf"filter(split(coalesce(text, ''), '\n', -1), l -> l rlike r'[^{common.SPACE}]')")
    rows = rows.withColumn("__lines", lines)
    rows = rows.withColumn("__pairs", F.expr("if(size(array_distinct(__windows)) = size(__windows), null, sort_array(transform(__windows, (h, i) -> struct(h as h, i as i))))"))
    spots = "sort_array(transform(filter(__pairs, (p, k) -> coalesce(p.h = get(__pairs, k - 1).h, false) or coalesce(p.h = get(__pairs, k + 1).h, false)), p -> p.i))"
    covered = f"""coalesce(aggregate({spots}, struct(0L as n, 0 as upto),
        (a, i) -> struct(a.n + (i + {WINDOW} - greatest(a.upto, i)) as n, i + {WINDOW} as upto), a -> a.n), 0L)"""
    rows = rows.withColumn("n_words", F.size("__words").cast("bigint"))
    rows = rows.withColumn("n_repeat_words", F.expr(covered))
    return rows.select(
        *docs.columns,
        "n_words",
        (F.char_length(text) - F.regexp_count(text, F.lit(f"[{common.SPACE}]"))).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))).alias("base_failed"),
    )


def normal(line: str) -> str:
    """SQL for a normalised line."""
    return rf"trim(regexp_replace(regexp_replace(lower({line}), r'[{common.SPACE}]+', ' '), '[0-9]', '0'))"


def text_lines(docs: DataFrame) -> DataFrame:
    """host, text_hash, line, n_words, rows: the distinct normalised lines of each distinct text of a host, with the words that they hold there and the rows of the text."""
    lines = rf"transform(filter(split(coalesce(text, ''), '\n', -1), l -> l rlike r'[^{common.SPACE}]'), l -> {normal('l')})"
    marks = F.expr(f"transform({lines}, l -> struct(xxhash64(l) as line, regexp_count(l, '[^ ]+') as n))")
    texts = docs.select(F.col("source").alias("host"), common.text_of().alias("text")).select("host", F.xxhash64("text", F.length("text")).alias("text_hash"), marks.alias("marks"))
    one = texts.groupBy("host", "text_hash").agg(F.first("marks").alias("marks"), F.count("*").alias("rows"))
    each = one.select("host", "text_hash", "rows", F.explode("marks").alias("m")).groupBy("host", "text_hash", F.col("m.line").alias("line"))
    return each.agg(F.sum("m.n").alias("n_words"), F.first("rows").alias("rows"))


def losses(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, depleted: float = DEPLETED, named: bool = False) -> DataFrame:
    """host, text_hash, rows, gone, depleted of the texts that lose words to lines above the limit; if named, the hashes of these lines."""
    lines = common.materialize(text_lines(docs), "lines")
    texts = common.materialize(lines.groupBy(F.col("host").alias("t_host")).agg(F.count_distinct("text_hash").alias("texts"), F.count("*").alias("t_lines")), "hosts")
    total = lines.count()
    held = lines.groupBy("host", "line").agg(F.count("*").alias("docs")).filter(F.col("docs") > min_docs)
    limit = F.greatest(F.lit(float(min_docs)), F.col("texts") * share)
    above = common.keyed_join(common.materialize(held, "frequent"), texts, [("host", "t_host")], "t_lines", total, "inner").filter(F.col("docs") > limit)
    above = common.materialize(above.select(F.col("host").alias("a_host"), F.col("line").alias("a_line"), F.col("docs").alias("a_docs")), "boilerplate")
    marked = common.keyed_join(lines, above, [("line", "a_line"), ("host", "a_host")], "a_docs", total)
    more = [F.collect_list("a_line").alias("lines")] if named else []
    words, gone = F.sum("n_words"), F.sum(F.when(F.col("a_line").isNotNull(), F.col("n_words")).otherwise(0))
    lost = marked.groupBy("host", "text_hash").agg(words.alias("all"), gone.alias("gone"), F.first("rows").alias("rows"), *more)
    return lost.filter("gone > 0").withColumn("depleted", F.col("gone") > depleted * F.col("all")).drop("all")


def _judged(docs: DataFrame, rows: DataFrame, named: bool, limits: dict) -> DataFrame:
    """The rows with boilerplate_words and kept; if named, with the hashes of boilerplate lines in __lines."""
    lost = common.materialize(losses(docs, named=named, **limits), "losses")
    lost = lost.withColumnsRenamed({"host": "b_host", "text_hash": "b_hash", "lines": "__lines", "rows": "b_rows"})
    rows = common.materialize(rows, "base")
    judged = common.keyed_join(rows, lost, [("__hash", "b_hash"), ("source", "b_host")], "b_rows", rows.count())
    judged = judged.withColumn("boilerplate_words", F.coalesce("gone", F.lit(0)).cast("bigint"))
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.coalesce("depleted", F.lit(False))).drop("__hash", "b_host", "b_hash", "b_rows", "gone", "depleted")


def _base(docs: DataFrame) -> DataFrame:
    return base(docs.select("doc_id", "text", "source", F.xxhash64(common.text_of(), F.length(common.text_of())).alias("__hash")))


def judge(docs: DataFrame, **limits) -> DataFrame:
    """The columns of base(), boilerplate_words and kept, for every row of doc_id, text, source."""
    return _judged(docs, _base(docs).drop("text"), False, limits)


def cleaned(docs: DataFrame, **limits) -> DataFrame:
    """As judge(), with the text that is left without its boilerplate lines; other lines stay as they are."""
    rows = _judged(docs, _base(docs), True, limits)
    left = F.expr(rf"array_join(filter(split(text, '\n', -1), l -> not array_contains(__lines, xxhash64({normal('l')}))), '\n')")
    return rows.withColumn("text", F.when(F.col("__lines").isNull(), F.col("text")).otherwise(left)).drop("__lines")


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), w AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 4), ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d WHERE len(words) >= 5)
), rep AS (
  SELECT doc_id, i FROM w QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM rep, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id
), b AS (
  SELECT d.doc_id, d.source, d.text, d.lines, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(text) - len(regexp_extract_all(text, '[\x20\x09-\x0D]')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(cov.n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN cov USING (doc_id)
), t AS (SELECT DISTINCT source, text, lines FROM b),
l0 AS (
  SELECT source, text, regexp_replace(trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')), '[0-9]', '0', 'g') AS line
  FROM (SELECT source, text, unnest(lines) AS line FROM t)
), l AS (SELECT source, text, line, sum(len(regexp_extract_all(line, '[^ ]+'))) AS n FROM l0 GROUP BY ALL),
hosts AS (SELECT source, count(DISTINCT text) AS texts FROM l GROUP BY source),
above AS (
  SELECT l.source, l.line FROM l JOIN hosts ON l.source IS NOT DISTINCT FROM hosts.source
  GROUP BY l.source, l.line, texts HAVING count(*) > greatest(20.0, texts * 0.001)
), lost AS (
  SELECT l.source, l.text FROM l LEFT JOIN above a ON l.source IS NOT DISTINCT FROM a.source AND l.line = a.line
  GROUP BY l.source, l.text HAVING coalesce(sum(n) FILTER (WHERE a.line IS NOT NULL), 0) > 0.75 * sum(n)
)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost.text IS NULL AS kept
FROM b LEFT JOIN lost ON b.text = lost.text AND b.source IS NOT DISTINCT FROM lost.source
"""
