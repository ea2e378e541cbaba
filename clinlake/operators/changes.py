"""Change capture: decoding, masking, normalising, keys and routes, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fields that are masked, by table.
MASKED: Mapping[str, Sequence[str]] = {"patients": ("id_card", "phone")}
MASK = "***"

TEXT_MAP = T.MapType(T.StringType(), T.StringType())
ENVELOPE = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("source_id", T.StringType()), T.StructField("database", T.StringType()),
    T.StructField("table", T.StringType()), T.StructField("op_type", T.StringType()), T.StructField("primary_keys", TEXT_MAP),
    T.StructField("before", TEXT_MAP), T.StructField("after", TEXT_MAP), T.StructField("binlog_file", T.StringType()),
    T.StructField("binlog_pos", T.LongType()), T.StructField("row_seq", T.IntegerType()), T.StructField("lsn", T.StringType()),
    T.StructField("txn_id", T.StringType()), T.StructField("source_timestamp", T.TimestampType()),
])


def decode_op(code: Column) -> Column:
    """1 delete, 2 insert, 3 and 4 the two images of an update; other codes insert."""
    return F.when(code == 1, "DELETE").when(code.isin(3, 4), "UPDATE").otherwise("INSERT")


def pair_updates(rows: DataFrame, keys: Sequence[str], lsn: str = "lsn", code: str = "op_code", image: str = "image") -> DataFrame:
    """One event for each key and position: the images of an update, codes 3 and 4, become before and after."""
    kind = decode_op(F.col(code))
    before = F.max(F.when(F.col(code).isin(1, 3), F.col(image)))
    after = F.max(F.when(F.col(code).isin(2, 4), F.col(image)))
    return rows.groupBy(*keys, lsn, kind.alias("op_type")).agg(before.alias("before"), after.alias("after"))


def polled(rows: DataFrame, low: str, high: str, most: int, lsn: str = "lsn", tie: Sequence[str] = ()) -> DataFrame:
    """Change rows in (low, high], the first `most` by position and all others at the last position taken."""
    inside = rows.filter((F.col(lsn) > low) & (F.col(lsn) <= high))
    last = inside.orderBy(lsn, *tie).limit(most).agg(F.max(lsn).alias("__last"))
    return inside.join(F.broadcast(last), F.col(lsn) <= F.col("__last")).drop("__last")  # one row


def parsed(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Rows of valid JSON objects; others come out with ok = false and no fields."""
    got = F.from_json(column, schema, {"mode": "PERMISSIVE"})
    return lines.withColumn("event", got).withColumn("ok", F.col("event").isNotNull() & F.coalesce(F.col(f"event.{schema.fieldNames()[0]}").isNotNull(), F.lit(False)))


def masked(image: Column, fields: Sequence[str]) -> Column:
    """A map with the values of these keys replaced, null values too."""
    return F.transform_values(image, lambda k, v: F.when(k.isin(list(fields)), F.lit(MASK)).otherwise(v))


def masked_columns(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.withColumns({f: F.lit(MASK) for f in fields if f in df.columns})


def utc_text(instant: Column, fraction: Column) -> Column:
    """An instant as UTC with Z, whatever the session's zone; fraction: the text of its part of a second."""
    seconds = F.floor(F.unix_micros(instant) / 1_000_000)
    of_day = F.pmod(seconds, F.lit(86_400))
    two = lambda n: F.lpad(n.cast("bigint").cast("string"), 2, "0")
    day = F.date_from_unix_date(F.floor(seconds / 86_400).cast("int")).cast("string")
    return F.concat(day, F.lit("T"), two(F.floor(of_day / 3_600)), F.lit(":"), two(F.floor(of_day / 60) % 60), F.lit(":"), two(of_day % 60), fraction, F.lit("Z"))


def as_text(column: Column, kind: str) -> Column:
    """A value as the operational store keeps it: text, with true and false, whole numbers exact, and UTC times with
    the fraction of a second that they have, without trailing zeros (RFC 3339). A time without a zone (timestamp_ntz) is UTC."""
    if kind == "timestamp":
        micros = F.pmod(F.unix_micros(column), F.lit(1_000_000)).cast("string")
        return utc_text(column, F.regexp_replace(F.concat(F.lit("."), F.lpad(micros, 6, "0")), r"\.?0+$", ""))
    if kind == "timestamp_ntz":
        fraction = F.regexp_replace(F.date_format(column, ".SSSSSS"), r"\.?0+$", "")
        return F.concat(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))
    if kind == "binary":
        return F.decode(column, "UTF-8")
    return column.cast("string")


def from_row_events(rows: DataFrame) -> DataFrame:
    """Change events of row events (op_type, keys: names of key columns, rows: images): an insert or delete for each image, an
    update for each pair of images, before and after. row_seq numbers the events of one row event. Keys are
    taken from the image after, or before for deletes; a last image without its pair is left out."""
    pairs = "transform(sequence(0, size(rows) div 2 - 1), i -> struct(rows[2 * i] as before, rows[2 * i + 1] as after))"
    single = "transform(rows, r -> struct(if(op_type = 'DELETE', r, null) as before, if(op_type = 'DELETE', null, r) as after))"
    none = "cast(array() as array<struct<before: map<string, string>, after: map<string, string>>>)"
    images = F.expr(f"case when op_type = 'UPDATE' then if(size(rows) < 2, {none}, {pairs}) else {single} end")
    flat = rows.select(*[c for c in rows.columns if c not in ("rows", "keys")], "keys", F.posexplode(images).alias("row_seq", "__image"))
    image = F.coalesce("__image.after", "__image.before")
    named = F.map_filter(image, lambda k, v: F.array_contains("keys", k))
    return flat.withColumns({"primary_keys": named, "before": F.col("__image.before"), "after": F.col("__image.after")}).drop("__image", "keys")


def with_event_id(events: DataFrame) -> DataFrame:
    """A random id for each event; the idempotency key, not this id, tells that two are the same change."""
    return events.withColumn("event_id", F.uuid())


def lsn_bounds(rows: DataFrame, lsn: str = "lsn") -> DataFrame:
    """The lowest and the highest position, which are hexadecimal texts of one width."""
    return rows.agg(F.min(lsn).alias("min_lsn"), F.max(lsn).alias("max_lsn"))


def key_columns(constraints: DataFrame, usage: DataFrame) -> DataFrame:
    """The key columns of every table, sorted, from the catalog's constraints (table_schema, table_name, constraint_name, constraint_type) and their columns."""
    keys = constraints.filter("constraint_type = 'PRIMARY KEY'").select("table_schema", "table_name", "constraint_name")
    found = keys.join(usage.select("constraint_name", "column_name"), "constraint_name")
    return found.groupBy("table_schema", "table_name").agg(F.array_sort(F.collect_set("column_name")).alias("key_columns"))


def guessed_key(columns: Sequence[str]) -> list[str]:
    """Without a catalog: the column id, or columns that end in _id, or else all."""
    found = [c for c in columns if c == "id"] or [c for c in columns if c.endswith("_id")]
    return sorted(found or columns)


def image_columns(events: DataFrame, *images: str) -> list[str]:
    """All column names that occur in the images, sorted: the columns of a target table that does not exist yet."""
    names = F.array_union(*[F.map_keys(F.coalesce(F.col(i), F.create_map().cast("map<string,string>"))) for i in images]) if len(images) == 2 else F.map_keys(images[0])
    return sorted(r.c for r in events.select(F.explode(names).alias("c")).distinct().collect())  # one for each column


def as_table(state: DataFrame, columns: Sequence[str], image: str = "image") -> DataFrame:
    """A table of text columns from the images of a state."""
    return state.select(*[F.col(image)[c].alias(c) for c in columns])


def canonical(entries: Column) -> Column:
    """JSON of a map with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(entries))))


def idempotency_key(source: Column, table: Column, op: Column, keys: Column, file: Column, pos: Column, seq: Column) -> Column:
    """SHA-256 over what identifies a change; the row's sequence tells changes at one position apart."""
    return F.sha2(F.concat_ws("|", source, table, op, canonical(keys), file, pos.cast("string"), seq.cast("string")), 256)


def event_key(events: DataFrame) -> Column:
    """The idempotency key of events of any kind of source: with the log sequence number, which is one of its database, and the
    transaction where there are such."""
    c = F.col
    lsn = F.when(c("lsn").isNotNull(), F.concat_ws("/", F.lit("lsn"), F.coalesce("database", F.lit("")), "lsn"))
    txn = F.when(c("txn_id").isNotNull(), F.concat_ws("/", F.lit("txn"), "txn_id"))
    return F.sha2(F.concat_ws("|", "source_id", "table", "op_type", canonical(c("primary_keys")), "binlog_file", c("binlog_pos").cast("string"), c("row_seq").cast("string"), lsn, txn), 256)


def partition_key(keys: Column, field: Column | str | None = None) -> Column:
    """The value of the configured key field, if the keys have it, or else of the first key by name."""
    first = F.get(F.array_sort(F.map_entries(keys)), 0)["value"]
    if field is None:
        return first
    name = F.lit(field) if isinstance(field, str) else field
    return F.coalesce(F.when(F.try_element_at(keys, name) != "", F.try_element_at(keys, name)), first)


def routed(events: DataFrame, routes: DataFrame) -> DataFrame:
    """Events with topic and key: those of the route of their source and table, or topic by database and table.

    routes: source_id, table, topic, partition_key_field; one row for each table, so they are broadcast.
    """
    table = routes.select("source_id", "table", F.col("topic").alias("__topic"), F.col("partition_key_field").alias("__field"))
    out = events.join(F.broadcast(table), ["source_id", "table"], "left")
    key = F.when(F.col("__field").isNotNull(), partition_key(F.col("primary_keys"), F.col("__field"))).otherwise(partition_key(F.col("primary_keys")))
    return out.withColumn("topic", F.coalesce("__topic", topic(F.col("database"), F.col("table")))).withColumn("key", key).drop("__topic", "__field")


def topic(source: Column, table: Column) -> Column:
    return F.format_string("cdc.%s.%s", source, table)


def target_table(database: Column, table: Column) -> Column:
    return F.concat_ws("_", F.lit("ods"), F.lower(database), F.lower(table))


def incremental(df: DataFrame, at: str, key: str, since: tuple, most: int) -> DataFrame:
    """The next rows after a compound watermark, so that equal times across a cut are read once."""
    ts, last = since
    return df.filter((F.col(at) > ts) | ((F.col(at) == ts) & (F.col(key) > last))).orderBy(at, key).limit(most)


def grown_schema(rows: DataFrame, image: str = "image") -> T.StructType:
    """The columns that the images (VARIANT objects) of all rows have, with the narrowest types that hold all of their values.

    A pass over the images that shuffles one schema a task. Fields whose values are all null or that never agree are text.
    """
    found = rows.agg(F.schema_of_variant_agg(F.when(F.typeof(F.col(image)) == "variant", F.col(image)))).first()[0]
    kind = T._parse_datatype_string(found.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING").replace("VARIANT", "STRING")) if found and found.startswith("OBJECT<") else None
    return kind if isinstance(kind, T.StructType) else T.StructType([])


def merged_schema(held: T.StructType, new: T.StructType) -> T.StructType:
    """The columns held, in their order, and then new ones; a column whose type has changed is widened, or else text."""
    numbers = ("decimal", "bigint", "double")

    def wider(a: T.DataType, b: T.DataType) -> T.DataType:
        if a == b:
            return a
        if isinstance(a, T.StructType) and isinstance(b, T.StructType):
            return merged_schema(a, b)
        if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
            return T.ArrayType(wider(a.elementType, b.elementType))
        return T.DoubleType() if a.typeName().replace("long", "bigint") in numbers and b.typeName().replace("long", "bigint") in numbers else T.StringType()

    known = {f.name: f.dataType for f in held}
    late = {f.name: f.dataType for f in new}
    return T.StructType([T.StructField(n, wider(t, late[n]) if n in late else t) for n, t in known.items()] + [T.StructField(n, t) for n, t in late.items() if n not in known])


def as_typed(rows: DataFrame, schema: T.StructType, image: str = "image") -> DataFrame:
    """Images as columns of a schema; what an image lacks or what does not fit is null."""
    typed = [F.try_variant_get(F.col(image), f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in schema]
    return rows.select(*[c for c in rows.columns if c != image and c not in schema.fieldNames()], *typed)
