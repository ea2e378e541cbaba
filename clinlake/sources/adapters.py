"""The clinical domain over the star-schema tables of a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def patients(spark: SparkSession, sf_dir: str, key: int | None = None) -> DataFrame:
    """key: one patient only, as a filter on the stored column, which reaches the files."""
    c = table(spark, sf_dir, "customer")
    c = c if key is None else c.filter(F.col("c_custkey") == key)
    return c.select(
        F.col("c_custkey").cast("string").alias("patient_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
        F.date_add(F.lit("1950-01-01").cast("date"), ((F.col("c_custkey") * 37) % 16000).cast("int")).cast("string").alias("birth_date"),
        F.col("c_mktsegment").alias("address"),
    )


def visits(spark: SparkSession, sf_dir: str, key: int | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    """key, since, until: one visit, or admissions in [since, until), as filters on the stored columns, which reach the files."""
    o = table(spark, sf_dir, "orders")
    o = o if key is None else o.filter(F.col("o_orderkey") == key)
    stored = o.schema["o_orderdate"].dataType
    o = o if since is None else o.filter(F.col("o_orderdate") >= F.lit(since).cast(stored))
    o = o if until is None else o.filter(F.col("o_orderdate") < F.lit(until).cast(stored))
    admit = F.col("o_orderdate").cast("timestamp")
    return o.select(
        F.col("o_orderkey").cast("string").alias("visit_id"),
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.col("o_orderpriority").alias("dept"),
        F.when(F.col("o_orderstatus") == "O", "outpatient").when(F.col("o_orderstatus") == "F", "inpatient").otherwise("emergency").alias("visit_type"),
        admit.alias("admit_time"),
        F.when(F.col("o_orderstatus") != "O", F.timestamp_seconds(F.unix_seconds(admit) + (F.col("o_orderkey") % 240) * 3600)).alias("discharge_time"),
        F.concat(F.lit("D"), (F.col("o_orderkey") % 100).cast("string")).alias("diagnosis"),
    )


def order_id() -> Column:
    """The id of a medication order, from the numbers of its visit and line."""
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


def medication_versions(spark: SparkSession, sf_dir: str, drugs: bool = True) -> DataFrame:
    """Medication orders with all the versions that the table holds. drugs: with the names of drugs, which are in another table."""
    line = table(spark, sf_dir, "lineitem")
    status = F.when(F.col("l_returnflag") == "A", "executed").when(F.col("l_returnflag") == "R", "cancelled").otherwise("pending")
    if drugs:
        line = line.join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return line.select(
        order_id().alias("order_id"),
        F.col("l_orderkey").cast("string").alias("visit_id"),
        *([F.col("p_name").alias("drug_name")] if drugs else []),
        F.col("l_shipdate").cast("timestamp").alias("order_time"),
        status.alias("status"),
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_orderkey", "l_linenumber",
    )


def lab_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("result_id"),
        F.col("user_id").cast("string").alias("patient_id"),
        F.col("event_type").alias("item_code"),
        F.initcap("event_type").alias("item_name"),
        "value",
        (F.col("value") > 50).cast("int").alias("is_abnormal"),
        F.col("ts").cast("timestamp").alias("result_time"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events of a table keyed by user: source, table, op, key, position, sequence, image and time."""
    e = table(spark, sf_dir, "events")
    op = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    image = F.create_map(F.lit("user_id"), F.col("user_id").cast("string"), F.lit("event"), F.col("event_type"), F.lit("props"), F.col("props"))
    return e.select(
        F.lit("his_mysql_01").alias("source_id"), F.lit("his").alias("database"), F.lit("Users").alias("table"), op.alias("op_type"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("primary_keys"),
        F.when(op != "DELETE", image).alias("after"), F.when(op == "DELETE", image).alias("before"),
        F.lit("bin.000001").alias("binlog_file"), F.col("event_id").alias("binlog_pos"), F.lit(0).alias("row_seq"), F.col("ts").cast("timestamp").alias("source_timestamp"),
    )


def mixed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events of three tables in one log, whose primary keys are alike: users of one server and clients of another, each with
    places in log files, and clients of a third, with log sequence numbers only and with repeated changes. n: a number of the change."""
    key = lambda c: F.create_map(F.lit("id"), F.col(c).cast("string"))
    null = lambda kind: F.lit(None).cast(kind)
    users = change_log(spark, sf_dir).withColumns({"primary_keys": F.create_map(F.lit("id"), F.col("primary_keys")["user_id"]), "lsn": null("string"), "n": F.col("binlog_pos")})
    changed = table(spark, sf_dir, "client_changes")
    op = F.when(F.col("op") == "I", "INSERT").when(F.col("op") == "D", "DELETE").otherwise("UPDATE")
    image = F.create_map(F.lit("id"), F.col("client_id").cast("string"), F.lit("event"), F.col("segment"), F.lit("city"), F.col("city"))
    numbered = changed.select(
        F.lit("crm_sqlserver_01").alias("source_id"), F.lit("crm").alias("database"), F.lit("Clients").alias("table"), op.alias("op_type"), key("client_id").alias("primary_keys"),
        F.when(op != "DELETE", image).alias("after"), F.when(op == "DELETE", image).alias("before"), null("string").alias("binlog_file"), null("bigint").alias("binlog_pos"), F.lit(0).alias("row_seq"),
        F.col("valid_at").cast("timestamp").alias("source_timestamp"), F.lpad(F.hex("change_id"), 20, "0").alias("lsn"), F.col("change_id").alias("n"),
    )
    held = table(spark, sf_dir, "clients")
    image = F.create_map(F.lit("id"), F.col("client_id").cast("string"), F.lit("event"), F.col("segment"), F.lit("name"), F.col("name"))
    clients = held.select(
        F.lit("shop_mysql_02").alias("source_id"), F.lit("shop").alias("database"), F.lit("Clients").alias("table"), F.lit("INSERT").alias("op_type"), key("client_id").alias("primary_keys"),
        image.alias("after"), null("map<string,string>").alias("before"), F.lit("bin.000007").alias("binlog_file"), F.col("client_id").alias("binlog_pos"), F.lit(0).alias("row_seq"),
        F.col("updated_at").cast("timestamp").alias("source_timestamp"), null("string").alias("lsn"), F.col("client_id").alias("n"),
    )
    return users.unionByName(numbered).unionByName(clients)


def master_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons with identifiers of one or two source systems."""
    key = F.col("patient_id")
    entry = lambda system, value: F.struct(F.lit(system).alias("system"), value.alias("value"))
    two = F.array(entry("his", key), entry("lis", F.concat(F.lit("L"), key)))
    known = F.when(key.cast("bigint") % 5 != 3, two).otherwise(F.array(entry("his", key)))
    return patients(spark, sf_dir).withColumns({"empi_id": F.concat(F.lit("EMPI-"), F.lpad(key, 8, "0")), "identifiers": known})


def row_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row events of the change log: an update holds the image before, of the user's event before it, and the image after."""
    e = table(spark, sf_dir, "events")
    op = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    image = lambda event: F.create_map(F.lit("user_id"), F.col("user_id").cast("string"), F.lit("event"), event)
    last = F.coalesce(F.lag("event_type").over(Window.partitionBy("user_id").orderBy("event_id")), F.lit("none"))
    return e.select("event_id", op.alias("op_type"), F.array(F.lit("user_id")).alias("keys"), F.when(op == "UPDATE", F.array(image(last), image(F.col("event_type")))).otherwise(F.array(image(F.col("event_type")))).alias("rows"))
