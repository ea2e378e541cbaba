"""Identity resolution and access control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Weights of the demographic score in tenths, and the least score that counts as a match.
NAME, NAME_PART, GENDER, BIRTH, LEAST = 4, 2, 2, 4, 4

#: The access policies (role, resources, departments, fields).
POLICIES = [
    ("role_admin", ["Patient", "Encounter", "MedicationRequest", "DiagnosticReport", "Observation"], ["*"], ["*"]),
    ("role_doctor", ["Patient", "Encounter", "MedicationRequest", "DiagnosticReport", "Observation"], ["$own"], ["*"]),
    ("role_nurse", ["Patient", "Encounter", "MedicationRequest"], ["$own"], ["identifier", "name", "gender", "birthDate", "class", "period", "medication", "dosage"]),
    ("role_lab_tech", ["Patient", "DiagnosticReport", "Observation"], ["*"], ["identifier", "name", "code", "value", "unit", "referenceRange", "status"]),
]


def by_identifier(records: DataFrame, index: DataFrame, system: str, key: str) -> DataFrame:
    """Records with the master id of (system, key); those without one keep null."""
    flat = index.select("empi_id", F.explode("identifiers").alias("i")).filter(F.col("i.system") == system)
    return records.join(flat.select(F.col("i.value").alias(key), "empi_id"), key, "left")


def by_master_id(index: DataFrame, empi_id: str) -> DataFrame:
    return index.filter(F.col("empi_id") == empi_id)


def match_score(name: Column, gender: Column, birth: Column, p_name: Column, p_gender: Column, p_birth: Column) -> Column:
    """Tenths: equal or contained name, gender, birth date. What is empty on either side does not count."""
    name, gender, birth, p_name, p_gender, p_birth = (F.nullif(c, F.lit("")) for c in (name, gender, birth, p_name, p_gender, p_birth))
    part = p_name.contains(name) | name.contains(p_name)
    points = lambda ok, n: F.when(ok, n).otherwise(0)
    return F.when(name == p_name, NAME).when(part, NAME_PART).otherwise(0) + points(gender == p_gender, GENDER) + points(birth == p_birth, BIRTH)


#: Letters of a name, at most, by which contained names meet.
HEAD = 32


def _pieces(long: DataFrame, l_name: str, widths: DataFrame) -> DataFrame:
    """Names with their pieces (`__piece`) of the given lengths that are shorter than the name. widths: one row, of HEAD lengths at most."""
    each = f"transform(filter(__widths, w -> w < length({l_name})), w -> transform(sequence(1, length({l_name}) - w + 1), i -> substring({l_name}, i, w)))"
    return long.crossJoin(F.broadcast(widths)).withColumn("__piece", F.explode(F.expr(f"array_distinct(flatten({each}))"))).drop("__widths")


def _inside(short: DataFrame, s_name: str, s_gender: str, long: DataFrame, l_name: str, l_gender: str) -> DataFrame:
    """Pairs of equal gender where the one name is in the other, longer one.

    The shorter name meets the equal pieces of the longer one, which is cut into pieces of such lengths only as shorter names have. So
    whoever meets is a match, but for names of more than HEAD letters, which meet by the first HEAD of them.
    """
    own = short.filter(f"length({s_name}) > 0").withColumn("__head", F.substring(s_name, 1, HEAD))
    spread = _pieces(long, l_name, own.agg(F.collect_set(F.length("__head")).alias("__widths")))
    met = (F.col("__head") == F.col("__piece")) & (F.col(s_gender) == F.col(l_gender)) & (F.length(s_name) < F.length(l_name)) & F.col(l_name).contains(F.col(s_name))
    return own.join(spread, met).drop("__head", "__piece")


def fuzzy(queries: DataFrame, persons: DataFrame) -> DataFrame:
    """Matches of queries (query_id, q_name, q_gender, q_birth) with persons, scored in tenths and above 3.

    No pair reaches the limit without an equal birth date, an equal name, or a contained name and an equal
    gender. All three are equi-joins: for the last, the shorter name meets a piece of the longer one, so a name gives at most
    HEAD rows for each of its letters, and none where no name is shorter. Persons of a query's birth date are matches by definition, so
    they are all in the result. Empty values are as missing ones.
    """
    said = lambda c: F.nullif(F.col(c), F.lit(""))
    p = persons.select("empi_id", said("name").alias("p_name"), said("gender").alias("p_gender"), said("birth_date").alias("p_birth"))
    q = queries.select("query_id", *[said(c).alias(c) for c in ("q_name", "q_gender", "q_birth")])
    pairs = q.join(p, F.col("q_birth") == F.col("p_birth")).unionByName(q.join(p, F.col("q_name") == F.col("p_name")))
    pairs = pairs.unionByName(_inside(q, "q_name", "q_gender", p, "p_name", "p_gender")).unionByName(_inside(p, "p_name", "p_gender", q, "q_name", "q_gender"))
    score = match_score(F.col("q_name"), F.col("q_gender"), F.col("q_birth"), F.col("p_name"), F.col("p_gender"), F.col("p_birth"))
    return pairs.withColumn("score", score).filter(F.col("score") >= LEAST).select("query_id", "empi_id", "score").distinct()


def ranked(queries: DataFrame, persons: DataFrame) -> DataFrame:
    """fuzzy() with the person's name and the rank of the match for its query: by score, then by id."""
    named = fuzzy(queries, persons).join(persons.select("empi_id", "name"), "empi_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "empi_id"))
    return named.select("query_id", "empi_id", "name", "score", rank.alias("rank"))


#: The users (id, user name, name, role, department).
USERS = [
    ("U001", "doctor_zhang", "张医生", "role_doctor", "心内科"),
    ("U002", "nurse_li", "李护士", "role_nurse", "心内科"),
    ("U003", "lab_wang", "王技师", "role_lab_tech", "检验科"),
    ("U004", "admin", "系统管理员", "role_admin", "信息科"),
]


def users(spark) -> DataFrame:
    """The users as stored, with a digest of their password."""
    rows = spark.createDataFrame(USERS, "user_id string, username string, name string, role string, department string")
    return rows.withColumn("password", F.sha2(F.concat("user_id", "username"), 256))


def listed(users: DataFrame) -> DataFrame:
    """Users for a list: everything but the password."""
    return users.drop("password")


def policies(spark) -> DataFrame:
    return spark.createDataFrame(POLICIES, "role string, resources array<string>, departments array<string>, fields array<string>")


def check(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """Requests (role, resource, own_dept, dept) with allowed. A missing department denies roles bound to their own.

    rules: one row for each role, a handful, so they are broadcast.
    """
    joined = requests.join(F.broadcast(rules), "role", "left")
    has = lambda a, v: F.coalesce(F.array_contains(a, v), F.lit(False))
    resource = has("resources", F.col("resource")) | has("resources", "*")
    dept = has("departments", "*") | (has("departments", "$own") & F.coalesce(F.col("dept") == F.col("own_dept"), F.lit(False)))
    return joined.withColumn("allowed", resource & dept).drop("resources", "departments", "fields")


def visible(resource: DataFrame, fields: list[str], always: tuple[str, ...] = ("resourceType", "id")) -> DataFrame:
    """The fields of a resource that a role may see; * is all."""
    if "*" in fields:
        return resource
    return resource.select(*[c for c in resource.columns if c in always or c in fields])


def projected(resources: DataFrame, role: str, rules: DataFrame, always: tuple[str, ...] = ("resourceType", "id")) -> DataFrame:
    """Resources (one column for each field, and the column `role`) as JSON with the fields that the role of each row may see.

    rules: role, fields; one row for each role, a handful, so they are broadcast. A role without a rule sees nothing: json is null.
    """
    held = resources.join(F.broadcast(rules.select(F.col("role").alias("__role"), F.col("fields").alias("__fields"))), F.col(role) == F.col("__role"), "left")
    may = lambda c: F.array_contains("__fields", c) | F.array_contains("__fields", "*")
    shown = [F.col(f"`{c}`") if c in always else F.when(may(c), F.col(f"`{c}`")).alias(c) for c in resources.columns if c != role]
    return held.withColumn("json", F.when(F.col("__fields").isNotNull(), F.to_json(F.struct(*shown)))).drop("__role", "__fields")
