"""Declarative mapping rules, compiled to one nested column for each resource.

A rule is (path, kind, field, detail). Kinds: constant (detail: value), direct (detail: transform or none),
mapping (detail: values and default), template (detail: text with {value}), conditional (detail: values for
null and not null). Paths nest with dots and [n]. A null leaf creates no path: structs whose leaves are all
null are null, and arrays hold only elements that are not null.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from clinlake.operators import changes

CDC = "urn:hospital:data-platform:cdc"
#: The rules of the four resources.
RULES: dict[str, list[tuple]] = {
    "Patient": [
        ("resourceType", "constant", None, "Patient"),
        ("id", "direct", "patient_id", "toString"),
        ("identifier[0].system", "constant", None, "urn:hospital:his:patient-id"),
        ("identifier[0].value", "direct", "patient_id", "toString"),
        ("identifier[1].system", "constant", None, "urn:hospital:empi"),
        ("identifier[1].value", "direct", "_empi_id", None),
        ("name[0].use", "constant", None, "official"),
        ("name[0].text", "direct", "name", None),
        ("gender", "mapping", "gender", ({"M": "male", "F": "female", "男": "male", "女": "female", "male": "male", "female": "female"}, "unknown")),
        ("birthDate", "direct", "birth_date", "toDateString"),
        ("address[0].use", "constant", None, "home"),
        ("address[0].text", "direct", "address", None),
        ("meta.lastUpdated", "direct", "created_at", "toISOString"),
        ("meta.source", "constant", None, CDC),
    ],
    "Encounter": [
        ("resourceType", "constant", None, "Encounter"),
        ("id", "direct", "visit_id", "toString"),
        ("identifier[0].system", "constant", None, "urn:hospital:his:visit-id"),
        ("identifier[0].value", "direct", "visit_id", "toString"),
        ("status", "conditional", "discharge_time", ("in-progress", "finished")),
        ("class.system", "constant", None, "http://terminology.hl7.org/CodeSystem/v3-ActCode"),
        ("class.code", "mapping", "visit_type", ({"门诊": "AMB", "急诊": "EMER", "住院": "IMP", "outpatient": "AMB", "emergency": "EMER", "inpatient": "IMP"}, "AMB")),
        ("class.display", "direct", "visit_type", None),
        ("subject.reference", "template", "patient_id", "Patient/{value}"),
        ("participant[0].individual.display", "direct", "doctor", None),
        ("period.start", "direct", "admit_time", "toISOString"),
        ("period.end", "direct", "discharge_time", "toISOString"),
        ("reasonCode[0].text", "direct", "diagnosis", None),
        ("serviceProvider.display", "direct", "dept", None),
        ("meta.source", "constant", None, CDC),
    ],
    "MedicationRequest": [
        ("resourceType", "constant", None, "MedicationRequest"),
        ("id", "direct", "order_id", "toString"),
        ("identifier[0].system", "constant", None, "urn:hospital:his:order-id"),
        ("identifier[0].value", "direct", "order_id", "toString"),
        ("status", "mapping", "status", ({"已执行": "completed", "待执行": "active", "已取消": "cancelled", "executed": "completed", "pending": "active", "cancelled": "cancelled"}, "unknown")),
        ("intent", "constant", None, "order"),
        ("medicationCodeableConcept.text", "direct", "drug_name", None),
        ("subject.reference", "template", "patient_id", "Patient/{value}"),
        ("encounter.reference", "template", "visit_id", "Encounter/{value}"),
        ("requester.display", "direct", "doctor", None),
        ("authoredOn", "direct", "order_time", "toISOString"),
        ("dosageInstruction[0].text", "direct", "dosage", None),
        ("dosageInstruction[0].timing.code.text", "direct", "frequency", None),
        ("dosageInstruction[0].route.text", "direct", "route", None),
        ("meta.source", "constant", None, CDC),
    ],
    "DiagnosticReport": [
        ("resourceType", "constant", None, "DiagnosticReport"),
        ("id", "direct", "result_id", "toString"),
        ("identifier[0].system", "constant", None, "urn:hospital:lis:result-id"),
        ("identifier[0].value", "direct", "result_id", "toString"),
        ("status", "constant", None, "final"),
        ("category[0].coding[0].system", "constant", None, "http://terminology.hl7.org/CodeSystem/v2-0074"),
        ("category[0].coding[0].code", "constant", None, "LAB"),
        ("code.coding[0].code", "direct", "item_code", None),
        ("code.coding[0].display", "direct", "item_name", None),
        ("subject.reference", "template", "patient_id", "Patient/{value}"),
        ("encounter.reference", "template", "visit_id", "Encounter/{value}"),
        ("effectiveDateTime", "direct", "result_time", "toISOString"),
        ("result[0].display", "direct", "item_name", None),
        ("conclusion", "mapping", "is_abnormal", ({"1": "异常", "0": "正常", "true": "异常", "false": "正常"}, "未知")),
        ("meta.source", "constant", None, CDC),
    ],
}


def _transform(value: Column, name: str | None, timed: bool = False) -> Column:
    """timed: the value is a timestamp already, not a text."""
    text = value.cast("string")
    if name == "toISOString" and timed:
        # As a time of UTC without a zone, whose text is the same in any session; short code, as one plan may hold many such times.
        micros = F.unix_micros(value)
        shown = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.expr("interval '0.000001' second") * micros
        millis = F.lpad(F.floor(F.pmod(micros, F.lit(1_000_000)) / 1_000).cast("string"), 3, "0")
        made = F.concat(F.translate(F.substring_index(shown.cast("string"), ".", 1), " ", "T"), F.lit("."), millis, F.lit("Z"))
        return F.when(F.year(value) > 9999, text).otherwise(made)  # such years have a + in their text
    if name == "toISOString":
        # Texts that name their zone stay as they are, and so do those that are no times.
        at = text.try_cast("timestamp")
        millis = F.lpad(F.floor(F.pmod(F.unix_micros(at), F.lit(1_000_000)) / 1_000).cast("string"), 3, "0")
        made = changes.utc_text(at, F.concat(F.lit("."), millis))
        return F.when(text.endswith("Z") | text.contains("+"), text).otherwise(F.coalesce(made, text))
    if name == "toDateString":
        return F.substring_index(F.substring_index(text, "T", 1), " ", 1)
    if name == "toNumber":
        # A JSON number: whole ones without a fraction; what is no number is null.
        number = F.trim(text).try_cast("double")
        whole = (number == F.floor(number)) & (F.abs(number) < 1e18)
        return F.try_parse_json(F.when(whole, number.cast("bigint").cast("string")).otherwise(F.when(~F.isnan(number), number.cast("string"))))
    return text


def leaf(rule: tuple, columns: Collection[str], get: Callable[[str], Column] | None = None, timed: Collection[str] = ()) -> Column:
    """The value of one rule, as text; a field that the table lacks is null. get: a field's column, by its name; timed: fields that are timestamps."""
    _, kind, field, detail = rule
    if kind not in ("constant", "direct", "mapping", "template", "conditional"):
        raise ValueError(f"unknown kind of rule: {kind}")
    if kind == "constant":
        return F.lit(detail)
    if field not in columns:
        return F.lit(detail[0]) if kind == "conditional" else F.lit(None).cast("string")
    value = F.col(f"`{field}`") if get is None else get(field)
    if kind == "direct":
        return _transform(value, detail, field in timed)
    if kind == "mapping":
        table, default = detail
        known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
        text = value.cast("string")
        return F.when(text.isNotNull(), F.coalesce(F.try_element_at(known, text), F.lit(default) if default else text))
    if kind == "template":
        head, _, tail = detail.partition("{value}")
        return F.when(value.isNotNull(), F.concat(F.lit(head), value.cast("string"), F.lit(tail)))
    return F.when(value.isNull(), F.lit(detail[0])).otherwise(F.lit(detail[1]))


def _tree(rules: list[tuple], columns: Collection[str], get: Callable[[str], Column] | None = None, timed: Collection[str] = ()) -> dict:
    root: dict = {}
    for rule in rules:
        steps = [int(s) if s.isdigit() else s for s in re.findall(r"[^.\[\]]+", rule[0])]
        at = root
        for step in steps[:-1]:
            at = at.setdefault(step, {})
        at[steps[-1]] = leaf(rule, columns, get, timed)
    return root


def _column(tree, leaves: list[Column]) -> Column:
    if not isinstance(tree, dict):
        leaves.append(tree)
        return tree
    mine: list[Column] = []
    parts = {k: _column(v, mine) for k, v in tree.items()}
    leaves += mine
    if all(isinstance(k, int) for k in tree):
        # Elements of an array may have different fields; as JSON text they share one type until to_json at the end.
        names = list(dict.fromkeys(f for v in tree.values() for f in v))
        items = []
        for k in sorted(tree):
            own: list[Column] = []
            fields = {f: _column(tree[k][f], own) if f in tree[k] else F.lit(None).cast("string") for f in names}
            items.append(F.when(F.coalesce(*own).isNotNull(), F.struct(*[c.alias(f) for f, c in fields.items()])))
        held = F.filter(F.array(*items), lambda x: x.isNotNull())
        return F.when(F.size(held) > 0, held)
    return F.when(F.coalesce(*mine).isNotNull(), F.struct(*[c.alias(k) for k, c in parts.items()]))


def compiled(resource: str, columns: Collection[str], rules: dict[str, list[tuple]] | None = None, get: Callable[[str], Column] | None = None, timed: Collection[str] = ()) -> list[Column]:
    """The top-level fields of a resource."""
    known = RULES if rules is None else rules
    if resource not in known:
        raise ValueError(f"no rules for {resource}")
    return [_column(v, []).alias(k) for k, v in _tree(known[resource], columns, get, timed).items()]


def to_resource(df: DataFrame, resource: str, rules: dict[str, list[tuple]] | None = None) -> DataFrame:
    return df.select(*compiled(resource, df.columns, rules, timed=timestamps(df)))


def timestamps(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, TimestampType)]


def used(df: DataFrame, resource: str) -> list[str]:
    """The columns that the rules of a resource read."""
    fields = {rule[2] for rule in RULES[resource]}
    return [c for c in df.columns if c in fields]


def to_json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))


def _file(resource: str) -> str:
    return re.sub(r"(?<!^)(?=[A-Z])", "_", resource).lower() + ".json"


class Registry:
    """Rules by resource: list, get, update, reset, files, and a test run on given rows."""

    def __init__(self):
        self.rules = {k: list(v) for k, v in RULES.items()}

    def names(self) -> list[str]:
        return sorted(self.rules)

    def get(self, resource: str) -> list[tuple]:
        return self.rules[resource]

    def update(self, resource: str, rules: list[tuple]) -> None:
        for rule in rules:
            leaf(rule, [])
        self.rules[resource] = list(rules)

    def reset(self) -> None:
        self.__init__()

    def save(self, folder: str) -> None:
        """One file for each resource, in snake case, on the driver."""
        os.makedirs(folder, exist_ok=True)
        for resource, rules in self.rules.items():
            with open(os.path.join(folder, _file(resource)), "w", encoding="utf-8") as file:
                json.dump({"resourceType": resource, "mappingRules": [dict(zip(("fhirPath", "type", "sourceField", "detail"), r)) for r in rules]}, file, ensure_ascii=False, indent=1)

    def load(self, folder: str) -> None:
        """Rules from the files of save(); resources without a file keep theirs, and a wrong file changes nothing."""
        new = {}
        for name in sorted(os.listdir(folder)):
            if name.endswith(".json"):
                with open(os.path.join(folder, name), encoding="utf-8") as file:
                    spec = json.load(file)
                tuples = [(r["fhirPath"], r["type"], r["sourceField"], tuple(r["detail"]) if isinstance(r["detail"], list) else r["detail"]) for r in spec["mappingRules"]]
                for rule in tuples:
                    leaf(rule, [])
                new[spec["resourceType"]] = tuples
        self.rules.update(new)

    def transform(self, df: DataFrame, resource: str) -> DataFrame:
        return to_resource(df, resource, self.rules)
