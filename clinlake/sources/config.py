"""Settings from YAML or JSON files: sources, masks, routes and pipeline values."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping

#: What holds where neither file nor environment says otherwise.
DEFAULTS = {
    "pipeline.batch_size": 500, "pipeline.batch_timeout_ms": 1000, "pipeline.max_retries": -1, "pipeline.retry_base_delay_ms": 1000, "pipeline.retry_max_delay_ms": 60000,
    "metrics.port": 8000, "log.level": "info", "log.format": "json", "sink.dedup_retention_hours": 168,
}


def _parsed(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if path.endswith(".json"):
        return json.loads(text)
    import yaml

    return yaml.safe_load(text) or {}


def _expanded(value, env: Mapping[str, str]):
    """$NAME and ${NAME} in all texts; names that are not set are empty."""
    if isinstance(value, str):
        return re.sub(r"\$(?:\{(\w+)\}|(\w+))", lambda m: env.get(m[1] or m[2], ""), value)
    if isinstance(value, dict):
        return {k: _expanded(v, env) for k, v in value.items()}
    return [_expanded(v, env) for v in value] if isinstance(value, list) else value


def load(*paths: str, env: Mapping[str, str] | None = None, prefix: str = "CDC") -> dict:
    """The files, later ones over earlier ones by top-level name; then variables such as CDC_PIPELINE_BATCH_SIZE over them."""
    env = os.environ if env is None else env
    out: dict = {}
    for path in paths:
        out |= _parsed(path)
    out = _expanded(out, env)
    for name, default in DEFAULTS.items():
        section, key = name.split(".")
        held = out.setdefault(section, {})
        said = env.get(f"{prefix}_{name.replace('.', '_').upper()}")
        if said is not None:
            held[key] = type(default)(said)
        else:
            held.setdefault(key, default)
    return out


def masks(config: dict) -> dict[str, dict[str, list[str]]]:
    """Masked fields by source and table."""
    return {s["id"]: s.get("mask_fields", {}) for s in config.get("sources", [])}


def routes(config: dict) -> list[tuple[str, str, str, str | None]]:
    """(source_id, table, topic, partition_key_field) of every configured topic."""
    return [(t["source_id"], t["table"], t["topic"], t.get("partition_key_field")) for t in config.get("topics", [])]


def topics(config: dict) -> list[str]:
    """The distinct topics, sorted."""
    return sorted({t["topic"] for t in config.get("topics", [])})
