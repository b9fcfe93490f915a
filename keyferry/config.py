"""Run settings from a config file (YAML or JSON), in the shape migration
configs commonly have:

* ``table_mappings``: list of ``source_table`` / ``target_table`` /
  ``partition_key`` / ``clustering_keys`` (plus our optional ``source_key``,
  ``order_by``, ``buckets``, ``split_column``, ``num_partitions``);
* ``optimization``: fields of ``PlanSettings`` (``enable_repartition``,
  ``enable_cache``, ``repartition_threshold``, ``target_partitions``,
  ``rows_per_partition``, ...);
* ``write_options``: ``mode`` and ``confirm.truncate``; other keys pass through;
* a source section holding ``jdbc_url`` (a template filled from ``host``,
  ``port``, ``database`` and the ``connection`` entries), ``username``,
  ``password``, ``driver``, and a ``tables`` list whose ``primary_key`` becomes
  the mappings' ``source_key``.

Values are used as written: nothing is expanded from the environment.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from keyferry.sources.jdbc import DEFAULT_SCHEMA, JdbcConnection, split_table_name, url_from_template
from keyferry.spec import PlanSettings, RunOptions


def load_file(path: str) -> dict:
    with open(path) as f:
        if path.endswith((".yaml", ".yml")):
            import yaml

            return yaml.safe_load(f) or {}
        return json.load(f)


def _flag(v: object) -> bool:
    if isinstance(v, str):
        return v.strip().lower() not in ("false", "no", "off", "0", "")
    return bool(v)


def run_settings(cfg: Mapping) -> tuple[list[dict], PlanSettings, RunOptions]:
    mappings = [dict(m) for m in (cfg.get("table_mappings") or cfg.get("mappings") or [])]
    plan = PlanSettings.from_dict(cfg.get("optimization"))
    wo = dict(cfg.get("write_options") or {})
    options = RunOptions(
        mode=str(wo.pop("mode", "append")),
        confirm_truncate=_flag(wo.pop("confirm.truncate", True)),
        extra=wo,
    )
    return mappings, plan, options


def _source_section(cfg: Mapping) -> Mapping:
    if "jdbc_url" in cfg:
        return cfg
    for v in cfg.values():
        if isinstance(v, Mapping) and "jdbc_url" in v:
            return v
    raise ValueError("no section with a jdbc_url in the source config")


def jdbc_connection(cfg: Mapping) -> JdbcConnection:
    s = _source_section(cfg)
    parts = {k: s[k] for k in ("host", "port", "database") if k in s}
    parts.update(dict(s.get("connection") or {}))
    url = url_from_template(s["jdbc_url"], **parts)
    return JdbcConnection(url, s.get("username") or s.get("user"), s.get("password"), s.get("driver"))


def source_keys(cfg: Mapping) -> dict[str, tuple[str, ...]]:
    """``schema.table`` -> declared primary key columns, from a ``tables``
    list at the top level or inside the source section."""
    tables = cfg.get("tables")
    if tables is None:
        try:
            tables = _source_section(cfg).get("tables")
        except ValueError:
            tables = None
    out = {}
    for t in tables or []:
        pk = t.get("primary_key")
        if not pk:
            continue
        if "schema" in t:
            schema, name = t["schema"], t["name"]
        else:
            schema, name = split_table_name(t["name"])
        out[f"{schema}.{name}"] = (pk,) if isinstance(pk, str) else tuple(pk)
    return out


def attach_source_keys(mappings: list[dict], keys: Mapping[str, tuple[str, ...]]) -> list[dict]:
    """Mappings with ``source_key`` filled from the source's declared keys."""
    out = []
    for m in mappings:
        m = dict(m)
        name = m.get("source_table") or m.get("source") or ""
        schema, table = split_table_name(name)
        if not m.get("source_key") and f"{schema}.{table}" in keys:
            m["source_key"] = list(keys[f"{schema}.{table}"])
        out.append(m)
    return out


def keyspace_settings(cfg: Mapping) -> dict:
    """Replication and durability of the ``keyspace`` section, where given."""
    known = ("replication_strategy", "replication_factor", "durable_writes")
    return {k: _flag(v) if k == "durable_writes" else v for k, v in (cfg.get("keyspace") or {}).items() if k in known}
