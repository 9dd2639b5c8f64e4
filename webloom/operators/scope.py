"""The scope grammar: nested all_of / any_of of predicates, compiled to one Column for each stage."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from webloom.errors import ScopeFilterError
from webloom.functions.urls import tld, tld_class

#: Which stage a predicate belongs to; graph metrics always see the whole graph.
STAGE = {
    "language": "classify",
    "tld": "classify",
    "tld_class": "classify",
    "min_language_share": "classify",
    "min_crawls_active": "crawls",
    "min_crawls_language": "crawls",
    "min_referring_domains": "metrics",
    "min_pagerank": "metrics",
}
GROUPS = ("all_of", "any_of")


def _list(value: Any) -> list:
    return list(value) if isinstance(value, (list, tuple, set)) else [value]


def _leaf(key: str, value: Any) -> Column:
    if key == "language":
        return F.col("lang").isin(_list(value))
    if key == "tld":
        return tld(F.col("domain")).isin([str(v).lstrip(".") for v in _list(value)])
    if key == "tld_class":
        return tld_class(F.col("domain")).isin(_list(value))
    column = {"min_language_share": "language_share", "min_crawls_active": "crawls_active", "min_crawls_language": "crawls_language", "min_referring_domains": "referring_domains", "min_pagerank": "pagerank_score"}[key]
    if not isinstance(value, (int, float)) or isinstance(value, bool):
        raise ScopeFilterError(f"{key} needs a number, not {value!r}")
    return F.col(column) >= value


def _entries(node: Any) -> list[tuple[str, Any]]:
    if isinstance(node, dict):
        return list(node.items())
    if isinstance(node, (list, tuple)):
        out = []
        for x in node:
            if not isinstance(x, dict):
                raise ScopeFilterError(f"a scope entry must be a mapping, not {x!r}")
            out += list(x.items())
        return out
    raise ScopeFilterError(f"a scope group must be a list or a mapping, not {node!r}")


def _split(node: Any) -> tuple[Any, list[tuple[str, Any]]]:
    """The node without min_* thresholds, and those thresholds, at any depth: they always hold by AND."""
    kept, floors = [], []
    for key, value in _entries(node):
        if key in GROUPS:
            inner, found = _split(value)
            floors += found
            if inner:
                kept.append({key: inner})
        elif key not in STAGE:
            raise ScopeFilterError(f"unknown scope key {key!r}; known: {', '.join((*GROUPS, *STAGE))}")
        elif key.startswith("min_"):
            floors.append((key, value))
        else:
            kept.append({key: value})
    return kept, floors


def _combine(node: Any, any_of: bool, stage: str | None) -> Column | None:
    parts = []
    for key, value in _entries(node):
        if key in GROUPS:
            part = _combine(value, key == "any_of", stage)
        else:
            part = _leaf(key, value) if stage in (None, STAGE[key]) else None
        if part is not None:
            parts.append(part)
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = (out | p) if any_of else (out & p)
    return out


def compile_scope(scope: Any, stage: str | None = None) -> Column:
    """A boolean Column over domain, lang, language_share, crawls_active, referring_domains, pagerank_score.

    stage limits it to the predicates of one stage (classify, crawls, metrics); a stage without any is
    true. An any_of group belongs to one stage: predicates of other stages inside it are an error.
    """
    kept, floors = _split(scope)
    for key, value in _entries(kept):
        _one_stage(key, value)
    out = _combine(kept, False, stage)
    out = F.lit(True) if out is None else F.coalesce(out, F.lit(False))
    for key, value in floors:
        if stage in (None, STAGE[key]):
            out = out & F.coalesce(_leaf(key, value), F.lit(False))
    return out


def _one_stage(key: str, value: Any) -> set[str]:
    if key not in GROUPS:
        return {STAGE[key]}
    stages = set().union(*[_one_stage(k, v) for k, v in _entries(value)])
    if key == "any_of" and len(stages) > 1:
        raise ScopeFilterError(f"any_of mixes predicates of stages {sorted(stages)}")
    return stages


def subdomain_key(handling: str) -> Column:
    """Grouping key of a page by how subdomains are handled; columns host and domain."""
    if handling == "aggregate":
        return F.col("domain")
    if handling == "include":
        return F.col("host")
    if handling == "root_only":
        bare = F.regexp_replace("host", r"^www\.", "")
        return F.when(bare == F.col("domain"), F.col("domain"))
    raise ScopeFilterError(f"unknown subdomain handling {handling!r}")
