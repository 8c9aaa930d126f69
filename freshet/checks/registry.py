"""Registration of checks: a Spark query and the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from freshet.functions.missing import KEEP, RatioPolicy

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key], SQL[key] = fn, sql
        return fn

    return add


def sql_quotient(n: str, d: str) -> str:
    return (
        f"CASE WHEN {n} IS NULL OR {d} IS NULL THEN NULL WHEN {d} = 0 THEN "
        f"CASE WHEN {n} = 0 THEN 'NaN'::DOUBLE WHEN {n} > 0 THEN 'Infinity'::DOUBLE ELSE '-Infinity'::DOUBLE END "
        f"ELSE {n} / {d} END"
    )


def sql_policy(x: str, p: RatioPolicy) -> str:
    """A policy applied to a column that holds the IEEE quotient."""

    def special(v) -> str:
        return x if v == KEEP else "NULL" if v is None else repr(float(v)) + "::DOUBLE"

    value = x if p.digits is None else f"CASE WHEN isfinite({x}) THEN round({x}, {p.digits}) ELSE {x} END"
    capped = value if p.cap is None else f"CASE WHEN {value} > {p.cap} THEN {p.cap}::DOUBLE ELSE {value} END"
    out = (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN {special(p.on_nan)} "
        f"WHEN {x} = 'Infinity'::DOUBLE THEN {special(p.on_inf)} "
        f"WHEN {x} = '-Infinity'::DOUBLE THEN {special(p.on_neg_inf)} ELSE {capped} END"
    )
    return out if p.on_null is None else f"coalesce({out}, {float(p.on_null)!r}::DOUBLE)"


def sql_finite(x: str) -> str:
    return f"CASE WHEN isfinite({x}) THEN {x} END"


def sql_kind(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN 'missing' WHEN isnan({x}) THEN 'nan' WHEN {x} = 'Infinity'::DOUBLE THEN 'inf' "
        f"WHEN {x} = '-Infinity'::DOUBLE THEN '-inf' ELSE 'finite' END"
    )
