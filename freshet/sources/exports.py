"""Text exports of the models.

Files are read as splittable lines, so a large export is not bound to one task.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.dates import EXPORT_DATE, century_shift, month_end
from freshet.operators.skew import spread_join

#: Stands for a comma inside quotes while a line is split; no text has this control character.
MASK = "\x1f"


def lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines with the file they come from; a byte-order mark and carriage returns go."""
    text = spark.read.text(paths if isinstance(paths, str) else list(paths))
    clean = F.regexp_replace("value", "^﻿|\r$", "")
    return text.select(F.col("_metadata.file_path").alias("file"), clean.alias("line"))


def titled_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: str, key: str, date_format: str = "yyyy-MM-dd"
) -> DataFrame:
    """CSV with title and header lines above the data.

    A line is data when its ``key`` column (a number or a date) parses; titles
    and headers do not. The file of each row is kept.
    """
    options = {"mode": "PERMISSIVE", "dateFormat": date_format}
    parsed = lines(spark, paths).withColumn("row", F.from_csv("line", schema, options))
    return parsed.select("file", "row.*").filter(F.col(key).isNotNull())


def cells(line: Column) -> Column:
    """The cells of a line. A comma inside quotes belongs to its cell, where it
    becomes ``MASK``; quotes go. Takes time in proportion to the line."""
    # Pieces between quotes are outside and inside by turns.
    hidden = F.transform(F.split(line, '"'), lambda s, i: F.when(i % 2 == 1, F.translate(s, ",", MASK)).otherwise(s))
    return F.when(F.contains(line, F.lit('"')), F.split(F.array_join(hidden, ""), ",")).otherwise(F.split(line, ","))


def header_positions(spark: SparkSession, paths: str | Sequence[str], nodes: Sequence[str] | None, name_row: str) -> DataFrame:
    """``(file, wanted)``: one row per name row, with the place and name of each wanted node."""
    first = F.regexp_extract("line", '^\\s*"?\\s*([^",]*?)\\s*"?\\s*,', 1)
    names = F.transform(cells(F.col("line")), lambda c, i: F.struct(i.alias("at"), F.trim(F.translate(c, MASK, ",")).alias("node")))
    chosen = F.filter(names, lambda n: (n["at"] >= 2) & (n["node"] != "" if nodes is None else n["node"].isin(list(nodes))))
    return lines(spark, paths).filter(first == name_row).select("file", chosen.alias("wanted"))


def node_export(
    spark: SparkSession,
    paths: str | Sequence[str],
    nodes: Sequence[str] | None = None,
    first: int | None = None,
    last: int | None = None,
    name_row: str = "B",
    date_format: str = EXPORT_DATE,
) -> DataFrame:
    """Model exports as ``(file, date, node, flow_cfs)``.

    Node names are in the row that starts with ``name_row``; the first column is
    a counter and the second the date; every other row without a date is header.
    A quoted number may have commas between its thousands.
    Files may have different nodes: each file's places of the wanted nodes are
    joined to its rows (a large file's rows are spread), and only those cells are
    taken from a line. Lines outside the window of years are not split.
    """
    # The second cell, read from the front of the line.
    text = F.regexp_extract("line", '^(?:[^",]*|\\s*"[^"]*"\\s*),\\s*"?([^",]*)', 1)
    data = lines(spark, paths).withColumn("date", month_end(F.try_to_date(F.trim(text), date_format)))
    data = data.filter(F.col("date").isNotNull())
    if first is not None:
        data = data.filter(F.year("date") >= first)
    if last is not None:
        data = data.filter(F.year("date") <= last)
    header = header_positions(spark, paths, nodes, name_row)
    # Bound once: the cells would else be split anew for every wanted node.
    picked = F.transform(
        F.array(cells(F.col("line"))),
        lambda c: F.transform("wanted", lambda w: F.struct(w["node"].alias("node"), F.get(c, w["at"]).alias("text"))),
    )
    rows = spread_join(data, header, ["file"], ["line"]).select("file", "date", F.inline(F.get(picked, F.lit(0))))
    number = F.translate("text", MASK, "").try_cast("double")
    return rows.select("file", "date", "node", number.alias("flow_cfs"))


def wide_export(
    wide: DataFrame, date: str, date_format: str, keys: Sequence[str] = (), century: bool = False
) -> DataFrame:
    """A wide frame of text columns in long form, numbers cast, missing values dropped."""
    values = [c for c in wide.columns if c not in (*keys, date)]
    parsed = month_end(F.try_to_date(F.col(date), date_format))
    parsed = century_shift(parsed) if century else parsed
    rows = wide.withColumn(date, parsed).filter(F.col(date).isNotNull())
    long = rows.unpivot([*keys, date], values, "node", "text")
    number = F.expr("try_cast(text AS double)")
    return long.select(*keys, date, "node", number.alias("flow_cfs")).filter(F.col("flow_cfs").isNotNull())


def scenario_of_file(df: DataFrame, scenarios: Mapping[str, str]) -> DataFrame:
    """Scenario by a part of the file path: whole names, so ``N`` is not found in ``N2``."""
    out = F.lit(None).cast("string")
    for part, scenario in scenarios.items():
        whole = rf"(?<![A-Za-z0-9_]){re.escape(part)}(?![A-Za-z0-9_])"
        out = F.when(F.col("file").rlike(whole), F.lit(scenario)).otherwise(out)
    return df.withColumn("scenario", out)
