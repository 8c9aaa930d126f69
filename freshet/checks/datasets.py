"""The published datasets over the stand-in runs, against column arithmetic in SQL.

The SQL side spreads the nodes into columns and writes each formula out, which
is a different evaluation from the joined terms on the Spark side.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.checks import views as V
from freshet.checks.registry import check, sql_finite, sql_kind, sql_policy, sql_quotient
from freshet.functions.dates import in_years
from freshet.functions.missing import (
    BYPASS_CAPPED,
    DELTA_NORTH,
    DELTA_SOUTH,
    DIVERTED_CAP_FIRST,
    DIVERTED_CAPPED,
    DIVERTED_ROUNDED,
    DIVERTED_UNCAPPED,
    NATAL,
    PULSE_FILL,
    PULSE_KEEP,
    finite,
    kind,
)
from freshet.functions.units import ACRE_FEET_PER_MONTH_PER_CFS, CMS_PER_CFS, LOWER_MID_REACHES
from freshet.operators import compare as C
from freshet.operators.lookup import splice_by_year
from freshet.operators.reshape import to_wide
from freshet.plans import delta as T
from freshet.plans import disaggregation as G
from freshet.plans import diversions as D
from freshet.plans import flows as P
from freshet.plans import functional as E
from freshet.plans import maps
from freshet.plans.crosswalk import crosswalk

FIRST, LAST = V.YEARS
YEARS = range(FIRST, LAST + 1)
KEYS = ["scenario", "date"]
CMS = f"{CMS_PER_CFS!r}::DOUBLE"
FAMILY_COLUMN = {"calsim2": 1, "calsim3": 2, "action_5": 2}


def _q(node: str) -> str:
    return f'"{node}"'


def _plus(cell, coalesced: bool = False) -> str:
    """Nodes added up as columns; ``coalesced`` sums those that are present."""
    found = maps.nodes(cell) if isinstance(cell, str) else list(cell)
    if not coalesced:
        return "(" + " + ".join(_q(n) for n in found) + ")"
    some = f"coalesce({', '.join(_q(n) for n in found)})"
    return f"(CASE WHEN {some} IS NOT NULL THEN " + " + ".join(f"coalesce({_q(n)}, 0)" for n in found) + " END)"


def _wide(family: str, source: str = "coded") -> str:
    cols = ", ".join(f"max(CASE WHEN node = '{n}' THEN flow_cfs END) AS {_q(n)}" for n in V.family_codes(family))
    return f"wide AS (SELECT scenario, date, {cols} FROM {source} GROUP BY 1, 2)"


def _base(family: str) -> list[str]:
    return [V.coded_flow_sql(family), _wide(family)]


def _per_place(pairs, value: str = "value") -> str:
    """One row per month and place from (place, expression) pairs."""
    return " UNION ALL ".join(
        f"SELECT scenario, date, '{place}' AS place, CAST({expr} AS DOUBLE) AS {value} FROM wide" for place, expr in pairs
    )


def _grid(places) -> str:
    listed = V.values_cte("places", ["place_order", "place"], [(i + 1, p) for i, p in enumerate(places)])
    return listed + f""", grid AS (
  SELECT s.scenario, CAST(p.place_order AS INTEGER) AS place_order, p.place, CAST(m.month AS INTEGER) AS month,
         CAST(y.year AS INTEGER) AS year
  FROM (VALUES ('A'), ('N'), ('R')) s(scenario), places p, range(1, 13) m(month), range({FIRST}, {LAST + 1}) y(year))"""


def _cube(value: str = "s.value") -> str:
    return f"""SELECT g.scenario, g.place_order, g.place, g.month, g.year, {value} AS value
FROM grid g LEFT JOIN series s ON s.scenario = g.scenario AND s.place = g.place AND year(s.date) = g.year
  AND month(s.date) = g.month"""


def _flows(family: str):
    return [(place, _q(node)) for node, place in maps.flow_map(family)]


# --- flows by place ---------------------------------------------------------------------------

_EAST = """SELECT scenario, date, 'Mokelumne River' AS place, other AS flow_cfs FROM coded
LEFT JOIN (SELECT date, flow_cfs AS other FROM second_source WHERE node = '1-URGENT' AND month(date) <> 4) USING (date)
WHERE node = 'C104'"""
_FLOWS_2 = "SELECT * FROM (" + _per_place(_flows("calsim2"), "flow_cfs") + f") WHERE flow_cfs IS NOT NULL UNION ALL {_EAST}"


def _east_side(spark, sf):
    rows = V.second_source(spark, sf).filter((F.col("node") == "1-URGENT") & (F.month("date") != 4))
    return rows.withColumn("node", F.lit(maps.MOKELUMNE_FLOW))


def _flows_2(spark, sf, years=None):
    return P.watershed_flows(V.coded_flow(spark, sf, "calsim2", years), "calsim2", _east_side(spark, sf))


def _flows_3(spark, sf, years=None):
    return P.watershed_flows(V.coded_flow(spark, sf, "calsim3", years), "calsim3")


@check(V.query(_FLOWS_2, *_base("calsim2"), V.SECOND_SOURCE))
def flows_cfs_calsim2(spark, sf):
    return _flows_2(spark, sf)


@check(V.query("SELECT * FROM (" + _per_place(_flows("calsim3"), "flow_cfs") + ") WHERE flow_cfs IS NOT NULL",
               *_base("calsim3")))
def flows_cfs_calsim3(spark, sf):
    return _flows_3(spark, sf)


def _tagged_region(place: str, node: str) -> str:
    if place in maps.LOWER_MID:
        return ""
    return f"SELECT scenario, date, '{place}' AS place, {_q(node)} AS flow_cfs FROM wide WHERE {_q(node)} IS NOT NULL"


_MID = {row[0]: row[2] for row in maps.FLOW_NODES if row[0] in maps.LOWER_MID}
_TAGGED_FLOWS = " UNION ALL ".join(filter(None, (_tagged_region(r[0], r[2]) for r in maps.FLOW_NODES))) + (
    f" UNION ALL SELECT scenario, date, 'Lower-mid Sacramento River', {LOWER_MID_REACHES[0]!r}::DOUBLE * "
    f"{_q(_MID[maps.LOWER_MID[0]])} + {LOWER_MID_REACHES[1]!r}::DOUBLE * {_q(_MID[maps.LOWER_MID[1]])} FROM wide "
    f"WHERE coalesce({', '.join(_q(n) for n in _MID.values())}) IS NOT NULL"
)


@check(V.query(_TAGGED_FLOWS, *_base("action_5")))
def flows_cfs_action_5(spark, sf):
    return P.region_flows(V.tagged_flow(spark, sf))


_LONG_2 = f"flows AS ({_FLOWS_2})"
_TEMPLATES = {
    river: V.values_cte(name, ["wet", "month", "new_cfs"], [
        (r[1] == "Wet", m + 1, float(v)) for r in maps.TEMPLATES if r[0] == river and r[2] == "proposed"
        for m, v in enumerate(maps.nodes(r[3]))
    ])
    for river, name in (("Sacramento", "sac"), ("San Joaquin", "sjr"))
}
_NEW = """new_{0} AS (SELECT last_day(make_date(CAST(y.year AS BIGINT), CAST(t.month AS BIGINT), 1)) AS date,
  t.new_cfs::DOUBLE / 20 AS new_cfs FROM year_types y JOIN {0} t ON t.wet = (y.year_type IN ('Wet', 'Above Normal'))
  WHERE y.location = '1-URGENT' AND y.year < 2001)"""
_REACH_LIST = ", ".join(f"'{r}'" for r in maps.DELTA_REACHES)
_PLACE_LIST = V.values_cte("flow_places", ["place"], [(p,) for p in P.FLOW_PLACES])
_EFF = f"""SELECT 'eff' AS scenario, m.date, m.place, CASE WHEN m.place = 'Upper Sacramento River' THEN a.new_cfs
  WHEN m.place = 'San Joaquin River' THEN b.new_cfs WHEN m.place IN ({_REACH_LIST}) THEN
    CASE WHEN f.flow_cfs + (a.new_cfs - u.flow_cfs) < 0 THEN 100 ELSE f.flow_cfs + (a.new_cfs - u.flow_cfs) END
  ELSE f.flow_cfs END AS flow_cfs
FROM (SELECT DISTINCT date, p.place FROM flows, flow_places p WHERE scenario = 'A') m
LEFT JOIN (SELECT * FROM flows WHERE scenario = 'A') f ON f.date = m.date AND f.place = m.place
LEFT JOIN (SELECT * FROM flows WHERE scenario = 'A') u ON u.date = m.date AND u.place = 'Upper Sacramento River'
LEFT JOIN new_sac a ON a.date = m.date LEFT JOIN new_sjr b ON b.date = m.date"""
_EFF_CTES = [*_base("calsim2"), V.SECOND_SOURCE, V.YEAR_TYPES, *_TEMPLATES.values(), _NEW.format("sac"),
             _NEW.format("sjr"), _LONG_2, _PLACE_LIST]


def _years(spark, sf):
    return V.year_types(spark, sf).filter((F.col("location") == V.LOCATION) & (F.col("year") < 2001))


def _eff(spark, sf):
    base = _flows_2(spark, sf).filter(F.col("scenario") == "A")
    new = [
        E.synthetic_flow(_years(spark, sf), river).withColumn("new_cfs", F.col("new_cfs") / 20)
        for river in ("Sacramento", "San Joaquin")
    ]
    return P.eff_flows(base, *new)


@check(V.query(_EFF, *_EFF_CTES))
def flows_cfs_eff(spark, sf):
    return _eff(spark, sf)


@check(V.query("""SELECT date, place, flow_cfs FROM eff WHERE year(date) IN (SELECT year FROM dry)
UNION ALL SELECT date, place, flow_cfs FROM (SELECT * FROM newer WHERE scenario = 'A')
WHERE year(date) NOT IN (SELECT year FROM dry)""", *_EFF_CTES, f"eff AS ({_EFF})",
               V.coded_flow_sql("calsim3").replace("codes(", "codes3(").replace("JOIN codes ", "JOIN codes3 ")
               .replace("slots AS", "slots3 AS").replace("FROM slots ", "FROM slots3 ").replace("coded AS", "coded3 AS"),
               _wide("calsim3", "coded3").replace("wide AS", "wide3 AS"),
               "newer AS (SELECT * FROM (" + _per_place(_flows("calsim3"), "flow_cfs").replace("FROM wide", "FROM wide3")
               + ") WHERE flow_cfs IS NOT NULL)",
               """dry AS (SELECT year FROM year_types WHERE location = '1-URGENT' AND year BETWEEN 1995 AND 2001
  AND year_type NOT IN ('Wet', 'Above Normal'))"""))
def flows_cfs_spliced(spark, sf):
    newer = _flows_3(spark, sf).filter(F.col("scenario") == "A").select("date", "place", "flow_cfs")
    dry = E.dry_years(V.year_types(spark, sf), V.LOCATION, 1995, 2001)
    return splice_by_year(_eff(spark, sf).select("date", "place", "flow_cfs"), newer, dry)


# --- bypass flows -----------------------------------------------------------------------------


def _segments(family: str):
    c = FAMILY_COLUMN[family] + 1
    out, chain = [], {}
    for bypass, segment, *_ in maps.BYPASS_SEGMENTS:
        own = maps.nodes(next(r for r in maps.BYPASS_SEGMENTS if r[1] == segment)[c])
        chain[bypass] = chain.get(bypass, []) + own
        nodes = chain[bypass] if family == "calsim2" else own
        out.append((segment, nodes))
    return out


def _bypass_sql(family: str) -> str:
    return " UNION ALL ".join(
        f"SELECT scenario, date, '{s}' AS place, {_plus(n, family != 'calsim2')} AS flow_cfs FROM wide "
        f"WHERE coalesce({', '.join(_q(x) for x in n)}) IS NOT NULL"
        for s, n in _segments(family)
    )


@check(V.query(_bypass_sql("calsim2"), *_base("calsim2")))
def bypass_flows_calsim2(spark, sf):
    return P.bypass_flows(V.coded_flow(spark, sf, "calsim2"), "calsim2")


@check(V.query(_bypass_sql("calsim3"), *_base("calsim3")))
def bypass_flows_calsim3(spark, sf):
    return P.bypass_flows(V.coded_flow(spark, sf, "calsim3"), "calsim3")


@check(V.query(_bypass_sql("action_5"), *_base("action_5")))
def bypass_flows_action_5(spark, sf):
    return P.tagged_bypass_flows(V.tagged_flow(spark, sf))


# --- diversions -------------------------------------------------------------------------------


def _div_rows(family: str):
    for place, top, bottom in maps.DIVERSIONS_2 if family == "calsim2" else maps.DIVERSIONS_3:
        num = [n for n in maps.nodes(top) if family != "action_5" or n not in maps.ACTION_5_WITHOUT]
        den = bottom.lstrip("+ ")
        if family == "action_5":
            den = maps.ACTION_5_DENOMINATORS.get(place, den)
        yield place, num, ((num if bottom.startswith("+") else []) + [den])


def _shared_pairs(over_own: bool):
    for group, place, own, shared in maps.SHARED_2:
        total = _plus([r[2] for r in maps.SHARED_2 if r[0] == group])
        part = f"({sql_quotient(_q(own), total)}) * {_q(shared)}"
        volume = f"CASE WHEN {_q(own)} = 0 THEN 0 ELSE {part} END"
        yield place, f"({sql_quotient(f'({volume})', _q(own))})" if over_own else volume


def _total_series(family: str) -> str:
    pairs = [(p, _plus(n)) for p, n, _ in _div_rows(family)]
    return _per_place(pairs + (list(_shared_pairs(False)) if family == "calsim2" else []))


def _total_sql(family: str) -> str:
    return _cube(f"coalesce(s.value * {CMS}, 0)")


def _register_totals() -> None:
    for family in ("calsim3", "action_5"):
        sql = V.query(_total_sql(family), *_base(family), _grid(maps.PLACES), f"series AS ({_total_series(family)})")

        def total(spark, sf, family=family):
            return D.total_diverted(V.coded_flow(spark, sf, family, V.YEARS), family, FIRST, LAST)

        check(sql, f"total_diverted_{family}")(total)


_register_totals()

_MOKE = _plus(maps.MOKELUMNE_DIVERSIONS)
_MOKE_COLS = ", ".join(
    f"max(CASE WHEN node = '{n}' THEN flow_cfs END) AS {_q(n)}" for n in [maps.MOKELUMNE_FLOW, *maps.MOKELUMNE_DIVERSIONS]
)
_MOKE_CTE = f"""moke AS (SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  {_MOKE} * {CMS} AS volume, {sql_quotient(_MOKE, _q(maps.MOKELUMNE_FLOW))} AS share
  FROM (SELECT date, {_MOKE_COLS} FROM coded WHERE scenario = 'A' GROUP BY 1))"""


def _with_moke(inner: str, column: str) -> str:
    return f"""SELECT c.scenario, c.place_order, c.place, c.month, c.year,
  CASE WHEN c.place = 'Mokelumne River' THEN m.{column} ELSE c.value END AS value
FROM ({inner}) c LEFT JOIN moke m ON m.year = c.year AND m.month = c.month"""


@check(V.query(_with_moke(_total_sql("calsim2"), "volume"), *_base("calsim2"), _grid(maps.PLACES), _MOKE_CTE,
               f"series AS ({_total_series('calsim2')})"))
def total_diverted_calsim2(spark, sf):
    flows = V.coded_flow(spark, sf, "calsim2", V.YEARS)
    return D.total_diverted(flows, "calsim2", FIRST, LAST, flows, east_scenario="A")


def _share_series(family: str) -> str:
    policy = {"calsim2": DIVERTED_ROUNDED, "calsim3": DIVERTED_CAPPED, "action_5": DIVERTED_CAP_FIRST}[family]
    pairs = [(p, sql_quotient(_plus(n), _plus(d))) for p, n, d in _div_rows(family)]
    pairs += list(_shared_pairs(True)) if family == "calsim2" else []
    special = ", ".join(f"'{p}'" for p in maps.UNCAPPED_3)
    value = sql_policy("x", policy)
    if family == "calsim3":
        value = f"CASE WHEN place IN ({special}) THEN {sql_policy('x', DIVERTED_UNCAPPED)} ELSE {value} END"
    return f"SELECT scenario, date, place, {value} AS value FROM ({_per_place(pairs, 'x')})"


def _classed(df, value: str = "value"):
    """Non-finite values as NULL with their class beside them, so both sides compare alike."""
    return df.withColumn("kind", kind(value)).withColumn(value, finite(value))


def _classed_sql(inner: str, value: str = "value") -> str:
    return f"SELECT * REPLACE ({sql_finite(value)} AS {value}), {sql_kind(value)} AS kind FROM ({inner})"


def _register_shares() -> None:
    for family in ("calsim3", "action_5"):
        inner = _cube("coalesce(s.value, 0)")
        sql = V.query(_classed_sql(inner), *_base(family), _grid(maps.PLACES), f"series AS ({_share_series(family)})")

        def share(spark, sf, family=family):
            return _classed(D.proportion_diverted(V.coded_flow(spark, sf, family, V.YEARS), family, FIRST, LAST))

        check(sql, f"proportion_diverted_{family}")(share)


_register_shares()


@check(V.query(_classed_sql(_with_moke(_cube("coalesce(s.value, 0)"), "share")), *_base("calsim2"), _grid(maps.PLACES),
               _MOKE_CTE, f"series AS ({_share_series('calsim2')})"))
def proportion_diverted_calsim2(spark, sf):
    flows = V.coded_flow(spark, sf, "calsim2", V.YEARS)
    return _classed(D.proportion_diverted(flows, "calsim2", FIRST, LAST, flows, east_scenario="A"))


_UPPER = next(n for p, n, _ in _div_rows("calsim3") if p == maps.UPPER_SACRAMENTO)
_UPPER_SEEN = f"coalesce({', '.join(_q(n) for n in _UPPER)}) IS NOT NULL"


@check(V.query(_total_sql("calsim3"), *_base("calsim3"), _grid(maps.PLACES),
               f"grand AS (SELECT CASE WHEN count(*) = count({_plus(_UPPER)}) THEN sum({_plus(_UPPER)}) END AS total "
               f"FROM wide WHERE {_UPPER_SEEN})",
               f"series AS (SELECT * FROM ({_total_series('calsim3')}) WHERE place <> '{maps.UPPER_SACRAMENTO}' UNION ALL "
               f"SELECT scenario, date, '{maps.UPPER_SACRAMENTO}', (SELECT total FROM grand) FROM wide WHERE {_UPPER_SEEN})"))
def total_diverted_calsim3_compat(spark, sf):
    """The first place holds the total of all months, as published."""
    return D.total_diverted(V.coded_flow(spark, sf, "calsim3"), "calsim3", FIRST, LAST, compat=True)


# --- mean flow, matrices, natal, pulse --------------------------------------------------------


def _mean_series(family: str) -> str:
    pairs = [
        ("Lower-mid Sacramento River" if p == maps.LOWER_MID[1] else p, e)
        for p, e in _flows(family) if p != maps.LOWER_MID[0]
    ]
    for segment, nodes in _segments(family):
        if segment in maps.LAST_SEGMENTS:
            pairs.append((maps.LAST_SEGMENTS[segment], _plus(nodes, family != "calsim2")))
    return _per_place(pairs)


@check(V.query(_cube(f"s.value * {CMS}"), *_base("calsim2"), V.SECOND_SOURCE, _grid(maps.PLACES),
               f"series AS ({_mean_series('calsim2')} UNION ALL SELECT scenario, date, place, flow_cfs FROM ({_EAST}))"))
def mean_flow_calsim2(spark, sf):
    flows = V.coded_flow(spark, sf, "calsim2", V.YEARS)
    places = P.watershed_flows(flows, "calsim2", _east_side(spark, sf))
    return P.mean_flow(places, P.bypass_flows(flows, "calsim2"), FIRST, LAST)


@check(V.query(_cube(f"s.value * {CMS}"), *_base("calsim3"), _grid(maps.PLACES), f"series AS ({_mean_series('calsim3')})"))
def mean_flow_calsim3(spark, sf):
    flows = V.coded_flow(spark, sf, "calsim3", V.YEARS)
    return P.mean_flow(P.watershed_flows(flows, "calsim3"), P.bypass_flows(flows, "calsim3"), FIRST, LAST)


def _year_cells(value: str, column: str = "year(date)") -> str:
    return ", ".join(f"max(CASE WHEN {column} = {y} THEN {value} END) AS y{y}" for y in YEARS)


def _matrix_sql(family: str) -> str:
    pairs = [(r[0], _plus(r[FAMILY_COLUMN[family]], True)) for r in maps.MATRIX_NODES]
    return f"""SELECT scenario, place AS dataset, CAST(month(date) AS INTEGER) AS month, {_year_cells(f'value * {CMS}')}
FROM ({_per_place(pairs)}) WHERE value IS NOT NULL AND year(date) BETWEEN {FIRST} AND {LAST} GROUP BY 1, 2, 3"""


@check(V.query(_matrix_sql("calsim2"), *_base("calsim2")))
def node_matrices_calsim2(spark, sf):
    return P.node_matrices(V.coded_flow(spark, sf, "calsim2", V.YEARS), "calsim2", FIRST, LAST)


@check(V.query(_matrix_sql("calsim3"), *_base("calsim3")))
def node_matrices_calsim3(spark, sf):
    return P.node_matrices(V.coded_flow(spark, sf, "calsim3", V.YEARS), "calsim3", FIRST, LAST)


@check(V.query(f"""SELECT scenario, CAST(month(date) AS INTEGER) AS month, {_year_cells(f'flow_cfs * {CMS}')}
FROM coded WHERE node = 'C_SAC257' AND year(date) BETWEEN {FIRST} AND {LAST} GROUP BY 1, 2""", *_base("action_5")))
def upper_sacramento_flows_action_5(spark, sf):
    return P.tagged_matrix(V.tagged_flow(spark, sf, V.YEARS), "upsac_flow", FIRST, LAST)


@check(V.query(f"""SELECT scenario, CAST(month(date) AS INTEGER) AS month, {_year_cells(f'{_q("C_SJR081")} * {CMS}')}
FROM wide WHERE year(date) BETWEEN {FIRST} AND {LAST} AND "C_SJR081" IS NOT NULL GROUP BY 1, 2""", *_base("calsim3")))
def san_joaquin_flows_calsim3(spark, sf):
    return P.place_matrix(_flows_3(spark, sf, V.YEARS), maps.SAN_JOAQUIN, FIRST, LAST)


def _published_matrix(river: str, newer: str) -> str:
    """The synthetic series, and the newer run outside dry years, as matrices."""
    cells = _year_cells(f"flow_cfs * {CMS}")
    return f"""SELECT scenario, CAST(month(date) AS INTEGER) AS month, {cells} FROM (
  SELECT 'eff' AS scenario, date, new_cfs AS flow_cfs FROM new_{river}
  UNION ALL SELECT 'LTO_12a_eff_dy', date, new_cfs FROM new_{river} WHERE year(date) IN (SELECT year FROM dry)
  UNION ALL SELECT 'LTO_12a_eff_dy', date, flow_cfs FROM coded WHERE node = '{newer}' AND scenario = 'A'
    AND year(date) NOT IN (SELECT year FROM dry)) WHERE year(date) BETWEEN {FIRST} AND {LAST} GROUP BY 1, 2"""


_DRY = """dry AS (SELECT year FROM year_types WHERE location = '1-URGENT' AND year BETWEEN 1995 AND 2001
  AND year_type NOT IN ('Wet', 'Above Normal'))"""
_PUBLISHED = [V.coded_flow_sql("calsim3"), V.SECOND_SOURCE, V.YEAR_TYPES, *_TEMPLATES.values(), _NEW.format("sac"),
              _NEW.format("sjr"), _DRY]


def _published(spark, sf, river: str, newer: str):
    series = E.synthetic_flow(_years(spark, sf), river).select(
        F.lit("eff").alias("scenario"), "date", F.lit("P").alias("place"), (F.col("new_cfs") / 20).alias("flow_cfs")
    )
    run = V.coded_flow(spark, sf, "calsim3", V.YEARS).filter((F.col("scenario") == "A") & (F.col("node") == newer))
    run = run.select("scenario", "date", F.lit("P").alias("place"), "flow_cfs")
    spliced = splice_by_year(series, run, E.dry_years(V.year_types(spark, sf), V.LOCATION, 1995, 2001))
    both = series.unionByName(spliced.withColumn("scenario", F.lit("LTO_12a_eff_dy")))
    return P.place_matrix(both, "P", FIRST, LAST)


@check(V.query(_published_matrix("sac", "C_SAC257"), *_PUBLISHED))
def upper_sacramento_flows_published(spark, sf):
    return _published(spark, sf, "Sacramento", "C_SAC257")


@check(V.query(_published_matrix("sjr", "C_SJR081"), *_PUBLISHED))
def san_joaquin_flows_published(spark, sf):
    return _published(spark, sf, "San Joaquin", "C_SJR081")


@check(V.query(f"""SELECT place, calsim2, calsim3, count(flow_cfs) AS months, sum(flow_cfs) AS flow_cfs
FROM (SELECT coalesce(x.place, y.place) AS place, x.calsim2, y.calsim3 FROM older x FULL JOIN newer y ON x.place = y.place) c
LEFT JOIN coded ON coded.node = c.calsim2 GROUP BY 1, 2, 3""", V.coded_flow_sql("calsim2"),
               *(V.values_cte(name, ["place", c], [(r[0], r[k]) for r in maps.FLOW_NODES if r[k]])
                 for name, c, k in (("older", "calsim2", 1), ("newer", "calsim3", 2)))))
def node_crosswalk(spark, sf):
    """The nodes of both families side by side, with what the older one carries."""
    flows = V.coded_flow(spark, sf, "calsim2").groupBy(F.col("node").alias("calsim2")).agg(
        F.count("flow_cfs").alias("months"), F.sum("flow_cfs").alias("flow_cfs")
    )
    return crosswalk(spark, "flows").join(flows, "calsim2", "left").fillna(0, ["months"])


@check(V.query(f"""SELECT scenario, date, "C400" AS "freeportQcfs", "C400" * {CMS} AS "freeportQcms" FROM wide
WHERE "C400" IS NOT NULL""", *_base("calsim2")))
def freeport_series_calsim2(spark, sf):
    return P.freeport_series(V.coded_flow(spark, sf, "calsim2"))


@check(V.query("SELECT scenario, date, " + ", ".join(_q(n) for n in maps.MISC_NODES) + " FROM wide WHERE coalesce("
               + ", ".join(_q(n) for n in maps.MISC_NODES) + ") IS NOT NULL", *_base("calsim2")))
def misc_flows_calsim2(spark, sf):
    flows = V.coded_flow(spark, sf, "calsim2")
    return P.misc_flows(flows.withColumn("flow_cfs", F.col("flow_cfs").cast("string")))


_JUNCTIONS = V.values_cte("junctions", ["place", "junction"], list(maps.JUNCTIONS.items()))
_ONE_MID = """one_mid AS (SELECT scenario, date, CASE WHEN place = 'Lower-mid Sacramento River2'
  THEN 'Lower-mid Sacramento River' ELSE place END AS place, flow_cfs FROM flows
  WHERE place <> 'Lower-mid Sacramento River1')"""
_NATAL_FIXED = ", ".join(f"'{p}'" for p in maps.NATAL_FIXED)


_NATAL = f"""SELECT g.scenario, g.place_order, g.place, g.year, coalesce(CASE WHEN g.place IN ({_NATAL_FIXED})
    THEN 1 ELSE {sql_policy('x', NATAL)} END, 0) AS value
FROM (SELECT * FROM grid WHERE month = 10) g
LEFT JOIN (SELECT f.scenario, f.date, f.place, {sql_quotient('f.flow_cfs', 'h.flow_cfs')} AS x
  FROM one_mid f LEFT JOIN junctions j USING (place)
  LEFT JOIN one_mid h ON h.scenario = f.scenario AND h.date = f.date AND h.place = j.junction) f
  ON f.scenario = g.scenario AND f.place = g.place AND year(f.date) = g.year AND month(f.date) = 10"""


@check(V.query(_NATAL, *_base("calsim3"), _grid(maps.PLACES), _JUNCTIONS,
               "flows AS (SELECT * FROM (" + _per_place(_flows("calsim3"), "flow_cfs") + ") WHERE flow_cfs IS NOT NULL)",
               _ONE_MID))
def proportion_flow_natal_calsim3(spark, sf):
    return P.proportion_flow_natal(_flows_3(spark, sf, V.YEARS), FIRST, LAST)


@check(V.query(_NATAL, *V.once(*_base("calsim2"), V.SECOND_SOURCE, _grid(maps.PLACES), _JUNCTIONS, _LONG_2, _ONE_MID)))
def proportion_flow_natal_calsim2(spark, sf):
    return P.proportion_flow_natal(_flows_2(spark, sf, V.YEARS), FIRST, LAST)


@check(V.query(_NATAL, *V.once(*_base("action_5"), _grid(maps.PLACES), _JUNCTIONS, f"flows AS ({_TAGGED_FLOWS})", _ONE_MID)))
def proportion_flow_natal_action_5(spark, sf):
    return P.proportion_flow_natal(P.region_flows(V.tagged_flow(spark, sf, V.YEARS)), FIRST, LAST)


def _blended(family: str) -> str:
    a, b = (_q(row[FAMILY_COLUMN[family]]) for row in maps.FLOW_NODES if row[0] in maps.LOWER_MID)
    mid = f"{LOWER_MID_REACHES[0]!r}::DOUBLE * {a} + {LOWER_MID_REACHES[1]!r}::DOUBLE * {b}"
    pairs = [(p, e) for p, e in _flows(family) if p not in maps.LOWER_MID]
    return _per_place(pairs + [("Lower-mid Sacramento River", mid)], "flow_cfs")


_N_YEARS = LAST - FIRST + 1
_MONTH_GRID = V.values_cte("places", ["place_order", "place"], [(i + 1, p) for i, p in enumerate(maps.PLACES)]) + (
    """, months AS (SELECT s.scenario, CAST(p.place_order AS INTEGER) AS place_order, p.place,
  CAST(m.month AS INTEGER) AS month FROM (VALUES ('A'), ('N'), ('R')) s(scenario), places p, range(1, 13) m(month))"""
)
_STATS = f"""stats AS (SELECT scenario, place, CAST(month(date) AS INTEGER) AS month,
  CASE WHEN count(flow_cfs) = {_N_YEARS} THEN stddev_samp(flow_cfs) END AS sd,
  CASE WHEN count(flow_cfs) = {_N_YEARS} THEN median(flow_cfs) END AS med
  FROM ({{flows}}) WHERE year(date) BETWEEN {FIRST} AND {LAST} GROUP BY 1, 2, 3)"""
_MONTH_STATS = _STATS.format(flows=_blended("calsim3"))


@check(V.query(f"""SELECT scenario, place_order, place, month,
  round(CASE WHEN place IN ('Sutter Bypass', 'Yolo Bypass') THEN 0 ELSE {sql_policy('x', PULSE_FILL)} END, 6) AS value
FROM (SELECT m.*, {sql_quotient('(sd / 100)', 'med')} AS x FROM months m LEFT JOIN stats USING (scenario, place, month))""",
               *_base("calsim3"), _MONTH_GRID, _MONTH_STATS))
def proportion_pulse_flows_calsim3(spark, sf):
    cells = P.proportion_pulse_flows(_flows_3(spark, sf, V.YEARS), first=FIRST, last=LAST)
    return cells.withColumn("value", F.round("value", 6))


@check(V.query(f"""SELECT scenario, place_order, place, month, round({sql_finite('v')}, 6) AS value, {sql_kind('v')} AS kind
FROM (SELECT scenario, place_order, place, month,
  CASE WHEN place IN ('Sutter Bypass', 'Yolo Bypass') THEN 0 ELSE {sql_policy('x', PULSE_KEEP)} END AS v
  FROM (SELECT m.*, {sql_quotient('(sd / 100)', 'med')} AS x FROM months m LEFT JOIN stats USING (scenario, place, month)))""",
               *_base("calsim2"), _MONTH_GRID, _STATS.format(flows=_blended("calsim2"))))
def proportion_pulse_flows_calsim2(spark, sf):
    flows = P.watershed_flows(V.coded_flow(spark, sf, "calsim2", V.YEARS), "calsim2")
    cells = _classed(P.proportion_pulse_flows(flows, PULSE_KEEP, FIRST, LAST))
    return cells.withColumn("value", F.round("value", 6))


@check(V.query("SELECT scenario, place, month, round(med, 6) AS value FROM stats WHERE place IN (SELECT place FROM present "
               "WHERE present.scenario = stats.scenario AND present.month = stats.month)", *_base("calsim3"), _MONTH_STATS,
               f"""present AS (SELECT DISTINCT scenario, CASE WHEN place LIKE 'Lower-mid%' THEN 'Lower-mid Sacramento River'
  ELSE place END AS place, CAST(month(date) AS INTEGER) AS month FROM ({_per_place(_flows("calsim3"), "flow_cfs")})
  WHERE flow_cfs IS NOT NULL AND year(date) BETWEEN {FIRST} AND {LAST})"""))
def med_flow_calsim3(spark, sf):
    return P.med_flow(_flows_3(spark, sf, V.YEARS), FIRST, LAST).withColumn("value", F.round("value", 6))


@check(V.query(f"""SELECT scenario, place_order, place, month,
  round(CASE WHEN place IN ('Sutter Bypass', 'Yolo Bypass') THEN 0 ELSE {sql_policy('x', PULSE_FILL)} END, 6) AS value
FROM (SELECT m.*, {sql_quotient('(sd / 100)', 'med')} AS x FROM months m LEFT JOIN stats USING (scenario, place, month))""",
               *V.once(*_base("action_5"), _MONTH_GRID, _STATS.format(flows=_TAGGED_FLOWS))))
def proportion_pulse_flows_action_5(spark, sf):
    flows = P.region_flows(V.tagged_flow(spark, sf, V.YEARS))
    cells = P.proportion_pulse_flows(flows, first=FIRST, last=LAST, blend=False)
    return cells.withColumn("value", F.round("value", 6))


def _hatchery_sql(months: str, flows: str = "") -> str:
    listed = ", ".join(f"'{p}'" for p in maps.HATCHERY_PLACES)
    flows = flows or f"SELECT * FROM ({_per_place(_flows('calsim3'), 'flow_cfs')}) WHERE flow_cfs IS NOT NULL"
    return f"""SELECT scenario, place, {_year_cells('value', 'year')} FROM (
  SELECT scenario, place, year(date) AS year, CASE WHEN count(flow_cfs) = 2 THEN sum(flow_cfs) / 2 END AS value
  FROM ({flows}) WHERE place IN ({listed}) AND month(date) IN ({months}) AND year(date) BETWEEN {FIRST} AND {LAST} GROUP BY 1, 2, 3) GROUP BY 1, 2"""


@check(V.query(_hatchery_sql("10, 11"), *_base("calsim3")))
def hatchery_oct_nov_flows_calsim3(spark, sf):
    return P.hatchery_flows(_flows_3(spark, sf, V.YEARS), (10, 11), FIRST, LAST)


@check(V.query(_hatchery_sql("4, 5"), *_base("calsim3")))
def hatchery_apr_may_flows_calsim3(spark, sf):
    return P.hatchery_flows(_flows_3(spark, sf, V.YEARS), (4, 5), FIRST, LAST)


@check(V.query(_hatchery_sql("10, 11", _FLOWS_2), *_base("calsim2"), V.SECOND_SOURCE))
def hatchery_oct_nov_flows_calsim2(spark, sf):
    return P.hatchery_flows(_flows_2(spark, sf, V.YEARS), (10, 11), FIRST, LAST)


@check(V.query(_hatchery_sql("4, 5", _FLOWS_2), *_base("calsim2"), V.SECOND_SOURCE))
def hatchery_apr_may_flows_calsim2(spark, sf):
    return P.hatchery_flows(_flows_2(spark, sf, V.YEARS), (4, 5), FIRST, LAST)


# --- delta and bypass proportions -------------------------------------------------------------


def _delta_series(family: str, south=DELTA_SOUTH) -> str:
    loose = family == "calsim3"
    sums = ", ".join(f"{_plus(r[FAMILY_COLUMN[family]], loose)} AS {r[0]}" for r in maps.DELTA_NODES)
    seen = ", ".join(_q(n) for r in maps.DELTA_NODES for n in maps.nodes(r[FAMILY_COLUMN[family]]))
    return f"""SELECT scenario, date, n_dlt_inflow_cfs, s_dlt_inflow_cfs, n_dlt_div_cfs, s_dlt_div_cfs,
  {sql_policy('nx', DELTA_NORTH)} AS n_dlt_prop_div, {sql_policy('sx', south)} AS s_dlt_prop_div
FROM (SELECT *, {sql_quotient('n_dlt_div_cfs', 'n_dlt_inflow_cfs')} AS nx,
             {sql_quotient('s_dlt_div_cfs', 's_dlt_inflow_cfs')} AS sx
      FROM (SELECT scenario, date, {sums} FROM wide WHERE coalesce({seen}) IS NOT NULL))"""


def _delta_classed_sql(inner: str) -> str:
    return f"""SELECT * REPLACE ({sql_finite('n_dlt_prop_div')} AS n_dlt_prop_div, {sql_finite('s_dlt_prop_div')} AS s_dlt_prop_div),
  {sql_kind('n_dlt_prop_div')} AS n_kind, {sql_kind('s_dlt_prop_div')} AS s_kind FROM ({inner})"""


def _delta_classed(df):
    out = df.withColumn("n_kind", kind("n_dlt_prop_div")).withColumn("s_kind", kind("s_dlt_prop_div"))
    return out.withColumn("n_dlt_prop_div", finite("n_dlt_prop_div")).withColumn(
        "s_dlt_prop_div", finite("s_dlt_prop_div")
    )


@check(V.query(_delta_classed_sql(_delta_series("calsim2")), *_base("calsim2")))
def delta_flows_calsim2(spark, sf):
    return _delta_classed(T.delta_flows(V.coded_flow(spark, sf, "calsim2"), "calsim2"))


@check(V.query(_delta_classed_sql(_delta_series("calsim3") + """ WHERE date BETWEEN
  (SELECT min(date) FROM second_source WHERE year(date) BETWEEN 1996 AND 1999) AND
  (SELECT max(date) FROM second_source WHERE year(date) BETWEEN 1996 AND 1999)"""), *_base("calsim3"), V.SECOND_SOURCE))
def delta_flows_calsim3(spark, sf):
    other = V.second_source(spark, sf).filter(F.year("date").between(1996, 1999))
    return _delta_classed(T.delta_flows(V.coded_flow(spark, sf, "calsim3"), "calsim3", other))


def _tagged_delta_flows(spark, sf):
    return T.tagged_delta_flows(V.tagged_flow(spark, sf, V.YEARS), FIRST, LAST)


_TAGGED_DELTA = _delta_series("calsim3", BYPASS_CAPPED).replace(
    "WHERE coalesce(", f"WHERE year(date) BETWEEN {FIRST} AND {LAST} AND coalesce("
)


@check(V.query(_delta_classed_sql(_TAGGED_DELTA), *_base("action_5")))
def delta_flows_action_5(spark, sf):
    return _delta_classed(_tagged_delta_flows(spark, sf))


def _delta_of(spark, sf, family: str):
    if family == "action_5":
        return _tagged_delta_flows(spark, sf)
    return T.delta_flows(V.coded_flow(spark, sf, family, V.YEARS), family)


def _register_delta_cubes() -> None:
    names = (("delta_inflow", "inflow"), ("delta_total_diverted", "div"), ("delta_proportion_diverted", "prop_div"))
    for family, flows in (("calsim2", _delta_series("calsim2")), ("calsim3", _delta_series("calsim3")),
                          ("action_5", _TAGGED_DELTA)):
        for name, measure in names:
            suffix = "prop_div" if measure == "prop_div" else f"{measure}_cfs"
            factor = "" if measure == "prop_div" else f" * {CMS}"
            series = " UNION ALL ".join(
                f"SELECT scenario, date, '{p}' AS place, {c}_dlt_{suffix}{factor} AS value FROM ({flows})"
                for p, c in (("North Delta", "n"), ("South Delta", "s"))
            )
            sql = V.query(_classed_sql(_cube()), *_base(family), _grid(T.PLANES), f"series AS ({series})")

            def cube(spark, sf, family=family, measure=measure):
                return _classed(T.delta_cube(_delta_of(spark, sf, family), measure, FIRST, LAST))

            check(sql, f"{name}_{family}")(cube)


_register_delta_cubes()


def _alias_wide() -> list[str]:
    cols = ", ".join(f"{_plus(cell, True)} AS {_q(code)}" for code, cell in maps.ALIASES)
    return [V.coded_flow_sql("calsim3"), _wide("calsim3").replace("wide AS", "wide3 AS"),
            f"wide AS (SELECT scenario, date, {cols} FROM wide3)"]


def _bypass_share_sql(family: str) -> str:
    rows = [r for r in maps.BYPASS_RATIOS if r[1] == ("action_5" if family == "action_5" else "calsim2")]
    pairs = []
    for bypass, _, top, bottom in rows:
        num = maps.nodes(top)
        den = (num if bottom.startswith("+") else []) + [bottom.lstrip("+ ")]
        pairs.append((bypass, sql_quotient(_plus(num), _plus(den))))
    capped = sql_policy("x", BYPASS_CAPPED)
    value = capped if family == "action_5" else f"CASE WHEN place = 'Yolo Bypass' THEN {capped} ELSE x END"
    return f"SELECT scenario, date, place, {value} AS value FROM ({_per_place(pairs, 'x')})"


def _over_sql(family: str) -> str:
    c = 2 if family == "action_5" else 1
    return " UNION ALL ".join(
        f"SELECT scenario, date, '{r[0]}' AS place, {_plus(r[c])} >= 100 AS value FROM wide" for r in maps.OVERTOPPED_NODES
    )


def _register_bypass() -> None:
    grid = _grid(maps.BYPASSES)
    for family in ("calsim2", "calsim3", "action_5"):
        base = _alias_wide() if family == "calsim3" else _base(family)

        def share(spark, sf, family=family):
            flows = V.coded_flow(spark, sf, family, V.YEARS)
            return _classed(T.proportion_flow_bypasses(flows, family, FIRST, LAST))

        def over(spark, sf, family=family):
            return T.gates_overtopped(V.coded_flow(spark, sf, family, V.YEARS), family, FIRST, LAST)

        check(V.query(_classed_sql(_cube()), *base, grid, f"series AS ({_bypass_share_sql(family)})"),
              f"proportion_flow_bypasses_{family}")(share)
        check(V.query(_cube(), *base, grid, f"series AS ({_over_sql(family)})"), f"gates_overtopped_{family}")(over)


_register_bypass()



@check(V.query(f"""SELECT scenario, date, place, value FROM ({_over_sql('calsim2')}) WHERE year(date) BETWEEN 1995 AND 1999
  AND (scenario, date, place) IN (SELECT (scenario, date, place) FROM present)""", *_base("calsim2"),
               "present AS (" + " UNION ALL ".join(
                   f"SELECT scenario, date, '{r[0]}' AS place FROM wide WHERE coalesce("
                   + ", ".join(_q(n) for n in maps.nodes(r[1])) + ") IS NOT NULL" for r in maps.OVERTOPPED_NODES) + ")"))
def bypass_overtopped_calsim2(spark, sf):
    return T.overtopped_series(V.coded_flow(spark, sf, "calsim2", (1995, 1999)), "calsim2", 1995, 1999)


def _tagged_sql(series: str, variable: str) -> str:
    return f"SELECT scenario, '{variable}' AS variable, place, CAST(date_trunc('month', date) AS DATE) AS date, value FROM ({series})"


_DELTA_LONG = " UNION ALL ".join(
    f"SELECT scenario, date, '{p}' AS place, {c}_dlt_inflow_cfs * {CMS} AS value FROM ({_delta_series('calsim2')})"
    for p, c in (("North Delta", "n"), ("South Delta", "s"))
)
_COMPARED = f"""compared AS (SELECT * FROM (
  SELECT scenario, 'delta_inflow' AS variable, place, make_date(CAST(year AS BIGINT), CAST(month AS BIGINT), 1) AS date, value
  FROM ({_cube()})
  UNION ALL {_tagged_sql(" UNION ALL ".join(
      f"SELECT scenario, date, '{p}' AS place, {_q(n)} * {CMS} AS value FROM wide WHERE year(date) BETWEEN {FIRST} AND {LAST}"
      for p, n in (("freeport_flow", "C400"), ("vernalis_flow", "C639"))), "single_nodes")}
  UNION ALL SELECT scenario, 'flows_cfs', place, date, flow_cfs FROM ({_per_place(_flows('calsim2'), 'flow_cfs')})
            WHERE year(date) BETWEEN {FIRST} AND {LAST}) WHERE value IS NOT NULL)"""


_SIDES = """sides AS (SELECT variable, place, date, max(value) FILTER (WHERE scenario = 'A') AS left_value,
  max(value) FILTER (WHERE scenario = 'N') AS right_value FROM compared WHERE scenario IN ('A', 'N') GROUP BY 1, 2, 3)"""


@check(V.query("""SELECT variable, place, date, left_value, right_value, right_value - left_value AS difference
FROM sides WHERE place IN (SELECT place FROM sides GROUP BY place HAVING count(left_value) > 0 AND count(right_value) > 0)""",
               *V.once(*_base("calsim2"), _grid(T.PLANES), f"series AS ({_DELTA_LONG})", _COMPARED, _SIDES)))
def unified_comparison(spark, sf):
    """A cube, a matrix and a series of two scenarios, stacked and compared."""
    # The same rows for all three, so that one shuffle of the nodes' sums serves them.
    chosen = ((F.col("scenario") == "A") | (F.col("scenario") == "N")) & in_years("date", FIRST, LAST)
    flows = V.coded_flow(spark, sf, "calsim2", V.YEARS).filter(chosen)
    cube = T.delta_inflow(T.delta_flows(flows, "calsim2"), FIRST, LAST)
    matrix = P.node_matrices(flows, "calsim2", FIRST, LAST, ["freeport_flow", "vernalis_flow"])
    places = P.watershed_flows(flows, "calsim2").filter(F.col("place") != maps.MOKELUMNE)
    stacked = (
        C.long_cube(cube, "delta_inflow")
        .unionByName(C.long_matrix(matrix, "single_nodes"))
        .unionByName(C.long_series(places, "flows_cfs"))
    )
    known = stacked.filter(F.col("value").isNotNull())
    return C.scenario_difference(known, "A", "N", ["variable", "place", "date"], shared="place")


# --- climate run ------------------------------------------------------------------------------


def _regional_pairs():
    for region, stream, node, weight in maps.REGION_STREAMS:
        if stream:
            total = _plus([r[2] for r in maps.REGION_STREAMS if r[0] == region])
            value = f"({sql_quotient(f'({_q(node)} * {float(weight)}::DOUBLE)', total)}) * {_q(region)}"
            if region == "Eastside":
                value = f"CASE WHEN isnan({value}) OR {value} < 0 THEN 0 ELSE {value} END"
            yield region, stream, node, value


_REGIONAL = " UNION ALL ".join(
    f"SELECT scenario, date, '{r}' AS region, '{s}' AS place, {v} AS flow_cfs FROM wide WHERE {_q(n)} IS NOT NULL"
    for r, s, n, v in _regional_pairs()
)


@check(V.query(_classed_sql(_REGIONAL, "flow_cfs"), *_base("climate")))
def regional_disaggregation(spark, sf):
    return _classed(G.regional_share(V.coded_flow(spark, sf, "climate")), "flow_cfs")


@check(V.query(" UNION ALL ".join(
    f"SELECT scenario, date, '{p}' AS place, {_plus(c)} AS flow_cfs FROM wide WHERE coalesce("
    + ", ".join(_q(n) for n in maps.nodes(c)) + ") IS NOT NULL" for p, c in maps.CLIMATE_DELTA
), *_base("climate")))
def climate_delta_flows(spark, sf):
    return P.climate_delta(V.coded_flow(spark, sf, "climate"))


@check(V.query(f"""SELECT s.scenario, s.date, s.place, p.place_order, {sql_finite('flow_cfs')} AS flow_cfs
FROM (SELECT scenario, date, place, flow_cfs FROM ({_REGIONAL}) WHERE region <> 'YubaFeather'
      UNION ALL SELECT scenario, date, 'Bear River', "Bear River" FROM wide WHERE "Bear River" IS NOT NULL) s
JOIN places p ON p.place = s.place""", *_base("climate"), _grid(maps.PLACES)))
def assembled_streams(spark, sf):
    flows = V.coded_flow(spark, sf, "climate")
    shares = G.regional_share(flows).filter(F.col("region") != "YubaFeather").drop("region")
    bear = flows.filter(F.col("node") == "Bear River").withColumnRenamed("node", "place")
    stacked = G.assemble([shares, bear.select("scenario", "date", "place", "flow_cfs")])
    return stacked.withColumn("flow_cfs", finite("flow_cfs"))


@check(V.query("""SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 4) AS intercept,
  CAST(regr_count(y, x) AS BIGINT) AS n
FROM (SELECT "D117" + "D124" + "D125" + "D126" AS y, "C112" AS x FROM wide) WHERE x >= 20""", *_base("climate")))
def spill_regression(spark, sf):
    wide = to_wide(V.coded_flow(spark, sf, "climate"), KEYS, "node", "flow_cfs", [*maps.SPILL_NODES, maps.SPILL_RIVER_NODE])
    fit = G.spill_fit(wide, threshold=20.0)
    return fit.select(F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"), "n")


_AF = f"{ACRE_FEET_PER_MONTH_PER_CFS!r}::DOUBLE"


def _template_sum(kind_: str) -> str:
    row = next(r for r in maps.TEMPLATES if r[:3] == ["Sacramento", "Wet", kind_])
    return " + ".join(f"{v} * {_AF}" for v in maps.nodes(row[3]))


@check(V.query(f"""SELECT type, round(v, 1) AS acre_feet, format('{{:,}}', CAST(round_even(v, 0) AS BIGINT)) AS acre_feet_text
FROM (SELECT 'calsim' AS type, sum(flow_cfs * {_AF}) AS v FROM coded WHERE node = 'C115' AND year(date) = 1996
      UNION ALL SELECT 'Natural flows Database flows', {_template_sum('natural')}
      UNION ALL SELECT 'Proposed Model EFF', {_template_sum('proposed')})""", *_base("calsim2")))
def volume_comparison(spark, sf):
    model = V.coded_flow(spark, sf, "calsim2", (1996, 1996)).filter(F.col("node") == "C115")
    parts = [
        E.templates(spark, "Sacramento", k).filter(F.col("year_type") == "Wet") for k in ("natural", "proposed")
    ]
    return E.compare_volumes(model, *parts).withColumn("acre_feet", F.round("acre_feet", 1))
