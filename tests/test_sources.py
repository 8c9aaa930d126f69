"""Text exports and published datasets."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from freshet.functions.dates import month_index
from freshet.sources import exports, store


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_node_export_with_different_files(spark, tmp_path, rows):
    write(tmp_path / "run" / "a.csv", "﻿A,,MODEL,MODEL\r\nB,,C1,C2\r\nUnits,,CFS,CFS\r\n1,31Oct1921,4395,6962\r\n2,30Nov1921,x,7045\r\n")
    write(tmp_path / "run" / "b.csv", "A,,MODEL\nB,,D9\nType,,PER-AVER\n1,31Oct1921,12.5\n2,30Nov1921,\n3,31Dec1921,7\n")
    df = exports.node_export(spark, str(tmp_path / "run"))
    assert rows(df, "date", "node", "flow_cfs") == [
        (dt.date(1921, 10, 31), "C1", 4395.0), (dt.date(1921, 10, 31), "C2", 6962.0), (dt.date(1921, 10, 31), "D9", 12.5),
        (dt.date(1921, 11, 30), "C1", None), (dt.date(1921, 11, 30), "C2", 7045.0), (dt.date(1921, 11, 30), "D9", None),
        (dt.date(1921, 12, 31), "D9", 7.0),
    ]
    assert {r[0] for r in exports.node_export(spark, str(tmp_path / "run"), ["D9"], 1921, 1921).select("node").collect()} == {"D9"}
    assert exports.node_export(spark, str(tmp_path / "run"), first=1922).count() == 0
    tagged = exports.scenario_of_file(df, {"a.csv": "first", "b.csv": "second"})
    assert rows(tagged.groupBy("scenario").count()) == [("first", 4), ("second", 3)]


def test_titled_csv(spark, tmp_path, rows):
    write(tmp_path / "map.csv", "to calculate, see notes,,,\norder,place,nodes\n1,Butte Creek,\"C217B, D217\"\n2,Bear Creek,NA\n")
    df = exports.titled_csv(spark, str(tmp_path / "map.csv"), "id int, place string, nodes string", "id")
    assert rows(df, "id", "place", "nodes") == [(1, "Butte Creek", "C217B, D217"), (2, "Bear Creek", "NA")]


def test_gate_rules_with_two_titles(spark, tmp_path, rows):
    write(tmp_path / "rules.csv", "citation: a plan,,\n\"changes, possible\",,\nMonth,Days Closed,Note\nJanuary,31,\"long, text\"\nJuly,0,Open\n")
    df = exports.titled_csv(spark, str(tmp_path / "rules.csv"), "month string, days_closed int, note string", "days_closed")
    assert rows(df.select(month_index("month"), "days_closed")) == [(1, 31), (7, 0)]


def test_series_with_slash_dates(spark, tmp_path, rows):
    write(tmp_path / "s.csv", "a title,\ncs_date,Sutter Bypass\n10/1/1921,0\n11/1/1921,4.5\n")
    df = exports.titled_csv(spark, str(tmp_path / "s.csv"), "cs_date date, flow double", "cs_date", "M/d/yyyy")
    assert rows(df, "cs_date", "flow") == [(dt.date(1921, 10, 1), 0.0), (dt.date(1921, 11, 1), 4.5)]


def test_wide_export_repairs_the_century(spark, rows):
    wide = spark.createDataFrame([("31Oct2021", "1", ""), ("CFS", "CFS", "CFS"), ("30Nov2001", "n/a", "2.5")], "date string, a string, b string")
    out = exports.wide_export(wide, "date", "ddMMMyyyy", century=True)
    assert rows(out) == [(dt.date(1921, 10, 31), "a", 1.0), (dt.date(2001, 11, 30), "b", 2.5)]


def test_publish_replaces_only_its_scenarios(spark, tmp_path, rows):
    root = str(tmp_path)
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "scenario string, x int")
    store.publish(df, root, "flows_cfs")
    store.publish(spark.createDataFrame([("b", 9)], "scenario string, x int"), root, "flows_cfs")
    assert rows(store.lookup(spark, root, "flows_cfs"), "scenario", "x") == [("a", 1), ("a", 2), ("b", 9)]
    one = store.lookup(spark, root, "flows_cfs", "b")
    assert "PartitionFilters: [isnotnull(scenario" in one._jdf.queryExecution().executedPlan().toString()
    assert rows(one, "x") == [(9,)]
    store.register(spark, root, ["flows_cfs"])
    assert spark.sql("SELECT count(*) FROM flows_cfs").first()[0] == 3


def test_availability():
    store.check_available("mean_flow", "eff")
    with pytest.raises(KeyError):
        store.check_available("mean_flow", "action_5")


def test_literal_maps_are_bounded(spark):
    from freshet.operators.lookup import MAX_LITERAL_ROWS, small_frame

    with pytest.raises(ValueError):
        small_frame(spark, [("a",)] * (MAX_LITERAL_ROWS + 1), "x string")
    assert small_frame(spark, [("a", None)], "x string, y double").filter(F.col("y").isNull()).count() == 1


def test_landing(spark, tmp_path, rows):
    from freshet.plans import landing

    write(tmp_path / "a.csv", "A,,M,M\nB,,C104,ZZZ\n1,31Oct1921,1,9\n2,31Jan1922,2,9\n")
    write(tmp_path / "b.csv", "A,,M,M\nB,,C104,D104\n1,31Jan1922,7,3\n2,28Feb1922,8,\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    got = rows(landing.land_exports(spark, paths, "run"))
    assert got == [
        ("run", dt.date(1922, 1, 31), "C104", 2.0), ("run", dt.date(1922, 1, 31), "D104", 3.0),
        ("run", dt.date(1922, 2, 28), "C104", 8.0), ("run", dt.date(1922, 2, 28), "D104", None),
    ]
    write(tmp_path / "c.csv", "B,,C104\n1,31Jan2022,5\n2,31Jan2001,6\n")
    late = landing.land_exports(spark, str(tmp_path / "c.csv"), "run", misread_after=2003)
    assert rows(late, "date", "flow_cfs") == [(dt.date(1922, 1, 31), 5.0), (dt.date(2001, 1, 31), 6.0)]

    wide = spark.createDataFrame([("x", dt.date(2021, 10, 31), 1.0, None)], "B string, date date, C_ANT010 double, C_BTL006 double")
    assert rows(landing.land_wide(wide, "LTO_12a")) == [("LTO_12a", dt.date(1921, 10, 31), "C_ANT010", 1.0)]

    write(tmp_path / "t.csv", "datetime,node,dataset,region,values,units\n1979-01-31T00:00:00Z,C_SAC257,upsac_flow,upsac,4.5,CFS\n")
    assert rows(landing.land_tagged(spark, str(tmp_path / "t.csv"))) == [
        ("action_5", dt.date(1979, 1, 31), "C_SAC257", "upsac_flow", "upsac", 4.5)
    ]
    sheet = spark.createDataFrame([(dt.date(1980, 1, 1), *map(float, range(6)))], "Date date, C91 double, D503A double, D503B double, D503C double, D502A double, D502B double")
    assert len(rows(landing.land_east_side(sheet, "run"))) == 6


def test_cells_of_a_line(spark):
    lines = ['a,b,,d', '1,"2,345.5",x', '"a ""b"", c",,"d,e"', "", ",", 'B,, N1 ,"N 2"']
    got = [r[0] for r in spark.createDataFrame([(t,) for t in lines], "line string").select(exports.cells(F.col("line"))).collect()]
    m = exports.MASK
    assert got == [
        ["a", "b", "", "d"], ["1", f"2{m}345.5", "x"], [f"a b{m} c", "", f"d{m}e"], [""], ["", ""], ["B", "", " N1 ", "N 2"]
    ]


def test_quoted_headers_counters_and_numbers(spark, tmp_path, rows):
    write(tmp_path / "q.csv", 'A,,MODEL\n"B",,"C,1", C2 \n"1,000",31Oct1921,"4,395.5",7\n1001, "30Nov1921" ,,"x"\nB,,late header\n')
    df = exports.node_export(spark, str(tmp_path / "q.csv"), ["C,1", "C2"])
    assert rows(df, "date", "node", "flow_cfs") == [
        (dt.date(1921, 10, 31), "C,1", 4395.5), (dt.date(1921, 10, 31), "C2", 7.0),
        (dt.date(1921, 11, 30), "C,1", None), (dt.date(1921, 11, 30), "C2", None),
    ]


def test_a_wide_line_takes_time_in_proportion(spark, tmp_path):
    """Eight times the nodes: sixty-four times the time if each comma looked along its line."""
    times = {}
    for nodes in (1000, 8000):
        head = "B,," + ",".join(f"C{i}" for i in range(nodes))
        month = ",".join('"1,234.5"' for _ in range(nodes))
        write(tmp_path / str(nodes) / "a.csv", "\n".join([head, *(f"{i},31Oct{1900 + i}," + month for i in range(100))]))
        for _ in range(2):
            start = time.perf_counter()
            total = exports.node_export(spark, str(tmp_path / str(nodes)), ["C5", f"C{nodes - 1}"]).agg(F.sum("flow_cfs")).first()[0]
            times[nodes] = time.perf_counter() - start
        assert total == 200 * 1234.5
    assert times[8000] < 24 * times[1000]
