"""Replacing stored results, one ordered file, and sums that outlive a choice."""

import csv

import pytest
from conftest import HEADER, ROWS, csv_line, rows
from pyspark.sql import functions as F

from panelkit.operators.rows import apply_filters
from panelkit.operators.totals import totals
from panelkit.plans.rollup import rollup
from panelkit.sources.panel_csv import read_panel
from panelkit.sources.tables import load_table, read_table, write_one_csv, write_table


def test_a_result_can_replace_itself(spark, tmp_path):
    path = str(tmp_path / "result")
    write_table(spark.range(5), path)
    again = read_table(spark, path)
    write_table(again.union(again), path)
    assert read_table(spark, path).count() == 10
    assert again.count() == 5  # a reader that began before keeps its rows


def test_a_failing_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "result")
    write_table(spark.range(3), path)
    bad = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_table(bad, path)
    assert sorted(rows(read_table(spark, path))) == [(0,), (1,), (2,)]


def test_a_plain_folder_is_read_as_it_is(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "plain"))
    assert read_table(spark, str(tmp_path / "plain")).count() == 4


def test_a_named_table_can_replace_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    load_table(spark.range(4), "panelkit_replaced", path)
    load_table(spark.table("panelkit_replaced").where("id > 1"), "panelkit_replaced", path)
    assert sorted(rows(spark.table("panelkit_replaced"))) == [(2,), (3,)]
    spark.sql("DROP TABLE panelkit_replaced")


def test_one_csv_in_order_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "all.csv")
    df = spark.range(5_000).select((F.lit(4_999) - F.col("id")).alias("n"), F.concat(F.lit('a "b",\t'), F.col("id")).alias("odd, name"))
    stages = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one csv", "")
    again = write_one_csv(df.repartition(4), path, ["n"], parts=5)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    counts = [stages.getStageInfo(s).numTasks for j in stages.getJobIdsForGroup("one csv") for s in stages.getJobInfo(j).stageIds]
    assert 5 in counts
    with open(path, newline="") as file:
        found = list(csv.reader(file))
    assert found[0] == ["n", "odd, name"] and [int(r[0]) for r in found[1:]] == list(range(5_000))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, df.collect()))
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["all.csv"]
    assert write_one_csv(df.limit(0), path, ["n"]).count() == 0  # replaces, and has its header
    assert open(path).read() == 'n,"odd, name"\n'


def test_choices_share_one_scan_and_new_files_are_added(spark, tmp_path):
    lines = [csv_line(r) for r in ROWS]
    names = []
    for i, some in enumerate((lines[:5], lines[5:9], lines[9:])):
        names.append(str(tmp_path / f"{i}.csv"))
        with open(names[-1], "w", encoding="utf-8") as file:
            file.write("\n".join([HEADER, *some]) + "\n")
    reads = []

    def read(paths):
        reads.append(paths)
        return read_panel(spark, paths)

    def sums(p):
        return sorted(rows(totals(p, [p.entity, p.area, p.date])), key=str)

    home = str(tmp_path / "home")
    assert sums(rollup(spark, home, names[:2], read)) == sums(read_panel(spark, names[:2]))
    for area in ("Europe", "Asia", None):
        p = rollup(spark, home, names[:2], read)
        assert "csv" not in p.df._jdf.queryExecution().optimizedPlan().toString().lower()
        assert sums(apply_filters(p, area)) == sums(apply_filters(read_panel(spark, names[:2]), area))
    reads.clear()
    assert sums(rollup(spark, home, names, read)) == sums(read_panel(spark, names)) and reads == [names[2:]]
    with open(names[0], "a", encoding="utf-8") as file:
        file.write(lines[0] + "\n")
    reads.clear()
    assert sums(rollup(spark, home, names, read)) == sums(read_panel(spark, names)) and reads == [names]
    assert sums(rollup(spark, home, names[1:], read)) == sums(read_panel(spark, names[1:]))
