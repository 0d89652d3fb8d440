"""The dirty rows: what each operator makes of blanks, bad text, ties, empty groups."""

import datetime as dt

import pytest
from conftest import HEADER, ROWS, as_dict, csv_line, rows
from pyspark.sql import functions as F

from panelkit.constants import SHORT_LABELS, SUBAREAS
from panelkit.operators import ranking, running, totals, trends
from panelkit.operators import rows as row_ops
from panelkit.plans import dashboard as dash
from panelkit.plans import reports
from panelkit.sources import tables
from panelkit.sources.panel_csv import read_panel

BONAIRE = "Bonaire, Saint Eustatius and Saba"


def test_typed_read(panel):
    types = dict(panel.df.dtypes)
    assert types["cases"] == types["deaths"] == types["popData2019"] == "bigint"
    assert types["dateRep"] == "date" and types[panel.rate] == "double"
    assert panel.df.count() == len(ROWS)
    assert panel.df.filter(F.col("dateRep").isNull()).count() == 2
    assert panel.df.filter(F.col("cases").isNull()).count() == 2


@pytest.mark.parametrize("how", [{"infer": True}, {"by_position": True}])
def test_other_readers_give_the_same(spark, csv_path, panel, how):
    assert sorted(map(str, rows(read_panel(spark, csv_path, **how).df))) == sorted(map(str, rows(panel.df)))


def test_split_files_lose_no_row(spark, tmp_path, panel):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text("\n".join([HEADER, *map(csv_line, ROWS[i::3])]) + "\n", encoding="utf-8")
    assert read_panel(spark, str(tmp_path)).df.count() == len(ROWS)


def test_header_is_trimmed_and_month_added(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_text("\n".join([HEADER.replace(",cases,", ", cases ,"), csv_line(ROWS[0])]) + "\n")
    p = read_panel(spark, str(path), add_month=True)
    assert rows(p.df, "cases", "month") == [(10, "2019-12")]


def test_totals(panel):
    got = as_dict(totals.totals(panel, panel.entity), panel.entity, "total_cases", "total_deaths")
    assert got["Alpha_Land"] == (60, 11)
    assert got["Beta"] == (68, 7)
    assert got["Quiet"] == (0, 0)
    assert got[None] == (2, 0)
    assert None not in as_dict(totals.totals(panel, panel.entity, drop_null_keys=True), panel.entity, "total_cases")


def test_totals_of_nothing_but_nulls_are_zero(panel):
    p = panel.where(F.col("cases").isNull())
    assert as_dict(totals.totals(p, p.area), p.area, "total_cases") == {"Europe": 0, "Asia": 0}


def test_ratio(panel):
    got = as_dict(totals.ratio(panel), panel.entity, "ratio")
    assert got["Quiet"] == 0.0 and got["Alpha_Land"] == 11 / 60
    strict = as_dict(totals.ratio(panel, strict=True), panel.entity, "ratio")
    assert strict["Alpha_Land"] == 6 / 60 and strict["Beta"] == 6 / 60


def test_rate_per(panel):
    got = as_dict(totals.rate_per(panel), panel.entity, "population", "cases_per_100000")
    assert got["Alpha_Land"] == (1000, 6000.0)
    assert got["Beta"] == (None, 0.0) and got["Quiet"] == (0, 0.0)
    assert "Beta" not in as_dict(totals.rate_per(panel, require_pop=True), panel.entity, "population")


def test_rate_split_by_population(panel):
    changed = panel.using(
        panel.df.withColumn("popData2019", F.when(F.col("dateRep") < "2020-01-01", 500).otherwise(F.col("popData2019")))
    )
    got = rows(totals.rate_per(changed, split_by_pop=True).filter(F.col(panel.entity) == "Alpha_Land"), "population", "total_cases")
    assert sorted(got) == [(500, 10), (1000, 50)]


def test_rate_stats(panel):
    got = as_dict(totals.rate_stats(panel), panel.entity, "avg_rate", "max_rate", "min_rate")
    assert got["Beta"] == (6.0, 8.0, 4.0) and got["Alpha_Land"] == (2.0, 2.5, 1.5)
    assert BONAIRE not in got


def test_filters(panel):
    def entities(p):
        return sorted(x[0] for x in rows(p.df.select(p.entity).na.drop().distinct()))

    assert entities(row_ops.filter_area(panel, "Asia")) == ["Beta", "Quiet"]
    assert row_ops.filter_area(panel, None) is panel and row_ops.filter_month(panel, "All") is panel
    assert entities(row_ops.filter_month(panel, "2019-12")) == ["Alpha_Land"]
    assert entities(row_ops.filter_area(panel, "South America", {"South America": ["Curaçao", "Beta"]})) == ["Curaçao"]
    assert entities(row_ops.filter_area(panel, "America", SUBAREAS)) == [BONAIRE, "Curaçao"]
    assert rows(row_ops.row_count(row_ops.apply_filters(panel, "Europe", "2020-01", "Alpha_Land"))) == [(2,)]


def test_rows_that_are_dropped(panel):
    assert row_ops.strict_rows(panel).df.count() == 8
    assert row_ops.drop_unparsable(panel, panel.rate).df.count() == 8
    assert row_ops.require_cols(panel, ["popData2019", panel.entity]).df.count() == 7


def test_threshold_falls_back_to_all_rows(panel):
    grouped = totals.totals(panel, panel.entity)
    assert row_ops.min_threshold(grouped, "total_cases", 60).count() == 3
    assert row_ops.min_threshold(grouped, "total_cases", 61).count() == 2
    assert row_ops.min_threshold(grouped, "total_cases", 1000).count() == grouped.count()
    assert row_ops.min_threshold(grouped.limit(0), "total_cases", 1).count() == 0


def test_top_n_breaks_ties_by_name(panel):
    grouped = totals.totals(panel, panel.entity, drop_null_keys=True)
    assert rows(ranking.top_n(grouped, "total_cases", 2, panel.entity), panel.entity) == [("Beta",), ("Curaçao",)]
    shown = ranking.top_n(grouped, "total_cases", 3, panel.entity, display="asc")
    assert rows(shown, panel.entity) == [("Alpha_Land",), ("Curaçao",), ("Beta",)]


def test_top_reports(panel):
    assert rows(ranking.top_ratio(panel, 1, 60), panel.entity) == [("Alpha_Land",)]
    assert rows(ranking.top_rate(panel, 5, 1000), panel.entity) == [("Alpha_Land",)]
    assert len(rows(ranking.top_rate(panel, 50, 10**9))) == 6
    assert rows(ranking.top_rate_stats(panel, 1), panel.entity) == [("Curaçao",)]
    assert rows(ranking.top_labels(panel, 3), "label")[2] == ("Alpha Land",)


def test_fixed_order(spark):
    df = spark.createDataFrame([(x,) for x in ["zeta", "small", "large", None, "alpha", "data"]], "v string")
    got = [r[0] for r in rows(ranking.order_by_category(df, {"v": ["large", "data", "small"]}))]
    assert got == ["large", "data", "small", "alpha", "zeta", None]


def test_weeks_at_the_turn_of_the_year(panel):
    europe = row_ops.filter_area(panel, "Europe")
    iso = {(r["year"], r["week"]): r["total_cases"] for r in trends.trend(europe, "week").collect()}
    assert iso == {(2020, 1): 30, (2020, 53): 30}
    calendar = {(r["year"], r["week"]) for r in trends.trend(europe, "week", week_year="calendar").collect()}
    assert calendar == {(2019, 1), (2020, 1), (2021, 53)}


def test_multi_trend_agrees_with_each_trend(panel):
    multi = trends.multi_trend(panel)
    for level in ("day", "week", "month"):
        one = trends.trend(panel, level, panel.entity)
        assert multi.filter(F.col("level") == level).count() == one.count()
        assert multi.filter(F.col("level") == level).agg(F.sum("total_cases")).collect() == (
            one.agg(F.sum("total_cases")).collect()
        )
    keys = {r["key"] for r in trends.tagged_key(multi, panel.entity).collect()}
    assert {"Alpha_Land|2019-12-30", "Alpha_Land|2020-W01", "Alpha_Land|2019-12"} <= keys


def test_months(panel):
    assert [r[0] for r in rows(totals.months(panel))] == ["2019-12", "2020-01", "2021-01"]
    assert rows(trends.month_snapshot(panel)) == [("2021-01", "Alpha Land", 30)]
    assert as_dict(trends.month_snapshot(panel, "2020-01"), "label", "total_cases")["Alpha Land"] == 20
    assert trends.month_snapshot(panel, "2018-05").count() == 0


def test_running_totals(panel):
    got = [
        (r["dateRep"], r["cumulative_cases"], r["cumulative_deaths"])
        for r in running.cumulative(row_ops.filter_entity(panel, "Alpha_Land")).orderBy("dateRep").collect()
    ]
    assert got == [(dt.date(2019, 12, 30), 10, 1), (dt.date(2020, 1, 1), 30, 8), (dt.date(2021, 1, 1), 60, 11)]
    final = as_dict(running.cumulative_final(panel), panel.entity, "last_date", "cumulative_cases")
    assert final["Alpha_Land"] == (dt.date(2021, 1, 1), 60)


def test_running_records(panel):
    asia = running.cumulative_records(row_ops.filter_area(panel, "Asia")).orderBy(F.col("dateRep"), panel.entity)
    assert rows(asia, "dateRep", panel.entity, "cumulative_cases") == [
        (None, "Beta", 8), (dt.date(2020, 1, 2), "Beta", 68), (dt.date(2020, 1, 3), "Quiet", 68),
    ]


def test_members(spark, panel):
    assert [r[0] for r in rows(totals.members(panel, panel.area))] == ["America", "Asia", "Europe"]
    nested = spark.createDataFrame(
        [("South America", "America", "x"), ("North America", "America", "y"), ("Far", "Nowhere", "z")],
        "sub_area string, area string, entity string",
    )
    got = [r[0] for r in rows(totals.members(panel, panel.area, nested))]
    assert got == ["America", "North America", "South America", "Asia", "Europe"]


def test_sinks(spark, panel, tmp_path):
    grouped = totals.totals(panel, panel.entity)
    want = sorted(map(str, rows(grouped)))
    for n, write in enumerate([tables.write_csv, tables.write_json, tables.write_tsv, tables.write_table]):
        path = str(tmp_path / str(n))
        for _ in range(2):  # the second write replaces the first
            assert sorted(map(str, rows(write(grouped, path)))) == want
    for df in (grouped, grouped.limit(2)):
        assert tables.load_table(df, "panelkit_test", str(tmp_path / "t")).count() == df.count()


def test_summary_of_result(panel):
    grouped = totals.totals(panel, panel.entity).orderBy(F.desc("total_cases"), panel.entity)
    got = rows(tables.summarize_result(grouped, 2), panel.entity, "groups")
    assert got == [("Beta", 6), ("Curaçao", 6)]


def test_reports(spark, csv_path, tmp_path):
    top = reports.top_countries_job(spark, csv_path, str(tmp_path / "top"), 2)
    assert top.columns == ["countriesAndTerritories", "total_cases", "total_deaths"] and top.count() == 2
    assert reports.ratio_job(spark, csv_path, str(tmp_path / "ratio"), 20, 60).count() == 3
    months = rows(reports.monthly_job(spark, csv_path, str(tmp_path / "month")))
    assert (2019, 12, 10, 1) in months and len(months) == 4


def test_dashboard(spark, panel):
    dim = spark.createDataFrame([("Alpha Land", "ALP"), ("Curaçao", "CUW"), ("beta", "BET")], "name string, alpha_3 string")
    got = dash.dashboard(panel, dim)
    assert as_dict(got["map"], "iso_a3", "total_cases") == {"ALP": 60, "CUW": 68, "BET": 68}
    assert {r["iso_a3"] for r in got["map_snapshot"].collect()} == {"ALP"}
    assert got["top50"].columns == ["label", "total_cases"]
    assert rows(got["series"])[0] == (dt.date(2019, 12, 30), 10)
    assert "series" not in dash.dashboard(panel, dim, month="2020-01")


def test_map_frames(panel):
    frames = dash.map_frames(panel)
    assert {(r["range_low"], r["range_high"]) for r in frames.collect()} == {(0, 68)}
    assert "2019-12-30" in {r["frame"] for r in frames.collect()}


def test_short_labels_are_part_of_the_fixed_values():
    assert SHORT_LABELS["United_Kingdom"] == "UK" and len(SUBAREAS["North America"]) == 23


@pytest.mark.parametrize("times", [5])
def test_replicated_rows_scale_sums_and_keep_ratios(panel, times):
    copies = panel.using(panel.df.withColumn("copy", F.explode(F.array(*[F.lit(i) for i in range(times)]))))
    once = as_dict(totals.ratio(panel), panel.entity, "total_cases", "ratio")
    many = as_dict(totals.ratio(copies), panel.entity, "total_cases", "ratio")
    assert many == {k: (cases * times, ratio) for k, (cases, ratio) in once.items()}


def test_last_running_total_is_the_total(panel):
    total = as_dict(totals.totals(panel, panel.entity), panel.entity, "total_cases")
    last = running.cumulative(panel).groupBy(panel.entity).agg(F.max("cumulative_cases").alias("last"))
    assert as_dict(last, panel.entity, "last") == total
