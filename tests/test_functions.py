from conftest import rows
from pyspark.sql import functions as F

from panelkit.functions import calendar, runtext, values


def one(spark, schema, data, *columns):
    df = spark.createDataFrame(data, schema)
    return rows(df.select(*columns))


def test_to_number(spark):
    texts = ["12", " -7 ", "12.5", "", "  ", "abc", None, "99999999999999999999", "1e3"]
    got = one(
        spark, "t string", [(t,) for t in texts],
        values.to_number("t"), values.to_number("t", "double"),
    )
    assert [g[0] for g in got] == [12, -7, None, None, None, None, None, None, None]
    assert [g[1] for g in got] == [12.0, -7.0, 12.5, None, None, None, None, 1e20, 1000.0]


def test_dates(spark):
    got = one(
        spark, "t string", [("30/12/2019",), ("31/02/2020",), ("2020-01-01",), ("",), (None,)],
        calendar.to_day("t").cast("string"),
        calendar.bucket_label(calendar.to_day("t"), "week"),
        calendar.bucket_label(calendar.to_day("t"), "week", "calendar"),
        calendar.bucket_label(calendar.to_day("t"), "month"),
    )
    assert got == [("2019-12-30", "2020-W01", "2019-W01", "2019-12")] + [(None,) * 4] * 4


def test_names_and_labels(spark):
    got = one(
        spark, "t string", [(" United_Kingdom ",), ("Falkland (Malvinas)",), (None,)],
        values.clean_name("t"), values.strip_parens("t"), values.relabel(values.clean_name("t"), {"United Kingdom": "UK"}),
    )
    assert got == [
        ("United Kingdom", "United_Kingdom", "UK"),
        ("Falkland (Malvinas)", "Falkland", "Falkland (Malvinas)"),
        (None, None, None),
    ]


def test_formats(spark):
    got = one(
        spark, "v double", [(0.250799,), (1234567.89,)],
        values.fmt_number("v", 3), values.fmt_number("v", 1, "percent"), values.fmt_number("v", 0, "thousands"),
    )
    assert got[0] == ("0.251", "25.1%", "0") and got[1][2] == "1,234,568"


LOG = """\tCommand being timed: "run"
\tUser time (seconds): 0.01
\tElapsed (wall clock) time (h:mm:ss or m:ss): {}
\tMaximum resident set size (kbytes): {}
\tExit status: 0
"""


def test_logs(spark):
    texts = [LOG.format("0:08.09", 26880), LOG.format("1:02:03", "?"), "Elapsed time: 7.5\n", "nothing"]
    got = one(spark, "t string", [(t,) for t in texts], runtext.elapsed_seconds("t"), runtext.max_rss_kb("t"))
    assert got == [(8.09, 26880), (3723.0, None), (7.5, None), (None, None)]


def test_log_names(spark):
    parts = runtext.log_name_parts("n")
    got = one(
        spark, "n string", [("logs/spark_A_run12_data_small.time.txt",), ("spark_A.time.txt",), ("a_b_c.txt",)],
        parts["framework"], parts["workload"], parts["runid"],
    )
    assert got == [("spark", "A", "12"), (None, None, None), ("a", "b", None)]


def test_variants(spark):
    data = [
        ("1_Large_x", "any"), ("1", "logs/a_b_run1_data_small.time.txt"), ("1", "a_b_run1_data.out.txt"),
        (None, "a_b_run1.err.txt"), ("1", None), (None, ""), ("2", "plain.csv"),
    ]
    got = one(
        spark, "r string, l string", data, runtext.variant_of("r", "l"), runtext.variant_of_log("l"),
        runtext.normalize_variant(runtext.variant_of("r", "l")),
    )
    assert [g[0] for g in got] == ["Large_x", "small", "data", "run1", "unknown", "unknown", "plain.csv"]
    assert [g[1] for g in got] == ["data", "small", "data", "data", "data", "data", "data"]
    assert [g[2] for g in got] == ["big", "small", "normal", "run1", "unknown", "unknown", "plain.csv"]


def test_normalize_variant(spark):
    data = [(x,) for x in ["DATA", "Baseline", "normal", "big", "xLargex", "smallish", "odd", None]]
    got = one(spark, "v string", data, runtext.normalize_variant("v"))
    assert [g[0] for g in got] == ["normal", "normal", "normal", "big", "big", "small", "odd", "unknown"]


def test_month_start_and_guard(spark):
    got = one(
        spark, "y int, m int", [(2020, 2)],
        calendar.month_start("y", "m").cast("string"), values.guarded(F.col("y") > 3000, F.lit(1.0), 0.0),
        values.scale("m", "y", 1010), values.zero_if_null(F.lit(None).cast("int")),
    )
    assert got == [("2020-02-01", 0.0, 1.0, 0)]
