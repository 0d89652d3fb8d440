"""Run logs and summaries, against numpy and pandas."""

import random

import numpy as np
import pandas as pd
import pytest
from conftest import as_dict, rows
from test_functions import LOG

from pyspark.sql import functions as F

from panelkit.operators import quantiles as Q
from panelkit.operators import runstats as R
from panelkit.plans.runlog import run_log_job
from panelkit.sources.runs import read_results, read_run_logs


@pytest.fixture()
def logs(tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    for run, (clock, rss) in enumerate([("0:08.09", 26880), ("0:06.79", 26752), ("1:00:01", 27000)], 1):
        (folder / f"spark_A_run{run}_data.time.txt").write_text(LOG.format(clock, rss))
    (folder / "mongo_B_run1_data_small.time.txt").write_text("no times here")
    (folder / "short.time.txt").write_text(LOG.format("0:01.00", 1))
    (folder / "spark_A_run1_data.out.txt").write_text("not a log")
    return str(folder)


def test_run_log_job(spark, logs, tmp_path):
    out = run_log_job(spark, logs + "/*.time.txt", str(tmp_path / "results"))
    assert out.columns == ["framework", "workload", "runid", "wall_time_sec", "max_rss_kb", "logfile"]
    assert sorted(rows(out.drop("logfile")), key=str) == [
        ("mongo", "B", "1", None, None), ("spark", "A", "1", 8.09, 26880), ("spark", "A", "2", 6.79, 26752),
        ("spark", "A", "3", 3601.0, 27000),
    ]
    assert read_run_logs(spark, logs + "/*.time.txt").count() == 5


def test_results_are_checked_and_coerced(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("framework, wall_time_sec ,max_rss_kb,logfile\nspark,oops,5,a\nspark,1.5,,b\n")
    assert rows(read_results(spark, str(path)), "wall_time_sec", "max_rss_kb") == [(None, 5), (1.5, None)]
    path.write_text("framework,wall_time_sec\nspark,1\n")
    with pytest.raises(ValueError, match="logfile"):
        read_results(spark, str(path))


@pytest.fixture(scope="module")
def runs(spark):
    rng = random.Random(3)
    data = []
    for i in range(600):
        framework = rng.choice(["Spark", "hadoop", "hadoop", None])
        time = rng.choice([None, round(rng.lognormvariate(1, 2), 2), 7.0, round(rng.uniform(0, 3), 2)])
        variant = rng.choice(["data", "data_small", "data_large"])
        data.append((framework, rng.choice("AB"), str(i), time, rng.choice([None, rng.randint(1, 50)]), f"x_y_run{i}_{variant}.time.txt"))
    data.append(("empty", "A", "1", None, None, "x_y_run1_data.time.txt"))
    data.append(("single", "A", "1", 4.0, 9, "x_y_run1_data.time.txt"))
    schema = "framework string, workload string, runid string, wall_time_sec double, max_rss_kb bigint, logfile string"
    columns = [c.split()[0] for c in schema.split(", ")]
    frame = pd.DataFrame(data, columns=columns).astype({"wall_time_sec": float, "max_rss_kb": float})
    return spark.createDataFrame(data, schema).repartition(5), frame


def same(a, b):
    return (a is None or np.isnan(a)) and np.isnan(b) or a == pytest.approx(b)


@pytest.mark.parametrize("keep", [Q.KEEP, 1])
def test_run_summary(runs, monkeypatch, keep):
    """With KEEP = 1 brackets are narrowed until hardly a value lies inside."""
    monkeypatch.setattr(Q, "KEEP", keep)
    df, frame = runs
    got = as_dict(
        R.run_summary(df, ("framework", "workload")).withColumnRenamed("framework", "f").selectExpr("f || workload AS k", "*"),
        "k", "n", "median_time", "mean_time", "std_time", "q1_time", "q3_time", "iqr_time", "median_rss_kb", "mean_rss_kb",
    )
    groups = frame.dropna(subset=["framework"]).groupby(["framework", "workload"])
    assert set(got) == {f + w for f, w in groups.groups}
    for (f, w), g in groups:
        t, m = g["wall_time_sec"], g["max_rss_kb"]
        want = [t.count(), t.median(), t.mean(), t.std(), t.quantile(0.25), t.quantile(0.75), t.quantile(0.75) - t.quantile(0.25), m.median(), m.mean()]
        assert all(same(a, b) for a, b in zip(got[f + w], want)), (f, w, got[f + w], want)


@pytest.mark.parametrize(("accuracy", "keep", "rungs"), [(2_000, 10_000, 256), (2_000, 1, 256), (20, 5, 16)])
def test_quantiles_do_not_depend_on_the_sketch(spark, monkeypatch, accuracy, keep, rungs):
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    monkeypatch.setattr(Q, "KEEP", keep)
    monkeypatch.setattr(Q, "RUNGS", rungs)
    rng = random.Random(accuracy)
    values = {
        "hot": [rng.gauss(0, 1) for _ in range(4000)],
        "constant": [3.0] * 500,
        "outlier": [1e9] + [rng.choice([0.0, 1.0, 2.0]) for _ in range(99)],
        "halves": [1.0] * 300 + [2.0] * 300,
        "two": [1.0, 2.0],
        "one": [5.0],
    }
    rows = [(k, v, -v) for k, vs in values.items() for v in vs] + [("one", None, None), ("none", None, 1.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = as_dict(Q.quantiles(df, ["g"], ["v", "w"], probs), "g", "n_v", "q_v", "q_w")
    assert set(got) == {*values, "none"} and got["none"][:2] == (0, [None] * len(probs))
    for k, vs in values.items():
        assert got[k][0] == len(vs), k
        assert got[k][1] == pytest.approx(list(np.quantile(vs, probs))), k
        assert got[k][2] == pytest.approx(list(np.quantile([-v for v in vs], probs))), k


def test_quantiles_of_no_rows(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert Q.quantiles(df, ["g"], ["v"], [0.5]).collect() == []


def test_what_is_shuffled_does_not_grow_with_the_values(spark, monkeypatch):
    """A look leaves a row per group and value kept, and no more than KEEP are kept, whether there are 100 values or 40,000."""
    monkeypatch.setattr(Q, "KEEP", 64)
    sizes = []
    for n in (100, 2_000, 40_000):
        rows = spark.range(0, n, 1, 4).selectExpr("id % 2 AS g", "rand(7) AS v")
        state = Q.settled(Q._brackets(rows, ["g"], ["v"], [0.5], []), "test")
        counts = Q._counts(rows.join(state, "g"), ["g"], ["v"], [0.5])
        assert "Window" not in counts._jdf.queryExecution().executedPlan().toString()
        sizes.append(counts.count())
        q = dict(Q.quantiles(rows, ["g"], ["v"], [0.5]).selectExpr("g", "q_v[0]").collect())
        values = rows.toPandas()
        assert q == pytest.approx(values.groupby("g").v.median().to_dict())
    assert max(sizes) <= 2 * 65


def test_variant_medians(runs):
    df, frame = runs
    got = as_dict(R.variant_medians(df).selectExpr("framework || '/' || variant AS k", "*"), "k", "median_time", "median_rss_mb", "n")
    frame = frame.dropna(subset=["framework"]).assign(
        framework=lambda x: x.framework.str.lower(),
        variant=lambda x: x.logfile.str.extract(r"_data(?:_(\w+))?\.time")[0].fillna("data"),
    )
    for (f, v), g in frame.groupby(["framework", "variant"]):
        a = got[f"{f}/{v}"]
        assert same(a[0], g.wall_time_sec.median()) and same(a[1], (g.max_rss_kb / 1024).median()) and a[2] == len(g)


def test_workload_medians_and_summary(runs):
    df, frame = runs
    normal = as_dict(R.workload_medians(df).selectExpr("framework || workload || variant AS k", "*"), "k", "median_time", "median_rss_kb")
    picked = frame[(frame.framework == "hadoop") & (frame.workload == "A") & frame.logfile.str.contains("_data.time", regex=False)]
    assert same(normal["hadoopAnormal"][0], picked.wall_time_sec.median())
    assert normal["emptyAnormal"] == (None, None)
    short = R.workload_summary(df)
    assert short.columns == ["framework", "workload", "n", "median", "iqr", "mean", "std", "median_rss_kb"]


def test_approximate_summary_is_close(runs):
    df, _ = runs
    exact = as_dict(R.run_summary(df, ("framework",)), "framework", "n", "median_time")
    rough = as_dict(R.run_summary(df, ("framework",), approx=True), "framework", "n", "median_time")
    for k, (n, median) in exact.items():
        assert rough[k][0] == n and (median is None or abs(rough[k][1] - median) < 1.0)


def test_box_stats(spark):
    data = {"plain": [1.0, 2.0, 3.0, 4.0, 100.0], "inside": [1.0, 1.0, 1.0, 100.0], "one": [2.0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "g string, v double")
    got = as_dict(R.box_stats(df, ["g"], "v"), "g", "whisker_low", "q1", "median", "q3", "whisker_high")
    assert got["plain"] == (1.0, 2.0, 3.0, 4.0, 4.0)
    assert got["inside"] == (1.0, 1.0, 1.0, 25.75, 25.75)  # nothing lies between q3 and the fence
    assert got["one"] == (2.0,) * 5


def test_suspect_runs(runs):
    df, frame = runs
    assert R.suspect_runs(df, 0.5).count() == (frame.wall_time_sec <= 0.5).sum()
