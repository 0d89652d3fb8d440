"""The analyses' inputs, derived from the warehouse tables (line items, suppliers, events)."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..binding import Panel
from ..functions.values import clean_name
from ..session import fresh_path
from .panel_csv import csv_text

ROLES = {
    "date": "date", "entity": "entity", "area": "area", "cases": "cases", "deaths": "deaths",
    "pop": "pop", "rate": "rate",
}
MESSY = "spelled"


# The columns that are read of each table. With a schema given, no job is run to find one.
SCHEMAS = {
    "lineitem": "l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


_done: dict[tuple[Any, ...], Any] = {}


def once(spark: SparkSession, folder: str, kind: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once per application, table folder and state of its files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    state = files.agg(F.count("*"), F.sum("length"), F.max("modificationTime").cast("string")).first()
    key = (spark.sparkContext.applicationId, folder, tuple(state), kind)
    if key not in _done:
        _done[key] = make()
    return _done[key]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def messy_name(name, key):
    """Six ways to spell a nation, by supplier key: plain, lower case, a letter lost, a suffix,
    words swapped, and a name that means nothing."""
    number = F.regexp_extract(name, r"(\d+)", 1)
    lost = F.pmod(key, F.lit(5)) + 1
    return (
        F.when(F.pmod(key, F.lit(6)) == 0, name)
        .when(F.pmod(key, F.lit(6)) == 1, F.lower(name))
        .when(
            F.pmod(key, F.lit(6)) == 2,
            F.concat(F.substring(name, F.lit(1), lost.cast("int")), F.substring(name, (lost + 2).cast("int"), F.length(name))),
        )
        .when(F.pmod(key, F.lit(6)) == 3, F.concat(name, F.lit(" (site "), key.cast("string"), F.lit(")")))
        .when(F.pmod(key, F.lit(6)) == 4, F.concat(number, F.lit("_NATION")))
        .otherwise(F.concat(F.lit("DEPOT_"), key.cast("string")))
    )


def territories(spark: SparkSession, folder: str) -> DataFrame:
    """One row per supplier: its nation as entity, region as area, the nation's population, and
    the nation's name as this supplier spells it.

    The population is 1000 per supplier of the nation in debt. A nation without any has
    population 0 if its key is odd, an unknown one if it is even.
    """
    supplier, nation, region = (table(spark, folder, t) for t in ("supplier", "nation", "region"))
    debtors = F.count(F.when(F.col("s_acctbal") < 0, 1))
    people = supplier.groupBy(F.col("s_nationkey").alias("pop_nation")).agg(
        F.when((debtors > 0) | (F.col("s_nationkey") % 2 == 1), debtors * 1000).alias("pop")
    )
    nations = (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(people, F.col("n_nationkey") == F.col("pop_nation"), "left")
        .select("n_nationkey", "n_name", "r_name", "pop")
    )
    return supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey",
        F.col("n_name").alias("entity"),
        F.col("r_name").alias("area"),
        "pop",
        messy_name(F.col("n_name"), F.col("s_suppkey")).alias(MESSY),
    )


def observations(spark: SparkSession, folder: str) -> Panel:
    """Line items as the daily panel, typed, with the rate left as dirty text.

    One large join, with the territories; a filter on area or entity is applied to them before it.
    The date is a cast of the stored column, so date filters and unused columns are pruned in the
    line item scan.
    """
    item = table(spark, folder, "lineitem")
    joined = item.join(territories(spark, folder), F.col("l_suppkey") == F.col("s_suppkey"))
    quantity = F.col("l_quantity").cast("bigint")
    df = joined.select(
        F.col("l_shipdate").cast("date").alias("date"),
        "entity",
        "area",
        quantity.alias("cases"),
        F.when(F.col("l_returnflag") == "R", F.col("l_linenumber")).otherwise(0).cast("bigint").alias("deaths"),
        "pop",
        F.when(F.col("l_returnflag") == "A", "").otherwise(quantity.cast("string")).alias("rate"),
        MESSY,
    )
    return Panel(df, **ROLES)


def messy_observations(spark: SparkSession, folder: str) -> Panel:
    """The panel under the entity names as they were spelled."""
    p = observations(spark, folder)
    return p.using(p.df, entity=MESSY)


def observation_text(spark: SparkSession, folder: str) -> DataFrame:
    """The panel as the text rows of the CSV layout."""
    return csv_text(observations(spark, folder))


def observation_csv(spark: SparkSession, folder: str) -> str:
    """Path of the whole panel written as CSV."""
    def write():
        path = fresh_path(spark, "observations")
        observation_text(spark, folder).write.option("header", True).option("escape", '"').csv(path)
        return path

    return once(spark, folder, "observations", write)


def territory_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """(name, alpha_3) of the nations."""
    nation = table(spark, folder, "nation")
    key = F.col("n_nationkey").cast("string")
    code = F.concat(F.lit("N"), F.when(F.length(key) < 2, F.lpad(key, 2, "0")).otherwise(key))
    return nation.select(clean_name("n_name").alias("name"), code.alias("alpha_3"))


def subarea_table(spark: SparkSession, folder: str) -> DataFrame:
    """(sub_area, area, entity): the nations of AMERICA, split by the parity of their key."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    side = F.when(F.col("n_nationkey") % 2 == 0, "AMERICA EVEN").otherwise("AMERICA ODD")
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .filter(F.col("r_name") == "AMERICA")
        .select(side.alias("sub_area"), F.col("r_name").alias("area"), F.col("n_name").alias("entity"))
    )


def spelling_fixes(spark: SparkSession, folder: str) -> DataFrame:
    """(raw, fixed): every second depot is known to belong to its supplier's nation."""
    supplier, nation = table(spark, folder, "supplier"), table(spark, folder, "nation")
    return (
        supplier.filter((F.col("s_suppkey") % 6 == 5) & (F.col("s_suppkey") % 4 == 1))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.concat(F.lit("DEPOT_"), F.col("s_suppkey").cast("string")).alias("raw"), F.col("n_name").alias("fixed"))
    )


def run_results(spark: SparkSession, folder: str) -> DataFrame:
    """Events as benchmark runs: the type is the framework, the user decides workload and variant."""
    user = F.col("user_id")
    workload = (user % 3).cast("string")
    ending = (
        F.when(user % 4 == 0, "_data")
        .when(user % 4 == 1, "_data_small")
        .when(user % 4 == 2, "_data_large")
        .otherwise("_baseline")
    )
    event = F.col("event_id").cast("string")
    return table(spark, folder, "events").select(
        F.col("event_type").alias("framework"),
        workload.alias("workload"),
        F.when(user % 5 == 0, F.concat(event, F.lit("_Small"))).otherwise(event).alias("runid"),
        F.col("value").alias("wall_time_sec"),
        (20_000 + user * 128).alias("max_rss_kb"),
        F.concat("event_type", F.lit("_"), workload, F.lit("_run"), event, ending, F.lit(".time.txt")).alias("logfile"),
    )


def run_log_text(hundredths, rss):
    """A run log: the lines with elapsed time and memory peak, between some that are not read."""
    whole = F.floor(hundredths / 100)
    minutes = F.floor(whole / 60)
    clock = F.when(
        whole >= 3600,
        F.format_string("%d:%02d:%02d", F.floor(whole / 3600), minutes % 60, whole % 60),
    ).otherwise(F.format_string("%d:%02d.%02d", minutes, whole % 60, hundredths % 100))
    return F.concat_ws(
        "\n",
        F.lit("\tUser time (seconds): 0.01"),
        F.concat(F.lit("\tElapsed (wall clock) time (h:mm:ss or m:ss): "), clock),
        F.lit("\tAverage total size (kbytes): 0"),
        F.concat(F.lit("\tMaximum resident set size (kbytes): "), rss.cast("string")),
        F.lit("\tExit status: 0"),
    )


def run_log_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(logfile, text): one log per event, its value taken as minutes."""
    hundredths = F.round(F.col("wall_time_sec") * 100).cast("bigint") * 60
    runs = run_results(spark, folder)
    return runs.select("logfile", run_log_text(hundredths, F.col("max_rss_kb")).alias("text"))


def run_log_files(spark: SparkSession, folder: str) -> str:
    """Glob of run logs on disk: one per event type, workload and week, over all events.

    The time of a log is the number of its events in hundredths of a second, its memory the sum
    of the users' keys.
    """
    def write():
        path = fresh_path(spark, "runlogs")
        logs = (
            table(spark, folder, "events")
            .groupBy(
                F.col("event_type").alias("framework"),
                (F.col("user_id") % 3).cast("string").alias("workload"),
                F.weekofyear("ts").cast("string").alias("week"),
            )
            .agg(F.count("*").alias("events"), F.sum("user_id").alias("rss"))
        )
        name = F.concat("framework", F.lit("_"), "workload", F.lit("_run"), "week", F.lit("_data.time.txt"))
        text = run_log_text(F.col("events"), F.col("rss"))
        logs.select(name.alias("log"), text.alias("value")).write.partitionBy("log").text(path)
        return path + "/*.time.txt"

    return once(spark, folder, "runlogs", write)


def run_result_csv(spark: SparkSession, folder: str) -> str:
    """Path of the run results written as CSV."""
    def write():
        path = fresh_path(spark, "runresults")
        run_results(spark, folder).write.option("header", True).csv(path)
        return path

    return once(spark, folder, "runresults", write)
