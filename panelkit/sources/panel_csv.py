"""Reading the daily panel from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..binding import RATE_COLUMN, Panel
from ..functions.calendar import DAY_FIRST, month_label, to_day
from ..functions.values import number_in

# The columns of the daily CSV, by position.
CSV_COLUMNS = [
    "dateRep", "day", "month", "year", "cases", "deaths", "countriesAndTerritories", "geoId",
    "countryterritoryCode", "popData2019", "continentExp", RATE_COLUMN,
]
CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CSV_COLUMNS])


def typed_panel(p: Panel, date_format: str = DAY_FIRST) -> Panel:
    """Dates, counts, population and rate of a text panel as numbers; null where they do not parse."""
    columns = {c: number_in(p.df, c) for c in (p.cases, p.deaths, p.pop) if c in p.df.columns}
    if p.rate in p.df.columns:
        columns[p.rate] = number_in(p.df, p.rate, "double")
    if dict(p.df.dtypes)[p.date] == "string":
        columns[p.date] = to_day(p.date, date_format)
    else:
        columns[p.date] = F.col(p.date).cast("date")
    return p.using(p.df.withColumns(columns))


def read_panel(
    spark: SparkSession,
    path: str,
    binding: Panel | None = None,
    infer: bool = False,
    by_position: bool = False,
    add_month: bool = False,
    typed: bool = True,
    date_format: str = DAY_FIRST,
    multiline: bool = False,
) -> Panel:
    """The CSV panel: header skipped by the reader, quoted fields and UTF-8 understood.

    Columns are found by header name, with outer blanks removed, or ``by_position`` in the fixed
    layout. ``infer`` reads the data once more to guess types; the typed result is the same
    without it. ``typed=False`` keeps the text. ``multiline`` allows line ends inside quotes, at
    the price of files that cannot be split.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    if by_position:
        df = reader.schema(CSV_SCHEMA).csv(path)
    else:
        df = reader.option("inferSchema", infer).csv(path)
        df = df.toDF(*[c.strip() for c in df.columns])
    binding = binding.using(df) if binding else Panel(df)
    p = typed_panel(binding, date_format) if typed else binding
    if add_month:
        day = F.col(p.date) if typed else to_day(p.date, date_format)
        p = p.using(p.df.withColumn("month", month_label(day)))
    return p


def csv_text(p: Panel) -> DataFrame:
    """A panel in the fixed CSV layout, all text, with an unparsable value as a blank.

    ``p`` holds text in its rate role and dates, counts and names elsewhere.
    """
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    role = {
        "dateRep": F.date_format(p.date, DAY_FIRST),
        "day": F.dayofmonth(p.date).cast("string"),
        "month": F.month(p.date).cast("string"),
        "year": F.year(p.date).cast("string"),
        "cases": text(p.cases),
        "deaths": text(p.deaths),
        "countriesAndTerritories": F.col(p.entity),
        "geoId": F.lit(""),
        "countryterritoryCode": F.lit(""),
        "popData2019": text(p.pop),
        "continentExp": F.col(p.area),
        RATE_COLUMN: text(p.rate),
    }
    return p.df.select(*[role[c].alias(c) for c in CSV_COLUMNS])
