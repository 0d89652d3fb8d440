"""Name matching."""

from pyspark.sql import functions as F

from ..functions.values import clean_name
from ..operators.names import (
    SUBSET_SCORE,
    apply_fixes,
    attach_values,
    daily_names,
    fill_unmatched,
    fuzzy_match,
    iso3,
    unmatched_count,
    unmatched_report,
    valid_names,
)
from ..operators.totals import totals
from ..sources.warehouse import (
    messy_observations,
    observations,
    spelling_fixes,
    table,
    territory_dimension,
)
from . import query
from .sql import CASES, NATION_CODES, PANEL, clean, matches
from .trends import MATCHED, THRESHOLD

FIXES = """
fixes AS (
  SELECT 'DEPOT_' || s_suppkey AS raw, n_name AS fixed FROM supplier JOIN nation ON s_nationkey = n_nationkey
  WHERE s_suppkey % 6 = 5 AND s_suppkey % 4 = 1
)
"""


@query(
    "j1_attach_values",
    PANEL + f""", {NATION_CODES}
    SELECT name, alpha_3, total_cases
    FROM codes LEFT JOIN (SELECT entity, {CASES} FROM panel GROUP BY entity) ON {clean('entity')} = name""",
)
def j1(spark, folder):
    p = observations(spark, folder)
    values = totals(p, p.entity, [p.cases]).select(clean_name(p.entity).alias("label"), "total_cases")
    return attach_values(territory_dimension(spark, folder), values, "name", "label").drop("label")


@query(
    "j2_codes_of_names",
    PANEL + f""", {NATION_CODES}, names AS (SELECT DISTINCT spelled FROM panel), tried AS (
      SELECT spelled, regexp_replace({clean('spelled')}, '^([0-9]+) NATION$', 'NATION \\1') AS tried FROM names
    )
    SELECT spelled, coalesce(a.alpha_3, b.alpha_3) AS iso_a3 FROM tried
    LEFT JOIN forms a ON a.form = lower(tried)
    LEFT JOIN forms b ON b.form = lower(trim(regexp_replace(tried, '\\s*\\(.*\\)', '')))""",
)
def j2(spark, folder):
    names = messy_observations(spark, folder).df.select("spelled").distinct()
    number = F.regexp_extract("n_name", r"(\d+)", 1)
    swapped = table(spark, folder, "nation").select(
        F.concat(number, F.lit(" NATION")).alias("raw"), F.concat(F.lit("NATION "), number).alias("fixed")
    )
    return iso3(names, "spelled", territory_dimension(spark, folder), swapped)


def _valid(spark, folder):
    return territory_dimension(spark, folder).select("name")


def _matches(spark, folder):
    p = messy_observations(spark, folder)
    return fuzzy_match(p.df, p.entity, _valid(spark, folder), THRESHOLD)


@query(
    "j3_fuzzy_match",
    MATCHED + "SELECT raw, clean, match, CASE WHEN match IS NOT NULL THEN score END AS score FROM best",
)
def j3(spark, folder):
    return _matches(spark, folder)


@query(
    "j3_fuzzy_match_default_threshold",
    PANEL + "," + matches("SELECT DISTINCT spelled AS raw FROM panel", 95.0)
    + "SELECT raw, clean, match, CASE WHEN match IS NOT NULL THEN score END AS score FROM best",
)
def j3_default(spark, folder):
    p = messy_observations(spark, folder)
    return fuzzy_match(p.df, p.entity, _valid(spark, folder))


@query("j4_valid_names", "SELECT s_name AS name FROM supplier UNION SELECT c_name FROM customer")
def j4(spark, folder):
    dim = table(spark, folder, "supplier").select(F.col("s_name").alias("name"))
    return valid_names(dim, table(spark, folder, "customer").select("c_name"))


@query(
    "j5_manual_fixes",
    PANEL + f""", {FIXES}
    SELECT coalesce(fixed, spelled) AS spelled, {CASES} FROM panel LEFT JOIN fixes ON spelled = raw GROUP BY 1""",
)
def j5(spark, folder):
    p = messy_observations(spark, folder)
    fixed = apply_fixes(totals(p, p.entity, [p.cases]), p.entity, spelling_fixes(spark, folder))
    return fixed.groupBy(p.entity).agg(F.sum("total_cases").alias("total_cases"))


@query(
    "j6_fill_unmatched",
    MATCHED + f""", {FIXES}
    SELECT best.raw, coalesce(match, fixed, best.raw) AS match FROM best LEFT JOIN fixes ON best.raw = fixes.raw""",
)
def j6(spark, folder):
    matched = _matches(spark, folder).select("raw", "match")
    return fill_unmatched(matched, "match", "raw", spelling_fixes(spark, folder))


@query("j7_unmatched_report", MATCHED + "SELECT raw, clean, closest, score FROM best WHERE match IS NULL")
def j7(spark, folder):
    return unmatched_report(_matches(spark, folder), _valid(spark, folder))


@query(
    "j7_unmatched_count",
    MATCHED + "SELECT count(DISTINCT clean) AS unmatched FROM best WHERE match IS NULL",
)
def j7_count(spark, folder):
    return unmatched_count(_matches(spark, folder))


SPOILED = (
    "SELECT DISTINCT CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN replace(c_name, '#', '_')"
    " ELSE substr(c_name, 1, 3) || substr(c_name, 5) END AS raw FROM customer"
)
BEST = "SELECT raw, clean, match, CASE WHEN match IS NOT NULL THEN score END AS score FROM best"


def _long_list(spark, folder, threshold):
    """As many valid names as raw ones: nothing is compared but names that share a rare pair of letters."""
    customer = table(spark, folder, "customer")
    name = F.col("c_name")
    raw = (
        F.when(F.col("c_custkey") % 3 == 0, name)
        .when(F.col("c_custkey") % 3 == 1, F.translate(name, "#", "_"))
        .otherwise(F.concat(F.substring(name, 1, 3), F.substring(name, 5, 100)))
    )
    return fuzzy_match(customer.select(raw.alias("raw")), "raw", customer, threshold, "c_name")


@query("j3_fuzzy_match_long_list", "WITH " + matches(SPOILED, 90.0, "c_name", "customer") + BEST)
def j3_long(spark, folder):
    return _long_list(spark, folder, 90.0)


@query("j3_fuzzy_match_long_list_85", "WITH " + matches(SPOILED, 85.0, "c_name", "customer") + BEST)
def j3_long_85(spark, folder):
    return _long_list(spark, folder, 85.0)


PART_NAMES = (
    "SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN p_brand || ' ' || p_name WHEN 1 THEN split_part(p_name, ' ', 2)"
    " ELSE p_type || '_' || p_name END AS raw FROM part"
)


@query("j3_fuzzy_match_word_subset", "WITH " + matches(PART_NAMES, SUBSET_SCORE, "p_name", "part", SUBSET_SCORE) + BEST)
def j3_subset(spark, folder):
    part = table(spark, folder, "part")
    raw = (
        F.when(F.col("p_partkey") % 3 == 0, F.concat("p_brand", F.lit(" "), "p_name"))
        .when(F.col("p_partkey") % 3 == 1, F.get(F.split("p_name", " "), F.lit(1)))
        .otherwise(F.concat("p_type", F.lit("_"), "p_name"))
    )
    return fuzzy_match(part.select(raw.alias("raw")), "raw", part, SUBSET_SCORE, "p_name", SUBSET_SCORE)


@query(
    "a18_daily_raw_names",
    PANEL + f"SELECT CAST(date AS VARCHAR) AS date, spelled, {CASES}, count(*) AS rows FROM panel GROUP BY panel.date, spelled",
)
def raw_names(spark, folder):
    return daily_names(messy_observations(spark, folder))
