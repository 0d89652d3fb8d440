"""SQL fragments: the derived inputs of the queries as common table expressions."""

MESSY_NAME = """
CASE s_suppkey % 6
  WHEN 0 THEN n_name
  WHEN 1 THEN lower(n_name)
  WHEN 2 THEN substr(n_name, 1, CAST(s_suppkey % 5 + 1 AS INTEGER)) || substr(n_name, CAST(s_suppkey % 5 + 3 AS INTEGER))
  WHEN 3 THEN n_name || ' (site ' || s_suppkey || ')'
  WHEN 4 THEN regexp_extract(n_name, '([0-9]+)', 1) || '_NATION'
  ELSE 'DEPOT_' || s_suppkey
END
"""

PANEL = f"""
WITH people AS (
  SELECT s_nationkey AS pop_nation, count(*) FILTER (WHERE s_acctbal < 0) AS debtors
  FROM supplier GROUP BY s_nationkey
), territory AS (
  SELECT s_suppkey, n_name AS entity, r_name AS area,
         CAST(CASE WHEN debtors > 0 OR s_nationkey % 2 = 1 THEN debtors * 1000 END AS BIGINT) AS pop,
         {MESSY_NAME} AS spelled
  FROM supplier
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN people ON s_nationkey = pop_nation
), panel AS (
  SELECT CAST(l_shipdate AS DATE) AS date, entity, area,
         CAST(l_quantity AS BIGINT) AS cases,
         CAST(CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END AS BIGINT) AS deaths,
         pop,
         CASE WHEN l_returnflag = 'A' THEN '' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS rate,
         spelled
  FROM lineitem JOIN territory ON l_suppkey = s_suppkey
)
"""

SUMS = "CAST(sum(cases) AS BIGINT) AS total_cases, CAST(sum(deaths) AS BIGINT) AS total_deaths"
CASES = "CAST(sum(cases) AS BIGINT) AS total_cases"


def clean(c: str) -> str:
    return f"trim(replace({c}, '_', ' '))"


def key(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]', ' ', 'g'))"


def word_list(k: str) -> str:
    return f"list_filter(string_split({k}, ' '), lambda w: w <> '')"


def words(k: str) -> str:
    return f"array_to_string(list_sort(list_distinct({word_list(k)})), ' ')"


NATION_CODES = f"""
codes AS (
  SELECT {clean('n_name')} AS name, 'N' || lpad(CAST(n_nationkey AS VARCHAR), greatest(2, CAST(length(CAST(n_nationkey AS VARCHAR)) AS INTEGER)), '0') AS alpha_3 FROM nation
), forms AS (
  SELECT lower(name) AS form, alpha_3 FROM codes UNION SELECT lower(alpha_3), alpha_3 FROM codes
)
"""


def matches(names: str, threshold: float, base: str = "n_name", table: str = "nation", subset: float = 0) -> str:
    """CTEs that score each distinct ``raw`` of ``names`` against all valid names, by brute force."""
    one, other = word_list("key"), word_list("other")
    within = f"len({one}) > 0 AND (list_has_all({one}, {other}) OR list_has_all({other}, {one}))"
    return f"""
spelled_names AS (
  SELECT raw, {clean('raw')} AS clean, {key(clean('raw'))} AS key FROM ({names}) WHERE raw IS NOT NULL
), listed AS (
  SELECT DISTINCT {clean(base)} AS match, {key(clean(base))} AS other FROM {table}
), scored AS (
  SELECT raw, clean, match,
         greatest(CASE WHEN key = other THEN CAST(100 AS DOUBLE) ELSE 0 END,
                  CASE WHEN {words('key')} = {words('other')} THEN CAST(95 AS DOUBLE) ELSE 0 END,
                  CASE WHEN {within} THEN CAST({subset} AS DOUBLE) ELSE 0 END,
                  CAST(100 AS DOUBLE) * (1 - CAST(levenshtein(key, other) AS DOUBLE) / greatest(length(key), length(other)))) AS score
  FROM spelled_names CROSS JOIN listed
), best AS (
  SELECT raw, clean, match AS closest, score,
         CASE WHEN score >= {threshold} THEN match END AS match
  FROM scored QUALIFY row_number() OVER (PARTITION BY raw ORDER BY score DESC, match) = 1
)
"""


RUNS = """
WITH runs AS (
  SELECT event_type AS framework, CAST(user_id % 3 AS VARCHAR) AS workload,
         CASE WHEN user_id % 5 = 0 THEN event_id || '_Small' ELSE CAST(event_id AS VARCHAR) END AS runid,
         value AS wall_time_sec, 20000 + user_id * 128 AS max_rss_kb,
         event_type || '_' || (user_id % 3) || '_run' || event_id
           || CASE user_id % 4 WHEN 0 THEN '_data' WHEN 1 THEN '_data_small' WHEN 2 THEN '_data_large' ELSE '_baseline' END
           || '.time.txt' AS logfile,
         CASE user_id % 4 WHEN 0 THEN 'data' WHEN 1 THEN 'small' WHEN 2 THEN 'large' ELSE 'baseline' END AS token,
         CASE user_id % 4 WHEN 1 THEN 'small' WHEN 2 THEN 'large' ELSE 'data' END AS log_variant,
         user_id
  FROM events
), named AS (
  SELECT *, CASE WHEN user_id % 5 = 0 THEN 'Small' ELSE token END AS variant FROM runs
)
"""

LOG_FILES = """
WITH logs AS (
  SELECT event_type AS framework, CAST(user_id % 3 AS VARCHAR) AS workload, week(ts) AS week,
         count(*) AS events, CAST(sum(user_id) AS BIGINT) AS rss
  FROM events GROUP BY ALL
)
"""
