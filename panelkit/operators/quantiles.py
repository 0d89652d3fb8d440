"""Exact interpolated quantiles per group by bracket selection, without holding or sorting a group.

A first aggregation counts each group's values and takes from a sketch a bracket around each wanted position: two values that it should lie
between. A second one over the same rows counts what lies below, on and between the ends of the brackets, and keeps the values strictly between,
if the sketch leaves room for no more than ``KEEP`` of them. A position on an end, or among the values kept, is found exactly. Brackets with more
inside get a sketch of what they hold and are narrowed to a part of it; one that misses its position is opened on that side, to the last
value that is known to lie beyond. Only such groups are looked at again. The sketch decides how many looks there are, not what comes out.

Shuffled are counts, sketches and kept values: a bounded amount per group and task, however many values there are. Brackets of all groups are a
table of a row per group, which Spark sends to the tasks or joins by group, as its size allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import settled

ACCURACY = 2_000  # a sketch's positions are off by at most rows / ACCURACY
KEEP = 10_000  # at least 1: values of a bracket that one task keeps and orders
RUNGS = 256  # parts that a sketch of a bracket's inside divides it into
STATE = "_brackets"


def _array(items) -> str:
    return f"array({', '.join(items)})"


def _brackets(df: DataFrame, by: Sequence[str], values: Sequence[str], probs: Sequence[float], also: Sequence[Column]) -> DataFrame:
    """Per group the struct ``STATE``: of each column its number, brackets, ends, the room in them, and the quantiles found so far (none)."""
    slack = 2 / ACCURACY
    shares = [min(1.0, max(0.0, p + side * slack)) for p in probs for side in (-1, 1)]
    found = []
    for k, v in enumerate(values):
        sketch = f"percentile_approx({v}, {_array(f'{x:.17g}D' for x in shares)}, {ACCURACY}) AS sketch_{k}"
        found += [f"count({v}) AS n_{k}", f"min({v}) AS least_{k}", f"max({v}) AS most_{k}", sketch]
    first = df.groupBy(*by).agg(*map(F.expr, found), *also)
    fields = [f"`{c}`" for c in first.columns if c not in by and c.rsplit("_", 1)[0] not in ("least", "most", "sketch")]
    for k in range(len(values)):
        # a position is between two ranks, and in a small group one rank is more than the slack
        low = [f"CASE WHEN {p} <= {slack} OR n_{k} < {ACCURACY} THEN least_{k} ELSE sketch_{k}[{2 * i}] END" for i, p in enumerate(probs)]
        high = [f"CASE WHEN {p} >= {1 - slack} OR n_{k} < {ACCURACY} THEN most_{k} ELSE sketch_{k}[{2 * i + 1}] END" for i, p in enumerate(probs)]
        own = {"low": low, "high": high}
        own |= {"from": [f"least_{k}"] * len(probs), "to": [f"most_{k}"] * len(probs)}
        own |= {"room": [f"CASE WHEN n_{k} < {ACCURACY} THEN n_{k} ELSE ceil(n_{k} * {3 * slack}D) END"] * len(probs), "q": ["CAST(null AS DOUBLE)"] * len(probs)}
        fields += [f"{_array(items)} AS {name}_{k}" for name, items in own.items()]
    return first.select(*by, F.expr(f"struct({', '.join(fields)}) AS {STATE}"))


def _spots(values: Sequence[str], probs: Sequence[float]):
    """Of each wanted quantile: its column's number and values, its own number and share, the ends of its bracket, whether its inside is kept."""
    for k, v in enumerate(values):
        for i, p in enumerate(probs):
            yield k, v, i, p, f"{STATE}.low_{k}[{i}]", f"{STATE}.high_{k}[{i}]", f"{STATE}.room_{k}[{i}] <= {KEEP}"


def _counts(rows: DataFrame, by: Sequence[str], values: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Per group, and value strictly inside a bracket that keeps its values (``w``; all other values together): what lies where."""
    kept, seen = {}, ["count(*) AS n"]
    for k, v, i, _, low, high, keeps in _spots(values, probs):
        kept.setdefault(f"w_{k}", (v, []))[1].append(f"({keeps} AND {v} > {low} AND {v} < {high})")
        ends = {"below": f"{v} < {low}", "upto": f"{v} <= {low}", "before": f"{v} < {high}", "within": f"{v} <= {high}"}
        seen += [f"count_if({condition}) AS {name}_{k}_{i}" for name, condition in ends.items()]
    inside = [f"CASE WHEN {' OR '.join(tests)} THEN {v} END AS {w}" for w, (v, tests) in kept.items()]
    return rows.selectExpr("*", *inside).groupBy(*by, *kept).agg(*map(F.expr, seen))


def _look(rows: DataFrame, by: Sequence[str], state: DataFrame, values: Sequence[str], probs: Sequence[float], margin: int | None) -> DataFrame:
    """The groups of ``state`` after one look at their rows. ``margin`` is how many rungs wide of its place a bracket begins and ends; None takes no sketch."""
    rows = rows.join(state, list(by))
    counts = _counts(rows, by, values, probs)
    total = [f"sum({c}) AS {c}" for c in counts.columns if c.split("_")[0] in ("below", "upto", "before", "within")]
    total += [f"array_sort(collect_list(CASE WHEN w_{k} IS NOT NULL THEN struct(w_{k} AS w, n) END)) AS all_{k}" for k in range(len(values))]
    looked = counts.groupBy(*by).agg(*map(F.expr, total))
    if margin:
        rungs = _array(f"{j / RUNGS}D" for j in range(RUNGS + 1))
        ladders = [
            f"percentile_approx(CASE WHEN {v} > {low} AND {v} < {high} AND NOT {keeps} THEN {v} END, {rungs}, {ACCURACY}) AS ladder_{k}_{i}"
            for k, v, i, _, low, high, keeps in _spots(values, probs)
        ]
        looked = looked.join(rows.groupBy(*by).agg(*map(F.expr, ladders)), list(by))
    looked = looked.join(state, list(by))
    kept, at, value, found = [], [], [], []
    fields = {f: f"{STATE}.`{f}`" for f in state.schema[STATE].dataType.names}
    fields |= {f"{name}_{k}": [] for k in range(len(values)) for name in ("low", "high", "from", "to", "room", "q")}
    for k, _, i, p, low, high, keeps in _spots(values, probs):
        spot, place = f"{k}_{i}", f"{p:.17g}D * ({STATE}.n_{k} - 1)"
        inside = f"filter(all_{k}, x -> {keeps} AND x.w > {low} AND x.w < {high})"
        kept.append(f"flatten(transform({inside}, x -> array_repeat(x.w, CAST(x.n AS INT)))) AS kept_{spot}")
        at += [f"floor({place}) AS first_{spot}", f"ceil({place}) AS second_{spot}", f"{place} - floor({place}) AS part_{spot}"]
        value += [
            f"""CASE WHEN {end}_{spot} < below_{spot} THEN null WHEN {end}_{spot} < upto_{spot} THEN {low}
            WHEN {end}_{spot} < before_{spot} THEN get(kept_{spot}, CAST({end}_{spot} - upto_{spot} AS INT))
            WHEN {end}_{spot} < within_{spot} THEN {high} END AS {end}_value_{spot}"""
            for end in ("first", "second")
        ]
        a, b = f"first_value_{spot}", f"second_value_{spot}"
        found.append(f"coalesce({STATE}.q_{k}[{i}], {a} + ({b} - {a}) * part_{spot}) AS q_{spot}")
        for name, expression in _next(k, i, margin).items():
            fields[f"{name}_{k}"].append(expression)
    for step in (kept + at, value, found):  # step by step, so that none repeats the expressions of the one before
        looked = looked.selectExpr("*", *step)
    after = [f"{_array(x) if isinstance(x, list) else x} AS `{f}`" for f, x in fields.items()]
    return looked.select(*by, F.expr(f"struct({', '.join(after)}) AS {STATE}"))


def _next(k: int, i: int, margin: int | None) -> dict[str, str]:
    """One quantile after a look: its value, or the bracket to look at next."""
    spot = f"{k}_{i}"
    low, high, from_, to, room = (f"{STATE}.{name}_{k}[{i}]" for name in ("low", "high", "from", "to", "room"))
    below, upto, before, within, first, second = (f"{name}_{spot}" for name in ("below", "upto", "before", "within", "first", "second"))
    next_low, next_high, next_room = low, high, room
    if margin:
        ladder, some = f"ladder_{spot}", f"nullif({before} - {upto}, 0)"
        rung_low = f"CAST(floor(({first} - {upto}) * {RUNGS} / {some}) AS INT) - {margin}"
        rung_high = f"CAST(ceil(({second} - {upto}) * {RUNGS} / {some}) AS INT) + {margin}"
        next_low = f"CASE WHEN {rung_low} >= 0 THEN coalesce(get({ladder}, {rung_low}), {low}) ELSE {low} END"
        next_high = f"CASE WHEN {rung_high} <= {RUNGS} THEN coalesce(get({ladder}, {rung_high}), {high}) ELSE {high} END"
        # two rungs for the places, the margins, and what the sketch may be off by
        next_room = f"coalesce(ceil({some} * {(2 + 4 * margin) / RUNGS}D), {room})"
    missed, still = f"({first} < {below} OR {second} >= {within})", f"q_{spot} IS NULL AND {low} IS NOT NULL"
    # what this look has shown: the values wanted are not below ``from`` and not above ``to``
    next_from = f"CASE WHEN {first} >= {within} THEN {high} WHEN {first} >= {below} THEN {low} ELSE {from_} END"
    next_to = f"CASE WHEN {second} < {below} THEN {low} WHEN {second} < {within} THEN {high} ELSE {to} END"
    return {
        "low": f"CASE WHEN {still} THEN CASE WHEN {missed} THEN {next_from} ELSE {next_low} END END",
        "high": f"CASE WHEN {still} THEN CASE WHEN {missed} THEN {next_to} ELSE {next_high} END END",
        "from": next_from,
        "to": next_to,
        "room": f"CASE WHEN {still} THEN CASE WHEN {missed} THEN {STATE}.n_{k} ELSE {next_room} END ELSE 0 END",
        "q": f"q_{spot}",
    }


def quantiles(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], probs: Sequence[float], also: Sequence[Column] = ()
) -> DataFrame:
    """One row per group: its keys, ``also`` (aggregates of the same rows), and for each column c ``n_c`` and the array ``q_c``.

    Quantiles are interpolated linearly; those of a column without values are null. Groups with a null key are left out.
    """
    by, columns = list(by), list(dict.fromkeys(columns))
    names = [f"_value_{k}" for k in range(len(columns))]
    rows = df.na.drop(subset=by).withColumns({v: F.col(c).cast("double") for c, v in zip(columns, names, strict=True)})
    state = _brackets(rows, by, names, probs, also)
    rows = rows.select(*by, *names)
    width = range(len(columns))
    is_open = F.expr(f"exists(concat({', '.join(f'{STATE}.low_{k}' for k in width)}), x -> x IS NOT NULL)")
    most_room = F.expr(f"max(array_max(concat({', '.join(f'{STATE}.room_{k}' for k in width)}))) AS room")

    def write(state: DataFrame) -> tuple[DataFrame, bool, int]:
        noted = Observation()
        state = settled(state.observe(noted, F.max(is_open).alias("open"), most_room), "quantiles")
        return state, bool(noted.get["open"]), noted.get["room"] or 0

    state, open_, room = write(state)
    found, margin = None, 1 + RUNGS // ACCURACY
    while open_:
        looked, open_, room = write(_look(rows, by, state, names, probs, margin if room > KEEP else None))
        margin = min(2 * margin, RUNGS // 8)  # wider each time, for sketches that are off by more than they should
        done = looked.where(~is_open) if open_ else looked
        found = done if found is None else found.unionByName(done)
        state = looked.where(is_open)
    found = state if found is None else found
    own = {f"{f}_{k}" for k in width for f in ("n", "low", "high", "from", "to", "room", "q")}
    fields = [f for f in found.schema[STATE].dataType.names if f not in own]
    figures = [F.col(f"{STATE}.{f}_{k}").alias(f"{f}_{c}") for k, c in enumerate(columns) for f in ("n", "q")]
    return found.select(*by, *[F.col(f"{STATE}.{f}").alias(f) for f in fields], *figures)
