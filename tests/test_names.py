"""Matching against brute force over all pairs."""

import random

import pytest
from conftest import as_dict, rows
from pyspark.sql import functions as F

from panelkit.constants import CODE_ALIASES, EUROPE_FIXES, WORLD_EXTRA_NAMES, WORLD_FIXES
from panelkit.operators import names as N
from panelkit.plans.matched import matched_map


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def key(name):
    return "".join(c if c.isalnum() else " " for c in name.replace("_", " ").strip().lower()).strip()


def score(a, b):
    a, b = key(a), key(b)
    same_words = 95.0 if set(a.split()) == set(b.split()) else 0.0
    return max(same_words, 100.0 * (1 - edits(a, b) / max(len(a), len(b))))


def best(name, valid):
    return min((-score(name, v), v) for v in valid)


def table(spark, values, column="name"):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def spoil(rng, name):
    letters = list(name)
    for _ in range(rng.randint(0, 3)):
        at = rng.randrange(len(letters))
        rng.choice([
            lambda: letters.pop(at) if len(letters) > 1 else None,
            lambda: letters.insert(at, rng.choice("abe ")),
            lambda: letters.__setitem__(at, rng.choice("abe")),
        ])()
    return "".join(letters)


def test_word_sets_count_each_word_once(spark):
    valid = "Congo, The Democratic Republic of the"
    got = N.fuzzy_match(table(spark, ["Democratic_Republic_of_the_Congo"]), "name", table(spark, [valid]), 95.0)
    assert rows(got, "match", "score") == [(valid, 95.0)]


def test_a_correction_that_repeats_doubles_nothing(spark):
    df = table(spark, ["a", "b"], "raw")
    fixes = spark.createDataFrame([("a", "y"), ("a", "x")], "raw string, fixed string")
    assert sorted(rows(N.apply_fixes(df, "raw", fixes))) == [("b",), ("x",)]


def test_scoring_against_the_whole_list_is_spread(spark):
    names, valid = table(spark, [f"ab{i}" for i in range(200)]), table(spark, ["xyz", "xab"])
    report = N.unmatched_report(N.fuzzy_match(names, "name", valid, 95.0), valid)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "REPARTITION_BY_NUM" in plan


@pytest.mark.parametrize("threshold", [95.0, 90.0, 80.0, 60.0])
def test_fuzzy_match_equals_brute_force(spark, threshold):
    rng = random.Random(threshold)
    valid = sorted({"".join(rng.choice("abe ") for _ in range(rng.randint(2, 45))).strip() or "a" for _ in range(60)})
    valid = [v for v in valid if key(v)]
    raw = sorted({spoil(rng, rng.choice(valid)).replace(" ", rng.choice([" ", "_"])) for _ in range(120)})
    raw = [r for r in raw if key(r)]
    got = as_dict(N.fuzzy_match(table(spark, raw), "name", table(spark, valid), threshold), "raw", "match", "score")
    assert set(got) == set(raw)
    for name in raw:
        cost, match = best(name, valid)
        if -cost >= threshold - 1e-9:
            assert got[name] == (match, pytest.approx(-cost)), name
        else:
            assert got[name] == (None, None), name


def test_comparisons_grow_with_the_names_that_are_near(spark, monkeypatch):
    """Listed names that are not near any name bring no pairs, and no name is scored against the whole list."""
    monkeypatch.setattr(N, "_closest", None)
    draw = lambda rng, chars: "".join(rng.choice(chars) for _ in range(14))
    rng = random.Random(1)
    raw = [draw(rng, "bcdfghjklmn") for _ in range(100)]
    near = [name[:5] + "x" + name[6:] for name in raw]
    pairs = []
    for others in (0, 2_000, 8_000):
        far = [draw(rng, "PQRSTUVWYZ0123456789") for _ in range(others)]
        valid = table(spark, near + far)
        got = N.fuzzy_match(table(spark, raw), "name", valid, 90.0)
        assert {r.raw: r.match for r in got.collect()} == dict(zip(raw, near, strict=True))
        keys = table(spark, [key(x) for x in raw], "key")
        pairs.append(N._candidates(keys, N._listed(valid, "name"), 90.0, None).count())
    assert pairs[-1] <= 1.2 * pairs[0] < 0.25 * len(raw) * len(near)


def test_nothing_is_searched_if_no_name_is_open(spark, monkeypatch):
    monkeypatch.setattr(N, "_candidates", None)
    assert rows(N.fuzzy_match(table(spark, ["ITALY"]), "name", table(spark, ["Italy", "Itali"])), "match") == [("Italy",)]


def test_report_names_the_closest(spark):
    valid, raw = ["Italy", "Republic of Korea", "Kosovo"], ["Itali", "Korea_Republic_of", "KOSOVO", "Atlantis"]
    matches = N.fuzzy_match(table(spark, raw), "name", table(spark, valid))
    assert as_dict(matches, "raw", "match", "score") == {
        "Itali": (None, None), "Korea_Republic_of": ("Republic of Korea", 95.0), "KOSOVO": ("Kosovo", 100.0),
        "Atlantis": (None, None),
    }
    report = as_dict(N.unmatched_report(matches, table(spark, valid)), "raw", "closest", "score")
    assert report["Itali"] == ("Italy", pytest.approx(80.0))
    assert report["Atlantis"] == (best("Atlantis", valid)[1], pytest.approx(-best("Atlantis", valid)[0]))
    assert rows(N.unmatched_count(matches)) == [(2,)]


def test_long_lists_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(N, "LIST_CHUNK", 3)
    valid = [f"place number {i:03d}" for i in range(40)]
    matches = N.fuzzy_match(table(spark, ["nothing like it"]), "name", table(spark, valid))
    got = rows(N.unmatched_report(matches, table(spark, valid)), "closest", "score")
    cost, match = best("nothing like it", valid)
    assert got == [(match, pytest.approx(-cost))]


def test_empty_inputs(spark):
    none, some = table(spark, ["x"]).limit(0), table(spark, ["Italy", None])
    assert rows(N.fuzzy_match(some, "name", none)) == [("Italy", "Italy", None, None)]
    assert rows(N.fuzzy_match(none, "name", some)) == []


def test_a_very_long_name_is_matched_whole(spark):
    long = " ".join(f"word{i}" for i in range(300))
    got = rows(N.fuzzy_match(table(spark, [long[:-1] + "x", long[:900]]), "name", table(spark, [long])), "match")
    assert sorted(g[0] is None for g in got) == [False, True]


def test_iso3(spark):
    dim = spark.createDataFrame(
        [("Russian Federation", "Russia (official)", "RUS"), ("Falkland Islands", None, "FLK"), ("Curaçao", None, "CUW")],
        "name string, official_name string, alpha_3 string",
    )
    raw = ["Russia", "russian_federation", "Falkland Islands (Malvinas)", "CURAÇAO", "rus", "Atlantis", "", None]
    got = as_dict(N.iso3(table(spark, raw), "name", dim, CODE_ALIASES), "name", "iso_a3")
    assert got == {
        "Russia": "RUS", "russian_federation": "RUS", "Falkland Islands (Malvinas)": "FLK", "CURAÇAO": "CUW",
        "rus": "RUS", "Atlantis": None, "": None, None: None,
    }


def test_fixes_and_fallback(spark):
    df = spark.createDataFrame([("Viet_Nam", None), ("Cote_dIvoire", None), ("Italy", "Italy")], "raw string, match string")
    assert [r[0] for r in rows(N.apply_fixes(df, "raw", WORLD_FIXES), "raw")] == ["Vietnam", "Ivory Coast", "Italy"]
    filled = N.fill_unmatched(df, "match", "raw", EUROPE_FIXES)
    assert rows(filled) == [("Viet_Nam", "Viet_Nam"), ("Cote_dIvoire", "Ivory Coast"), ("Italy", "Italy")]
    fixes = spark.createDataFrame([("Viet_Nam", "Vietnam")], "raw string, fixed string")
    assert sorted(rows(N.apply_fixes(df, "raw", fixes), "raw")) == [("Cote_dIvoire",), ("Italy",), ("Vietnam",)]


def test_valid_names_and_dimension_join(spark):
    dim = table(spark, ["Italy", "Kosovo"])
    assert N.valid_names(dim, WORLD_EXTRA_NAMES).count() == 6
    values = spark.createDataFrame([("Italy", 5)], "label string, total bigint")
    assert sorted(rows(N.attach_values(dim, values, "name", "label"), "name", "total")) == [("Italy", 5), ("Kosovo", None)]


def test_matched_map(spark, panel):
    valid = table(spark, ["Alpha Land", "Beta", "Curaçao"])
    world = matched_map(panel, valid, {"Quiet": "Beta"})
    assert {r["match"] for r in world["map"].collect()} == {"Alpha Land", "Beta", "Curaçao"}
    assert rows(world["coverage"])[0][0] == pytest.approx(100.0 * 10 / 12)
    assert {r["raw"] for r in world["unmatched"].collect()} == {"Bonaire, Saint Eustatius and Saba"}
    asia = matched_map(panel, valid, {"Quiet": "Silent"}, area="Asia")
    assert {r["match"] for r in asia["map"].collect()} == {"Beta", "Silent"}
    assert {r["raw"] for r in asia["unmatched"].collect()} == {"Quiet"}


def test_coverage_counts_rows_not_groups(spark):
    df = spark.createDataFrame([("a", 3), (None, 1)], "match string, rows bigint")
    assert rows(N.coverage(df)) == [(50.0,)] and rows(N.coverage(df, rows="rows")) == [(75.0,)]
    assert rows(N.coverage(df.withColumn("match", F.lit("x")))) == [(100.0,)]


def drawn_names(rng, n, words):
    return sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) + rng.choice(["", " ii", " 7"]) for _ in range(n)})


@pytest.mark.parametrize("chunk", [1_000, 12])
def test_the_report_equals_brute_force(spark, monkeypatch, chunk):
    """By one cell and by many, with ties, names far longer than cells tell apart, and names without letters."""
    monkeypatch.setattr(N, "LIST_CHUNK", chunk)
    rng = random.Random(chunk)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(40)]
    valid = drawn_names(rng, 150, words) + ["ab ba", "ba ab", "x" * 70, "x" * 90 + "y"]
    raw = [spoil(rng, rng.choice(valid)) for _ in range(80)] + ["b a", "***", "x" * 80, "zzzz", "ab_ba_ab"]
    left = spark.createDataFrame([(r, r.replace("_", " ").strip()) for r in sorted(set(raw))], "raw string, clean string")
    report = N.unmatched_report(left.withColumn("match", F.lit(None).cast("string")), table(spark, valid))
    got = as_dict(report, "raw", "closest", "score")
    assert set(got) == set(raw)
    for name, (closest, found) in got.items():
        cost, match = best(name, valid)
        assert (closest, found) == (match, pytest.approx(-cost)), name


def test_few_listed_names_are_compared(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(400)]
    valid = drawn_names(rng, 5_200, words)[:5_000]
    raw = sorted({spoil(rng, spoil(rng, rng.choice(valid))) for _ in range(3_000)})
    listed = N._listed(table(spark, valid), "name").cache()
    keys = N._keyed(table(spark, raw), F.col("name")).select("key", "words").distinct()
    pairs = N._candidates(keys.select("key"), listed, N.NEAR_SCORE, None).count()
    near = N._nearest_within(keys.select("key"), listed, N.NEAR_SCORE).select("key")
    unknown = F.lit(None).cast("struct<cost:double,match:string>")
    closest = N._closest(keys.select("key", unknown.alias("best")).join(near, "key", "left_anti"), listed, len(valid))
    compared, lost = closest.agg(F.sum("compared"), F.count_if(F.col("best").isNull())).first()
    assert lost == 0 and pairs + compared < 0.25 * keys.count() * len(valid), (pairs, compared)


def test_words_of_one_name_among_those_of_the_other(spark):
    valid = ["United Republic of Tanzania", "Republic of Korea", "Guinea", "Equatorial Guinea", "Kosovo", "---"]
    raw = ["Tanzania", "Korea", "Guinea_Bissau", "KOSOVO", "Republic", "of of", "Atlantis Republic", "***", "Equatorial"]

    def brute(name):
        def own(v):
            a, b = set(key(name).split()), set(key(v).split())
            return max(score(name, v) if key(name) else 0.0, N.SUBSET_SCORE if a and b and (a <= b or b <= a) else 0.0)

        return min((-own(v), v) for v in valid if key(v))

    got = as_dict(N.fuzzy_match(table(spark, raw), "name", table(spark, valid), 90.0, subset_score=N.SUBSET_SCORE), "raw", "match", "score")
    for name in raw:
        cost, match = brute(name)
        assert got[name] == ((match, pytest.approx(-cost)) if -cost >= 90 else (None, None)), name
    assert got["Tanzania"][0] == "United Republic of Tanzania" and got["Republic"][0] == "Republic of Korea"
    assert rows(N.fuzzy_match(table(spark, ["Tanzania"]), "name", table(spark, valid), 90.0), "match") == [(None,)]
    same = N.fuzzy_match(table(spark, raw), "name", table(spark, valid).limit(0), 90.0, subset_score=N.SUBSET_SCORE)
    assert same.where("match is null").count() == len(raw)


def test_like_numbered_names_meet_few_listed_ones(spark):
    """Names that differ in a digit share every pair of letters with many, but a variant with few; so do names around the longest written out."""
    valid = [f"Customer#{i:09d}" for i in range(0, 30_000, 10)]
    raw = [name[:3] + name[4:] for name in valid[::30]]
    keys = table(spark, [key(x) for x in raw], "key")
    assert N._candidates(keys, N._listed(table(spark, valid), "name"), 90.0, 1).distinct().count() <= 12 * len(raw)

    long = N.VARIANT_LETTERS
    valid = sorted({"x" * (long + k) + f"{i:04d}" for k in range(-6, 0) for i in range(40)})
    raw = sorted({spoil(random.Random(i), name) for i, name in enumerate(valid)})
    want = {(key(x), key(y)) for x in raw for y in valid if edits(key(x), key(y)) <= 1}
    keys = table(spark, sorted({key(x) for x in raw}), "key")
    got = N._candidates(keys, N._listed(table(spark, valid), "name"), 85.0, 1)
    assert want <= {(r.key, r.other) for r in got.collect()}
