"""Quality rules, quality classifier and language profiles."""

import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelkit.llm import divergence_rules, language_profiles, quality_model
from panelkit.llm.common import in_fold, table, whole_rows
from panelkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside)


@pytest.fixture(scope="module")
def documents(llm):
    return {r.doc_id: r for r in table(llm, SF, "documents").collect()}


def test_measures_are_those_of_a_plain_count(llm, documents):
    for r in QUERIES["op5_quality_rules"](llm, SF).collect():
        expected = base(documents[r.doc_id].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])
        assert not (r.base_failed and r.kept)


def test_measures_take_the_memory_of_a_small_chunk():
    texts = pa.array([f"some words of text {i} " * 50 for i in range(4_000)])
    same = {"en": (np.ones(divergence_rules.CLASSES) / divergence_rules.CLASSES, np.arange(64), np.ones(65) / 65)}
    divergence_rules._measure(texts[:1], same)  # tables that stay
    tracemalloc.start()
    found = divergence_rules._measure(texts, same)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found["n_words"].tolist() == [250] * 4_000
    assert peak < 48 * 1024**2


def test_rules_keep_good_documents_and_reject_bad_ones(llm):
    judged = divergence_rules.judge(table(llm, "/root/testdata/sf0.01", "documents"), ["doc_id"])
    good = judged.join(table(llm, "/root/testdata/sf0.01", "labels"), "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept for r in good if r.quality == 1]) > 0.995
    assert np.mean([r.kept for r in good if r.quality == 0]) < 0.1


def test_distance_is_that_of_jensen_and_shannon():
    p, q = np.array([[0.5, 0.5, 0.0], [1.0, 0, 0], [0, 0, 1.0]]), np.array([0.5, 0.5, 0.0])
    d = divergence_rules.distance(p, q)
    m = (p[1] + q) / 2
    expected = np.sqrt((1 * np.log2(1 / m[0]) + 2 * 0.5 * 0 + 0.5 * np.log2(0.5 / m[0]) + 0.5 * np.log2(0.5 / m[1])) / 2)
    assert d[0] == 0 and d[1] == pytest.approx(expected) and d[2] == 1


def test_rules_on_odd_rows(odd, empty):
    found = divergence_rules.judge(whole_rows(odd, "text", "lang"), ["row"])
    got = found.select("row.*").collect()
    assert len(got) == odd.count() and set(got[0].asDict()) == set(odd.columns)
    by_id = {r.row.doc_id: r for r in found.collect()}
    for i in (1, 2, 3, 4):
        assert by_id[i].base_failed and not by_id[i].kept
    assert by_id[6].n_words == 60_000
    assert divergence_rules.judge(empty, ["doc_id"]).count() == 0


def test_rules_without_any_reference(llm):
    docs = llm.createDataFrame([(1, "a b c d e f g h i j k l m n", None)], "doc_id long, text string, lang string")
    assert divergence_rules.judge(docs, ["doc_id"]).first().kept


def test_rules_judge_by_distance_only_where_the_language_has_a_reference(llm):
    """A clean text of a rare or no language stays beside a large one; a strange text of the large one goes."""
    rng = np.random.default_rng(2)
    large = [" ".join(f"the{i}" for i in rng.zipf(1.5, 200) % 3000) for _ in range(60)]
    rare = " ".join(chr(0x0561 + i % 30) + chr(0x0561 + i // 30) + "ա" * (i % 5) for i in rng.integers(0, 900, 80))
    rows = [(i, t, "en") for i, t in enumerate(large)] + [(100, rare, "hy"), (101, rare, None), (102, rare, "en"), (103, "a b", "hy")]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in divergence_rules.judge(docs, ["doc_id"]).collect()}
    assert {i: kept[i] for i in (100, 101, 102, 103)} == {100: True, 101: True, 102: False, 103: False}


def test_classifier_on_held_out_labels(llm):
    folder = "/root/testdata/sf0.01"
    scored = QUERIES["op1_quality_classifier"](llm, folder)
    assert scored.count() == table(llm, folder, "documents").count()
    r = scored.where("held_out").join(table(llm, folder, "labels"), "doc_id").collect()
    good, bad = [x.score for x in r if x.quality == 1], [x.score for x in r if x.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.99
    assert np.mean([x.predicted == x.quality for x in r]) > 0.95


def test_classifier_on_odd_rows(odd, empty, llm):
    labels = llm.createDataFrame([(5, 1), (5, 0), (6, 0), (7, None), (8, 1), (None, 0), (99, 1)], "doc_id long, label int")
    weights = quality_model.fit(odd, labels)
    got = quality_model.score(whole_rows(odd, "text"), weights, ["row"]).collect()
    assert len(got) == odd.count() and all(0 <= r.quality_score <= 1 for r in got)
    assert len({r.quality_score for r in got if r.row.doc_id in (1, 2, 3)}) == 1  # the bias alone
    assert quality_model.score(empty, weights, ["doc_id"]).count() == 0
    one = quality_model.score(odd, quality_model.fit(odd, labels.where("label = 1")), ["doc_id"]).first()
    assert one.quality_score == pytest.approx(4 / 5)  # ids 5, 8 and 99
    assert quality_model.score(odd, quality_model.fit(empty, labels.limit(0)), ["doc_id"]).first().quality_score == pytest.approx(0.5)


def grams(text):
    runs = re.findall(r"[^\W\d_]+", text.lower())
    padded = " " + " ".join(runs) + " " if runs else ""
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            g = padded[i : i + n]
            if g != " " and not (n == 3 and g[1] == " "):
                out[g] += 1
    return out


def test_profiles_are_those_of_a_plain_count(llm):
    docs = llm.createDataFrame([(1, "Der Hund, der 3 Hunde!", "de"), (2, "the dog", "en"), (3, "x", None)], "doc_id long, text string, lang string")
    profiles = language_profiles.learn(docs)
    assert list(profiles) == ["de", "en"]
    for lang, text in (("de", "Der Hund, der 3 Hunde!"), ("en", "the dog")):
        pack = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
        expected = sorted(grams(text).items(), key=lambda x: (-x[1], pack(x[0])))
        assert profiles[lang].tolist() == [pack(g) for g, _ in expected][: language_profiles.TOP]


def test_languages_on_held_out_rows(llm):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op2_language_id"](llm, folder).join(table(llm, folder, "documents"), "doc_id").where("held_out").collect()
    assert len(got) == table(llm, folder, "documents").where(in_fold(F.col("doc_id"), 5, 0)).count()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97


def test_languages_of_odd_rows(odd, empty, llm):
    profiles = language_profiles.learn(odd)
    got = {r.row.doc_id: r for r in language_profiles.predict(whole_rows(odd, "text"), profiles, ["row"]).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[1].lang_score == 0
    assert got[6].lang_pred == "xx" and 0 <= got[6].lang_score <= 1
    assert language_profiles.learn(empty) == {}
    assert {r.lang_pred for r in language_profiles.predict(odd, {}, ["doc_id"]).collect()} == {"und"}


def test_a_text_in_pieces_counts_as_a_whole(monkeypatch):
    text = "some words and then the words " * 50
    whole = language_profiles._counts(text)
    monkeypatch.setattr(language_profiles, "PIECE", 64)
    parts = language_profiles._counts(text)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
