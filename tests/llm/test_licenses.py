"""License scans against a search of all blocks."""

import re
from collections import Counter

import numpy as np
import pytest
from oracle import compare, connect

from panelkit.llm import licenses
from panelkit.llm.common import table
from panelkit.llm.license_texts import PHRASES, TEMPLATES
from panelkit.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_row(doc_id, text, texts, percent):
    w = words(text)
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    met = []
    for label, template in texts:
        own = words(template)
        size = 16
        while size < len(own):
            size *= 2
        own = set(own)
        for at in range(0, len(w), size):
            common = len(own & set(w[at : at + 2 * size]))
            if 100 * common >= percent * len(own):
                met.append((label, common / len(own)))
    base = {label for _, label in places}
    at = [i for i, _ in places]
    return (
        doc_id, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
        ",".join(sorted(base | {label for label, _ in met})), max((c for _, c in met), default=0.0), len(met),
    )


def check(docs, texts=TEMPLATES, percent=licenses.PERCENT):
    got = Counter(tuple(r) for r in licenses.scan(docs, texts, percent=percent).collect())
    expected = Counter(plain_row(r.doc_id, r.text, texts, percent) for r in docs.collect())
    assert got == expected
    return got


def test_labels_of_all_documents(llm):
    got = check(table(llm, SF, "documents"))
    assert {r[6] for r in got} >= {"", "apache,apache-2.0"}


def test_the_query_is_its_sql(llm):
    assert compare(llm, connect(SF), SF, QUERIES["op11_license_scan"], ORACLE["op11_license_scan"]) is None


@pytest.mark.parametrize("percent", [100, 90, 60, 30])
def test_random_blocks_and_templates(llm, percent):
    """Few words, so that templates share theirs and blocks meet several."""
    rng = np.random.default_rng(percent)
    names = [f"w{i}" for i in range(30)]
    weights = 1 / np.arange(1, 31)
    draw = lambda n: " ".join(rng.choice(names, n, p=weights / weights.sum()))
    texts = [(f"t{k % 5}", draw(int(rng.integers(1, 40)))) for k in range(9)]
    docs = llm.createDataFrame([(i, draw(int(rng.integers(0, 150)))) for i in range(60)], "doc_id long, text string")
    check(docs, texts, percent)


def test_whole_notices_are_found_wherever_they_stand(llm):
    filler = " ".join(f"x{i}" for i in range(70))
    rows = [(i, filler[: 13 * i] + "\n" + notice + " " + filler) for i, (_, notice) in enumerate(TEMPLATES)]
    got = {r.doc_id: r for r in licenses.scan(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, _) in enumerate(TEMPLATES):
        assert label in got[i].labels.split(",") and got[i].score == 1.0


def test_blocks_are_named(llm):
    docs = llm.createDataFrame([(1, "a " * 40 + "Released under the MIT License.")], "doc_id long, text string")
    got = {(r.label, r.first_word, r.n_words, r.containment) for r in licenses.find_blocks(docs).collect()}
    assert got == {("mit", 16, 32, 1.0), ("mit", 32, 32, 1.0)}


def test_phrases_next_to_each_other(llm):
    check(llm.createDataFrame([(1, "MIT License, MIT license; CC-BY cc by cc"), (2, "gnu general public licenses"), (3, "apache\nlicense")], "doc_id long, text string"))


def test_odd_rows(odd, empty, llm):
    check(odd)
    check(odd, [("x", "the same words"), ("y", "no id at all")], 50)
    assert licenses.scan(empty).collect() == []
    assert licenses.find_blocks(empty).collect() == []
    with pytest.raises(ValueError):
        licenses.templates([("x", " - ")])
    with pytest.raises(ValueError):
        licenses.templates([("x", " ".join(f"w{i}" for i in range(licenses.MOST_WORDS + 1)))])


def test_no_python_runs(llm):
    plan = licenses.scan(table(llm, SF, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_a_text_full_of_prefix_words(llm):
    docs = llm.createDataFrame([(1, "license apache " * 30_000)], "doc_id long, text string")
    row = licenses.scan(docs).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (60_000, 29_999, 1, 59_997)
