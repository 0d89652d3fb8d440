"""Collocations and periodic runs against brute force."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelkit.llm import collocations, periodic_runs
from panelkit.llm.common import table
from panelkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_collocations(rows, top, least, covered):
    """rows: (text, lang)"""
    count, size = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            size[lang] += len(w)
            for k in (1, 2, 3):
                count[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, f in count.items():
        candidates = [p for p, a in f.items() if len(p) > 1 and a >= least]
        longer = defaultdict(int)
        for p in candidates:
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], f[p])
        scored = []
        for p in candidates:
            a = f[p]
            score, _, l, r = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            if not (len(p) == 2 and longer[p] and 100 * longer[p] >= covered * a):
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, size[lang], -score))
    return out


def check_collocations(docs, **settings):
    expected = plain_collocations([(r.text, r.lang) for r in docs.collect()], settings.get("top", 2000), settings.get("least", 10), 50)
    got = [tuple(r) for r in collocations.collocations(docs, **settings).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    return got


@pytest.mark.parametrize("budget", [1_000_000, 500, 15])
def test_collocations_of_all_documents(llm, budget):
    """With 500 words are extended to pairs, with 15 pairs to triples."""
    assert check_collocations(table(llm, SF, "documents"), budget=budget)


def test_collocations_of_the_query(llm):
    docs = table(llm, SF, "documents")
    assert {tuple(r) for r in QUERIES["op12_phrase_collocations"](llm, SF).collect()} == plain_collocations(
        [(r.text, r.lang) for r in docs.collect()], 2000, 10, 50
    )


def test_collocations_with_ties_at_the_last_place(llm):
    rng = np.random.default_rng(5)
    names = [f"n{i}" for i in range(12)]
    rows = [(" ".join(rng.choice(names, 40)) + rng.choice([".", "\n", ", A B c", ""]), str(rng.choice(["x", "y"]))) for _ in range(60)]
    rows += [("p q r! " * 12, "z"), ("s t; u v, w é; " * 11, "z")]
    docs = llm.createDataFrame(rows, "text string, lang string")
    for top in (1, 2, 7, 50):
        check_collocations(docs, top=top, least=4, budget=100)


def test_collocations_of_odd_rows(odd, empty):
    check_collocations(odd, least=2)
    check_collocations(odd, least=1, budget=40)
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(odd.where("doc_id in (1, 2, 3)")).collect() == []


def test_a_long_text_is_worked_off_in_slices(llm, monkeypatch):
    docs = llm.createDataFrame([("one two three, " * 700 + "two three four " * 300, None)], "text string, lang string")
    data, offsets = np.frombuffer(docs.first().text.encode(), np.uint8), np.array([0, len(docs.first().text)])
    words = collocations.scan(data, offsets, np.zeros(1, np.int64), np.zeros(1, np.uint64))
    whole = collocations._followers(words.hash, words.goes_on, 0, len(words.hash))
    parts = [collocations._followers(words.hash, words.goes_on, low, low + 7) for low in range(0, len(words.hash), 7)]
    assert all((np.concatenate(p) == w).all() for p, w in zip(zip(*parts, strict=True), whole, strict=True))
    check_collocations(docs, budget=100)


def test_a_subtree_gives_back_its_leaves():
    rng = np.random.default_rng(2)
    leaf = np.unique(rng.integers(0, 5, (200, 3)), axis=0).astype(np.uint64)
    n = rng.integers(1, 9, len(leaf))
    got = collocations._leaves(collocations._subtree(*leaf.T, n))
    assert all((a == b).all() for a, b in zip(got, (*leaf.T, n), strict=True))


def plain_runs(w, least):
    found, n = {}, len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, q, e - s) for (s, e), q in found.items())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 20).map(lambda k: [0, 1, 0] * k)), max_size=4), st.sampled_from([2, 5, 12]))
def test_runs_of_words(texts, least):
    size = [len(t) for t in texts]
    row = np.repeat(np.arange(len(texts)), size)
    symbols = row * 10 + np.array([x for t in texts for x in t], np.int64)
    last = np.cumsum(size)
    start, stop, period = periodic_runs.find_runs(symbols, last[row], least)
    for k, t in enumerate(texts):
        first = last[k] - size[k]
        own = (row[start] == k) if len(start) else np.zeros(0, bool)
        got = list(zip((start[own] - first).tolist(), period[own].tolist(), (stop - start)[own].tolist(), strict=True))
        assert got == plain_runs(t, least)


def plain_row(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    number = {x: i for i, x in enumerate(dict.fromkeys(w))}
    x = np.array([number[y] for y in w], np.int64)
    found = {}
    for q in range(1, n // 2 + 1):
        same = np.concatenate(([0], (x[:-q] == x[q:]).astype(np.int8), [0]))
        edge = np.flatnonzero(np.diff(same))
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
    rows = sorted((s, q, e - s) for (s, e), q in found.items())
    dropped = {i for s, q, length in rows for i in range(s + q, s + length)}
    best = min(rows, key=lambda r: (-r[2], r[0], r[1])) if rows else None
    return (
        doc_id, n, len(rows), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, q, length in rows).encode()).hexdigest(),
        hashlib.sha256(" ".join(y for i, y in enumerate(w) if i not in dropped).encode()).hexdigest(),
    )


def test_runs_of_all_documents(llm):
    docs = table(llm, SF, "documents")
    got = Counter(tuple(r) for r in QUERIES["op13_periodic_runs"](llm, SF).collect())
    expected = Counter(plain_row(r.doc_id, r.text) for r in docs.collect())
    assert got == expected
    assert sum(r[2] > 0 for r in got) >= 10


def test_runs_of_odd_rows(odd, empty):
    from pyspark.sql import functions as F

    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    got = periodic_runs.periodic_runs(odd, ["doc_id"], checksum).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id != 6]
    assert Counter(tuple(r) for r in got if r.doc_id != 6) == Counter(plain_row(*r) for r in rows)
    assert [r.n_words for r in got if r.doc_id == 6] == [60_000]
    assert periodic_runs.periodic_runs(empty, ["doc_id"], checksum).collect() == []
    kept = periodic_runs.periodic_runs(odd, ["doc_id", "score"]).columns
    assert kept[:2] == ["doc_id", "score"]


def test_long_texts_of_one_word_and_of_one_period(llm):
    n = 200_000
    words = [f"w{i}" for i in range(997)]
    texts = [(1, "a " * n), (2, " ".join(words[i % 997] for i in range(n))), (3, "b " * 50_000 + "c " + "b " * 50_000)]
    docs = llm.createDataFrame(texts, "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period) for r in periodic_runs.periodic_runs(docs, ["doc_id"]).collect()}
    assert got == {1: (1, 0, n, 1), 2: (1, 0, n, 997), 3: (2, 0, 50_000, 1)}
    assert time.time() - began < 60
