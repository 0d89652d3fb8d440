"""Near duplicates, components, decontamination, language-model scores, pipeline: against brute force."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelkit.llm import decontaminate, maxent, near_dups, quality_model
from panelkit.llm.common import table, whole_rows
from panelkit.llm.components import components
from panelkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def smallest_reachable(sets):
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    common = Counter((a, b) for own in holders.values() for a in own for b in own if a < b)
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return [find(i) for i in range(len(sets))]


def check_near(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles(t) for t in texts]
    expected = smallest_reachable(sets)
    got = {r.doc_id: r for r in near_dups.near_duplicates(docs).collect()}
    assert len(got) == len(texts)
    for i, s in enumerate(sets):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(s), expected[i], expected[i] == i)


def test_near_duplicates_of_all_documents(llm):
    check_near(llm, [r.text for r in table(llm, SF, "documents").orderBy("doc_id").collect()])


def test_near_duplicates_of_edited_copies(llm):
    """A large group around one text, chains, strays, copies, and texts that share half."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 5000, 150)]
    texts = []
    for k in range(150):
        copy = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 5)):
            copy[at] = f"x{k}" if rng.random() < 0.7 else f"y{rng.integers(0, 4)}"
        texts.append(" ".join(copy))
    chain = [f"c{i}" for i in range(120)]
    for k in range(12):
        chain = chain[3:] + [f"d{k}{j}" for j in range(3)]
        texts.append(" ".join(chain))
    half = " ".join(f"h{i}" for i in range(60))
    texts += [half + " " + " ".join(f"z{k}{i}" for i in range(40)) for k in range(40)]
    texts += ["a b c d", "A B c d", "a b c d e", "", None, " \n", texts[0].upper(), texts[0] + " "]
    check_near(llm, [texts[i] for i in rng.permutation(len(texts))])


def test_near_duplicates_of_ids_with_several_texts(llm):
    """An id is linked if one of its texts is, in families whose members are near each other but not all near one of them."""
    rng = np.random.default_rng(8)
    rows = []
    for family in range(12):
        base = [f"f{family}w{i}" for i in range(100)]
        for k in range(20):
            copy = list(base)
            for at in rng.integers(0, 100, rng.integers(0, 5)):
                copy[at] = f"x{family}{rng.integers(0, 6)}"
            rows.append((int(rng.integers(0, 120)), " ".join(copy)))
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    sets = [shingles(t) for _, t in rows]
    part = {i: i for i, _ in rows}

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    for (a, _), x in zip(rows, sets, strict=True):
        for (b, _), y in zip(rows, sets, strict=True):
            if 100 * len(x & y) >= 85 * len(x | y):
                one, two = sorted((find(a), find(b)))
                part[two] = one
    got = near_dups.near_duplicates(docs).collect()
    assert len(got) == len(rows) and all(r.component_id == find(r.doc_id) for r in got)


def test_near_duplicates_from_another_similarity_on(llm):
    """Texts of similarity 0.80 to 0.85 (96 shingles each, 5 of them around each changed word)."""
    base = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(base)), (1, " ".join("x" if i in (20, 60) else w for i, w in enumerate(base)))]
    rows += [(2, " ".join("y" if i in (10, 30, 50) else w for i, w in enumerate(base)))]  # 81 / 111
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    for percent, component in ((80, {0: 0, 1: 0, 2: 2}), (85, {0: 0, 1: 1, 2: 2}), (70, {0: 0, 1: 0, 2: 0})):
        assert {r.doc_id: r.component_id for r in near_dups.near_duplicates(docs, percent).collect()} == component
    for percent in range(50, 100, 5):
        assert (1 - (percent / 100) ** near_dups._rows(percent)) ** near_dups.BANDS <= near_dups.MISSED or near_dups._rows(percent) == 1


def test_near_duplicates_of_odd_rows(odd, empty):
    got = near_dups.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert all(r.kept and r.component_id == r.doc_id for r in got if r.doc_id is not None)
    assert {r.doc_id for r in got if r.n_shingles == 0} == {1, 2, 3}
    assert near_dups.near_duplicates(empty).count() == 0


def test_pruning_bounds_follow_the_posterior():
    least = near_dups._least_matches()
    grid = np.linspace(0, 1, 200_001)
    for i, m in enumerate(least):
        n = (i + 1) * near_dups.BATCH
        for matches, above in ((m, True), (m - 1, False)):
            density = grid**matches * (1 - grid) ** (n - matches)
            chance = density[grid >= 0.85].sum() / density.sum()
            assert (chance >= near_dups.MISS) == above


def test_components_of_a_path_a_star_and_a_loop(llm):
    links = [(i, i + 1) for i in range(30, 60)] + [(5, i) for i in range(6, 25)] + [(70, 71), (71, 70), (72, 72)]
    got = {r.node: r.component for r in components(llm.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 30 for i in range(30, 61)} | {i: 5 for i in range(5, 25)} | {70: 70, 71: 70}
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


BENCHMARK_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(text, items):
    w = BENCHMARK_WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, own in items:
        n = min(10, len(own))
        for g in {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else ():
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) == g:
                    hit.update(range(at, at + n))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_windows_against_brute_force(llm, odd, monkeypatch, limit):
    """With items of one word, shared windows, overlaps, null ids; broadcast and joined by shuffle."""
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    long = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, "single"), (2, long), (3, long + " thirteen"), (10, "Two words"), (None, "no id here"), (5, None), (6, ""), (7, "ÉTÉ été"), (8, "m n o p")]
    texts = [long.upper() + "!", "x " + long + " y", "one two three four five six seven eight nine ten single", "two words two-words Two", "no id here", "single", "", None, "Été ÉTÉ été", "nothing of it"]
    docs = llm.createDataFrame([*enumerate(texts, 100), (100, texts[0]), (101, "single")], "doc_id long, text string").union(odd.select("doc_id", "text"))
    benchmark = llm.createDataFrame(rows, "item_id long, text string")
    items = [(i, BENCHMARK_WORD.findall((t or "").translate(LOWER))) for i, t in rows]
    got = decontaminate.contamination(docs, benchmark).drop("text_hash").collect()
    expected = [(r.doc_id, *contaminated(r.text, items)) for r in docs.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    kept = decontaminate.remove(docs, benchmark).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id is not None and r.text is not None) == sorted(
        (r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None and r.text is not None and not contaminated(r.text, items)[-1]
    )


def test_windows_of_empty_tables(odd, empty, llm):
    benchmark = llm.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination(odd, benchmark).collect())
    assert decontaminate.contamination(empty, odd.selectExpr("doc_id item_id", "text")).count() == 0
    assert decontaminate.remove(odd, benchmark).count() == odd.count()


def test_decontamination_runs_no_python(llm):
    df = QUERIES["op9_decontamination"](llm, SF)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def check_scores(got, rows, train):
    count = Counter()
    for i, t in rows:
        if train(i):
            count.update([*words(t), None])
    n, v = sum(count.values()), len(count)
    assert len(got) == len(rows)
    for r, (_, t) in zip(got, rows, strict=True):
        tokens = [*words(t), None]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(count[w] > 0 for w in tokens), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0 and math.isfinite(r.score)


def test_scores_of_all_documents(llm, monkeypatch):
    rows = sorted((r.doc_id, r.text) for r in table(llm, SF, "documents").collect())
    got = sorted(QUERIES["op6_lm_scores"](llm, SF).collect(), key=lambda r: r.doc_id)
    check_scores(got, rows, lambda i: zlib.crc32(str(i).encode()) % 5 != 1)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_of_odd_rows_and_small_shards(odd, empty, llm, monkeypatch):
    monkeypatch.setattr(maxent, "SHARD_TOKENS", 50)
    train = odd.doc_id % 2 == 0
    got = sorted(maxent.score(odd, train).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.n_tokens))
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    check_scores(got, rows, lambda i: i is not None and i % 2 == 0)
    none = maxent.score(odd, odd.doc_id < 0).collect()
    assert {r.train_tokens for r in none} == {0} and all(math.isfinite(r.score) for r in none)
    assert maxent.score(empty, train).count() == 0


def test_rare_words_tell_what_follows_them(llm, monkeypatch):
    """Words that no common token is among: the next word by the last one, by the last two, and by one further back."""
    monkeypatch.setattr(maxent, "SHARD_GRAMS", 5_000)
    rng = np.random.default_rng(5)
    rows = [f"a{i}z b{i}z x{rng.integers(300)}y c{i}z" for i in range(400) for _ in range(4)]
    held = [f"a7z b{i}z" for i in (7, 8)] + [f"b7z q c{i}z" for i in (7, 8)]
    docs = llm.createDataFrame(list(enumerate(held + rows)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in maxent.score(docs, docs.doc_id >= len(held)).collect()}
    assert all(got[i].base_score == pytest.approx(got[i + 1].base_score, rel=0.01) for i in (0, 2))  # equally frequent words
    assert got[0].score > got[1].score + 1 and got[2].score > got[3].score + 1


def test_strengths_come_from_all_blocks(llm, monkeypatch, tmp_path):
    real = maxent._strengths

    def noted(row, *rest):
        (tmp_path / str(row["block"])).touch()
        return real(row, *rest)

    monkeypatch.setattr(maxent, "_strengths", noted)
    docs = llm.createDataFrame([(i, f"a{i} b c") for i in range(40)], "doc_id long, text string").repartition(20)
    assert maxent.score(docs, docs.doc_id >= 0).count() == 40
    assert len(list(tmp_path.iterdir())) == docs.select(F.spark_partition_id()).distinct().count() > 6


def test_n_grams_are_those_of_a_plain_count(llm):
    """And the share of all tokens after a history is one, whatever the family."""
    texts = ["x y x y z", "y", "", "x y z z", "z x y"]
    data = "".join(texts).encode()
    import pyarrow as pa

    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    train = np.array([True, True, True, True, False])
    row = maxent._block(0, pa.array(range(5)), train, np.frombuffer(data, np.uint8), offsets)
    sliced = maxent._gram_slices(3)(iter([pa.RecordBatch.from_pylist([row])]))
    own = [np.concatenate([maxent._from_small(x.as_py()) for x in of.column("counts")]) for of in sliced]
    words_n = np.frombuffer(row["counts"], "<u4").astype(np.int64)
    found = maxent._occurrences(row, words_n, own, 3)
    padded = [["^"] * 3 + words(t) + ["$"] * 3 for t in texts]
    for (n, history), back in zip(found, maxent.FAMILIES, strict=True):
        count, of = Counter(), Counter()
        for p, yes in zip(padded, train, strict=True):
            for i in range(3, len(p) - 3 + back[0]):
                if yes:
                    count[tuple(p[i - k] for k in back), p[i]] += 1
                    of[tuple(p[i - k] for k in back)] += 1
        at = [(tuple(p[i - k] for k in back), p[i]) for p in padded for i in range(3, len(p) - 2)]
        assert n.tolist() == [count[x] for x in at] and history.tolist() == [of[h] for h, _ in at]


def test_the_model_is_a_distribution(llm):
    """Over all classes and head tokens, and over the counts of a tail class with an unseen token."""
    rng = np.random.default_rng(1)
    words = maxent.Vocabulary(np.arange(1, 201, dtype=np.uint64), np.arange(200, 0, -1), np.full(maxent.TAILS, 7), np.full(maxent.TAILS, 3), 0, 0)
    by_class, by_word = maxent._first_weights(words)
    by_class[:, 1:] = rng.normal(size=by_class[:, 1:].shape)
    s = maxent.Sequence(np.zeros(5, np.int64), np.zeros(5, np.int64), [rng.integers(1, maxent.FEATURES, 5) for _ in range(4)], rng.integers(0, maxent.SYMBOLS, 5))
    assert np.exp(maxent._class_logs(s, by_class)).sum(axis=0) == pytest.approx(np.ones(5), rel=1e-5)
    assert np.exp(maxent._word_logs(s, by_word)).sum(axis=0) == pytest.approx(np.ones(5), rel=1e-5)


def model_block():
    """A block of texts of 300 words, and a model whose weights have been moved."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.3, rng.integers(0, 60)) % 300) for _ in range(700)]
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    row = maxent._block(0, pa.array(range(700)), rng.random(700) < 0.8, data, offsets)
    totals = np.frombuffer(row["counts"], "<u4").astype(np.int64)
    hashes = np.frombuffer(row["hashes"], "<u8")
    best = np.lexsort((hashes, -totals))[:200]
    words = maxent.Vocabulary(hashes[best], totals[best], np.full(maxent.TAILS, 7), np.full(maxent.TAILS, 3), 0, 0)
    weights = maxent._first_weights(words)
    for w, size in zip(weights, (1, maxent.HEAD // maxent.WORDS), strict=True):
        w[:, size:] = rng.normal(size=w[:, size:].shape)
    return row, totals, words, weights


def plain_log_softmax(x):
    x = x - x.max(axis=0)
    return x - np.log(np.exp(x).sum(axis=0))


def plain_logs(s, weights):
    by_class, by_word = (w.astype(np.float64) for w in weights)
    a, b = maxent._word_columns(s)
    heads = s.kind < maxent.HEAD // maxent.WORDS
    words = by_word[:, a[heads]] + by_word[:, b[heads]]
    return plain_log_softmax(by_class[:, :1] + sum(by_class[:, f] for f in s.features)), plain_log_softmax(words), heads


def test_logs_of_tokens_are_those_of_the_softmax_by_few_exponentials(monkeypatch):
    row, totals, words, weights = model_block()
    s, _ = maxent._sequence(row, words)
    tails = np.frombuffer(row["tails"], np.uint8)[maxent._from_planes(row["ids"])]
    by_class, by_word, heads = plain_logs(s, weights)
    expected = by_class[s.kind, np.arange(len(s.kind))]
    expected[heads] += by_word[s.word[heads], np.arange(heads.sum())]
    inside = np.log((totals[maxent._from_planes(row["ids"])] + 0.5) / (words.tail_n + 0.5 * (words.tail_v + 1))[tails])
    expected[~heads] += inside[~heads]
    real, made = np.exp, []

    def counted(x, *rest, **named):
        made.append(np.size(x))
        return real(x, *rest, **named)

    monkeypatch.setattr(np, "exp", counted)
    got = maxent._token_logs(row, totals, words, weights)
    assert got == pytest.approx(expected, rel=1e-5)
    assert sum(made) < maxent.CLASSES * len(got) / 2  # of all classes of all tokens
    for some in (np.arange(5, len(got), 7), np.zeros(0, np.int64)):
        assert maxent._token_logs(row, totals, words, weights, some) == pytest.approx(expected[some], rel=1e-5)


def test_gradient_steps_are_the_plain_ones():
    row, _, words, weights = model_block()
    s = maxent._sequence(row, words)[0].part(slice(0, maxent.BATCH))
    n = len(s.kind)
    by_class, by_word, heads = plain_logs(s, weights)
    plain = [np.zeros(w.shape) for w in weights]
    rest, inner = np.exp(by_class), np.exp(by_word)
    rest[s.kind, np.arange(n)] -= 1
    inner[s.word[heads], np.arange(heads.sum())] -= 1
    for f in (np.zeros(n, np.int64), *s.features):
        np.add.at(plain[0].T, f, rest.T / n)
    for f in maxent._word_columns(s):
        np.add.at(plain[1].T, f[heads], inner.T / n)
    for kind, close in ((np.float64, 1e-9), (np.float32, 1e-4)):
        own = tuple(w.astype(kind, order="F") for w in weights)
        seen = tuple(np.zeros_like(w) for w in own)
        maxent._descend(s, own, seen)
        for w, start, g2, g in zip(own, weights, seen, plain, strict=True):
            assert np.abs(w - (start - maxent.RATE * g / (np.abs(g) + 1e-4))).max() < close
            assert np.abs(g2 - g * g).max() < close


def test_strengths_are_likeliest_by_the_plain_sum():
    rng = np.random.default_rng(4)
    p, history = rng.random(5_003) ** 6, rng.integers(0, 40, 5_003)
    assert maxent._likelihoods(p[:0], history[:0], history[:0]) == [0] * len(maxent.STRENGTH_POWERS)
    for n in (np.minimum(rng.integers(0, 9, 5_003), history), np.zeros(5_003, np.int64)):
        plain = np.array([np.log(maxent._moved(p, (n, history), maxent.STRENGTH_BASE**k)).sum() for k in maxent.STRENGTH_POWERS])
        got = np.array(maxent._likelihoods(p, n, history))
        assert got - got[0] == pytest.approx(plain - plain[0], rel=1e-9, abs=1e-6)


def test_order_of_keys_that_only_their_lowest_bits_tell_apart():
    rng = np.random.default_rng(6)
    high = rng.integers(0, 1 << 64, 50, dtype=np.uint64) << np.uint64(8)
    for keys in (rng.choice(high, 4_000) | rng.integers(0, 256, 4_000, dtype=np.uint64), rng.choice(high, 4_000), high[:1], high[:0]):
        order, ordered = maxent._ordered(keys)
        assert order.tolist() == np.argsort(keys, kind="stable").tolist() and (keys[order] == ordered).all()
        for got, expected in zip(maxent._distinct(keys), np.unique(keys, return_index=True, return_inverse=True), strict=True):
            assert (got == expected).all()


def test_pipeline_against_its_operators(llm):
    docs = table(llm, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(llm, docs, SF)
        assert new.columns == docs.columns, name
        before, after = ({r.doc_id: r for r in df.collect()} for df in (docs, new))
        assert all(before[i] == r for i, r in after.items())  # whole rows
        gone = set(before) - set(after)
        if name == "near_dedup":
            ids = sorted(before)
            found = smallest_reachable([shingles(before[i].text) for i in ids])
            assert gone == {i for k, i in enumerate(ids) if found[k] != k}
        if name == "decontamination":
            items = [(r.item_id, BENCHMARK_WORD.findall(r.text.translate(LOWER))) for r in table(llm, SF, "benchmark").collect()]
            assert gone == {i for i, r in before.items() if contaminated(r.text, items)[-1]}
        if name == "quality_classifier":
            labels = table(llm, SF, "labels").selectExpr("doc_id", "quality label")
            weights = quality_model.fit(table(llm, SF, "documents"), labels)
            scores = quality_model.score(whole_rows(docs, "text"), weights, ["row"]).collect()
            assert gone == {r.row.doc_id for r in scores if r.quality_score < quality_model.ACCEPT}
        docs = llm.createDataFrame(list(after.values()), docs.schema)
    pieces = corpus_pipeline.run(llm, SF).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}


def test_pipeline_stages_take_odd_rows(llm, odd, empty):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, empty):
            got = stage(llm, docs, SF)
            if name == "packing":
                assert got.where("start = 0").count() == docs.count()
            else:
                assert got.columns == docs.columns and got.count() <= docs.count()


def test_queries_against_their_sql(llm):
    from oracle import compare, connect
    from panelkit.llm.queries import ORACLE

    con = connect(SF)
    for name, sql in ORACLE.items():
        assert compare(llm, con, SF, QUERIES[name], sql) is None, name


def test_a_very_long_text_beyond_the_broadcast(llm, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", -1)
    words = [f"w{i}" for i in range(200_000)]
    items = [("a", " ".join(words[500:530])), ("b", "nowhere to be found"), ("c", " ".join(words[-3:]))]
    benchmark = llm.createDataFrame(items, "item_id string, text string")
    docs = llm.createDataFrame([(1, " ".join(words)), (2, None)], "doc_id long, text string")
    start = time.monotonic()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(docs, benchmark).collect()}
    assert got == {1: (200_000, 33, 2), 2: (0, 0, 0)} and time.monotonic() - start < 60
