"""Id files and packing."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelkit.llm import id_files, packing
from panelkit.llm.common import table
from panelkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def ids_of(path, text, end):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def texts(llm):
    return {r.doc_id: r.text for r in table(llm, SF, "documents").collect()}


def test_files_hold_the_ids_of_all_documents_in_order(llm, texts):
    got = {r.doc_id: r for r in QUERIES["op3_id_files"](llm, SF).collect()}
    start = 0
    library = Tokenizer.from_file(BYTES)
    for doc_id in sorted(texts):
        ids = [*library.encode(texts[doc_id] or "", add_special_tokens=False).ids, 0]
        r = got.pop(doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    assert not got


def test_files_of_odd_rows(odd, empty, llm, tmp_path, monkeypatch):
    id_files.write(odd, str(tmp_path / "odd"), BYTES, 0)
    got = id_files.read(llm, str(tmp_path / "odd"), with_ids=True).collect()
    assert len(got) == odd.count()
    expected = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in odd.collect())
    assert [r.ids for r in sorted(got, key=lambda r: r.start)] == [ids_of(BYTES, t, 0) for _, t in expected]
    id_files.write(empty, str(tmp_path / "none"), BYTES, 0)
    assert id_files.read(llm, str(tmp_path / "none")).count() == 0


def check_pieces(pieces, documents):
    """Every id in exactly one piece, sequences gapless and of allowed sizes; returns the padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(documents)
    for doc_id, ids in documents.items():
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            assert p["ids_crc32"] == crc(ids[at : at + p["length"]])
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= packing.WINDOW
        padding += 0 if at & (at - 1) == 0 else packing.WINDOW - at
    return padding


def test_packing_of_all_documents(llm, texts):
    library = Tokenizer.from_file(WORDS)
    documents = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts.items()}
    assert check_pieces([r.asDict() for r in QUERIES["op7_packing"](llm, SF).collect()], documents) == 0


def test_packing_of_odd_rows(odd, empty):
    once = odd.dropDuplicates(["doc_id"])
    documents = {r.doc_id: ids_of(WORDS, r.text, 2) for r in once.collect()}
    assert check_pieces([r.asDict() for r in packing.pack(once, WORDS, 2).collect()], documents) == 0
    assert packing.pack(odd, WORDS, 2).where("start = 0").count() == odd.count()
    assert packing.pack(empty, WORDS, 2).count() == 0
    piece = packing.pack(odd, WORDS, 2, with_ids=True).where("doc_id = 4").first()
    assert piece.ids == ids_of(WORDS, "word", 2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_the_level_array_counts_open_windows_and_is_minimised(lengths):
    packer = packing.Packer(16)
    for i, n in enumerate(lengths):
        before = packer.count.copy()
        full = list(packer.add(i, b"\0\0\0\0" * n))
        assert all(sum(len(p[2]) // 4 for p in w) == 16 for w in full)
        rest = n % 16
        if rest:
            choices = []
            for h in [0, *np.flatnonzero(before[: 16 - rest + 1])]:
                c = before.copy()
                if h:
                    c[h] -= 1
                if h + rest < 16:
                    c[h + rest] += 1
                choices.append((c * c).sum())
            assert (packer.count**2).sum() == min(choices)
        assert {k: len(v) for k, v in packer.open.items() if v} == {int(k): int(packer.count[k]) for k in np.flatnonzero(packer.count)}
    sizes = [sum(len(p[2]) // 4 for p in w) for w in packer.finish()]
    assert all(s & (s - 1) == 0 for s in sizes)
