"""The word scanner against regular expressions, the coding and the tokens against round trips."""

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelkit.llm import tokens, wordscan
from panelkit.llm.common import chunks, utf8
from panelkit.llm.simple8b import pack, unpack
from panelkit.llm.tokens import encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("ab Aé\n\t.　日\x1c")), max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 40))
def test_words_are_those_of_the_pattern(rows, most):
    data, offsets = utf8(pa.array(rows, pa.string()))
    found = [[] for _ in rows]
    hashes = {}
    for low, high in chunks(offsets, most):
        words = wordscan.runs(data, offsets[low : high + 1])
        for r, a, b, h in zip(words.row, words.start, words.end, words.hash, strict=True):
            word = data[a:b].tobytes().decode()
            found[low + r].append(word)
            assert hashes.setdefault(word, h) == h
    assert found == [WORD.findall(t or "") for t in rows]
    assert len(set(hashes.values())) == len(hashes)


def test_a_sliced_column_is_read_from_its_offset():
    data, offsets = utf8(pa.array(["one", "two three", None, "four"]).slice(1, 3))
    assert wordscan.runs(data, offsets).per_row().tolist() == [2, 0, 1]


def test_folded_hashes_ignore_ascii_case_only():
    data, offsets = utf8(pa.array(["Word word WORD É é"]))
    h = wordscan.runs(data, offsets, folded=True).hash
    assert h[0] == h[1] == h[2] and h[3] != h[4]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**16), st.integers(0, 2**64 - 1)), max_size=300), st.integers(0, 5))
def test_coding_gives_back_the_numbers(numbers, times):
    numbers = np.array(numbers * 2**times, np.uint64)
    assert (unpack(*pack(numbers), len(numbers)) == numbers).all()


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@settings(max_examples=300, deadline=None)
@given(text=st.lists(st.sampled_from([*"abzTéßñ12'.,!-|<>*# \n\t\r\x0b", "'s", "  ", "\x1c", "\x85", " ", "　", "İ", "Σ", "ς", "́", "日", "﻿", "<|endoftext|>", "ª"]), max_size=40).map("".join))
def test_ids_are_those_of_the_library(file, text):
    path = public_tokenizers.path(file)
    ids = np.frombuffer(encoder(path).encode([text])[0], "<u4").tolist()
    assert ids == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_units_that_never_repeat_or_are_forgotten(file, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 500)
    path = public_tokenizers.path(file)
    library, own = Tokenizer.from_file(path), tokens.Encoder(path)
    for part in range(3):
        texts = [None, "", *("  ".join(f"w{part}x{i * 50 + k:x} Ab\n" for k in range(50)) for i in range(20)), "a b " * 3, " "]
        column = pa.array(["before", *texts])[1:]
        got = [np.frombuffer(x, "<u4").tolist() for x in own.encode(column)]
        assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
