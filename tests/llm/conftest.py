from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1])]

from panelkit.llm.common import ship  # noqa: E402

SF = "/root/testdata/sf0.001"

# null, empty, white space only, one word, ties, a long text, odd characters; ids null and repeated
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
ODD = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " \n\t ", None),
    (4, "word", "en"),
    (5, "The same words here and the same words here again.", "en"),
    (5, "The same words here and the same words here again.", "en"),
    (6, LONG, "xx"),
    (7, "é ́ 日本 語　\x1c ﻿<|endoftext|> & < > \x00 'tis", None),
    (None, "no id at all in this row of the table", "en"),
    (8, "a b c d e f g h i j k l m n o p", "fr"),
]


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd(llm):
    """Odd rows, with columns named like those that operators add."""
    rows = [(*r, i, "n", 0.5, True) for i, r in enumerate(ODD)]
    names = "doc_id long, text string, lang string, n_words int, score string, quality_score double, kept boolean"
    return llm.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
