from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from granary.llm import token_counts
from tests.llm.conftest import odd_rows, prose

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def lookup():
    with open(FILE, encoding="utf-8") as file:
        return token_counts.Lookup(file.read(), ("", b"", b""))


def test_counts_as_the_library_does(library, lookup):
    draw = random.Random(1)
    parts = ["a", "é", " ", "  ", "\n", "\t", "1", "Ⅷ", "'s", "'", "　", "日本", "😀", "́", "<|endoftext|>", "\x1c",
             "\x85", "​", "!?", " x", "՘", "\U0003fc3d", "࢏"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert lookup.count(text) == len(library.encode(text, add_special_tokens=False)), repr(text)


def test_long_texts_are_cut_where_tokens_end(library, lookup, monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE", 50)
    for text in (prose(3, 400), "x" * 500, "ab  cd \n" * 60, "a1 " * 90):
        assert "".join(token_counts.pieces(text)) == text
        assert lookup.count(text) == len(library.encode(text, add_special_tokens=False))


def test_a_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts, "FREQUENT", 0)
    monkeypatch.setattr(token_counts, "CACHED", 20)
    with open(FILE, encoding="utf-8") as file:
        small = token_counts.Lookup(file.read(), ("", b"", b""))
    for seed in range(30):
        text = prose(seed, 60)
        assert small.count(text) == len(library.encode(text, add_special_tokens=False))


def test_odd_rows_and_columns(odd_documents, no_documents, library):
    rows = token_counts.count_tokens(odd_documents, FILE, limit=50).collect()
    assert len(rows) == len(odd_rows())
    for row in rows:
        text = row.text or ""
        assert row.n_bytes == len(text.encode())
        assert row.n_tokens == len(library.encode(text, add_special_tokens=False))
        assert row.over_limit == (row.n_tokens > 50) and row._row == "r"
    assert token_counts.count_tokens(no_documents, FILE).count() == 0
