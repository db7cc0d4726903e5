"""Word cutting where Python's and the library's Unicode tables differ in combining classes."""

import sys
import unicodedata

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from smeltery.llm import bpe  # noqa: E402


def test_every_combining_mark_beside_every_class():
    coder = bpe.coder(public_tokenizers.path("word_bpe_49k.json"))
    marks = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.combining(chr(c))]
    one_of = list({unicodedata.combining(m): m for m in marks}.values()) + ["́", "̣", "᫊", "ᫌ", "߽", "࢘"]
    wrong = [(a, b) for m in marks for o in one_of for a, b in ((m, o), (o, m))
             if coder.words(f"x{a}{b}e{b}") != coder.by_library(f"x{a}{b}e{b}")]
    assert not wrong


def test_marks_are_asked_whichever_comes_first():
    coder = bpe.WordCoder(public_tokenizers.path("word_bpe_49k.json"))
    for text in ("x᫊ᫌ", "ạ࢘ b", "ẹ́ͅ", "߽߲"):
        assert coder.words(text) == coder.by_library(text)
