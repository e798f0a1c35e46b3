import random

import pytest
from tokenizers import Tokenizer

from landloom.llm import token_counts as tc
from landloom.llm.queries import tokenizer_file
from .helpers import prose


@pytest.fixture(scope="module")
def path():
    return tokenizer_file("word_bpe_49k.json")


def texts():
    draw = random.Random(8)
    odd = ["", "  ", "It's <|endoftext|> don't.we'll!", "<|STARTOFTEXT|>x<|startoftext|>", "H̱ÉE̱ǰ. ½²x³", "a b c", "ÀB.,;'s", "X'S", "x" * 700,
           "ﬁ ǅ İstanbul ΣΑΣ.", "12.5%!!! a.b,c", "end?!'", "你好。世界！", "l'été. d'un", "tab\tthere\r\nline"]
    return odd + [prose(draw, draw.randint(1, 200)) for _ in range(40)]


def library(path, texts):
    return [len(Tokenizer.from_file(path).encode(t or "", add_special_tokens=False)) for t in texts]


def test_counts_are_the_librarys(spark, path):
    rows = [(i, t, 5) for i, t in enumerate(texts())] + [(None, "null id", 1), (0, "again", 2), (0, "again", 2), (99, None, 0)]
    got = sorted((tuple(r) for r in tc.count_tokens(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), path).collect()), key=repr)
    want = sorted(((i, len((t or "").encode()), n) for (i, t, _), n in zip(rows, library(path, [r[1] for r in rows]))), key=repr)
    assert got == want


def test_huge_texts_by_chunks(spark, path):
    """Small chunks and overlaps: many seams, and words longer than an overlap, which widen it."""
    long_ = [" ".join(texts()[2:]), "y" * 500 + " " + "é" * 333, "ab cd " * 200 + "z" * 300, "short"]
    df = spark.createDataFrame(list(enumerate(long_)), "rid long, text string")
    got = dict(tuple(r) for r in tc.huge_counts(df, path, chunk=64, overlap=16).collect())
    assert got == dict(enumerate(library(path, long_)))


def test_huge_rows_among_others(spark, path):
    rows = [(1, "a b " * 300), (1, "a b " * 300), (None, "c " * 400), (2, "small")]
    got = sorted((tuple(r) for r in tc.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, huge=500).collect()), key=repr)
    assert got == sorted(((i, len(t), n) for (i, t), n in zip(rows, library(path, [t for _, t in rows]))), key=repr)
    assert tc.count_tokens(spark.createDataFrame([], "doc_id long, text string"), path).count() == 0
