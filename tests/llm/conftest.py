"""Rows that every operator must take: nulls, empty, blank, long and foreign texts, ties,
copies, repeated and null ids, and extra columns with clashing names."""

from __future__ import annotations

import pytest

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, term string, item string, key string, n string, part string"


@pytest.fixture(scope="session")
def odd_rows():
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    long = " ".join(words[(i * i) % 10] + str(i % 97) for i in range(6000))
    texts = [
        None, "", " \t\n ", "word", "word", "Two words, two WORDS; two\nwords", long, long + " end", " ".join(words * 4), (" ".join(words * 4)).upper(),
        "é" * 40 + " 日本語 ünïcode 😀 İstanbul ǅ", "a b c d e. " * 30, "a" * 3000 + " " * 700 + "=" * 900, "\x0b\x0cveil\x1cveil\x00\x85x", "<s> </s> ▁▁ x▁y <0x0A>",
    ]
    rows = [(i * 3, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}") for i, t in enumerate(texts)]
    rows += rows[5:8] + [(15, "another text, two words", "en", "s1"), (None, "two words", "en", "s1"), (None, "two words", "en", "s1"), (None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame([(*r, 0, "b", "t", "i", "k", "n", "p") for r in odd_rows], ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
