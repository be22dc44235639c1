"""Source divergence against a plain count."""

from __future__ import annotations

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least, top=10):
    docs = [(r[2] or "", r[3] or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(r[1] or "")]) for r in rows]
    df, counts, groups = collections.Counter(), collections.defaultdict(collections.Counter), collections.defaultdict(set)
    for lang, source, terms in docs:
        groups[lang].add(source)
        df.update((lang, t) for t in set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang, sources in groups.items():
        kept = [t for (x, t), n in df.items() if x == lang and n >= least]

        def rates(own):
            total = sum(own[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (own[t] + 2) // total for t in kept}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: rates(counts[lang, s]) for s in sources}
        q = rates(sum((counts[lang, s] for s in sources), collections.Counter()))
        for s in sources:
            pairs = [(-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-gap(p[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items, n in (("pair", pairs, len(pairs)), ("term", terms, top)):
                out |= {(lang, s, part, item, -value, k + 1) for k, (value, _, item) in enumerate(sorted(items)[:n])}
    return out


def got(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def mixed_rows(odd_rows):
    draw = random.Random(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Ünï", "日本", "ÉA"]
    rows = list(odd_rows)
    for i in range(150):
        text = " ".join(draw.choice(("{}", "{},", "({}", "{}-{}", "{}9{}", "X{}")).format(*draw.choices(words, [1 / (k + 1) for k in range(len(words))], k=2)) for _ in range(draw.randint(0, 30)))
        rows.append((i % 90, text, draw.choice(("en", "en", "de", None, "fr")), draw.choice(("a", "b", "a\0c", None, f"s{i % 7}"))))
    return rows + rows[-20:]


@pytest.mark.parametrize("broadcast_rows, block, long", [(0, 50, 80), (100_000, 400_000, 1 << 24)])
def test_audit(spark, mixed_rows, monkeypatch, broadcast_rows, block, long):
    from costlens.llm import divergence

    monkeypatch.setattr(divergence, "BLOCK_ROWS", block)
    monkeypatch.setattr(divergence, "LONG", long)
    docs = spark.createDataFrame([(*r, "g", "n", "k") for r in mixed_rows], "doc_id long, text string, lang string, source string, `group` string, v string, chunk string")
    for least in (3, 10):
        assert got(divergence.audit_sources(docs.repartition(4), least, broadcast_rows=broadcast_rows)) == plain(mixed_rows, least)


def test_odd_rows(odd_docs, no_docs, odd_rows):
    from costlens.llm.divergence import audit_sources

    assert got(audit_sources(odd_docs, 2)) == plain(odd_rows, 2)
    assert got(audit_sources(odd_docs)) == plain(odd_rows, 10)
    assert audit_sources(no_docs).count() == 0


def test_rates_beyond_64_bits(spark):
    from costlens.llm.divergence import rate

    cases = [(0, 3), (10**13, 3 * 10**13), (7 * 10**14, 8 * 10**15), (12, 14)]
    frame = spark.createDataFrame(cases, "c long, total long")
    assert [r[0] for r in frame.select(rate(F.col("c"), F.col("total"))).collect()] == [1 + 10**9 * (c + 2) // t for c, t in cases]


def test_chunks_of_a_batch_take_little_memory():
    """Arrays of a batch hold a few hundred bytes a word, so a batch must be small."""
    import tracemalloc

    from costlens.llm.divergence import read_chunks

    texts = [" ".join(f"w{(i * 7919 + k) % 5003}" for k in range(400)) for i in range(4000)]
    next(read_chunks(texts[:2]))
    tracemalloc.start()
    for _ in read_chunks(texts):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20


def test_equal_spans_follow_each_other():
    import numpy as np

    from costlens.llm.divergence import in_order, joined_forms

    long = "x" * 70
    forms = ["ab", "b", "ab", long + "a", "ä" * 40, long + "b", "b", long + "a", "ä" * 40, "12345678", "12345679", "12345678", long + "a"]
    buffer, starts, ends = joined_forms(forms)
    hashes = np.array([{f: i for i, f in enumerate(forms)}[f] << 40 for f in forms], dtype=np.uint64)
    order, same = in_order(buffer, starts, ends - starts, hashes)
    in_turn = [forms[i] for i in order]
    assert same.tolist() == [i > 0 and in_turn[i] == in_turn[i - 1] for i in range(len(forms))] and same.sum() == 6
    # Spans that share a hash are still told apart.
    order, same = in_order(buffer, starts, ends - starts, np.zeros(len(forms), dtype=np.uint64))
    assert order.tolist() == list(range(len(forms))) and not same.any()


def test_counts_by_group_across_flushes(spark, monkeypatch):
    """Chunks of one word in many forms, of many batches, in two groups of one language."""
    from costlens.llm import divergence

    monkeypatch.setattr(divergence, "BATCH", 64)
    monkeypatch.setattr(divergence, "HELD", 256)
    monkeypatch.setattr(divergence, "RANGE_BYTES", 1024)
    forms = ("go", "Go,", "(go)", "go-go", "GO!", "go;go", "stay")
    rows = [(i, f"{forms[i % 7]} {forms[i % 3]} u{chr(97 + i % 26)}{i} once", "en", f"s{i % 2}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(2)
    assert got(divergence.audit_sources(docs)) == plain(rows, 10)
