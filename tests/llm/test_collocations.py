"""Collocation mining against a plain count of all phrases."""

from __future__ import annotations

import collections
import random
import re

import pytest


def plain(rows, least, top):
    counts, total = collections.Counter(), collections.Counter()
    for r in rows:
        lang, text = "und" if r[2] is None else r[2], re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, *words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    known = {p: n for p, n in counts.items() if n >= least}
    found = collections.defaultdict(list)
    for (lang, *words), a in known.items():
        longer = [p for p in known if p[0] == lang and len(p) - 1 > len(words) and any(list(p[i : i + len(words)]) == words for i in range(1, len(p))) and known[p] >= a]
        if len(words) < 2 or longer:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = known[(lang, *words[:k])], known[(lang, *words[k:])]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return {(lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for lang, items in found.items() for i, (s, a, p, left, right) in enumerate(sorted(items)[:top])}


def got(df):
    rows = [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def wordy_rows(odd_rows):
    draw = random.Random(11)
    words = [f"w{i}" for i in range(30)] + ["é", "日本", "Up\0per", "x\x85y"]
    rows = list(odd_rows)
    for i in range(250):
        picked = draw.choices(words, [1 / (k + 1) for k in range(len(words))], k=draw.randint(0, 40))
        text = "".join(w + draw.choice((" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!")) for w in picked)
        # Phrases that come late, so that a sample of few documents misses them.
        rows.append((i % 200, text + ("rare phrase of five words" if i % 17 == 0 else ""), draw.choice(("en", "en", "en\0x", "a\tb", None))))
    return rows


@pytest.mark.parametrize("sample, caution, bits, limit", [(8, 0.5, 27, 1 << 21), (1000, 0.5, 27, 60), (2, 8.0, 6, 1 << 21), (1, 0.01, 27, 1 << 21)])
def test_mining(spark, wordy_rows, monkeypatch, sample, caution, bits, limit):
    """Samples that propose nothing, little or everything, full bit sets, sliced texts."""
    from costlens.llm import bitsets, collocations

    monkeypatch.setattr(collocations, "CAUTION", caution)
    monkeypatch.setattr(collocations, "SLICE", limit)
    docs = spark.createDataFrame([(r[0], r[1], r[2], "i", 1) for r in wordy_rows], "doc_id long, text string, lang string, item string, n long").repartition(3)
    assert got(collocations.mine_collocations(docs, 12, 40, sample, bits)) == plain(wordy_rows, 12, 40)


def test_odd_rows(odd_docs, no_docs, odd_rows):
    from costlens.llm.collocations import mine_collocations

    assert got(mine_collocations(odd_docs, 3)) == plain(odd_rows, 3, 2000)
    assert mine_collocations(no_docs).count() == 0
    assert mine_collocations(odd_docs, 10**9).count() == 0


def test_passes_end_with_a_closed_border(spark):
    """A phrase of five words that no sampled document holds."""
    from costlens.llm.collocations import frequent_phrases

    docs = spark.createDataFrame([(1, "a b c d e. " * 5, "en")], "doc_id long, text string, lang string")
    found = {(r["lang"], r["phrase"]): r["n"] for r in frequent_phrases(docs, 5, 10**6).collect()}
    words = "a b c d e".split()
    assert found == {("en", " ".join(words[i : i + k])): 5 for k in range(1, 6) for i in range(6 - k)} | {("en", ""): 25}


def test_bits(spark):
    import numpy as np
    from costlens.llm.bitsets import gather, joined

    keys = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 5000)
    sets = []
    for part, most in ((keys[:3000], 20), (keys[3000:], 12)):
        bits, n = gather(spark.createDataFrame([(int(k),) for k in part], "key long"), most)
        assert n == len(part) and bits.has(part.view(np.uint64)).all() and bits.bits <= most
        sets.append(bits)
    assert joined(*sets).has(keys.view(np.uint64)).all()
    assert sets[0].has(keys[3000:].view(np.uint64)).mean() < 0.1


@pytest.mark.parametrize("bits", [0, 5])
def test_packed_counts(spark, monkeypatch, bits):
    """Counts of hashes survive packing, in less than half the bytes of hash and count."""
    import numpy as np
    import pandas as pd
    from costlens.llm import keycounts

    monkeypatch.setattr(keycounts, "HELD", 20_000)
    rng = np.random.default_rng(4)
    keys = np.append(rng.integers(0, 1 << 63, 60_000, dtype=np.uint64) << np.uint64(1), np.array([0, (1 << 64) - 1], np.uint64))
    n = rng.integers(1, 400, len(keys))
    parts = [(keys[a : a + 7000], n[a : a + 7000]) for a in range(0, len(keys), 7000)] + [(keys[:50], n[:50])]
    frame = pd.concat(list(keycounts.pack(iter(parts), bits)))
    assert frame["keys"].map(len).sum() + frame["counts"].map(len).sum() < 8 * len(keys)
    packed = spark.createDataFrame(frame, keycounts.PACKED)
    wanted = collections.Counter()
    for k, c in parts:
        for x, y in zip((k >> np.uint64(24)).tolist(), c.tolist()):
            wanted[x] += y
    got = {(r["key"] % (1 << 64)) >> 24: r["n"] for r in keycounts.frequent(packed, bits, 300).collect()}
    assert got == {k: c for k, c in wanted.items() if c >= 300}
    assert keycounts.range_bits(0) == 0 and keycounts.range_bits(3 * keycounts.RANGE_BYTES) == 2
