"""Text operators against plain versions, with odd rows in every table."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, kept string, span string, score string"
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def odd_texts():
    """Nulls, empty and blank texts, ties, copies, near copies, long and foreign texts."""
    long = " ".join(BASE[(i * i) % 24] + str(i % 97) for i in range(6000))
    near = " ".join(BASE * 4)
    return [
        None, "", " \t\n ", "word", "word", "two words", near, near + " coda", near.upper(), near, long, long + " end",
        "é" * 40 + " 日本語 ünïcode 😀", "a b c d e " * 30, " ".join(BASE) + "\nmail me at x.y@example.org or +49 (30) 1234567",
        "ip 10.0.0.300 and 10.0.0.1, card 4111 1111 1111 1111, IBAN GB82 WEST 1234 5698 7654 32", "\x0b\x0cveil\x1cveil", near + " alpha beta",
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}", 0 if t is None else len(t), "b", "k", "s", "x") for i, t in enumerate(odd_texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def truth(docs):
    return sorted((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())


def test_fingerprints(docs, empty):
    from costlens.llm.fingerprints import compare, decode, fingerprint_documents, merge, sketch, code_points

    got, rows = by_id(fingerprint_documents(docs)), truth(docs)
    assert len(got) == len(rows)
    prints = collections.defaultdict(set)
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        prints[text].add(got[i]["fingerprint"])
        shingles = [{x[k : k + 8] for k in range(max(1, len(x) - 7))} if x else set() for x in (text, edited, following)]
        for other, column in ((shingles[1], "near_edited"), (shingles[2], "near_next")):
            whole = shingles[0] | other
            exact = len(shingles[0] & other) / len(whole) if whole else 1.0
            assert abs(got[i][column] - exact) < 0.25
    assert all(len(p) == 1 for p in prints.values())
    assert fingerprint_documents(empty).count() == 0
    a, b = (sketch(code_points(t)) for t in (rows[10][1][:9000], rows[10][1]))
    assert compare(b, a)[1] == pytest.approx(1.0, abs=0.05)
    assert (merge(a, b) == sketch(code_points(rows[10][1]))).all()
    assert (decode(got[rows[10][0]]["fingerprint"]) == b).all()


def test_repeated_passages(docs, empty):
    from costlens.llm.passages import pack, remove_repeats, unpack

    got, seen = by_id(remove_repeats(docs)), set()
    for i, text in truth(docs):
        words = text.encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - 19):
            window = tuple(words[s : s + 20])
            if window in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        assert (got[i]["n_words"], got[i]["n_removed"]) == (len(words), sum(gone))
        assert got[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest() and got[i]["kept_text"].encode() == kept
    assert remove_repeats(empty).count() == 0
    for n in (0, 1, 2, 999):
        values = np.sort(np.random.default_rng(n).integers(0, 1 << 24, n))
        assert (unpack(pack(values)) == values).all()


def test_personal_data(docs, empty):
    from costlens.llm.pii import find_personal_data, mask_personal_data, mod97
    from pyspark.sql import functions as F

    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def right(kind, found):
        digits = re.sub("[^0-9]", "", found)
        doubled = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits)))
        return {"email": True, "ip": all(p.isdigit() and int(p) <= 255 for p in found.split(".")) if kind == "ip" else True, "card": 13 <= len(digits) <= 19 and doubled % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]

    got = by_id(find_personal_data(docs))
    for i, text in truth(docs):
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p in patterns.items() for m in re.finditer(p, text) if right(k, m[0])]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
    assert sum(r["n_iban"] for r in got.values()) == 1 and sum(r["n_email"] for r in got.values()) == 1
    masked = by_id(mask_personal_data(docs))
    assert masked[45]["text"] == "ip 10.0.0.300 and <IP>, card <CARD>, IBAN <IBAN>" and masked[0]["text"] is None
    assert find_personal_data(empty).count() == 0 and mask_personal_data(empty).columns == empty.columns
    check = docs.sparkSession.createDataFrame([("GB82 WEST 1234 5698 7654 32",), ("DE89370400440532013000",), ("DE89370400440532013001",)], "c string")
    assert [r[0] for r in check.select(mod97(F.col("c"))).collect()] == [True, True, False]


def components(texts, width, percent=80):
    sets = {}
    for i, text in texts.items():
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text).encode().split()
        sets[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("large", [256, 1])
def test_near_duplicates(docs, empty, monkeypatch, large):
    from costlens.llm import neardup

    monkeypatch.setattr(neardup, "LARGE_KEY", large)
    wanted = components(dict(truth(docs)), 4)
    got = by_id(neardup.near_duplicates(docs, width=4))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == wanted
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    if large == 1:
        assert neardup.near_duplicates(empty).count() == 0


def test_sketches_hold_few_texts_at_once():
    import pandas as pd

    from costlens.llm import neardup

    texts = [None, "", *[" ".join(BASE[i % 24 :]) + f" {i}" for i in range(2 * neardup.SLICE)]]
    frame = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    out = list(neardup._sketcher(4)(iter([frame])))
    assert max(map(len, out)) <= neardup.SLICE
    assert pd.concat(out)["doc_id"].tolist() == list(range(len(texts)))
    assert [n for o in out for n in o["n_shingles"]] == [len(s) for s in neardup.shingle_sets(texts, 4)]


def test_sets_are_made_without_a_shuffle_of_texts(docs, monkeypatch):
    from costlens.llm import neardup

    plans, real = [], neardup.materialise
    monkeypatch.setattr(neardup, "materialise", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    neardup.near_duplicates(docs, width=4)
    made = [p for p in plans if "make(doc_id" in p]
    assert len(made) == 1 and "Exchange hashpartitioning" not in made[0] and "Join" not in made[0]


def test_keys_are_shuffled_once_and_never_added_up(spark):
    from costlens.llm import neardup

    rows = [(i, 5, [i // 2 if k < 3 else 1000 * i + k for k in range(neardup.LONGS)]) for i in range(20)] + [(7, 5, list(range(50, 50 + neardup.LONGS)))]
    classes = spark.createDataFrame(rows, "id long, n int, signature array<long>")
    got = neardup.shared_keys(classes)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Generate") == 1
    keyed = classes.select("id", "n", neardup._keys(classes["signature"]).alias("key")).collect()
    ids = collections.defaultdict(set)
    for r in keyed:
        ids[r["key"]].add(r["id"])
    wanted = {(r["key"], r["id"], r["n"]) for r in keyed if len(ids[r["key"]]) > 1}
    assert wanted and sorted(map(tuple, got.collect())) == sorted(wanted)


def test_near_pairs_of_keys():
    import itertools

    import pandas as pd

    from costlens.llm import neardup

    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, neardup.SYMBOLS, dtype=np.uint8)
    marks = {}
    for i in range(40):
        own = base.copy()
        at = rng.permutation(neardup.SYMBOLS)[: 2 * i]
        own[at] += 1
        marks[i] = own
    rows = [(k, i, 10 + i // 4, i % 3) for k in range(6) for i in range(40) if k == 0 or rng.random() < 0.2]
    rng.shuffle(rows)
    frame = pd.DataFrame(rows, columns=["key", "id", "n", "component"]).assign(bucket=0)
    frame["signature"] = [marks[i].view(np.int64) for i in frame["id"]]
    wanted = set()
    for (k, i, n, c), (l, j, m, e) in itertools.combinations(rows, 2):
        if k == l and c != e and 100 * min(n, m) >= 80 * max(n, m) and (marks[i] != marks[j]).sum() <= neardup.DISTANCE:
            wanted.add((min(i, j), max(i, j)))
    got = neardup._near_pairs(80)(frame)
    assert 0 < len(wanted) < 700 and sorted(map(tuple, got.to_numpy().tolist())) == sorted(wanted)
    assert not len(neardup._near_pairs(80)(frame[frame["component"] == 0]))


def test_a_near_pair_is_found_in_one_key_alone(spark):
    import pandas as pd
    from pyspark.sql import functions as F

    from costlens.llm import neardup

    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, neardup.SYMBOLS, dtype=np.uint8)
    rows = []
    for i in range(40):
        own = base.copy()
        own[rng.permutation(neardup.SYMBOLS)[: i // 2]] += 1
        rows.append((i, own.view(np.int64).tolist()))
    listed = spark.createDataFrame(rows, "id long, signature array<long>").select("*", neardup._keys(F.col("signature")).alias("key"))
    frame = listed.withColumn("slot", F.array_position(neardup._key_list(F.col("signature")), F.col("key"))).toPandas()
    frame = frame.assign(n=10, component=frame["id"])
    buckets = [frame[frame["slot"] % 3 == k] for k in range(3)]
    every = pd.concat([neardup._near_pairs(80)(b) for b in buckets])
    once = pd.concat([neardup._near_pairs(80, once=True)(b) for b in buckets])
    assert len(every) > len(every.drop_duplicates()) == len(once) > 500
    assert set(map(tuple, once.to_numpy().tolist())) == set(map(tuple, every.to_numpy().tolist()))


def test_components_of_chains(spark):
    from costlens.llm.components import connected_components

    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    from costlens.llm.packing import difference, divide, pack_documents

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = pack_documents(docs, path, capacity=512, piece=64).collect()
    ids = {i: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4") for i, t in truth(docs)}
    place, sequence = collections.defaultdict(int), collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        assert r["start"] == place[r["doc_id"]] and r["doc_tokens"] == len(own)
        place[r["doc_id"]] += r["length"]
        assert r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {i: len(x) for i, x in ids.items()} == dict(place)
    for parts in sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    assert len(sequence) <= 1.05 * sum(map(len, ids.values())) / 512 + 1
    assert pack_documents(empty, path).count() == 0
    sizes = np.array([8, 7, 6, 5, 4])
    assert sorted(np.bincount(difference(sizes, 2), weights=sizes)) == [14, 16]
    assert np.bincount(divide(np.array([5] * 9), 10), weights=[5] * 9).max() <= 10


def test_token_files(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer

    from costlens.llm import coder
    from costlens.llm.idfiles import read_shard, read_token_ids, write_shard, write_token_ids

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    folder = f"file://{tmp_path}/ids"
    got = by_id(read_token_ids(spark, folder, write_token_ids(docs, folder, path)))
    start = 0
    for i, text in truth(docs):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    manifest = write_token_ids(empty, f"file://{tmp_path}/none", path)
    assert manifest.count() == 0
    rng = np.random.default_rng(5)
    ids = np.concatenate([rng.integers(0, 65536, 3000), np.tile(rng.integers(0, 50, 40), 100), [65535, 0]])
    raw = write_shard([4, None], [3000, len(ids) - 3000], ids)
    doc_ids, sizes, back = read_shard(raw)
    assert doc_ids == [4, None] and sizes.tolist() == [3000, len(ids) - 3000] and (back == ids).all()
    damaged = bytearray(raw)
    damaged[-3] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        read_shard(bytes(damaged))
    lengths = np.array([0, 1, coder.BLOCK])
    grid = rng.integers(0, 300, (3, coder.BLOCK)) * (np.arange(coder.BLOCK) < lengths[:, None])
    assert (coder.decode(coder.encode(grid, lengths), lengths) == grid).all()


@pytest.mark.parametrize("name, rule", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_pieces_have_the_ids_of_whole_texts(name, rule):
    import random

    from tokenizers import Tokenizer

    from costlens.llm.tokens import encoder

    draw = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "Word, ", "end. ", ".", ",", "Σ", "İ", "ß", " naïve", "\x01", "_,", "é", "é", "'s", "don't", "!!", "<|endoftext|>", "\xa0", "\x1c", "日本", "한", "ᄀ", "ᅡ", "12", "😀"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 9))) for _ in range(8000)] + odd_texts()[1:]
    ids, at = encoder(public_tokenizers.path(name), rule)(texts)
    whole = Tokenizer.from_file(public_tokenizers.path(name)).encode_batch(texts, add_special_tokens=False)
    assert all(ids[a:b].tolist() == w.ids for a, b, w in zip(at[:-1], at[1:], whole))


def test_plain_texts_are_told_all_at_once():
    """What is taken without a look by the rule is what the rule takes."""
    import random

    from costlens.llm import tokens

    draw = random.Random(7)
    parts = [" ", "  ", "\n", "\t", "Word, ", "end. ", ".", ",", "é", "×", "ß,", "÷. ", "\x01", "İ", "日", "\u3000", "\xa0", "\x85", "\u2009", "é. ", "x", "y<|z", "<", "|", "ñ,", "😀.", "_, "]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 5))) for _ in range(20000)]
    sure = tokens._all_plain([t.encode() for t in texts]).tolist()
    rule = [not tokens._PLAIN.search(t) for t in texts]
    assert all(r for s, r in zip(sure, rule) if s)
    assert all(s or not t.isascii() or any(c in t for c in "\t\r") for t, s, r in zip(texts, sure, rule) if r)


def test_mixture(docs, empty):
    from costlens.llm.mixing import mix_sources, sample_mixture

    rows = mix_sources(docs, share=0.6).collect()
    assert len(rows) == docs.count() and all(0 <= r["chance"] <= 1 for r in rows)
    total = sum(r["tokens"] for r in rows)
    assert sum(r["tokens"] * r["chance"] for r in rows) == pytest.approx(0.6 * total, rel=0.02)
    kept = sample_mixture(docs, share=0.6)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["kept"]}
    assert mix_sources(empty).count() == 0 and sample_mixture(empty).count() == 0


def test_raked_marginals(spark):
    from costlens.llm.mixing import DIMENSIONS, rake

    cells = spark.createDataFrame(
        [(s, d, t, 10 + 7 * i + 3 * j + 11 * k) for i, s in enumerate("ab") for j, d in enumerate("xyz") for k, t in enumerate("pq")], "source string, lang string, topic string, tokens long"
    )
    goals = {d: spark.createDataFrame(g, f"{d} string, target double") for d, g in zip(DIMENSIONS, ([("a", 0.3), ("b", 0.7)], [("x", 0.2), ("y", 0.5), ("z", 0.3)], [("p", 0.6), ("q", 0.4)]))}
    raked = rake(cells, goals)
    for d in DIMENSIONS:
        for r in raked.groupBy(d).sum("weight").join(goals[d], d).collect():
            assert r["sum(weight)"] == pytest.approx(r["target"], abs=1e-4)


def test_sample_meets_marginals(spark, empty):
    from pyspark.sql import functions as F

    from costlens.llm.mixing import marginals, mix_sources, sample_mixture

    # A hot source with a third of the tokens, and 20 others.
    docs = spark.range(24000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("some words of document "), "id").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.floor(F.col("id") / 3) % 20)).alias("source"),
        F.when(F.col("id") % 10 == 1, "de").otherwise("en").alias("lang"),
    )
    rows = marginals(docs, share=None).collect()
    assert len(rows) == 21 + 2 + 1
    for r in rows:
        assert r["expected"] == pytest.approx(r["wanted"], rel=1e-5) and r["reached"] == pytest.approx(r["wanted"], abs=0.015)
    hot = next(r["wanted"] for r in rows if r["level"] == "hot")
    sample = sample_mixture(docs, share=None)
    assert sample.columns == docs.columns
    assert sample.filter("source = 'hot'").count() / sample.count() == pytest.approx(hot, abs=0.015)
    # The largest such share: one cell is kept whole.
    assert mix_sources(docs, share=None).agg(F.max("chance")).first()[0] == pytest.approx(1)
    # A share of nine tenths cannot meet them, and the report says so.
    missed = next(r for r in marginals(docs).collect() if r["level"] == "hot")
    assert missed["expected"] > 1.5 * missed["wanted"]
    assert mix_sources(empty, share=None).count() == 0


@pytest.mark.parametrize("name, rule", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_letters_that_normalisation_takes_apart(name, rule):
    """Bengali, Hindi, Hebrew and Tibetan letters end in a mark once normalised."""
    import random

    from tokenizers import Tokenizer

    from costlens.llm.tokens import encoder

    draw = random.Random(8)
    parts = ["য়", "ड़", "אַ", "གྷ", "x", "Word", " ", " ", ". ", ", ", ".\n", ".", "é", "é"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(8000)] + ["xয়. y"]
    ids, at = encoder(public_tokenizers.path(name), rule)(texts)
    whole = Tokenizer.from_file(public_tokenizers.path(name)).encode_batch(texts, add_special_tokens=False)
    assert all(ids[a:b].tolist() == w.ids for a, b, w in zip(at[:-1], at[1:], whole))


def test_coder_holds_few_bytes_for_an_id():
    """Many blocks go through the coder at once, so what it holds for each id must be little."""
    import tracemalloc

    import numpy as np

    from costlens.llm import coder

    grid = np.random.default_rng(5).integers(0, 500, (512, coder.BLOCK))
    lengths = np.full(len(grid), coder.BLOCK)
    tracemalloc.start()
    raw = coder.encode(grid, lengths)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 56 * grid.size
    assert (coder.decode(raw[:3], lengths[:3]) == grid[:3]).all()


def test_coder_steps_hold_little_and_carry():
    """Time goes with what the steps touch: packed counts, narrow tables, none for the encoder."""
    import tracemalloc

    import numpy as np

    from costlens.llm import coder

    rng = np.random.default_rng(6)
    grid = rng.integers(0, 500, (512, coder.BLOCK))
    lengths = np.full(len(grid), coder.BLOCK)
    peaks = []
    for run, given in ((coder.encode, grid), (coder.decode, coder.encode(grid, lengths))):
        tracemalloc.start()
        last = run(given, lengths)
        peaks.append(tracemalloc.get_traced_memory()[1] / grid.size)
        tracemalloc.stop()
    assert (last == grid).all()
    assert peaks[0] < 22 and peaks[1] < 22, peaks
    # Carries run through words of ones; id 0 and blocks of one id; blocks of other lengths end earlier.
    words = np.array([5, 0xFFFFFFFF, 0xFFFFFFFF, 0, 9, 0], "<u4")
    coder._emit(words, np.array([3, 5]), np.array([1 << 32 | 7, 8], np.uint64))
    assert words.tolist() == [6, 0, 0, 7, 9, 8]
    for top in (1, 2, 60, 65536):
        lengths = rng.integers(0, coder.BLOCK + 1, 40)
        grid = rng.integers(0, top, (40, coder.BLOCK)) * (np.arange(coder.BLOCK) < lengths[:, None])
        back = coder.decode(coder.encode(grid, lengths), lengths)
        assert (back == grid[:, : back.shape[1]]).all()


@pytest.mark.parametrize("name, rule", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_pieces_of_signs_capitals_and_long_words(name, rule):
    """Ids as of whole texts, with a memory so small that it forgets all the time."""
    import random

    from tokenizers import Tokenizer

    from costlens.llm.tokens import encoder

    draw = random.Random(9)
    parts = ["Word", "word", "wORD", "***", "&&&", "'s", "'S", "'st", "don't", "I'M", ",", ".", "!", "_", "-", "é", "É", "Ñ.", "ß***", "\u212a", "T\u0308", "T", "\u0308", "Σ", "İ", "д", "12", "3.4", "x@y.z"]
    parts += ["a" * 17, "A" * 17, "a" * 8, "a" * 9, "a" * 16, "x" + "a" * 30, "<", "|", "\x00", "a\x00", " ", " ", " ", "\n", "\xa0", "\u2019", "’s"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(12000)]
    whole = Tokenizer.from_file(public_tokenizers.path(name)).encode_batch(texts, add_special_tokens=False)
    encode = encoder(public_tokenizers.path(name), rule, memory=300)
    for a in range(0, len(texts), 200):
        ids, at = encode(texts[a : a + 200])
        assert all(ids[x:y].tolist() == w.ids for x, y, w in zip(at[:-1], at[1:], whole[a : a + 200]))


def test_few_pieces_are_learnt():
    """A word with signs behind it or a capital is no new piece, nor one seen again before the memory was full."""
    from costlens.llm import tokens

    path = public_tokenizers.path("word_bpe_49k.json")
    encode = tokens.encoder(path, "word", memory=400)
    held = tokens._shelf()[(path, "word")]
    held.clear()
    encode(["Garten&&& garten, Garten garten***", "Größe größe. Größe", "größe"])
    # garten, größe, and the signs &&& , *** .
    assert held.n <= 6
    letters = "abcdefghij"
    for a in range(0, 800, 200):
        encode([" ".join(letters[i // 100] + letters[i // 10 % 10] + letters[i % 10] + "xqz" for i in range(a, a + 200)), "garten größe"])
    learnt = []
    learn = held._learn
    held._learn = lambda *given: learnt.append(given) or learn(*given)
    encode(["garten größe"])
    del held._learn
    held.clear()
    assert not learnt
