"""Toxicity, page text, vector search and the pipeline."""

from __future__ import annotations

import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")


def labelled(spark, n=400):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        toxic = i % 8 == 0
        text = draw.choices(words, k=60) + (draw.sample(["vilea", "vileb", "viles", "dolt", "oaf"], 2) if toxic else [])
        draw.shuffle(text)
        rows.append((i, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([(i, t, "extra") for i, t, _ in rows] + [(n, None, "x"), (n + 1, "", "x"), (0, rows[0][1], "x")], "doc_id long, text string, score string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None)], "doc_id long, toxic int"), {i: y for i, _, y in rows}


def test_toxicity(spark):
    from costlens.llm.toxicity import THRESHOLD, held_out, reject_toxic, score_toxicity, train

    docs, labels, want = labelled(spark)
    model = train(docs, labels.filter(~held_out("doc_id")))
    rows = score_toxicity(docs, model).withColumn("out", held_out("doc_id")).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    unseen = [r for r in rows if r["out"] and r["doc_id"] in want]
    assert len(unseen) > 50 and all((r["score"] >= THRESHOLD) == bool(want[r["doc_id"]]) for r in unseen)
    kept = reject_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, y in want.items() if not y} | {400, 401}
    none = train(docs, labels.limit(0))
    assert score_toxicity(docs.limit(0), none).count() == 0
    assert max(r["score"] for r in score_toxicity(docs, none).collect()) < THRESHOLD


def test_label_model_discounts_copies():
    from costlens.llm.toxicity import label_model

    rng = np.random.default_rng(0)
    truth = rng.random(3000) < 0.3
    voters = [np.where(rng.random(3000) < 0.85, truth, ~truth) for _ in range(5)]
    copied = np.where(rng.random(3000) < 0.6, truth, ~truth)
    votes = np.stack([*voters, *[copied] * 4], axis=1)
    posterior, speak, correlation, weight = label_model(votes, np.where(votes[:, :5].mean(axis=1) > 0.5, 0.8, 0.2))
    assert ((posterior > 0.5) == truth).mean() > 0.95
    assert weight[5:].max() < 0.5 < weight[:5].min() and correlation[5, 6] > 0.9
    assert (speak[1][:5] > 0.75).all() and (speak[0][:5] < 0.25).all()


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p><article>no";</script></head><body>
<nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav><div class="ad">Buy this now</div>
<article><h1>A &amp; B</h1><p>First <b>bold</b>
 line.<br><p>Second&nbsp;&#8364; line</p><!-- <p>no</p> --></article><footer>&copy; someone</footer>"""


def test_page_text(spark, sf):
    from costlens.llm.pages import extract_main_text, leaf_blocks

    assert [b.text for b in leaf_blocks(PAGE)] == ["Home", "News", "Buy this now", "A & B", "First bold line.", "Second € line", "© someone"]
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    odd = spark.createDataFrame(
        [(900001, "u", PAGE), (900002, None, None), (900003, "u", ""), (900004, "u", "<"), (900005, "u", "<script>x"), (None, "u", PAGE), (900001, "u", PAGE)], "page_id long, url string, html string"
    )
    got = extract_main_text(pages.unionByName(odd)).collect()
    assert len(got) == pages.count() + odd.count() and all(r["n_chars"] == len(r["text"]) for r in got)
    special = {r["page_id"]: r["text"] for r in got}
    assert special[900001] == special[None] == "A & B\n\nFirst bold line.\n\nSecond € line"
    assert special[900002] == special[900003] == special[900005] == ""
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    same = [special[i] == "\n\n".join(b.text for b in leaf_blocks(h) if "article" in b.tags) for i, h in html.items()]
    assert np.mean(same) > 0.97
    assert extract_main_text(pages.limit(0)).count() == 0


def test_labeller_on_unseen_layouts(spark, sf):
    from costlens.llm.pages import compose, label, leaf_blocks, padded, train_on, vectors

    html = [r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    net = train_on(html[:40], 500)
    draw, good = random.Random(5), [b.text for h in html for b in leaf_blocks(h) if "article" in b.tags]
    right = total = 0
    for _ in range(100):
        page, labels = compose(draw, good, ["Home", "Contact us", "Terms"])
        blocks = leaf_blocks(page)
        assert len(blocks) == len(labels)
        x, mask = padded([vectors(blocks)])
        right += ((label(net, x, mask)[:, 0] >= 0.5) == np.array(labels)).sum()
        total += len(labels)
    assert right / total > 0.93


def test_top_products(spark):
    from costlens.llm.nearest import top_products

    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)]
    bad = [(500, None), (501, [None] * 8), (502, [float("nan")] * 8), (503, [float("inf")] + [0.0] * 7), (None, rows[0][1]), (504, [1.0])]
    df = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<float>").selectExpr("*", "'x' AS pivot", "'y' AS ring")
    got = {}
    for r in top_products(df, df.filter("vec_id % 50 = 0 OR vec_id = 7"), k=5, pivots=6, rings=3).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    whole = {i: np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(int) for i, v in rows}
    for q in [*range(0, 360, 50), 7]:
        scores = sorted((-int(whole[q] @ whole[i]), i) for i in whole if i != q)[:5]
        assert got.pop(q) == [(i, -s) for s, i in scores]
    assert not got
    assert top_products(df.limit(0), df.limit(0)).count() == 0


def test_main_text_in_forms_and_dialogs(spark, sf):
    from costlens.llm.pages import leaf_blocks, main_text, train_on

    html = [r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    net = train_on(html)
    wanted = ["\n\n".join(b.text for b in leaf_blocks(h) if "article" in b.tags) for h in html]
    wraps = [
        ('<form method="post" action="./" id="form1">', "</form>", "<body>", "</body>"),
        ('<dialog open>', "</dialog>", "<article>", "</article>"),
    ]
    for start, end, after, before in wraps:
        set_anew = [(h.replace(after, after + start) if after == "<body>" else h.replace(after, start + after)) for h in html]
        set_anew = [(h.replace(before, end + before) if before == "</body>" else h.replace(before, before + end)) for h in set_anew]
        assert all(start in h for h in set_anew)
        assert np.mean([a == b for a, b in zip(main_text(net, set_anew), wanted)]) > 0.9
    assert np.mean([a == b for a, b in zip(main_text(net, html), wanted)]) > 0.97


def test_word_vector_reads_whole_blocks():
    from costlens.llm.pages import PATH_SIZE, WORD_SIZE, leaf_blocks, vectors

    start = " ".join(f"w{i}" for i in range(400))
    a, b = (vectors(leaf_blocks(f"<p>{start} {end}</p>"))[0, PATH_SIZE : PATH_SIZE + WORD_SIZE] for end in ("cookie consent notice", "quiet river bank"))
    assert not np.array_equal(a, b) and a.sum() == pytest.approx(1, abs=1e-5) == b.sum()
    # The places hold all words, whatever their order.
    back = vectors(leaf_blocks("<p>" + " ".join(reversed(f"{start} cookie consent notice".split())) + "</p>"))[0]
    assert np.allclose(back[PATH_SIZE : PATH_SIZE + WORD_SIZE], a)


@pytest.mark.parametrize("copies", [2, 7])
def test_top_products_of_repeated_rows(spark, copies):
    from costlens.llm.nearest import top_products

    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(40)]
    rows += [(40 + i, [float(9 - i), 0.0, 0.0, 0.0]) for i in range(5)] + [(7, [float(i), 1.0, 0.0, 0.0]) for i in range(3)]
    df = spark.createDataFrame(rows * copies, "vec_id long, embedding array<double>")
    got = {}
    for r in top_products(df, df.filter("vec_id % 5 = 0 OR vec_id = 7"), pivots=1, rings=1).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    asked = {i for i, _ in rows if i % 5 == 0 or i == 7}
    distinct = sorted({(i, tuple(v)) for i, v in rows})
    for q in asked:
        scores = sorted((-int(256 * 256 * np.dot(u, v)), i) for j, u in distinct if j == q for i, v in distinct if i != q)[:5]
        assert got.pop(q) == [(-s, i) for s, i in scores]
    assert not got


def test_repeated_ids_keep_their_texts(spark, sf):
    import corpus_pipeline

    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None, "a"), (1, None, "a"), (2, long, "b"), (2, "quite another text of its own", "c"), (2, long, "b"), (3, None, "d"), (None, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.near_duplicate_removal(spark, docs, sf).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, set(rows)))


@pytest.mark.parametrize("bits", [3, 27])
def test_copies_go_whatever_the_bits_let_through(spark, sf, monkeypatch, bits):
    import corpus_pipeline
    from costlens.llm import bitsets

    gather = bitsets.gather
    monkeypatch.setattr(bitsets, "gather", lambda keys, n: gather(keys, max(6, bits), n))
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(i, " ".join(f"{i}x{k}" for k in range(9)), "a") for i in range(50)]
    rows += [(100, long, "a"), (101, long + " end", "b"), (102, long, "c"), (101, "a text of an id that goes", "d"), (3, None, "e"), (3, None, "f"), (None, long, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string")
    out = corpus_pipeline.near_duplicate_removal(spark, docs, sf)
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    wanted = {(i, t) for i, t, _ in rows if i not in (101, 102)}
    assert out.columns == docs.columns and len(got) == len(wanted) and set(got) == wanted


def test_pipeline(spark, sf, tmp_path):
    import corpus_pipeline
    from costlens.llm.toxicity import THRESHOLD, score_toxicity, train

    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("*", "'x' AS bucket", "doc_id AS kept")
    odd = docs.limit(1).selectExpr("doc_id", "CAST(NULL AS string) AS text", "CAST(NULL AS string) AS lang", "source", "n_chars", "bucket", "kept")
    docs = docs.unionByName(docs.limit(3)).unionByName(odd.withColumn("doc_id", odd["doc_id"] + 10**6))
    held, counts = docs, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"file://{tmp_path}/{k}"
        stage(spark, held, sf).write.parquet(path)
        new = spark.read.parquet(path)
        if k == 0:
            model = train(held, spark.read.parquet(f"{sf}/labels.parquet"))
            bad = score_toxicity(held, model).filter(f"score >= {THRESHOLD}").count()
            assert new.count() == counts[0] - bad
        if k < 4:
            assert new.columns == docs.columns
        held = new
        counts.append(held.count())
    assert counts[0] > counts[2] and counts[2] == counts[3] >= counts[4] > 0.6 * counts[3]
    assert {r["doc_id"] for r in held.collect()} == {r["doc_id"] for r in spark.read.parquet(f"file://{tmp_path}/3").collect()}
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, sf)
        assert out.count() == 0
