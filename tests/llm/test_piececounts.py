"""Token counts against the library itself."""

from __future__ import annotations

import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "é", "日", "本", "😀", "1", "23", ".", ",", "<s>", "</s>", "▁", "́", "zq", "\x00", "য়", "ー", "    ", "=", "==", "//"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_rows(odd_docs, no_docs, odd_rows, library):
    from costlens.llm.piececounts import count_tokens

    def order(rows):
        return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))

    got = order(tuple(r) for r in count_tokens(odd_docs, PATH, limit=300).collect())
    want = []
    for doc_id, text, *_ in odd_rows:
        n = len(library.encode(text or ""))
        want.append((doc_id, len((text or "").encode()), n, n > 300))
    assert got == order(want)
    assert count_tokens(no_docs, PATH).count() == 0


def test_random_texts(library):
    from costlens.llm import piececounts

    draw = random.Random(5)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 40))) for _ in range(20000)]
    got = piececounts.count_texts(piececounts.load(PATH), texts)
    assert (got == [len(x) for x in library.encode(texts, num_threads=1)]).all()


@pytest.mark.parametrize("window, long", [(64, 4), (1 << 20, 256)])
def test_long_texts(library, monkeypatch, window, long):
    from costlens.llm import piececounts

    monkeypatch.setattr(piececounts, "WINDOW", window)
    monkeypatch.setattr(piececounts, "LONG", long)
    draw = random.Random(6)
    texts = ["a" * 3000, " " * 3000, "".join(draw.choice("abcdefghijKLMNOP") for _ in range(5000)), "日本" * 900, "", " ".join("".join(draw.choice("etaoin") for _ in range(6)) for _ in range(3000))]
    assert piececounts.count_texts(piececounts.load(PATH), texts).tolist() == [len(library.encode(t)) for t in texts]


def test_hash_collisions(library, monkeypatch):
    from costlens.llm import piececounts

    monkeypatch.setattr(piececounts, "span_hashes", lambda points, starts, ends, base: np.zeros(len(starts), dtype=np.uint64))
    texts = ["one two three", "three two one zero", "x yy zzz"]
    assert piececounts.count_texts(piececounts.load(PATH), texts).tolist() == [len(library.encode(t)) for t in texts]


def test_other_models_are_refused(tmp_path):
    from costlens.llm.piececounts import Merges
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.trainer_spec.model_type = 1
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        Merges(str(path))
