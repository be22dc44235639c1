"""Toxicity of texts by weak supervision.

Voters are lexicons and patterns. The lexicons are found in a bounded sample of labelled
rows: words, and word beginnings of four to six letters, that toxic rows have far more
often; each lexicon is one voter. Patterns (shouting, repeated marks, direct address,
absence of any listed word) and the given label are further voters. A generative label model estimates by
expectation-maximisation how often each voter speaks given either class, and from the
residuals how strongly voters are correlated; correlated voters share one weight. Its
posteriors are the soft labels on which a linear classifier over words and word
beginnings is trained. Only the classifier scores documents; it never sees a label,
language, source or id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.textops import FAMILIES, U64, mix, span_hashes

SAMPLE_ROWS = 6_000  # labelled rows that are learnt from, at most
THRESHOLD = 0.3
SPACE_BITS = 22  # hashed words and beginnings
LEXICONS = 24  # voters of each kind of lexicon
FEATURES = 4096
PRECISION = 0.8  # share of toxic rows among those with a listed feature
PREFIXES = (4, 5, 6)
EDGES = " \t\n\r.,;:!?\"'()[]{}<>*#$%&|-_=+/\\~`^@…“”‘’«»¡¿"

_MARKS = re.compile(r"[!?]{2,}|[*#$%&]{3,}")
_CAPS = re.compile(r"\b[A-Z]{3,}\b")
_YOU = re.compile(r"\b(?:you|your|du|dein|tu|ton|tus|vous)\b", re.I)


def hashed(names: list[str]) -> np.ndarray:
    raw = [n.encode("utf-8", "surrogatepass") for n in names]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    ends = np.cumsum(sizes)
    h = span_hashes(np.frombuffer(b"".join(raw), dtype=np.uint8), ends - sizes, ends, FAMILIES[0])
    return (h >> np.uint64(64 - SPACE_BITS)).astype(np.int64)


def names_of(token: str) -> list[str]:
    """The word of a token in lower case, and its beginnings."""
    word = token.strip(EDGES).lower()
    if len(word) < 3:
        return []
    return ["=" + word] + [f"{n}{word[:n]}" for n in PREFIXES if len(word) > n]


class Features:
    """Hashed names of tokens, kept for tokens seen before."""

    def __init__(self, wanted: np.ndarray | None = None, memory: int = 300_000):
        self.known: dict[str, tuple] = {}
        self.wanted = None if wanted is None else set(wanted.tolist())
        self.memory = memory

    def of(self, text: str) -> np.ndarray:
        tokens = set(text.split())
        missing = [t for t in tokens if t not in self.known]
        if missing:
            if len(self.known) > self.memory:
                self.known.clear()
                missing = list(tokens)
            names = [names_of(t) for t in missing]
            flat = hashed([n for ns in names for n in ns]).tolist() if any(names) else []
            at = 0
            for token, ns in zip(missing, names):
                ids = flat[at : at + len(ns)]
                at += len(ns)
                self.known[token] = tuple(ids if self.wanted is None else [i for i in ids if i in self.wanted])
        found: set = set()
        for ids in map(self.known.__getitem__, tokens):
            if ids:
                found.update(ids)
        return np.array(sorted(found), dtype=np.int32)


def patterns(text: str) -> list[float]:
    """Rates per word of shouting, repeated marks and direct address."""
    words = max(1, text.count(" ") + 1)
    return [len(p.findall(text)) / words for p in (_CAPS, _MARKS, _YOU)]


def _describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    features = Features()
    for frame in frames:
        texts = [t if isinstance(t, str) else "" for t in frame["text"]]
        yield pd.DataFrame(
            {"toxic": frame["toxic"], "features": [features.of(t).tobytes() for t in texts], "patterns": [patterns(t) for t in texts]}
        )


# ---- label model ------------------------------------------------------------


def label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 50):
    """Posterior of class 1 given binary votes (rows by voters), from starting posteriors.

    Returns posteriors, the chance of a vote given class 0 and 1, the residual
    correlations of voters and their weights.
    """
    rows, voters = votes.shape
    v = votes.astype(float)
    p = np.clip(start, 0.02, 0.98)
    weight = np.ones(voters)
    for turn in range(rounds):
        prior = np.clip(p.mean(), 1e-3, 1 - 1e-3)
        speak = np.stack([((1 - p) @ v + 0.5) / ((1 - p).sum() + 1.0), (p @ v + 0.5) / (p.sum() + 1.0)])
        if turn % 10 == 5:
            # What the classes leave unexplained: correlated voters share their weight.
            rest = v - (p[:, None] * speak[1] + (1 - p)[:, None] * speak[0])
            deviation = np.sqrt((rest**2).mean(axis=0)) + 1e-9
            correlation = (rest.T @ rest) / rows / np.outer(deviation, deviation)
            np.fill_diagonal(correlation, 0.0)
            weight = 1.0 / (1.0 + np.clip(correlation, 0.0, 1.0).sum(axis=1))
        yes = weight * np.log(speak[1] / speak[0])
        no = weight * np.log((1 - speak[1]) / (1 - speak[0]))
        logit = np.log(prior / (1 - prior)) + v @ yes + (1 - v) @ no
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - p).max() < 1e-6 and turn > 6:
            p = new
            break
        p = new
    return p, speak, correlation if rounds > 5 else None, weight


def lexicon(present: np.ndarray, toxic: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features that toxic rows have more often than chance allows, the clearest first.

    The likelihood ratio against the overall rate must exceed twice the logarithm of the
    number of features tried, so that about one of them passes by chance; and most rows
    with the feature must be toxic.
    """
    base = toxic.mean()
    a, n = present, counts
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.where(a > 0, a * np.log(a / (n * base)), 0) + np.where(n > a, (n - a) * np.log((n - a) / (n * (1 - base))), 0))
    order = np.argsort(-ratio, kind="stable")
    needed = 2 * np.log(max(2, int((n > 1).sum())))
    return order[(ratio[order] > needed) & (a[order] >= max(PRECISION, base) * n[order])]


def distinct_rows(features: list[np.ndarray], bands: int = 3, width: int = 4) -> np.ndarray:
    """Rows that are no near copy of an earlier one, by min-hashes of their features.

    A copied toxic text would make each of its words look like evidence.
    """
    seeds = mix(np.arange(1, bands * width + 1, dtype=U64))
    seen: set = set()
    keep = []
    for i, own in enumerate(features):
        if len(own) > 8:
            h = own.astype(U64)
            least = [int(mix(h ^ s).min()) for s in seeds]
            keys = [(b, *least[b * width : (b + 1) * width]) for b in range(bands)]
            copy = any(k in seen for k in keys)
            seen.update(keys)
            if copy:
                continue
        keep.append(i)
    return np.array(keep, dtype=np.int64)


def fit(toxic: np.ndarray, features: list[np.ndarray], rates: np.ndarray) -> dict:
    """Classifier from described rows; ``features`` are sorted hashes of each."""
    own = distinct_rows(features)
    toxic, features, rates = toxic[own].astype(float), [features[i] for i in own], rates[own]
    if not len(toxic) or toxic.min() == toxic.max():
        chance = float(np.clip(toxic.mean() if len(toxic) else 0.0, 0.01, 0.99))
        return {"features": np.empty(0, np.int64), "weights": np.empty(0), "bias": float(np.log(chance / (1 - chance)))}
    row = np.repeat(np.arange(len(features), dtype=np.int32), [len(f) for f in features])
    ids = np.concatenate(features)
    size = 1 << SPACE_BITS
    counts = np.bincount(ids, minlength=size)
    bad = np.bincount(ids, weights=toxic[row], minlength=size)
    seen = np.flatnonzero(counts)
    words = seen[lexicon(bad[seen], toxic, counts[seen])][:FEATURES]
    # Voters: every list takes each LEXICONS-th entry, so that all are of like strength.
    # Only entries of the lists matter from here on.
    listed = np.zeros(size, dtype=bool)
    listed[words] = True
    row, ids = row[listed[ids]], ids[listed[ids]]
    voter = np.full(size, -1, dtype=np.int32)
    voter[words] = np.arange(len(words)) % LEXICONS
    hit = voter[ids]
    votes = np.zeros((len(toxic), LEXICONS), dtype=bool)
    votes[row[hit >= 0], hit[hit >= 0]] = True
    high = rates > np.quantile(rates, 0.9, axis=0)
    # The given label is the surest voter, yet may be wrong.
    votes = np.hstack([votes, high, ~votes.any(axis=1, keepdims=True), toxic[:, None] > 0])
    votes = votes[:, votes.any(axis=0) & ~votes.all(axis=0)]
    posterior = label_model(votes, 0.05 + 0.9 * toxic)[0] if votes.shape[1] else toxic
    # Linear classifier on the posteriors, over the features with most evidence for them.
    place = np.full(size, -1, dtype=np.int32)
    place[words] = np.arange(len(words))
    at = place[ids]
    r, c = row[at >= 0], at[at >= 0]
    weights, bias = np.zeros(len(words)), -1.0
    step, speed, speed_b = 0.5, np.zeros(len(words)), 0.0
    for _ in range(300):
        z = bias + np.bincount(r, weights=weights[c], minlength=len(toxic))
        gap = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - posterior
        gradient = np.bincount(c, weights=gap[r], minlength=len(words)) + 0.02 * weights
        speed = 0.9 * speed - step * gradient / (10 + counts[words])
        speed_b = 0.9 * speed_b - step * gap.mean()
        # A listed word never speaks for a text being clean.
        weights, bias = np.maximum(weights + speed, 0.0), bias + speed_b
    return {"features": words, "weights": weights, "bias": float(bias)}


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Fit on at most ``sample_rows`` labelled rows, drawn by a hash of their id.

    ``labels`` has ``doc_id, toxic``; null labels and ids are left out, and the first of
    repeated ones (the largest label) counts. The sample is broadcast to the scan.
    """
    drawn = (
        labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(drawn), "doc_id")
        .select("text", "toxic")
        .mapInPandas(_describe, "toxic int, features binary, patterns array<double>")
        .toPandas()
    )
    features = [np.frombuffer(f, dtype=np.int32) for f in rows.pop("features")]
    rates = np.array(rows["patterns"].to_list(), dtype=float).reshape(len(rows), 3)
    return fit(rows["toxic"].to_numpy(), features, rates)


def _scorer(model: dict):
    order = np.argsort(model["features"])
    ids, weights = model["features"][order], model["weights"][order]

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features(ids)
        for frame in frames:
            z = np.full(len(frame), model["bias"])
            for i, text in enumerate(frame["text"]):
                if isinstance(text, str):
                    found = features.of(text)
                    if len(found):
                        z[i] += weights[np.searchsorted(ids, found)].sum()
            yield frame.drop(columns="text").assign(score=1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score


def score_toxicity(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``score`` of each whole text, from 0 to 1, beside the columns ``keep``.

    Null and empty texts get the score of a text without evidence. One row per input row;
    an empty table gives an empty result.
    """
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    columns = [*keep, F.col("text").cast("string").alias("text")] if "text" not in keep else [*keep]
    if "text" in keep:
        raise ValueError("text cannot be kept; join the scores instead")
    return docs.select(*columns).mapInPandas(_scorer(model), f"{schema}, score double")


def held_out(doc_id) -> F.Column:
    """Rows never learnt from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string")) % 4 == 2, F.lit(False))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more; same columns.

    Rows are judged by text alone, so equal texts share their fate.
    """
    model = train(docs, labels)
    names = docs.columns
    order = np.argsort(model["features"])
    ids, weights, bias = model["features"][order], model["weights"][order], model["bias"]
    limit = float(np.log(threshold / (1 - threshold)))

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        features = Features(ids)
        out = np.ones(len(texts), dtype=bool)
        for i, text in enumerate(texts):
            found = features.of(text) if isinstance(text, str) else ()
            out[i] = bias + (weights[np.searchsorted(ids, found)].sum() if len(found) else 0.0) < limit
        return pd.Series(out)

    return docs.filter(clean(F.col("text").cast("string"))).select(*names)
