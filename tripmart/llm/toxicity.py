"""Toxicity scores from a counterfactual-regularised classifier.

A logistic model over hashed words and word beginnings. Where a labelled sentence names
a group, the model also sees the sentence with another group's name, and the difference
of both scores is penalised: a name alone may not move a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bound of the labelled rows that are fitted, drawn by a hash of doc_id.
SAMPLE_ROWS = 8000
BITS = 18
SELECTED = 4096
THRESHOLD = 0.3
SWAP_WEIGHT = 1.0
PREFIXES = (4, 5, 6)
CACHED_WORDS = 200_000
SEED = 5

# Names of groups that are exchanged for one another.
IDENTITY_TERMS = (
    "women", "men", "muslims", "christians", "jews", "hindus", "buddhists", "atheists",
    "immigrants", "refugees", "foreigners", "gays", "lesbians", "blacks", "whites", "asians",
    "africans", "europeans", "americans", "mexicans", "chinese", "indians", "arabs", "turks",
    "frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge",
    "femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers", "réfugiés",
    "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "extranjeros", "refugiados",
)

SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
EDGES = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))


def word_features(word: str) -> list[int]:
    """Hashed features of one lower-case word: itself and its beginnings."""
    core = word.strip(EDGES)
    if not core:
        return []
    names = ["=" + core] + [core[:size] for size in PREFIXES if len(core) >= size]
    return [xxhash.xxh32_intdigest(n.encode("utf-8", "surrogatepass")) >> (32 - BITS) for n in names]


def text_features(text: str) -> np.ndarray:
    """Distinct features of a whole text, sorted."""
    found = {f for word in set(text.lower().split()) for f in word_features(word)}
    return np.array(sorted(found), np.int32)


def swapped_sentences(text: str, terms: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features lost and gained in each sentence whose group names are exchanged, each for
    the next one of the list."""
    following = dict(zip(terms, [*terms[1:], *terms[:1]]))
    lowered = text.lower()
    if not any(term in lowered for term in terms):
        return
    for sentence in SENTENCE.split(lowered):
        words = sentence.split()
        other = [following.get(word.strip(EDGES), word) for word in words]
        if other != words:
            one, two = text_features(" ".join(words)), text_features(" ".join(other))
            yield np.setdiff1d(one, two), np.setdiff1d(two, one)


@dataclass
class Scorer:
    """Weights of the selected features, and the bias."""

    weights: dict[int, float]
    bias: float

    def score(self, text: str, cache: dict[str, tuple]) -> float:
        """Probability of the label; ``cache`` keeps the weighted features of words."""
        found: set[int] = set()
        for word in set(text.lower().split()):
            known = cache.get(word)
            if known is None:
                known = tuple(f for f in word_features(word) if f in self.weights)
                if len(cache) >= CACHED_WORDS:
                    cache.clear()
                cache[word] = known
            found.update(known)
        logit = self.bias + sum(self.weights[f] for f in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def select_features(rows: list[np.ndarray], labels: np.ndarray, count: int) -> np.ndarray:
    """The features whose document shares differ most between the labels, in standard
    deviations; ties by feature."""
    totals = np.zeros((2, 1 << BITS))
    for row, label in zip(rows, labels):
        totals[label, row] += 1
    sizes = np.bincount(labels, minlength=2)
    shares = (totals + 0.5) / (sizes[:, None] + 1)
    pooled = (totals.sum(axis=0) + 0.5) / (len(labels) + 1)
    spread = np.sqrt(pooled * (1 - pooled) * (1 / sizes[0] + 1 / sizes[1]))
    z = np.abs(shares[1] - shares[0]) / np.maximum(spread, 1e-9)
    z[totals.sum(axis=0) < 2] = 0
    best = np.argsort(-z, kind="stable")[:count]
    return np.sort(best[z[best] > 2.5])


def fit(
    rows: list[np.ndarray],
    labels: np.ndarray,
    swaps: list[tuple[np.ndarray, np.ndarray]],
    swap_weight: float = SWAP_WEIGHT,
    steps: int = 400,
    decay: float = 2e-3,
) -> Scorer:
    """Logistic regression with a penalty on the squared score change of swaps, by Adam.

    Rows of one label only give a constant score: that label's share.
    """
    if len(labels) == 0 or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.0
        return Scorer({}, float(np.log((share + 1e-4) / (1 - share + 1e-4))))
    chosen = select_features(rows, labels, SELECTED)
    if len(chosen) == 0:
        share = labels.mean()
        return Scorer({}, float(np.log(share / (1 - share))))

    def matrix(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) of every selected feature that is present."""
        kept = [np.searchsorted(chosen, np.intersect1d(s, chosen)) for s in sets]
        if not kept:
            return np.empty(0, int), np.empty(0, int)
        return np.repeat(np.arange(len(kept)), [len(k) for k in kept]), np.concatenate(kept)

    at, on = matrix(rows)
    lost_at, lost = matrix([one for one, _ in swaps])
    gained_at, gained = matrix([two for _, two in swaps])
    weights, bias = np.zeros(len(chosen) + 1), -1
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    weights[bias] = np.log(labels.mean() / (1 - labels.mean()))
    for step in range(1, steps + 1):
        logits = weights[bias] + np.bincount(at, weights[on], len(rows))
        rest = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) / len(rows)
        slope = np.append(np.bincount(on, rest[at], len(chosen)), rest.sum())
        slope[:-1] += decay * weights[:-1] / len(chosen) ** 0.5
        if swaps:
            change = np.bincount(gained_at, weights[gained], len(swaps))
            change -= np.bincount(lost_at, weights[lost], len(swaps))
            push = 2 * swap_weight * change / len(swaps)
            slope[:-1] += np.bincount(gained, push[gained_at], len(chosen))
            slope[:-1] -= np.bincount(lost, push[lost_at], len(chosen))
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weights -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Scorer(dict(zip(chosen.tolist(), weights[:-1].tolist())), float(weights[bias]))


def train_scorer(docs: DataFrame, labels: DataFrame, terms: Sequence[str]) -> Scorer:
    """Fit on at most ``SAMPLE_ROWS`` labelled documents: those of the smallest hashes.

    ``labels`` has (doc_id, toxic); rows without either are left out. The sample's ids are
    broadcast, as their number is bounded.
    """
    drawn = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id")
        .limit(SAMPLE_ROWS)
    )

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text or "" for text in batch["text"]]
            swaps = [list(swapped_sentences(text, terms)) for text in texts]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "toxic": batch["toxic"],
                    "features": [text_features(text) for text in texts],
                    "lost": [[one for one, _ in pairs] for pairs in swaps],
                    "gained": [[two for _, two in pairs] for pairs in swaps],
                }
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {doc_id}, toxic int, features array<int>, lost array<array<int>>, "
        "gained array<array<int>>"
    )
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = found.mapInPandas(features, schema).limit(SAMPLE_ROWS).toPandas().sort_values("doc_id")
    swaps = [
        (np.asarray(one, int), np.asarray(two, int))
        for lost, gained in zip(rows["lost"], rows["gained"])
        for one, two in zip(lost, gained)
    ]
    return fit(
        [np.asarray(row, int) for row in rows["features"]], rows["toxic"].to_numpy(int), swaps
    )


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, terms: Sequence[str] = IDENTITY_TERMS
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    Rows whose crc32 of doc_id as text leaves 2 modulo 4 are held out: their labels are not
    read. Only the text enters a score; null and empty texts get that of no words. A null
    doc_id is not held out. Repeated rows get equal scores; without labels the score is 0,
    up to rounding. Other columns are dropped.
    """
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    held_out = F.coalesce(rest == 2, F.lit(False))
    known = labels.select("doc_id", "toxic").where(~held_out)
    scorer = docs.sparkSession.sparkContext.broadcast(train_scorer(docs, known, terms))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, tuple] = {}
        for texts in batches:
            yield pd.Series([scorer.value.score(t or "", cache) for t in texts], dtype=float)

    scored = docs.select("doc_id", held_out.alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
