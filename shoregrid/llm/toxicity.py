"""Toxicity by a logistic model that is held to the same score when identity terms are swapped.

Features are the words of a text and their beginnings, hashed. Labelled sentences that mention a
group are rewritten with other groups of the same kind and with a neutral noun; the squared change of
the model's logit between the versions is part of the loss, so mentions as such cannot carry toxicity.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoregrid.llm.common import ready, written

SAMPLE_ROWS = 20_000
"""At most so many labelled rows are fitted, half of them of either label (by hash of the id)."""
FEATURES = 4_000
"""At most so many features enter the model: those that speak most for label 1, and the identity terms."""
BUCKETS = 1 << 24
STEMS = range(3, 11)
THRESHOLD = 0.7
SWAP_PENALTY = 1.0
SPARSITY = 1e-4
ROUNDS = 600
CACHED_WORDS = 400_000

# Terms that name groups, by kind; the first of each kind is the neutral noun.
IDENTITY_TERMS = [
    ["people", "women", "men", "girls", "boys", "trans", "nonbinary"],
    ["person", "woman", "man", "girl", "boy", "mother", "father"],
    ["believers", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["religious", "muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["ethnic", "black", "white", "asian", "african", "latino", "arab", "european"],
    ["couples", "gay", "lesbian", "straight", "bisexual", "queer", "homosexual"],
    ["residents", "immigrants", "refugees", "migrants", "foreigners", "natives"],
    ["adults", "disabled", "deaf", "blind", "elderly", "young"],
    ["menschen", "frauen", "männer", "juden", "muslime", "christen", "flüchtlinge", "ausländer"],
    ["personnes", "femmes", "hommes", "juifs", "musulmans", "chrétiens", "réfugiés", "étrangers"],
    ["personas", "mujeres", "hombres", "judíos", "musulmanes", "cristianos", "refugiados", "extranjeros"],
]

_EDGES = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>|/\\*#$%&+=-_~`^@…«»„“”‘’¿¡"
_SENTENCES = re.compile(r"[.!?\n]+")
_KINDS = {term: kind for kind in IDENTITY_TERMS for term in kind}


def _hashed(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


def word_features(word: str) -> list[int]:
    """The word itself and its beginnings; nothing for what has no letter."""
    word = word.strip(_EDGES)
    if not any(map(str.isalpha, word)):
        return []
    return [_hashed(f"w {word}"), *(_hashed(f"s {word[:k]}") for k in STEMS if len(word) >= k)]


def text_features(text: str) -> set[int]:
    return {f for word in set(text.lower().split()) for f in word_features(word)}


def swaps(text: str) -> list[tuple[list[int], list[int]]]:
    """(features lost, features gained) for every rewriting of every sentence that names a group."""
    found = []
    if not any(term in text for term in _KINDS):
        return found
    for sentence in set(_SENTENCES.split(text)):
        parts = [w.strip(_EDGES) for w in sentence.split()]
        for term in dict.fromkeys(p for p in parts if p in _KINDS):
            before = {f for w in parts for f in word_features(w)}
            for other in _KINDS[term]:
                if other != term:
                    after = {f for w in parts for f in word_features(other if w == term else w)}
                    found.append((sorted(before - after), sorted(after - before)))
    return found


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, features, lost, gained) of at most SAMPLE_ROWS labelled documents, repeated texts once.

    Copies would make any word of theirs look telling. `lost` and `gained` are flat lists; an entry
    of -1 ends the features of one rewriting.
    """
    given = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    given = given.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    halves = [
        given.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS // 2)
        for k in (0, 1)
    ]
    chosen = halves[0].unionByName(halves[1])
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for toxic, text in zip(frame["toxic"], frame["text"]):
                pairs = swaps((text or "").lower())
                lost = [f for pair in pairs for f in (*pair[0], -1)]
                gained = [f for pair in pairs for f in (*pair[1], -1)]
                out.append((toxic, sorted(text_features(text or "")), lost, gained))
            yield pd.DataFrame(out, columns=["toxic", "features", "lost", "gained"])

    schema = "toxic int, features array<int>, lost array<int>, gained array<int>"
    return written(rows.mapInPandas(run, schema).dropDuplicates(["toxic", "features"]), "labelled")


def chosen_features(rows: DataFrame, classes: dict[int, int]) -> np.ndarray:
    """The features that occur more often, by far, in label 1 than in label 0, and all swapped ones."""
    if not classes.get(1):
        return np.zeros(0, np.int64)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            toxic = np.repeat(frame["toxic"].to_numpy(), frame["features"].map(len))
            flat = np.concatenate([*frame["features"], np.zeros(0, np.int32)])
            ids, at = np.unique(flat, return_inverse=True)
            yield pd.DataFrame(
                {
                    "feature": ids.astype(np.int32),
                    "ones": np.bincount(at, toxic == 1, len(ids)).astype(np.int64),
                    "zeros": np.bincount(at, toxic == 0, len(ids)).astype(np.int64),
                }
            )

    counts = rows.select("toxic", "features").mapInPandas(run, "feature int, ones long, zeros long")
    totals = counts.groupBy("feature").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    rate = lambda c, k: (F.col(c) + 0.5) / (classes.get(k, 0) + 1)
    telling = totals.where("ones >= 3").withColumn("ratio", F.log(rate("ones", 1) / rate("zeros", 0)))
    telling = telling.where("ratio > 1").withColumn("weight", F.col("ratio") * F.sqrt("ones"))
    top = telling.orderBy(F.desc("weight"), "feature").limit(FEATURES).select("feature")
    swapped = rows.select(F.explode(F.concat("lost", "gained")).alias("feature")).where("feature >= 0")
    # the terms are a fixed list, so what their swaps touch is bounded too
    both = [r.feature for r in top.unionByName(swapped.distinct()).distinct().collect()]
    return np.array(sorted(both), np.int64)


def _matrix(lists: list[list[int]], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the features that the model knows."""
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    flat = np.array([f for x in lists for f in x], np.int64)
    at = np.searchsorted(features, flat)
    at[at == len(features)] = 0
    known = features[at] == flat if len(features) else np.zeros(len(flat), bool)
    return rows[known], at[known]


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Bias and weights by feature; without labelled rows of both kinds the bias alone decides."""
    ready(docs.sparkSession)
    given = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    whole = {int(r.k): r.n for r in given.groupBy((F.col("toxic") > 0).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = sample(docs, labels)
    classes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not classes.get(1) or not classes.get(0):
        return {"bias": 6.0 if classes.get(1) else -6.0, "weights": {}}
    features = chosen_features(rows, classes)
    known = set(features.tolist())

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(features=[[f for f in x if f in known] for x in frame["features"]])

    small = rows.mapInPandas(keep, rows.schema).toPandas()
    y = small["toxic"].to_numpy().astype(float)
    share = {k: whole[k] / classes[k] for k in (0, 1)}
    weight = np.where(y > 0, share[1], share[0])
    weight = weight / weight.sum()
    r, c = _matrix(list(small["features"]), features)
    pairs = []
    for lost, gained in zip(small["lost"], small["gained"]):
        pairs += zip(_split(lost), _split(gained))
    lr, lc = _matrix([p[0] for p in pairs], features)
    gr, gc = _matrix([p[1] for p in pairs], features)

    def grad(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        z = np.bincount(r, w[c], len(y)) + b
        e = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.bincount(c, e[r], len(w))
        if pairs:
            change = np.bincount(gr, w[gc], len(pairs)) - np.bincount(lr, w[lc], len(pairs))
            change *= 2 * SWAP_PENALTY / len(pairs)
            g = g + np.bincount(gc, change[gr], len(w)) - np.bincount(lc, change[lr], len(w))
        return g, e.sum()

    w, b = np.zeros(len(features)), 0.0
    m, v = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    for t in range(1, ROUNDS + 1):
        g, gb = grad(w, b)
        full = np.append(g, gb)
        m = 0.9 * m + 0.1 * full
        v = 0.99 * v + 0.01 * full**2
        rate = 0.2 / np.sqrt(t / 50 + 1)
        scale = rate / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        step = scale * m / (1 - 0.9**t)
        w, b = w - step[:-1], b - step[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - scale[:-1] * SPARSITY, 0)
    kept = np.abs(w) > 1e-3
    return {"bias": float(b), "weights": dict(zip(features[kept].tolist(), w[kept].tolist()))}


def _split(flat: list[int]) -> list[list[int]]:
    out: list[list[int]] = []
    part: list[int] = []
    for f in flat:
        if f == -1:
            out.append(part)
            part = []
        else:
            part.append(f)
    return out


def scorer(model: dict) -> Callable:
    """A column function from text to the score; the model is a few thousand numbers at most."""
    bias, weights = model["bias"], model["weights"]

    def run(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, tuple[int, ...]] = {}
        for column in columns:
            scores = []
            for text in column:
                found: set[int] = set()
                for word in set((text or "").lower().split()):
                    fs = cache.get(word)
                    if fs is None:
                        if len(cache) >= CACHED_WORDS:
                            cache.clear()
                        fs = cache[word] = tuple(f for f in word_features(word) if f in weights)
                    if fs:
                        found.update(fs)
                z = bias + sum(weights[f] for f in sorted(found))
                scores.append(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))
            yield pd.Series(scores, dtype="float64")

    run.__annotations__ = {"columns": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, score (0 to 1), predicted (1 from THRESHOLD on).

    Every row is scored by its text alone: null and empty texts get the bias, repeated rows and null
    ids stay. Words count once per text, so neither length nor repetition changes a score. Other
    columns are not read.
    """
    score = scorer(fit(docs, labels))
    return docs.select("doc_id", score("text").alias("score")).select(
        "doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns kept, whose score is below THRESHOLD."""
    score = scorer(fit(docs, labels))
    return docs.where(score("text") < THRESHOLD)
