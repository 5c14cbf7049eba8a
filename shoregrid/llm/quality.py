"""Quality rules: an isolation forest over rule statistics, its threshold calibrated on labelled rows.

The forest is TREES trees over PSI rows each, drawn by hash from the distinct texts of all rows, so
copies count once. Rows that random splits isolate early have short paths and a score near 1. The
threshold is the one that best parts the labelled rows when a lost sound document weighs
CLEAN_WEIGHT times a missed bad one; without labelled rows of both kinds it is DEFAULT_THRESHOLD.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoregrid.llm.common import ready, written

TREES = 200
PSI = 64
CLEAN_WEIGHT = 20.0
DEFAULT_THRESHOLD = 0.5
SEED = 7
MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW_WORDS = 5
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_LONG = re.compile(rb"[^\W\d_]{2}").search

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
LIMITS = {"symbols": 0.1, "dup_lines": 0.34, "repeats": 0.2, "shouted": 0.3, "marks": 0.3, "stutter": 0.1}
"""Shares (of words or lines) that sound text reaches too; a statistic is what lies beyond its limit."""
FEATURES = list(LIMITS)


def repeated_words(ids: np.ndarray, window: int = WINDOW_WORDS) -> int:
    """Words that lie in a window found twice or more in the text; ids number the distinct words."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    key = ids[:n].astype(np.int64)
    top = int(key.max()) + 1
    width = int(ids.max()) + 1
    for k in range(1, window):
        if top * width > 2**62:  # renumber what is left, so that keys stay exact
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            top = int(key.max()) + 1
        key = key * width + ids[k : n + k]
        top *= width
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    if not twice.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = np.nonzero(twice)[0]
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics(text: str) -> tuple[float, ...]:
    """COUNTS, then FEATURES."""
    data = text.encode()
    words = data.split()
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in _SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    dup = len(lines) - len(set(lines))
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    repeat = repeated_words(ids) if n else 0
    per = max(n, 1)
    shouted = sum(map(bytes.isupper, filter(_LONG, words)))
    marks = text.count("!") + text.count("?")
    stutter = int(np.count_nonzero(ids[1:] == ids[:-1]))
    return (
        *(n, chars, symbols, dup, repeat),
        *(
            max(0.0, min(share, most) - LIMITS[name])
            for name, share, most in (
                ("symbols", symbols / per, 2.0),
                ("dup_lines", dup / max(len(lines), 1), 1.0),
                ("repeats", repeat / per, 1.0),
                ("shouted", shouted / per, 1.0),
                ("marks", marks / per, 2.0),
                ("stutter", stutter / per, 1.0),
            )
        ),
    )


def _columns(texts: pd.Series) -> pd.DataFrame:
    rows = [statistics(t or "") for t in texts]
    frame = pd.DataFrame(rows, columns=[*COUNTS, *FEATURES])
    return frame.astype({c: "int64" for c in COUNTS} | {c: "float64" for c in FEATURES})


_SCHEMA = ", ".join([f"{c} long" for c in COUNTS] + [f"{c} double" for c in FEATURES])


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, s, copy): the statistics and a hash of every text, written once to the shared folder."""
    ready(docs.sparkSession)

    def run(texts: pd.Series) -> pd.DataFrame:
        return _columns(texts)

    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    s = F.pandas_udf(run, _SCHEMA)("text").alias("s")
    return written(docs.select("doc_id", s, F.xxhash64("text").alias("copy")), "statistics")


def grow(points: np.ndarray, seed: int = SEED) -> dict:
    """The forest as flat arrays: per node the feature (-1: leaf), the split, the left child, the path length."""
    rng = np.random.default_rng(seed)
    depth = int(np.ceil(np.log2(max(PSI, 2))))
    feature, split, left, length, roots = [], [], [], [], []

    def average(n: int) -> float:
        return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    for tree in range(TREES):
        if len(points) >= TREES * PSI:  # every tree has rows of its own
            rows = points[tree::TREES][:PSI]
        else:
            rows = points[rng.permutation(len(points))[:PSI]]
        roots.append(len(feature))
        queue = [(rows, 0, len(feature))]
        feature.append(-1), split.append(0.0), left.append(-1), length.append(0.0)
        while queue:
            part, level, at = queue.pop()
            spread = np.nonzero(part.max(0) > part.min(0))[0] if len(part) > 1 else []
            if level >= depth or not len(spread):
                length[at] = level + average(len(part))
                continue
            f = int(rng.choice(spread))
            lo, hi = part[:, f].min(), part[:, f].max()
            cut = rng.uniform(lo, hi)
            below = part[:, f] < cut
            if not below.any():
                cut = np.nextafter(lo, hi)
                below = part[:, f] < cut
            feature[at], split[at], left[at] = f, float(cut), len(feature)
            for child in (part[below], part[~below]):
                queue.append((child, level + 1, len(feature)))
                feature.append(-1), split.append(0.0), left.append(-1), length.append(0.0)
    used = min(PSI, len(points))
    return {
        "feature": np.array(feature, np.int16),
        "split": np.array(split),
        "left": np.array(left, np.int32),
        "length": np.array(length),
        "roots": np.array(roots, np.int64),
        "average": average(used) or 1.0,
    }


def scores(forest: dict, x: np.ndarray) -> np.ndarray:
    """Anomaly score 2^(-mean path / expected path) of every row."""
    x, back = np.unique(x, axis=0, return_inverse=True)  # most rows share their statistics
    at = np.repeat(forest["roots"][None, :], len(x), axis=0)
    rows = np.arange(len(x))[:, None]
    while True:
        f = forest["feature"][at]
        inner = f >= 0
        if not inner.any():
            break
        step = forest["left"][at] + (x[rows, np.maximum(f, 0)] >= forest["split"][at])
        at = np.where(inner, step, at)
    return (2.0 ** (-forest["length"][at].mean(axis=1) / forest["average"]))[back.reshape(-1)]


def fit(stats: DataFrame, labels: DataFrame) -> dict:
    """Forest and threshold; `stats` as from `measured`."""
    points = stats.where("s.n_words > 0").select(*[f"s.{c}" for c in FEATURES], F.col("copy").alias("_h"))
    need = TREES * PSI
    held = points.agg(F.approx_count_distinct("_h")).first()[0]
    share = min(1.0, 1.5 * need / max(held, 1))
    bound = int(min(share * 2**64 - 2**63, 2**63 - 1))
    drawn = points.where(F.col("_h") <= bound).dropDuplicates(["_h"]).orderBy("_h").limit(need)
    cloud = drawn.select(*FEATURES).toPandas().to_numpy(dtype=float)
    if not len(cloud):
        return {"forest": None, "threshold": 1.0}
    forest = grow(cloud[np.random.default_rng(SEED).permutation(len(cloud))])
    given = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    given = given.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = stats.where("s.n_words > 0").join(given, "doc_id")
    level = F.floor(scorer(forest)("s") * 1000).cast("int").alias("level")
    good = (F.col("quality") > 0).cast("int").alias("good")
    table = known.select(level, good).groupBy("level", "good").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros((2, 1002))
    for row in table:
        counts[row.good, row.level] += row.n
    if not counts[0].sum() or not counts[1].sum():
        return {"forest": forest, "threshold": DEFAULT_THRESHOLD}
    rates = counts / counts.sum(axis=1, keepdims=True)
    kept_bad, kept_good = np.cumsum(rates, axis=1)  # below and at each level
    cost = kept_bad + CLEAN_WEIGHT * (1 - kept_good)
    best = np.nonzero(cost <= cost.min() + 1e-9)[0]
    return {"forest": forest, "threshold": float(best[len(best) // 2] + 1) / 1000}


def scorer(forest: dict) -> Callable:
    """A column function from the statistics to the anomaly score; the forest has a fixed size."""

    def run(frame: pd.DataFrame) -> pd.Series:
        return pd.Series(scores(forest, frame[FEATURES].to_numpy(dtype=float)))

    run.__annotations__ = {"frame": pd.DataFrame, "return": pd.Series}
    return F.pandas_udf(run, "double")


def base_failed(prefix: str = "") -> Column:
    n, repeat = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeat > REPEAT_PERCENT * n)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, anomaly (the score), kept.

    A document is kept if it passes the base rules and its score is below the threshold. Null texts
    count as without words and fail. Repeated rows and null ids stay, each judged by its text.
    """
    stats = measured(docs)
    model = fit(stats, labels)
    found = stats.select(
        "doc_id",
        *[f"s.{c}" for c in COUNTS],
        base_failed("s.").alias("base_failed"),
        (scorer(model["forest"])("s") if model["forest"] else F.lit(0.0)).alias("anomaly"),
    )
    kept = ~F.col("base_failed") & (F.col("anomaly") < model["threshold"])
    return found.withColumn("kept", kept)


def sound(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns kept, that the rules keep."""
    model = fit(measured(docs), labels)

    def run(texts: pd.Series) -> pd.Series:
        s = _columns(texts)
        ok = (s["n_words"] >= MIN_WORDS) & (100 * s["n_repeat_words"] <= REPEAT_PERCENT * s["n_words"])
        if model["forest"] is not None and len(s):
            ok &= scores(model["forest"], s[FEATURES].to_numpy(dtype=float)) < model["threshold"]
        return ok

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return docs.where(F.pandas_udf(run, "boolean")("text"))
