"""Language-model scores of whole texts, learnt from a part of the corpus.

Tokens are lower-cased words and one end per text. A token is a known word or is spelt by the bit predictors of `mixing`;
the share of tokens that training met once (what a new text brings in unseen words) weighs the two. Which known word
it is depends on the words before it: predictors in contexts of up to two words before decide
the bits of its code, counts in training the word among those of this code. Several experts add to this
what the text itself has said so far, each with its own share; they are weighed anew at every token
by how well they did before, which comes to one sum over experts at the end. Bits per byte follow.

The vocabulary is never in one place. Texts are dealt into blocks of about BLOCK_BYTES; each block asks
for its distinct words only, words are counted, scored and sent back to the blocks that asked. What
is sent to all tasks is the predictors' tables, at most 6 x 2^MAX_BITS pairs of counts for spelling and 3 x 2^MAX_BITS for
what follows; a task that counts sends one table of either kind on, so texts are read for it in one task per TABLE_BYTES.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoregrid.llm import mixing
from shoregrid.llm.common import ready, release, words, written

BLOCK_BYTES = 24 << 20
MIN_BITS = 14
MAX_BITS = 20
TABLE_WORDS = 400_000
"""Words that one set of tables is counted from; a task sends its tables on, so they should not be few."""
TABLE_BYTES = 64 << 20
"""Text that one set of tables of what follows is counted from."""
TASK_WORDS = 50_000
WORD_BATCH = 10_000
"""Rows of an Arrow batch of words; batches of texts are smaller."""
FLUSH_WORDS = 500_000
HASHED_BYTES = 1 << 16
"""Bytes of the texts that are hashed together, or one longer text."""
SCORED_TOKENS = 1 << 14
"""Tokens of the texts that are priced together, or one longer text."""
CHUNK_SLOTS = 1 << 14
CHUNK_ROWS = 16
"""Chunks of one Arrow batch: 2 MB."""
END = b""
LN10 = float(np.log(10))
SHARES = ((0.0, 0.7), (0.1, 0.1), (0.4, 0.1), (0.8, 0.1))
"""Experts: the share that the words of the text so far have in the prediction, and the expert's prior weight."""


def asked_words(blocks: DataFrame) -> DataFrame:
    """(block, word, train): the distinct words of every block and how often training texts have them.

    The end of a text is the empty word. A word can come more than once for a block.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pd.DataFrame]:
            for block, (train, rest) in held.items():
                asked = [*train, *(w for w in rest if w not in train)]
                yield pd.DataFrame({"block": block, "word": asked, "train": [train[w] for w in asked]})
            held.clear()

        for frame in frames:
            for block, learnt, text in zip(frame["block"], frame["learnt"], frame["text"]):
                train, rest = held.setdefault(block, (Counter(), Counter()))
                found = words(text or "")
                (train if learnt else rest).update(found)
                (train if learnt else rest)[END] += 1
            if sum(len(a) + len(b) for a, b in held.values()) > FLUSH_WORDS:
                yield from flush()
        yield from flush()

    return written(blocks.mapInPandas(run, "block int, word binary, train long"), "asked")


def log_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """As np.logaddexp, in fewer seconds; b is finite."""
    return np.maximum(a, b) + np.log(1 + np.exp(-np.abs(a - b)))


def text_score(at: np.ndarray, price: np.ndarray) -> float:
    """log10 probability of a text: `at` numbers its tokens, `price` has their log10 in the corpus."""
    order = np.argsort(at, kind="stable")
    runs = np.r_[0, np.nonzero(np.diff(at[order]))[0] + 1]
    met = np.empty(len(at))
    met[order] = np.arange(len(at)) - np.repeat(runs, np.diff(np.r_[runs, len(at)]))
    so_far = met / np.maximum(np.arange(len(at)), 1)
    plain = np.exp(price * LN10)
    sums = []
    for share, prior in SHARES:
        mixed = (1 - share) * plain + share * so_far
        mixed[0] = plain[0]
        sums.append(np.log(np.maximum(mixed, 1e-300)).sum() / LN10 if share else price.sum())
        sums[-1] += np.log10(prior)
    best = max(sums)
    return float(best + np.log10(sum(10.0 ** (s - best) for s in sums)))


def _summed(parts: Iterator[np.ndarray]) -> Iterator[pd.DataFrame]:
    for total in parts:
        flat = total.reshape(-1, 2 * min(CHUNK_SLOTS, total.shape[1]))
        for at in range(0, len(flat), CHUNK_ROWS):
            part = [(at + k, x.astype(np.float32).tobytes()) for k, x in enumerate(flat[at : at + CHUNK_ROWS]) if x.any()]
            yield pd.DataFrame(part, columns=["chunk", "data"]).astype({"chunk": np.int32})


def _tables(parts: DataFrame, orders: int, bits: int) -> np.ndarray:
    """Counts (orders, slots, 2): the sum of all tasks' tables, given as (chunk, data), chunk by chunk."""

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, np.float32) for x in frame["data"]], axis=0, dtype=np.float64)
        return pd.DataFrame({"chunk": [key[0]], "data": [total.astype(np.float32).tobytes()]})

    schema = "chunk int, data binary"
    halves = parts.withColumn("k", F.pmod(F.spark_partition_id(), F.lit(64)))
    parts = halves.groupBy("chunk", "k").applyInPandas(add, schema).groupBy("chunk").applyInPandas(add, schema)
    table = np.zeros((orders << bits, 2), np.float32)
    wide = min(CHUNK_SLOTS, 1 << bits)
    for row in parts.toLocalIterator():
        table[row.chunk * wide : (row.chunk + 1) * wide] = np.frombuffer(row.data, np.float32).reshape(-1, 2)
    return table.reshape(orders, 1 << bits, 2)


def fit_tables(vocab: DataFrame, bits: int) -> np.ndarray:
    """The spelling predictors' counts over all training words: dense parts per task, added up chunk by chunk."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            total = mixing.counts(list(frame["word"]), bits, total)
        yield from _summed(iter(() if total is None else (total,)))

    return _tables(vocab.mapInPandas(run, "chunk int, data binary"), len(mixing.ORDERS), bits)


def _hashed(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For a few texts at a time: the hashes of all tokens, and how many tokens each text has."""
    for frame in frames:
        held, size = [], 0
        for text in frame["text"]:
            held.append((text or "").encode().lower())
            size += len(held[-1])
            if size >= HASHED_BYTES:
                yield mixing.token_hashes(held)
                held, size = [], 0
        if held:
            yield mixing.token_hashes(held)


def fit_following(texts: DataFrame, size: int, bits: int) -> dict:
    """Log odds, mixing weights and refinement of what follows the words before, learnt from every token of the texts.

    Counted in one task for each TABLE_BYTES of the `size` bytes; weights go on through all texts of a task.
    """
    orders = len(mixing.FOLLOWED)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for hashes, sizes in _hashed(frames):
            total = mixing.following_counts(hashes, sizes, bits, total)
        yield from _summed(iter(() if total is None else (total,)))

    # without a shuffle: the texts are as long as the input
    few = texts.coalesce(max(1, -(-size // TABLE_BYTES)))
    table = _tables(few.mapInPandas(count, "chunk int, data binary"), orders, bits)
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odds, state = None, mixing.new_state(orders)
        for hashes, sizes in _hashed(frames):
            odds = odds or mixing.Odds(shared.value, True, mixing.FOLLOWED_GATED)
            mixing.learn_following(hashes, sizes, odds, state)
        if odds:
            yield pd.DataFrame({"weights": [state[0].ravel()], "used": [state[1]], "followed": [state[2].ravel()]})

    weights, refine = _averaged(texts.mapInPandas(learn, LEARNT), orders)
    shared.destroy()
    odds = mixing.Odds(table, False, mixing.FOLLOWED_GATED)
    odds.odds = odds.odds.astype(np.float16)
    return {"odds": texts.sparkSession.sparkContext.broadcast(odds), "weights": weights, "refine": refine}


def trained_codes(vocab: DataFrame) -> np.ndarray:
    """How many training tokens have each code."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << mixing.CODE_BITS)
        for frame in frames:
            total += np.bincount(mixing.codes(mixing.word_hashes(list(frame["word"]))), frame["train"], len(total))
        yield pd.DataFrame({"code": np.arange(len(total), dtype=np.int32), "n": total.astype(np.int64)})

    found = np.zeros(1 << mixing.CODE_BITS)
    for row in vocab.select("word", "train").mapInPandas(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        found[row.code] = row.n
    return found


LEARNT = "weights array<double>, used array<double>, followed array<double>"


def _averaged(parts: DataFrame, orders: int) -> tuple[np.ndarray, np.ndarray]:
    """Mixing weights, averaged by use over what tasks have learnt, and the refinement."""
    start, used, followed = mixing.new_state(orders)
    top = np.zeros_like(start)
    for row in parts.collect():
        part = np.array(row.used)
        top += np.array(row.weights).reshape(start.shape) * part
        used += part
        followed += np.array(row.followed).reshape(followed.shape)
    return np.where(used > 0, top / np.maximum(used, 1), start), mixing.refinement(followed)


def _spread(vocab: DataFrame, n_words: int) -> DataFrame:
    return vocab.repartition(max(1, -(-n_words // TASK_WORDS)), "word")


def fit(vocab: DataFrame, n_words: int, bits: int) -> dict:
    """The spelling's tables, mixing weights and refinement, learnt from all training words."""
    spark = vocab.sparkSession
    learnt = vocab.where("train > 0")
    # dealt without a key: every task sends whole tables on, so there must be no more of them than the words are worth
    tables = fit_tables(learnt.repartition(max(1, -(-n_words // TABLE_WORDS))), bits)
    shared = spark.sparkContext.broadcast(tables)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odds = None
        for frame in frames:
            odds = odds or mixing.Odds(shared.value, True)
            found = mixing.learn(list(frame["word"]), odds)
            yield pd.DataFrame({"weights": [found[0].ravel()], "used": [found[1]], "followed": [found[2].ravel()]})

    weights, refine = _averaged(_spread(learnt, n_words).mapInPandas(run, LEARNT), len(mixing.ORDERS))
    return {"tables": shared, "weights": weights, "refine": refine}


def scored(docs: DataFrame, learnt: Column) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    `learnt` says which rows the model learns from. base_score is the sum of log10((c+1)/(N+V+1)) over the
    tokens. Null and empty texts are one end token. Without training rows every bit has
    probability one half. Repeated rows and null ids stay. Other columns are read by `learnt` only.
    """
    spark = ready(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int").alias("block")
    dealt = docs.select(block, "doc_id", F.coalesce(learnt, F.lit(False)).alias("learnt"), "text")
    asked = asked_words(dealt.select("block", "learnt", "text").repartition("block"))
    vocab = asked.groupBy("word").agg(F.sum("train").alias("train"))
    vocab = written(vocab, "vocabulary")
    release(spark)
    known, once, end = F.col("train") > 0, F.col("train") == 1, F.col("word") == F.lit(END)
    sums = vocab.agg(
        F.sum("train").alias("n"), F.count_if(known).alias("v"), F.count_if(once).alias("once"),
        F.max(F.when(end, F.col("train"))).alias("ends"), F.count(F.lit(1)).alias("words"),
    ).first()
    total, distinct = sums.n or 0, sums.v or 0
    bits = min(MAX_BITS, max(MIN_BITS, int(distinct).bit_length() + 3))
    of_code = trained_codes(vocab.where(known))
    after = fit_following(dealt.where("learnt").select("text"), size, min(MAX_BITS, max(MIN_BITS, int(total).bit_length() + 2)))
    release(spark)
    ready(spark, WORD_BATCH)
    model = fit(vocab, sums.words, bits)
    seen = 1 - sums.once / total if total else 0.0
    tables, weights, refine = model["tables"], model["weights"], model["refine"]

    def price(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odds = None
        for frame in frames:
            odds = odds or mixing.Odds(tables.value, False)
            spelt = mixing.log10_spelling(list(frame["word"]), odds, weights, refine)
            yield frame.assign(spelt=spelt + np.log10(1 - seen) if seen < 1 else spelt - 300)

    priced = _spread(vocab, sums.words).mapInPandas(price, "word binary, train long, spelt double")
    priced = written(priced, "priced")
    tables.destroy()
    release(spark)
    ready(spark)
    answers = asked.select("block", "word").join(priced, "word")

    def score(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        place = dict(zip(answers["word"], range(len(answers))))
        train = answers["train"].to_numpy()
        hashes = mixing.word_hashes(answers["word"].array)
        # of a known word: how much likelier than its code it is, which the words before it decide
        with np.errstate(divide="ignore"):
            among = np.log10(seen * train / np.maximum(of_code[mixing.codes(hashes)], 1)) * LN10
        spelt = answers["spelt"].to_numpy() * LN10
        rows, met = [], []

        def priced_texts() -> Iterator[tuple]:
            sizes = np.array([len(at) for _, at, _ in met])
            at = np.concatenate([x for _, x, _ in met])
            code = mixing.log10_following(hashes[at], sizes, after["odds"].value, after["weights"], after["refine"])
            price = log_sum(among[at] + code * LN10, spelt[at]) / LN10
            for (doc_id, at, byte_count), price_of in zip(met, np.split(price, np.cumsum(sizes)[:-1])):
                value = text_score(at, price_of)
                bits = -value / np.log10(2) / byte_count
                yield doc_id, len(at), int((train[at] > 0).sum()), total, np.log10((train[at] + 1) / (total + distinct + 1)).sum(), value, bits
            met.clear()

        tokens = 0
        for doc_id, text in zip(texts["doc_id"], texts["text"]):
            found = words(text or "")
            at = np.fromiter(map(place.__getitem__, [*found, END]), np.int64, len(found) + 1)
            met.append((doc_id, at, sum(map(len, found)) + len(found) + 1))
            tokens += len(at)
            if tokens >= SCORED_TOKENS:
                rows += priced_texts()
                tokens = 0
        if met:
            rows += priced_texts()
        del place
        pa.default_memory_pool().release_unused()  # a worker waits for its next task with what it has not given back
        out = pd.DataFrame(rows, columns=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])
        return out.astype({"doc_id": "Int64"})

    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    texts = dealt.select("block", "doc_id", "text")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(score, schema)
