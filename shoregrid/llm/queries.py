"""The operators as queries: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoregrid.llm import (
    bpe,
    chat_format,
    conversation_repair,
    filter_audit,
    html_text,
    licenses,
    lm_score,
    neighbours,
    packing,
    quality,
    simhash,
    token_files,
    toxicity,
)
from shoregrid.llm.common import id_remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@_register
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences whose lengths are powers of two."""
    found = packing.packed(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


@_register
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of every document and whether they keep it."""
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_register
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files and read back."""
    folder = token_files.folder(spark)
    manifest = token_files.write(table(spark, sf_dir, "documents"), WORD_TOKENIZER, folder)
    return token_files.read(manifest, folder).select(
        "doc_id",
        "start",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@_register
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labelled rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_remainder("doc_id", 3) == 1
    found = toxicity.scored(docs, labels.where(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@_register
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the byte-level ranks, and their decoding."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@_register
def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


@_register
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.groups(table(spark, sf_dir, "documents"))


@_register
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extracted(table(spark, sf_dir, "pages"))


@_register
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 7) == 2
    found = lm_score.scored(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), *found.columns[1:])


@_register
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every document."""
    return licenses.found(table(spark, sf_dir, "documents"))


@_register
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by the rule, with their faults and their cheapest repair."""
    conversations = table(spark, sf_dir, "conversations")
    rows, summary = conversation_repair.repaired(conversation_repair.damaged(conversations))
    named = lambda df, name: df.withColumnRenamed("conv_id", name)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    hashes = named(conversation_repair.hashed(rows), "hash_id")
    found = conversations.select("conv_id").distinct()
    found = found.join(named(summary, "id"), F.col("conv_id").eqNullSafe(F.col("id")), "left")
    found = found.join(hashes, F.col("conv_id").eqNullSafe(F.col("hash_id")), "left")
    return found.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


SQL["op11_conversation_repair"] = r"""
WITH RECURSIVE checksums AS (
    SELECT *, xor(list_reduce(
        list_concat([4294967295], list_transform(string_split(
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda sum, byte: list_reduce(list_concat([xor(sum, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, ignored: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS damage
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
        CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
    FROM checksums JOIN (VALUES (1), (2)) c(copy) ON copy = 1 OR damage = 3
    WHERE damage <> 0
), placed AS (
    SELECT *, row_number() OVER w AS pos, left(role, 1) AS initial, lag(left(role, 1)) OVER w AS earlier,
        right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
    FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
    SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM placed
), inserts(f, t, more, price) AS (
    VALUES ('', '', '', 0), ('', 'u', 'I', 5), ('', 'a', 'II', 10), ('s', 's', '', 0), ('s', 'u', 'I', 5), ('s', 'a', 'II', 10),
        ('u', 'u', '', 0), ('u', 'a', 'I', 5), ('a', 'a', '', 0), ('a', 'u', 'I', 5)
), moves(f, t) AS (
    VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')
), edits AS (
    SELECT f, t, 'K' AS edit, 0 AS price FROM moves UNION ALL SELECT f, t, 'R', 1 FROM moves WHERE t <> 's'
    UNION ALL SELECT DISTINCT f, f, 'D', 2 FROM inserts
), walk AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, '' AS state, {'cost': CAST(0 AS BIGINT), 'audit': ''} AS best FROM damaged
    UNION ALL
    SELECT w.conv_id, j.pos, e.t, min({'cost': CAST(w.best.cost + i.price + e.price
            + CASE WHEN e.edit <> 'D' AND j.fault = 'truncated' THEN 5 ELSE 0 END AS BIGINT), 'audit': w.best.audit || i.more || e.edit})
    FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.pos = w.pos + 1
        JOIN inserts i ON i.f = w.state JOIN edits e ON e.f = i.t
    WHERE e.edit = 'D' OR (j.fault NOT IN ('blank', 'duplicate') AND (e.edit = 'R' OR e.t = j.initial))
    GROUP BY w.conv_id, j.pos, e.t
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, max(pos) AS n,
        count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
), ended AS (
    SELECT c.*, min({'cost': w.best.cost + i.price, 'audit': w.best.audit || i.more}) AS best
    FROM counted c JOIN walk w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.pos = c.n JOIN inserts i ON i.f = w.state
    WHERE i.t IN ('', 'a') GROUP BY ALL
), letters AS (
    SELECT conv_id, best.audit AS audit, unnest(string_split(best.audit, '')) AS edit, unnest(range(1, length(best.audit) + 1)) AS i
    FROM ended
), steps AS (
    SELECT *, count(*) FILTER (edit <> 'I') OVER w AS pos, count(*) FILTER (edit <> 'D') OVER w + length(replace(audit, 'D', '')) AS place
    FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY i)
), lines AS (
    SELECT s.conv_id, i, CASE WHEN edit = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line
    FROM steps s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.pos = greatest(s.pos, 1)
    WHERE edit <> 'D'
), hashes AS (
    SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY i)) AS repaired_sha256 FROM lines GROUP BY conv_id
)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
    coalesce(best.audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
    LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
    LEFT JOIN hashes h ON h.conv_id IS NOT DISTINCT FROM a.conv_id
"""


@_register
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_format.read_back(chat_format.examples(rows))


SQL["op12_chat_format"] = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *,
        length(regexp_replace(text, '([<\[])(\\*)(/?s>|</?SYS>>|/?INST\]|/?ROLE\])', '\1\\\2\3', 'g'))
        + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17
          ELSE 21 + length(regexp_replace(role, '([<\[])(\\*)(/?s>|</?SYS>>|/?INST\]|/?ROLE\])', '\1\\\2\3', 'g'))
          END AS chars
    FROM said
), placed AS (
    SELECT *, sum(chars) OVER upto AS example_chars, lead(true) OVER w IS NULL AS is_last
    FROM sized
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text),
        upto AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(example_chars) FILTER (role = 'assistant' OR is_last) AS BIGINT) AS formatted_chars
FROM placed
GROUP BY conv_id
"""


@_register
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each filter removes from each source in every order of the five filters."""
    return filter_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op13_filter_audit"] = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), firsts AS (
    SELECT text, min(doc_id) AS least FROM docs GROUP BY text
), marks AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), masks AS (
    SELECT part,
        CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS failed,
        coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM docs JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)
), counts AS (
    SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM masks GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f), orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), fates AS (
    SELECT part, filter_order, step, n, good, toxic, failed,
        contains(failed, filter_order[step]) AS fails,
        len(list_filter(string_split(filter_order[1:step - 1], ''), lambda f: f <> '' AND contains(failed, f))) > 0 AS gone
    FROM counts, orders, (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS step) s
), summed AS (
    SELECT part, filter_order, step,
        CAST(coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS BIGINT) AS kept,
        CAST(coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS BIGINT) AS removed,
        CAST(coalesce(sum(n) FILTER (fails AND gone), 0) AS BIGINT) AS redundant,
        CAST(coalesce(sum(n) FILTER (failed = filter_order[step]), 0) AS BIGINT) AS unique_fails,
        CAST(coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS BIGINT) AS good_lost,
        CAST(coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS BIGINT) AS toxic_lost
    FROM fates GROUP BY ALL
)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley FROM summed
"""
