"""The dealt operators on the smallest tables and on edge cases, against plain versions of the same rules."""

import html
import io
import re
import textwrap
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shoregrid.llm import (
    bpe,
    html_text,
    licenses,
    lm_score,
    mixing,
    near_copies,
    neighbours,
    packing,
    quality,
    queries,
    simhash,
    token_files,
    tokens,
    toxicity,
)
from shoregrid.llm.common import Scratch
from shoregrid.llm.components import components

SF_DIR = "/root/testdata/sf0.001"
LONG = "Une très longue phrase, with words and 12 numbers. " * 3000
EDGES = [
    (1, "", "en"),
    (2, None, "en"),
    (3, " \n\t ", "de"),
    (4, "one", "fr"),
    (5, "the quick brown fox jumps over the lazy dog and runs away\nfar", None),
    (5, "the quick brown fox jumps over the lazy dog and runs away\nfar", None),
    (None, "the quick brown fox jumps over the lazy dog and runs away\nfar", "en"),
    (None, None, None),
    (7, LONG, "en"),
    (8, "a  double  space\r\n\nand\ttabs <|endoftext|> 's 中文 é", "en"),
    (9, "x" * 20_000, "en"),
]
EXTRA = ["row", "_fp", "_row", "key", "block", "s", "f", "found", "_h", "word", "lang"]


@pytest.fixture(scope="module")
def edge(spark):
    """Odd rows with further columns that are named like working columns."""
    rows = spark.createDataFrame(EDGES, "doc_id long, text string, lang string")
    return rows.select(*[F.col("lang").alias(c) for c in EXTRA[:5]], "doc_id", "text", *[F.col("lang").alias(c) for c in EXTRA[5:]])


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (4, 0, 1), (5, 1, 0), (7, 1, 0), (None, 1, 1), (9, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def read(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pydict()


@pytest.fixture(scope="module")
def documents():
    d = read("documents")
    return dict(zip(d["doc_id"], d["text"]))


def remainder(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


def ids_of(path, texts):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [np.array([*e.ids, 1], "<u4") for e in t.encode_batch(texts, add_special_tokens=False)]


# packing


@pytest.mark.parametrize("n", [0, 1, 2, 5, 2047, 2048, 2049, 6151])
def test_pieces_cover_and_are_powers_of_two(n):
    found = packing.pieces(n)
    assert sum(length for _, length in found) == n
    assert all(length & (length - 1) == 0 and length <= 2048 for _, length in found)
    assert [s for s, _ in found] == [sum(x for _, x in found[:k]) for k in range(len(found))]


def test_packing_holds_every_id_once(spark, documents):
    rows = queries.op1_packing(spark, SF_DIR).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    want = dict(zip(documents, ids_of(queries.BYTE_TOKENIZER, list(documents.values()))))
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == want.keys()
    for doc_id, ids in want.items():
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.offset, r.doc_tokens) == (at, 0, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_packing_edges(spark, edge):
    rows = packing.packed(edge, queries.BYTE_TOKENIZER).collect()
    whole = sum(len(x) for x in ids_of(queries.BYTE_TOKENIZER, [t or "" for _, t, _ in EDGES]))
    assert sum(r.length for r in rows) == whole
    assert packing.packed(edge.limit(0), queries.BYTE_TOKENIZER).count() == 0


# tokens and BPE

ODD = ["a", "b ", "  ", "\n", " \n", "\n\n", "\t", "\xa0", "\x1c", "é", "!", "?!", "'s", "12", "\r\n", " ", "中", "Σ ", ", ", "."]


@pytest.fixture(scope="module")
def odd_texts():
    rng = np.random.default_rng(3)
    return ["".join(rng.choice(ODD, rng.integers(0, 9))) for _ in range(3000)]


@pytest.mark.parametrize("path,drops", [(queries.BYTE_TOKENIZER, False), (queries.WORD_TOKENIZER, True)])
def test_cut_encoder_equals_whole(odd_texts, path, drops):
    got = tokens.encoder(path, drops).encode(odd_texts)
    assert got == [x[:-1].tobytes() for x in ids_of(path, odd_texts)]


@pytest.mark.parametrize("joined", [1, 3, 100])
def test_pieces_are_joined_before_they_are_tokenized(odd_texts, monkeypatch, joined):
    monkeypatch.setattr(tokens, "JOINED_PIECES", joined)
    tokens.encoder.cache_clear()
    texts = [*odd_texts, "~", "a~b ~ c", "~~~ x", "e\u0301 \u0301 ~\u0303", "Don't stop. It's 12 <|endoftext|>", "x" * 5000]
    got = tokens.encoder(queries.WORD_TOKENIZER, True).encode(texts)
    tokens.encoder.cache_clear()
    assert got == [x[:-1].tobytes() for x in ids_of(queries.WORD_TOKENIZER, texts)]


def reference_bpe():
    ranks = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_library(odd_texts):
    vocab, encode = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    own = reference_bpe()
    texts = [*odd_texts, "ab" * 3000, "word" * 200, *map(chr, range(0x20, 0x3000))]
    for text, ids in zip(texts, encode.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text)
        assert vocab.decode(ids) == text.encode()


def test_bpe_query_and_edges(spark, documents, edge):
    own = reference_bpe()
    rows = {r.doc_id: r for r in queries.op5_bpe(spark, SF_DIR).collect()}
    assert rows.keys() == documents.keys()
    import hashlib

    for doc_id, text in documents.items():
        ids = own.encode_ordinary(text)
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        assert (rows[doc_id].n_tokens, rows[doc_id].ids_sha256, rows[doc_id].decoded_sha256) == want
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = bpe.encoded(edge, path, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in found) == sorted((t or "").encode() for _, t, _ in EDGES)
    assert bpe.digests(edge.limit(0), path, public_tokenizers.PATTERN).count() == 0


# token files


def test_token_files_query(spark, documents):
    rows = sorted(queries.op3_token_files(spark, SF_DIR).collect(), key=lambda r: r.doc_id)
    order = sorted(documents)
    at = 0
    for r, doc_id, ids in zip(rows, order, ids_of(queries.WORD_TOKENIZER, [documents[i] for i in order]), strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_files_edges(spark, edge):
    folder = token_files.folder(spark)
    found = token_files.read(token_files.write(edge, queries.WORD_TOKENIZER, folder), folder).collect()
    want = Counter(
        (i, x.tobytes()) for (i, _, _), x in zip(EDGES, ids_of(queries.WORD_TOKENIZER, [t or "" for _, t, _ in EDGES]))
    )
    assert Counter((r.doc_id, bytes(r.ids)) for r in found) == want
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((i for i, _, _ in EDGES), key=lambda i: (i is not None, i or 0))
    folder = token_files.folder(spark)
    assert token_files.read(token_files.write(edge.limit(0), queries.WORD_TOKENIZER, folder), folder).count() == 0


class _Kept(io.BytesIO):
    def close(self):
        pass


def test_reader_loads_asked_frames_and_checks_them(monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_BYTES", 100)
    out = _Kept()
    writer = token_files.Writer(out)
    docs = {None: 3, 1: 0, 2: 70, 5: 200_000, 9: 10}
    for doc_id, n in docs.items():
        writer.add(doc_id, np.arange(n, dtype="u4"))
    writer.close()
    reader = token_files.Reader(io.BytesIO(out.getvalue()))
    assert len(reader.entries) == 3
    loaded = []
    frame = reader.frame
    reader.frame = lambda k: (loaded.append(k), frame(k))[1]
    assert [len(x) for x in reader.find(5)] == [200_000] and loaded == [1]
    assert reader.find(4) == [] and reader.find(9)[0].tolist() == list(range(10))
    import zstandard

    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    broken = bytearray(out.getvalue())
    reader = token_files.Reader(io.BytesIO(bytes(broken)))
    reader.entries = reader.entries.copy()
    reader.entries["check"][0] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        reader.frame(0)


# SimHash


def plain_fingerprint(text):
    w = text.encode().lower().split()
    parts = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps):
    """Smallest id reachable over links of at most two bits."""
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    items = list(fps.items())
    for k, (i, a) in enumerate(items):
        for j, b in items[:k]:
            if bin(a ^ b).count("1") <= 2:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in fps}


def test_simhash_query(spark, documents):
    rows = {r.doc_id: r for r in queries.op7_simhash(spark, SF_DIR).collect()}
    fps = {i: plain_fingerprint(t) for i, t in documents.items()}
    want = plain_groups(fps)
    assert {i: r.component_id for i, r in rows.items()} == want
    assert all(rows[i].fingerprint == f"{fps[i]:016x}" for i in fps)


def test_byte_distances_tell_all_bytes_apart():
    refs = simhash.references()
    for k in range(8):
        seen = {tuple(bin((b ^ (r >> (8 * k))) & 255).count("1") for r in refs) for b in range(256)}
        assert len(seen) == 256


def test_links_are_complete(spark):
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 2**63, 20)]
    fps = {0, 2**64 - 1}
    for x in base:
        fps.add(x)
        for _ in range(30):
            y = x
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                y ^= 1 << int(b)
            fps.add(y)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    found = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(f,) for f in [*signed, *signed[:9]]], "fp long")).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2}
    assert found == want


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, i) for i in range(900, 1000)]
    links = spark.createDataFrame([*chain, *star, (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 900 for i in range(900, 1001)}}
    assert components(links.limit(0)).count() == 0


def test_simhash_edges(spark, edge):
    rows = simhash.groups(edge).collect()
    assert len(rows) == len(EDGES)
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}
    assert {r.component_id for r in rows if r.doc_id == 5} == {5}
    kept = simhash.representatives(edge)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted({r.component_id for r in rows})
    assert simhash.groups(edge.limit(0)).count() == 0 and simhash.representatives(edge.limit(0)).count() == 0
    only_null = edge.where("doc_id IS NULL AND text IS NOT NULL")
    assert [r.component_id for r in simhash.groups(only_null).collect()] == [None]


# quality


def plain_statistics(text):
    w = [x for x in re.split(r"[ \t-\r]+", text) if x]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    inside = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^ \t-\r]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_quality_query(spark, documents):
    rows = {r.doc_id: r for r in queries.op2_quality(spark, SF_DIR).collect()}
    assert rows.keys() == documents.keys()
    for doc_id, text in documents.items():
        r, want = rows[doc_id], plain_statistics(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    truth = read("labels")
    known = [(q, rows[i]) for i, q in zip(truth["doc_id"], truth["quality"]) if i in rows and not rows[i].base_failed]
    assert np.mean([r.kept for q, r in known if q]) > 0.98
    assert np.mean([r.kept for q, r in known if not q]) < 0.3


def test_forest_isolates_the_odd_rows():
    rng = np.random.default_rng(1)
    cloud = np.vstack([rng.normal(0, 0.05, (3000, 6)), rng.normal(2, 0.5, (100, 6))])
    forest = quality.grow(cloud[rng.permutation(len(cloud))])
    s = quality.scores(forest, cloud)
    assert s[3000:].min() > np.quantile(s[:3000], 0.99)


def test_repeated_words_in_large_vocabularies_stay_exact():
    ids = np.arange(100_000)
    ids[50_000:50_007] = ids[10:17]
    assert quality.repeated_words(ids) == 14


def test_quality_edges(spark, edge, labels):
    rows = quality.judged(edge, labels).collect()
    assert len(rows) == len(EDGES)
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 10)
    kept = quality.sound(edge, labels)
    assert kept.columns == edge.columns
    assert kept.count() == sum(r.kept for r in rows)
    assert quality.judged(edge.limit(0), labels).count() == 0 and quality.sound(edge.limit(0), labels).count() == 0
    assert quality.judged(edge, labels.limit(0)).count() == len(EDGES)


# toxicity


def test_toxicity_query(spark, documents):
    rows = {r.doc_id: r for r in queries.op4_toxicity(spark, "/root/testdata/sf0.1").collect()}
    d = pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pydict()
    held = [(t, rows[i]) for i, t in zip(d["doc_id"], d["toxic"]) if remainder(i, 3) == 1]
    assert all(r.held_out == (remainder(i, 3) == 1) and 0 <= r.score <= 1 for i, r in rows.items())
    assert np.mean([r.predicted for t, r in held if t]) > 0.75
    assert np.mean([r.predicted for t, r in held if not t]) < 0.01


def test_mentions_of_groups_are_not_toxic(spark):
    """Labels that follow insults, with one group mentioned in toxic rows most of the time."""
    rng = np.random.default_rng(2)
    filler = [f"word{k}" for k in range(300)]
    docs, marks = [], []
    for i in range(1200):
        toxic = i % 4 == 0
        group = "muslim" if rng.random() < (0.9 if toxic else 0.05) else "christian"
        text = " ".join([*rng.choice(filler, 12), f"the {group} neighbour", "moron" if toxic else "friend", "."])
        docs.append((i, text))
        marks.append((i, 1, int(toxic)))
    for k, group in enumerate(["muslim", "christian", "jewish"]):
        docs.append((5000 + k, f"the {group} neighbour came to lunch"))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.scored(frame, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()}
    neutral = [got[5000 + k].score for k in range(3)]
    assert max(neutral) < 0.3 and max(neutral) - min(neutral) < 0.1
    assert np.mean([got[i].predicted == t for i, _, t in marks]) > 0.99


def test_toxicity_edges(spark, edge, labels):
    rows = toxicity.scored(edge, labels).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.without_toxic(edge, labels)
    assert kept.columns == edge.columns and kept.count() == sum(not r.predicted for r in rows)
    assert toxicity.scored(edge.limit(0), labels).count() == 0
    assert all(not r.predicted for r in toxicity.scored(edge, labels.limit(0)).collect())


def joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return set(re.findall(r"BroadcastHashJoin|SortMergeJoin", plan))


def test_tables_that_grow_after_they_are_sized_are_not_broadcast(spark):
    fingerprints = spark.range(3_000).select(F.xxhash64("id").alias("fp"))
    assert joins(simhash.links(fingerprints)) == {"SortMergeJoin"}
    texts = [" ".join(f"w{j}" if j % 30 else f"u{i}.{j}" for j in range(60)) for i in range(40)]
    marked = near_copies.marked_rows(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    left = near_copies.parted(near_copies.shared_entries(marked), None)
    assert joins(near_copies.met(left)) == joins(near_copies.star_pairs(left)) == {"SortMergeJoin"}


# neighbours


def test_neighbours_query(spark):
    d = read("embeddings")
    v, ids = np.array(d["embedding"], np.float64), np.array(d["vec_id"])
    rows = queries.op6_neighbours(spark, SF_DIR).collect()
    hits = total = 0
    for k in np.nonzero(ids % 20 == 0)[0]:
        score = v @ v[k]
        score[k] = -np.inf
        want = ids[np.lexsort((ids, -score))[:20]]
        got = sorted((r for r in rows if r.query_id == ids[k]), key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(1, 21))
        hits += len({r.vec_id for r in got} & set(want))
        total += 20
    assert hits / total >= 0.98


def test_neighbours_edges(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (3, None, 1), (4, [], 1), (5, [0.0, 0.0], 1)]
    rows += [(6, [1.0, None], 1), (7, [float("nan"), 1.0], 1), (None, [1.0, 1.0], 1), (20, [3.0, 1.0, 2.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v int")
    got = neighbours.nearest(frame, F.pmod("vec_id", F.lit(20)) == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(0, 1, 1, 5.0), (0, 2, 2, 5.0)]
    assert neighbours.nearest(frame.limit(0), F.col("vec_id") == 0).count() == 0


def test_blocks_of_vectors_are_merged(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 60)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 7)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(400, 70)) * rng.uniform(0.5, 2, (400, 1)) + 0.3
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame, F.pmod("vec_id", F.lit(20)) == 0).collect()
    hits = 0
    for q in range(0, 400, 20):
        score = v @ v[q]
        score[q] = -np.inf
        hits += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(-score)[:20].tolist()))
    assert hits >= 0.98 * 400


def test_rows_of_packed_vectors_are_bounded_by_bytes(spark, monkeypatch):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(6_000, 64))
    frame = spark.createDataFrame([(i % 5_990, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    seen, path_of = [], neighbours.work_path
    monkeypatch.setattr(neighbours, "work_path", lambda s, name: seen.append((name, path := path_of(s, name))) or path)
    got = neighbours.nearest(frame.coalesce(1), F.pmod("vec_id", F.lit(300)) == 7).collect()
    for name, most in (("vectors", neighbours.BLOCK_BYTES), ("queries", 2 * neighbours.QUERY_BYTES)):
        found = spark.read.parquet(dict(seen)[name])
        assert found.select(F.max(F.length("v"))).first()[0] <= most
    assert spark.read.parquet(dict(seen)["vectors"]).select(F.sum(F.length("ids") / 8)).first()[0] == 6_000
    ids = np.arange(6_000) % 5_990
    for q in range(307, 5_990, 300):
        score = np.where(ids == q, -np.inf, v @ v[q])
        want = [(int(ids[i]), round(float(score[i]), 9)) for i in np.lexsort((ids, -score))[:20]]
        assert [(r.vec_id, round(r.score, 9)) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == want


# HTML


def test_html_query(spark):
    d = read("pages")
    got = {r.page_id: r for r in queries.op8_html_text(spark, SF_DIR).collect()}
    for page_id, source in zip(d["page_id"], d["html"]):
        article = re.search("<article>(.*?)</article>", source, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert got[page_id].text == "\n".join(filter(None, blocks))
        assert got[page_id].n_chars == len(got[page_id].text)


PAGE = """<html><head><title>no</title><script>if (a < b) "</p>"</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div><div class="wrap"><main>
<div class="post-{0} content"><h2>Title</h2><p>One &lt;two&gt; three,   four<p>Second <a href="x">link</a>.
<ul><li>item a<li>item b</ul><div class="ad-box">Buy</div><form><label>Mail</label></form>
<table><tr><td>c1<td>c2</table><!-- <p>gone --></div></main><aside>side</aside>
<div class="comments"><p>A reader's long, long, long comment, longer than the article and all of its blocks, says this.</p>
</div></div><footer>foot</footer></body></html>"""


def test_html_page_parts():
    text = html_text.Page(PAGE.format(1)).text([])
    assert text == "Title\nOne <two> three, four\nSecond link.\nitem a\nitem b\nc1\nc2"


def test_host_decides_over_a_page(spark):
    """A page whose own best container is a teaser list follows the path that won at its host."""
    page = '<body><div class="story"><p>{0}</p></div><div class="teasers"><p>{1}</p></div></body>'
    rows = [(i, "http://a.example/x", page.format("long text, " * 30, "short"), i) for i in range(9)]
    rows.append((9, "http://a.example/y", page.format("brief story", "teaser " * 20), 9))
    rows += [(10, None, None, 1), (11, "", "", 1), (None, "http://b.example", "<p>only <b>this", 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = {r.page_id: r.text for r in html_text.extracted(frame).collect()}
    assert got[9] == "brief story" and got[10] == got[11] == "" and got[None] == "only this"
    assert html_text.extracted(frame.limit(0)).count() == 0


# language model


def test_lm_query(spark, documents):
    rows = {r.doc_id: r for r in queries.op9_lm_score(spark, SF_DIR).collect()}
    split = {i: [*t.encode().lower().split(), b""] for i, t in documents.items()}
    count = Counter(w for i, ws in split.items() if remainder(i, 7) != 2 for w in ws)
    total, distinct = sum(count.values()), len(count)
    for i, ws in split.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (remainder(i, 7) == 2, len(ws), total)
        assert r.n_known == sum(count[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(sum(np.log10((count[w] + 1) / (total + distinct + 1)) for w in ws))
        assert r.score < 0


def test_spelling_probabilities_add_up():
    """Over all one-byte words and what longer words leave, the probability is one."""
    words = [b"abc", b"abd", b"xyz", b"a", b""]
    table = mixing.counts(words * 3, 14)
    weights, _, followed = mixing.learn(words, mixing.Odds(table, True))
    odds = mixing.Odds(table, False)
    refine = mixing.refinement(followed)
    price = 10 ** mixing.log10_spelling([b"", *(bytes([c]) for c in range(256) if c != 32)], odds, weights, refine)
    assert 0 < price.sum() < 1
    seen = 10 ** mixing.log10_spelling([b"abc", b"qqq"], odds, weights, refine)
    assert seen[0] > 100 * seen[1]


def test_text_score_prefers_repeats():
    price = np.full(40, -3.0)
    same, varied = np.zeros(40, int), np.arange(40)
    assert lm_score.text_score(same, price) > lm_score.text_score(varied, price) > -120.2
    assert lm_score.text_score(np.array([3]), price[:1]) == pytest.approx(-3.0)


def test_token_hashes_are_those_of_the_words():
    texts = [t.encode().lower() for t in ["A b  ab\x0bbA é中\x1c x", "", " \n", "z" * 300_000, "a b", " ab"]]
    found, sizes = mixing.token_hashes(texts)
    split = [[*t.split(), b""] for t in texts]
    assert sizes.tolist() == [len(w) for w in split]
    assert found.tolist() == mixing.word_hashes([w for ws in split for w in ws]).tolist()
    assert len(set(found.tolist())) == len({w for ws in split for w in ws})


def test_codes_after_words_add_up():
    """One two-token text for each code: the probabilities of all codes after the same word come to one."""
    hashes, sizes = mixing.token_hashes([b"a b c d a b c d"] * 20)
    table = mixing.following_counts(hashes, sizes, 14)
    state = mixing.new_state(len(mixing.FOLLOWED))
    mixing.learn_following(hashes, sizes, mixing.Odds(table, True, mixing.FOLLOWED_GATED), state)
    first = hashes[0]
    every = np.arange(1 << mixing.CODE_BITS, dtype=np.uint64) << np.uint64(64 - mixing.CODE_BITS)
    pairs = np.stack([np.full(len(every), first), every], axis=1).ravel()
    odds = mixing.Odds(table, False, mixing.FOLLOWED_GATED)
    found = mixing.log10_following(pairs, np.full(len(every), 2), odds, state[0], mixing.refinement(state[2]))
    assert (10 ** found[1::2]).sum() == pytest.approx(1)
    assert found[1::2].argmax() == mixing.codes(hashes[1:2])[0]


def test_lm_score_depends_on_the_words_before(spark):
    """The words of a text in an order that training never had score clearly worse, the same set of words or not."""
    rng = np.random.default_rng(5)
    runs = [" ".join(f"{a}{k}" for k in range(6)) for a in "abcdefghij"]
    training = [" ".join(rng.choice(runs, 30)) for _ in range(300)]
    kept = " ".join(runs)
    mixed = " ".join(rng.permutation(kept.split()))
    rows = [(k, t, True) for k, t in enumerate(training)] + [(1000, kept, False), (1001, mixed, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learnt boolean")
    score = {r.doc_id: r.score for r in lm_score.scored(docs, F.col("learnt")).where("doc_id >= 1000").collect()}
    assert score[1000] > score[1001] + 30


def test_lm_edges(spark, edge):
    rows = lm_score.scored(edge, F.col("doc_id") != 7).collect()
    assert len(rows) == len(EDGES) and all(np.isfinite(r.score) and np.isfinite(r.base_score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert lm_score.scored(edge.limit(0), F.lit(True)).count() == 0
    untrained = lm_score.scored(edge, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and np.isfinite(r.score) for r in untrained)


# licences


def plain_labels(text, threshold=licenses.THRESHOLD):
    found = set()
    for line in text.encode().lower().split(b"\n"):
        held = set(re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line))
        for _, label, bag in licenses.templates():
            if len(held & bag) >= licenses.needed(len(bag), threshold):
                found.add(label)
    return found


def plain_places(text):
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().lower())
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.encode().split()
        here = [k for k in range(len(w)) if w[k : k + len(p)] == p]
        places += here
        labels |= {label} if here else set()
    return len(w), sorted(places), labels


def test_license_query(spark, documents):
    rows = {r.doc_id: r for r in queries.op10_licenses(spark, SF_DIR).collect()}
    for doc_id, text in documents.items():
        r, (n, places, base) = rows[doc_id], plain_places(text)
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(places), ",".join(sorted(base)))
        assert (r.first_word, r.last_word) == ((places[0], places[-1]) if places else (None, None))
        assert r.labels == ",".join(sorted(base | plain_labels(text)))


def test_license_join_is_exact(spark):
    rng = np.random.default_rng(6)
    bags = [[w.decode() for w in bag] for _, _, bag in licenses.templates()]
    lines = []
    for _ in range(300):
        bag = list(bags[rng.integers(len(bags))])
        rng.shuffle(bag)
        lines.append(" ".join([*bag[: max(1, int(len(bag) * rng.uniform(0.7, 1)))], *rng.choice(["foo", "the", "of"], 2)]))
    rows = [(i, x, 0) for i, x in enumerate(lines)] + [(None, None, 0), (900, "", 0), (901, "MIT License mit license", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, f int")
    got = {r.doc_id: r for r in licenses.found(frame).collect()}
    for i, x in enumerate(lines):
        assert set(filter(None, got[i].labels.split(","))) - plain_places(x)[2] == plain_labels(x) - plain_places(x)[2]
    assert got[None].n_words == 0 and (got[901].n_base, got[901].first_word, got[901].last_word) == (2, 0, 2)
    assert licenses.found(frame.limit(0)).count() == 0


@pytest.mark.parametrize("width", [30, 72])
@pytest.mark.parametrize("mark", ["", "# ", " * ", "\n"])
def test_wrapped_notices_match(spark, width, mark):
    notices = [(label, text) for label, texts in licenses.TEMPLATES.items() for text in texts]
    made = [textwrap.wrap(f"Some words come first and then {text} and more words follow it.", width) for _, text in notices]
    rows = [(i, "Title\n\n" + "\n".join(mark + x for x in lines) + "\n\nEnd.") for i, lines in enumerate(made)]
    rows += [(900, "Permission is hereby granted\n\n" + "free words\n" * 40), (901, None)]
    got = {r.doc_id: r for r in licenses.found(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, _) in enumerate(notices):
        assert label in got[i].labels.split(",") and got[i].score == 1
        assert [m for m in got[i].matches if m.label == label]
    assert (got[900].labels, got[900].score, got[901].labels) == ("", 0, "")


# pipeline


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert 0 < len(rows) < docs.count()
        docs = spark.createDataFrame(rows, docs.schema)
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in rows}
    want = dict(zip([r.doc_id for r in rows], ids_of(queries.BYTE_TOKENIZER, [r.text for r in rows])))
    assert sum(p.length for p in pieces) == sum(map(len, want.values()))
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    assert all(i == g for i, g in plain_groups(fps).items())


def test_pipeline_stages_on_edges(spark, edge):
    for name, stage in corpus_pipeline.STAGES:
        for frame in (edge, edge.limit(0)):
            out = stage(spark, frame, SF_DIR)
            assert out.count() >= 0
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == edge.columns


def five_words(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_kept(texts):
    """The smallest id of each group of texts of five-word Jaccard 0.8 or more, all pairs compared."""
    bags = {i: five_words(t) for i, t in texts.items()}
    root = {i: i for i in bags}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in bags:
        for j in bags:
            if i < j and 5 * len(bags[i] & bags[j]) >= 4 * len(bags[i] | bags[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i for i in root if root[i] == i}


def test_near_copies_are_found_whole(spark):
    rng = np.random.default_rng(3)
    texts = {}
    for group in range(12):
        base = [f"w{x}" for x in rng.integers(0, 400, 150)]
        for copy in range(8):
            held = list(base)
            for at in rng.integers(0, 150, copy):
                held[at] = f"new{rng.integers(10**6)}"
            texts[len(texts)] = " ".join(held)
    texts |= {len(texts) + k: t for k, t in enumerate(["", " ", "two words", "Two  Words", "a b c d e f"])}
    rows = [(i, t, "x") for i, t in texts.items()]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _class string")
    got = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, frame, SF_DIR).collect()}
    assert got == plain_kept(texts)
    assert len(got) < len({x.text for x in simhash.representatives(frame).collect()})


def test_large_group_of_near_copies_makes_few_pairs(spark):
    base = [f"w{x}" for x in range(200)]
    texts = [" ".join([*base[:k], f"new{k}", *base[k + 1 :]]) for k in range(150)]
    marked = near_copies.marked_rows(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    entries = near_copies.shared_entries(marked)
    sets = near_copies.set_table(marked)
    first = near_copies.star_pairs(near_copies.parted(entries, None))
    links = near_copies.verified(first, sets, marked, Scratch(spark))
    left = near_copies.parted(entries, near_copies.components(links))
    assert near_copies.all_pairs(left).count() < 150 * 149 / 20
    assert near_copies.representatives(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count() == 1


@pytest.mark.parametrize("widths", [(3, 300), (40, 40)])
def test_what_stands_beside_the_winning_container_comes_along(spark, widths):
    lead, body = (" ".join(["word"] * n) for n in widths)
    post = f'<div class="post"><h1>Title</h1><div class="intro">{lead}</div><div class="entry"><p>{body}</p></div></div>'
    table = f"<div class='body'><p>First {lead}.</p><table><tr><td>{body}</td><td>{body}</td></tr></table><p>Last.</p></div>"
    side = '<div class="extra"><a href="/a">One linked line that stands outside</a></div>'
    formula = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold.</p></article>"
    named = f'<article><div class="entry-header"><h1>Title</h1></div><header class="post-header">By A</header><p>{body}</p></article>'
    site = f'<div class="site-header">Name of the site</div><article><p>{body}</p></article>'
    pages = {
        "posts": (post, f"Title\n{lead}\n{body}"), "beside": (post + side, f"Title\n{lead}\n{body}"),
        "tables": (table, f"First {lead}.\n{body}\n{body}\nLast."), "formulas": (formula, "Let x=1 hold."),
        "named": (named, f"Title\nBy A\n{body}"), "sites": (site, body),
    }
    rows = [(i, f"http://{host}.example/{k}", f"<html><body><nav>Menu</nav>{source}</body></html>") for i, (host, (source, _)) in enumerate(pages.items()) for k in range(3)]
    got = html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    wanted = [text for _, text in pages.values()]
    assert len(got) == len(rows) and all(r.text == wanted[r.page_id] for r in got)


def test_whole_page_wins_only_where_nothing_in_it_does_better(spark):
    rows = [(k, "http://mixed.example/", f"<body><p>{'loose text ' * 30}</p></body>") for k in range(5)]
    rows.append((9, "http://mixed.example/", f"<body><p>Small print</p><div class='main-text'><p>{'body text ' * 30}</p></div></body>"))
    got = {r.page_id: r.text for r in html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == ("loose text " * 30).strip() and got[9] == ("body text " * 30).strip()


def test_token_files_are_read_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FRAMES_PER_TASK", 1)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("word "), "id"), 400).alias("text"))
    folder = token_files.folder(spark)
    manifest = token_files.write(docs.coalesce(1), queries.WORD_TOKENIZER, folder)
    frames = manifest.agg(F.sum("frames")).first()[0]
    found = token_files.read(manifest, folder)
    assert frames > 1 and found.rdd.getNumPartitions() == frames
    assert sorted(r.doc_id for r in found.select("doc_id").collect()) == list(range(300))


def test_licences_in_very_long_texts_take_time_in_proportion(spark):
    notices = [text for texts in licenses.TEMPLATES.values() for text in texts]
    rows = [(n, "\n".join([notices[0]] * n)) for n in (1, 3, 20_000)] + [(0, "mit license " * 100_000)]
    start = time.monotonic()
    got = {r.doc_id: r for r in licenses.found(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert time.monotonic() - start < 60
    for n in (1, 3, 20_000):  # each line matches, no wider block adds anything
        assert [m.line for m in got[n].matches] == list(range(n)) and got[n].score == 1
    assert (got[0].n_base, got[0].first_word, got[0].last_word) == (100_000, 0, 199_998)


def test_near_duplicates_are_linked_by_fingerprints_first(spark, monkeypatch):
    """A long text and its copy with one word more: fingerprints alone find and group them."""
    words = [f"w{x}" for x in np.random.default_rng(5).integers(0, 10**6, 3000)]
    other = [f"v{x}" for x in range(3000)]
    rows = list(enumerate([" ".join(words), " ".join([*words, "end"]), " ".join(other)]))
    marked = near_copies.marked_rows(spark.createDataFrame(rows, "doc_id long, text string"))
    names = {r["_class"]: r.doc_id for r in marked.select("_class", "row.doc_id").collect()}
    assert [{names[p.a], names[p.b]} for p in near_copies.fingerprint_pairs(marked).collect()] == [{0, 1}]
    monkeypatch.setattr(near_copies, "TURNS", ("simhash",))
    assert {names[r.node] for r in near_copies.grouped(marked).collect()} == {0, 1}


def test_texts_that_share_a_passage_do_not_meet(spark):
    passage = " ".join(f"same{x}" for x in range(80))
    texts = [f"{passage} " + " ".join(f"own{k}x{x}" for x in range(60)) for k in range(40)]
    marked = near_copies.marked_rows(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    entries = near_copies.shared_entries(marked)
    assert entries.count() > 40
    assert near_copies.met(near_copies.parted(entries, None)).count() == 0


def test_word_tables_do_not_grow_with_shuffle_partitions(spark, monkeypatch):
    """Each task sends a whole table on, so a few words must not be dealt to as many tasks as there are partitions."""
    seen = []
    monkeypatch.setattr(lm_score, "fit_tables", lambda learnt, bits: seen.append(learnt) or np.zeros((len(mixing.ORDERS), 1 << bits, 2), np.float32))
    vocab = spark.range(500).select(F.concat(F.lit("w"), "id").cast("binary").alias("word"), F.lit(2).cast("long").alias("train"))
    lm_score.fit(vocab, 500, 14)
    assert "hashpartitioning" not in seen[0]._jdf.queryExecution().executedPlan().toString()
    assert seen[0].rdd.getNumPartitions() == 1


def test_prefixes_do_not_lie_with_the_rows(spark):
    """Entries are those of shingles that two sets hold in their prefixes, and rows are written without them."""
    head = " ".join(f"w{k}" for k in range(40))
    rows = [(1, head + " x"), (2, head + " y"), (2, head + " y"), (3, "one two three"), (4, ""), (5, None), (None, head + " x")]
    marked = near_copies.marked_rows(spark.createDataFrame(rows, "doc_id long, text string"))
    assert "_prefix" not in marked.columns
    none = np.zeros(0, np.int64)
    sets = [near_copies.shingles(t) for t in (head + " x", head + " y", "one two three")]
    held = Counter(x for s in sets for x in near_copies.prefix(s, none, none).tolist())
    got = near_copies.shared_entries(marked).collect()
    assert Counter(r.token for r in got) == {x: n for x, n in held.items() if n > 1}
    size = {r._class: (r._size, r.p0, r.p1, r.p2, r.p3) for r in marked.collect()}
    assert got and all((r.n, r.p0, r.p1, r.p2, r.p3) == size[r.c] for r in got)
