"""Vectors, pages, queries with SQL, and the pipeline."""

from __future__ import annotations

import collections
import hashlib
import html
import random
import re
import struct

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from adloom.llm import byte_bpe, common, embedding_dedup, html_extract, language_id, queries, secrets_scan
from tests.llm.test_text_operators import linked
from tools import compare

SF_DIR = "/root/testdata/sf0.001"


# --- vectors ---------------------------------------------------------------------------


def near(rows, least=0.9):
    """(vec_id, n_links, component_id) by comparing everything."""
    units = []
    for _, v in rows:
        usable = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, float) / np.abs(np.array(v, float)).max() if usable else None)
    units = [u if u is None else u / np.linalg.norm(u) for u in units]
    n, parent, links = len(rows), list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and len(a) == len(b) and (rows[i][1] == rows[j][1] or a @ b >= least):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            ids[find(i)].append(vec_id)
    return collections.Counter((rows[i][0], links[i], min(ids[find(i)], default=None)) for i in range(n))


def vector_rows(df):
    return collections.Counter(tuple(r) for r in embedding_dedup.near_duplicates(df).select("vec_id", "n_links", "component_id").collect())


@pytest.mark.parametrize("part", [2048, 16])
def test_vectors_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(embedding_dedup, "PART", part)
    rng = np.random.default_rng(3)
    rows = []
    for i, v in enumerate(rng.normal(size=(120, 32))):
        for k in range(rng.integers(1, 5)):
            rows.append((i * 10 + k, [float(x) for x in v + rng.normal(size=32) * 0.2]))
    hot = rng.normal(size=32)
    rows += [(5000 + i, [float(x) for x in hot + rng.normal(size=32) * 0.15]) for i in range(60)]
    inf, nan = float("inf"), float("nan")
    rows += [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [2.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0])]
    rows += [(7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (11, [1.0]), (12, [-0.0, 1.0]), (13, [0.0, 1.0]), (14, [1e300, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, node string, links int")
    assert vector_rows(df) == near(rows)


def test_pairs_at_the_threshold_are_found(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(size=(1500, 48))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = 0.9005 * a + np.sqrt(1 - 0.9005**2) * b
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([a, c]))]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.where("n_links > 0").count() >= 0.999 * len(rows)


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(7)
    a = rng.normal(size=64)
    a /= np.linalg.norm(a)
    b = rng.normal(size=64)
    b = 0.9 * a + np.sqrt(1 - 0.81) * (b - (a @ b) * a) / np.linalg.norm(b - (a @ b) * a)
    errors, spreads = [], []
    for seed in range(400):
        turned = np.stack([a, b]) @ embedding_dedup.rotations(64, 64, seed).T
        factor = np.abs(turned[1]).sum() / 8
        errors.append(turned[0] @ np.where(turned[1] > 0, 1, -1) / (8 * factor) - 0.9)
        spreads.append(np.sqrt(1 - 0.81) * np.sqrt(1 - factor**2) / factor / np.sqrt(63))
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) == pytest.approx(np.mean(spreads), rel=0.15)
    assert (np.abs(errors) < embedding_dedup.EPSILON * np.array(spreads)).all()


@pytest.mark.parametrize("dim", [1, 2, 33, 64])
def test_codes_estimate_without_bias_and_keep_every_pair(dim):
    rng = np.random.default_rng(dim)
    a = embedding_dedup._unit(rng.normal(size=(300, dim)))
    b = embedding_dedup._unit(a + rng.normal(size=a.shape) * 0.45 / np.sqrt(dim))
    unit = np.concatenate([a, b, embedding_dedup._unit(rng.normal(size=(300, dim)))])
    if dim > 2:
        errors = []
        for seed in range(40):
            factor, _, signs, turned = embedding_dedup._decode(pa.array(embedding_dedup._encode(unit, seed)))
            estimate = (turned[:300] * signs[300:600]).sum(axis=1) / (np.sqrt(dim) * factor[300:600])
            errors.append(estimate - (a * b).sum(axis=1))
        assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.6 / np.sqrt(dim)
    exact = unit @ unit.T >= 0.9
    np.fill_diagonal(exact, False)
    for side in (np.full(900, 2), np.arange(900) % 2):
        names = np.arange(900)
        table = pa.table({"piece": np.zeros(900, np.int64), "side": side, "t": names, "node": names, "code": embedding_dedup._encode(unit, 29)})
        meets = exact if side[0] == 2 else exact & (side[:, None] != side[None, :])
        kept = embedding_dedup._undecided(0.9)(table)
        assert set(np.flatnonzero(meets.any(axis=1))) <= set(kept["node"].to_pylist())
        if dim == 64:
            assert kept.num_rows < 700


def test_empty_vectors_and_given_table(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    found = queries.QUERIES["op2_embedding_rotations"](spark, SF_DIR).select("vec_id", "n_links", "component_id")
    assert collections.Counter(tuple(r) for r in found.collect()) == near(rows)


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    hub = [(100, 100 + i) for i in range(1, 50)]
    edges = spark.createDataFrame(path + hub + [(7, 3), (500, 500)], "a long, b long")
    found = {r.node: r.root for r in common.components(edges).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 150)}
    assert common.components(edges.limit(0)).count() == 0


# --- pages -----------------------------------------------------------------------------


def article(page):
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    parts = [" ".join(html.unescape(re.sub(r"<(?:br|b|/b)>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(p for p in parts if p)


@pytest.fixture(scope="module")
def labeller(spark):
    return html_extract.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_pages_of_the_table(spark, labeller):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    found = html_extract.extract(pages, labeller).collect()
    assert {r.page_id: r.text for r in found} == want
    assert all(r.n_chars == len(r.text) for r in found)


@pytest.mark.parametrize("tag", ["script", "STYLE", "template"])
def test_raw_elements_end_where_they_end(tag):
    page = f"<p>{'İ' * 40} önce</p><{tag}>x = '<p>no</p>'</{tag.title()}><p>sonra</p><p>son</p>"
    assert [b.text for b in html_extract.blocks(page)] == ["İ" * 40 + " önce", "sonra", "son"]


def test_made_pages_that_were_not_trained_on(labeller):
    draw, wrong, total = random.Random(123), 0, 0
    words = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()
    for _ in range(200):
        found, labels = html_extract.made_page(draw, words)
        if found:
            wrong += int((labeller.label([found])[0] != np.array(labels, bool)).sum())
            total += len(labels)
    assert wrong <= 0.05 * total


def test_odd_pages(spark, labeller):
    body = "<article><h1>Title &amp; more</h1><p>A first paragraph&nbsp;with \n two   lines.<p>A second one &lt;b&gt; &#233;.</article>"
    rows = [
        (1, "u", f"<nav><ul><li><a href=/>Home</a></ul></nav>{body}<footer>Copyright</footer>"),
        (1, "u", f"<nav><ul><li><a href=/>Home</a></ul></nav>{body}<footer>Copyright</footer>"),
        (2, None, None),
        (3, "u", ""),
        (None, "u", "<script>if (a < b) { '</p>' }</script><style>p{}</style><!-- <p>no</p> -->"),
        (4, "u", "<article><p>cut <b>off" + "<i>" * 3000),
        (5, "u", '<article><p>An unfinished tag after some words.</p><a href="x'),
        (6, "u", "<article>" + "<p>A paragraph of the long page.</p>" * 3000 + "</article>"),
    ]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = collections.defaultdict(list)
    for r in html_extract.extract(df, labeller).collect():
        found[r.page_id].append(r.text)
    assert found[1] == ["Title & more\n\nA first paragraph with two lines.\n\nA second one <b> é."] * 2
    assert found[2] == found[3] == found[None] == [""]
    assert found[5] == ["An unfinished tag after some words."]
    assert found[6][0].count("A paragraph of the long page.") == 3000
    assert html_extract.extract(df.limit(0), labeller).count() == 0


# --- SQL, registration, pipeline --------------------------------------------------------


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_equals_sql(spark, key):
    assert compare.compare(spark, compare.duck(SF_DIR), SF_DIR, key) is None


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 11))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = [r for r in language_id.identify(docs, language_id.train(docs)).collect() if r.accepted]
    rows = {r.doc_id: r for r in docs.collect()}
    groups = linked([(r.doc_id, rows[r.doc_id].text) for r in kept])
    firsts = sorted(i for i, _, least in groups if i == least)
    stage = corpus_pipeline.STAGES[1][1](spark, corpus_pipeline.STAGES[0][1](spark, docs, SF_DIR), SF_DIR)
    assert sorted(r.doc_id for r in stage.collect()) == firsts
    assert stage.schema == docs.schema
    clean = corpus_pipeline.STAGES[2][1](spark, stage, SF_DIR)
    assert clean.schema == docs.schema and clean.where("n_chars != length(text)").isEmpty()
    assert not any(secrets_scan.base_findings(r.text) for r in clean.collect())
    texts = {r.doc_id: r.text for r in clean.collect()}
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    judge = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in out:
        ids = judge.encode_ordinary(texts[r.doc_id])
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids) and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert 1 <= max(collections.Counter(r.doc_id for r in out).values()) <= 3
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "secret_scan", "source_mix", "byte_bpe"]


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0
