"""Cases that earlier forms of the operators got wrong."""

from __future__ import annotations

import collections
import hashlib
import random
import struct
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from adloom.llm import byte_bpe, html_extract, quality, secrets_scan, simhash, suffix_dedup
from adloom.llm.common import utf8
from tests.llm.test_text_operators import removed, suffix_rows


def test_suffix_dedup_keeps_large_and_negative_ids(spark):
    same, other = "0123456789" * 13, "abcdefghij" * 12
    ids = [2**62, 4611686018427387909, 2**63 - 1, -(2**63), -5, 7, None, None, None]
    data = [(i, "".join([str(n), same, chr(65 + n) * 30, other[: 100 + n]]), "en", "s") for n, i in enumerate(ids)] + [(2**63 - 2, same, "en", "s"), (None, same, "en", "s")]
    df = spark.createDataFrame(data, "id long, body string, lang string, source string").repartition(4)
    got = suffix_rows(df)
    known = [(i, t) for i, t, *_ in data if i is not None]
    expected = removed(known)
    assert {k: n for k, n in got.items() if k[0] is not None} == dict(expected)
    absent = [k for k in got.elements() if k[0] is None]
    assert len(absent) == 4 and all(k[2] >= 130 for k in absent)  # they come last: what others hold is removed from them


def _thue_morse(n):
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_different_lines_of_equal_hash_are_told_apart():
    one, two = _thue_morse(2048)
    assert one != two
    texts = [f"{one}\n{two}\nx", f"{one}\n{two}\n{one}", " ".join([one, *"abcdefg", two, *"abcdefg"])]
    found = quality.measure(*utf8(pa.array(texts)))
    assert found["n_dup_lines"].tolist() == [0, 1, 0]
    assert found["n_repeat_words"].tolist() == [0, 0, 0]


def test_equal_hashes_give_exact_names():
    data, starts, sizes = np.frombuffer(b"aabbaacc", np.uint8), np.array([0, 2, 4, 6]), np.array([2, 2, 2, 2])
    names = quality._checked_bytes(np.zeros(4, np.uint64), data, starts, sizes)
    assert names[0] == names[2] and len(set(names.tolist())) == 3
    assert quality._checked_columns(np.zeros(3, np.uint64), [np.array([1, 2, 1]), np.array([5, 5, 5])]).tolist() == [0, 1, 0]
    assert len(quality._checked_bytes(np.zeros(0, np.uint64), data, starts[:0], sizes[:0])) == 0


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>Formula <math><mi>x</mi>=<mn>2</mn></math> here</p>", ["Formula x=2 here"]),
        ("<p>Drawn <svg><text>label</text></svg> here</p>", ["Drawn label here"]),
        ("<object data=x><p>Fallback</p></object><p>After</p>", ["Fallback", "After"]),
        ("<noscript>open <p>rest</p><p>more</p>", ["open", "rest", "more"]),
        ("<p>one</p><svg><p>two</p>", ["one", "two"]),
        ("<p>one</p><script>var x = '<p>no</p>'</script><p>two</p>", ["one", "two"]),
        ("<p>one</p><textarea>typed<p>two</p>", ["one", "typed", "two"]),
        ("<style>p {}</STYLE ><p>İİİ</p><SCRIPT>1</sCript><p>x</p>", ["İİİ", "x"]),
    ],
)
def test_only_code_and_form_content_is_no_text(page, text):
    assert [b.text for b in html_extract.blocks(page)] == text


def test_many_near_copies_give_few_links(spark):
    """5,000 fingerprints close to one another, and chains of three flips: links stay linear, components are those of all pairs."""
    draw = random.Random(3)
    flips = [1 << a | 1 << b for a in range(64) for b in range(a)] + [1 << a | 1 << b | 1 << c for a in range(40) for b in range(a) for c in range(b)]
    centre = draw.getrandbits(64)
    values = {centre ^ mask for mask in draw.sample(flips, 5000)}
    for _ in range(30):
        x = draw.getrandbits(64)
        for _ in range(12):
            values.add(x)
            for bit in draw.sample(range(64), 3):
                x ^= 1 << bit
    prints = np.array(sorted(values), np.uint64)
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[:i]) <= 3).tolist():
            parent[find(i)] = find(j)
    want = {}
    for i, p in enumerate(prints.view(np.int64).tolist()):
        want.setdefault(find(i), set()).add(p)
    df = spark.createDataFrame([(p,) for p in prints.view(np.int64).tolist()], "fp long")
    assert simhash.least_links(df).count() < len(prints)
    found = simhash.linked(df)
    assert found.select("fp").distinct().count() == found.count() == len(prints)
    groups = {}
    for fp, root in found.collect():
        groups.setdefault(root, set()).add(fp)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert all(root in group for root, group in groups.items())
    first = simhash._with_roots(df.select("fp", F.col("fp").alias("root")), "root", simhash.least_links(df))
    assert simhash.cluster_links(first).count() < len(prints)
    assert simhash.linked(df.where("false")).count() == 0


@pytest.mark.parametrize("tag", ["div", "span", "ul", "b"])
def test_deep_pages_cost_their_size(tag):
    """50,000 nested elements with a text each: no copy of the open elements per block, no scan of them per tag."""
    depth = 50_000
    page = "<a>" + "".join(f'<{tag} class="c d"><p>word {i}</em>' for i in range(depth))
    tracemalloc.start()
    started = time.monotonic()
    found = html_extract.blocks(page)
    taken, (_, peak) = time.monotonic() - started, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert [b.text for b in found] == [f"word {i}" for i in range(depth)]
    assert peak < 150 * 2**20 and taken < 60
    last = found[-1].path
    assert last[:4] == ("a", tag, ".c", ".d") and all(b.linked for b in found[:3])
    x = html_extract.features([found])
    want = {place for token in last for place in html_extract._place(token)} | {html_extract._place("last:" + last[-1])[0]}
    assert set(np.flatnonzero(x[-1, : html_extract.PATH_DIMS])) == want


def test_secret_candidates_beside_many_findings():
    draw = random.Random(4)
    key = lambda n: "".join(draw.choices("abcdefghij0123456789XYZ", k=n))
    parts = [draw.choice([f"token={key(20)}", f"AKIA{'A1B2C3D4E5F6G7H8'}", "0123456789abcdef" * 2, key(24), f"api_key: {key(9)}/{key(30)}"]) for _ in range(20_000)]
    text = " ".join(parts)
    base = secrets_scan.base_findings(text)
    started = time.monotonic()
    found = secrets_scan.other_candidates(text, base)
    assert time.monotonic() - started < 5
    some = text[:20_000]
    base = secrets_scan.base_findings(some)
    spans = [m.span() for m in secrets_scan.CANDIDATE.finditer(some) if secrets_scan.DIGIT.search(some, *m.span())]
    assert secrets_scan.other_candidates(some, base) == [(a, b) for a, b in spans if not any(s < b and a < e for s, _, e, _ in base)]
    assert len(found) > 1000


def test_pipeline_folds_distinct_words_by_higher_order_functions(spark, monkeypatch):
    """Every merge of the pipeline's last stage is made by the higher-order fold, whose ids meet the texts again."""
    def refuse(*_):
        raise AssertionError("a worker folds")

    monkeypatch.setattr(byte_bpe, "fold", refuse)
    monkeypatch.setattr(byte_bpe, "encode", refuse)
    monkeypatch.setattr(byte_bpe, "GROUP_BYTES", 4096)
    monkeypatch.setattr(byte_bpe, "GATHERED", 100)
    draw = random.Random(31)
    alphabet = "ab cd'sE é ßñ中文🎉\n\t \x1c\x85 12½_-!%&'ll're　"
    texts = ["".join(draw.choices(alphabet, k=draw.randint(0, 90))) for _ in range(400)] + ["", None, None, "same text"] + ["same text"] * 5
    texts += ["".join(draw.choices("abcdething", k=3000)), "a" * 2001, "ab" * 900 + "c", " " * 1300 + "x", "=-" * 700, "".join(draw.choices("éñ中🎉", k=600))]
    rows = [(None if i % 50 == 7 else i // 2, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = corpus_pipeline.tokens(spark, docs, "")
    assert "aggregate(" in found._jdf.queryExecution().optimizedPlan().toString()
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    judge = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    want = collections.Counter()
    for i, t in rows:
        ids = judge.encode_ordinary(t or "")
        want[i, len(ids), struct.pack(f"<{len(ids)}I", *ids), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in found.collect()) == want
