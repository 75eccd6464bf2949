"""Hard negatives, URL rules and token alignment against brute force on small tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adloom.llm import hard_negatives, queries, token_alignment, url_filter
from adloom.llm.common import utf8
from tests.conftest import plan, rows

# --- op11 ---

VECTORS = "vec_id bigint, embedding array<float>, label int, row int, score string, anchor int"


def _table(spark, data):
    floats = lambda v: v if v is None else [x if x is None else float(x) for x in v]
    return spark.createDataFrame([(i, floats(v), c, 1, "x", 2) for i, v, c in data], VECTORS)


def _mined(data, anchor, k=5, m=10):
    """Brute force over (id, vector, label)."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], c) for i, v, c in data
            if v is not None and c is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for i, v, c in kept:
        if i is None or not anchor(i):
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, d) for j, w, d in kept if j != i]
        for s, p, _ in sorted((r for r in scored if r[2] == c), key=order)[:k]:
            fits = [r for r in scored if r[2] != c and 30 * s <= 100 * r[0] <= 90 * s]
            out += [(i, p, n, q, s, t) for n, (t, q, _) in enumerate(sorted(fits, key=order)[:m], 1)]
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def _random_vectors(n, dims, labels, seed, spread=1.0):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, spread) for _ in range(dims)], draw.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("leaf, tree, slab, block", [(128, 1 << 15, 1 << 16, 16384), (4, 64, 100, 3)])
def test_negatives_equal_brute_force(spark, monkeypatch, leaf, tree, slab, block):
    for name, value in zip(("LEAF_ROWS", "TREE_ROWS", "SLAB_ROWS", "ANCHORS_AT_ONCE"), (leaf, tree, slab, block)):
        monkeypatch.setattr(hard_negatives, name, value)
    data = _random_vectors(700, 6, 4, 3)
    data += [(10_000 + i, [0.5, 0.25, 0, 0, 1, 0], i % 3) for i in range(300)]  # one vector, a third of all rows
    data += [(None, [1.0, 1, 1, 1, 1, 1], 1), (8, None, 1), (9, [None, 1.0], 1), (11, [float("nan")], 2), (12, [float("inf")], 2),
             (13, [1.0, 2.0], None), (14, [], 0), (15, [3.0], 1)]
    got = hard_negatives.mine(_table(spark, data), F.col("vec_id") % 50 == 0)
    assert rows(got) == _mined(data, lambda i: i % 50 == 0)


def test_negatives_of_zero_and_negative_scores_and_large_components(spark):
    data = [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 3.0], 1), (3, [-1.0, 0.0], 0), (4, [-0.5, 0.0], 1), (5, [0.0, 9.0], 2)]
    got = hard_negatives.mine(_table(spark, data), F.col("vec_id") == 0)
    assert rows(got) == _mined(data, lambda i: i == 0) != []
    big = [(i, [2.0**20 + i * 2.0, -(2.0**18) * i], i % 2) for i in range(8)]  # products beyond 2 ** 53
    got = hard_negatives.mine(_table(spark, big), F.col("vec_id") < 2)
    assert rows(got) == _mined(big, lambda i: i < 2)


def test_negatives_of_an_empty_table_and_of_repeated_rows(spark):
    assert hard_negatives.mine(_table(spark, []), F.col("vec_id") == 0).count() == 0
    data = [(0, [1.0], 0), (0, [1.0], 0), (1, [1.0], 0), (1, [1.0], 0), (2, [0.5], 1)]
    got = hard_negatives.mine(_table(spark, data), F.col("vec_id") == 0)
    assert rows(got) == _mined(data, lambda i: i == 0)


def test_boxes_bound_every_inner_product_and_prune():
    rng = np.random.default_rng(5)
    q = rng.integers(-300, 300, (4000, 8)) + np.repeat(rng.integers(-4000, 4000, (20, 8)), 200, axis=0)
    order = hard_negatives.str_order(q, [0, 3, 5])
    assert sorted(order.tolist()) == list(range(4000))
    tree = hard_negatives.Tree(np.zeros(4000, np.int64), q[order].astype(np.float64))
    anchor = rng.integers(-300, 300, 8).astype(np.float64)
    exact = tree.q @ anchor
    for (least, most), (low, *_, size) in zip(tree.bounds(anchor), tree.levels):
        for node in range(len(low)):
            part = exact[node * size : (node + 1) * size]
            assert least[node] <= part.min() and part.max() <= most[node]
    visited = []
    search = hard_negatives.Search(5)
    offered = search.offer
    search_offer = lambda *x: (visited.append(1), offered(*x))

    class Watched(hard_negatives.Search):
        offer = staticmethod(search_offer)

    watched = Watched(5)
    watched.best = search.best
    hard_negatives.best_first(tree, anchor, 0, np.zeros(4000, bool), [watched], True, np.arange(4000), np.zeros(4000, bool))
    assert sorted((-e[0] for e in search.best)) == sorted(-exact)[:5]
    assert len(visited) < len(tree.levels[0][0]) / 2


# --- op12 ---


def _pattern(glob):
    return re.compile("".join({"**": "(?s:.*)", "*": "[^/]*"}.get(p) or re.escape(p) for p in re.split(r"(\*\*|\*)", glob)))


def test_automaton_equals_regular_expressions():
    draw = random.Random(1)
    for _ in range(150):
        globs = ["".join(draw.choice(["a", "b", "/", "*", "**", ".", "é"]) for _ in range(draw.randint(0, 9))) for _ in range(draw.randint(0, 40))]
        texts = ["".join(draw.choice("ab/.é") for _ in range(draw.randint(0, 12))) for _ in range(40)]
        found = url_filter.Automaton(globs).match(*utf8(pa.array(texts)))
        assert found.tolist() == [[bool(_pattern(g).fullmatch(t)) for g in globs] for t in texts]


def _judged(url):
    start = (url or "").find("://")
    rest = "" if start < 0 else url[start + 3 :]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        rule = max(fits, key=lambda r: len(r.text))
        return host, path, rule.text, rule.action
    blocked = not host or any(_pattern(g.pattern).fullmatch(host + path) for g in url_filter.DEFAULT_GLOBS)
    return host, path, None, "block" if blocked else "allow"


def test_urls_equal_brute_force(spark):
    urls = [
        None, "", "no scheme", "://", "http://", "http://com", "http://com/", "http://COM/", "http://a.com?x=/", "http://xcom/", "http://.com/",
        "http://example.com/en", "http://example.com/en/", "http://WWW.Example.com/en/1", "http://m.www.example.com/en/", "http://m.example.com/EN/",
        "http://a.net/es/1", "http://a.net/fr/#x", "http://net/fr/", "http://a.net/de/", "http://a.net/login", "http://ads.org/x", "http://a.org/x.exe",
        "http://a.org/x.com/", "http://a.org//ads//", "http://É.com/ü", "http://a.com:80/", "http://u@a.com/", "x?y=http://a.com/", "http://a.org/\n/ads/\n",
        "http://a.net/" + "é/" * 200_000 + "login", "http://a.com/" + "x" * 300_000, "http://" + "a." * 100_000 + "net/es/",
    ]
    data = [(i, u, "h", "v") for i, u in enumerate(urls)] + [(None, "http://a.net/es/", "h", "v"), (5, "http://com", "h", "v")]
    pages = spark.createDataFrame(data, "page_id bigint, url string, host string, verdict string")
    got = url_filter.judge(pages, queries.URL_RULES).select("page_id", "host", "path", "rule", "verdict")
    assert rows(got) == sorted(((i, *_judged(u)) for i, u, *_ in data), key=lambda r: tuple((x is not None, x) for x in r))
    assert url_filter.judge(pages.limit(0), queries.URL_RULES).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, [], [], default="block").collect()} == {"block"}
    assert "Exchange" not in plan(got)


# --- op13 ---

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def _aligned(texts):
    """Brute force, token by token: per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = token_alignment._byte_letters()
    groups_of = []
    for text in texts:
        groups = []
        if text:
            a, b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
            a_bytes = [bytes(letters[c] for c in one.id_to_token(i)) for i in a]
            b_bytes = []
            for i in b:
                piece = two.id_to_piece(i)
                b_bytes.append(bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x..>", piece) else piece.replace("▁", " ").encode())
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                i = j = 0
                while i < len(a):
                    left, right, x, y = [a[i]], [b[j]], len(a_bytes[i]), len(b_bytes[j])
                    while x != y:
                        if x < y:
                            i += 1
                            left.append(a[i])
                            x += len(a_bytes[i])
                        else:
                            j += 1
                            right.append(b[j])
                            y += len(b_bytes[j])
                    groups.append((left, right))
                    i, j = i + 1, j + 1
        groups_of.append(groups)
    counts = Counter(pair for groups in groups_of for pair in {(x, y) for g in groups for x in g[0] for y in g[1]})
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for groups in groups_of:
        links = [counts[x, y] for g in groups for x in g[0] for y in g[1]]
        top = sum(counts[x, y] == best[x] for g in groups for x in g[0] for y in g[1])
        text = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups)
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), top, sum(links), text))
    return out


TEXTS = [
    None, "", " ", "a", "The quick brown fox jumps over the lazy dog.", "the the the the", "a  b   c", "tabs\tand\nlines\n\n", "Grüße, naïve café – 東京 🙂🙂",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "a▁b", "x\x00y", "supercalifragilistic antidisestablishmentarianism", "=" * 300, "ab" * 700, " " * 50 + "x",
    "0123456789abcdef" * 30, "́é ​﻿", "مرحبا بالعالم", "The quick brown fox", "The quick brown fox",
]


@pytest.mark.parametrize("links, pairs, tokens", [(1 << 20, 1 << 21, 1 << 19), (40, 50, 30)])
def test_alignment_equals_brute_force(spark, monkeypatch, links, pairs, tokens):
    """Also with portions so small that groups, shards and texts are split."""
    for name, value in (("LINKS_AT_ONCE", links), ("SHARD_PAIRS", pairs), ("TOKENS_AT_ONCE", tokens), ("PIECE", 64 if pairs == 50 else 1 << 16), ("HELD_PAIRS", 30 if pairs == 50 else 1 << 20)):
        monkeypatch.setattr(token_alignment, name, value)
    texts = TEXTS if pairs > 50 else TEXTS[:9]
    docs = spark.createDataFrame([(i if i else None, t, 7, "g") for i, t in enumerate(texts)], "doc_id bigint, text string, n_a int, groups string")
    got = rows(token_alignment.align(docs.repartition(4), A, B, public_tokenizers.PATTERN))
    assert got == sorted(((i if i else None, *r) for i, r in enumerate(_aligned(texts))), key=lambda r: tuple((x is not None, x) for x in r))


def test_alignment_of_very_long_texts_and_of_an_empty_table(spark):
    long_ones = ["word " * 60_000, " " * 200_000, "=" * 100_000, "é" * 60_000]
    docs = spark.createDataFrame(list(enumerate(long_ones)), "doc_id bigint, text string")
    got = token_alignment.align(docs, A, B, public_tokenizers.PATTERN)
    assert rows(got) == [(i, *r) for i, r in enumerate(_aligned(long_ones))]
    assert token_alignment.align(docs.limit(0), A, B, public_tokenizers.PATTERN).count() == 0


def test_perfect_hash_has_no_gaps():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 40, 200_000))
    perfect = token_alignment.PerfectHash(keys)
    assert perfect.n == len(keys) and sorted(perfect.index(keys).tolist()) == list(range(len(keys)))
    assert len(token_alignment.PerfectHash(keys[:0]).index(keys[:5])) == 5
