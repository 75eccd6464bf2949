"""Byte-level BPE: ranked merges folded over the bytes of distinct words; decoding joins binary pieces.

``fold_words`` folds a table of distinct words by Spark's higher-order functions with a literal rank map.
``encode_by_words`` folds every distinct word of the corpus once by it and brings the ids back to the documents, by
groups of bounded size. In ``encode`` a worker folds each distinct word when it first meets it, by the same merges; on
request the corpus's frequent words are folded ahead by ``fold_words`` and reach the workers as a table of bounded size.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Distinct words that a worker remembers before it starts anew; bounds its memory, not its result.
REMEMBERED = 300_000
#: Words of at most so many bytes are folded by rescanning, longer ones by a heap.
SHORT = 48
WORDS_AT_ONCE = 1 << 20
#: Frequent words folded ahead, at most, and the documents (least hashed ids) they are counted in. They save work and
#: change no result.
FREQUENT = 1 << 13
COUNTED_DOCS = 2000
#: The literal rank map is cut into this many small maps by the token's CRC, as Spark looks maps up from end to end.
RANK_MAPS = 1 << 14
#: A pair of parts is its rank times this and its place, so that the least is the leftmost of the lowest rank.
SPAN = 1 << 31
#: Words above so many times the longest token's bytes are folded window by window.
WINDOW_TOKENS = 4
#: Text bytes of a group of documents, about; a task holds the distinct words of one group and their ids.
GROUP_BYTES = 32 << 20
#: Distinct (group, word) pairs that a worker gathers before it sends them on; bounds its memory, not its result.
GATHERED = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file: a base64 token and its rank on each line."""
    lines = (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, as a lambda's variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _ids(data: Column, ranks: dict[bytes, int]) -> Column:
    """Ids of one word's bytes; a null or empty word has none."""
    maps: list[dict[str, int]] = [{} for _ in range(RANK_MAPS)]
    for token, rank in ranks.items():
        maps[zlib.crc32(token) % RANK_MAPS][token.hex().upper()] = rank
    # Of literals only, so Spark computes it once and plans with the result; JSON cannot hold bytes, hence hex keys.
    literal = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")
    none = F.lit(1 << 30).cast("long")
    window = WINDOW_TOKENS * max(map(len, ranks), default=1)

    def ids(maps: Column) -> Column:
        def rank(token: Column) -> Column:
            return F.try_element_at(F.element_at(maps, (F.crc32(token) % RANK_MAPS + 1).cast("int")), F.hex(token))

        def pair(joined: Column) -> Column:
            return F.coalesce(rank(joined).cast("long"), none) * SPAN

        def merge(state: Column, _: Column) -> Column:
            """The lowest-ranked, leftmost pair becomes one part; only the pairs beside it are looked up anew."""
            parts, pairs = state["parts"], state["pairs"]

            def joined(least: Column) -> Column:
                at = least.bitwiseAND(F.lit(SPAN - 1)).cast("int")
                part = F.concat(F.get(parts, at), F.get(parts, at + 1))
                before = F.when(at > 0, F.array(pair(F.concat(F.get(parts, at - 1), part)))).otherwise(F.array().cast("array<bigint>"))
                after = F.array(pair(F.concat(part, F.get(parts, at + 2))))
                return F.struct(
                    F.concat(F.slice(parts, F.lit(1), at), F.array(part), F.slice(parts, at + 3, F.size(parts))).alias("parts"),
                    F.concat(F.slice(pairs, F.lit(1), F.greatest(at - 1, F.lit(0))), before, after, F.slice(pairs, at + 3, F.size(parts))).alias("pairs"),
                )

            least = F.array_min(F.transform(pairs, lambda x, i: x + i))
            return F.when(F.array_min(pairs) >= none * SPAN, state).otherwise(_bind(least, joined))

        def fold(part: Column) -> Column:
            """Parts of some bytes after all merges, two bytes or more being given; the last part's pair has no rank."""
            size = F.octet_length(part)
            start = F.struct(
                F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(part, i, F.lit(1))).alias("parts"),
                F.transform(
                    F.sequence(F.lit(1), size),
                    lambda i: F.when(i < size, pair(F.substring(part, i, F.lit(2)))).otherwise(none * SPAN),
                ).alias("pairs"),
            )
            return F.aggregate(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), start, merge, lambda state: state["parts"])

        def slide(state: Column, _: Column) -> Column:
            """The first half of the parts of the next window; the next one starts where they end."""

            def taken(parts: Column) -> Column:
                last = state["at"] + window >= F.octet_length(data)
                n = F.when(last, F.size(parts)).otherwise(F.greatest((F.size(parts) / 2).cast("int"), F.lit(1)))
                first = F.slice(parts, F.lit(1), n)
                return F.struct(
                    F.aggregate(first, state["at"], lambda total, x: total + F.octet_length(x)).alias("at"),
                    F.get(parts, n).alias("next"),
                    (state["sure"] & F.coalesce(state["next"] == F.get(parts, F.lit(0)), F.lit(True))).alias("sure"),
                    F.concat(state["ids"], F.transform(first, rank)).alias("ids"),
                )

            rest = _bind(F.substring(data, state["at"] + 1, F.lit(window)), fold)
            return F.when(state["at"] >= F.octet_length(data), state).otherwise(_bind(rest, taken))

        def long(slid: Column) -> Column:
            # Merges are right if they are for every two neighbours, and two windows that share the part after a cut vouch
            # for the neighbours there. Windows that ever differed would send the word through one fold.
            return F.when(slid["sure"], slid["ids"]).otherwise(F.transform(fold(data), rank))

        begin = F.struct(
            F.lit(0).alias("at"), F.lit(None).cast("binary").alias("next"), F.lit(True).alias("sure"), F.array().cast("array<int>").alias("ids")
        )
        slid = F.aggregate(F.sequence(F.lit(1), F.greatest(F.octet_length(data), F.lit(1))), begin, slide)
        whole = rank(data)
        return (
            F.when(F.coalesce(F.octet_length(data), F.lit(0)) == 0, F.array().cast("array<int>"))
            .when(whole.isNotNull(), F.array(whole))
            .when(F.octet_length(data) <= window, F.transform(fold(data), rank))
            .otherwise(_bind(slid, long))
        )

    return _bind(literal, ids)


def fold_words(words: DataFrame, ranks: dict[bytes, int], word_col: str = "word") -> DataFrame:
    """(word, ids, and the other columns) for a table of distinct words: ranked merges folded over arrays of bytes by
    higher-order functions.

    Every round merges the lowest-ranked, leftmost pair; a word of n bytes needs n - 1 rounds at most. Words far above the
    longest token are folded in windows, so their time grows with their length. Null and empty words have no ids.
    """
    coded = words.withColumn("_data", F.encode(F.col(word_col), "utf-8"))
    rest = [c for c in words.columns if c != word_col]
    return coded.select(F.col(word_col).alias("word"), _ids(F.col("_data"), ranks).alias("ids"), *rest)


def frequent_words(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str, text_col: str) -> dict[str, bytes]:
    """Ids (little-endian) of at most FREQUENT words, the most frequent ones of COUNTED_DOCS documents."""
    ids = docs.select(F.col(id_col).cast("string").alias("id")).where("id is not null").distinct()
    ids = [r.id for r in ids.orderBy(F.xxhash64("id"), "id").limit(COUNTED_DOCS).collect()]
    texts = docs.where(F.col(id_col).cast("string").isin(ids)).select(F.col(text_col).cast("string").alias("text"))
    words = texts.select(F.explode(F.regexp_extract_all("text", F.lit(f"(?U){pattern}"), F.lit(0))).alias("word"))
    counted = words.where(F.octet_length("word").between(1, SHORT)).groupBy("word").agg(F.count("*").alias("n"))
    chosen = counted.orderBy(F.desc("n"), "word").limit(FREQUENT).repartition(16)
    return {r.word: np.array(r.ids, "<u4").tobytes() for r in fold_words(chosen, ranks).collect()}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: of all adjacent pairs the lowest-ranked, leftmost, is merged until none has a rank."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > SHORT:
        return _fold_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    known = ranks.get
    none = 1 << 60
    pairs = [known(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        least = min(pairs)
        if least == none:
            break
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = known(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = known(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for long words: a linked list of parts and a heap of pairs."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, start, stop = heapq.heappop(heap)
        middle = end[start] if end[start] else n
        if not end[start] or middle >= n or not end[middle] or end[middle] != stop:
            continue
        end[start], end[middle] = stop, 0
        if stop < n:
            before[stop] = start
            rank = ranks.get(word[start : end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, start, end[stop]))
        left = before[start]
        if left >= 0:
            rank = ranks.get(word[left:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, left, stop))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[word[at : end[at]]])
        at = end[at]
    return ids


class Words(dict):
    """Word to its ids as little-endian 32-bit bytes; a missing word is folded once."""

    def __init__(self, ranks: dict[bytes, int], known: dict[str, bytes] | None = None):
        super().__init__(known or {})
        self.ranks, self.known = ranks, known or {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
            self.update(self.known)
        ids = np.array(fold(word.encode("utf-8"), self.ranks), "<u4").tobytes()
        self[word] = ids
        return ids


_WORKER: dict = {}


def _tools(shared) -> tuple[Words, list[bytes], regex.Pattern]:
    """This worker's words, token bytes by id, and pattern; kept between tasks of the same vocabulary."""
    if shared.value["name"] not in _WORKER:
        ranks = dict(zip(shared.value["tokens"], shared.value["ids"], strict=True))
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            pieces[i] = token
        _WORKER.clear()
        _WORKER[shared.value["name"]] = Words(ranks, shared.value.get("words")), pieces, regex.compile(shared.value["pattern"])
    return _WORKER[shared.value["name"]]


def encode_text(text: str, words: Words, pattern: regex.Pattern) -> bytes:
    """Ids of a whole text as little-endian 32-bit bytes."""
    if len(text) < WORDS_AT_ONCE:
        return b"".join(map(words.__getitem__, pattern.findall(text)))
    return b"".join(words[m.group()] for m in pattern.finditer(text))


def decode_ids(ids: bytes, pieces: list[bytes]) -> bytes:
    """Bytes of a sequence of ids: the binary pieces one after the other."""
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _worker(shared, decode: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pieces, pattern = _tools(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                ids = [encode_text(x.as_py() or "", words, pattern) for x in rows.column(1)]
                out = [rows.column(0), pa.array(ids, pa.binary())]
                if decode:
                    out.append(pa.array([decode_ids(x, pieces) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "ids", "decoded"][: len(out)])

    return run


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False, ahead: bool = False
) -> DataFrame:
    """(doc_id, ids[, decoded]) for every row: ids as little-endian 32-bit bytes, optionally decoded again.

    The rank file is read by the driver and broadcast with the frequent words (their size is bounded, whatever the
    corpus). Each match of the pattern is encoded by itself, each distinct word once per worker.
    With ``ahead`` frequent words are folded by ``fold_words`` first (its literal map needs a few hundred MB of
    driver heap over repeated calls); without it the workers fold all words themselves. The result is the same.
    Null and empty texts give empty binaries; repeated rows and null ids are kept; extra columns
    are ignored; an empty table gives none.
    """
    ranks = read_ranks(ranks_path)
    value = {"name": f"{ranks_path}\n{pattern}\n{len(ranks)}", "tokens": list(ranks), "ids": list(ranks.values()), "pattern": pattern}
    value["words"] = frequent_words(docs, ranks, pattern, id_col, text_col) if ahead else {}
    value["name"] += f"\n{zlib.crc32(repr(value['words']).encode())}"
    shared = docs.sparkSession.sparkContext.broadcast(value)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_worker(shared, decode), f"doc_id {id_type}, ids binary" + ", decoded binary" * decode)


def _matches(text: str | None, pattern: regex.Pattern) -> Iterable[str]:
    """All matches in a text; those of a long one are not held at once."""
    if text is None or len(text) < WORDS_AT_ONCE:
        return pattern.findall(text or "")
    return (m.group() for m in pattern.finditer(text))


def _distinct_words(pattern: str) -> Callable:
    """(part, text) to distinct words and the parts they occur in; a word may come again with other parts, or the same."""

    def sent(seen: dict[int, set[str]]) -> Iterator[pa.RecordBatch]:
        parts_of: dict[str, list[int]] = {}
        for part, words in seen.items():
            for word in words:
                parts_of.setdefault(word, []).append(part)
        words, parts = list(parts_of), list(parts_of.values())
        for at in range(0, len(words), 1 << 14):
            columns = [pa.array(words[at : at + (1 << 14)], pa.string()), pa.array(parts[at : at + (1 << 14)], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["word", "parts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        seen: dict[int, set[str]] = {}
        held = 0
        for batch in batches:
            for part, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = seen.setdefault(part, set())
                before = len(words)
                words.update(_matches(text.as_py(), compiled))
                held += len(words) - before
                if held >= GATHERED:
                    yield from sent(seen)
                    seen, held = {}, 0
        yield from sent(seen)

    return run


def _token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    """Token bytes by id."""
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        pieces[i] = token
    return pieces


def _put_together(shared, pattern: str, decode: bool) -> Callable:
    """(part, word, ids, doc_id, text), of every part the words first, to the ids of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled, pieces = regex.compile(pattern), shared.value
        known: dict[str, bytes] = {}
        current = None
        for batch in batches:
            kinds = np.column_stack([batch.column(0).to_numpy(), batch.column(1).is_valid().to_numpy(zero_copy_only=False)])
            cuts = np.flatnonzero((kinds[1:] != kinds[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if start == stop:
                    continue
                rows, (part, words) = batch.slice(start, stop - start), kinds[start].tolist()
                if part != current:
                    known, current = {}, part
                if words:
                    data = rows.column(2).flatten().to_numpy().astype("<u4").tobytes()
                    ends = (np.cumsum(rows.column(2).value_lengths().to_numpy()) * 4).tolist()
                    known.update(zip(rows.column(1).to_pylist(), (data[a:b] for a, b in zip([0, *ends], ends))))
                    continue
                for at in range(0, rows.num_rows, 256):
                    some = rows.slice(at, 256)
                    ids = [b"".join(map(known.__getitem__, _matches(x.as_py(), compiled))) for x in some.column(4)]
                    out = [some.column(3), pa.array(ids, pa.binary())]
                    if decode:
                        out.append(pa.array([decode_ids(x, pieces) for x in ids], pa.binary()))
                    yield pa.RecordBatch.from_arrays(out, ["doc_id", "ids", "decoded"][: len(out)])

    return run


def encode_by_words(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False
) -> DataFrame:
    """The rows of ``encode``, all merges being folded by higher-order functions over distinct words.

    Documents are dealt by a hash into groups of about GROUP_BYTES; every
    distinct word of the corpus is folded once by ``fold_words`` and its ids go to the groups that hold it, so that
    a task's memory is that of one group's distinct words. ``docs`` is read three times (size, words, texts).
    """
    ranks = read_ranks(ranks_path)
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups = max(-(-size // GROUP_BYTES), context.defaultParallelism)
    rows = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int").alias("part"), "doc_id", "text")
    words = rows.select("part", "text").mapInArrow(_distinct_words(pattern), "word string, parts array<int>")
    words = words.groupBy("word").agg(F.array_distinct(F.flatten(F.collect_list("parts"))).alias("parts"))
    coded = fold_words(words, ranks).select(F.explode("parts").alias("part"), "word", "ids")
    both = coded.unionByName(rows, allowMissingColumns=True).select("part", "word", "ids", "doc_id", "text")
    both = both.repartitionById(groups, "part").sortWithinPartitions("part", F.col("word").isNull())
    shared = context.broadcast(_token_bytes(ranks) if decode else [])
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return both.mapInArrow(_put_together(shared, pattern, decode), f"doc_id {id_type}, ids binary" + ", decoded binary" * decode)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary) to rows with ids as little-endian 32-bit bytes; null ids give null."""
    ranks = read_ranks(ranks_path)
    value = {"name": f"{ranks_path}\n\n{len(ranks)}", "tokens": list(ranks), "ids": list(ranks.values()), "pattern": ""}
    shared = encoded.sparkSession.sparkContext.broadcast(value)
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, pieces, _ = _tools(shared)
        for batch in batches:
            texts = [None if x is None else decode_ids(x, pieces) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "decoded"])

    fields = [*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]
    return encoded.mapInArrow(run, T.StructType(fields))
