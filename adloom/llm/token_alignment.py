"""Alignment of two tokenizers, with corpus counts of linked id pairs by minimal perfect hashing.

Offsets at which tokens of both end cut a text into groups; every A token of a group is linked to every B token of it.
The first pass encodes each text once, stores its ids, and collects the distinct linked pairs. Each shard of the pairs
gets a minimal perfect hash: a pair's index in a dense vector of counts. Tasks turn their partial counts into such
vectors, which are summed in a tree. The second pass aligns the stored ids again and looks the counts up, the pair
found at an index compared with the pair asked for.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adloom.llm.common import mix, spool

#: Texts encoded together, by characters, and stored ids aligned together; bounds a worker's memory beside the longest text.
CHARS_AT_ONCE, TOKENS_AT_ONCE = 1 << 18, 1 << 17
#: Links expanded together; a group of more links is counted by its distinct ids instead.
LINKS_AT_ONCE = 1 << 18
#: Rows of an Arrow batch turned into Python values together.
ROWS_AT_ONCE = 256
#: Partial counts a task holds before it hands them on.
HELD_PAIRS = 1 << 20
#: Distinct pairs of a shard, in the mean: the size of what is broadcast (about 13 bytes a pair) and of a dense vector.
SHARD_PAIRS = 1 << 21
#: Counts of a piece of a dense vector, the unit that the tree sums.
PIECE = 1 << 16
#: Runs of white space that the faster library refuses are left to the other one.
SPACES = re.compile(r"\s{20000}")


# --- tokenizers ---


def _byte_letters() -> dict[str, int]:
    """The letters that a byte-level vocabulary writes bytes with: printable Latin-1 stands for itself, others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevel:
    """A byte-level BPE vocabulary (JSON); texts are encoded without special tokens.

    Where merges stand in the order of their ids and nothing but the standard pattern splits texts,
    a library that works on ranks gives the same ids several times faster; it refuses very long
    runs of white space, which go to the vocabulary's own library, as all texts do otherwise.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            text = file.read()
        known = json.loads(text)
        letters = _byte_letters()
        special = {t["content"] for t in known.get("added_tokens", [])}
        vocabulary = known["model"]["vocab"]
        tokens = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        self.pieces = [b""] * (max([*vocabulary.values(), *(t["id"] for t in known.get("added_tokens", []))]) + 1)
        for token, i in tokens.items():
            self.pieces[i] = token
        self.path, self._own = path, None
        merges = [m.split(" ") if isinstance(m, str) else m for m in known["model"]["merges"]]
        ids = [vocabulary[a + b] for a, b in merges]
        split = known.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not known.get("normalizer")
        ranked = plain and ids == sorted(ids) and len(tokens) == 256 + len(ids) and not known["model"].get("ignore_merges")
        self.fast = tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=tokens, special_tokens={}) if ranked else None

    @property
    def own(self) -> Tokenizer:
        """The vocabulary's own library, loaded when it is first needed."""
        if self._own is None:
            self._own = Tokenizer.from_file(self.path)
            self._own.encode_special_tokens = True
        return self._own

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.fast is None:
            return [x.ids for x in self.own.encode_batch(texts, add_special_tokens=False)]
        return [
            self.own.encode(t, add_special_tokens=False).ids if len(t) >= 20000 and SPACES.search(t) else self.fast.encode_ordinary(t)
            for t in texts
        ]


class Pieces:
    """A sentence-piece model; it puts a space before a text by itself."""

    def __init__(self, path: str):
        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.own.get_piece_size()
        self.pieces = []
        for i in range(n):
            piece = self.own.id_to_piece(i)
            byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
            self.pieces.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode("utf-8"))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.own.encode(texts, num_threads=1)


_WORKER: dict = {}


def _tools(a_path: str, b_path: str, pattern: str) -> tuple[ByteLevel, Pieces]:
    """This worker's tokenizers, kept between tasks."""
    key = a_path, b_path, pattern
    if _WORKER.get("key") != key:
        _WORKER.update(key=key, tools=(ByteLevel(a_path, pattern), Pieces(b_path)))
    return _WORKER["tools"]


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows; an empty batch is one slice."""
    for batch in batches:
        for at in range(0, max(batch.num_rows, 1), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def token_bytes(ids: list[int], pieces: list[bytes]) -> bytes:
    return b"".join(map(pieces.__getitem__, ids))


def _width(n: int) -> str:
    return "<u2" if n <= 1 << 16 else "<u4"


# --- alignment ---


class Aligned:
    """Tokens of some texts, one after the other, cut into groups; ``of`` gives the text of each group."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], a_lengths: np.ndarray, b_lengths: np.ndarray):
        self.a = np.concatenate(a).astype(np.int64) if a else np.zeros(0, np.int64)
        self.b = np.concatenate(b).astype(np.int64) if b else np.zeros(0, np.int64)
        # Texts have the same bytes on both sides, so their ends are common offsets of the joined tokens too.
        a_end, b_end = np.cumsum(a_lengths[self.a]), np.cumsum(b_lengths[self.b])
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        self.a_stop, self.b_stop = np.searchsorted(a_end, ends) + 1, np.searchsorted(b_end, ends) + 1
        self.a_start, self.b_start = (np.r_[0, stop][:-1].astype(np.int64) for stop in (self.a_stop, self.b_stop))
        self.n_a, self.n_b = self.a_stop - self.a_start, self.b_stop - self.b_start
        self.sizes = [len(x) + len(y) for x, y in zip(a, b)]
        self.of = np.searchsorted(np.cumsum([len(x) for x in a]), self.a_start, side="right")

    def listed(self, words: list[str], n_a: int, n_b: int) -> list[str]:
        """Groups of every text as ``a1,a2|b1;a3|b2,b3``, put together from ``separated`` words."""
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        a, b = self.a.copy(), self.b + 2 * n_a
        a[self.a_stop - 1] += n_a
        b[self.b_stop - 1] += n_b
        codes[np.arange(len(a)) + np.repeat(self.b_start, self.n_a)] = a
        codes[np.arange(len(b)) + np.repeat(self.a_stop, self.n_b)] = b
        out, at = [], 0
        for n in self.sizes:
            out.append("".join(map(words.__getitem__, codes[at : at + n].tolist()))[:-1])
            at += n
        return out

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """All links in bounded portions, as (text, A id, B id, how many such links)."""
        n = self.n_a * self.n_b
        large = n > LINKS_AT_ONCE
        plain = np.flatnonzero(~large)
        total = np.cumsum(n[plain])
        at = 0
        while at < len(plain):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + LINKS_AT_ONCE, side="right")))
            g = plain[at:end]
            of = np.repeat(np.arange(len(g)), n[g])
            place = np.arange(len(of)) - np.repeat(np.cumsum(n[g]) - n[g], n[g])
            width = self.n_b[g][of]
            a, b = self.a[self.a_start[g][of] + place // width], self.b[self.b_start[g][of] + place % width]
            yield self.of[g][of], a, b, np.ones(len(of), np.int64)
            at = end
        for g in np.flatnonzero(large):
            a, times_a = np.unique(self.a[self.a_start[g] : self.a_stop[g]], return_counts=True)
            b, times_b = np.unique(self.b[self.b_start[g] : self.b_stop[g]], return_counts=True)
            step = max(1, LINKS_AT_ONCE // len(b))
            for at in range(0, len(a), step):
                one, times = a[at : at + step], times_a[at : at + step]
                yield np.full(len(one) * len(b), self.of[g]), np.repeat(one, len(b)), np.tile(b, len(one)), np.outer(times, times_b).ravel()


def separated(n_a: int, n_b: int) -> list[str]:
    """Decimal ids with what follows them in a list of groups: A ids inside and at the end of a group, then B ids likewise."""
    ends = (n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";")
    return [f"{i}{end}" for n, end in ends for i in range(n)]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by key."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.int64)


def _document_pairs(aligned: Aligned, n_b: int, n_pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (A id * n_b + B id) and how many of the texts hold each."""
    held = [np.unique(of * n_pairs + a * n_b + b) for of, a, b, _ in aligned.links()]
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A text may go on in the next portion.
    return np.unique((np.unique(np.concatenate(held)) if len(held) > 1 else held[0]) % n_pairs, return_counts=True)


def _portions(a: list[bytes], b: list[bytes], a_type: str, b_type: str) -> Iterator[tuple[int, int, list[np.ndarray], list[np.ndarray]]]:
    """Stored ids in portions (from, to, A ids, B ids) of bounded size."""
    at = 0
    while at < len(a):
        end, n = at, 0
        while end < len(a) and (end == at or n + len(a[end]) // 2 <= TOKENS_AT_ONCE):
            n += len(a[end]) // 2
            end += 1
        yield at, end, [np.frombuffer(x, a_type) for x in a[at:end]], [np.frombuffer(x, b_type) for x in b[at:end]]
        at = end


# --- minimal perfect hashing ---

#: Set bits of each byte.
_ONES = np.array([bin(x).count("1") for x in range(256)], np.int64)


class PerfectHash:
    """Keys to 0 .. n - 1 without gaps: in each level a key whose slot no other key has takes it, the others go on.

    An index is the number of taken slots before the key's own, over all levels.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []  # slots, taken ones packed by bits, ranks before each byte
        left, self.n = keys, 0
        while len(left):
            slots = -(-max(64, 2 * len(left)) // 8) * 8
            at = self._slot(left, len(self.levels), slots)
            taken = np.bincount(at, minlength=slots) == 1
            before = self.n + np.r_[0, np.cumsum(taken.reshape(-1, 8).sum(axis=1))[:-1]]
            self.levels.append((slots, np.packbits(taken, bitorder="little"), before.astype(np.int32)))
            self.n += int(taken.sum())
            left = left[~taken[at]]
            if len(self.levels) > 200:
                raise ValueError("repeated keys")

    @staticmethod
    def _slot(keys: np.ndarray, level: int, slots: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            hashed = mix(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1))
        return (hashed % np.uint64(slots)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; -1 or any index for keys that were not among those hashed, so compare the key found there."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (slots, packed, before) in enumerate(self.levels):
            at = self._slot(keys[open_], level, slots)
            byte, bit = packed[at >> 3], (at & 7).astype(np.uint8)
            taken = (byte >> bit) & 1 == 1
            lower = byte[taken] & ((np.uint8(1) << bit[taken]) - np.uint8(1))
            out[open_[taken]] = before[at[taken] >> 3] + _ONES[lower]
            open_ = open_[~taken]
            if not len(open_):
                break
        return out


# --- passes ---

def _encoder(a_path: str, b_path: str, pattern: str) -> Callable:
    """Ids of both tokenizers for every text, little-endian; empty where the joined bytes differ from the text's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _tools(a_path, b_path, pattern)
        a_type, b_type = _width(len(one.pieces)), _width(len(two.pieces))
        for batch in _few(batches):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                end, n = at, 0
                while end < len(texts) and (end == at or n + len(texts[end]) <= CHARS_AT_ONCE):
                    n += len(texts[end])
                    end += 1
                a_ids, b_ids = [], []
                some = texts[at:end]
                for text, a, b in zip(some, one.encode([" " + t for t in some]), two.encode(some)):
                    raw = b" " + text.encode("utf-8")
                    same = text and token_bytes(a, one.pieces) == raw and token_bytes(b, two.pieces) == raw
                    a_ids.append(np.array(a, a_type).tobytes() if same else b"")
                    b_ids.append(np.array(b, b_type).tobytes() if same else b"")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(a_ids, pa.binary()), pa.array(b_ids, pa.binary())], ["id", "a", "b"]
                )
                at = end

    return run


def _lengths(pieces: list[bytes]) -> np.ndarray:
    return np.array([len(p) for p in pieces], np.int64)


def _counter(shapes: dict) -> Callable:
    """(key, n): linked pairs of a task and in how many of its documents each occurs; in portions of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for batch in _few(batches):
            a, b = (batch.column(i).to_pylist() for i in (0, 1))
            for _, _, one, two in _portions(a, b, shapes["a_type"], shapes["b_type"]):
                found = _document_pairs(Aligned(one, two, shapes["a_lengths"], shapes["b_lengths"]), shapes["n_b"], shapes["n_pairs"])
                keys.append(found[0])
                counts.append(found[1])
                held += len(found[0])
                if held > HELD_PAIRS:
                    merged = _merged(keys, counts)
                    keys, counts, held = [merged[0]], [merged[1]], len(merged[0])
                    if held > HELD_PAIRS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(merged[0]), pa.array(merged[1])], ["key", "n"])
                        keys, counts, held = [], [], 0
        merged = _merged(keys, counts)
        yield pa.RecordBatch.from_arrays([pa.array(merged[0]), pa.array(merged[1])], ["key", "n"])

    return run


def _dense(shared) -> Callable:
    """(piece, counts): the partial counts of a task summed in one dense vector, cut into pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        perfect = shared.value
        vector, some = np.zeros(perfect.n, np.int64), False
        for batch in batches:
            if batch.num_rows:
                np.add.at(vector, perfect.index(batch.column(0).to_numpy()), batch.column(1).to_numpy())
                some = True
        for at in range(0, len(vector) if some else 0, PIECE):
            yield pa.RecordBatch.from_arrays(
                [pa.array([at // PIECE], pa.int32()), pa.array([vector[at : at + PIECE].tobytes()], pa.binary())], ["piece", "counts"]
            )

    return run


def _summer() -> Callable:
    """(piece, counts) summed by piece; rows come sorted by piece, so one piece is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, total = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["piece", "counts"])
        for batch in batches:
            for one, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                vector = np.frombuffer(counts.as_buffer(), "<i8")
                if one == piece:
                    total = total + vector
                    continue
                if piece is not None:
                    yield row()
                piece, total = one, vector
        if piece is not None:
            yield row()

    return run


def _of_shard(n_b: int, shard: int, shards: int) -> Callable:
    """The rows (key first) whose pairs belong to a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shard_of(batch.column(0).to_numpy() // n_b, shards) == shard))

    return run


def _looker(shared, shapes: dict, describe: bool) -> Callable:
    """Per document n_best and count_sum over its links whose A ids belong to the shard at hand; with ``describe``
    also its id, numbers of tokens, groups and links, and its groups as text."""

    def counted(aligned: Aligned, n: int) -> tuple[np.ndarray, np.ndarray]:
        value = shared.value
        perfect, keys, counts, best, n_b = value["hash"], value["keys"], value["counts"], value["best"], shapes["n_b"]
        n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for of, x, y, times in aligned.links():
            if value["shards"] > 1:
                mine = shard_of(x, value["shards"]) == value["shard"]
                of, x, y, times = of[mine], x[mine], y[mine], times[mine]
            asked = x * n_b + y
            index = perfect.index(asked)
            if (index < 0).any() or (keys[index] != asked).any():
                raise ValueError("a linked pair is not among the counted ones")
            count = counts[index]
            np.add.at(count_sum, of, count * times)
            np.add.at(n_best, of, np.where(count == best[x], times, 0))
        return n_best, count_sum

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes_of = len(shapes["a_lengths"]), len(shapes["b_lengths"])
        words = separated(*sizes_of) if describe else []
        for batch in _few(batches):
            a, b = (batch.column(i).to_pylist() for i in (2, 3))
            for at, end, one, two in _portions(a, b, shapes["a_type"], shapes["b_type"]):
                n = end - at
                aligned = Aligned(one, two, shapes["a_lengths"], shapes["b_lengths"])
                columns = [batch.column(0).slice(at, n), *map(pa.array, counted(aligned, n))]
                names = ["doc", "n_best", "count_sum"]
                if describe:
                    n_links = np.zeros(n, np.int64)
                    np.add.at(n_links, aligned.of, aligned.n_a * aligned.n_b)
                    groups = aligned.listed(words, *sizes_of)
                    sizes = [len(x) for x in one], [len(x) for x in two], np.bincount(aligned.of, minlength=n), n_links
                    columns += [batch.column(1).slice(at, n), *(pa.array(x, pa.int64()) for x in sizes), pa.array(groups, pa.string())]
                    names += ["id", "n_a", "n_b", "n_groups", "n_links", "groups"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def shard_of(a: np.ndarray, shards: int) -> np.ndarray:
    """The shard an A id's pairs belong to."""
    return (mix(a.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


def _tree_sum(partial: DataFrame, perfect: PerfectHash, vectors: int) -> DataFrame:
    """(piece, counts) of the whole corpus: ``vectors`` tasks add up dense vectors, whose pieces are summed in two further levels."""
    shape = "piece int, counts binary"
    shared = partial.sparkSession.sparkContext.broadcast(perfect)
    dense = partial.select("key", "n").coalesce(vectors).mapInArrow(_dense(shared), shape)
    branch = F.pmod(F.xxhash64("counts"), F.lit(max(1, math.isqrt(vectors))))
    some = dense.withColumn("branch", branch).repartition("piece", "branch").sortWithinPartitions("piece")
    some = some.select("piece", "counts").mapInArrow(_summer(), shape)
    return some.repartition("piece").sortWithinPartitions("piece").mapInArrow(_summer(), shape)


def align(
    docs: DataFrame, a_path: str, b_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) for every row.

    A is a byte-level BPE vocabulary file that encodes space + text, B a sentence-piece model that
    adds the space. ``groups`` lists the groups as ``a1,a2|b1;a3|b2,b3``. A pair's count is the number
    of documents (rows) with such a link; ``n_best`` are the links whose count no other pair of
    their A id exceeds, ``count_sum`` sums the counts over the links.

    Null and empty texts, and texts whose tokens do not give back their bytes, have no tokens:
    zeros and empty groups. Texts may have any length; a group of very many links is counted by its
    distinct ids. Repeated rows and null ids are kept as rows of their own, extra columns ignored;
    an empty table gives none. Both files are read by each worker from the same path.

    Shards bound what is broadcast and a dense vector's size; their number follows the counted
    distinct pairs, and each costs one more look at the stored ids, not another encoding.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    one, two = ByteLevel(a_path, pattern), Pieces(b_path)
    shapes = {
        "a_lengths": _lengths(one.pieces),
        "b_lengths": _lengths(two.pieces),
        "a_type": _width(len(one.pieces)),
        "b_type": _width(len(two.pieces)),
        "n_b": len(two.pieces),
        "n_pairs": len(one.pieces) * len(two.pieces),
    }
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    encoded = rows.mapInArrow(_encoder(a_path, b_path, pattern), f"id {kind}, a binary, b binary")
    stored = spool(encoded.withColumn("doc", F.monotonically_increasing_id()))
    partial = spool(stored.select("a", "b").mapInArrow(_counter(shapes), "key bigint, n bigint"))
    pairs = spool(partial.select("key").distinct())
    shards = -(-pairs.count() // SHARD_PAIRS) or 1
    looked = []
    for shard in range(shards):
        def mine(table: DataFrame, shard: int = shard) -> DataFrame:
            return table.mapInArrow(_of_shard(shapes["n_b"], shard, shards), table.schema) if shards > 1 else table

        keys = mine(pairs).toArrow().column("key").to_numpy()
        perfect = PerfectHash(keys)
        by_index = np.zeros(len(keys), np.int64)
        by_index[perfect.index(keys)] = keys
        vectors = max(1, math.isqrt(partial.rdd.getNumPartitions()))
        counts = np.zeros(len(keys), np.int64)
        for piece, part in _tree_sum(mine(partial), perfect, vectors).toLocalIterator():
            counts[piece * PIECE : (piece + 1) * PIECE] = np.frombuffer(part, "<i8")
        best = np.zeros(len(one.pieces), np.int64)
        np.maximum.at(best, by_index // shapes["n_b"], counts)
        shared = context.broadcast({"hash": perfect, "keys": by_index, "counts": counts, "best": best, "shard": shard, "shards": shards})
        own = "doc bigint, n_best bigint, count_sum bigint"
        if not shard:
            own += f", id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"
        looked.append(stored.select("doc", "id", "a", "b").mapInArrow(_looker(shared, shapes, not shard), own))
    out = looked[0]
    if shards > 1:
        sums = looked[1]
        for more in looked[2:]:
            sums = sums.unionByName(more)
        sums = sums.groupBy("doc").agg(F.sum("n_best").alias("__best"), F.sum("count_sum").alias("__sum"))
        out = out.join(sums, "doc").withColumns({"n_best": F.expr("n_best + __best"), "count_sum": F.expr("count_sum + __sum")})
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
