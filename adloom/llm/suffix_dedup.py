"""Removal of repeated byte strings by sorting suffixes, deep and shallow.

A string of 100 bytes contains 77 substrings of 24 bytes; the one with the least hash (the leftmost of equals) is
its anchor. Equal strings have equal anchors at the same place, so only suffixes around anchors that occur
twice need sorting, and they need sorting only among those of the same anchor. Consecutive starts with one anchor form a run, which
travels as one piece of text. Anchors with very many runs are not sorted in one task: the strings around them are dealt
out by their own hash, and the least start of each is found by a grouping. Copies of whole documents are set aside before: all they hold starts earlier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adloom.llm.common import mix, powers, slices, utf8

#: Bytes of a repeated string, starts that compete for an anchor, bytes of an anchor.
LENGTH, STARTS = 100, 77
ANCHOR = LENGTH - STARTS + 1
#: Rows without an id carry a hash of their text as ``k`` and count ``n`` from here; they come after all others.
NO_ID = 1 << 30
#: Bytes hashed together; words of 8 bytes that the shallow sort looks at; rows solved together.
PLACES = 1 << 20
SHALLOW = 3
AT_ONCE = 20_000
#: Runs of one anchor that one task may sort; more of them are split by the strings they hold.
MOST_RUNS = 20_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _chunk_runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first start, last start, anchor, hash) of the runs in at most PLACES bytes; ``ends`` are the texts' ends."""
    n = len(data)
    if n < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=total[1:])
    hashes = mix((total[ANCHOR:] - total[:-ANCHOR]) * powers(_INVERSE, n - ANCHOR + 1))
    low = np.uint64(PLACES - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while reach < STARTS:
        step = min(reach, STARTS - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    anchor = (least & low).astype(np.int64)
    shut = np.zeros(n + 1, np.int64)
    np.add.at(shut, np.maximum(ends - LENGTH + 1, 0), 1)
    np.add.at(shut, ends, -1)
    valid = np.cumsum(shut)[: len(anchor)] == 0
    change = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | ~valid[:-1]])
    first = np.flatnonzero(valid & change)
    last_change = np.concatenate([(anchor[1:] != anchor[:-1]) | ~valid[1:], [True]])
    last = np.flatnonzero(valid & last_change)
    return first, last, anchor[first], hashes[anchor[first]]


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first start, last start, anchor, hash) of all runs of all texts; places count from the text's start."""
    parts = []
    for a, b in slices(offsets, PLACES // 2):
        begin, end = int(offsets[a]), int(offsets[b])
        step = PLACES - LENGTH
        for at in range(begin, max(end - LENGTH + 1, begin + 1), step):
            stop = min(at + PLACES - 1, end)
            first, last, anchor, hashes = _chunk_runs(data[at:stop], np.minimum(offsets[a + 1 : b + 1], stop) - at)
            row = np.searchsorted(offsets, first + at, side="right") - 1
            shift = at - offsets[row]
            parts.append((row, first + shift, last + shift, anchor + shift, hashes))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (k, n, text) to their runs. One run of each anchor and batch asks under the anchor's hash whether
    it occurs elsewhere, and tells how many it stands for; the batch's others are known to repeat (2 runs) and are dealt out evenly."""
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        row, first, last, anchor, hashes = runs(data, offsets)
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        again, runs_of = np.zeros(len(row), bool), np.full(len(row), 2, np.int64)
        again[order[1:]] = same
        heads = np.flatnonzero(~again[order])
        runs_of[order[heads]] = np.diff(np.append(heads, len(row)))
        k = batch.column(0).to_numpy()[row]
        route = np.where(again, mix(mix(k.view(np.uint64)) + anchor.astype(np.uint64)), hashes)
        run = first << 15 | (anchor - first) << 8 | (last - first) << 1
        columns = [route.view(np.int64), k, batch.column(1).to_numpy()[row], run, runs_of]
        for at in range(0, len(row), 1 << 16):
            part = [pa.array(c[at : at + (1 << 16)]) for c in columns]
            yield pa.RecordBatch.from_arrays(part, ["route", "k", "n", "run", "runs"])


def _large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs (route, k, n, run, runs, total) to their hashes. Reading all columns keeps the shuffle below the same as that of the hits."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pc.unique(batch.column(0))], ["large"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (k, n, text, hits) to the text pieces of their repeated runs. Of equal pieces in a batch only the earliest
    is compared further; all later ones are removed whole (piece null)."""
    powered = powers(_BASE, ANCHOR)
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        numbers, keys = batch.column(1).to_numpy(), batch.column(0).to_numpy()
        hits = batch.column(3)
        own, places = np.asarray(hits.flatten().field(0)), np.asarray(hits.flatten().field(1))
        counts = np.diff(hits.offsets.to_numpy())
        row = np.repeat(np.arange(batch.num_rows), counts)
        mine = own == numbers[row]
        row, places = row[mine], places[mine]
        first, off, span = places >> 15, places >> 8 & 127, places >> 1 & 127
        order = np.lexsort((first, numbers[row], keys[row], numbers[row] > NO_ID))
        row, first, off, span = row[order], first[order], off[order], span[order]
        base = offsets[row] + first
        hashes = np.zeros(len(row), np.uint64)
        for j in range(ANCHOR):
            hashes += (data[base + off + j].astype(np.uint64) + np.uint64(1)) * powered[j]
        hashes = mix(hashes)
        raw, seen, texts = data.tobytes(), set(), []
        repeats = np.zeros(len(row), bool)
        for i, (at, end, o) in enumerate(zip(base.tolist(), (base + span + LENGTH).tolist(), off.tolist(), strict=True)):
            text = raw[at:end]
            if (o, text) in seen:
                repeats[i] = True
                texts.append(None)
            else:
                seen.add((o, text))
                texts.append(text)
        # Removed runs that touch travel as one.
        end = first + span + LENGTH
        joined = np.concatenate([[False], repeats[1:] & repeats[:-1] & (row[1:] == row[:-1]) & (first[1:] <= end[:-1])]) if len(row) else repeats
        heads = np.flatnonzero(~joined)
        last = np.append(heads[1:], len(row)) - 1
        span = np.where(repeats[heads], end[last] - first[heads] - LENGTH, span[heads])
        row, first, off, hashes, repeats = row[heads], first[heads], off[heads], hashes[heads], repeats[heads]
        texts = [texts[i] for i in heads.tolist()]
        route = np.where(repeats, mix(mix(keys[row].view(np.uint64)) + first.astype(np.uint64)), hashes)
        columns = [route.view(np.int64), hashes.view(np.int64), keys[row], numbers[row], first, off, span]
        for at in range(0, len(row), 1 << 15):
            part = [pa.array(c[at : at + (1 << 15)]) for c in columns] + [pa.array(texts[at : at + (1 << 15)], pa.binary())]
            yield pa.RecordBatch.from_arrays(part, ["route", "hash", "k", "n", "first", "off", "span", "piece"])


def blind_trie(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of strings of equal length, and the common prefix of each with the one before (0 for the first).

    Nodes keep only the place at which their strings first differ. A string walks down by those places
    alone, is compared once with the leaf it ends at, and is put in where the two differ. Equal strings share a leaf.
    """
    size = len(strings[0])
    root = None  # a leaf [string, number, members] or a node (place, children by byte)
    for i, s in enumerate(strings):
        number = int.from_bytes(s, "big")
        if root is None:
            root = [s, number, [i]]
            continue
        path, at = [], root
        while type(at) is tuple:
            path.append(at)
            at = at[1].get(s[at[0]]) or next(iter(at[1].values()))
        common = size - ((number ^ at[1]).bit_length() + 7) // 8
        if common == size:
            at[2].append(i)
            continue
        leaf = [s, number, [i]]
        depth = 0
        while depth < len(path) and path[depth][0] < common:
            depth += 1
        below = path[depth] if depth < len(path) else at
        if type(below) is tuple and below[0] == common:
            below[1][s[common]] = leaf
            continue
        node = (common, {at[0][common]: below, s[common]: leaf})
        if depth:
            path[depth - 1][1][s[path[depth - 1][0]]] = node
        else:
            root = node
    order, prefixes, waiting = [], [], [(root, 0)]
    while waiting:
        at, common = waiting.pop()
        if type(at) is tuple:
            children = sorted(at[1].items(), reverse=True)
            waiting += [(child, at[0]) for _, child in children[:-1]]
            waiting.append((children[-1][1], common))
            continue
        order += at[2]
        prefixes += [common] + [size] * (len(at[2]) - 1)
    return order, prefixes


def deep_shallow(group: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows of bytes inside their groups: (order, common prefix with the row before; -1 where a group begins).

    Shallow: multikey quicksort, words of 8 bytes being its characters, partitions all groups that are still tied
    word by word. Deep: groups still tied after SHALLOW words have long common prefixes and go to a blind trie each.
    """
    n, size = rows.shape
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    fresh = np.concatenate([[True], group[order][1:] != group[order][:-1]])
    prefixes = np.where(fresh, -1, size)
    for d in range(min(SHALLOW, words.shape[1])):
        tied = ~fresh | np.append(~fresh[1:], False)
        at = np.flatnonzero(tied)
        if not len(at):
            break
        name = np.cumsum(fresh)[at]
        inner = np.lexsort((words[order[at], d], name))
        order[at] = order[at][inner]
        here = words[order[at], d]
        differs = np.concatenate([[False], (here[1:] != here[:-1]) & (name[1:] == name[:-1])])
        where = at[differs]
        both = rows[order[where], 8 * d : 8 * d + 8] != rows[order[where - 1], 8 * d : 8 * d + 8]
        prefixes[where] = 8 * d + both.argmax(axis=1)
        fresh[where] = True
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.append(starts, n))
    for start, count in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        members = order[start : start + count]
        inner, common = blind_trie([rows[i].tobytes() for i in members.tolist()])
        order[start : start + count] = members[inner]
        prefixes[start + 1 : start + count] = common[1:]
    return order, prefixes


def repeated(rows: dict[str, np.ndarray | list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the strings of LENGTH bytes that start earlier in another row, joined where they touch.

    Rows are pieces around anchors: hash, order of the document (rank), first start, off (anchor - first), span (last - first), piece.
    Suffixes from the anchor on and the reversed texts before it are sorted; strings that start x bytes before
    their anchor are equal if the suffixes share LENGTH - x bytes and the reversed texts x.
    """
    n = len(rows["hash"])
    tail = np.zeros((n, (LENGTH + 7) // 8 * 8), np.uint8)
    head = np.zeros((n, (STARTS + 7) // 8 * 8), np.uint8)
    for i, (piece, off) in enumerate(zip(rows["piece"], rows["off"].tolist(), strict=True)):
        data = np.frombuffer(piece, np.uint8)
        tail[i, : len(data) - off] = data[off:]
        head[i, :off] = data[:off][::-1]
    group = np.unique(rows["hash"], return_inverse=True)[1]
    tails, tail_common = deep_shallow(group, tail)
    heads, head_common = deep_shallow(group, head)
    most, least = rows["off"], rows["off"] - rows["span"]
    rank = np.empty(n, np.int64)
    rank[np.lexsort((rows["first"] + rows["off"], rows["rank"]))] = np.arange(n)
    found_row, found_x = [], []
    tail_class, head_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for x in range(STARTS):
        at = np.flatnonzero((least <= x) & (x <= most))
        if len(at) < 2:
            continue
        tail_class[tails] = np.cumsum(tail_common < LENGTH - x)
        head_class[heads] = np.cumsum(head_common < x)
        name = tail_class[at] * (n + 1) + head_class[at]
        order = np.lexsort((rank[at], name))
        later = order[1:][name[order][1:] == name[order][:-1]]
        found_row.append(at[later])
        found_x.append(np.full(len(later), x))
    row, x = np.concatenate([*found_row, np.zeros(0, np.int64)]), np.concatenate([*found_x, np.zeros(0, np.int64)])
    order = np.lexsort((-x, row))
    row, x = row[order], x[order]
    if not len(row):
        return row, x, x
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (x[1:] != x[:-1] - 1)])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(row)) - 1
    anchor = (rows["first"] + rows["off"])[row[begin]]
    return row[begin], anchor - x[begin], anchor - x[end] + LENGTH


def _solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
    k, n, first, off, span, hashes = (table[c].to_numpy() for c in ("k", "n", "first", "off", "span", "hash"))
    whole = table["piece"].is_null().to_numpy()
    out = [(k[whole], n[whole], first[whole], first[whole] + span[whole] + LENGTH)]
    # Only hashes with two pieces or more can repeat anything.
    left = np.flatnonzero(~whole)
    _, inverse, counts = np.unique(hashes[left], return_inverse=True, return_counts=True)
    left = left[counts[inverse] > 1]
    if len(left):
        rank = np.empty(len(left), np.int64)
        order = np.lexsort((n[left], k[left], n[left] > NO_ID))
        new = (k[left][order][1:] != k[left][order][:-1]) | (n[left][order][1:] != n[left][order][:-1])
        rank[order] = np.concatenate([[0], np.cumsum(new)])
        pieces = table["piece"].take(pa.array(left)).to_pylist()
        row, start, end = repeated(
            {"hash": hashes[left], "rank": rank, "first": first[left], "off": off[left], "span": span[left], "piece": pieces}
        )
        out.append((k[left][row], n[left][row], start, end))
    columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
    if len(columns[0]):
        yield pa.RecordBatch.from_arrays(columns, ["k", "n", "start", "end"])


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of split anchors to the digests of all strings of LENGTH bytes in them, with their starts."""
    for batch in batches:
        batch = batch.filter(pc.and_(batch.column(8), pc.is_valid(batch.column(7))))
        for at in range(0, batch.num_rows, 1 << 10):
            part = batch.slice(at, 1 << 10)
            span = part.column(6).to_numpy()
            digests = [
                hashlib.blake2b(piece[i : i + LENGTH], digest_size=16).digest()
                for piece, last in zip(part.column(7).to_pylist(), span.tolist(), strict=True)
                for i in range(last + 1)
            ]
            row = np.repeat(np.arange(part.num_rows), span + 1)
            start = part.column(4).to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(span + 1) - span - 1, span + 1)
            columns = [pa.array(digests, pa.binary()), part.column(2).take(pa.array(row)), part.column(3).take(pa.array(row)), pa.array(start)]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "k", "n", "start"])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a partition, sorted by hash, to removed spans; whole hashes are solved some thousands of rows at a time.
    Of split anchors only the pieces that are known to be removed whole are solved here."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        batch = batch.filter(pc.invert(pc.and_(batch.column(8), pc.is_valid(batch.column(7)))))
        if not batch.num_rows:
            continue
        waiting.append(batch)
        held += batch.num_rows
        if held < AT_ONCE:
            continue
        table = pa.Table.from_batches(waiting)
        hashes = table["hash"].to_numpy()
        other = np.flatnonzero(hashes != hashes[-1])
        end = int(other[-1]) + 1 if len(other) else 0
        if end:
            yield from _solve(table.slice(0, end))
            waiting = table.slice(end).combine_chunks().to_batches()
            held = table.num_rows - end
    if waiting:
        yield from _solve(pa.Table.from_batches(waiting))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (k, n, text, copy, spans) to what is removed and what is left."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        raw = memoryview(data)
        numbers, copies = batch.column(1).to_numpy(), batch.column(3).to_pylist()
        kept, lists = [], []
        for row, found in enumerate(batch.column(4)):
            low, high = int(offsets[row]), int(offsets[row + 1])
            merged = [[0, high - low]] if copies[row] and high - low >= LENGTH else []
            for n, start, end in sorted((s["n"], s["start"], s["end"]) for s in found.as_py() or ()):
                if n != numbers[row]:
                    continue
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            at, parts = 0, []
            for start, end in merged:
                parts.append(raw[low + at : low + start])
                at = end
            parts.append(raw[low + at : high])
            kept.append(b"".join(parts))
            lists.append([{"start": s, "end": e} for s, e in merged])
        columns = [batch.column(0), pa.array(np.diff(offsets)), pa.array(lists, span), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["k", "n_bytes", "spans", "kept"])


def _dealt(texts: DataFrame) -> DataFrame:
    """Texts (k, n, text, copy) to the pieces of their repeated runs, dealt out by hash; those of split anchors by their place."""
    asked = texts.where("not copy").select("k", "n", "text").mapInArrow(_candidates, "route long, k long, n int, run long, runs long")
    asked = asked.withColumn("total", F.sum("runs").over(Window.partitionBy("route")))
    # At most one anchor in MOST_RUNS runs, 8 bytes each.
    large = F.broadcast(asked.where(F.col("total") > MOST_RUNS).mapInArrow(_large, "large long").distinct())
    hits = asked.where("total > 1")
    hits = hits.groupBy("k").agg(F.collect_list(F.struct("n", "run")).alias("hits"))
    pieces = texts.join(hits, "k").select("k", "n", "text", "hits").mapInArrow(
        _pieces, "route long, hash long, k long, n int, first long, off long, span long, piece binary"
    )
    pieces = pieces.join(large, F.col("hash") == F.col("large"), "left").withColumn("split", F.col("large").isNotNull()).drop("large")
    route = F.when(F.col("split"), F.xxhash64("route", "k", "first")).otherwise(F.col("route"))
    # Both uses of the dealt pieces read all columns, so Spark shuffles them once.
    return pieces.withColumn("route", route).repartition("route")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for every row: each byte inside a string of 100 bytes that also starts earlier is removed.

    Earlier means a smaller doc_id, or the same document and an earlier start. Strings never cross
    documents; overlaps count; strings are judged on the input. ``spans`` are the removed runs of bytes,
    ``kept`` the other bytes, which may cut characters.

    Defined cases: a null text is empty; texts below 100 bytes stay whole; rows that share a doc_id are documents of their
    own, ordered by text; rows without an id come last, ordered by a hash of the text; an empty table gives none. Extra columns are ignored.
    A passage shared by any number of documents costs one row per task and variant, as equal pieces
    are merged before they travel, and above MOST_RUNS runs no task holds all variants; copies of whole
    texts (equal length and SHA-256) go no further than that.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    known = F.col(id_col).cast("long")
    plain = docs.select(F.coalesce(known, F.xxhash64(text)).alias("k"), known.isNull().alias("absent"), text.alias("text"))
    # Later copies of whole texts, by digest: narrow rows only.
    digests = plain.where(F.octet_length("text") >= LENGTH).select("k", "absent", F.sha2("text", 256).alias("digest"))
    # Least (absent, k) by two plain minima, as those are combined by hash before they travel.
    known_k = F.when(~F.col("absent"), F.col("k"))
    firsts = digests.groupBy("digest").agg(F.min(known_k).alias("first"), F.min("k").alias("first_absent"), F.count("*").alias("many")).where("many > 1")
    after = F.when(F.col("absent"), F.col("first").isNotNull() | (F.col("k") > F.col("first_absent"))).otherwise(F.col("k") > F.col("first"))
    later = digests.join(firsts.drop("many"), "digest").where(after)
    later = later.groupBy("k").agg(F.collect_set(F.concat("absent", "digest")).alias("copied"))
    by_id = Window.partitionBy("k").orderBy("absent", "text")
    same_before = F.coalesce(F.lag("text").over(by_id) == F.col("text"), F.lit(False))
    # All three uses below read the same columns, so Spark shuffles the texts once.
    number = F.row_number().over(by_id) + F.when(F.col("absent"), NO_ID).otherwise(0)
    texts = plain.select("k", "absent", number.alias("n"), "text", same_before.alias("again")).join(later, "k", "left")
    copied = F.when(F.col("copied").isNotNull(), F.array_contains("copied", F.concat("absent", F.sha2("text", 256)))).otherwise(F.lit(False))
    texts = texts.select("k", "n", "text", (F.col("again") | copied).alias("copy"))
    pieces = _dealt(texts)
    spans = pieces.sortWithinPartitions("hash").mapInArrow(_spans, "k long, n int, start long, end long")
    starts = pieces.mapInArrow(_starts, "digest binary, k long, n int, start long")
    place = F.struct((F.col("n") > NO_ID).alias("absent"), "k", "n", "start")
    least = starts.groupBy("digest").agg(F.min(place).alias("least"), F.count("*").alias("many")).where("many > 1")
    later = starts.join(least.select("digest", "least"), "digest").where(place > F.col("least"))
    spans = spans.unionByName(later.select("k", "n", "start", (F.col("start") + LENGTH).alias("end")))
    spans = spans.groupBy("k").agg(F.collect_list(F.struct("n", "start", "end")).alias("spans"))
    doc_id = F.when(F.col("n") < NO_ID, F.col("k")).alias("k")
    out = texts.join(spans, "k", "left").select(doc_id, "n", "text", "copy", "spans")
    out = out.mapInArrow(_remove, "k long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return out.select(F.col("k").alias("doc_id"), "n_bytes", "spans", "kept")
