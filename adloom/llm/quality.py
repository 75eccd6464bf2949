"""Quality rules by repetition coverage: rolling hashes of several n-gram lengths, and of lines."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import mix, powers, slices, utf8

#: Base rules: least words; share of words in repeated windows of so many words.
LEAST_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30
#: The method's rules: most characters (share of all word characters) inside duplicated n-grams, by n, and inside
#: repetitions of lines.
NGRAM_SHARES = {5: 0.40, 6: 0.38, 7: 0.36, 8: 0.34, 9: 0.32, 10: 0.30}
LINE_SHARE = 0.30
BASE, WORD_BASE, SLICE = 0x100000001B3, 0x9E3779B97F4A7C15 | 1, 1 << 22

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]
FIELDS += [f"dup_chars_{n}" for n in NGRAM_SHARES]


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values between consecutive bounds."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _checked(keys: np.ndarray, same: Callable, names: Callable) -> np.ndarray:
    """The hashes, if equal ones stand for equal things (``same``, asked of neighbours in sorted order); else exact ``names``."""
    order = np.argsort(keys, kind="stable")
    pair = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    return keys if same(order[pair + 1], order[pair]).all() else names().astype(np.uint64)


def _checked_columns(keys: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """The same for rows of numbers."""

    def same(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.logical_and.reduce([c[i] == c[j] for c in columns])

    return _checked(keys, same, lambda: np.unique(np.stack(columns, axis=1), axis=0, return_inverse=True)[1].ravel())


def _checked_bytes(keys: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The same for runs of bytes, compared byte by byte."""

    def same(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        if not len(i) or (sizes[i] != sizes[j]).any():
            return sizes[i] == sizes[j]
        before = np.cumsum(sizes[i]) - sizes[i]
        place = np.arange(int(sizes[i].sum())) - np.repeat(before, sizes[i])
        return data[np.repeat(starts[i], sizes[i]) + place] == data[np.repeat(starts[j], sizes[i]) + place]

    def names() -> np.ndarray:
        known: dict[bytes, int] = {}
        raw = data.tobytes()
        return np.array([known.setdefault(raw[a : a + n], len(known)) for a, n in zip(starts.tolist(), sizes.tolist())], np.uint64)

    return _checked(keys, same, names)


def _segments(data: np.ndarray, inner: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, hash, code points) of segments: runs of bytes flagged ``inner`` that begin where ``first`` is set.

    Equal hashes are compared by their bytes: a polynomial modulo a power of two is equal for some different long texts.
    """
    at = np.flatnonzero(inner)
    begins = np.flatnonzero(first[at])
    if not len(begins):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sizes = np.diff(np.append(begins, len(at)))
    place = np.arange(len(at)) - np.repeat(begins, sizes)
    own = data[at]
    values = (own.astype(np.uint64) + np.uint64(1)) * powers(BASE, int(sizes.max()))[place]
    hashes = mix(np.add.reduceat(values, begins) + sizes.astype(np.uint64))
    hashes = _checked_bytes(hashes, data, at[begins], sizes)
    return at[begins], hashes, np.add.reduceat(((own & 0xC0) != 0x80).astype(np.int64), begins)


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs twice or more, and whether it occurred before (first in order)."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    many, again = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:]] = same
    many[order[1:]] = same
    many[order[:-1]] |= same
    return many, again


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All measures of whole texts, given as one byte array and offsets; long integers, one per text."""
    n, size = len(offsets) - 1, len(data)
    border = np.zeros(size + 1, bool)
    border[offsets] = True
    space = _SPACE[data]
    first = ~space & (border[:-1] | np.concatenate([[True], space[:-1]]))
    starts, words, chars = _segments(data, ~space, first)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    bounds = np.searchsorted(starts, offsets)
    out = {
        "n_words": np.diff(bounds),
        "word_chars": _per_row(chars, bounds),
        "n_symbols": _per_row(_SYMBOL[data], offsets),
    }
    newline = data == 0x0A
    line_first = ~newline & (border[:-1] | np.concatenate([[True], newline[:-1]]))
    line_starts, lines, line_chars = _segments(data, ~newline, line_first)
    line_ends = np.append(line_starts[1:], size)
    worded = np.concatenate([[0], np.cumsum(~space)])
    worded = worded[line_ends] > worded[line_starts]
    line_starts, lines, line_chars = line_starts[worded], lines[worded], line_chars[worded]
    line_owner = np.searchsorted(offsets, line_starts, side="right") - 1
    _, again = _repeated(_checked_columns(mix(lines + mix(line_owner.astype(np.uint64))), [lines, line_owner]))
    line_bounds = np.searchsorted(line_starts, offsets)
    out["n_dup_lines"] = _per_row(again, line_bounds)
    out["dup_line_chars"] = _per_row(np.where(again, line_chars, 0), line_bounds)
    # n-grams from short to long: a longer one can only repeat where both shorter ones inside it do.
    factors = powers(WORD_BASE, max(NGRAM_SHARES) + 1)
    candidates, salt = np.arange(len(words)), mix(owner.astype(np.uint64) + np.uint64(7))
    shortest = min(NGRAM_SHARES)
    for k in NGRAM_SHARES:
        candidates = candidates[candidates + k <= len(words)]
        candidates = candidates[owner[candidates] == owner[candidates + k - 1]] if len(candidates) else candidates
        grams = np.zeros(len(candidates), np.uint64)
        for j in range(k):
            grams += words[candidates + j] * factors[j]
        keys = _checked_columns(mix(grams) + salt[candidates], [owner[candidates], *(words[candidates + j] for j in range(k))])
        many, _ = _repeated(keys)
        candidates = candidates[many]
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, candidates, 1)
        np.add.at(cover, candidates + k, -1)
        inside = np.cumsum(cover)[:-1] > 0
        out[f"dup_chars_{k}"] = _per_row(np.where(inside, chars, 0), bounds)
        if k == REPEAT_WINDOW:
            out["n_repeat_words"] = _per_row(inside, bounds)
        if k >= shortest and len(candidates):
            flags = np.zeros(len(words) + 1, bool)
            flags[candidates] = True
            candidates = candidates[flags[candidates + 1]]
    return {name: out[name].astype(np.int64) if len(out[name]) else np.zeros(n, np.int64) for name in FIELDS}


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for a, b in slices(offsets, SLICE):
            found = measure(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            columns = [batch.column(0).slice(a, b - a), *[pa.array(found[name]) for name in FIELDS]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *FIELDS])


def rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, measures, base_failed, kept) for every row.

    Words are runs of other than ASCII white space; lines are split at \\n and count if they hold
    a word. ``dup_chars_n`` counts the characters of words inside n-grams that occur twice or more in the text, the
    first included; ``dup_line_chars`` the characters of lines equal to an earlier one. A text is kept if no base rule
    and no share fails. Null and empty texts have all measures 0 and fail; repeated rows and null
    ids are kept as rows; extra columns are ignored; an empty table gives none. Texts are measured whole.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(_batches, "doc_id long, " + ", ".join(f"{name} long" for name in FIELDS))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    repeats = F.col("dup_line_chars") > LINE_SHARE * F.col("word_chars")
    for n, share in NGRAM_SHARES.items():
        repeats = repeats | (F.col(f"dup_chars_{n}") > share * F.col("word_chars"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & ~repeats)
