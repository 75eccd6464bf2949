"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import slices, utf8

BUCKETS = 1 << 15
WIDTHS = (3, 4, 5)
DIMENSIONS = 16
#: The training sample's bounds: documents per language, windows per document, bytes per window.
DOCS_PER_LANGUAGE = 300
WINDOWS = 6
WINDOW_BYTES = (12, 1500)
#: Share of right calibration windows that each rejection threshold may turn away; texts with fewer subwords are held
#: to a lower floor, as the mean of few varies more.
REJECTED = 0.002
FEW = 64
UNKNOWN = "und"

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:128] = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(128)]


@dataclass
class Model:
    """``table`` holds each bucket's logits (embedding times softmax weights); its last row is empty.

    ``typical`` holds each bucket's log frequency in the class against an even spread. Its mean over a text tells learned
    languages from all others, which the softmax cannot: ``usual`` is the mean of right windows, ``floor`` the least allowed.
    """

    classes: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    typical: np.ndarray
    usual: float = 0.0
    floor: float = -np.inf


def subwords(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Bucket of the n-gram at every byte; BUCKETS where it leaves its text or holds no letter."""
    n = len(data)
    plain = _PLAIN[data].astype(np.uint32)
    out = np.full(n, BUCKETS, np.int32)
    m = n - width + 1
    if m <= 0:
        return out
    h, blank = np.zeros(m, np.uint32), np.ones(m, bool)
    for i in range(width):
        piece = plain[i : i + m]
        h = h * np.uint32(0x01000193) ^ piece
        blank &= piece == 32
    h = (h + np.uint32(width)) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    out[:m] = (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 15)
    out[:m][blank] = BUCKETS
    for i in range(1, width):
        ends = offsets[1:] - i
        out[ends[ends >= np.maximum(offsets[:-1], 0)]] = BUCKETS
    return out


def _sums(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Per text, the sum of its subwords' rows; the last column counts them."""
    total = np.zeros((len(offsets) - 1, table.shape[1]))
    filled = np.flatnonzero(np.diff(offsets))
    if len(filled):
        for width in WIDTHS:
            rows = table[subwords(data, offsets, width)]
            total[filled] += np.add.reduceat(rows, offsets[:-1][filled], axis=0, dtype=np.float64)
    return total


def _totals(table: np.ndarray, data: np.ndarray, offsets: np.ndarray, most: int) -> np.ndarray:
    """``_sums`` of whole texts with a column of ones added to the table; long texts are summed piece by piece."""
    counted = np.concatenate([table, np.ones((BUCKETS + 1, 1), np.float32)], axis=1)
    counted[BUCKETS] = 0
    sums = []
    for a, b in slices(offsets, most):
        if b - a > 1 or offsets[b] - offsets[a] <= most:
            sums.append(_sums(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], counted))
            continue
        total, reach = np.zeros((1, counted.shape[1])), max(WIDTHS) - 1
        for at in range(offsets[a], offsets[b], most):
            piece = data[at : min(at + most + reach, offsets[b])]
            own = min(most, offsets[b] - at)
            for width in WIDTHS:
                found = subwords(piece, np.array([0, len(piece)]), width)[:own]
                total += counted[found].sum(axis=0, dtype=np.float64)
        sums.append(total)
    return np.concatenate(sums) if sums else np.zeros((0, counted.shape[1]))


def _softmax(model: Model, total: np.ndarray) -> np.ndarray:
    k = len(model.classes)
    logits = total[:, :k] / np.maximum(total[:, -1:], 1) + model.bias
    logits = logits / model.temperature
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    return p / p.sum(axis=1, keepdims=True)


def probabilities(model: Model, data: np.ndarray, offsets: np.ndarray, most: int = 1 << 19) -> np.ndarray:
    """Calibrated class probabilities of each text, whole; long texts are summed piece by piece."""
    return _softmax(model, _totals(model.table, data, offsets, most))


def judged(model: Model, data: np.ndarray, offsets: np.ndarray, most: int = 1 << 19) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class probabilities, typicality for the best class, number of subwords) of each text, whole."""
    k = len(model.classes)
    total = _totals(np.concatenate([model.table, model.typical], axis=1), data, offsets, most)
    p = _softmax(model, total)
    typical = total[np.arange(len(p)), k + p.argmax(axis=1)] / np.maximum(total[:, -1], 1)
    return p, typical, total[:, -1]


def good(model: Model, p: np.ndarray, typical: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which texts are probable and typical enough; below FEW subwords the bounds fall, by their share of FEW to chance
    and with the root of their number."""
    chance = 1 / len(model.classes)
    probable = p.max(axis=1, initial=0) >= min(chance, model.threshold) + max(0.0, model.threshold - chance) * np.minimum(size / FEW, 1)
    if np.isneginf(model.floor):
        return probable
    return probable & (typical >= model.usual - (model.usual - model.floor) * np.sqrt(FEW / np.clip(size, 1, FEW)))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of each text at places and of lengths that follow from its id alone."""
    low, high = WINDOW_BYTES
    for batch in batches:
        out: list[tuple] = []
        data, offsets = utf8(batch.column(1))
        for row, doc_id in enumerate(batch.column(0).to_pylist()):
            text = data[offsets[row] : offsets[row + 1]]
            draw = np.random.default_rng(zlib.crc32(str(doc_id).encode()))
            for _ in range(WINDOWS):
                size = int(np.exp(draw.uniform(np.log(low), np.log(high))))
                at = int(draw.integers(0, max(1, len(text) - size + 1)))
                out.append((doc_id, batch.column(2)[row].as_py(), text[at : at + size].tobytes()))
        ids, langs, pieces = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(pieces, pa.binary())], ["doc_id", "lang", "piece"]
        )


def held_out(id_col: str = "doc_id") -> Column:
    """True for a quarter of the ids, never learned from; false without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _features(pieces: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each window's buckets and their shares of its subwords."""
    out = []
    for piece in pieces:
        data, offsets = np.frombuffer(piece, np.uint8), np.array([0, len(piece)])
        found = np.concatenate([subwords(data, offsets, width) for width in WIDTHS])
        buckets, counts = np.unique(found[found < BUCKETS], return_counts=True)
        out.append((buckets, (counts / max(1, counts.sum())).astype(np.float32)))
    return out


def fit(samples: list[tuple[int, str, bytes]], epochs: int = 6, rate: float = 4.0, batch: int = 64, seed: int = 3) -> Model:
    """Train by SGD on (doc_id, lang, window) samples; every fifth document calibrates instead."""
    classes = sorted({lang for _, lang, _ in samples})
    index = {c: i for i, c in enumerate(classes)}
    samples = sorted(samples)
    aside = [s for s in samples if zlib.crc32(f"calibrate:{s[0]}".encode()) % 5 == 0]
    learn = [s for s in samples if zlib.crc32(f"calibrate:{s[0]}".encode()) % 5 != 0] or samples
    draw = np.random.default_rng(seed)
    k = len(classes)
    embedding = draw.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = draw.normal(0, 0.3, (DIMENSIONS, k)).astype(np.float32)
    bias = np.zeros(k, np.float32)
    features = _features([p for _, _, p in learn])
    labels = np.array([index[lang] for _, lang, _ in learn])
    steps, total = 0, max(1, epochs * -(-len(learn) // batch))
    for _ in range(epochs):
        order = draw.permutation(len(learn))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            x = np.zeros((len(chosen), BUCKETS), np.float32)
            for row, i in enumerate(chosen):
                x[row, features[i][0]] = features[i][1]
            y = labels[chosen]
            hidden = x @ embedding
            logits = hidden @ weights + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            step = rate * (1 - steps / total)
            back = p @ weights.T
            weights -= step * 0.25 * (hidden.T @ p)
            bias -= step * 0.05 * p.sum(axis=0)
            embedding -= step * 60 * (x.T @ back)
            steps += 1
    table = np.zeros((BUCKETS + 1, k), np.float32)
    table[:BUCKETS] = embedding @ weights
    counts = np.full((BUCKETS, k), 0.5)
    for (buckets, _), label, (_, _, piece) in zip(features, labels, learn, strict=True):
        found = np.concatenate([subwords(np.frombuffer(piece, np.uint8), np.array([0, len(piece)]), width) for width in WIDTHS])
        counts[buckets, label] += np.unique(found[found < BUCKETS], return_counts=True)[1]
    typical = np.zeros((BUCKETS + 1, k), np.float32)
    typical[:BUCKETS] = np.log(counts * BUCKETS / counts.sum(axis=0))
    model = Model(classes, table, bias.astype(np.float64), 1.0, 0.0, typical)
    if aside:
        pieces = [p for _, _, p in aside]
        data = np.frombuffer(b"".join(pieces), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        truth = np.array([index[lang] for _, lang, _ in aside])
        losses = {}
        for temperature in np.geomspace(0.1, 10, 25):
            model.temperature = float(temperature)
            p = probabilities(model, data, offsets)
            losses[model.temperature] = -np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean()
        model.temperature = min(losses, key=losses.get)
        p, found, size = judged(model, data, offsets)
        right = (p.argmax(axis=1) == truth) & (size > 0)
        if right.any():
            model.threshold = float(np.quantile(p.max(axis=1)[right], REJECTED, method="lower"))
            model.usual = float(found[right].mean())
            model.floor = float(np.quantile(found[right], REJECTED, method="lower"))
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Model from the labelled rows that are not held out; None if there are none.

    Learns from DOCS_PER_LANGUAGE documents of each language, those with the least hashed ids, and from
    WINDOWS windows of each (WINDOW_BYTES long, anywhere in the text): only these windows reach the driver.
    """
    known = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out("doc_id"))
    rank = "row_number() over (partition by lang order by xxhash64(doc_id), doc_id) as rank"
    chosen = known.where(F.col("text").isNotNull()).selectExpr("doc_id", "lang", rank).where(f"rank <= {DOCS_PER_LANGUAGE}")
    ids = sorted({r.doc_id for r in chosen.select("doc_id").collect()})
    if not ids:
        return None
    picked = known.where(F.col("doc_id").isin(ids) & F.col("text").rlike(r"\p{L}"))
    picked = picked.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("x")).select("doc_id", "x.text", "x.lang")
    samples = [tuple(r) for r in picked.mapInArrow(_windows, "doc_id long, lang string, piece binary").collect()]
    samples = [(i, lang, bytes(piece)) for i, lang, piece in samples]
    return fit(samples) if samples else None


def _predictor(model: Model) -> Callable:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            p, typical, size = judged(model, data, offsets)
            best = p.argmax(axis=1)
            lettered = np.array(batch.column(2).to_pylist(), bool)
            langs = [model.classes[i] if ok else UNKNOWN for i, ok in zip(best, lettered, strict=True)]
            score = np.where(lettered, p[np.arange(len(best)), best], 0.0)
            accepted = lettered & good(model, p, typical, size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(accepted)],
                ["doc_id", "lang_pred", "score", "accepted"],
            )

    return predict


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) for every row, from the whole text alone.

    Accepted are texts both probable and typical (``good``): noise and languages that were not learned are not.
    Null texts and texts without a letter are ``und`` with score 0 and are not accepted; so is every text
    if nothing could be learned. Ties go to the first language by name. A null id is kept, and
    never held out. Repeated rows repeat; extra columns are ignored; an empty table gives none.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)))
    if model is None:
        blank = rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    else:
        blank = rows.mapInArrow(_predictor(model), "doc_id long, lang_pred string, score double, accepted boolean")
    return blank.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")


def accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text the model accepts, all columns unchanged, in one pass without a shuffle.

    Without a model (no labelled rows) nothing is known to reject but texts without a letter.
    """
    schema, at = docs.schema, docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            lettered = np.array(batch.column(batch.num_columns - 1).to_pylist(), bool)
            kept = lettered & good(model, *judged(model, data, offsets))
            yield batch.select(list(range(batch.num_columns - 1))).filter(pa.array(kept))

    lettered = F.coalesce(F.col(f"`{text_col}`").cast("string").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.where(lettered)
    return docs.select("*", lettered.alias("_lettered")).mapInArrow(keep, schema)
