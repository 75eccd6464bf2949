"""Secret scans: fixed rules, and a character convolutional network over every candidate in its context."""

from __future__ import annotations

import random
import re
import string
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import shared_dir

KINDS = ("assign", "access", "hex", "learned")
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Any long run of key characters with a digit in it is a candidate for the network.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
DIGIT = re.compile(r"[0-9]")

#: Characters of context on either side.
CONTEXT = 24
#: Different labelled windows in a part that a task learns from, about; rounds over all parts, their networks averaged after each.
PART = 8000
ROUNDS = 8
#: Made examples of a part: at least, and to each found one.
MADE, MADE_SHARE = 900, 0.75
#: Windows and characters of a training step, at most (one window may be longer).
STEP_WINDOWS, STEP_CHARS = 64, 1 << 16
#: Places after the point that the calibration keeps of a logit.
LOGIT_PLACES = 3
#: Share of the true findings of the calibration part that the threshold must keep.
RECALL = 0.97
#: Characters of a window convolved at once; longer windows go piece by piece.
PIECE = 1 << 15
PLACEHOLDER = "[secret]"

ALPHABET = string.ascii_letters + string.digits + string.punctuation + " \n"
CODES = np.full(1 << 7, len(ALPHABET) + 1, np.int64)
for _i, _c in enumerate(ALPHABET):
    CODES[ord(_c)] = _i + 1
VOCABULARY, EMBED, WIDTH, FILTERS, HIDDEN = len(ALPHABET) + 2, 10, 5, 24, 16


def base_findings(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself), by start, then kind: the fixed rules."""
    found = [(m.start(), 0, m.end(), m.start(1)) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def other_candidates(text: str, base: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of runs of key characters, 16 or longer with a digit, that no base finding overlaps."""
    out, at, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        # Both lists go by start: the findings that begin before this end overlap it if one of them reaches past its start.
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= start and DIGIT.search(text, start, end):
            out.append((start, end))
    return out


def _window(text: str, start: int, end: int) -> tuple[str, int, int]:
    """The candidate, whole, with its context; where it starts and ends in there."""
    low = max(0, start - CONTEXT)
    return text[low : end + CONTEXT], start - low, end - low


def _arrays(windows: list[tuple[str, int, int]], length: int) -> tuple[np.ndarray, np.ndarray]:
    codes, inside = np.zeros((len(windows), length), np.int64), np.zeros((len(windows), length), np.float32)
    for row, (text, start, end) in enumerate(windows):
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        codes[row, : len(points)] = np.where(points < 128, CODES[np.minimum(points, 127)], VOCABULARY - 1)
        inside[row, start:end] = 1
    return codes, inside


@dataclass
class Network:
    """Embedding, one convolution, max and mean pooling, a hidden layer, a logit; calibrated by scale and shift."""

    weights: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def convolved(self, codes: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(input, activation, which places are real)."""
        w = self.weights
        x = np.concatenate([w["embed"][codes], inside[..., None]], axis=2)
        span = codes.shape[1] - WIDTH + 1
        conv = w["conv_b"] + sum(x[:, k : k + span] @ w["conv"][k] for k in range(WIDTH))
        real = (codes[:, WIDTH - 1 :] > 0) | (np.arange(span) == 0)
        return x, np.maximum(conv, 0) * real[..., None], real

    def forward(self, codes: np.ndarray, inside: np.ndarray) -> dict[str, np.ndarray]:
        x, act, real = self.convolved(codes, inside)
        size = real.sum(axis=1, keepdims=True)
        pooled = np.concatenate([act.max(axis=1), act.sum(axis=1) / size], axis=1)
        return {"x": x, "act": act, "size": size} | self.judged(pooled)

    def judged(self, pooled: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        hidden = np.maximum(pooled @ w["hidden"] + w["hidden_b"], 0)
        return {"pooled": pooled, "h": hidden, "logit": hidden @ w["out"] + w["out_b"][0]}

    def step(self, codes: np.ndarray, inside: np.ndarray, truth: np.ndarray, rate: float, memory: dict) -> None:
        """One step of Adam on the logistic loss."""
        w, f = self.weights, self.forward(codes, inside)
        d = (1 / (1 + np.exp(-f["logit"])) - truth) / len(truth)
        g = {"out": f["h"].T @ d, "out_b": np.array([d.sum()])}
        dh = d[:, None] * w["out"] * (f["h"] > 0)
        g |= {"hidden": f["pooled"].T @ dh, "hidden_b": dh.sum(axis=0)}
        dp = dh @ w["hidden"].T
        act = f["act"]
        best = act.argmax(axis=1)
        da = np.repeat((dp[:, FILTERS:] / f["size"])[:, None, :], act.shape[1], axis=1)
        rows, columns = np.indices(best.shape)
        da[rows, best, columns] += dp[:, :FILTERS]
        da *= act > 0
        span = act.shape[1]
        g["conv_b"] = da.sum(axis=(0, 1))
        g["conv"] = np.stack([np.einsum("nle,nlf->ef", f["x"][:, k : k + span], da, optimize=True) for k in range(WIDTH)])
        dx = np.zeros_like(f["x"])
        for k in range(WIDTH):
            dx[:, k : k + span] += da @ w["conv"][k].T
        g["embed"] = np.zeros_like(w["embed"])
        np.add.at(g["embed"], codes.ravel(), dx[..., :EMBED].reshape(-1, EMBED))
        g["embed"][0] = 0
        memory["t"] = memory.get("t", 0) + 1
        for name, grad in g.items():
            m, v = memory.get(name, (0.0, 0.0))
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            memory[name] = m, v
            unbiased = m / (1 - 0.9 ** memory["t"])
            w[name] = w[name] - rate * unbiased / (np.sqrt(v / (1 - 0.999 ** memory["t"])) + 1e-8)

    def long_logit(self, text: str, start: int, end: int) -> float:
        """The logit of one long window; its pieces overlap by WIDTH - 1 characters, so each place is convolved once."""
        most, total = np.zeros(FILTERS), np.zeros(FILTERS)
        span = len(text) - WIDTH + 1
        for at in range(0, span, PIECE):
            piece = text[at : at + min(PIECE, span - at) + WIDTH - 1]
            inner = (piece, min(max(start - at, 0), len(piece)), min(max(end - at, 0), len(piece)))
            act = self.convolved(*_arrays([inner], len(piece)))[1][0]
            most, total = np.maximum(most, act.max(axis=0)), total + act.sum(axis=0)
        return float(self.judged(np.concatenate([most, total / span])[None, :])["logit"][0])

    def logits(self, windows: list[tuple[str, int, int]]) -> np.ndarray:
        """Windows of similar length go together; each is read whole, long ones piece by piece."""
        out = np.zeros(len(windows))
        groups: dict[int, list[int]] = {}
        for i, (text, start, end) in enumerate(windows):
            if len(text) > PIECE:
                out[i] = self.long_logit(text, start, end)
                continue
            groups.setdefault(max(64, 1 << (len(text) - 1).bit_length()), []).append(i)
        for length, chosen in groups.items():
            at_once = max(1, (1 << 16) // length)
            for at in range(0, len(chosen), at_once):
                part = chosen[at : at + at_once]
                longest = max(64, max(len(windows[i][0]) for i in part))
                out[part] = self.forward(*_arrays([windows[i] for i in part], longest))["logit"]
        return out

    def scores(self, windows: list[tuple[str, int, int]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(windows) + self.shift, -60, 60)))


def _made(draw: random.Random, contexts: list[tuple[str, str]]) -> tuple[tuple[str, int, int], int]:
    """A made labelled finding: a key of an invented kind in a context that names it, or a harmless run in any context."""

    def pick(letters: str, low: int, high: int) -> str:
        return "".join(draw.choices(letters, k=draw.randint(low, high)))

    mixed, lower = string.ascii_letters + string.digits, string.ascii_lowercase
    before, after = draw.choice(contexts) if contexts else ("", "")
    if draw.random() < 0.5:
        name = draw.choice(["key", "auth", "private_key", "credential", "Authorization: Bearer", "access", "pwd", "client_id", "sig"])
        lead = name + draw.choice([" ", ": ", "=", ' = "', ":"])
        body = draw.choice(
            [
                lambda: pick(mixed, 24, 64),
                lambda: pick(string.ascii_uppercase + string.digits, 20, 40),
                lambda: draw.choice(["sk_live_", "gh_", "xo-", "pk-"]) + pick(mixed, 20, 40),
                lambda: pick(mixed + "+/", 32, 88) + draw.choice(["", "=", "=="]),
                lambda: pick(string.hexdigits.upper(), 24, 48),
            ]
        )()
        if not DIGIT.search(body):
            body += draw.choice(string.digits)
        return ((before[: CONTEXT - len(lead)] + lead)[-CONTEXT:] + body + after, min(CONTEXT, len(before[: max(0, CONTEXT - len(lead))] + lead)), 0), 1
    body = draw.choice(
        [
            lambda: pick(string.digits, 16, 24),
            lambda: "-".join(pick(string.digits, 2, 5) for _ in range(5)),
            lambda: "/".join(pick(lower, 3, 9) for _ in range(4)) + "/" + pick(string.digits, 1, 4),
            lambda: "_".join(pick(lower, 3, 9) for _ in range(3)) + pick(string.digits, 1, 3),
            lambda: pick(lower, 8, 14) + "-" + pick(lower, 6, 12) + "-" + pick(string.digits, 1, 4),
            lambda: pick(lower, 14, 24) + pick(string.digits, 1, 4),
            lambda: "=" * draw.randint(10, 40) + pick(string.digits, 1, 2) + "=" * 8,
        ]
    )()
    body = body if len(body) >= 16 else body + "0" * (16 - len(body))
    return ((before + body + after), len(before), 0), 0


def _rows(examples: list[tuple[str, int, int, int]], seed: int) -> tuple[list, list]:
    """(calibration, training) rows of a part: its labelled candidates (window, start, end, label) and made findings."""
    draw = random.Random(seed)
    contexts = [(w[:s], w[e:]) for w, s, e, label in examples if not label] or [(w[:s], w[e:]) for w, s, e, _ in examples]
    contexts = [(before, after) for before, after in contexts if len(before) <= CONTEXT and len(after) <= CONTEXT]
    rows = [((w, s, e), label) for w, s, e, label in sorted(examples)]
    for _ in range(max(MADE, int(MADE_SHARE * len(examples)))):
        (text, start, _), label = _made(draw, contexts)
        end = CANDIDATE.match(text, start)
        if end:
            rows.append(((text, start, end.end()), label))
    draw.shuffle(rows)
    return rows[: len(rows) // 4], rows[len(rows) // 4 :]


def _shapes() -> dict[str, tuple[int, ...]]:
    return {
        "embed": (VOCABULARY, EMBED), "conv": (WIDTH, EMBED + 1, FILTERS), "hidden": (2 * FILTERS, HIDDEN), "out": (HIDDEN,),
        "conv_b": (FILTERS,), "hidden_b": (HIDDEN,), "out_b": (1,),
    }


def _flat(weights: dict[str, np.ndarray], memory: dict) -> np.ndarray:
    """Weights, Adam's two moments and its steps as one vector, as it is averaged."""
    parts = [np.ravel(weights[k]) for k in _shapes()]
    parts += [np.ravel(np.broadcast_to(memory.get(k, (0.0, 0.0))[i], shape)) for i in (0, 1) for k, shape in _shapes().items()]
    return np.concatenate([*parts, [memory.get("t", 0.0)]])


def _unflat(state: np.ndarray) -> tuple[dict[str, np.ndarray], dict]:
    at, sets = 0, []
    for _ in range(3):
        sets.append({})
        for k, shape in _shapes().items():
            size = int(np.prod(shape))
            sets[-1][k] = state[at : at + size].reshape(shape).copy()
            at += size
    weights, first, second = sets
    return weights, {k: (first[k], second[k]) for k in weights} | {"t": float(state[at])}


def _start(seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    weights = {}
    for k, s in _shapes().items():
        weights[k] = np.zeros(s) if k.endswith("_b") else rng.normal(0, (2 / (s[-2] if len(s) > 1 else s[0])) ** 0.5 * 0.5, s)
    weights["embed"][0] = 0
    return _flat(weights, {})


def _epoch(state: np.ndarray, learn: list, seed: tuple[int, ...], rate: float = 0.004) -> np.ndarray:
    """One pass over a part's rows; a step's windows are fewer where they are long."""
    weights, memory = _unflat(state)
    net, part, longest = Network(weights), [], 64

    def step() -> None:
        net.step(*_arrays([w for w, _ in part], longest), np.array([y for _, y in part], float), rate, memory)

    for i in np.random.default_rng(seed).permutation(len(learn)):
        size = max(longest, len(learn[i][0][0]))
        if part and (len(part) == STEP_WINDOWS or (len(part) + 1) * size > STEP_CHARS):
            step()
            part, size = [], max(64, len(learn[i][0][0]))
        part.append(learn[i])
        longest = size
    if part:
        step()
    return _flat(net.weights, memory)


def _calibrated(state: np.ndarray, z: np.ndarray, truth: np.ndarray, times: np.ndarray) -> Network:
    """The network with scale and shift of its logit fitted to the calibration rows' logits, each so many times there.

    The threshold is the highest score that keeps RECALL of the true findings among them.
    """
    net = Network(_unflat(state)[0])
    share = times / times.sum()
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(net.scale * z + net.shift, -60, 60)))
        net.scale -= 0.1 * float(((p - truth) * z * share).sum())
        net.shift -= 0.1 * float(((p - truth) * share).sum())
    if truth.any():
        p, n = (1 / (1 + np.exp(-np.clip(net.scale * z + net.shift, -60, 60))))[truth > 0], times[truth > 0]
        order = np.argsort(p, kind="stable")
        place = np.searchsorted(np.cumsum(n[order]), int((1 - RECALL) * (n.sum() - 1)), side="right")
        net.threshold = float(p[order][place])
    return net


def _floored(z: np.ndarray) -> np.ndarray:
    """Logits cut down to LOGIT_PLACES, so that those of any number of rows can be counted."""
    return np.floor(np.clip(z, -60, 60) * 10**LOGIT_PLACES) / 10**LOGIT_PLACES


def fit(examples: list[tuple[str, int, int, int]], seed: int = 11) -> Network:
    """Train on one part alone, here: labelled candidates (window, start, end, label) and made findings; a quarter calibrates."""
    aside, learn = _rows(examples, seed)
    state = _start(seed)
    for number in range(ROUNDS):
        state = _epoch(state, learn, (seed, number))
    z = _floored(Network(_unflat(state)[0]).logits([w for w, _ in aside]))
    return _calibrated(state, z, np.array([y for _, y in aside], float), np.ones(len(aside)))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column(0).to_pylist():
            base = base_findings(text or "")
            out += [(*_window(text, own, end), 1) for _, _, end, own in base]
            out += [(*_window(text, start, end), 0) for start, end in other_candidates(text or "", base)]
        # A step learns from its windows whole; of a longer one than a piece only the verdict is asked.
        out = [x for x in out if len(x[0]) <= PIECE]
        columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        types = (pa.string(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["w", "s", "e", "label"])


def labelled(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(w, s, e, label): every different candidate of all documents in its context, labelled by the fixed rules."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_examples, "w string, s int, e int, label int").distinct()


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 11) -> Network:
    """The network, from the candidates of all documents, labelled by the fixed rules, and made findings.

    The different windows are written once and dealt by hash into parts of about PART. In each of ROUNDS rounds a task
    goes once over its part from the common network, and the networks are averaged by their rows; a quarter of each
    part calibrates. Averages are exact decimals, so they do not depend on the order of parts. The driver sees one network,
    and counts of logits to LOGIT_PLACES.
    """
    spark = docs.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/candidates-{uuid.uuid4().hex}"
    labelled(docs, text_col).write.parquet(path)
    found = spark.read.schema("w string, s int, e int, label int").parquet(path)
    size = found.count()
    if not size:
        return fit([], seed)
    parts = -(-size // PART)
    part = F.pmod(F.xxhash64("w", "s", "e", "label"), F.lit(parts)).cast("int")
    # A number of partitions keeps small parts from being put into one task.
    dealt = found.withColumn("part", part).repartition(parts, "part").groupBy("part")

    def rows_of(table: pa.Table) -> tuple[int, list, list]:
        part = table["part"][0].as_py()
        return part, *_rows(list(zip(*(table[c].to_pylist() for c in ("w", "s", "e", "label")), strict=True)), seed + part)

    def learner(state: np.ndarray, number: int) -> Callable[[pa.Table], pa.Table]:
        def run(table: pa.Table) -> pa.Table:
            part, _, learn = rows_of(table)
            return pa.table({"rows": pa.array([len(learn)], pa.int64()), "state": [_epoch(state, learn, (seed + part, number)).tolist()]})

        return run

    state = _start(seed)
    for number in range(ROUNDS):
        states = dealt.applyInArrow(learner(state, number), "rows long, state array<double>").select("rows", F.posexplode("state").alias("at", "value"))
        weighted = F.sum(F.col("value").cast("decimal(24,15)") * F.col("rows").cast("decimal(12,0)"))
        mean = (weighted / F.sum("rows")).cast("double").alias("value")
        state = np.array([r.value for r in states.groupBy("at").agg(mean).orderBy("at").collect()])

    def logits(table: pa.Table) -> pa.Table:
        _, aside, _ = rows_of(table)
        return pa.table({"z": _floored(Network(_unflat(state)[0]).logits([w for w, _ in aside])), "y": pa.array([y for _, y in aside], pa.int32())})

    counted = dealt.applyInArrow(logits, "z double, y int").groupBy("z", "y").count().orderBy("z", "y").collect()
    z, truth, times = (np.array([r[i] for r in counted], float) for i in range(3))
    return _calibrated(state, z, truth, times)


def findings(text: str, net: Network) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, score) of a whole text: all base findings, and candidates that the network accepts."""
    base = base_findings(text)
    others = other_candidates(text, base)
    if not base and not others:
        return []
    windows = [_window(text, own, end) for _, _, end, own in base] + [_window(text, s, e) for s, e in others]
    scores = net.scores(windows).tolist()
    out = [(s, kind, e, p) for (s, kind, e, _), p in zip(base, scores, strict=False)]
    out += [(s, 3, e, p) for (s, e), p in zip(others, scores[len(base) :], strict=True) if p >= net.threshold]
    return sorted(out)


def scan(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, findings) for every row: an array of (start, kind, stop, score), by start, then kind.

    Offsets are code points, the end exclusive. Null and empty texts have an empty array; repeated rows
    and null ids are kept; overlapping findings of different kinds are all listed; extra columns are
    ignored; an empty table gives none. Texts are scanned whole, however long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("stop", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            rows = []
            for text in batch.column(1):
                found = findings(text.as_py() or "", net)
                rows.append([{"start": s, "kind": KINDS[k], "stop": e, "score": p} for s, k, e, p in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "findings"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, findings array<struct<start:int,kind:string,stop:int,score:double>>")


def listed(found: Column) -> Column:
    """Findings as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ","
    )


def redact_text(text: str, net: Network) -> str:
    """The text with every finding replaced; overlapping findings become one placeholder."""
    out, at, until = [], 0, -1
    for start, _, end, _ in findings(text, net):
        if start >= until:
            out += [text[at:start], PLACEHOLDER]
        until = max(until, end)
        at = until
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame, net: Network, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns of docs with findings replaced in the text; null texts stay null; the length follows a changed text."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else redact_text(x, net) for x in (v.as_py() for v in batch.column(at))]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if length_col and length_col in docs.columns and length_col != text_col:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.coalesce(F.char_length(text_col).cast(kind), F.col(length_col)))
    return out
