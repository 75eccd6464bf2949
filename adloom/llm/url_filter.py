"""URL filters: all wildcard rules run at once as bits of one multiword Shift-And automaton over each canonical URL.

A canonical URL is ``host + path``. In a glob ``*`` stands for any run without ``/``, ``**`` for any run; every other
character stands for itself. Each glob takes one start bit and one bit per byte; the bits of all globs lie end to end
in 64-bit words. A step shifts all words by one, carries included, keeps the bits whose byte was read, and lets the
bits in front of a wildcard stay. Bits move from one glob into the next only at start bits, which no byte keeps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import utf8

#: URLs advanced together, by their bytes; bounds a worker's memory beside the longest single URL.
BYTES_AT_ONCE = 1 << 22
#: Texts still running at which a step on whole numbers, text by text, is cheaper than one on arrays.
FEW = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Allow or block a host with all its subdomains below a path prefix."""

    action: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Glob:
    """Allow or block the canonical URLs that a glob matches from end to end."""

    action: str
    pattern: str


#: What the method itself blocks where no rule fits: login and cart pages, adverts, trackers, archives and programs.
DEFAULT_GLOBS = tuple(
    Glob("block", pattern)
    for pattern in (
        "**/login", "**/login/**", "**/signin", "**/signin/**", "**/cart/**", "**/checkout/**", "**/ads/**", "**/banner/**",
        "ads.**", "adserver.**", "**.doubleclick.net/**", "tracker.**", "**/wp-admin/**", "**/cgi-bin/**",
        "**.exe", "**.zip", "**.gz", "**.iso", "**.apk", "**.dmg",
    )
)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


class Automaton:
    """Bit-parallel matcher of many globs; immutable once built, its size is the rules' alone."""

    def __init__(self, globs: list[str]):
        steps: list[tuple[int, int]] = []  # per bit: its byte (-1 for a start bit), and what may stay: 0 none, 1 all but /, 2 all
        ends = []
        for glob in globs:
            steps.append((-1, 0))
            raw, at = glob.encode("utf-8"), 0
            while at < len(raw):
                if raw[at] == ord("*"):
                    deep = raw[at : at + 2] == b"**"
                    steps[-1] = steps[-1][0], max(steps[-1][1], 2 if deep else 1)
                    at += 1 + deep
                else:
                    steps.append((raw[at], 0))
                    at += 1
            ends.append(len(steps) - 1)
        bits = max(len(steps), 1)
        self.words = -(-bits // 64)
        self.ends = np.array(ends, np.int64)
        literal = np.array([s[0] for s in steps] or [-1], np.int64)
        stays = np.array([s[1] for s in steps] or [0], np.int64)
        one_of = np.arange(256)[:, None]
        self.read = self._packed(literal[None, :] == one_of)
        self.stay = self._packed((stays[None, :] == 2) | ((stays[None, :] == 1) & (one_of != ord("/"))))
        self.start = self._packed((literal == -1)[None, :])[0]
        self.whole = [[int.from_bytes(row.astype("<u8").tobytes(), "little") for row in masks] for masks in (self.read, self.stay)]

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        wide = np.zeros((bits.shape[0], self.words * 64), bool)
        wide[:, : bits.shape[1]] = bits
        return np.packbits(wide, axis=1, bitorder="little").view("<u8").astype(np.uint64)

    def _finish(self, state: np.ndarray, rest: np.ndarray) -> np.ndarray:
        bits = int.from_bytes(state.astype("<u8").tobytes(), "little")
        read, stay = self.whole
        for byte in rest.tobytes():
            bits = ((bits << 1) & read[byte]) | (bits & stay[byte])
        return np.frombuffer(bits.to_bytes(self.words * 8, "little"), "<u8")

    def match(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, globs) booleans: which globs match each text from end to end."""
        lengths = np.diff(offsets)
        n = len(lengths)
        order = np.argsort(-lengths, kind="stable")  # the texts still running are always a prefix
        begin, length = offsets[:-1][order], lengths[order]
        state = np.repeat(self.start[None, :], n, axis=0)
        running = n - np.searchsorted(length[::-1], np.arange(int(length[0]) if n else 0), side="right")
        top, one = np.uint64(63), np.uint64(1)
        for at, k in enumerate(running):
            if k <= FEW:  # the rest of few long texts: the same step on one whole number each
                for i in range(k):
                    state[i] = self._finish(state[i], data[begin[i] + at : begin[i] + length[i]])
                break
            now = state[:k]
            byte = data[begin[:k] + at]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            moved &= self.read[byte]
            now &= self.stay[byte]
            now |= moved
        found = (state[:, self.ends // 64] >> (self.ends % 64).astype(np.uint64)) & one
        out = np.empty((n, len(self.ends)), bool)
        out[order] = found.astype(bool)
        return out


def _compiled(rules: list[Rule], globs: list[Glob]) -> tuple[Automaton, list[tuple[int, str, str]]]:
    """The automaton, and per pattern (precedence, rule text, action): longer rules first, then the given order; globs last."""
    ranked = sorted(range(len(rules)), key=lambda i: (-len(rules[i].text), i))
    patterns, meaning = [], []
    for rank, i in enumerate(ranked):
        rule = rules[i]
        for prefix in ("", "*."):
            patterns.append(f"{prefix}{rule.text}**")
            meaning.append((rank, rule.text, rule.action))
    for rank, glob in enumerate(globs, start=len(rules)):
        patterns.append(glob.pattern)
        meaning.append((rank, glob.pattern, glob.action))
    return Automaton(patterns), meaning


def _worker(rules: list[Rule], globs: list[Glob], default: str, without_host: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, meaning = _compiled(rules, globs)
        n_rules = 2 * len(rules)
        texts = np.array([m[1] for m in meaning] + [None], object)
        actions = np.array([m[2] for m in meaning] + [default], object)
        for batch in batches:
            data, offsets = utf8(pa.array([h + p for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())], pa.string()))
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BYTES_AT_ONCE, side="right")) - 1)
                rows = batch.slice(at, end - at)
                hit = automaton.match(data, offsets[at : end + 1])
                # Patterns stand in order of precedence, so the first hit decides; the last column is "no hit".
                first = np.where(hit.any(axis=1), hit.argmax(axis=1), len(meaning)) if len(meaning) else np.zeros(len(rows), np.int64)
                by_rule = first < n_rules
                verdict = actions[first]
                no_host = np.array([not h for h in rows.column(1).to_pylist()], bool) & ~by_rule
                verdict[no_host] = without_host
                rule = np.where(by_rule, texts[first], None)
                glob = np.where(by_rule | no_host, None, texts[first])
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, *(pa.array(x.tolist(), pa.string()) for x in (rule, verdict, glob))],
                    ["id", "host", "path", "rule", "verdict", "glob"],
                )
                at = end

    return run


def judge(
    pages: DataFrame,
    rules: list[Rule],
    globs: tuple[Glob, ...] | list[Glob] = DEFAULT_GLOBS,
    default: str = "allow",
    without_host: str = "block",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict, glob) for every row: the longest fitting rule decides, else the globs, else the default.

    A rule fits its host and all subdomains if the path starts with its path; of equally long
    ones the first given wins. Where no rule fits, the first matching glob (in the given order)
    decides and is returned; a URL without a host gets ``without_host``. Null, empty and
    ``://``-less URLs have empty host and path. URLs may have any length: the state of a URL is
    one bit per rule byte, whatever it reads. A lone ``*`` in a rule's host or path acts as a
    wildcard too. Repeated rows and null ids are kept, other columns ignored; an empty table,
    or no rules, is fine. One narrow pass: no shuffle, and rules travel with the task.
    """
    for x in (*rules, *globs):
        if x.action not in ("allow", "block"):
            raise ValueError(f"action {x.action!r}")
    rows = pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(
        _worker(list(rules), list(globs), default, without_host), f"id {kind}, host string, path string, rule string, verdict string, glob string"
    )
    return found.withColumnRenamed("id", id_col)
