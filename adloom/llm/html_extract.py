"""HTML extraction: a bidirectional LSTM labels every block of a page from tag paths and hashed words."""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import mix, powers

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME = re.compile(r"[a-z]+")
#: Elements whose content is no text of the page; elements without content; elements that begin and end a block.
#: Formulas, drawings and fallbacks are no such elements: their text is left to the network.
RAW = frozenset("script style template textarea select title iframe".split())
RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Blocks whose start tag ends an open paragraph.
ENDS_P = BLOCK - frozenset("body html button td th tr tbody thead tfoot caption legend summary".split())

PATH_DIMS, WORD_DIMS, SCALARS, HIDDEN = 192, 64, 8, 20
DIMS = PATH_DIMS + WORD_DIMS + SCALARS
#: The training sample's bounds: pages of the table, and made pages.
SAMPLE_PAGES, MADE_PAGES, LONGEST_TRAINED = 200, 700, 120
#: Pages of so many characters and more are not drawn into the sample; they are extracted like all others.
LONGEST_SAMPLED = 100_000


@dataclass(slots=True)
class Element:
    """An open element: its tag, its tokens, the element around it, and the hashed places of all tokens from the root on."""

    tag: str
    tokens: tuple[str, ...]
    parent: Element | None
    places: int = 0

    def __post_init__(self) -> None:
        self.places = self.parent.places if self.parent else 0
        for token in self.tokens:
            for place in _place(token):
                self.places |= 1 << place


@dataclass
class Block:
    """A run of text between block tags, its innermost open element, and how much of it is linked.

    Blocks share the elements around them, so a page holds each once, however deep it nests.
    """

    element: Element | None
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""

    @property
    def path(self) -> tuple[str, ...]:
        """The tokens of all open elements, from the root on."""
        tokens, at = [], self.element
        while at:
            tokens.append(at.tokens)
            at = at.parent
        return tuple(t for group in reversed(tokens) for t in group)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a whole page, in order, with references decoded and white space joined."""
    out: list[Block] = []
    stack: list[Element] = []
    counts: dict[str, int] = defaultdict(int)
    current: Block | None = None
    at = 0

    def add(raw: str) -> None:
        nonlocal current
        if not raw.strip() and (current is None or not raw):
            return
        if current is None:
            current = Block(stack[-1] if stack else None)
            out.append(current)
        current.parts.append(raw)
        if counts["a"]:
            current.linked += len(raw)

    def leave(i: int) -> None:
        for element in stack[i:]:
            counts[element.tag] -= 1
        del stack[i:]

    while at < len(page):
        m = MARKUP.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        close, tag, rest = (m.group(1), m.group(2), m.group(3)) if m.group(2) else (m.group(4), m.group(5), m.group(6))
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCK:
            current = None
        elif tag == "br":
            add(" ")
        if close:
            if counts[tag]:
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            continue
        if tag in RAW and not rest.endswith("/"):
            end = RAW_END[tag].search(page, at)
            if end:
                at = end.start()
                continue
            # Without its end tag it is an ordinary element, so that the rest of the page stays.
        if tag in VOID:
            continue
        for same, barrier in ((("p",), ()), (("li",), ("ul", "ol", "menu")), (("dt", "dd"), ("dl",)), (("td", "th"), ("tr", "table")), (("tr",), ("table",))):
            if (tag in same or (same == ("p",) and tag in ENDS_P)) and any(counts[t] for t in same):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag in barrier or (same == ("p",) and stack[i].tag in ("button", "td", "th", "table")):
                        break
                    if stack[i].tag in same:
                        leave(i)
                        break
        names = [tag]
        if "=" in rest:
            for a, b, c in ATTRIBUTE.findall(rest):
                names += ["." + n for n in NAME.findall((a or b or c).lower())]
        stack.append(Element(tag, tuple(names), stack[-1] if stack else None))
        counts[tag] += 1
    for block in out:
        block.text = " ".join(html.unescape("".join(block.parts)).split())
    return [b for b in out if b.text]


@lru_cache(maxsize=1 << 16)
def _place(token: str) -> tuple[int, int]:
    h = zlib.crc32(token.encode())
    return h % PATH_DIMS, (h // PATH_DIMS) % PATH_DIMS


def features(pages: list[list[Block]]) -> np.ndarray:
    """One row per block of all pages: hashed path tokens, hashed words, measures of the block and its place."""
    flat = [b for page in pages for b in page]
    x = np.zeros((len(flat), DIMS), np.float32)
    if not flat:
        return x
    texts = [(b.text + " ").encode("utf-8").lower() for b in flat]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    space = data == 0x20
    word_ends = np.flatnonzero(space)
    word_starts = np.concatenate([[0], word_ends[:-1] + 1])
    sizes = word_ends - word_starts + 1
    place = np.arange(len(data)) - np.repeat(word_starts, sizes)
    hashes = mix(np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers(0x100000001B3, int(sizes.max()))[place], word_starts))
    owner = np.searchsorted(ends, word_starts, side="right")
    counts = np.bincount(owner * WORD_DIMS + (hashes % np.uint64(WORD_DIMS)).astype(np.int64), minlength=len(flat) * WORD_DIMS)
    counts = counts.reshape(-1, WORD_DIMS)
    words = counts.sum(axis=1)
    x[:, PATH_DIMS : PATH_DIMS + WORD_DIMS] = counts / np.sqrt(np.maximum(words, 1))[:, None]
    row = 0
    for page in pages:
        for i, block in enumerate(page):
            if block.element:
                places = np.frombuffer(block.element.places.to_bytes(PATH_DIMS // 8, "little"), np.uint8)
                x[row, :PATH_DIMS] = np.unpackbits(places, bitorder="little")
                x[row, _place("last:" + block.element.tokens[-1])[0]] = 1
            text = block.text
            measures = (np.log1p(len(text)) / 5, np.log1p(words[row]) / 4, min(1, block.linked / max(1, len(text))), text[-1] in ".!?…:;\"'", i / len(page), (len(page) - i) / len(page), len(text) < 40, 1)
            x[row, PATH_DIMS + WORD_DIMS :] = measures
            row += 1
    return x


class Labeller:
    """A forward and a backward LSTM over the blocks of a page, and a logit per block from both states."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.w: dict[str, np.ndarray] = {"out": rng.normal(0, 0.2, 2 * HIDDEN), "out_b": np.zeros(1)}
        for way in "fb":
            self.w["x" + way] = rng.normal(0, 0.12, (DIMS, 4 * HIDDEN))
            self.w["h" + way] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
            self.w["c" + way] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    @staticmethod
    def turned(lengths: np.ndarray, steps: int) -> np.ndarray:
        """For each page the order that reverses its own blocks and leaves the padding where it is."""
        t = np.arange(steps)[None, :]
        return np.where(t < lengths[:, None], lengths[:, None] - 1 - t, t)

    def states(self, x: np.ndarray, way: str, trace: list | None = None) -> np.ndarray:
        """Hidden states (pages, steps, HIDDEN) of one direction; ``trace`` gets what back-propagation needs."""
        pages, steps, _ = x.shape
        projected = x @ self.w["x" + way] + self.w["c" + way]
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((pages, steps, HIDDEN), np.float32)
        for t in range(steps):
            z = projected[:, t] + h @ self.w["h" + way]
            gates = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, previous = c, h
            c = f * c + i * g
            h = o * np.tanh(c)
            out[:, t] = h
            if trace is not None:
                trace.append((i, f, o, g, before, c, previous))
        return out

    def logits(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        order = self.turned(lengths, x.shape[1])
        forward = self.states(x, "f")
        backward = self.states(np.take_along_axis(x, order[..., None], axis=1), "b")
        backward = np.take_along_axis(backward, order[..., None], axis=1)
        return np.concatenate([forward, backward], axis=2) @ self.w["out"] + self.w["out_b"][0]

    def step(self, x: np.ndarray, lengths: np.ndarray, truth: np.ndarray, rate: float, memory: dict) -> None:
        """Back-propagation through time on the logistic loss of the real blocks, and one step of Adam."""
        pages, steps, _ = x.shape
        real = np.arange(steps)[None, :] < lengths[:, None]
        order = self.turned(lengths, steps)
        inputs = {"f": x, "b": np.take_along_axis(x, order[..., None], axis=1)}
        traces: dict[str, list] = {"f": [], "b": []}
        states = {way: self.states(inputs[way], way, traces[way]) for way in "fb"}
        both = np.concatenate([states["f"], np.take_along_axis(states["b"], order[..., None], axis=1)], axis=2)
        z = both @ self.w["out"] + self.w["out_b"][0]
        d = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - truth) * real / max(1, real.sum())).astype(np.float32)
        grads = {"out": np.einsum("ps,psh->h", d, both), "out_b": np.array([d.sum()], np.float32)}
        for way, low in (("f", 0), ("b", HIDDEN)):
            from_out = d[..., None] * self.w["out"][low : low + HIDDEN]
            if way == "b":
                from_out = np.take_along_axis(from_out, order[..., None], axis=1)
            dz = np.zeros((pages, steps, 4 * HIDDEN), np.float32)
            dh, dc = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
            gh = np.zeros_like(self.w["h" + way])
            for t in range(steps - 1, -1, -1):
                i, f, o, g, before, c, previous = traces[way][t]
                dh = dh + from_out[:, t]
                tanh = np.tanh(c)
                dc = dc + dh * o * (1 - tanh * tanh)
                dz[:, t] = np.concatenate(
                    [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tanh * o * (1 - o), dc * i * (1 - g * g)], axis=1
                )
                gh += previous.T @ dz[:, t]
                dh, dc = dz[:, t] @ self.w["h" + way].T, dc * f
            grads["h" + way] = gh
            grads["x" + way] = inputs[way].reshape(-1, DIMS).T @ dz.reshape(-1, 4 * HIDDEN)
            grads["c" + way] = dz.sum(axis=(0, 1))
        memory["t"] = memory.get("t", 0) + 1
        for name, grad in grads.items():
            m, v = memory.get(name, (0.0, 0.0))
            m, v = 0.9 * m + 0.1 * grad, 0.995 * v + 0.005 * grad * grad
            memory[name] = m, v
            move = rate * (m / (1 - 0.9 ** memory["t"])) / (np.sqrt(v / (1 - 0.995 ** memory["t"])) + 1e-7)
            self.w[name] = (self.w[name] - move).astype(np.float32)

    def label(self, pages: list[list[Block]], most: int = 1 << 15) -> list[np.ndarray]:
        """For each page, which of its blocks are main text; pages of similar length go together, each is read whole."""
        x = features(pages)
        lengths = np.array([len(p) for p in pages], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        order = np.argsort(lengths, kind="stable")
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * lengths[order[end]] <= most:
                end += 1
            part, at = order[at:end], end
            steps = int(lengths[part].max())
            if steps:
                batch = np.zeros((len(part), steps, DIMS), np.float32)
                for row, page in enumerate(part):
                    batch[row, : lengths[page]] = x[starts[page] : starts[page + 1]]
                z = self.logits(batch, lengths[part])
                for row, page in enumerate(part):
                    out[page] = z[row, : lengths[page]] > 0
        return out


#: Words in paths by which the table's own pages are labelled for training, and the names that made pages use.
MAIN_NAMES = frozenset({"article", "main", ".article", ".post", ".entry", ".story"})
OTHER_NAMES = frozenset(
    "nav header footer aside form menu button dialog .nav .menu .header .footer .sidebar .aside .ad .ads .advert .advertisement .sponsored .promo"
    " .banner .cookie .notice .consent .popup .modal .newsletter .subscribe .share .social .related .comment .comments .reply .breadcrumb"
    " .breadcrumbs .pagination .widget .login .search .copyright .toolbar .tags .complementary .contentinfo .navigation".split()
)


def teacher(block: Block) -> int | None:
    """Label of a block of a real page by its path; none where the path does not tell."""
    names = set(block.path)
    if names & OTHER_NAMES:
        return 0
    return 1 if names & MAIN_NAMES else None


def _prose(draw: random.Random, words: list[str], low: int, high: int) -> str:
    text = " ".join(draw.choices(words, k=draw.randint(low, high)))
    return text[:1].upper() + text[1:] + draw.choice([".", ".", ".", "", "!", "?"])


def made_page(draw: random.Random, words: list[str]) -> tuple[list[Block], list[int]]:
    """A made page: sections of all kinds around an article, in varied markup, with its labels."""

    def el(tag: str, inner: str, name: str = "") -> str:
        attribute = f' {draw.choice(["class", "class", "id"])}="{name}"' if name else ""
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def items(low: int, high: int, size: int = 3) -> str:
        return "".join(el("li", f'<a href="#">{_prose(draw, words, 1, size)}</a>') for _ in range(draw.randint(low, high)))

    def short(phrases: list[str]) -> str:
        return draw.choice(phrases) + " " + _prose(draw, words, 0, 12)

    def paragraphs(low: int, high: int, longest: int = 60) -> str:
        return "".join(el("p", _prose(draw, words, 1, draw.choice([4, 15, longest]))) for _ in range(draw.randint(low, high)))

    ads = ["Advertisement", "Sponsored", "Buy now", "Special offer", ""]
    cookies = ["This site uses cookies.", "We value your privacy.", "Accept all cookies", "By using this site you agree"]
    rights = ["© 2024", "Copyright", "All rights reserved.", "Privacy Policy", "Terms of use", "©"]
    other = {
        "nav": lambda: el(draw.choice(["nav", "div", "ul"]), el("ul", items(3, 9)), draw.choice(["", "nav", "menu", "navbar navigation", "main-nav"])),
        "header": lambda: el(draw.choice(["header", "div"]), el(draw.choice(["h1", "p", "div", "span"]), _prose(draw, words, 1, 4)), draw.choice(["header", "site-header", "masthead banner"])),
        "ad": lambda: el(draw.choice(["div", "aside", "section"]), draw.choice([short(ads), el("p", short(ads)), _prose(draw, words, 3, 14)]), draw.choice(["ad", "ads", "advert", "advertisement", "sponsored", "promo banner"])),
        "notice": lambda: el("div", el(draw.choice(["p", "span", "div"]), short(cookies)) + draw.choice(["", "<button>Accept</button>"]), draw.choice(["cookie", "cookie-notice", "consent", "notice", "popup modal"])),
        "form": lambda: el("form", el("label", short(["Email", "Name", "Search"])) + "<input><button>" + draw.choice(["Send", "Subscribe", "Log in"]) + "</button>", draw.choice(["", "search", "newsletter", "login", "subscribe"])),
        "sidebar": lambda: el(draw.choice(["aside", "div"]), draw.choice([paragraphs(1, 3, 15), el("h3", short(["Related", "Popular", "Archive"])) + el("ul", items(2, 6, 7))]), draw.choice(["sidebar", "aside widget", "related", "right-sidebar"])),
    }
    footers = {
        "comments": lambda: el(draw.choice(["section", "div", "ol"]), el("h3", draw.choice(["Comments", "3 comments", "Leave a reply"])) + "".join(el(draw.choice(["div", "li", "article"]), el("p", _prose(draw, words, 2, 25)), "comment") for _ in range(draw.randint(1, 5))), draw.choice(["comments", "comment-list", "comments reply"])),
        "share": lambda: el("div", el("a", "Share") + " " + el("a", "Tweet"), draw.choice(["share", "social", "share-buttons"])),
        "tags": lambda: el(draw.choice(["ul", "div"]), items(1, 4, 2), draw.choice(["tags", "breadcrumb", "pagination"])),
    }
    heading = f"<h1>{_prose(draw, words, 2, 12)}</h1>"
    body = [heading] + [
        draw.choice(
            [
                lambda: el("p", _prose(draw, words, 1, 70)),
                lambda: el("p", _prose(draw, words, 1, 70)),
                lambda: "<p>" + _prose(draw, words, 1, 70),
                lambda: "<p><b>" + _prose(draw, words, 1, 20) + "<br>",
                lambda: el("p", _prose(draw, words, 1, 5)),
                lambda: el("p", short(rights)),
                lambda: el("h2", _prose(draw, words, 1, 7)),
                lambda: el(draw.choice(["ul", "ol"]), "".join(el("li", _prose(draw, words, 2, 20)) for _ in range(draw.randint(2, 4)))),
                lambda: el("blockquote", _prose(draw, words, 4, 30)),
                lambda: el("p", _prose(draw, words, 3, 12) + ' <a href="#">' + _prose(draw, words, 1, 4) + "</a> " + _prose(draw, words, 3, 12)),
                lambda: el("pre", _prose(draw, words, 3, 15)),
            ]
        )()
        for _ in range(draw.randint(1, 14))
    ]
    # Sections of the frame are marked by a private element, so that labels follow from where a block stands.
    mark = lambda section: f"<x-other>{section}</x-other>"
    for _ in range(draw.choice([0, 0, 0, 1, 2])):
        kind = draw.choice(["ad", "form", "sidebar", "share"])
        body.insert(draw.randint(1, len(body)), mark((other | footers)[kind]()))
    tail = [mark(footers[k]()) for k in footers if draw.random() < 0.25]
    inside = draw.random() < 0.5
    core = "".join(body + (tail if inside else []))
    wrap = draw.choice(["article"] * 4 + ["main", "div", "div", "section", "td", "body"])
    name = draw.choice(["article", "post", "post-content", "entry-content", "story body", "content", "text"]) if wrap in ("div", "section") else draw.choice(["", "", "post"])
    core = core if wrap == "body" else "<table><tr>" + el("td", core, name) + "</tr></table>" if wrap == "td" else el(wrap, core, name)
    if draw.random() < 0.2:
        core = el("main", core)
    frame = [mark(other[k]()) for k in other if draw.random() < (0.7 if k in ("nav", "ad") else 0.35)]
    draw.shuffle(frame)
    middle = len(frame) * 2 // 3
    last = [mark(el(draw.choice(["footer", "footer", "div"]), draw.choice([short(rights), el("p", short(rights)), short(rights) + _prose(draw, words, 2, 15)]), draw.choice(["footer", "site-footer", "copyright"])))] if draw.random() < 0.9 else []
    page = "<body>" + "".join([*frame[:middle], core, *([] if inside else tail), *frame[middle:], *last]) + "</body>"
    found = blocks(page)
    labels = [int("x-other" not in b.path) for b in found]
    for b in found:
        tokens = tuple(t for t in b.path if t != "x-other")
        b.element = Element(tokens[0], tokens, None) if tokens else None
    return found, labels


def fit(pages: list[str], seed: int = 7, epochs: int = 7, rate: float = 0.006, batch: int = 24) -> Labeller:
    """Train on the given pages, labelled by their paths, and on made pages with words of the former."""
    draw = random.Random(seed)
    rows: list[tuple[list[Block], list[int | None]]] = [(found, [teacher(b) for b in found]) for found in map(blocks, sorted(pages))]
    words = [w for found, _ in rows for b in found for w in b.text.split() if len(w) < 20][:20000] or "the of and in to words here".split()
    rows += [made_page(draw, words) for _ in range(MADE_PAGES)]
    rows = [(found, labels) for found, labels in rows if 0 < len(found) <= LONGEST_TRAINED]
    inputs = [features([found]) for found, _ in rows]
    model, memory, rng = Labeller(seed), {}, np.random.default_rng(seed)
    total, done = epochs * -(-len(rows) // batch), 0
    for _ in range(epochs):
        # Batches of pages of similar length, in a drawn order.
        order = sorted(range(len(rows)), key=lambda i: len(rows[i][0]) + rng.random() * 6)
        parts = [order[at : at + batch] for at in range(0, len(order), batch)]
        for k in rng.permutation(len(parts)):
            part = parts[k]
            lengths = np.array([len(rows[i][0]) for i in part])
            x, y = np.zeros((len(part), lengths.max(), DIMS), np.float32), np.zeros((len(part), lengths.max()), np.float32)
            for row, i in enumerate(part):
                x[row, : lengths[row]] = inputs[i]
                y[row, : lengths[row]] = [0.5 if label is None else label for label in rows[i][1]]
            model.step(x, lengths, y, rate * (1 - 0.9 * done / total), memory)
            done += 1
    return model


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Labeller:
    """The labeller, from SAMPLE_PAGES pages of the table (least hashed ids) and MADE_PAGES made ones."""
    ids = pages.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct()
    ids = [r.id for r in ids.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PAGES).collect()]
    chosen = pages.where(F.col(id_col).cast("long").isin(ids) & (F.length(html_col) < LONGEST_SAMPLED)).groupBy(F.col(id_col).alias("id"))
    return fit([r.page for r in chosen.agg(F.min(html_col).alias("page")).collect()])


def extract(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) for every row: the blocks that the model labels as main text, joined by empty lines.

    References are decoded, white space inside a block is one space, nothing else is dropped. Null and
    empty pages, and pages without main text, give an empty text; broken markup ends with the page;
    repeated rows and null ids are kept; extra columns are ignored; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200)
                found = [blocks(v.as_py() or "") for v in rows.column(2)]
                texts = [
                    "\n\n".join(b.text for b, main in zip(page, labels, strict=True) if main)
                    for page, labels in zip(found, model.label(found), strict=True)
                ]
                columns = [rows.column(0), rows.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([len(p) for p in found], pa.int64())], ["page_id", "url", "text", "n_chars", "n_blocks"]
                )

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long")
