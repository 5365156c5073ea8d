"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks, runs of text between block tags.  A block
is a vector of its hashed tag path, class and id words, its hashed words and a
few figures; a bidirectional LSTM reads the blocks of a whole page in order, so
each is labelled in the context of the document.  The network is trained here
in numpy: on pages made from templates with known labels, and on a bounded
sample of pages (TRAIN_PAGES, chosen by hash) whose blocks are labelled by the
names of the elements they stand in, with these names and without them.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftroll.llm.sample import rows_by_hash
from shiftroll.llm.words import batches, word_hashes

TRAIN_PAGES, MADE_PAGES = 300, 500
PATH_BUCKETS, WORD_BUCKETS, FIGURES = 64, 16, 6
INPUTS = PATH_BUCKETS + WORD_BUCKETS + FIGURES
HIDDEN = 12
EPOCHS, BATCH, RATE = 12, 32, 0.02
#: Blocks that the network is taught at once.
LESSON = 400
THRESHOLD = 0.5
#: Pages whose blocks are labelled at once, by their blocks in all.
BLOCKS_AT_ONCE = 20_000

# Fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img svg math object".split()
)
#: Skipped to their end tag; without one, to the end of the page.
RAW = frozenset("script style noscript template textarea title iframe".split())
#: Other elements than those of HTML stand in these, all of them inline.
FOREIGN = frozenset("svg math".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
CLOSE_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
#: Parts of FOREIGN whose text does not run on.
SPACED = frozenset("text tspan mtr mtd annotation foreignobject".split())
#: Begin outside of FOREIGN, whether that was closed or not.
BREAKOUT = CLOSE_P | CLOSES.keys() | {"body"}
# Names that tell what a part of a page is for
MAIN_TAGS = frozenset("article main".split())
OTHER_TAGS = frozenset("nav footer aside form button select menu dialog head".split())
OTHER_NAMES = frozenset(
    "ad ads advert advertisement sponsor sponsored promo banner sidebar comment comments reply respond cookie cookies consent notice alert "
    "popup modal newsletter subscribe signup login nav navbar navigation menu breadcrumb breadcrumbs footer header masthead share social "
    "related recommended widget tags pagination copyright".split()
)
# The value of an attribute may hold quotes, if it isn't in quotes itself.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?>"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+)>""", re.S
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@lru_cache(maxsize=1 << 14)
def _name_bucket(name: str) -> tuple[int, float]:
    h = xxhash.xxh32_intdigest(name)
    return h % PATH_BUCKETS, 1.0 if h >> 16 & 1 else -1.0


class Place:
    """Where a block stands: an element, with the elements around it.

    Siblings of the same names share one, and what is known of a path is kept
    as it grows, so a page takes no more for being deep."""

    __slots__ = ("outer", "names", "size", "last", "sums", "vector", "main", "other", "inner", "hidden")

    def __init__(self, outer: Place | None = None, names: tuple[str, ...] = ()) -> None:
        self.outer, self.names, self.inner = outer, names, {}
        self.hidden = self if outer is None else None
        self.size = len(names) + (outer.size if outer else 0)
        self.last = ((outer.last if outer else ()) + names)[-3:]
        self.sums = outer.sums.copy() if outer else np.zeros(PATH_BUCKETS, dtype=np.float32)
        for bucket, sign in map(_name_bucket, names):
            self.sums[bucket] += sign
        self.vector = self.sums / 2  # the last three count twice
        for bucket, sign in map(_name_bucket, self.last):
            self.vector[bucket] += sign / 2
        self.main = bool(outer and outer.main) or any(x in MAIN_TAGS for x in names)
        self.other = bool(outer and outer.other) or any(x in OTHER_TAGS or x[0] == "." and x[1:] in OTHER_NAMES for x in names)

    def within(self, names: tuple[str, ...]) -> Place:
        found = self.inner.get(names)
        if found is None:
            found = self.inner[names] = Place(self, names)
        return found

    def path(self) -> tuple[str, ...]:
        levels, at = [], self
        while at is not None:
            levels.append(at.names)
            at = at.outer
        return tuple(x for names in reversed(levels) for x in names)

    def nameless(self) -> Place:
        """This place in a page that tells nothing by names: no class and id words, plain boxes for telling elements."""
        levels, at = [], self
        while at.hidden is None:
            levels.append(at)
            at = at.outer
        for level in reversed(levels):
            kept = ("div" if x in MAIN_TAGS or x in OTHER_TAGS else x for x in level.names if x[0] != ".")
            level.hidden = level.outer.hidden.within(tuple(kept))
        return self.hidden


class Leaf(NamedTuple):
    text: str
    place: Place
    linked: int  # code points inside links

    @property
    def path(self) -> tuple[str, ...]:
        """Tags and, with a dot, class and id words."""
        return self.place.path()


def leaves(page: str) -> list[Leaf]:
    """The text blocks of a page in order, character references decoded and white space made one space."""
    found: list[Leaf] = []
    stack: list[tuple[str, Place]] = []
    depths: dict[str, list[int]] = defaultdict(list)  # places of each name in the stack
    unended: set[str] = set()  # without an end tag from here on
    parts: list[str] = []
    linked = at = 0
    root = place = Place()
    tags_end = page.rfind(">") + 1

    def end() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            found.append(Leaf(text, place, min(linked, len(text))))
        parts.clear()
        linked = 0

    def push(name: str, names: tuple[str, ...]) -> None:
        outer = stack[-1][1] if stack else root
        depths[name].append(len(stack))
        stack.append((name, outer if name in INLINE or not names else outer.within(names)))

    def cut(depth: int) -> None:
        while len(stack) > depth:
            depths[stack.pop()[0]].pop()

    def deepest(names: Iterable[str]) -> int:
        return max((depths[x][-1] for x in names if depths.get(x)), default=-1)

    def close(names: Iterable[str], limits: Iterable[str] = ()) -> None:
        k = deepest(names)
        if k >= 0 and k >= deepest(limits):
            cut(k)

    while True:
        token = _TOKEN.search(page, at, tags_end)
        text = page[at : token.start() if token else len(page)]
        if token is None:
            text = text.partition("<!--")[0]
        if text:
            parts.append(text)
            if depths.get("a"):
                linked += len(text)
        if token is None:
            break
        at = token.end()
        if token[2] is None:
            if token[0].startswith("<!--") and not token[0].endswith("-->"):
                break
            continue
        name, closing = token[2].lower(), bool(token[1])
        if name == "br":
            parts.append(" ")
            continue
        first = min((depths[x][0] for x in FOREIGN if depths.get(x)), default=len(stack))
        if not closing and name in BREAKOUT:
            cut(first)
        foreign = first < len(stack)
        own = depths.get(name)
        outer = name in BREAKOUT if not closing else bool(own) and own[-1] < first
        inside = foreign and not outer
        if inside and name in SPACED:
            parts.append(" ")
        if name not in INLINE and not inside:
            end()
        if closing:
            close((name,))
        else:
            if name in CLOSE_P:
                close(("p",), ("td", "th", "li", "article", "div", "body", "section"))
            if name in CLOSES:
                close(CLOSES[name], ("ul", "ol", "dl", "table", "select", "menu"))
            empty = token[3].rstrip().endswith("/")
            stop = None
            if inside and name in RAW and not empty and name not in unended:  # no further than the element of FOREIGN
                stop = re.compile(rf"</(?:{re.escape(name)}|svg|math)\s*>", re.I).search(page, at)
                if stop is None:
                    unended.add(name)
            if stop:
                at = stop.end() if stop[0][2:].lower().startswith(name) else stop.start()
            elif name in RAW and not inside:
                stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = stop.end() if stop else len(page)
            elif inside and not empty:
                push(name, ())
            elif name not in VOID and not empty:
                words = [w for m in _NAMES.finditer(token[3]) for w in _NAME.findall((m[1] or m[2] or m[3] or "").lower())]
                push(name, (name, *("." + w for w in words)))
        place = stack[-1][1] if stack else root
    end()
    return found


def taught(leaf: Leaf) -> int:
    """What the names of the elements say: 1 inside an article and no other part of a page."""
    return int(leaf.place.main and not leaf.place.other)


def vectors(page: list[Leaf], start: int = 0, stop: int | None = None) -> np.ndarray:
    """Inputs of the blocks of a page, or of some of them: hashed tag path, shares of hashed words, figures."""
    some = page[start:stop]
    out = np.zeros((len(some), INPUTS), dtype=np.float32)
    hashes, at = word_hashes([x.text.lower().encode("utf-8", "replace") for x in some])
    counts = np.diff(at)
    rows = np.repeat(np.arange(len(some)), counts)
    sign = np.where(hashes >> np.uint64(40) & np.uint64(1), 1.0, -1.0) / counts[rows]
    buckets = rows * WORD_BUCKETS + (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
    words = np.bincount(buckets, weights=sign, minlength=len(some) * WORD_BUCKETS)
    out[:, PATH_BUCKETS : PATH_BUCKETS + WORD_BUCKETS] = words.reshape(len(some), WORD_BUCKETS)
    for k, leaf in enumerate(some):
        n = len(leaf.text)
        out[k, :PATH_BUCKETS] = leaf.place.vector
        out[k, -FIGURES:] = [
            np.log1p(n) / 5, leaf.linked / n, leaf.text[-1] in ".!?:…\"”", leaf.place.size / 8, (start + k) / len(page), 1.0
        ]
    return out


class Network(NamedTuple):
    wx: np.ndarray  # 2 x INPUTS x 4 HIDDEN, gates input, forget, output, new
    wh: np.ndarray
    b: np.ndarray
    out: np.ndarray  # 2 HIDDEN
    bias: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _way(net: Network, way: int, x: np.ndarray, there: np.ndarray, h: np.ndarray, c: np.ndarray, kept: list | None = None):
    """States of one direction over some steps, from the state ``h``, ``c`` on, and the state at their end."""
    steps = len(x)
    states = np.zeros((steps, x.shape[1], HIDDEN), dtype=np.float32)
    from_x = x @ net.wx[way] + net.b[way]
    for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
        on = there[t][:, None]
        gates = from_x[t] + h @ net.wh[way]
        i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        cell = np.tanh(c_new := f * c + i * g)
        if kept is not None:
            kept.append((way, t, h, c, i, f, o, g, cell))
        h, c = on * o * cell + (1 - on) * h, on * c_new + (1 - on) * c
        states[t] = h
    return states, h, c


def forward(net: Network, x: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Logits of blocks, and all that training needs; x: T x B x INPUTS, there: T x B."""
    zero, kept = np.zeros((x.shape[1], HIDDEN), dtype=np.float32), []
    states = np.concatenate([_way(net, way, x, there, zero, zero, kept)[0] for way in range(2)], axis=2)
    return states @ net.out + net.bias[0], states, kept


def scored(net: Network, pages: list[list[Leaf]]) -> np.ndarray:
    """Logits of the blocks of some pages, T x B.

    The blocks are read BLOCKS_AT_ONCE at a time, forth and back, so that of a
    long page only the logits are kept."""
    steps = max(len(p) for p in pages)
    stride = max(1, BLOCKS_AT_ONCE // len(pages))
    spans = [(a, min(a + stride, steps)) for a in range(0, steps, stride)]
    read = lru_cache(maxsize=1)(lambda a, b: _padded([vectors(p, a, b) for p in pages], b - a))
    logits = np.full((steps, len(pages)), net.bias[0], dtype=np.float32)
    for way in range(2):
        h = c = np.zeros((len(pages), HIDDEN), dtype=np.float32)
        for a, b in spans if way == 0 else spans[::-1]:
            states, h, c = _way(net, way, *read(a, b), h, c)
            logits[a:b] += states @ net.out[way * HIDDEN : (way + 1) * HIDDEN]
    return logits


def _slopes(net: Network, x: np.ndarray, there: np.ndarray, y: np.ndarray) -> Network:
    logits, states, kept = forward(net, x, there)
    error = (there * (_sigmoid(logits) - y) / there.sum()).astype(np.float32)
    d_states = error[:, :, None] * net.out
    wx, wh, b = np.zeros_like(net.wx), np.zeros_like(net.wh), np.zeros_like(net.b)
    zero = np.zeros((x.shape[1], HIDDEN), dtype=np.float32)
    dh_of, dc_of = [zero, zero], [zero, zero]
    for way, t, h, c, i, f, o, g, cell in reversed(kept):
        on = there[t][:, None]
        dh = dh_of[way] + d_states[t, :, way * HIDDEN : (way + 1) * HIDDEN]
        dc_out = dc_of[way]
        d_o = dh * on * cell
        dc = dc_out * on + dh * on * o * (1 - cell * cell)
        d = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), d_o * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        wx[way] += x[t].T @ d
        wh[way] += h.T @ d
        b[way] += d.sum(axis=0)
        dh_of[way] = d @ net.wh[way].T + dh * (1 - on)
        dc_of[way] = dc * f + dc_out * (1 - on)
    return Network(wx, wh, b, np.tensordot(error, states, 2), np.array([error.sum()], dtype=np.float32))


def _padded(pages: list[np.ndarray], steps: int) -> tuple[np.ndarray, np.ndarray]:
    x, there = np.zeros((steps, len(pages), INPUTS), dtype=np.float32), np.zeros((steps, len(pages)), dtype=np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k] = p
        there[: len(p), k] = 1
    return x, there


def made_page(rng: np.random.Generator, misleading: bool = False) -> list[tuple[Leaf, int]]:
    """A page from templates of common layouts, its blocks labelled by the template.

    In a misleading one the names of the article and of the other parts say nothing, or the contrary."""
    letters = list("abcdefghijklmnopqrstuvwxyz")

    def text(low: int, high: int) -> str:
        words = ["".join(rng.choice(letters, rng.integers(2, 10))) for _ in range(rng.integers(low, high))]
        return " ".join(words) + ("." if rng.random() < 0.7 and high > 8 else "")

    top = Place().within(("html",)).within(("body",))

    def leaf(path: tuple[str, ...], low: int, high: int, link: bool = False) -> Leaf:
        t, place = text(low, high), top
        for x in path:
            place = place.within((x,))
        return Leaf(t, place, len(t) if link else 0)

    names = sorted(OTHER_NAMES)
    some = lambda: names[int(rng.integers(len(names)))]
    before = [("nav", "ul", "li"), ("header", "div"), ("header", "nav", "ul", "li"), ("div", ".menu", "ul", "li"), ("div", "." + some()), ("form",)]
    after = [("footer",), ("footer", "p"), ("aside", "ul", "li"), ("aside", "div", "p"), ("div", "." + some(), "p"), ("div", "." + some(), "ul", "li"), ("section", ".comments", "p"), ("form", "p")]
    root = [("article",), ("main",), ("main", "article"), ("div", ".content", "article"), ("div", ".post", ".content"), ("article", "section"), ("main", "div", ".entry")][int(rng.integers(7))]
    if misleading:
        root = [("div",), ("div", "." + some()), ("section", "div"), ("div", ".widget", "div")][int(rng.integers(4))]
        before = [("div", "ul", "li"), ("div", ".content", "ul", "li"), ("div", ".post"), ("div",)]
        after = [("div", ".content", "ul", "li"), ("div", "ul", "li"), ("div", ".entry"), ("div",)]
    page = []
    for path in rng.permutation(len(before))[: rng.integers(0, 4)]:
        kind = before[int(path)]
        page += [(leaf(kind, 1, 8 if "li" in kind else 20, "li" in kind), 0) for _ in range(rng.integers(1, 8))]
    page.append((leaf((*root, "h1"), 2, 14), 1))
    for _ in range(rng.integers(1, 20)):
        kind = ("p", "p", "p", "p", "h2", "blockquote", "pre", "ul li", "table tr td")[int(rng.integers(9))].split()
        page.append((leaf((*root, *kind), 1, 90), 1))
        if rng.random() < 0.08:
            inside = [("aside", "p"), ("div", "." + some()), ("div", "." + some(), "p"), ("form", "p")][int(rng.integers(4))]
            page.append((leaf((*root, *inside), 2, 30), 0))
    for path in rng.permutation(len(after))[: rng.integers(0, 4)]:
        kind = after[int(path)]
        page += [(leaf(kind, 1, 40, "li" in kind), 0) for _ in range(rng.integers(1, 6))]
    return page


def nameless(page: list[tuple[Leaf, int]]) -> list[tuple[Leaf, int]]:
    return [(x._replace(place=x.place.nameless()), y) for x, y in page]


def train(pages: list[str]) -> Network:
    """A network for pages with and without telling names.

    Made pages are labelled by their templates, a sixth of them misleading.  Given
    pages are labelled by their names, and every page that has a main text is
    taught twice: once as it is, once without the names that its labels came
    from, so that text, links, structure and neighbours must tell."""
    rng = np.random.default_rng(11)
    lessons = [made_page(rng, k % 6 == 0) for k in range(MADE_PAGES)]
    cut = [[(x, taught(x)) for x in leaves(p)] for p in pages]
    lessons += [p for p in cut if any(y for _, y in p)]
    lessons += [nameless(p) for k, p in enumerate(lessons) if k >= MADE_PAGES or k % 2]
    whole = [(vectors([x for x, _ in p]), np.array([y for _, y in p], dtype=np.float32)) for p in lessons]
    # a long page teaches in parts
    data = [(x[a : a + LESSON], y[a : a + LESSON]) for x, y in whole for a in range(0, len(y), LESSON)]
    net = Network(
        rng.normal(0, 0.2, (2, INPUTS, 4 * HIDDEN)).astype(np.float32),
        rng.normal(0, 0.2, (2, HIDDEN, 4 * HIDDEN)).astype(np.float32),
        np.zeros((2, 4 * HIDDEN), dtype=np.float32),
        rng.normal(0, 0.3, 2 * HIDDEN).astype(np.float32),
        np.zeros(1, dtype=np.float32),
    )
    first, second, step = [np.zeros_like(w) for w in net], [np.zeros_like(w) for w in net], 0
    lengths = np.array([len(y) for _, y in data])
    for _ in range(EPOCHS):
        order = np.argsort(lengths + rng.random(len(data)) * 8)
        groups = np.array_split(order, max(1, len(order) // BATCH))
        for k in rng.permutation(len(groups)):
            some = groups[int(k)]
            x, there = _padded([data[i][0] for i in some], max(len(data[i][1]) for i in some))
            y = np.zeros_like(there)
            for j, i in enumerate(some):
                y[: len(data[i][1]), j] = data[i][1]
            step += 1
            updated = []
            for j, (w, g) in enumerate(zip(net, _slopes(net, x, there, y), strict=True)):
                first[j], second[j] = 0.9 * first[j] + 0.1 * g, 0.99 * second[j] + 0.01 * g * g
                move = (first[j] / (1 - 0.9**step)) / (np.sqrt(second[j] / (1 - 0.99**step)) + 1e-7)
                updated.append((w - RATE * move).astype(np.float32))
            net = Network(*updated)
    return net


def labelled(net: Network, pages: list[list[Leaf]]) -> list[np.ndarray]:
    """Probability of each block of each page to be main text; pages of like length go together."""
    out = [np.zeros(0, dtype=np.float32) for _ in pages]
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    while order:
        longest = len(pages[order[-1]])
        some = order[-max(1, BLOCKS_AT_ONCE // longest) :]
        del order[-len(some) :]
        chances = _sigmoid(scored(net, [pages[k] for k in some]))
        for j, k in enumerate(some):
            out[k] = chances[: len(pages[k]), j]
    return out


def main_texts(net: Network, pages: list[str], threshold: float = THRESHOLD) -> list[str]:
    cut = [leaves(p) for p in pages]
    return [
        " ".join(x.text for x, y in zip(blocks, chance.tolist(), strict=True) if y >= threshold)
        for blocks, chance in zip(cut, labelled(net, cut), strict=True)
    ]


def learned(pages: DataFrame, rows: int = TRAIN_PAGES) -> Network:
    """A labeller that has seen up to ``rows`` of the pages."""
    usable = pages.filter(F.col("html").isNotNull())
    chosen = rows_by_hash(usable.select("page_id"), rows, key="page_id").distinct()
    found = usable.select("page_id", "html").join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min("html").alias("html"))
    return train([r["html"] for r in found.orderBy("page_id").collect()])


def extracted(pages: DataFrame, net: Network) -> DataFrame:
    """page_id, url, text and n_chars of every page; NULL and empty pages, and pages without main text, have the empty text."""
    sent = pages.sparkSession.sparkContext.broadcast(net)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, htmls in batches(rows, 2, 4 << 20):
            texts = main_texts(sent.value, [(h or b"").decode("utf-8", "replace") for h in htmls])
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
