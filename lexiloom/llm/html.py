"""HTML extraction with a recurrent block labeller.

A page is a sequence of leaf blocks: text between block-level tags, with the path
of elements above it. A bidirectional LSTM reads hashed vectors of path and words
and says of each block, knowing all others, whether it belongs to the main text.
It is trained on a bounded sample of pages, on blocks of which the nearest element
with a telling name says what they are. Names are hints only: an element around
most of a page's text tells nothing, whatever its name. As no corpus has all
layouts, each sampled page is used several times with landmarks renamed, left out
or put around the wrong blocks, and with blocks of other kinds put in.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.lstm import BlockLabeller
from lexiloom.llm.sampling import least_by_hash
from lexiloom.llm.words import pieces, split_words

PATH = 512
WORDS = 64
NUMBERS = 12
SIZE = 16
# Pages trained on, by hash order, and the largest of them in bytes.
SAMPLE = 200
SAMPLE_BYTES = 200_000
VARIANTS = 8
EPOCHS = 6
# Blocks whose vectors are in memory at a time.
BLOCKS = 4096
PAGES = 64

# Elements by the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rt s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
NO_TEXT = set("script style template svg".split())
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
    "nav ol p pre section table ul".split()
)
CLOSES_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}
# What begins a line of its own; any other element, known or not, runs on in the line.
OWN_LINE = CLOSES_P | set(
    "body caption center dialog dd dt head html iframe legend li noscript optgroup option select summary tbody td "
    "textarea tfoot th thead title tr".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())

# Names of tags, classes and ids that tell what a block is.
CONTENT_TAGS = set("article main".split())
OTHER_TAGS = set("nav aside footer header form select textarea dialog menu head title".split())
CONTENT_NAMES = ("article", "main", "content", "post", "entry", "story", "articlebody")
COMMENT_NAMES = ("comment", "comments", "discussion", "reply", "replies", "disqus", "respond")
OTHER_NAMES = (
    "nav", "menu", "header", "masthead", "banner", "footer", "sidebar", "aside", "widget", "related", "notice", "cookie",
    "consent", "alert", "ad", "ads", "advert", "advertisement", "sponsor", "promo", "form", "newsletter", "subscribe",
    "search", "login", "share", "social", "breadcrumb", "pagination", "dialog", "popup", "modal", *COMMENT_NAMES,
)
# Names that tell nothing, and names a wrapper may have by bad luck.
PLAIN_NAMES = ("", "wrap", "container", "inner", "row", "col", "box", "block", "region", "panel", "grid", "layout")
UNLUCKY = (
    "aspnet-form", "post-header", "has-sidebar", "related-posts-enabled", "form-page", "page-widget", "no-ads", "header-fixed",
    "comments-open", "login-required", "search-page", "menu-open",
)
_CONTENT, _OTHER, _COMMENT = set(CONTENT_NAMES), set(OTHER_NAMES), set(COMMENT_NAMES)

_SPACES = re.compile(r"\s+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
# A tag up to its end outside of quotes; else, where a quote stays open, up to any end.
_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*+)([^>]*+)>")
_NAMED = re.compile(r"""(?<![\w-])(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_RAW_END = {tag: re.compile(rf"</{tag}\b", re.IGNORECASE) for tag in ("script", "style")}


# A tag, and the names its element has, their parts joined by hyphens.
Element = tuple[str, ...]


@dataclass(frozen=True)
class Block:
    path: tuple[Element, ...]
    text: str
    linked: int


class _Reader:
    def __init__(self):
        self.open: list[Element] = []
        self.many: Counter[str] = Counter()
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.path: tuple[Element, ...] = ()

    def flush(self) -> None:
        if self.parts:
            text = _SPACES.sub(" ", "".join(self.parts)).strip()
            if text:
                self.blocks.append(Block(self.path, text, self.linked))
            self.parts, self.linked = [], 0

    def _close_to(self, place: int) -> None:
        if any(element[0] in OWN_LINE for element in self.open[place:]):
            self.flush()
        self.many.subtract(element[0] for element in self.open[place:])
        del self.open[place:]

    def _last(self, tag: str, within: tuple[str, ...] = ()) -> int:
        if not self.many[tag]:
            return -1
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place][0] == tag:
                return place
            if self.open[place][0] in within:
                return -1
        return -1

    def start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P and (place := self._last("p", ("table", "button"))) >= 0:
            self._close_to(place)
        if tag in CLOSES_SAME and (place := self._last(tag, CLOSES_SAME[tag])) >= 0:
            self._close_to(place)
        if tag == "br":
            self.parts.append(" ")
        elif tag in OWN_LINE:
            self.flush()
        if tag not in VOID:
            values = ("".join(found) for found in _NAMED.findall(attributes)) if "=" in attributes else ()
            names = {"-".join(_PART.findall(name)).lower() for value in values for name in value.split()}
            self.open.append((tag, *sorted(names - {""})))
            self.many[tag] += 1

    def end(self, tag: str) -> None:
        place = self._last(tag)
        if place >= 0:
            self._close_to(place)
        elif tag == "p":
            self.flush()

    def data(self, data: str) -> None:
        if not data:
            return
        if "&" in data:
            data = unescape(data)
        if any(self.many[tag] for tag in NO_TEXT):
            return
        if not self.parts or not any(p.strip() for p in self.parts):
            self.path = tuple(element for element in self.open if element[0] not in INLINE)
        self.parts.append(data)
        if self.many["a"]:
            self.linked += len(data.strip())


def read_blocks(html: str) -> list[Block]:
    """Leaf blocks in page order. Every character is looked at a few times at most,
    however broken the page; what an open comment or tag swallows at its end is lost."""
    reader, at, last_end = _Reader(), 0, html.rfind(">")
    while at < len(html):
        begin = html.find("<", at)
        reader.data(html[at:begin] if begin >= 0 else html[at:])
        if begin < 0:
            break
        if html.startswith("<!--", begin):
            end = html.find("-->", begin + 4)
            if end < 0:
                break
            at = end + 3
            continue
        closing = html.startswith("/", begin + 1)
        letter = html[begin + 1 + closing : begin + 2 + closing]
        marked = letter.isascii() and letter.isalpha()
        if not marked and letter not in ("!", "?"):
            reader.data("<")
            at = begin + 1
            continue
        if begin > last_end:  # cut off by the end of the page
            break
        match = marked and (_TAG.match(html, begin) or _LOOSE_TAG.match(html, begin))
        if not match:  # a declaration
            at = html.find(">", begin) + 1
            continue
        at, tag = match.end(), match[1].lower()
        if closing:
            reader.end(tag)
            continue
        reader.start(tag, match[2])
        if tag in _RAW_END:
            raw = _RAW_END[tag].search(html, at)
            if not raw:
                break
            at = raw.start()
        elif tag not in VOID and match[2].endswith("/"):
            reader.end(tag)
    reader.flush()
    return reader.blocks


@lru_cache(maxsize=200_000)
def _hash(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace"))


@lru_cache(maxsize=100_000)
def kind_of(element: Element) -> int | None:
    """1 for an element of main text, 0 for another kind, None where its names do not say.

    The tag counts first, then whole names and last parts (a ``post-header`` is a
    header), then first parts (``comment-body``). On elements made for main text
    only the names of comments tell otherwise.
    """
    tag, names = element[0], element[1:]
    if tag in ("html", "body"):
        return None
    last = {*names, *(n.rsplit("-", 1)[-1] for n in names)}
    if tag in CONTENT_TAGS:
        return 0 if last & _COMMENT else 1
    if tag in OTHER_TAGS or last & _OTHER:
        return 0
    if last & _CONTENT:
        return 1
    first = {n.split("-", 1)[0] for n in names}
    return 0 if first & _OTHER else 1 if first & {"article", "post", "entry", "story"} else None


def told_by(path: tuple[Element, ...], around: set[tuple[Element, ...]]) -> int | None:
    """What the nearest telling element says; ``around`` are places that tell nothing."""
    for depth in range(len(path), 0, -1):
        kind = kind_of(path[depth - 1])
        if kind is not None and path[:depth] not in around:
            if not kind and path[depth - 1][0] == "header" and path[-1][0] in HEADINGS and told_by(path[: depth - 1], around):
                return 1  # the heading of an article
            return kind
    return None


def surroundings(blocks: list[Block]) -> set[tuple[Element, ...]]:
    """Places, told by their names to be of another kind, that hold most of the page's
    text outside of links: they are wrappers. Comments may well be most of a page."""
    sizes: Counter[tuple[Element, ...]] = Counter()
    for block in blocks:
        sizes[block.path] += len(block.text) - min(block.linked, len(block.text))
    total, inside = sum(sizes.values()), Counter()
    for path, size in sizes.items():
        for depth in range(1, len(path) + 1):
            if kind_of(path[depth - 1]) == 0:
                inside[path[:depth]] += size
    return {p for p, size in inside.items() if 2 * size > total and not any(set(n.split("-")) & _COMMENT for n in p[-1][1:])}


def known_labels(blocks: list[Block]) -> list[int | None]:
    around = surroundings(blocks)
    return [told_by(block.path, around) for block in blocks]


@lru_cache(maxsize=50_000)
def _path_places(path: tuple[Element, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Where a path's names go in a vector, and their weights, less further up."""
    found: dict[int, float] = {}
    for up, element in enumerate(reversed(path)):
        weight = 0.6 if up < 3 else 0.2
        for name in (f"{min(up, 2)}/{element[0]}", element[0], *(part for n in element[1:] for part in n.split("-"))):
            place = _hash(name) % PATH
            found[place] = max(found.get(place, 0.0), weight)
    return np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.float32, len(found))


def vectors(blocks: list[Block], part: range | None = None) -> np.ndarray:
    """Hashed names of the path, hashed words, what the names tell, and shape, a row
    for each block of a page, or of a part of them."""
    part = part or range(len(blocks))
    out = np.zeros((len(part), PATH + WORDS + NUMBERS), np.float32)
    around = surroundings(blocks)
    places = {
        path: (told_by(path, around), *_path_places(tuple(e for d, e in enumerate(path, 1) if path[:d] not in around)))
        for path in {blocks[at].path for at in part}
    }
    total = sum(len(block.text) for block in blocks) or 1
    words = split_words(pa.array([blocks[at].text for at in part], pa.string()))
    hashed = words.rows() * WORDS + (words.hashes % np.uint64(WORDS)).astype(np.int64)
    shares = np.bincount(hashed, minlength=len(part) * WORDS).reshape(-1, WORDS) / np.maximum(words.counts, 1)[:, None]
    out[:, PATH : PATH + WORDS] = shares
    for row, (block, many) in enumerate(zip(blocks[part.start : part.stop], words.counts.tolist())):
        told, at, weights = places[block.path]
        out[row, at] = weights
        length, leaf = len(block.text), block.path[-1][0] if block.path else ""
        out[row, PATH + WORDS :] = (
            log1p(many) / 5,
            min(1.0, block.linked / max(length, 1)),
            log1p(sum(map(block.text.count, ".,;:!?"))) / 4,
            float(block.text[-1] in ".!?"),
            length / max(many, 1) / 10,
            1.0,
            2.0 * (told == 1),
            2.0 * (told == 0),
            float(leaf in HEADINGS),
            float(leaf == "p"),
            length / total,
            (part.start + row) / len(blocks),
        )
    return out


def variants(blocks: list[Block], pools: tuple[list[str], list[str]], count: int, random: np.random.Generator) -> Iterator[tuple[list[Block], list[int]]]:
    """The page, and versions of it with other landmarks and other kinds of blocks.

    Labels stay those of the page itself. In a version the elements of the main
    text, and often those of other kinds, get other names, none, or such as
    mislead; wrappers of unlucky names come around the page or the main text; and
    runs of blocks of other kinds are put in anywhere, with texts of any page
    under telling names and short texts (the second pool) under names that tell nothing.
    """
    labels = [label or 0 for label in known_labels(blocks)]
    if 1 not in labels:
        return
    yield blocks, labels

    def pick(values):
        return values[random.integers(len(values))]

    def plain(tag: str = "div") -> Element:
        name = pick(PLAIN_NAMES)
        return (tag, name) if name else (tag,)

    for _ in range(count):
        style = random.random()
        holder = ("div", pick(UNLUCKY)) if style < 0.15 else plain() if style < 0.6 else (pick(("section", "div", "main", "article")), pick(CONTENT_NAMES))
        hidden = random.random() < 0.5  # other kinds lose their names
        wrapper = ((pick(("form", "div")), pick(UNLUCKY)),) if random.random() < 0.4 else ()
        around = ((pick(("div", "section")), pick(UNLUCKY)),) if random.random() < 0.3 else ()
        bare = random.random() < 0.25  # nothing comes before the main text
        made, marks = [], []
        for block, label in zip(blocks, labels):
            if bare and not label and not any(marks):
                continue
            path = []
            for element in block.path:
                kind = kind_of(element)
                if label and kind:
                    path += [*around, holder]
                elif not label and kind == 0 and hidden:
                    path.append(plain("ul" if element[0] == "ul" else "div"))
                else:
                    path.append(element)
                if element[0] == "body":
                    path += wrapper
            made.append(Block(tuple(path), block.text, block.linked))
            marks.append(label)
        for _ in range(int(random.integers(2, 6))):
            inside = random.random() < 0.5
            at = int(random.integers(len(made) + 1))
            leaf = (pick(("p", "li", "div", "h3")),)
            named = random.random() < 0.6
            section = (pick(("div", "section", "aside", "ul", "form", "header", "footer", "nav")), pick(OTHER_NAMES)) if named else plain(pick(("div", "ul")))
            path = (("html",), ("body",), *wrapper, *((*around, holder) if inside and named else ()), section, leaf)
            texts = [pick(pools[0] if named else pools[1]) for _ in range(int(random.integers(1, 6 if named else 3)))]
            linked = random.random() < (0.3 if named else 0.7)
            made[at:at] = [Block(path, t, len(t) if linked else 0) for t in texts]
            marks[at:at] = [0] * len(texts)
        yield made, marks


def train_labeller(htmls: list[str], seed: int = 11) -> BlockLabeller:
    """From whole pages; the same pages in the same order give the same labeller."""
    random = np.random.default_rng(seed)
    pages = [blocks for blocks in map(read_blocks, htmls) if blocks]
    pool = [b.text for blocks in pages for b in blocks] or ["none"]
    short = [t for t in pool if len(t) < 60] or ["none"]
    model = BlockLabeller(PATH + WORDS + NUMBERS, SIZE, seed)
    sequences = []
    for blocks in pages:
        for made, marks in variants(blocks, (pool, short), VARIANTS, random):
            rows = vectors(made)
            # Words of one corpus say little about another's: they change places at random,
            # so that no place is learned by heart.
            rows[:, PATH : PATH + WORDS] = rows[:, PATH + random.permutation(WORDS)]
            if random.random() < 0.6:  # nor is any name, but for what it is known to tell
                rows[:, :PATH] = rows[:, random.permutation(PATH)]
            sequences.append((rows, np.array(marks, np.float32)))
    model.train(sequences, EPOCHS, 16, 0.01, seed)
    return model


def main_texts(htmls: list[str | None], model: BlockLabeller) -> list[str]:
    pages = [read_blocks(h) if h else [] for h in htmls]
    out = [""] * len(pages)
    order = sorted(range(len(pages)), key=lambda p: len(pages[p]))
    at = 0
    while at < len(order):
        group = [order[at]]
        at += 1
        while at < len(order) and len(group) < PAGES and len(pages[order[at]]) * (len(group) + 1) <= BLOCKS:
            group.append(order[at])
            at += 1
        gates = []
        for page in group:
            blocks = pages[page]
            parts = [model.gates(vectors(blocks, range(i, min(i + BLOCKS, len(blocks))))) for i in range(0, len(blocks), BLOCKS)]
            gates.append(np.concatenate(parts) if parts else np.zeros((0, 8 * model.size), np.float32))
        for page, marks in zip(group, model.probabilities(gates)):
            out[page] = "\n".join(b.text for b, p in zip(pages[page], marks) if p >= 0.5)
    return out


def _extract(shared):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for piece in pieces(batches, "html"):
            texts = main_texts(piece.column("html").to_pylist(), model)
            kept = [c for c in piece.schema.names if c != "html"]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*kept, "text", "n_chars"],
            )

    return extract


def extract_text(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    ``sample`` pages of at most ``SAMPLE_BYTES``, of least digests, are sent to the
    driver to train on, at most 40 MB. A null or empty page, or one without a block
    of main text, has the empty text; repeated pages give the same; no rows give no
    rows. Blocks are kept or left whole.
    """
    digest = F.md5("html").alias("digest")
    small = pages.filter((F.octet_length("html") <= SAMPLE_BYTES) & (F.length("html") > 0)).select(digest, "html")
    # Repeated pages count once, or many copies of one could be all there is to learn from.
    chosen = [r.digest for r in least_by_hash(small.select("digest"), "digest", sample, small.count(), distinct=True).collect()]
    texts = {r.digest: r.html for r in small.filter(F.col("digest").isin(chosen)).dropDuplicates(["digest"]).collect()}
    model = train_labeller([texts[d] for d in sorted(texts)])
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract(shared), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
