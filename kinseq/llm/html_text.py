"""HTML extraction: flat text blocks classified by a decision tree.

A page is read once into flat text blocks (what stands between block-level tags); scripts, styles,
form controls and the head give no text.  A block's features are its number of words and its
link density, those of the block before and of the block after it, whether these are headings, and what kind
of element it is in: a heading, a list item, the page's article, an element that holds furniture by HTML's own
definition.  Names that sites give their classes and ids play no part.  The labelled table is
built from the pages in ``LABELLED_PAGES``, each as it is and once more with all its containers
turned into plain ``div``, so that the tree must also tell blocks apart by words and links alone.
It is a CART tree, trained on the driver; its positive blocks are the main text.

The page's article is the innermost ``article`` or ``main`` with the most words (readers' comments are
often articles too); blocks outside it count as outside, unless the page has no such element.

Defined results: null and empty pages give empty text; unclosed tags are read to the page's end; an
unclosed form control ends at the next block or control and an unclosed comment at its next ``>``, so
they swallow no text, while an unclosed script or style is script or style to the end; blocks of
any length are kept whole; repeated rows are extracted alike; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseq.llm.common import arrow_map

# Element names of HTML by their role.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article aside body details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split())
FURNITURE = frozenset("nav footer aside form dialog menu fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCRIPTS = frozenset("script style".split())
EMBEDDED = frozenset("noscript template svg math iframe object canvas audio video head title".split())
CONTROLS = frozenset("button select textarea".split())

_TAG = re.compile(r"""<!--|<(?:!|\?)[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+[^<>]*+)>""", re.DOTALL)
_HIDDEN = re.compile(r"""(?<![\w-])hidden(?![\w-])|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_CONTROL_END = {name: re.compile(rf"</{name}\s*[^>]*>|(?=</?(?:{'|'.join(sorted(BLOCKS | CONTROLS))})[\s/>])", re.IGNORECASE) for name in CONTROLS}
_END = {name: re.compile(rf"</{name}\s*[^>]*>", re.IGNORECASE) for name in SCRIPTS | EMBEDDED}

#: Variants of each labelled page; how often a page counts as it is for each time without containers.
VARIANTS, MARKED = 12, 3
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "heading", "heading_before", "heading_after", "item", "article", "furniture")
#: Pages whose blocks are labelled: ``+`` is main text, ``-`` is not; ``p:40/3`` is a paragraph of 40 words,
#: three of them in links.  The first seven have the blocks of pages 0, 1, 3, 7, 9, 11 and 4 of the ``pages``
#: table at scale 0.001; the others stand for common layouts.
LABELLED_PAGES = """
<nav> -li:1/1 -li:1/1 -li:1/1 -li:1/1 -li:1/1 -li:1/1 </nav> <div> -div:8 </div> <article> +h1:10 +p:51 +p:8 +p:11 +p:36 +p:32 +p:52 +p:25 </article> <footer> -div:11 </footer>
<nav> -li:1/1 -li:1/1 -li:1/1 -li:1/1 -li:1/1 -li:1/1 </nav> <div> -div:8 </div> <article> +h1:9 +p:12 +p:9 +p:39 +p:8 +p:20 +p:8 </article> <footer> -div:8 </footer>
<nav> -li:1/1 -li:1/1 -li:1/1 -li:1/1 -li:1/1 </nav> <div> -div:8 </div> <article> +h1:11 +p:17 +p:143 +p:31 +p:189 +p:43 +p:51 +p:22 </article> <footer> -div:11 </footer>
<nav> -li:1/1 -li:1/1 -li:1/1 -li:1/1 -li:1/1 -li:1/1 </nav> <div> -div:4 </div> <article> +h1:6 +p:6 +p:10 </article> <footer> -div:15 </footer>
<nav> -li:1/1 -li:1/1 -li:1/1 -li:1/1 -li:1/1 -li:1/1 </nav> <div> -div:6 </div> <article> +h1:8 +p:12 +p:8 +p:3 +p:38 +p:36 +p:28 +p:6 +p:25 +p:32 </article> <footer> -div:13 </footer>
<nav> -li:1/1 -li:1/1 -li:1/1 -li:1/1 -li:1/1 -li:1/1 </nav> <div> -div:7 </div> <article> +h1:5 +p:5 </article> <footer> -div:15 </footer>
<nav> -li:1/1 -li:1/1 -li:1/1 -li:1/1 -li:1/1 -li:1/1 </nav> <div> -div:8 </div> <article> +h1:8 +p:8 +p:45 +p:1 +p:30 +p:37 +p:47 +p:2 +p:1 +p:15 +p:3 +p:8 </article> <footer> -div:14 </footer>
<header> -h1:3/3 -p:16 </header> <nav> -li:2/2 -li:1/1 -li:1/1 </nav> <main> +h1:9 +p:60/2 +p:1 +p:44 +h2:4 +li:12 +li:9/2 +p:70 </main> <aside> -h3:2 -li:6/6 -li:7/7 -p:25 </aside> <footer> -p:12/6 -p:30 </footer>
<header> -div:2/2 </header> <nav> -li:1/1 -li:1/1 </nav> <article> +h1:7 +p:22 +p:90/4 +p:5/5 +p:48 </article> <section> -h2:1 <article> -p:14 </article> <article> -p:35 </article> </section> <form> -p:2 -p:9 </form> <footer> -p:6 </footer>
<div> -p:3/3 -p:2/2 -p:14 </div> <div> +h1:8 +p:75 +p:50/1 +p:33 +p:120/6 </div> <div> -p:4/4 -p:5/5 -p:6/6 -p:7/6 </div> <div> -p:9 </div>
<nav> -li:1/1 -li:2/2 -li:1/1 </nav> <main> +h1:4 +p:31 +pre:18 +p:26 +li:3/3 +li:4/4 +li:2/2 +p:40 </main> <nav> -li:2/2 -li:2/2 </nav> <footer> -p:8/2 </footer>
<div> -li:1/1 -li:1/1 -li:2/2 </div> <div> +p:110 +p:64 +li:8 +li:11 +li:9 +p:45 </div> <div> -li:5/5 -li:4/4 </div> <div> -p:7/3 </div>
<header> -p:20 </header> <article> <header> +h1:8 +p:30 </header> +p:65 +blockquote:24 +p:3 +p:80/9 <footer> -p:7/2 </footer> </article> <dialog> -p:28 -p:2 </dialog> <aside> -p:60 -p:5/5 </aside>
"""


class Tree:
    """CART by Gini impurity: exact splits at midpoints between neighbouring values."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 12, least: int = 3) -> None:
        self.positive, self.split = float(y.mean()) >= 0.5, None
        if depth and 0 < y.sum() < len(y):
            best = (np.inf, 0, 0.0)
            for k in range(x.shape[1]):
                values = np.unique(x[:, k])
                for cut in (values[1:] + values[:-1]) / 2:
                    low = x[:, k] <= cut
                    if least <= low.sum() <= len(y) - least:
                        cost = sum(p.mean() * (1 - p.mean()) * len(p) for p in (y[low], y[~low]))
                        best = min(best, (cost, k, float(cut)))
            if best[0] < np.inf:
                _, k, cut = best
                low = x[:, k] <= cut
                self.split = (k, cut, Tree(x[low], y[low], depth - 1, least), Tree(x[~low], y[~low], depth - 1, least))

    def __call__(self, row) -> bool:
        node = self
        while node.split:
            k, cut, low, high = node.split
            node = low if row[k] <= cut else high
        return node.positive


class _Block:
    __slots__ = ("text", "words", "links", "heading", "item", "furniture", "article")

    def __init__(self, parts, heading: bool, item: bool, furniture: bool, article: int) -> None:
        self.text = " ".join("".join(t for t, _ in parts).split())
        self.words = len(self.text.split())
        self.links = min(1.0, sum(len(t.split()) for t, linked in parts if linked) / self.words) if self.words else 0.0
        self.heading, self.item, self.furniture, self.article = heading, item, furniture, article


def blocks(page: str) -> list[_Block]:
    """The page's blocks that have text, in order."""
    out: list[_Block] = []
    parts: list[tuple[str, bool]] = []
    # open containers: (name, inside furniture, number of the innermost article or 0)
    stack: list[tuple[str, bool, int]] = [("", False, 0)]
    articles, linked, leaf, hidden = 0, False, "", False

    def close() -> None:
        if parts:
            found = _Block(parts, leaf in HEADINGS, leaf == "li", stack[-1][1] or hidden, stack[-1][2])
            if found.words:
                out.append(found)
            parts.clear()

    at, end, last = 0, len(page), page.rfind("-->")
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            parts.append((html.unescape(page[at:]), linked))
            break
        if m.start() > at:
            parts.append((html.unescape(page[at : m.start()]), linked))
        at = m.end()
        if m[0] == "<!--":
            stop = page.find("-->", at) + 3 if at <= last else page.find(">", at) + 1
            at = stop or end
        if not m[2]:
            continue
        closing, name, attributes = bool(m[1]), m[2].lower(), m[3]
        if closing and name in SCRIPTS | EMBEDDED | CONTROLS:
            continue
        if name in SCRIPTS or name in EMBEDDED:
            if not attributes.rstrip().endswith("/"):
                stop = _END[name].search(page, at)
                at = stop.end() if stop else end if name in SCRIPTS else at
        elif name in CONTROLS:
            stop = _CONTROL_END[name].search(page, at)
            at = stop.end() if stop else at
        elif name == "br":
            parts.append((" ", False))
        elif name == "a":
            linked = not closing
        elif name in BLOCKS:
            close()
            if name not in CONTAINERS:
                leaf, hidden = ("", False) if closing else (name, bool(attributes) and _HIDDEN.search(attributes) is not None)
                continue
            leaf, hidden, linked = "", False, False
            if closing:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
            else:
                _, furniture, article = stack[-1]
                furniture = furniture or name in FURNITURE or (name == "header" and not article) or (bool(attributes) and _HIDDEN.search(attributes) is not None)
                if name in ("article", "main"):
                    articles += 1
                    article = articles
                stack.append((name, furniture, article))
    close()
    return out


def features(found: list[_Block]) -> list[tuple]:
    """A row of ``FEATURES`` for each block."""
    size: dict[int, int] = {}
    for b in found:
        if b.article and not b.furniture:
            size[b.article] = size.get(b.article, 0) + b.words
    main = max(size, key=lambda a: (size[a], -a), default=0)
    edge = _Block([], False, False, False, 0)
    rows = []
    for k, b in enumerate(found):
        before, after = found[k - 1] if k else edge, found[k + 1] if k + 1 < len(found) else edge
        rows.append((b.words, b.links, before.words, before.links, after.words, after.links, b.heading, before.heading, after.heading, b.item, (1 if b.article == main else -1) if main else 0, b.furniture))
    return rows


def labelled_table(pages: str = LABELLED_PAGES, variants: int = VARIANTS, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The features and labels of all blocks of ``pages``, with and without their containers.

    Each page also comes in ``variants`` with the sizes of its blocks redrawn among those of all
    blocks of the same label and element, and up to all but one of its main paragraphs left out."""
    lines = [line.split() for line in pages.strip().splitlines()]
    sizes: dict[str, list[str]] = {}
    for part in (p for line in lines for p in line if p[0] != "<"):
        kind, _, size = part.partition(":")
        sizes.setdefault(kind, []).append(size)
    rng = np.random.default_rng(seed)
    for line in list(lines):
        for _ in range(variants):
            drawn = [p if p[0] == "<" else f"{p.partition(':')[0]}:{rng.choice(sizes[p.partition(':')[0]])}" for p in line]
            spare = [k for k, p in enumerate(drawn) if p.startswith("+p")][1:]
            gone = set(rng.permutation(spare)[: rng.integers(0, len(spare) + 1)].tolist()) if spare else set()
            lines.append([p for k, p in enumerate(drawn) if k not in gone])
    x, y = [], []
    for line in lines:
        made, labels = [], []
        for part in line:
            if part[0] == "<":
                made.append(part)
                continue
            name, _, size = part[1:].partition(":")
            words, _, links = size.partition("/")
            linked = int(links or 0)
            made.append(f"<{name}><a>{'w ' * linked}</a>{'w ' * (int(words) - linked)}</{name}>")
            labels.append(part[0] == "+")
        whole = "".join(made)
        plain = re.sub(r"<(/?)(?:nav|main|article|header|footer|aside|form|dialog|section)>", r"<\1div>", whole)
        for page in [whole] * MARKED + [plain]:
            x.extend(features(blocks(page)))
            y.extend(labels)
    return np.array(x, dtype=float), np.array(y, dtype=float)


@cache
def trained_tree() -> Tree:
    return Tree(*labelled_table())


def main_text(page: str | None, tree: Tree | None = None) -> str:
    """The page's main blocks, parted by blank lines."""
    found, tree = blocks(page or ""), tree or trained_tree()
    return "\n\n".join(b.text for b, row in zip(found, features(found), strict=True) if tree(row))


def _extract(tree: Tree):
    def run(batches):
        for batch in batches:
            texts = [main_text(h, tree) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return arrow_map(rows, _extract(trained_tree()), "page_id long, url string, text string, n_chars long")
