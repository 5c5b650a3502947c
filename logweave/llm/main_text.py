"""Main text of web pages by tag-path ratios.

A page is cut into blocks: the text between two block tags, with inline tags left out.  Each block has a tag
path, from the root to the block.  Per path the text outside links and the punctuation are added up and
divided by the path's blocks; both ratios, set at each block of the page, are smoothed with a Gaussian over
the neighbouring blocks, fused into one value, and averaged per path again.  Paths that reach a share of the
page's highest value are content.

Elements that name themselves as something else (``nav``, ``footer``, ``class="sidebar"`` and the like) make
paths of their own with no value.  The content element is the innermost one that holds the text of all
content paths; where the page has ``article`` or ``main`` elements with text, only theirs counts.  The result
is what the content element says outside the other parts, short lines and headings too, but for blocks of
links alone that are no content path.

Pages are read one by one inside Arrow batches; nothing is shuffled.  A page is scanned once from its start to
its end, and open elements are found by name, so time follows the page's length, however its tags nest."""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from logweave.llm.common import extended, map_arrow, table, without

# Element names of HTML and the words by which pages name their parts.
#: Elements that begin and end a block.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup; it ends at their end tag.
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
#: Elements that are never part of the article.
ASIDE = frozenset("head nav footer aside menu dialog search template svg math canvas object audio video button select datalist".split())
#: What a new tag closes if it is the innermost of its kind.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "body": ("head",)}
#: Elements that CLOSES does not look beyond.
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"),
         "option": ("select",), "tbody": ("table",), "tfoot": ("table",), "body": ("html",)}
#: Words of ``class``, ``id`` and ``role`` that name another part of the page.
PARTS = frozenset("""adsense banner breadcrumb breadcrumbs complementary consent contentinfo cookie cookies copyright dialog disclaimer foot footer
    form gdpr login menu menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup
    register search searchbox share sharing sidebar sidebars signin signup skip social submenu subscribe subscription toolbar widget widgets""".split())
#: Of these words, those that an ``article`` element can bear and be another part.
REPLIES = frozenset("""ad ads adv advert advertisement advertising adverts comment commentlist comments disqus promo promoted promotion
    recommendations recommended related replies reply respond sponsor sponsored""".split())
#: Words that name the page's head, unless a word of CONTENT stands beside them.
HEADS = frozenset("header masthead topbar".split())
CONTENT = frozenset("article body content entry main page post story text".split())
#: Words that turn a name into one of the page's layout, as in ``has-sidebar``.
LAYOUT = frozenset("has layout no with without".split())
#: Elements that an article has: what holds one is no mere part, unless nothing else is there.
SIGNS = frozenset("article main h1".split())

#: Share of the highest value from which a path is content.
THRESHOLD = 0.1
#: Weights of a block's neighbours at distance 0, 1, 2 (a Gaussian of deviation 1).
KERNEL = tuple(float(np.exp(-k * k / 2)) for k in range(3))
PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？·¡¿«»„“”\"()\-–—]")

_TAG = re.compile(r"""<(?:!--(?:>|->|(?P<comment>))|(?P<decl>[!?])|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)
    (?P<attrs>(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+>)|(?P<odd>/))""", re.X)
_NAMED = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


HARD, SOFT = 1, 2  # named as another part by its tag or as replies; by other words


class _Element:
    __slots__ = ("tag", "parent", "named", "block", "path", "other", "article", "wraps", "holds", "inside")

    def __init__(self, tag: str, parent: _Element | None, named: int, block: bool):
        self.tag, self.parent, self.named, self.block = tag, parent, named, block
        self.path, self.other, self.article, self.wraps, self.holds, self.inside = 0, False, False, False, 0, False


class _Block:
    __slots__ = ("element", "text", "chars", "linked", "marks")

    def __init__(self, element: _Element, text: str, linked: int):
        self.element, self.text = element, text
        self.chars, self.linked = len(text), min(linked, len(text))
        self.marks = len(PUNCTUATION.findall(text))


def _named(tag: str, attrs: str) -> int:
    """Whether an element's own names say that it is not part of the article."""
    if tag in ASIDE:
        return HARD
    if tag in ("html", "body"):
        return 0
    named = SOFT if tag == "form" else 0
    for groups in _NAMED.findall(attrs) if "=" in attrs else ():
        for name in unescape("".join(groups)).split():
            words = {w.lower() for w in _WORDS.findall(name)}
            if words & LAYOUT:
                continue
            if words & REPLIES:
                return HARD
            if tag not in SIGNS and (words & PARTS or (words & HEADS and not words & CONTENT)):
                named = SOFT
    return named


class _Reader:
    """Reads one page into blocks, each under its innermost block element."""

    def __init__(self) -> None:
        self.stack = [_Element("", None, 0, True)]
        self.elements = self.stack[:]  # parents before what they hold
        self.signs: list[_Element] = []
        self.open: dict[str, list[int]] = {}  # positions in the stack, by name
        self.blocks_open = [0]  # positions of block elements
        self.pieces: list[str] = []
        self.linked: list[str] = []
        self.blocks: list[_Block] = []

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append(_Block(self.stack[self.blocks_open[-1]], text, len(" ".join("".join(self.linked).split()))))
            self.pieces, self.linked = [], []

    def say(self, text: str) -> None:
        if "&" in text:
            text = unescape(text)
        self.pieces.append(text)
        if self.open.get("a"):
            self.linked.append(text)

    def pop_to(self, position: int) -> None:
        if self.blocks_open[-1] >= position:
            self.flush()
        while len(self.stack) > position:
            element = self.stack.pop()
            self.open[element.tag].pop()
            if element.block:
                self.blocks_open.pop()

    def last(self, *names: str) -> int:
        return max((self.open[n][-1] for n in names if self.open.get(n)), default=0)

    def start(self, tag: str, attrs: str) -> None:
        if tag in ("html", "body") and self.open.get(tag):
            return
        block = tag in BLOCK
        if block:
            self.flush()
            p = self.last("p")  # a block ends an open paragraph, but not one around a table or the like
            if p and p > self.last("td", "th", "table", "button", "object"):
                self.pop_to(p)
            if tag[0] == "h" and tag[1:].isdigit() and self.stack[-1].tag[:1] == "h" and self.stack[-1].tag[1:].isdigit():
                self.pop_to(len(self.stack) - 1)
        if tag in CLOSES:
            beyond = self.last(*SCOPE[tag])
            inner = [self.open[n][-1] for n in CLOSES[tag] if self.open.get(n) and self.open[n][-1] > beyond]
            if inner:
                self.pop_to(min(inner))
        if tag == "a" and self.open.get("a") and self.open["a"][-1] > self.blocks_open[-1]:
            self.pop_to(self.open["a"][-1])
        if tag == "br":
            self.pieces.append("\n")
        if tag in VOID:
            return
        named = _named(tag, attrs)
        element = _Element(tag, self.stack[-1], named, block or bool(named))
        if element.block:
            self.flush()  # an inline element that is another part is cut out of its block
            self.blocks_open.append(len(self.stack))
        if tag in SIGNS:
            self.signs.append(element)
        self.elements.append(element)
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append(element)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.pieces.append("\n")
        at = self.open.get(tag)
        if not at and tag == "p":
            self.flush()
        if not at or tag in ("body", "html"):  # what stands after them still belongs to the page
            return
        if tag in BLOCK or at[-1] >= self.blocks_open[-1]:
            self.pop_to(at[-1])

    def read(self, html: str) -> list[_Block]:
        at, size = 0, len(html)
        while at < size:
            lt = html.find("<", at)
            if lt < 0:
                self.say(html[at:])
                break
            if lt > at:
                self.say(html[at:lt])
            m = _TAG.match(html, lt)
            if m is None:
                if lt + 1 < size and (html[lt + 1].isascii() and html[lt + 1].isalpha()):
                    break  # the page ends inside a tag
                self.say("<")
                at = lt + 1
                continue
            name = m["name"]
            if name is None:
                if m["comment"] is not None:
                    end = html.find("-->", m.end())
                    at = size if end < 0 else end + 3
                elif m["decl"] or m["odd"]:
                    end = html.find(">", m.end())
                    at = size if end < 0 else end + 1
                else:
                    at = m.end()
                continue
            tag, at = name.lower(), m.end()
            if m["end"]:
                self.end(tag)
            elif tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I).search(html, at)
                at = close.end() if close else size
            else:
                self.start(tag, m["attrs"])
        self.flush()
        return self.blocks

    def judge(self) -> None:
        """Set each element's tag path and whether it is another part of the page, or in an article."""
        paths: dict[tuple[int, str], int] = {}
        for e in self.elements[1:]:
            up = e.parent
            e.other = up.other or e.named == HARD or (e.named == SOFT and not e.wraps) or (e.tag == "header" and not up.article)
            e.article = up.article or (e.tag in ("article", "main") and not e.other)
            e.path = paths.setdefault((up.path, e.tag + "~" if e.other else e.tag), len(paths) + 1) if e.block else up.path

    def unwrap(self) -> bool:
        """Where every article or heading is inside an element that is named as another part, the name
        means something else: whether there was one."""
        found = False
        if any(e.tag != "h1" and not e.other for e in self.signs):
            return False
        seen: set[int] = set()
        for e in self.signs:
            while e is not None and id(e) not in seen:
                seen.add(id(e))
                if e.named == SOFT:
                    e.wraps = found = True
                e = e.parent
        return found

    def mark(self, chosen: list[_Block]) -> None:
        """Set which elements lie in the innermost one that holds all of ``chosen``."""
        for b in chosen:
            b.element.holds += 1
        for e in reversed(self.elements[1:]):
            e.parent.holds += e.holds
        container = [e for e in self.elements if e.holds == len(chosen)][-1]
        for e in self.elements:
            e.inside = e is container or (e.parent is not None and e.parent.inside)


def _smooth(x: np.ndarray) -> np.ndarray:
    total, weight = KERNEL[0] * x, np.full(len(x), KERNEL[0])
    for k, w in enumerate(KERNEL[1:], 1):
        total[k:] += w * x[:-k]
        weight[k:] += w
        total[:-k] += w * x[k:]
        weight[:-k] += w
    return total / weight


def _path_values(blocks: list[_Block]) -> dict[int, float]:
    """The fused value of each tag path."""
    paths, path = np.unique([b.element.path for b in blocks], return_inverse=True)
    count = np.bincount(path)
    own = np.array([0 if b.element.other else b.chars - b.linked for b in blocks], float)
    marks = np.array([0 if b.element.other else b.marks * (b.chars - b.linked) / b.chars for b in blocks], float)
    text = _smooth((np.bincount(path, own) / count)[path])
    punctuation = _smooth((np.bincount(path, marks) / count)[path])
    fused = text * (1 + punctuation)
    return dict(zip(paths.tolist(), (np.bincount(path, fused) / count).tolist()))


def main_blocks(html: str, threshold: float = THRESHOLD) -> list[str]:
    """The blocks of the page's main text, in page order."""
    reader = _Reader()
    blocks = reader.read(html)
    reader.judge()
    if all(b.element.other for b in blocks) and reader.unwrap():
        reader.judge()
    named = [b for b in blocks if not b.element.other]
    pool = [b for b in named if b.element.article] or named
    if not pool:
        return []
    values = _path_values(blocks)
    least = threshold * max(values[b.element.path] for b in pool)
    chosen = [b for b in pool if values[b.element.path] >= least]
    reader.mark(chosen)
    content = {b.element.path for b in chosen}
    return [b.text for b in pool if b.element.inside and (b.linked < b.chars or b.element.path in content)]


FIELDS = {"text": "string", "n_chars": "long"}


def extract_text(pages: DataFrame, html: str = "html", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``pages`` plus ``text``, the page's main text, and ``n_chars``, its code points
    (columns of these names give way, but ``html`` may itself be called ``text``).

    Blocks stand in page order with two line feeds between them; inside a block, white space is one space
    and character references are decoded.  A null or empty page, and one without text, has an empty text.  Pages
    are judged one by one: null ids, ties and repeated rows change nothing; a very long page is read whole."""
    kept = [c for c in pages.columns if c.lower() not in FIELDS]
    source = pages.select(*[pages[f"`{c}`"] for c in kept], pages[f"`{html}`"].alias("__html"))
    base = without(source, "__html")

    def extract(batches):
        for batch in batches:
            texts = ["\n\n".join(main_blocks(h, threshold)) if h else "" for h in batch.column(batch.num_columns - 1).to_pylist()]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*batch.schema.names[:-1], *FIELDS])

    return map_arrow(source, extract, extended(base, **FIELDS))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")
