"""Main text of web pages, by tag-path ratios.

A page is a sequence of text nodes, each with the path of tags from the root
to it. Per path the lengths and the punctuation marks of its nodes are summed:
their ratios to the number of nodes are high on the paths of running prose and
low on those of menus, buttons and captions. The two ratios of the nodes are
smoothed along the page by a Gaussian, so that a short paragraph between long
ones is not lost, and fused to one score between 0 and 1; a path is content if
the mean score of its nodes reaches a share of the page's highest.

Markup that names its purpose is fused in as well: paths below ``nav``,
``footer`` and the like, or below an element whose class or id names an
advert, a menu or reader comments, take no part; and where a page marks
articles, the one whose nodes score highest in sum is preferred: its paths
gain more than the ratios can give, so that a short paragraph of it is content
and a long notice beside it is not. Blocks on content paths are returned
whole, in page order.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text is no text of the article.
HIDDEN = frozenset("script style template noscript iframe noframes noembed head title svg math canvas audio video object select datalist textarea button".split())
ASIDE = frozenset("nav footer aside form header menu dialog search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form toolbar".split())
#: Words of a class or an id that name something beside the article.
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer header masthead banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "comment comments commentlist disqus reply replies respond share sharing social related recommended recommendations newsletter "
    "subscribe subscription signup login pagination pager widget toolbar search copyright".split()
)
#: A start tag that ends open elements of these names, up to one of the barriers.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th", "caption"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "thead": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("optgroup", "option"), ("select",)),
}
#: An end tag does not reach beyond these.
SCOPE = frozenset(("table", "td", "th", "caption", "article", "main", "body", "html"))

_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
_MARKS = re.compile(r"[.,;:!?…。，、；：！？،؛؟।]")

_CUT_OFF = re.compile(r"<[/!?]?[a-zA-Z!?][^>]*$")

#: Width of the smoothing in text nodes, the share of the highest path's score that content has, and what
#: the marked article adds to scores between 0 and 1 (more than 1 / THRESHOLD, so that it decides).
SIGMA, THRESHOLD, MARKED = 1.0, 0.25, 5.0
#: An element is the content's if it holds this share of the text on content paths.
SHARE = 0.8


class _Page(HTMLParser):
    """Elements (parent, tag, purpose) and text nodes (element, block, text)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.beside, self.article = [-1], [""], [False], [False]
        self.open = [0]
        self.block = 0
        self.nodes: list[tuple[int, int, str]] = []

    def handle_starttag(self, tag, attrs):
        if tag == "body" or tag == "html":
            if tag in (self.tag[e] for e in self.open):
                return
        if tag in BLOCKS:
            self.block += 1
            self._end("p", {"button", *SCOPE})
            if tag == "body":
                self._end("head", frozenset())
            if tag in HEADINGS and self.tag[self.open[-1]] in HEADINGS:
                self.open.pop()
        for_tag, barriers = CLOSES.get(tag, ((), ()))
        for other in for_tag:
            self._end(other, barriers)
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        given = {k: v or "" for k, v in attrs}
        words = {w.lower() for w in _WORD.findall(f"{given.get('class', '')} {given.get('id', '')}")}
        shown = not ("hidden" in given or given.get("aria-hidden") == "true")
        article = tag in ("article", "main") or given.get("role") in ("main", "article") or given.get("itemprop") == "articleBody"
        beside = tag in ASIDE or given.get("role") in ROLES or (bool(words & NAMED) and tag not in ("html", "body", "main")) or not shown
        self.parent.append(self.open[-1])
        self.tag.append(tag)
        self.beside.append(beside)
        self.article.append(article)
        self.open.append(len(self.tag) - 1)

    def handle_startendtag(self, tag, attrs):  # a slash before the bracket means nothing in HTML
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.block += 1
        if tag in ("body", "html"):
            return
        if tag in HEADINGS:  # any heading's end closes the open one
            for e in reversed(self.open):
                if self.tag[e] in HEADINGS:
                    tag = self.tag[e]
                    break
        self._end(tag, SCOPE - {tag} if tag not in ("article", "main", "table") else frozenset())

    def _end(self, tag, barriers):
        """Closes the innermost ``tag`` and all within it, unless a barrier, or
        for an inline element a block, stands between."""
        inline = tag not in BLOCKS
        for i in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[i]]
            if name == tag:
                del self.open[i:]
                return
            if name in barriers or (inline and name in BLOCKS):
                return

    def handle_data(self, data):
        self.nodes.append((self.open[-1], self.block, data))


def _smooth(x: np.ndarray, sigma: float) -> np.ndarray:
    reach = int(np.ceil(2 * sigma))
    weights = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma**2))
    total = np.convolve(np.pad(x, reach), weights, "valid")
    return total / np.convolve(np.pad(np.ones(len(x)), reach), weights, "valid")


def fused_scores(paths: list, lengths: np.ndarray, marks: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Each text node's score, from its path and every node's characters and
    punctuation marks: the smoothed path ratios, fused, the highest being 1."""
    if not len(paths):
        return np.zeros(0)
    _, path = np.unique(np.array(paths), return_inverse=True)
    count = np.bincount(path)
    length, mark = (_smooth((np.bincount(path, x) / count)[path], sigma) for x in (lengths, marks))
    fused = np.sqrt(length * (mark + 1.0))
    return fused / fused.max()


def content_paths(paths: list, scores: np.ndarray, threshold: float = THRESHOLD) -> set:
    """The paths whose nodes' mean score reaches the threshold."""
    if not len(paths):
        return set()
    unique, path = np.unique(np.array(paths), return_inverse=True)
    score = np.bincount(path, scores) / np.bincount(path)
    return set(unique[score >= threshold * score.max()].tolist())


def _whole_tags(html: str) -> str:
    """The page without a comment or a tag that its end cuts off."""
    at = html.rfind("<!--")
    if at >= 0 and html.find("-->", at) < 0 and "<script" not in html[html.rfind("</script") + 1 : at]:
        html = html[:at]
    at = html.rfind("<")
    return html[:at] if at >= 0 and _CUT_OFF.match(html, at) else html


def main_text(html: str | None) -> str:
    """The article's blocks, joined by blank lines; empty if there are none."""
    if not html:
        return ""
    page = _Page()
    page.feed(_whole_tags(html))
    page.close()
    parent, tag = page.parent, page.tag
    n = len(tag)
    hidden, number, paths = [False] * n, [0] * n, {(0, ""): 0}
    for e in range(1, n):
        hidden[e] = hidden[parent[e]] or tag[e] in HIDDEN
        number[e] = paths.setdefault((number[parent[e]], tag[e]), len(paths))
    nodes = [(e, b, t) for e, b, t in page.nodes if not hidden[e] and t]
    size = [0] * n  # visible characters of each element's own text, then of all within
    for e, _, t in nodes:
        size[e] += sum(map(len, t.split()))
    for e in range(n - 1, 0, -1):
        size[parent[e]] += size[e]

    # nodes that markup does not name as something else
    below = [False] * n
    for e in range(1, n):
        below[e] = below[parent[e]] or page.beside[e]
    marked = [e for e in range(1, n) if page.article[e] and size[e] and not page.beside[e]]
    free = [e for e in marked if not below[e]]
    marked = free or marked
    around: set[int] = set()  # an element around a marked article is not beside it
    for e in marked:
        while e > 0 and e not in around:
            around.add(e)
            e = parent[e]
    drop, headed, heading, holder = [False] * n, [False] * n, [False] * n, [0] * n
    for e in marked:
        holder[e] = e
    for e in range(1, n):
        holder[e] = holder[e] or holder[parent[e]]
        own = tag[e] == "header" and holder[parent[e]] > 0  # a header of an article
        headed[e] = headed[parent[e]] or own
        drop[e] = drop[parent[e]] or (page.beside[e] and e not in around and not own)
        heading[e] = heading[parent[e]] or tag[e] in HEADINGS
    kept = [(e, b, t) for e, b, t in nodes if not drop[e] and (heading[e] or not headed[e])]
    seen = [(e, b, t, sum(map(len, t.split()))) for e, b, t in kept]
    seen = [x for x in seen if x[3]]
    if not seen:
        return ""
    lengths = np.array([x[3] for x in seen], dtype=np.float64)
    marks = np.array([len(_MARKS.findall(x[2])) for x in seen], dtype=np.float64)
    paths = [number[x[0]] for x in seen]
    scores = fused_scores(paths, lengths, marks)

    # the marked article whose nodes score highest in sum, all within it included
    root, inside = 0, [False] * n
    if marked:
        total = [0.0] * n
        for (e, *_), s in zip(seen, scores.tolist()):
            total[e] += s
        for e in range(n - 1, 0, -1):
            total[parent[e]] += total[e]
        root = max(marked, key=lambda e: (total[e], -e))
        for e in range(1, n):
            inside[e] = e == root or inside[parent[e]]
        within = np.array([inside[x[0]] for x in seen])
        # a path within the article is another one than the same tags outside of it
        paths = [2 * p + w for p, w in zip(paths, within.tolist())]
        scores = scores + MARKED * within
    chosen = content_paths(paths, scores)
    content = [p in chosen for p in paths]
    if root:
        return _joined(_whole_blocks(kept, seen, content, inside))
    return _joined(_between(kept, seen, content, parent, heading))


def _whole_blocks(nodes, seen, content, inside):
    """The nodes of the blocks that stand on content paths of the article."""
    blocks = {x[1] for x, ok in zip(seen, content) if ok and inside[x[0]]}
    return [x for x in nodes if x[1] in blocks and inside[x[0]]]


def _within(e: int, root: int, parent: list[int]) -> bool:
    while e > 0:
        if e == root:
            return True
        e = parent[e]
    return False


def _between(nodes, seen, content, parent, heading):
    """The nodes of a page that marks no article: the blocks on content paths
    and what stands between the first and the last of them, or heads them."""
    weight: dict[int, int] = defaultdict(int)
    share: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for (e, b, _, size), ok in zip(seen, content):
        share[b][ok] += size
        while ok and e >= 0:
            weight[e] += size
            e = parent[e]
    container = 0
    while True:  # the innermost element that holds most of the text on content paths
        inner = [e for e in weight if parent[e] == container and weight[e] >= SHARE * weight[0]]
        if not inner:
            break
        container = inner[0]
    inside = [(e, b, t) for e, b, t in nodes if container == 0 or _within(e, container, parent)]
    blocks = list(dict.fromkeys(b for _, b, _ in inside if b in share))
    told = [i for i, b in enumerate(blocks) if share[b][1] >= share[b][0]]
    if not told:
        return []
    first, last = told[0], told[-1]
    heads = {b for e, b, _ in inside if heading[e]}
    while first and blocks[first - 1] in heads:
        first -= 1
    kept = set(blocks[first : last + 1])
    return [x for x in inside if x[1] in kept]


def _joined(nodes) -> str:
    blocks: dict[int, list[str]] = {}
    for _, b, t in nodes:
        blocks.setdefault(b, []).append(t)
    texts = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(t for t in texts if t)


#: Characters of the pages whose texts leave a task together (one page at least).
SLICE_CHARS = 4 << 20


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of each page, its main ``text`` and ``n_chars``,
    the code points of it.

    A null or empty page, and one without text, gives an empty text. Pages are
    taken one by one and whole, so ties and repeated rows give the same text
    each, and an empty table gives no rows. Character references are decoded;
    a line break is white space of its block. Columns not named are not read.
    """
    fields = [pages.schema[c] for c in keep]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", text string, n_chars bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, column = 0, batch.column(len(keep))
            while at < len(column):
                to, chars, texts = at, 0, []
                while to < len(column) and (to == at or chars < SLICE_CHARS):
                    page = column[to].as_py()
                    chars += len(page or "")
                    texts.append(main_text(page))
                    to += 1
                same = [batch.column(i).slice(at, to - at) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*same, pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [*keep, "text", "n_chars"])
                at = to

    return pages.select(*(f"`{c}`" for c in keep), f"`{html}`").mapInArrow(run, ddl)


def op11_main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars. Nulls, empty and very long pages,
    ties, repeated rows, empty tables and extra columns as in ``extract``."""
    return extract(pages)


#: A plain rule for pages that mark one article and nothing within it that is beside it.
ORACLE = r"""
WITH body AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS h FROM pages),
parts AS (
  SELECT page_id, url, list_transform(
    regexp_split_to_array(h, '</?(p|h[1-6]|div|ul|ol|li|blockquote|section)>'),
    lambda b: trim(regexp_replace(
      replace(regexp_replace(replace(replace(replace(replace(
        regexp_replace(b, '<[^>]*>', ' ', 'g'),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp($|[^;])', '&amp;\1', 'g'), '&amp;', '&'),
      '\s+', ' ', 'g'))) AS blocks
  FROM body),
texts AS (SELECT page_id, url, array_to_string(list_filter(blocks, lambda b: b <> ''), chr(10) || chr(10)) AS text FROM parts)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM texts
"""
