"""Pages as streams of tags and text, folded by a small state machine in SQL.

``tokens`` splits a page into comments, scripts and styles (each one token),
tags and text. ``fold_elements`` walks the tokens once with ``aggregate``: an
element opens at its start tag and ends at its end tag, or where HTML implies
its end (the next paragraph, the end of what holds it, the end of the page).
Void and inline elements within it only lend their text. Character references
are decoded in what is left. All of it is column expressions: no Python, no
shuffle, one pass over the page.
"""

from __future__ import annotations

from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
    r"""|</?[a-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
    r"|</?[a-z][^>]*(?:>|\z)|<[!?][^>]*(?:>|\z)|[^<]++|<"
)
_BLOCKS = (
    "address|article|aside|blockquote|body|center|details|dialog|dir|div|dl|dd|dt|fieldset|figcaption|figure|footer|form|h[1-6]|"
    "header|hgroup|hr|html|li|main|menu|nav|ol|p|pre|search|section|table|tbody|td|tfoot|th|thead|tr|ul"
)
_HOLDERS = "article|aside|body|div|footer|header|html|main|nav|section|table|td|th|tr"
#: What ends an open element, besides its own start and end tag.
_ENDS = {
    "p": rf"</?(?:{_BLOCKS})\b",
    "li": rf"</(?:ul|ol|menu|{_HOLDERS})\b",
    "dt": rf"</?(?:dd)\b|</(?:dl|{_HOLDERS})\b",
    "dd": rf"</?(?:dt)\b|</(?:dl|{_HOLDERS})\b",
    "td": r"</?(?:th|tr|thead|tbody|tfoot)\b|</table\b",
    "th": r"</?(?:td|tr|thead|tbody|tfoot)\b|</table\b",
    "option": r"</?(?:optgroup)\b|</(?:select|datalist)\b",
    **{f"h{i}": rf"</?h[1-6]\b|</(?:{_HOLDERS})\b" for i in range(1, 7)},
}
_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"


def tokens(page: Column) -> Column:
    """All of a page in order, as an array of tokens; null for a null page."""
    return F.regexp_extract_all(page, F.lit(TOKEN), F.lit(0))


@cache
def _named() -> list[tuple[str, str]]:
    """Names of one character within Latin-1, typographic marks and the like,
    the commonest first (a map is searched from its start)."""
    first = ["amp", "lt", "gt", "quot", "apos", "nbsp"]
    names = {n[:-1]: c for n, c in html5.items() if n.endswith(";") and len(c) == 1 and (ord(c) < 0x180 or 0x2000 <= ord(c) < 0x20B0)}
    return [(n, names[n]) for n in first] + sorted((n, c) for n, c in names.items() if n not in first)


def decode_references(text: Column) -> Column:
    """``&amp;`` → ``&`` and so on, each reference once; an unknown one stays.
    A text without a reference is returned as it is."""
    # the text between references and the references, one after the other
    between = F.split(text, _REFERENCE)
    found = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    names = F.create_map(*[F.lit(x) for pair in _named() for x in pair])

    def one(ref: Column) -> Column:
        body = F.substring(ref, F.lit(2), F.length(ref) - 2)
        digits = F.when(body.rlike("^#[xX]"), F.conv(F.substring(body, 3, 32), 16, 10)).otherwise(F.substring(body, 2, 32))
        code = digits.try_cast("int")
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        number = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("�"))
        return F.when(body.startswith("#"), number).otherwise(F.coalesce(F.try_element_at(names, body), ref))

    whole = F.transform(between, lambda s, i: F.concat(s, F.coalesce(one(F.get(found, i)), F.lit(""))))
    return F.when(F.contains(text, F.lit("&")), F.concat_ws("", whole)).otherwise(text)


def is_text(token: Column) -> Column:
    return ~token.startswith("<") | (token == "<")


def is_start(token: Column, tag: str) -> Column:
    """A whole start tag; one that the page's end cuts off is none."""
    return token.rlike(rf"(?is)^<{tag}(?![\w:-])") & token.endswith(">")


def ends(tag: str) -> str:
    """A pattern of the tokens that end an open ``tag``."""
    own = rf"</?{tag}(?![\w:-])"
    return rf"(?is)^(?:{own}|{_ENDS[tag]})" if tag in _ENDS else rf"(?is)^(?:</{tag}(?![\w:-]))"


def element_texts(page: Column, tag: str) -> Column:
    """The text of every ``tag`` element of a page in order (elements of the tag
    itself do not nest), markup left out and references decoded."""
    start = F.struct(F.lit(False).alias("open"), F.lit("").alias("text"), F.array().cast("array<string>").alias("done"))
    ending = ends(tag)

    def closed(s: Column) -> Column:
        return F.when(s["open"], F.array_append(s["done"], s["text"])).otherwise(s["done"])

    def step(s: Column, t: Column) -> Column:
        text = F.struct(s["open"].alias("open"), F.concat(s["text"], t).alias("text"), s["done"].alias("done"))
        begin = F.struct(F.lit(True).alias("open"), F.lit("").alias("text"), closed(s).alias("done"))
        end = F.struct(F.lit(False).alias("open"), F.lit("").alias("text"), closed(s).alias("done"))
        return (
            F.when(is_text(t), F.when(s["open"], text).otherwise(s)).when(is_start(t, tag), begin).when(s["open"] & t.rlike(ending), end).otherwise(s)
        )

    return F.transform(F.aggregate(tokens(page), start, step, closed), decode_references)


def attribute(token: Column, name: str) -> Column:
    """The value of an attribute of a tag, quoted or not; null without it."""
    pattern = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    parts = [F.regexp_extract(token, pattern, i) for i in (1, 2, 3)]
    return F.when(token.rlike(pattern), decode_references(F.concat(*parts)))


def item_links(page: Column) -> Column:
    """``(href, text)`` of the links that open a list item, in order."""
    kind = "array<struct<href:string,text:string>>"
    # 0: elsewhere, 1: right behind a list item's start, 2: within its link
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("href"), F.lit("").alias("text"), F.array().cast(kind).alias("done"))

    def state(at: int, href: Column, text: Column, done: Column) -> Column:
        return F.struct(F.lit(at).alias("at"), href.alias("href"), text.alias("text"), done.alias("done"))

    def closed(s: Column) -> Column:
        return F.when(s["at"] == 2, F.array_append(s["done"], F.struct(s["href"].alias("href"), s["text"].alias("text")))).otherwise(s["done"])

    def step(s: Column, t: Column) -> Column:
        none, href = F.lit(""), attribute(t, "href")
        in_text = F.when(s["at"] == 2, state(2, s["href"], F.concat(s["text"], t), s["done"]))
        in_text = in_text.when((s["at"] == 1) & (F.trim(F.regexp_replace(t, r"\s", " ")) != ""), state(0, none, none, s["done"])).otherwise(s)
        link = F.when((s["at"] == 1) & href.isNotNull(), state(2, href, none, s["done"])).otherwise(state(0, none, none, closed(s)))
        end = t.rlike(rf"(?is)^(?:</a(?![\w:-])|</?(?:{_BLOCKS})\b)")
        return (
            F.when(is_text(t), in_text).when(is_start(t, "li"), state(1, none, none, closed(s)))
            .when(is_start(t, "a"), link).when(end, state(0, none, none, closed(s)))
            .when((s["at"] == 1) & ~t.startswith("<!"), state(0, none, none, s["done"])).otherwise(s)
        )

    found = F.aggregate(tokens(page), start, step, closed)
    return F.transform(found, lambda x: F.struct(x["href"].alias("href"), decode_references(x["text"]).alias("text")))
