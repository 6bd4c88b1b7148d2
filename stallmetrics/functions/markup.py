"""Elements of HTML by the selector forms of site configurations, as column expressions.

A page is split before every start tag that fits a selector; each piece is cut where its element
ends, which a running count of its tag's start and end tags tells. What is read from an element
is read from that short text. Compounds of tag, #id, .class and [attribute] are known, and
descendants by spaces; any other form is an error.

Elements whose end tag may be left out (``OPTIONAL_END``) end at the next one that fits. Attribute
values hold no ``>``. Scripts, styles and comments must be dropped first (``visible``).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PART = re.compile(r"#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>[*^$]?=)\"?(?P<val>[^\"\]]*)\"?)?\]|(?P<tag>[\w-]+|\*)")
ANY_TAG = r"[a-zA-Z][\w:-]*"
# Elements without content, elements whose end tag may be left out, named characters.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
OPTIONAL_END = ["dd", "dt", "li", "option", "p", "td", "th", "tr"]
ENTITIES = {"nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "ccedil": "ç", "Ccedil": "Ç", "ouml": "ö", "Ouml": "Ö",
            "uuml": "ü", "Uuml": "Ü", "auml": "ä", "Auml": "Ä", "szlig": "ß", "eacute": "é", "egrave": "è", "agrave": "à",
            "euro": "€", "copy": "©", "reg": "®", "hellip": "…", "ndash": "–", "mdash": "—", "rsquo": "’", "lsquo": "‘"}
# End of fixed values.


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def named(value: Column, use: Callable[[Column], Column]) -> Column:
    """The same outside of lambdas, where generated code computes equal terms once."""
    return use(value)


def start_tag(compound: str) -> str:
    """Pattern of a start tag that fits one compound selector."""
    if PART.sub("", compound):
        raise ValueError(f"selector part {compound!r} has a form that is not supported")
    tag, tests = ANY_TAG, []
    for m in PART.finditer(compound):
        if m["tag"]:
            tag = ANY_TAG if m["tag"] == "*" else f"(?i:{re.escape(m['tag'])})"
            continue
        name, op, value = ("id", "=", m["id"]) if m["id"] else ("class", "~=", m["cls"]) if m["cls"] else (m["attr"], m["op"], m["val"])
        if op is None:
            tests.append(rf"(?=[^>]*?[\s\"'](?i:{name})(?=[\s=/>]))")
            continue
        v = re.escape(value or "")
        inside = lambda quote: {"=": v, "~=": rf"(?:[^{quote}>]*\s)?{v}(?:\s[^{quote}>]*)?", "*=": f"[^{quote}>]*?{v}[^{quote}>]*",
                                "^=": f"{v}[^{quote}>]*", "$=": f"[^{quote}>]*{v}"}[op]
        bare = {"=": v, "~=": v, "*=": rf"[^\s\"'>]*?{v}[^\s\"'>]*", "^=": rf"{v}[^\s\"'>]*", "$=": rf"[^\s\"'>]*{v}"}[op]
        tests.append(rf"(?=[^>]*?[\s\"'](?i:{name})\s*=\s*(?:\"{inside(chr(34))}\"|'{inside(chr(39))}'|{bare}(?=[\s>])))")
    return f"<{tag}(?=[\\s/>])" + "".join(tests)


def visible(html: Column) -> Column:
    """The page without scripts, styles and comments."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", "")


def tag_of(element: Column) -> Column:
    return F.lower(F.regexp_extract(element, f"^<({ANY_TAG})", 1))


def _end(pieces: Column) -> Column:
    """Number of the piece with the end tag that closes an open element; 0 if there is none."""
    closes = lambda piece: F.when(piece.startswith("</"), -1).when(piece.startswith("<") & ~piece.rlike("^<[^>]*/>"), 1).otherwise(0)
    state = F.struct(F.lit(0).alias("at"), F.lit(1).alias("depth"), F.lit(0).alias("end"))
    step = lambda s, piece: let(s["depth"] + closes(piece), lambda depth: F.struct(
        (s["at"] + 1).alias("at"), depth.alias("depth"),
        F.when(s["end"] > 0, s["end"]).when(depth == 0, s["at"] + 1).otherwise(0).alias("end")))
    return F.aggregate(pieces, state, step, lambda s: s["end"])


#: An element up to the first end tag of its name.
SHORT = rf"(?is)^<({ANY_TAG})[^>]*>(.*?)</\1\s*>"


def inner(element: Column, bind: Callable = named) -> Column:
    """Content of the element that a text begins with: null if it does not end there, empty for
    elements without content. Where no element of the same name is inside, one pattern reads it."""
    same = lambda tag: F.concat(F.lit("(?i)(?=</?"), tag, F.lit(r"(?=[\s/>]))"))
    cut = lambda pieces: let(_end(pieces), lambda end: F.when(end > 0, F.array_join(F.slice(pieces, 1, end - 1), "")))
    counted = lambda tag: let(F.split(F.regexp_replace(element, "^<[^>]*>", ""), same(tag)), cut)

    def read(tag: Column) -> Column:
        return bind(F.regexp_extract(element, SHORT, 2), lambda short: F.when(
            short == "", F.when(element.rlike(SHORT), "")).when(
            F.contains(F.lower(short), F.concat(F.lit("<"), tag)), counted(tag)).otherwise(short))

    alone = lambda tag: tag.isin(VOID) | element.rlike("^<[^>]*/>")
    return bind(tag_of(element), lambda tag: F.when(alone(tag), "").otherwise(read(tag)))


def elements(html: Column, compound: str) -> Column:
    """Array of (tag, content) of all elements that fit, in document order: their start tags and
    their inner markup. An element that is never closed reaches to the end."""
    start = start_tag(compound)

    def whole(parts: Column, part: Column, at: Column) -> Column:
        """The element that begins with a part, over the parts behind it if it holds further ones."""
        rest = lambda: F.array_join(F.slice(parts, at + 1, F.size(parts)), "")
        return let(inner(part, let), lambda own: F.when(own.isNotNull(), own).when(
            tag_of(part).isin(OPTIONAL_END), F.regexp_replace(part, "^<[^>]*>", "")).otherwise(
                F.coalesce(inner(rest(), let), F.regexp_replace(rest(), "^<[^>]*>", ""))))

    def found(parts: Column) -> Column:
        fit = F.transform(parts, lambda part, at: F.when(part.rlike(f"^{start}"), F.struct(
            F.regexp_extract(part, "^<[^>]*>", 0).alias("tag"), whole(parts, part, at).alias("content"))))
        return F.filter(fit, lambda e: e.isNotNull())

    return let(F.split(html, f"(?={start})"), found)


def _scope(html: Column, outer: list[str]) -> Column:
    """The markup inside all elements that fit nested compounds."""
    for compound in outer:
        html = F.array_join(F.transform(elements(html, compound), lambda e: e["content"]), "")
    return html


def selectors_of(text: str) -> list[list[str]]:
    """Selectors of a comma-separated list, each as its nested compounds; brackets are not cut."""
    listed = re.findall(r"(?:\[[^\]]*\]|[^,\[])+", text)
    return [re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", s) for s in listed if s.strip()]


def find_all(html: Column, selectors: str) -> Column:
    """Elements of the first selector in a list that fits any."""
    found = [elements(_scope(html, outer), last) for *outer, last in selectors_of(selectors)]
    known = [let(e, lambda some: F.when(F.size(some) > 0, some)) for e in found]
    return F.coalesce(*known) if known else F.lit(None)


def find_first(html: Column, selectors: str) -> Column:
    """Markup that begins with the first element of the first selector in a list that fits; null without one."""
    hits = [F.regexp_extract(_scope(html, outer), f"(?s)({start_tag(last)}.*)", 1) for *outer, last in selectors_of(selectors)]
    return F.coalesce(*[F.nullif(h, F.lit("")) for h in hits]) if hits else F.lit(None)


def attribute(element: Column, name: str) -> Column:
    """An attribute of the element that a text begins with, null without it."""
    pattern = rf"^<[^>]*?[\s\"'](?i:{name})\s*=\s*(?:\"([^\">]*)\"|'([^'>]*)'|([^\s\"'>]+))"
    value = lambda k: F.regexp_extract(element, pattern, k)
    return F.when(element.rlike(pattern), decoded(F.concat(value(1), value(2), value(3))))


def decoded(text: Column) -> Column:
    """Character references as their characters; unknown ones stay."""
    code = lambda piece: F.coalesce(
        F.regexp_extract(piece, r"^&#(\d{1,7});", 1).try_cast("long"),
        F.conv(F.nullif(F.regexp_extract(piece, "^&#[xX]([0-9a-fA-F]{1,6});", 1), F.lit("")), 16, 10).try_cast("long"))
    real = lambda n: (n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF)
    char = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    said = lambda piece: let(code(piece), lambda n: F.when(real(n), F.concat(
        char(n), F.regexp_replace(piece, "^&#[0-9xXa-fA-F]+;", ""))).otherwise(piece))
    out = F.when(text.contains("&#"), F.array_join(F.transform(F.split(text, "(?=&#)"), said), "")).otherwise(text)
    for name, char_ in [*ENTITIES.items(), ("amp", "&")]:
        out = F.replace(out, F.lit(f"&{name};"), F.lit(char_))
    return F.when(text.contains("&"), out).otherwise(text)


def text_of(markup: Column) -> Column:
    """Text of a piece of markup, trimmed."""
    return F.regexp_replace(decoded(F.regexp_replace(markup, "(?s)<[^>]*>", "")), r"^[\s\x{A0}]+|[\s\x{A0}]+$", "")
