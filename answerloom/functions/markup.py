"""HTML to Markdown by one fold over the tags of a page, inside the JVM.

A page is cut once into tags and texts. The fold goes through them with a small state (open lists and their counters,
preformatted text, the open link, the cells of the table row) and appends what each of them stands for. Marks that need
what comes later (where a link or an emphasis ends) are control characters, which a page cannot hold, until the end.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from answerloom.functions.text import squeeze_newlines, strip

# Elements that start and end a block of text.
BLOCKS = (
    "address|article|aside|blockquote|body|dd|details|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    "header|html|main|nav|ol|p|pre|section|summary|table|tbody|tfoot|thead|tr|ul"
)
# Elements without text for the reader.
SILENT = ("script", "style", "head", "template")

# Control characters that stand for something until the end: a space and a line break that stay as they are, the two
# ends of a link, and the two ends of strong, emphasised and code text.
KEPT_SPACE, KEPT_BREAK, LINK, LINK_END = "\x01", "\x02", "\x0e", "\x0f"
INLINE = {("b", "strong"): ("**", "\x03", "\x04"), ("i", "em"): ("*", "\x05", "\x06"), ("code",): ("`", "\x10", "\x11")}
# A line break, unless there is one already.
SOFT_BREAK = "\x12"
CONTROLS = "[\x01-\x06\x0e-\x12]"
INDENT = KEPT_SPACE * 4
#: Text is appended to a piece of so many characters, and pieces to a list, so that a long page is not copied for each tag.
TAIL = 4096

# Names and characters of the standard table; the most frequent names come first, as a lookup reads from the front.
FREQUENT_NAMES = ("amp", "lt", "gt", "quot", "nbsp", "copy", "middot")
# A space that does not break is a plain one here.
NAMED = {n.removesuffix(";"): c.replace("\xa0", " ") for n, c in html5.items() if n.endswith(";")}
NAMED = {n: NAMED[n] for n in FREQUENT_NAMES} | NAMED

def decode_entities(text: Column) -> Column:
    """Replace named, decimal and hexadecimal character references by their characters, in one pass.

    What is no known reference stays as it is; what a replaced one makes together with the text after it is not
    read again.
    """
    names = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")

    def character(code: Column) -> Column:
        usable = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(usable, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def piece(part: Column, position: Column) -> Column:
        name = F.regexp_extract(part, r"\A(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);", 1)
        decimal = F.regexp_extract(name, r"\A#0*([0-9]{1,7})\z", 1)
        hexadecimal = F.regexp_extract(name, r"\A#[xX]0*([0-9a-fA-F]{1,6})\z", 1)
        found = (
            F.when(name == "", F.lit(None).cast("string"))
            .when(decimal != "", character(decimal.cast("bigint")))
            .when(hexadecimal != "", character(F.conv(hexadecimal, 16, 10).cast("bigint")))
            .otherwise(F.try_element_at(names, name)))
        rest = F.substr(part, F.length(name) + 2)
        return F.when(position == 0, part).otherwise(
            F.coalesce(F.concat(found, rest), F.concat(F.lit("&"), part)))

    return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "&"), piece), "")).otherwise(text)


def _plain_tags() -> dict[str, str]:
    """Tags that stand for the same text wherever they are, but in preformatted text."""
    breaks = set(BLOCKS.split("|")) - {"ul", "ol", "pre", "tr", "thead", "tbody", "tfoot"}
    out = {end + name: "\n\n" for name in breaks for end in ("", "/")}
    for level in range(1, 7):
        out |= {f"h{level}": "\n\n" + "#" * level + " ", f"/h{level}": "\n\n"}
    for names, (_, start, end) in INLINE.items():
        out |= {name: start for name in names} | {f"/{name}": end for name in names}
    return out | {"br": "\n", "hr": "\n\n---\n\n"}


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in double quotes, single quotes or none; empty without it."""
    pattern = rf"""(?is)\A<[^\s>]+\s(?:[^>]*?\s)?{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, group) for group in (1, 2, 3)])


def _token(text: Column) -> Column:
    """Name of the tag (null for a text), what it gives, and what it gives in preformatted text or, for a link, its target."""
    is_tag = text.rlike(r"\A<[!/?a-zA-Z]")
    name = F.when(is_tag, F.lower(F.regexp_extract(text, r"\A<(/?[a-zA-Z][a-zA-Z0-9]*)", 1)))
    plain = F.from_json(F.lit(json.dumps(_plain_tags())), "map<string,string>")
    image = F.concat(F.lit("!["), _attribute(text, "alt"), F.lit("]("), _attribute(text, "src"), F.lit(")"))

    def described(name: Column) -> Column:
        shown = (
            F.when(name.isNull(), F.regexp_replace(text, r"[ \t\r\n\f]+", " "))
            .when(name == "img", F.when(_attribute(text, "src") != "", image).otherwise(""))
            .otherwise(F.coalesce(F.try_element_at(plain, name), F.lit(""))))
        kept = F.when(name.isNull(), F.translate(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\t"), F.lit(
            "    ")), " \n\r", KEPT_SPACE + KEPT_BREAK * 2)).when(name == "a", _attribute(text, "href")).otherwise("")
        return F.struct(name.alias("name"), shown.alias("shown"), kept.alias("kept"))

    return _let(name, described)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


START = "struct<done:array<string>,tail:string,lists:array<int>,pre:boolean,link:string,cells:int,head:boolean>"


def _step(state: Column, token: Column) -> Column:
    """The state after one more tag or text."""
    name = token["name"]
    depth = F.size(state["lists"])
    counter = F.coalesce(F.get(state["lists"], depth - 1), F.lit(0))  # of the innermost list; 0 without numbers
    opens, closes = name.isin("ul", "ol"), name.isin("/ul", "/ol")
    cell, row_ends = name.isin("td", "th"), name.isin("tr", "/tr", "table", "/table") & (state["cells"] > 0)
    in_row = state["cells"] > 0

    item = F.concat(F.lit("\n"), F.repeat(F.lit(INDENT), F.greatest(depth - 1, F.lit(0))),
                    F.when(counter > 0, F.concat(counter.cast("string"), F.lit(". "))).otherwise("* "))
    row_end = F.concat(F.lit(" |\n"), F.when(state["head"], F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), state["cells"]), F.lit(
        "\n"))).otherwise(""))
    piece = (
        F.when(state["pre"], F.when(name.isNull(), token["kept"]).when(name == "br", KEPT_BREAK).when(
            name == "/pre", "\n```\n\n").otherwise(""))
        .when(name.isNull(), token["shown"])
        .when(name == "pre", "\n\n```\n")
        .when(name == "li", item)
        .when(opens, F.when(depth > 0, "").otherwise("\n\n"))
        .when(closes, F.when(depth > 1, SOFT_BREAK).otherwise("\n\n"))
        .when(name == "a", F.when(token["kept"] != "", LINK).otherwise(""))
        .when(name == "/a", F.when(state["link"].isNotNull(), F.concat(F.lit(f"{LINK_END}]("), state["link"], F.lit(")"))).otherwise(""))
        .when(row_ends, F.concat(row_end, F.when(name.isin("table", "/table"), "\n").otherwise("")))
        .when(cell, F.when(in_row, " | ").otherwise("| "))
        .when(in_row & token["shown"].contains("\n"), " ")
        .otherwise(token["shown"]))
    last = F.slice(state["lists"], 1, F.greatest(depth - 1, F.lit(0)))
    lists = (
        F.when(state["pre"], state["lists"])
        .when(name == "ul", F.array_append(state["lists"], F.lit(0)))
        .when(name == "ol", F.array_append(state["lists"], F.lit(1)))
        .when(closes, last)
        .when((name == "li") & (counter > 0), F.array_append(last, counter + 1))
        .otherwise(state["lists"]))
    link = F.when(state["pre"], state["link"]).when((name == "a") & (token["kept"] != ""), token["kept"]).when(
        name != "/a", state["link"]).when(name.isNull(), state["link"])
    cells = F.when(name.isin("tr", "/tr", "table", "/table"), 0).when(cell, state["cells"] + 1).otherwise(state["cells"])

    def grown(tail: Column) -> Column:
        full = F.length(tail) > TAIL
        return F.struct(
            F.when(full, F.array_append(state["done"], tail)).otherwise(state["done"]).alias("done"),
            F.when(full, "").otherwise(tail).alias("tail"), lists.alias("lists"),
            F.coalesce((name == "pre") | state["pre"] & (name != "/pre"), state["pre"]).alias("pre"), link.alias("link"),
            cells.alias("cells"),
            F.coalesce(F.when(name.isin("tr", "/tr", "table", "/table"), False).otherwise(state["head"] | (name == "th")),
                       state["head"]).alias("head")).cast(START)

    return _let(F.concat(state["tail"], piece), grown)


def html_to_markdown(html: Column) -> Column:
    """Markdown with ``#`` headings, links, nested and numbered lists, tables, preformatted text, emphasis and blank lines
    between blocks."""
    text = F.regexp_replace(html, CONTROLS, "")
    for name in SILENT:
        text = F.regexp_replace(text, rf"(?is)<{name}\b[^>]*>.*?</{name}[^>]*>", "")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", "")
    tokens = F.regexp_extract_all(text, F.lit(r"(<[!/?a-zA-Z][^>]*>|[^<]+|<)"), F.lit(1))
    start = F.from_json(F.lit('{"done":[],"tail":"","lists":[],"pre":false,"link":null,"cells":0,"head":false}'), START)
    text = F.aggregate(F.transform(tokens, _token), start, _step, lambda s: F.concat(F.array_join(s["done"], ""), s["tail"]))
    text = F.translate(F.regexp_replace(text, rf"{SOFT_BREAK}(?= *[{SOFT_BREAK}\n])", ""), SOFT_BREAK, "\n")
    text = F.regexp_replace(F.regexp_replace(text, rf"{LINK}[ \n]*", "["), rf"[ \n]*{LINK_END}", "")
    for mark, first, last in INLINE.values():
        # Inline marks stay within a line: Markdown knows no others, and an element that is never closed gives none.
        text = F.regexp_replace(text, rf"{first}([^{first}{last}\n]*){last}", rf"{mark}$1{mark}")
        text = F.translate(text, first + last, "")
    text = F.regexp_replace(F.regexp_replace(text, r" *\n *", "\n"), r" {2,}", " ")
    text = _let(text, decode_entities)
    return F.translate(squeeze_newlines(strip(text)), KEPT_SPACE + KEPT_BREAK, " \n")
