"""Text expressions built from Spark functions only."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode-aware strip or split takes as white space.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regular expression that Java and RE2 read alike.
SPACE = (
    r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def strip(text: Column) -> Column:
    """Remove white space at both ends; reads no further than that."""
    return F.btrim(text, F.lit(SPACES))


def squeeze_newlines(text: Column) -> Column:
    """Three or more newlines become one blank line."""
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def words(text: Column) -> Column:
    """The non-empty words of a text.

    All white space becomes a plain blank first: splitting at one literal
    character is several times faster than splitting at a character class.
    """
    others = SPACES.replace(" ", "")
    blanks = F.translate(text, others, " " * len(others))
    return F.filter(F.split(blanks, " "), lambda w: w != "")


def utf8_text(content: Column) -> Column:
    """Strictly decoded text, null where the bytes are not UTF-8."""
    return F.try_validate_utf8(content.cast("string"))


def null_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def fill_template(template: str, **slots: Column) -> Column:
    """Put columns into the named slots of a template.

    The template is cut once here, on the driver; slot values are never scanned
    for further slots, so braces inside a text stay as they are.
    """
    pieces: list[Column] = []
    for literal, name, spec, conversion in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is None:
            continue
        if name not in slots or spec or conversion:
            raise ValueError(f"template slot {{{name}}} is not supported")
        pieces.append(F.coalesce(slots[name].cast("string"), F.lit("")))
    return F.concat(*pieces) if pieces else F.lit("")


def first_sentence(text: Column) -> Column:
    """Text up to and including the first full stop that a space or the end follows."""
    head = F.regexp_extract(text, rf"(?s)\A(.*?\.)(?:{SPACE}|\z)", 1)
    return strip(F.when(head != "", head).otherwise(text))
