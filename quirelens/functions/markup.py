"""Text of HTML pages as expressions: tokens by one pattern, character references by lookup and arithmetic."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import strip

# The rest of a start tag: values in quotes after an equals sign may hold ">".
_REST = r"""[^\s/>]*+(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+"""


def _raw(name: str) -> str:
    """An element whose content is no markup, with its content; where it is not closed, to the end."""
    return rf"<(?i:{name})(?=[\s/>])(?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+(?<!/)>.*?(?:</(?i:{name})(?=[\s/>])[^>]*+>|\z)"


TOKEN = "(?s)" + "|".join(
    [
        r"<!--(?:-?>|.*?(?:--!?>|\z))",
        r"<!\[CDATA\[.*?(?:\]\]>|\z)",
        _raw("script"),
        _raw("style"),
        r"<[!?][^>]*+(?:>|\z)",
        r"</[^a-zA-Z>][^>]*+(?:>|\z)",
        rf"</?[a-zA-Z]{_REST}>",
        r"<(?:[a-zA-Z]|/(?!>)).*+",  # a tag that does not end: nothing after it is text
        r"(?:[^<]++|<(?![a-zA-Z/!?])|</>)++",  # "</>" is nothing at all
    ]
)
_REFERENCE = r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[^\t\n\f <&#;]{1,32}+;?)|[^&]++|&"
#: Names that need no semicolon: they also count as beginnings of longer ones.
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
# Codes of 0x80 to 0x9F stand for the characters of code page 1252 where it has one.
_C1 = {chr(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")}


def _character(code: Column) -> Column:
    """The character of a numeric reference."""
    one = F.translate(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"), "".join(_C1), "".join(_C1.values()))
    bad = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    silent = code.between(1, 8) | code.between(0xE, 0x1F) | (code == 0xB) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF) | (code % 0x10000 >= 0xFFFE)
    return F.when(bad, "�").when(silent, "").otherwise(one)


def _code(digits: Column, base: int) -> Column:
    """The number of digits, one beyond all characters where there are too many of them."""
    own = F.ltrim(digits, F.lit("0"))
    return F.when(F.length(own) > 7, 0x110000).otherwise(F.coalesce(F.conv(F.when(own == "", "0").otherwise(own), base, 10).cast("long"), F.lit(0)))


def unescape(text: Column) -> Column:
    """Character references decoded: all named ones, also without semicolon where HTML allows that, and numeric ones."""
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")

    def one(r: Column) -> Column:
        name = F.substring(r, 2, 40)
        number = F.regexp_extract(r, r"^&#([0-9]+)", 1)
        hexa = F.regexp_extract(r, r"^&#[xX]([0-9a-fA-F]+)", 1)
        start = F.regexp_extract(name, "^(?:" + "|".join(_BARE) + ")", 0)
        rest = F.concat(F.try_element_at(names, start), F.substring(name, F.length(start) + 1, F.lit(40)))
        named = F.coalesce(F.try_element_at(names, name), F.when(start != "", rest), r)
        return F.when(~F.startswith(r, F.lit("&")) | (r == "&"), r).when(number != "", _character(_code(number, 10))).when(hexa != "", _character(_code(hexa, 16))).otherwise(named)

    pieces = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, one), "")).otherwise(text)


def visible_text(html: Column) -> Column:
    """The text runs of a page, without scripts, styles, comments and declarations, each stripped, one a line; empty ones are left out."""

    def run(t: Column) -> Column:
        section = F.regexp_extract(t, r"(?s)^<!\[CDATA\[(.*?)(?:\]\]>)?\z", 1)
        return F.when(F.startswith(t, F.lit("<![CDATA[")), section).when(~F.rlike(t, F.lit("^<(?:[a-zA-Z!?]|/(?!>))")), unescape(F.replace(t, F.lit("</>"), F.lit(""))))

    runs = F.transform(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0)), lambda t: strip(run(t)))
    return F.array_join(F.filter(runs, lambda x: F.coalesce(x, F.lit("")) != ""), "\n")
