"""Column expressions that turn HTML and wiki markup into plain text."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Named character references with the text they stand for, as HTML defines them. A non-breaking
#: space becomes a plain one. The few that make up most of a text come first, as maps are searched.
COMMON = ("amp", "lt", "gt", "quot", "nbsp")
ENTITIES: dict[str, str] = {n: html5[f"{n};"] for n in COMMON} | {
    name.removesuffix(";"): value for name, value in html5.items() if name.endswith(";")
} | {"nbsp": " "}

REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"

SPACE = r"[ \t\n\r\f]+"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and pass it to ``use``, so that it is not evaluated per mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _decoded(reference: Column) -> Column:
    """The text of one reference; unknown names and numbers outside Unicode stay as they are."""
    hexadecimal = reference.rlike("^&#[xX]")
    digits = F.regexp_extract(reference, "^&#[xX]?0*([0-9a-fA-F]*);", 1)
    base = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits)
    code = F.when(F.length(digits).between(1, 7), base.cast("bigint"))
    legal = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    names = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")
    name = F.substring(reference, F.lit(2), F.length(reference) - 2)
    numeric = reference.startswith("&#")
    return F.coalesce(
        F.when(numeric & legal, char), F.when(~numeric, F.try_element_at(names, name)), reference
    )


def unescaped(text: Column) -> Column:
    """Decode named and numeric character references, each once, in one pass over the text."""

    def joined(bound: Column) -> Column:
        references = F.regexp_extract_all(bound, F.lit(REFERENCE), F.lit(0))
        between = F.split(bound, REFERENCE, -1)
        pieces = F.zip_with(
            between, F.transform(references, _decoded),
            lambda piece, char: F.concat(piece, F.coalesce(char, F.lit(""))),
        )
        return F.when(bound.contains("&"), F.array_join(pieces, "")).otherwise(bound)

    return _let(text, joined)


def squeezed(text: Column) -> Column:
    """Runs of whitespace become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def _closed(text: Column, closing: str, rewrite: Callable[[Column], Column]) -> Column:
    """Apply ``rewrite`` to the text up to its last match of ``closing``, if there is one.

    What ``rewrite`` looks for ends with ``closing``. So every search that it begins there ends there too, and
    no unclosed marker makes it run to the end of the text in vain: the time is linear.
    """

    def split(bound: Column) -> Column:
        return _let(
            F.regexp_extract(bound, f"(?is)^.*{closing}", 0),
            lambda reach: F.when(reach == "", bound).otherwise(
                F.concat(rewrite(reach), F.substring(bound, F.length(reach) + 1, F.length(bound)))
            ),
        )

    return _let(text, split)


def _without_tags(text: Column) -> Column:
    return _closed(text, ">", lambda t: F.regexp_replace(t, r"(?s)<[a-zA-Z/!][^>]*>", " "))


def _without_comments(text: Column) -> Column:
    return _closed(text, "-->", lambda t: F.regexp_replace(t, r"(?s)<!--.*?-->", " "))


def _where(text: Column, marker: str, rewrite: Callable[[Column], Column]) -> Column:
    """Apply ``rewrite`` to texts that hold ``marker``; a plain search is far cheaper than a pattern."""
    return _let(text, lambda t: F.when(t.contains(marker), rewrite(t)).otherwise(t))


def html_title(html: Column) -> Column:
    reach = F.regexp_extract(html, r"(?is)^.*</title>", 0)
    return squeezed(unescaped(F.regexp_extract(reach, r"(?is)<title[^<>]*>(.*?)</title>", 1)))


def html_text(html: Column) -> Column:
    """Visible text of a page: no comments, head, scripts, styles or tags."""
    html = _without_comments(html)
    for name in ("head", "script", "style"):
        pair = rf"(?is)<{name}[^<>]*>.*?</{name}>"
        html = _closed(html, f"</{name}>", lambda t, pair=pair: F.regexp_replace(t, pair, " "))
    return squeezed(unescaped(_without_tags(html)))


#: Tags whose content is no text of the article.
PAIRED_TAGS = ("ref", "math", "gallery", "source", "syntaxhighlight")


@lru_cache(maxsize=1)
def _resolver() -> Callable[[Column], Column]:
    """Column function that takes out what stands between two markers: comments, references and the like,
    and pairs which may stand inside each other: templates, tables, links.

    Each nested kind is one pass over the text, split at its markers, with a stack of the pairs that are open.
    Column expressions can only take the innermost pairs, once per level, so this is done in Python on
    Arrow batches. As in ``_closed``, nothing is searched beyond the last closing marker.
    """
    tags = PAIRED_TAGS

    @F.arrow_udf("string")
    def resolved(texts: pa.Array) -> pa.Array:
        def drop(inner: str) -> str:
            return " "

        def unlink(inner: str) -> str:
            return " " if media.match(inner) else inner.rpartition("|")[2]

        media = re.compile(r"\s*(?:file|image|category)\s*:", re.IGNORECASE)
        nested = [("{{", "}}", drop), ("{|", "|}", drop), ("[[", "]]", unlink)]
        splits = [re.compile(f"({re.escape(opening)}|{re.escape(closing)})") for opening, closing, _ in nested]
        comment = re.compile("<!--.*?-->", re.DOTALL)
        # a reference that closes itself is no opening one, even with a slash in its name
        alone = re.compile(r"<ref(?:[\s/][^<>]*)?(?<=/)>", re.IGNORECASE)
        closings = [re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in tags]
        pairs = [re.compile(rf"<{tag}(?:\s[^<>]*)?>.*?</{tag}\s*>", re.IGNORECASE | re.DOTALL) for tag in tags]

        def between(text: str) -> str:
            reach = text.rfind("-->") + 3
            if reach > 2:
                text = comment.sub(" ", text[:reach]) + text[reach:]
            text = alone.sub(" ", text)
            for closing, pair in zip(closings, pairs, strict=True):
                reach = 0
                for found in closing.finditer(text):
                    reach = found.end()
                if reach:
                    text = pair.sub(" ", text[:reach]) + text[reach:]
            return text

        def resolve(text: str) -> str:
            if "<" in text:
                text = between(text)
            for (opening, closing, rewrite), split in zip(nested, splits, strict=True):
                if closing not in text:
                    continue
                found: list[str] = []
                opened: list[int] = []
                for piece in split.split(text):
                    if piece == closing and opened:
                        start = opened.pop()
                        found[start:] = [rewrite("".join(found[start + 1 :]))]
                        continue
                    if piece == opening:
                        opened.append(len(found))
                    found.append(piece)
                text = "".join(found)
            return text

        return pa.array([None if t is None else resolve(t) for t in texts.to_pylist()], pa.string())

    return resolved


def wiki_text(markup: Column) -> Column:
    """Plain text of wiki markup.

    Comments, references, templates, tables, media and category links go; links and headings leave
    their label; quotes, list markers and tags go; character references are decoded. A marker without its
    partner stays as it is. Every step takes time in proportion to the text, however markers are nested or
    left unclosed; only the label of a link is copied once for each link around it.
    """

    def outside_links(text: Column) -> Column:
        text = _closed(text, r"\]", lambda t: F.regexp_replace(t, r"\[(?:https?|ftp)://[^\s\]]++\s*+([^\]]*+)\]", "$1"))
        return F.regexp_replace(text, r"(?:https?|ftp)://\S+", " ")

    def plain(text: Column) -> Column:
        text = _where(text, "://", outside_links)
        text = _where(text, "''", lambda t: F.regexp_replace(t, r"'{2,5}", ""))
        text = _where(text, "=", lambda t: F.regexp_replace(t, HEADING, "$1"))
        text = F.regexp_replace(text, r"(?m)^[*#:;]+[ \t]*", "")
        text = _where(text, "__", lambda t: F.regexp_replace(t, r"__[A-Z]+__", " "))
        text = unescaped(_where(text, "<", _without_tags))
        text = F.regexp_replace(text, r"[ \t\f\r]+", " ")
        return F.btrim(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), F.lit(" \n"))

    return _let(_resolver()(markup), plain)


#: A line between equals signs. The label is taken whole first and then given back from its end, so that runs of
#: blanks inside it are looked at once.
HEADING = r"(?m)^[ \t]*+={1,6}+[ \t]*+([^=\n](?:[^\n]*[^=\s])?)[ \t]*+={1,6}+[ \t]*+$"
