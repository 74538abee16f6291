"""Tags and attributes of web pages, read once a page.

A page is scanned by the rules of HTML: attribute values stand in double quotes, in
single quotes or bare, in any order and any case of their names; of a repeated
attribute the first counts; comments and the contents of scripts, styles, titles and
text areas hold no tags; character references of all kinds are decoded, those
without a semicolon only where no letter, digit or ``=`` follows.  A tag that the
page ends in is none.  Null pages have no tags.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_START = re.compile(r"<(?:(!--)|([a-zA-Z][^\s/>]*))")
_COMMENT_END = re.compile(r"--!?>")
_ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?)""")
_REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*)(;?)(?=(.?))", re.S)
#: Elements whose content is text only.
_TEXT_ONLY = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes")}


def decode(value: str) -> str:
    """An attribute's value without character references."""

    def one(found: re.Match) -> str:
        after = found[2]
        open_name = not found[1] and found[0][1] != "#" and (after == "=" or after.isalnum())
        return found[0] if open_name else references.unescape(found[0])

    return _REFERENCE.sub(one, value) if "&" in value else value


def tags(page: str | None) -> Iterator[tuple[str, dict[str, str]]]:
    """(tag, attributes) of the opening tags of a page in order, names in lower case, values as they stand."""
    page, at = page or "", 0
    while found := _START.search(page, at):
        at = found.end()
        if found[1]:
            end = _COMMENT_END.search(page, at)
            at = end.end() if end else len(page)
            continue
        name, attributes = found[2].lower(), {}
        while part := _ATTRIBUTE.match(page, at):
            at = part.end()
            if part[1]:
                break
            attributes.setdefault(part[2].lower(), next((v for v in part.groups()[2:] if v is not None), ""))
        else:
            return
        yield name, attributes
        if name in _TEXT_ONLY:
            end = _TEXT_ONLY[name].search(page, at)
            at = end.start() if end else len(page)


def components(html: Column, tag: str | None = None) -> Column:
    """map<name, attributes>: what the first component of each name carries in ``attributes``; null where it carries nothing.

    Components are elements of the given tag, or of any tag with a hyphen.  The scan counts as one that isn't
    deterministic: so a page is scanned once, where it was asked for, and no filter on what was found is moved below
    a grouping or beside it, to scan again.
    """

    @F.pandas_udf("map<string,string>")
    def scan(pages: pd.Series) -> pd.Series:
        def one(page: str | None) -> dict[str, str | None]:
            found: dict[str, str | None] = {}
            for name, attributes in tags(page):
                if "name" in attributes and (name == tag if tag else "-" in name):
                    found.setdefault(decode(attributes["name"]), decode(attributes.get("attributes", "")) or None)
            return found

        return pages.map(one)

    return scan.asNondeterministic()(html)


def attributes(html: Column, *wanted: tuple[str, str]) -> Column:
    """array<struct<tag, attribute, value>> of the wanted (tag, attribute) in the order of the page."""
    by_tag: dict[str, list[str]] = {}
    for tag, attribute in wanted:
        by_tag.setdefault(tag, []).append(attribute)

    @F.pandas_udf("array<struct<tag:string,attribute:string,value:string>>")
    def scan(pages: pd.Series) -> pd.Series:
        row = lambda page: [{"tag": t, "attribute": a, "value": decode(own[a])} for t, own in tags(page) if t in by_tag for a in by_tag[t] if a in own]
        return pages.map(row)

    return scan(html)
