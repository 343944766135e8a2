"""HTML to Markdown, stated over a page's events; Spark has no HTML parser, so batches go through Python's.

A page is a list of events: tags and stretches of text. What is hidden is taken out by its
depth. Text between two neighbouring block tags is written when the second one closes, behind
the mark of the first where that one opens; between others it is lost. Fences stand where their
tags do. Everything from a footer's heading on is cut off.
"""

from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate, pairwise

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that are hidden, marks of block elements, and the headings at which a page's own text ends.
HIDDEN = ("script", "style", "svg", "noscript", "time")
MARKS = {"p": "", "li": "- ", "blockquote": "> ", "h1": "# ", "h2": "## ", "h3": "### ", "h4": "#### ", "h5": "##### ", "h6": "###### "}
FOOTER_HEADINGS = ("share on social media:", "subscribe to bi-weekly echo news")
FENCE = "```"
#: The article of a page, if it has one.
ARTICLE = r"(?s)<article[^>]*>.*?</article>"

#: (1 opens, -1 closes, 0 text; the tag or the text)
Event = tuple[int, str]


class Events(HTMLParser):
    """A page as a list of events, references decoded."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.found: list[Event] = []
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        self.found.append((1, tag))

    def handle_endtag(self, tag):
        self.found.append((-1, tag))

    def handle_data(self, data):
        self.found.append((0, data))


def depths(events: list[Event], tags: tuple[str, ...]) -> list[int]:
    """How many of tags are open after each event; closing tags without an open one count nothing."""
    return list(accumulate((kind if kind and what in tags else 0 for kind, what in events), lambda depth, step: max(0, depth + step)))


def visible(events: list[Event]) -> list[Event]:
    return [e for e, depth in zip(events, depths(events, HIDDEN), strict=True) if not depth and not (e[0] and e[1] in HIDDEN)]


def inline(events: list[Event]) -> list[str]:
    """What each event adds to the text of its block."""
    signs = [("`" if not fenced else "") if kind and what == "code" else "\n" if kind == 1 and what == "br" else "" for (kind, what), fenced in zip(events, depths(events, ("pre",)), strict=True)]
    return [what if kind == 0 else sign for (kind, what), sign in zip(events, signs, strict=True)]


def is_footer(tag: str, text: str) -> bool:
    return tag[0] == "h" and " ".join(text.split()).strip("#-* ").lower() in FOOTER_HEADINGS


def to_markdown(article: str, keep_code: bool = False) -> str:
    """keep_code writes the body of <pre>, which the plain rule loses."""
    events = visible(Events(article).found)
    texts = inline(events)
    bounds = MARKS | ({"pre": ""} if keep_code else {})
    edges = [-1, *(i for i, (kind, what) in enumerate(events) if kind and what in bounds)]
    fences = [(i, FENCE) for i, (kind, what) in enumerate(events) if kind and what == "pre"]
    blocks, end = [], len(events)
    for before, at in pairwise(edges):
        kind, tag = events[at]
        if kind == 1:
            continue
        mark = bounds[events[before][1]] if before >= 0 and events[before][0] == 1 else ""
        text = (mark + "".join(texts[before + 1 : at])).strip()
        if is_footer(tag, text):
            end = at
            break
        if text:
            blocks.append((at - 0.5, text))  # before a fence of the same tag
    return "\n".join(text for at, text in sorted(blocks + fences) if at < end).strip()


def html_to_markdown(html: Column, keep_code: bool = False) -> Column:
    """The first article of a page, or the whole page, as Markdown; null stays null."""

    def convert(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda page: to_markdown(page, keep_code), na_action="ignore")

    convert.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    article = F.coalesce(F.nullif(F.regexp_extract(html, ARTICLE, 0), F.lit("")), html)
    return F.pandas_udf(convert, "string")(article)
