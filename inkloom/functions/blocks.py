"""Markdown as typed blocks: what a narrator treats by kind is found by kind, with its place.

A line's kind follows from the line and from two states, whether a fence and whether a displayed equation is open;
neighbouring lines of one kind are a block. A block's kind decides what of its Markdown goes and what a model is asked for.
"""

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.functions.text import let

# Kinds by the first pattern that a line has, in this order; SQL states the same ones. Space is ASCII's here.
KINDS = {
    "heading": r"^#{1,6}[ \t]",
    "table": r"^[ \t]*\|.*\|[ \t]*$",
    "figure": r"^[ \t]*(Figure|Fig\.)[ \t]*[0-9]+|^[ \t]*!\[[^\]]*\]\([^)]*\)[ \t]*$",
    "quote": r"^[ \t]*>",
    "list": r"^[ \t]*([-*+]|[0-9]+[.)])[ \t]+[^ \t]",
    "equation": r"^[ \t]*\$\$.+\$\$[ \t]*$|^[^.!?]*[A-Za-z0-9)][ \t]*=[ \t]*[A-Za-z0-9(][^.!?]*[-+*/^]",
}
FENCE, DISPLAY = r"^[ \t]*```", r"^[ \t]*\$\$[ \t]*$"
BLANK = r"^[ \t\x0B\f\r]*$"
#: Kinds whose lines are blocks of their own.
SINGLE = ("heading", "figure")

#: What a model is asked for beyond the prompt of its corpus, where a section has blocks of a kind.
ASKED = {
    "code": "The section has code: say what language it is in and what it does, line by line where it is short, without reading its signs.",
    "table": "The section has a table: say what its rows and columns are, then what its figures show; do not read cell after cell.",
    "equation": "The section has an equation: say it in words.",
    "figure": "The section has a figure's caption: keep it, as what the figure shows, where it says anything.",
    "list": "The section has a list: make sentences of its items.",
    "quote": "The section quotes someone: say so.",
}


@dataclass(frozen=True)
class Block:
    kind: str
    first: int
    last: int
    text: str


def typed_blocks(text: str) -> Iterator[Block]:
    """The blocks of a text in order, with the numbers of their first and last lines. Blank lines are in no block but those of fences and displayed equations."""
    kinds = {k: re.compile(p) for k, p in KINDS.items()}
    fence, display, blank = map(re.compile, (FENCE, DISPLAY, BLANK))
    held: list[str] = []
    first, kind_before, fenced, displayed, closed = 0, "", False, False, False
    for at, line in enumerate([*text.split("\n"), None]):
        kind, opens, closes = "", False, False
        if line is not None:
            if fence.search(line):
                kind, opens, closes, fenced = "code", not fenced, fenced, not fenced
            elif fenced:
                kind = "code"
            elif display.search(line):
                kind, opens, closes, displayed = "equation", not displayed, displayed, not displayed
            elif displayed:
                kind = "equation"
            elif not blank.search(line):
                kind = next((k for k, p in kinds.items() if p.search(line)), "text")
        if held and (kind != kind_before or opens or closed or kind in SINGLE):
            yield Block(kind_before, first, at - 1, "\n".join(held))
            held = []
        if kind:
            if not held:
                first = at
            held.append(line)
        kind_before, closed = kind, closes


def explode_blocks(docs: DataFrame, keys: list[str], rows: Callable[[str], Iterator[Block]] = typed_blocks) -> DataFrame:
    """keys, block, kind, first, last, text: a row for each block of docs (keys, text). A null or blank text has none."""
    own = docs.select(*keys, "text")
    shape = own.select(*keys, F.lit(0).alias("block"), F.lit("").alias("kind"), F.lit(0).alias("first"), F.lit(0).alias("last"), "text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            for k, text in enumerate(batch.column(batch.num_columns - 1)):
                for n, b in enumerate(rows(text.as_py() or "")):
                    at.append(k), out.append((n, b.kind, b.first, b.last, b.text))
            columns = list(zip(*out, strict=True)) or [()] * 5
            made = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string()), strict=True)]
            kept = batch.select(keys).take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([*kept.columns, *made], names=[*keys, "block", "kind", "first", "last", "text"])

    return own.mapInArrow(run, shape)


def without_markdown(kind: Column, text: Column) -> Column:
    """A block's text without the signs of its kind: no fences, bars, bullets, quote signs or dollars; a table's rows are lines of
    cells with commas between, its line of dashes goes; a caption says what the figure shows, and a bare one is empty."""
    cells = F.regexp_replace(F.regexp_replace(text, r"(?m)^[ \t]*\|[ \t:|-]*\|[ \t]*(?:\n|\z)", ""), r"(?m)^[ \t]*\|[ \t]*|[ \t]*\|[ \t]*$", "")
    caption = F.regexp_replace(text, r"^[ \t]*(?:(?:Figure|Fig\.)[ \t]*[0-9]+[ \t]*[.:)]?[ \t]*|!\[([^\]]*)\]\([^)]*\)[ \t]*$)", "$1")
    return (
        F.when(kind == "code", F.regexp_replace(text, r"(?m)^[ \t]*```.*(?:\n|\z)", ""))
        .when(kind == "table", F.regexp_replace(cells, r"[ \t]*\|[ \t]*", ", "))
        .when(kind == "quote", F.regexp_replace(text, r"(?m)^[ \t]*(?:>[ \t]?)+", ""))
        .when(kind == "list", F.regexp_replace(text, r"(?m)^[ \t]*[-*+][ \t]+", ""))
        .when(kind == "equation", F.btrim(F.regexp_replace(text, r"\$\$", ""), F.lit(" \t\n")))
        .when(kind == "heading", F.regexp_replace(text, r"^#{1,6}[ \t]+|[ \t]*#*[ \t]*\z", ""))
        .when(kind == "figure", let(caption, lambda c: F.when(c == "", "").otherwise(F.concat(F.lit("The figure shows "), F.lower(F.left(c, F.lit(1))), F.substr(c, F.lit(2))))))
        .otherwise(text)
    )


def asked_for(system: Column, kinds: Column) -> Column:
    """A prompt, and behind it what is asked for each of the kinds (an array) that a section has, in the order of ASKED."""
    wanted = [F.when(F.array_contains(kinds, k), F.lit(hint)) for k, hint in ASKED.items()]
    return F.concat_ws("\n\n", system, *wanted)


def section_prompts(parts: DataFrame, keys: list[str], system: Column) -> DataFrame:
    """parts (keys, text, …) with asked_for's prompt of each section as prompt; keys name a section."""
    kinds = explode_blocks(parts, keys).groupBy(*keys).agg(F.collect_set("kind").alias("kinds"))  # eight of them at most
    own = parts.join(kinds, keys, "left")
    return own.select(*parts.columns, asked_for(system, F.coalesce("kinds", F.array().cast("array<string>"))).alias("prompt"))
