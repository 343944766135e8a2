"""Documents to sections, sections to chunks, and the sample that a model is shown."""

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from inkloom.functions.noise import strip_wiki_noise
from inkloom.functions.text import let, lines, strip

MAX_SECTION_CHARS = 8000
# Heading levels at which the kinds of document are split.
LEVELS = {"paper": "## ", "blog": "#{2,3} ", "wiki": "#{1,4} "}


#: A kind of document, or a function from a text to an array of sections.
Split = str | Callable[[Column], Column]


def split_sections(md: Column, kind: Split) -> Column:
    """Non-blank sections in order, stripped; each begins with its heading. Wiki text is cleaned first."""
    if callable(kind):
        return F.filter(F.transform(kind(md), strip), lambda p: p != "")
    md = strip_wiki_noise(md) if kind == "wiki" else md
    parts = F.transform(F.split(md, rf"(?md)^(?={LEVELS[kind]})", -1), strip)
    return F.filter(parts, lambda p: p != "")


def chunks(section: Column, max_chars: int = MAX_SECTION_CHARS, hard_limit: bool = False) -> Column:
    """Whole paragraphs, packed greedily into chunks of at most max_chars; each paragraph counts two more.

    A section that fits stays whole, and so does a single paragraph that does not, unless hard_limit cuts it.
    """
    none = F.array().cast("array<string>")
    paragraphs = F.split(section, "\n\n", -1)
    if hard_limit:
        # Each code point of a paragraph belongs to one piece; an empty paragraph is one empty piece.
        cut = lambda p: F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length(p) - 1) / max_chars))), lambda i: F.substring(p, i.cast("int") * max_chars + 1, F.lit(max_chars)))
        paragraphs = F.flatten(F.transform(paragraphs, cut))
    joined = lambda acc: F.concat(acc["out"], F.array(F.array_join(acc["cur"], "\n\n")))

    def add(acc, p):
        cost = F.length(p) + 2
        full = (F.size(acc["cur"]) > 0) & (acc["n"] + cost > max_chars)
        return F.struct(
            F.when(full, joined(acc)).otherwise(acc["out"]).alias("out"),
            F.when(full, F.array(p)).otherwise(F.concat(acc["cur"], F.array(p))).alias("cur"),
            F.when(full, cost).otherwise(acc["n"] + cost).alias("n"),
        )

    start = F.struct(none.alias("out"), none.alias("cur"), F.lit(0).alias("n"))
    return F.when(F.length(section) <= max_chars, F.array(section)).otherwise(F.aggregate(paragraphs, start, add, joined))


def explode_chunks(docs: DataFrame, kind: Split | None, max_chars: int = MAX_SECTION_CHARS, hard_limit: bool = False) -> DataFrame:
    """The columns of docs (text replaced), sec_idx, chunk_idx: order is in columns, not in rows. A document
    without sections is one row without text and places, so that it is not lost."""
    sections = split_sections(F.col("text"), kind) if kind else F.array("text")
    keep = [c for c in docs.columns if c != "text"]
    out = docs.select(*keep, F.posexplode_outer(sections).alias("sec_idx", "section"))
    return out.select(*keep, "sec_idx", F.posexplode_outer(chunks(F.col("section"), max_chars, hard_limit)).alias("chunk_idx", "text"))


def splitter(split: Callable[[str], Iterator[str]]):
    """A table function of a text: sec_idx, section of what split yields, blank ones left out and the others stripped. For splits that
    no column states; joined laterally it keeps a document's other columns beside its sections."""

    @udtf(returnType="sec_idx int, section string")
    class Sections:
        def eval(self, text: str):
            number = 0
            for part in split(text or ""):
                if part := part.strip():
                    yield number, part
                    number += 1

    return Sections


def split_by(docs: DataFrame, split: Callable[[str], Iterator[str]], name: str = "sections_of") -> DataFrame:
    """The columns of docs but text, sec_idx and section: docs joined laterally with a splitter, which is registered under name."""
    docs.sparkSession.udtf.register(name, splitter(split))
    kept = ", ".join(f"d.`{c}`" for c in docs.columns if c != "text")
    return docs.sparkSession.sql(f"SELECT {kept}, s.sec_idx, s.section FROM {{docs}} d, LATERAL {name}(d.text) s", docs=docs)


def sample_text(text: Column, first: int = 200, middle: int = 200) -> Column:
    """The head and the middle of a long text, with a note of how many lines are left out."""
    return let(lines(text), lambda own: sampled(text, own, first, middle))


def sampled(text: Column, own: Column, first: int, middle: int) -> Column:
    n = F.size(own)
    head = F.array_join(F.slice(own, 1, first), "\n")
    body = F.array_join(F.slice(own, F.floor(n / 2).cast("int") + 1, F.lit(middle)), "\n")
    note = F.concat(F.lit("\n\n... [ "), (n - (first + middle)).cast("string"), F.lit(" lines omitted ] ...\n\n"))
    return F.when(n <= first + middle, text).otherwise(F.concat(head, note, body))


def spoken_paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, "\n+", -1), lambda p: strip(p) != "")
