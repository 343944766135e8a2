"""What is stripped from wiki Markdown and from papers before they are split."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkloom.functions.text import SPACE, each_match, let, lines, strip

# Lines of a paper's page furniture, as whole lines, starts and parts.
FULL_LINES = [r"\*\*\p{Nd}+\*\*", r"\p{Nd}+:\p{Nd}+", r"S\. Dong et al\.", "RocksDB: Evolution of Development Priorities"]
LINE_STARTS = ["ACM Transactions on Storage", "© ", "This work is licensed", "Authors", "SIYING DONG,", "CCS Concepts:", "Additional Key Words", "### **ACM Reference format:**"]
LINE_PARTS = ["https://doi.org/10.1145/3483840"]
# Patterns of what goes from papers and from wiki pages; from a wiki link, its text stays.
REFERENCES = r"(?md)^## \*\*REFERENCES\*\*"
SUPERSCRIPT = r"(?s)<sup>.*?</sup>"
CITATION = rf"\[\p{{Nd}}+(?:{SPACE}*,{SPACE}*\p{{Nd}}+)*\]"
LINK = r"\[\[([^\]|]+)(?:\|([^\]]+))?\]\]"
OPEN_LINK = r"\[\[([^\]\n|]+)\](?!\])"
IMAGE = r"!\[[^\]]*\]\([^)]*\)"
CLOSED_HEADING = rf"(?md)^({SPACE}*#{{1,6}}{SPACE}.*?){SPACE}*#+{SPACE}*$"
BYLINE = rf"(?md)^{SPACE}*#{{1,6}}{SPACE}*Author:.*$"


def link_text(target: Column, label: Column) -> Column:
    """The label, unless it is blank or has an anchor; then the target."""
    target, label = strip(target), strip(F.coalesce(label, F.lit("")))
    return F.when((label == "") | F.contains(label, F.lit("#")), target).otherwise(label)


def strip_wiki_noise(md: Column) -> Column:
    out = F.regexp_replace(each_match(md, LINK, 2, lambda g: link_text(g[0], g[1])), OPEN_LINK, "$1")
    out = F.regexp_replace(F.regexp_replace(out, IMAGE, ""), CLOSED_HEADING, "$1")
    return F.regexp_replace(out, BYLINE, "")


def is_furniture(line: Column) -> Column:
    """Of a line without white space at its ends."""
    hits = [line.rlike(r"\A(?:" + "|".join(FULL_LINES) + r")\z"), *(line.startswith(p) for p in LINE_STARTS), *(F.contains(line, F.lit(p)) for p in LINE_PARTS)]
    return reduce(Column.__or__, hits)


def strip_paper_noise(md: Column) -> Column:
    out = F.regexp_replace(F.replace(md, F.lit("<br>"), F.lit(" ")), SUPERSCRIPT, "")
    out = F.split(F.regexp_replace(out, CITATION, ""), REFERENCES, 2)[0]
    return F.array_join(F.filter(lines(out), lambda x: ~let(strip(x), is_furniture)), "\n")


def book_stem(title: Column, name: Column) -> Column:
    """A file stem from a title: other signs than word characters, blanks, full stops and dashes go; the name where nothing is left."""
    first = strip(F.split(F.coalesce(title, F.lit("")), "\n", 2)[0])
    stem = strip(F.regexp_replace(F.when(first == "", name).otherwise(first), r"[^\p{L}\p{N}_ .\-]+", ""))
    return F.when(stem == "", name).otherwise(stem)


def slug_from_url(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/", -1), -1)
