"""Python's text rules as Spark columns.

Python, Java and the usual SQL engines disagree about white space, line ends and digits.
Everything that must agree with Python goes through this module.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points that str.strip() and \s know, and the line ends of str.splitlines().
SPACE = r"[\t\n\x0B\f\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
RARE_SPACE = r"[\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Printable ASCII and line feeds, most of any text, are passed by before the many ranges of RARE_SPACE are gone through.
ANY_RARE_SPACE = rf"(?![\x20-\x7E\n]){RARE_SPACE}"
LINE_END = r"(?:\r\n|[\n\x0B\f\r\x1C-\x1E\x85\u2028\u2029])"


def let(value: Column, body) -> Column:
    """body(value) with value computed once for a row, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def holds(c: Column, *parts: str) -> Column:
    """Whether c has any of the parts in it."""
    return reduce(or_, [F.contains(c, F.lit(p)) for p in parts])


def where(c: Column, test, body) -> Column:
    """body(c) where test(c) holds, else c as it is. A rule's pattern is far slower to look for than some signs that every
    match of it has, so that texts without them are passed by; test must hold wherever body would change anything."""
    return let(c, lambda t: F.when(test(t), body(t)).otherwise(t))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACES))


def one_space(c: Column, least: int = 2) -> Column:
    """Runs of at least so much white space made one space. The class of all white space is slow to match, so it is used where a text has any of the rarer kinds."""
    return let(c, lambda t: F.when(t.rlike(ANY_RARE_SPACE), F.regexp_replace(t, f"{SPACE}{{{least},}}", " ")).otherwise(F.regexp_replace(t, f"[ \\t\\n\\x0B\\f\\r]{{{least},}}", " ")))


def lines(c: Column) -> Column:
    """splitlines(): no empty line after a final line end, none at all for an empty text."""
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(c, LINE_END + r"\z", ""), LINE_END, -1))


def word_count(c: Column) -> Column:
    """len(split()). All white space is made one sign and the text cut at it: the pattern of a word is far slower."""
    return F.size(F.array_remove(F.split(F.translate(c, SPACES, " " * len(SPACES)), " ", -1), "")).cast("long")


def matches(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("long")


def each_match(c: Column, pattern: str, groups: int, body) -> Column:
    """c with every match of pattern, which must not match the empty text, replaced by body(groups as an array). In one
    pass: what a replacement yields is never matched again. What lies between the matches and what they hold are two arrays that
    are put together again, so no sign has to be kept free as a mark. A group that took no part is empty."""

    def joined(t: Column) -> Column:
        gaps = F.split(t, pattern, -1)
        own = [F.regexp_extract_all(t, F.lit(pattern), F.lit(i + 1)) for i in range(groups)]
        if groups == 1:
            made = F.transform(own[0], lambda g: body(F.array(g)))
        else:
            made = F.transform(F.arrays_zip(*[g.alias(f"g{i}") for i, g in enumerate(own)]), lambda g: body(F.array(*[g[f"g{i}"] for i in range(groups)])))
        return F.array_join(F.zip_with(gaps, made, lambda gap, new: F.concat(gap, F.coalesce(new, F.lit("")))), "")

    # The text is named once a group: without let, rules that follow each other would compute it anew a hundredfold.
    return let(c, joined)


def repeated(own: Column, least: int, over: int) -> Column:
    """The distinct strings of an array that are in it `least` times or more and longer than `over`. Sorted, a string
    is the last of its first `least` where it equals the one least - 1 before it and not the one least before."""
    long = F.array_sort(F.filter(own, lambda x: F.length(x) > over))

    def pick(ordered: Column) -> Column:
        return F.filter(ordered, lambda x, i: (i >= least - 1) & (x == F.get(ordered, i - (least - 1))) & ((i < least) | (x != F.coalesce(F.get(ordered, i - least), F.lit("")))))

    return let(long, pick)
