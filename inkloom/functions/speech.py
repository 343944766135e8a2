"""URLs as speech, and the rules of spoken text that need no model."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkloom.functions.text import SPACE, each_match, holds, let, one_space, repeated, strip, where

# How the signs of a URL are spoken, in the order in which they are replaced.
SPOKEN_SIGNS = [(".", "dot"), ("/", "slash"), ("-", "dash"), ("_", "underscore"), ("#", "hash"), ("?", "question mark"), ("=", "equals"), ("&", "ampersand")]
URL = "(https?://" + SPACE.replace("[", "[^<>\"'", 1) + "+)"
TAIL = r"""([.,;:!?)\]}'"]+)\z"""


def spoken_url(url: Column) -> Column:
    """One URL without scheme, its signs as words; closing punctuation stays at the end as it is."""
    s = F.regexp_replace(url, r"\Ahttps?://", "")
    tail = F.regexp_extract(s, TAIL, 1)
    # A URL of nothing but such signs keeps one of them as its body only where there is a body before them.
    body = F.substring(s, F.lit(1), F.length(s) - F.length(tail))
    for sign, word in SPOKEN_SIGNS:
        body = F.replace(body, F.lit(sign), F.lit(f" {word} "))
    return F.concat(strip(one_space(body, 1)), tail)


def verbalize_urls(text: Column, keep_paragraphs: bool = False, keep_scheme_words: bool = False) -> Column:
    """Every http(s) URL spoken, the bare words http and https dropped, runs of white space made one space.

    The default also joins paragraphs and drops "HTTP" as an acronym; the flags keep both.
    """
    out = where(text, lambda t: holds(t, "://"), lambda t: each_match(t, URL, 1, lambda g: spoken_url(g[0])))
    if not keep_scheme_words:
        out = where(out, lambda t: t.rlike("[hH][tT][tT][pP]"), lambda t: F.regexp_replace(t, r"(?i)\bhttps?\b", ""))
    if keep_paragraphs:
        return F.array_join(F.transform(F.split(out, "\n\n", -1), lambda p: strip(one_space(p))), "\n\n")
    return strip(one_space(out))


# Number words, abbreviations and domain spellings of the narration rules; terms that stay as they are.
ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
ABBREVIATIONS = [("e.g.", "for example"), ("i.e.", "that is"), ("etc.", "and so on"), ("->", "leads to"), ("×", "times")]
SPELLINGS = [
    ("L0", "level zero"), ("L1", "level one"), ("Lmax", "level max"), ("SST", "ess ess tee"), ("WAL", "write-ahead log"), ("DB", "database"), ("I/O", "I O"), ("IO", "I O"),
    ("IOPS", "I O P S"), ("memtable", "mem table"), ("tmpfs", "temp f s"), ("fio", "F I O"), ("db_bench", "d b bench"), ("sst_dump", "ess ess tee dump"), ("ldb", "ell dee bee"),
    ("kLZ4Compression", "kay L Z 4 compression"), ("Get", "get"), ("Put", "put"), ("Delete", "delete"), ("Merge", "merge"), ("Prev", "prev"),
]
FIRST_MENTION = ("LSM", "log-structured merge", "L S M")
KEPT = ("GPU", "CPU", "RAM", "SSD")
SCALES = ("", "thousand", "million", "billion", "trillion")
SIGNS = [("=", "equals"), ("+", "plus"), ("*", "times"), ("×", "times"), ("/", "divided by")]
SPECIAL = {"code": r"(?md)^```", "table": r"(?md)^\s*\|.*\|\s*$", "equation": r"\$\$|(?md)^[^\n]*[A-Za-z0-9)]\s*=\s*[A-Za-z0-9(][^\n]*[+*/^]", "figure": r"(?md)^\s*(?:Figure|Fig\.)\s*\p{Nd}+"}


#: Names of a program, which stay as they are: with colons or underscores within, and the acronyms that are kept. They begin at
#: the border of a word, which is looked for once; no word is gone through a second time, as a shorter part of it cannot match.
NAMES = r"\b(\w++(?:::\w++)+\b|[A-Za-z][A-Za-z0-9]*+_\w++\b|(?:" + "|".join(KEPT) + r")\b)"
#: A whole number, maybe with commas, and its decimals; not a part of a word, a version or an address.
NUMBER = r"(?<![\w.,:/-])([0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.([0-9]+))?(?![\w:/]|[.,-][0-9])"
MOST_DIGITS = 3 * len(SCALES)


def number_word(n: int) -> str:
    return ONES[n] if n < 20 else TENS[n // 10 - 2] + (f" {ONES[n % 10]}" if n % 10 else "")


def digit_words(digits: Column) -> Column:
    words = F.lit(ONES[:10])
    return F.array_join(F.transform(F.filter(F.split(digits, ""), lambda c: c != ""), lambda c: F.get(words, c.cast("int"))), " ")


def group_words(n: Column) -> Column:
    """A number below a thousand; nothing for 0."""
    below = F.lit(["", *map(number_word, range(1, 100))])
    return F.concat_ws(" ", F.when(n >= 100, F.concat(F.get(below, F.floor(n / 100).cast("int")), F.lit(" hundred"))), F.nullif(F.get(below, n % 100), F.lit("")))


def integer_words(digits: Column) -> Column:
    """150 as "one hundred fifty": its groups of three digits, each with the name of its scale. Digit by digit where there are zeros in front, or more than MOST_DIGITS."""

    def grouped(n: Column) -> Column:
        padded = F.lpad(digits, n * 3, F.lit("0"))
        spoken = F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: let(
                group_words(F.substring(padded, i * 3 + 1, F.lit(3)).cast("int")), lambda w: F.when(w != "", F.rtrim(F.concat_ws(" ", w, F.get(F.lit(list(SCALES)), n - 1 - i)))).otherwise("")
            ),
        )
        return F.array_join(F.filter(spoken, lambda w: w != ""), " ")

    plain = (F.length(digits) <= MOST_DIGITS) & ((F.left(digits, F.lit(1)) != "0") | (F.length(digits) == 1))
    return F.when(digits == "0", ONES[0]).when(plain, let(F.ceil(F.length(digits) / 3).cast("int"), grouped)).otherwise(digit_words(digits))


def spoken_number(number: Column) -> Column:
    """A section's number, 5.12 as "five point twelve"."""
    return F.array_join(F.transform(F.split(number, r"\.", -1), integer_words), " point ")


def spoken_numbers(text: Column) -> Column:
    """Every number in words, 1,024 and 3.14 too; "x" between numbers is "times". Versions, addresses and parts of words stay."""
    times = F.regexp_replace(text, r"(?<![\w.,])([0-9][0-9.,]*) ?[x×] ?(?=[0-9])", "$1 times ")
    point = lambda d: F.when(d == "", "").otherwise(F.concat(F.lit(" point "), digit_words(d)))
    return each_match(times, NUMBER, 2, lambda g: F.concat(integer_words(F.replace(g[0], F.lit(","), F.lit(""))), point(g[1])))


def spoken_equation(text: Column) -> Column:
    """An equation's signs and numbers in words; what is no sign or number stays."""
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\^2\b", " squared"), r"\^3\b", " cubed"), r"\^", " to the power of ")
    out = spoken_numbers(F.regexp_replace(out, r"(?<=[\w)]) ?- ?(?=[\w(])", " minus "))
    for sign, word in SIGNS:
        out = F.replace(out, F.lit(sign), F.lit(f" {word} "))
    return strip(one_space(out))


def without_furniture(text: Column) -> Column:
    """Without standalone page numbers and without running heads: lines of over 15 signs that are there three times or more."""
    number = lambda x: (F.length(x) <= 4) & x.rlike(r"\A\p{Nd}{1,4}\z")
    own = F.split(text, "\n", -1)
    heads = repeated(F.transform(own, strip), 3, 15)
    kept = let(heads, lambda h: F.filter(own, lambda x: let(strip(x), lambda s: ~number(s) & ~F.array_contains(h, s))))
    return F.array_join(kept, "\n")


def spelled(text: Column) -> Column:
    """Terms as they are spoken; the first mention of one of them in full. Names of a program and the terms in KEPT are
    matched as well, and put back as they are, so that no part of them is taken for a term."""
    term, first, later = FIRST_MENTION
    mentioned = lambda t: let(F.split(t, rf"\b{term}\b", 2), lambda p: F.when(F.size(p) > 1, F.concat(p[0], F.lit(first), F.regexp_replace(F.get(p, F.lit(1)), rf"\b{term}\b", later))).otherwise(p[0]))
    t = where(text, lambda t: holds(t, term), mentioned)
    names = F.create_map(*[F.lit(x) for pair in SPELLINGS for x in pair])
    shorts = [short for short, _ in SPELLINGS]
    # The first letter is looked at before all else: most places have another one.
    pattern = rf"(?=[{''.join(sorted({x[0] for x in shorts}))}])(?<![\w/:])(?:({'|'.join(shorts)})(?:\(\))?)(?![\w/(:])|{NAMES}"
    # Names alone change nothing.
    return where(t, lambda t: holds(t, *shorts), lambda t: each_match(t, pattern, 2, lambda g: F.when(g[1] != "", g[1]).otherwise(names[g[0]])))


def ended(text: Column) -> Column:
    """Paragraphs that are not blank, an empty line between, each with an end: a full stop where none is."""
    own = F.filter(F.transform(F.split(text, r"\n\s*\n", -1), strip), lambda p: p != "")
    return F.array_join(F.transform(own, lambda p: F.when(F.right(p, F.lit(1)).isin(".", "!", "?"), p).otherwise(F.concat(p, F.lit(".")))), "\n\n")


def special_content(text: Column) -> Column:
    """How often there is what only a model can narrate: it is found and counted, not spoken."""
    return F.struct(*[F.regexp_count(text, F.lit(p)).cast("long").alias(k) for k, p in SPECIAL.items()])


def narration(text: Column) -> Column:
    """An approximation, by rules, of what the clean-up prompt asks of a model: page furniture dropped, hyphenation
    joined, citation marks and Markdown signs dropped, headings announced, URLs, abbreviations and terms spoken,
    paragraphs ended; bullets, quote signs and the bars of tables dropped. What code, tables, equations and figures need beyond
    that, blocks.section_prompts asks of a model."""
    has = lambda *parts: lambda t: holds(t, *parts)
    gone = lambda pattern, to="": lambda t: F.regexp_replace(t, pattern, to)
    t = without_furniture(text)
    t = where(t, has("-\n"), gone(r"(\p{L})-\n(\p{Ll})", "$1$2"))
    t = where(t, has("[", "(19", "(20", "<sup>"), gone(r"\[\p{Nd}+(?:\s*,\s*\p{Nd}+)*\]|\((?:19|20)\p{Nd}{2}\)|(?s)<sup>.*?</sup>"))
    t = where(t, has("]("), gone(r"\[([^\]\n]*)\]\([^)\n]*\)", "$1"))
    t = where(t, has("**", "`", "u>"), gone(r"\*\*|`|</?u>"))
    numbered = lambda t: each_match(t, r"(?md)^#{1,6} ([0-9]+(?:\.[0-9]+)*)\.? +(.*?) *$", 2, lambda g: F.concat(F.lit("Now: section "), spoken_number(g[0]), F.lit(", "), g[1], F.lit(".")))
    t = where(t, lambda t: t.rlike("# [0-9]"), numbered)
    t = where(t, has("# "), gone(r"(?md)^#{1,6} +(.*?)\.? *$", "Now: $1."))
    t = where(t, has("---"), gone(r"(?md)^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*(?:\n|\z)"))
    starts = " \t>-*+"
    bullets = gone(r"(?md)^[ \t]*(?:(?:>[ \t]?)+|[-*+][ \t]+|\|[ \t]*)|[ \t]*\|[ \t]*$|^[ \t]+")
    t = where(t, lambda t: F.left(t, F.lit(1)).isin(*starts) | holds(t, "|", *["\n" + x for x in starts]), bullets)
    t = where(t, has("|"), gone(r"[ \t]+\|[ \t]+", ", "))
    t = where(t, lambda t: t.rlike("x ?[0-9]"), gone(r"(?<![\w.,])([0-9][0-9.,]*) ?x ?(?=[0-9])", "$1 times "))
    t = where(t, has("Fig"), lambda t: each_match(t, r"\bFig\. ?([0-9]+)()", 2, lambda g: F.concat(F.lit("figure "), spoken_number(g[0]))))
    for short, long in ABBREVIATIONS:
        t = F.replace(t, F.lit(short), F.lit(long))
    return ended(verbalize_urls(spelled(t), keep_paragraphs=True))
