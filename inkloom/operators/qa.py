"""Quality checks of narration text against its source."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.functions.text import SPACE, let, lines, matches, repeated, strip, word_count

# What is left of Markdown, by pattern; the accepted band of word ratios; names that are not checked.
RESIDUE = {"#": "#", r"\*\*": r"\*\*", "`": "`", r"^\s*\|": rf"(?md)^{SPACE}*\|", r"\]\(": r"\]\(", "http": "http"}
RATIO_MIN, RATIO_MAX = 0.85, 1.20
IGNORED = ("memtable", "prefix-seek", "transactions", "read-only-and-secondary-instances", "memory-usage-in-rocksdb")
REPEATED_OVER, REPEATED_FROM = 15, 3


def markdown_residue(text: Column) -> Column:
    return F.create_map(*[x for name, p in RESIDUE.items() for x in (F.lit(name), matches(text, p))])


def residue_total(residue: Column) -> Column:
    return F.aggregate(F.map_values(residue), F.lit(0).cast("long"), lambda a, x: a + x)


def shown(residue: Column) -> Column:
    """The patterns that were found; "0" when none was."""
    hits = F.map_entries(F.map_filter(residue, lambda k, v: v > 0))
    return F.when(F.size(hits) == 0, "0").otherwise(F.array_join(F.transform(hits, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ", "))


def stripped_lines(text: Column) -> Column:
    """What the three checks by line take: white space at a line's ends counts in none of them."""
    return F.transform(lines(text), strip)


def orphan_numbers(own: Column) -> Column:
    return F.size(F.filter(own, lambda x: (F.length(x) <= 4) & x.rlike(r"\A\p{Nd}{1,4}\z"))).cast("long")


def dangling_lines(own: Column) -> Column:
    return F.size(F.filter(own, lambda x: (x != "") & ~F.right(x, F.lit(1)).isin(".", "?", "!"))).cast("long")


def repeated_lines(own: Column, least: int = REPEATED_FROM) -> Column:
    """Distinct lines of over 15 code points that are there three times or more, within one row: no shuffle."""
    return F.size(repeated(own, least, REPEATED_OVER)).cast("long")


def word_ratio(clean: Column, raw: Column) -> Column:
    return word_count(clean).cast("double") / F.greatest(word_count(raw), F.lit(1).cast("long"))


def ignored(name: Column) -> Column:
    return F.exists(F.array(*map(F.lit, IGNORED)), lambda p: F.contains(name, p))


def report(clean: DataFrame, raw: DataFrame, keys: list[str], found: bool = False) -> DataFrame:
    """Five checks and the flags of each clean document; without a source (status "no source") there are none. With found,
    residue says which patterns were found, and how often."""
    both = clean.select(*keys, F.col("text").alias("clean")).join(raw.select(*keys, F.col("text").alias("raw")), keys, "left")
    # The lines are cut and stripped once for the three checks that need them.
    by_line = let(stripped_lines(F.col("clean")), lambda x: F.struct(orphan_numbers(x).alias("orphan"), dangling_lines(x).alias("dangling"), repeated_lines(x).alias("repeated")))
    both = both.withColumn("by_line", by_line)
    there = F.col("raw").isNotNull()
    checks = both.withColumn("patterns", markdown_residue(F.col("clean"))).select(
        *keys,
        F.when(there, "checked").otherwise("no source").alias("status"),
        F.when(there, residue_total(F.col("patterns"))).alias("md_residue"),
        F.when(there, F.col("by_line.orphan")).alias("orphan_numbers"),
        F.when(there, F.col("by_line.dangling")).alias("dangling_lines"),
        F.when(there, F.col("by_line.repeated")).alias("repeated_lines"),
        F.when(there, word_ratio(F.col("clean"), F.col("raw"))).alias("word_ratio"),
        *([F.when(there, shown(F.col("patterns"))).alias("residue")] if found else []),
    )
    bad = [F.col(c) != 0 for c in ("md_residue", "orphan_numbers", "dangling_lines", "repeated_lines")] + [~F.col("word_ratio").between(RATIO_MIN, RATIO_MAX)]
    return checks.withColumn("flags", sum((F.coalesce(b, F.lit(False)).cast("long") for b in bad), F.lit(0).cast("long")))


#: What must survive cleaning: numbers, names of a program, and acronyms.
FACTS = r"[0-9]+(?:[.,:][0-9]+)*|[A-Za-z][A-Za-z0-9]*(?:(?:_|::)[A-Za-z0-9]+)+|[A-Z][A-Z]+"


def unfaithful(raw: DataFrame, clean: DataFrame, keys: list[str], said=None) -> DataFrame:
    """keys, fact, in_raw, in_clean: the facts that a section of raw has more often than that of clean, or less often. Both have a
    row a section (keys, text); a section that only one side has is compared with an empty one.

    said: how a fact may be said in clean instead, as a column of it. Such mentions count as the fact, where clean lacks it."""

    def facts(side: DataFrame, name: str, other: str) -> DataFrame:
        own = side.select(*keys, F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(FACTS), F.lit(0))).alias("fact"))
        return own.groupBy(*keys, "fact").agg(F.count("*").alias(name)).withColumn(other, F.lit(0).cast("long"))

    both = facts(raw, "in_raw", "in_clean").unionByName(facts(clean, "in_clean", "in_raw"))
    out = both.groupBy(*keys, "fact").agg(F.sum("in_raw").alias("in_raw"), F.sum("in_clean").alias("in_clean")).filter("in_raw <> in_clean")
    if said is None:
        return out
    texts = clean.groupBy(*keys).agg(F.concat_ws("\n", F.collect_list("text")).alias("text"))
    spoken = out.join(texts, keys, "left").withColumn("said", said(F.col("fact")))
    # Words between blanks or signs; a fact that is said as itself has no other way.
    times = F.when((F.col("said") != F.col("fact")) & F.col("text").isNotNull(), F.size(F.split(F.concat(F.lit(" "), F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}_:]+", "  "), F.lit(" ")), F.concat(F.lit(" \\Q"), F.regexp_replace(F.lower("said"), " ", "  "), F.lit("\\E ")), -1)) - 1)
    found = spoken.withColumn("in_clean", F.when(F.col("in_raw") > F.col("in_clean"), F.least("in_raw", F.col("in_clean") + F.coalesce(times, F.lit(0)))).otherwise(F.col("in_clean")))
    return found.filter("in_raw <> in_clean").select(*keys, "fact", "in_raw", "in_clean")


def summary(checked: DataFrame, strict: bool = True) -> DataFrame:
    """Files, flags and the exit code: 1 without files, and 1 when strict and anything is flagged."""
    out = checked.agg(F.count("*").alias("files"), F.coalesce(F.sum("flags"), F.lit(0)).cast("long").alias("flags"))
    failed = (F.col("files") == 0) | ((F.col("flags") > 0) & F.lit(strict))
    return out.withColumn("exit_code", failed.cast("int"))
