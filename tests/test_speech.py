"""Blocks, numbers, names and faithfulness: narration beyond single patterns."""

import random
import re
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from inkloom.functions import blocks, speech
from inkloom.operators import qa, sections
from inkloom.plans import catalogue

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def column(spark, values, c):
    df = spark.createDataFrame(list(enumerate(values)), "id int, t string").coalesce(1)
    return [r[0] for r in df.orderBy("id").select(c).collect()]


NARRATED = [
    ("infer-\nence", "inference."),
    ("## 5.1 Quantization", "Now: section five point one, Quantization."),
    ("### 12.20.100 Deep", "Now: section twelve point twenty point one hundred, Deep."),
    ("## Overview", "Now: Overview."),
    ("The LSM tree, an LSM [3] of (2024).", "The log-structured merge tree, an L S M of ."),
    ("L0 to Lmax, e.g. by Get() -> SST on a CPU", "level zero to level max, for example by get leads to ess ess tee on a CPU."),
    ("See Fig. 3 and **bold** `code`.\n\n17\n\nEnd", "See figure three and bold code.\n\nEnd."),
    ("IO and I/O, IOPS of GetX; a write_buffer", "I O and I O, I O P S of GetX; a write_buffer."),
]

PAGE = """# Title
Some text.
More text.

- one
* two
1. three

| a | b |
|---|:-:|
| 1 | 2 |
> said
> so
```python
x = 1

# not a heading
```
```
| not | a table |
```
Figure 3: The tree grows.
![An image](x.png)
Fig. 4
$$
a = b

$$
$$ c = d $$
E = m * c + 1
open
```
- to the end
"""


def test_typed_blocks(spark):
    got = [(b.kind, b.first, b.last) for b in blocks.typed_blocks(PAGE)]
    assert got == [
        ("heading", 0, 0), ("text", 1, 2), ("list", 4, 6), ("table", 8, 10), ("quote", 11, 12), ("code", 13, 17), ("code", 18, 20), ("figure", 21, 21), ("figure", 22, 22),
        ("figure", 23, 23), ("equation", 24, 27), ("equation", 28, 29), ("text", 30, 30), ("code", 31, 33),
    ]
    lines = PAGE.split("\n")
    assert all(b.text == "\n".join(lines[b.first : b.last + 1]) for b in blocks.typed_blocks(PAGE))
    rows = blocks.explode_blocks(spark.createDataFrame([(1, PAGE), (2, None), (3, " \n\t")], "id int, text string"), ["id"])
    shown = {r["block"]: r["t"] for r in rows.withColumn("t", blocks.without_markdown(F.col("kind"), F.col("text"))).collect()}
    assert rows.filter("id > 1").isEmpty() and len(shown) == 14
    assert shown == {
        0: "Title", 1: "Some text.\nMore text.", 2: "one\ntwo\n1. three", 3: "a, b\n1, 2", 4: "said\nso", 5: "x = 1\n\n# not a heading\n", 6: "| not | a table |\n",
        7: "The figure shows the tree grows.", 8: "The figure shows an image", 9: "", 10: "a = b", 11: "c = d \nE = m * c + 1", 12: "open", 13: "- to the end\n",
    }


def test_prompts_by_kind(spark):
    parts = spark.createDataFrame([(1, 0, "x\n\n| a |\n"), (1, 1, "plain"), (2, 0, PAGE), (2, 1, None)], "doc int, sec int, text string")
    got = {(r["doc"], r["sec"]): r["prompt"] for r in blocks.section_prompts(parts, ["doc", "sec"], F.lit("P")).collect()}
    assert got == {(1, 0): "P\n\n" + blocks.ASKED["table"], (1, 1): "P", (2, 0): "\n\n".join(["P", *blocks.ASKED.values()]), (2, 1): "P"}


def plain_integer(n):
    """Another way to the same words: by recursion over the value."""
    if n < 100:
        return speech.number_word(n)
    for size, name in ((10**12, "trillion"), (10**9, "billion"), (10**6, "million"), (1000, "thousand"), (100, "hundred")):
        if n >= size:
            return f"{plain_integer(n // size)} {name}" + (f" {plain_integer(n % size)}" if n % size else "")


def test_numbers(spark):
    r = random.Random(1)
    numbers = [*range(130), 150, 200, 999, 1000, 1001, 1100, 2024, 10_000, 10**6, 10**6 + 1, 10**9, 10**12, 10**15 - 1] + [r.randrange(10 ** r.randint(3, 15)) for _ in range(200)]
    assert column(spark, list(map(str, numbers)), speech.integer_words(F.col("t"))) == [plain_integer(n) for n in numbers]
    assert plain_integer(150) == "one hundred fifty" and plain_integer(2024) == "two thousand twenty four"
    said = {
        "007 and 1234567890123456": "zero zero seven and one two three four five six seven eight nine zero one two three four five six",
        "In 2024, 150 of 1,024.": "In two thousand twenty four, one hundred fifty of one thousand twenty four.",
        "3.14, 3 x 4, 3x4 and 2 × 10": "three point one four, three times four, three times four and two times ten",
        "v1.2.3 10.0.0.1 5GB x4 12:30 1-2 a_1 (7)": "v1.2.3 10.0.0.1 5GB x4 12:30 1-2 a_1 (seven)",
        "": "",
    }
    assert column(spark, said, speech.spoken_numbers(F.col("t"))) == list(said.values())
    sums = {"x^2 + y": "x squared plus y", "(512 + 51) / 500 = 1.14": "(five hundred twelve plus fifty one) divided by five hundred equals one point one four", "a - b*c": "a minus b times c"}
    assert column(spark, sums, speech.spoken_equation(F.col("t"))) == list(sums.values())


def test_names_stay(spark):
    said = {
        "Use DB::Get and rocksdb::NewLRUCache": "Use DB::Get and rocksdb::NewLRUCache",
        "Get, Get() and DB on a CPU": "get, get and database on a CPU",
        "write_buffer_size, my_DB, db_bench, sst_dump": "write_buffer_size, my_DB, d b bench, ess ess tee dump",
        "GPU RAM SSD IO": "GPU RAM SSD I O",
    }
    assert column(spark, said, speech.spelled(F.col("t"))) == list(said.values())


def test_narration_drops_markdown(spark):
    said = {
        "- item\n* one\n+ two": "item\none\ntwo.",
        "> quote": "quote.",
        "| a | b |\n|---|---|\n| 1 | 2 |": "a, b\n1, 2.",
        "a | b |\n---|---|\nc | d": "a, b\nc, d.",
        "3 x 4 is not 3x": "3 times 4 is not 3x.",
        "## 150.2024 T": "Now: section one hundred fifty point two thousand twenty four, T.",
    }
    assert column(spark, said, speech.narration(F.col("t"))) == list(said.values())
    assert column(spark, [t for t, _ in NARRATED], speech.narration(F.col("t"))) == [s for _, s in NARRATED]


def test_names_are_gone_through_once(spark):
    """A name of many parts that ends within a word: it was tried from each of its parts, which took this one over a minute."""
    name = "a" + "_" * 60_000 + "é"
    begin = time.monotonic()
    assert column(spark, ["Get " + name], speech.spelled(F.col("t"))) == ["get " + name]
    assert time.monotonic() - begin < 10


def test_rules_that_are_passed_by_change_nothing(spark, monkeypatch):
    """Texts made of what rules look for, whole and in part: passing rules by where their signs are missing gives what they give."""
    r = random.Random(4)
    parts = ["infer-\nence", "[3]", "[3, 4]", "(2024)", "(1924)", "<sup>2</sup>", "[a](b)", "[", "](", ")", "**", "`", "<u>", "</u>", "u>", "# ", "### 5.1 T", "## 7. ", "#", "---", "|---|:--|", "> ", "- ", "* ", "+ ", "|", " | ",
        "3 x 4", "2x2", "1.x 3", "x", "Fig. 3", "Fig.", "e.g.", "->", "LSM", "LSMs", "Get", "Get()", "Get(", "IOPS", "I/O", "db_bench", "a::b", "a::bé", "a_", "a_b_", "_a", "a_bé", "CPU", "éDB", "DBé", "fio", "http://a.b/c.", "HTTPS://x",
        "HtTp", "https", "://", "é", "\u3000", "\xa0 ", "\x1c\x1d", "\t", " ", "  ", "\n", "\n\n", "word", "."]
    texts = ["", None, *parts, *("".join(r.choice(parts) + r.choice(["", "", " ", "\n"]) for _ in range(r.randint(2, 12))) for _ in range(1500))]
    rules = [speech.narration, speech.spelled, speech.verbalize_urls]
    got = [column(spark, texts, f(F.col("t"))) for f in rules]
    monkeypatch.setattr(speech, "where", lambda c, test, body: body(c))
    old = r"\b\w+(?:::\w+)+\b|\b[A-Za-z]\w*_\w+\b|\b(?:GPU|CPU|RAM|SSD)\b"
    monkeypatch.setattr(speech, "NAMES", f"({old})")
    assert got == [column(spark, texts, f(F.col("t"))) for f in rules]


def test_unfaithful(spark):
    raw = spark.createDataFrame([(1, 0, "In 2024 it was 3.14 or 42, by DB::Get, 42."), (1, 1, "7 GPUs, CPU"), (2, 0, "8")], "doc int, sec int, text string")
    clean = spark.createDataFrame([(1, 0, "In two thousand twenty four it was 3.14 or Forty two, by DB::Get."), (1, 1, "7 GPUs, CPU and RAM")], "doc int, sec int, text string")
    got = sorted(map(tuple, qa.unfaithful(raw, clean, ["doc", "sec"]).collect()))
    assert got == [(1, 0, "2024", 1, 0), (1, 0, "42", 2, 0), (1, 1, "RAM", 0, 1), (2, 0, "8", 1, 0)]
    spoken = sorted(map(tuple, qa.unfaithful(raw, clean, ["doc", "sec"], speech.spoken_numbers).collect()))
    assert spoken == [(1, 0, "42", 2, 1), (1, 1, "RAM", 0, 1), (2, 0, "8", 1, 0)]


def test_a_splitter_as_table_function(spark):
    """The split at headings by Python equals the column; other columns are kept."""
    docs = catalogue.with_headings(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", "text"))
    got = sections.split_by(docs, lambda t: re.split(r"(?m)^(?=#{2,3} )", t))
    want = docs.select("doc_id", "lang", F.posexplode(sections.split_sections(F.col("text"), "blog")).alias("sec_idx", "section"))
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    none = spark.createDataFrame([(1, None), (2, " ")], "doc_id int, text string")
    assert sections.split_by(none, lambda t: [t]).collect() == []


@pytest.mark.parametrize("text", ["", "\n", "```", "$$\n```\n$$\n```", "# a\n# b\n\n# c", "|a|\n\n|b|"])
def test_every_line_that_is_not_blank_is_in_one_block(text):
    lines, seen = text.split("\n"), [n for b in blocks.typed_blocks(text) for n in range(b.first, b.last + 1)]
    assert seen == sorted(set(seen)) and {k for k, x in enumerate(lines) if x.strip()} <= set(seen)
