"""What each of several filters does to a corpus, in every order in which they can run.

A document's failures are a mask with a bit for each filter. Four filters look at the text
alone. The fifth, that an earlier document has the same text, is found by sorting: rows are
range-sorted by fingerprint, and within a range by fingerprint, full text and doc_id, so that
equal texts are neighbours and each row compares its text with its predecessor's. Ranges are
cut by fingerprint and doc_id, so that a text of very many copies is spread over ranges; a
range's first and last texts are compared with those of other ranges, and what continues
there is judged by the smallest doc_id of all.

Masks are counted by part, additively: counters of several tables, or of shards of one, can
be summed before the report. All the orders are read off the counters, 32 numbers a part.
"""

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.llm.common import UPPER, limit_batches, materialize, shards_for

FILTERS = "ABCDE"
#: Least words; least distinct words and most capitals, in percent; signs that no text may have.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 50, 65, 5, "[#$%&*|]"


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: too few words, too few distinct ones, too many capitals, a forbidden sign."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return F.get(F.transform(F.array(words), lambda w: sum(
        (F.when(fails, 1 << bit).otherwise(0) for bit, fails in enumerate([
            F.size(w) < LEAST_WORDS,
            100 * F.size(F.array_distinct(w)).cast("long") < LEAST_DISTINCT * F.size(w).cast("long"),
            100 * capitals.cast("long") > MOST_CAPITALS * F.length(text).cast("long"),
            text.rlike(SIGNS),
        ])), F.lit(0))), F.lit(0))


SORTED = "doc_id bigint, part string, mask int, range bigint, text_no bigint, fp bigint, edge string"


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, part, mask, fp, text) in the order of fp, text, doc_id, as SORTED: with bit 4 where the range has the text
    under a smaller doc_id, and the number of the text in the range. After them come the texts of the range's first and of its
    last fingerprint, as edge, under their smallest doc_id."""
    here, bit = TaskContext.get().partitionId(), 1 << FILTERS.index("E")
    number, last, first_id = -1, None, None  # of the text that the last row had, its (fp, text), its smallest doc_id
    edges: list[tuple[int, int, str, int | None]] = []  # number, fp, text, doc_id of the first fingerprint
    recent: list[tuple[int, int, str, int | None]] = []  # and of the latest
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        fp, text, ids = (batch.column(batch.schema.get_field_index(c)) for c in ("fp", "text", "doc_id"))
        same = pc.and_(pc.equal(fp[1:], fp[:-1]), pc.equal(text[1:], text[:-1])).to_pylist()
        same.insert(0, last is not None and last == (fp[0].as_py(), text[0].as_py()))
        doc_ids, fails, numbers = ids.to_pylist(), [], []
        for k, doc_id in enumerate(doc_ids):
            if not same[k]:
                number, first_id = number + 1, doc_id
                own = (number, fp[k].as_py(), text[k].as_py(), doc_id)
                if not recent or recent[0][1] != own[1]:
                    edges, recent = edges or recent, []
                recent.append(own)
                last = own[1:3]
            fails.append(bit if doc_id is not None and first_id is not None and first_id < doc_id else 0)
            numbers.append(number)
        mask = pc.bit_wise_or(batch.column(batch.schema.get_field_index("mask")), pa.array(fails, pa.int32()))
        columns = [ids, batch.column(batch.schema.get_field_index("part")), mask, pa.array([here] * n, pa.int64()), pa.array(numbers, pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, fp, pa.nulls(n, pa.string())], names=EDGE_SCHEMA.names)
    for number, fingerprint, text, doc_id in dict.fromkeys(edges + recent):
        yield pa.RecordBatch.from_pylist([{"doc_id": doc_id, "range": here, "text_no": number, "fp": fingerprint, "edge": text}], EDGE_SCHEMA)


EDGE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("range", pa.int64()), ("text_no", pa.int64()), ("fp", pa.int64()), ("edge", pa.string())])


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask of every row of docs (doc_id, text, source). A null text is empty, a null source the part ''.
    Rows alike in doc_id and text do not fail by each other; a row without doc_id is a document too, which neither fails E nor
    makes others fail it. An empty table gives an empty result."""
    limit_batches(docs.sparkSession)
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["source"].cast("string"), F.lit("")).alias("part"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    ).withColumn("fp", F.xxhash64("text"))
    # Only fingerprints and doc_ids are sampled for the ranges, never texts; texts part the few that share a fingerprint.
    ranged = rows.repartitionByRange(shards_for(docs), "fp", F.col("doc_id").asc_nulls_last()).sortWithinPartitions("fp", "text", F.col("doc_id").asc_nulls_last())
    masked = ranged.select("doc_id", "part", text_mask(F.col("text")).cast("int").alias("mask"), "fp", "text")
    stored = materialize(masked.mapInArrow(compared, SORTED), "sorted-masks")

    # A text at the edges of several ranges. Its list has a place for each range at most, and its texts meet map side first.
    edges = stored.filter("edge IS NOT NULL").groupBy("fp", "edge")
    shared = edges.agg(F.min("doc_id").alias("first_id"), F.collect_list(F.struct("range", "text_no")).alias("places")).filter(F.size("places") > 1)
    shared = shared.select("first_id", F.inline("places"))  # two rows a range at most, but for texts that share a fingerprint
    bit = 1 << FILTERS.index("E")
    late = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    out = stored.filter("edge IS NULL").join(F.broadcast(shared), ["range", "text_no"], "left")
    return out.select("doc_id", "part", F.col("mask").bitwiseOR(F.when(late, bit).otherwise(0)).alias("mask"))


def counters(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: how many documents have a mask, and how many of them labels (doc_id, quality, toxic) mark. A
    document is good, or toxic, where any row of its doc_id says so. Summed by part and mask, counters of several tables add up."""
    named = labels.groupBy(labels["doc_id"].cast("long").alias("doc_id")).agg(
        F.coalesce(F.max((labels["quality"] == 1).cast("long")), F.lit(0)).alias("good"), F.coalesce(F.max((labels["toxic"] == 1).cast("long")), F.lit(0)).alias("toxic")
    )
    of_labels = masks.filter("doc_id IS NOT NULL").join(named.filter("good + toxic > 0"), "doc_id").select("part", "mask", F.lit(0).cast("long").alias("n"), "good", "toxic")
    zero = F.lit(0).cast("long")
    every = masks.select("part", "mask", F.lit(1).cast("long").alias("n"), zero.alias("good"), zero.alias("toxic"))
    return summed(every.unionByName(of_labels))


def summed(some: DataFrame) -> DataFrame:
    return some.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def report(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row for each part, order of the filters and step, from counters."""
    steps = [(order, step + 1, 1 << filters.index(order[step]), sum(1 << filters.index(f) for f in order[:step])) for order in map("".join, permutations(filters)) for step in range(len(filters))]
    orders = len(steps) // len(filters)
    names, numbers, bits, befores = (F.lit(list(x)) for x in zip(*steps, strict=True))
    rows = F.arrays_zip(names.alias("filter_order"), numbers.alias("step"), bits.alias("bit"), befores.alias("before"))
    by_part = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 32 of them at most
    own = by_part.select("part", "masks", F.inline(rows).alias("filter_order", "step", "bit", "before"))

    def total(column: str, holds) -> Column:
        return F.aggregate(F.filter("masks", lambda m: holds(m["mask"])), F.lit(0).cast("long"), lambda a, m: a + m[column])

    bit, before = F.col("bit"), F.col("before")
    fails, gone = (lambda m: m.bitwiseAND(bit) != 0), (lambda m: m.bitwiseAND(before) != 0)
    removed = lambda m: fails(m) & ~gone(m)
    # Of the filters that a document fails, each comes first in as many orders.
    share = F.aggregate(F.filter("masks", lambda m: fails(m["mask"])), F.lit(0).cast("long"), lambda a, m: a + m["n"] * (F.lit(orders) / F.bit_count(m["mask"])).cast("long"))
    return own.select(
        "part", "filter_order", "step",
        total("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"), total("n", removed).alias("removed"), total("n", lambda m: fails(m) & gone(m)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"), total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"), share.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """report of docs (doc_id, text, source) and labels (doc_id, quality, toxic); nulls and repeats as failures and counters say."""
    return report(materialize(counters(failures(docs), labels), "filter-counters"))
