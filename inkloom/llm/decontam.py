"""Benchmark decontamination by SimHash windows, with DataFrame functions only.

Each benchmark item has a weighted set of shingles: five words each, weighted by how often
they occur. A window of a document is as long as an item. For each length that items have, every window is formed, whatever
its start, in which so many places hold a shingle of some item of that length that it can reach the similarity
with one; with fewer it cannot. Windows know no item. They and the items get 64-bit SimHash fingerprints and are met by multi-index
blocks: of RADIUS + 1 blocks of bits at least one is equal in any two fingerprints within
RADIUS, so the join misses none of those. Similar windows beyond the radius, as one with a shingle of great weight may be,
are the fallback's: it pairs windows with the items whose shingles they share, where the index has not. So RADIUS sets the
work of the index, never the result. All pairs are verified exactly: the sum of the smaller weights
by the sum of the larger ones, over the shingles of both.

Most places of most documents hold no shingle of any item. They are told by a bitmap of the items'
shingles within the row, so that only the others become rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.llm.common import LOWER, UPPER, documents, materialize, with_row_hash

WORDS = 5
SIMILARITY = 0.8
#: Eight blocks of eight bits, so that a block parts the items of one length into 256. At similarity 0.8 the expected distance is below 12.
RADIUS = 7
#: Shingles of all items up to which their table is broadcast; beyond, it is joined by shuffle.
BROADCAST_SHINGLES = 1_000_000
#: Bits of the bitmap for each shingle, and bits of it at most (512 KB): beyond, it lets more through.
BITS_EACH, MOST_BITS = 16, 1 << 22


def let(value: Column, body) -> Column:
    """body(value) with value computed once, however often body names it and whatever the optimizer inlines."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    spaced = F.translate(text, UPPER + "\t\n\x0b\x0c\r", LOWER + "     ")
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def shingles(w: Column) -> Column:
    """Hashes of runs of WORDS words, in order; of all words where there are fewer; none without words."""
    return let(w, shingles_of)


def shingles_of(w: Column) -> Column:
    n = F.size(w)
    long = F.transform(F.sequence(F.lit(1), n - (WORDS - 1)), lambda i: F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(WORDS)]))
    return F.when(n >= WORDS, long).when(n > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))


def fingerprint(own: Column) -> Column:
    """64-bit SimHash of an array of hashes; a shingle counts as often as it is there."""
    none = F.lit(0).cast("long")
    votes = lambda b: F.size(F.filter(own, lambda h: F.call_function("shiftright", h, b).bitwiseAND(F.lit(1)) == 1))
    bit = lambda b: F.when(2 * votes(b) > F.size(own), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(none)
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(63)), bit), none, lambda acc, x: acc.bitwiseOR(x))


def blocks(print_: Column, radius: int) -> Column:
    """radius + 1 blocks of bits that make up the fingerprint, each with its number."""
    n = radius + 1
    cuts = [64 * k // n for k in range(n + 1)]
    return F.array(*[F.struct(F.lit(k).alias("no"), F.shiftrightunsigned(print_, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("bits")) for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False))])


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item_id, n_words, own (shingle hashes in order, repeated ones too); items without words are left out."""
    text = F.coalesce(benchmark["text"].cast("string"), F.lit(""))
    w = benchmark.filter(benchmark["item_id"].isNotNull()).select("item_id", words(text).alias("w"))
    return w.select("item_id", F.size("w").alias("n_words"), shingles(F.col("w")).alias("own")).filter("n_words > 0")


def bitmap(items: DataFrame, total: int) -> tuple[Column, int]:
    """A constant array of words of 64 bits, the bits of the items' shingles set, and the number of words: MOST_BITS / 64 at most."""
    n = 1
    while 64 * n < min(MOST_BITS, max(1, total) * BITS_EACH):
        n *= 2
    h = items.select(F.explode(F.array_distinct("own")).alias("h"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(F.lit(63)).cast("int"))
    set_ = h.groupBy(word_of(F.col("h"), n).cast("long").alias("id")).agg(F.bit_or(bit).alias("bits"))
    every = items.sparkSession.range(n).join(F.broadcast(set_), "id", "left").select(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("w"))
    row = every.agg(F.transform(F.sort_array(F.collect_list("w")), lambda w: w["bits"]).alias("words"))
    # One literal that the optimizer turns into an array, not a literal a word.
    return F.split(F.lit(",".join(map(str, row.first()["words"]))), ",").cast("array<bigint>"), n


def word_of(h: Column, n: int) -> Column:
    return F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(n - 1)).cast("int")


def maybe_in(bits: Column, n: int, h: Column) -> Column:
    return F.call_function("shiftrightunsigned", F.get(bits, word_of(h, n)), h.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """doc_id, row_hash, item_id, similarity, start (word), n_words: the best window of each document
    (doc_id, text) for each benchmark item (item_id, text) that it holds at `similarity` or more; of
    equal ones the first.

    A document shorter than an item is one window. An item of one to four words is found only in a
    document that consists of just those words, as in the SQL. Null, empty and blank texts match nothing, nor do
    items of that kind or with a null id; items that repeat an item_id are items of their own under one
    name. Empty tables give an empty result.
    """
    items = benchmark_items(benchmark).withColumn("item", F.monotonically_increasing_id())
    items = materialize(items.withColumn("item_print", fingerprint(F.col("own"))), "items")
    total = items.agg(F.sum(F.size("own")).alias("n")).first()["n"] or 0
    small = F.broadcast if total <= BROADCAST_SHINGLES else (lambda x: x)
    bits, n_words = bitmap(items, total)

    d = with_row_hash(documents(docs)).select("doc_id", "row_hash", words(F.col("text")).alias("w"))
    d = d.select("doc_id", "row_hash", F.size("w").alias("size"), shingles(F.col("w")).alias("own"))
    d = d.withColumn("places", F.filter(F.transform(F.col("own"), lambda h, p: F.when(maybe_in(bits, n_words, h), p).otherwise(-1)), lambda p: p >= 0))
    windows = materialize(candidates(d, items, similarity, small).withColumn("print", fingerprint(F.col("own"))), "windows")
    pairs = by_index(windows, items, radius, small).unionByName(by_shingles(windows, items, similarity, radius, small))
    return best_windows(pairs, similarity)


KEY = ["doc_id", "row_hash", "n_words", "start"]


def by_index(windows: DataFrame, items: DataFrame, radius: int, small) -> DataFrame:
    """KEY, item, item_id, own, item_own: windows and items of one length whose fingerprints are within the radius, through a block that both have."""
    left = windows.withColumn("block", F.explode(blocks(F.col("print"), radius)))
    right = items.select("item", "item_id", "n_words", F.col("own").alias("item_own"), "item_print").withColumn("block", F.explode(blocks(F.col("item_print"), radius)))
    near = left.join(small(right), ["n_words", "block"]).filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
    return near.select(*KEY, "item", "item_id", "own", "item_own").dropDuplicates([*KEY, "item"])


def by_shingles(windows: DataFrame, items: DataFrame, similarity: float, radius: int, small) -> DataFrame:
    """The same for pairs beyond the radius: windows and items of one length that share shingles, so many as the similarity takes where an item has none twice."""
    once = F.size(F.array_distinct("own")) == F.size("own")
    right = items.select("item", "n_words", once.alias("once"), F.size("own").alias("m"), "item_print", F.explode(F.array_distinct("own")).alias("h"))
    met = windows.select(*KEY, "print", F.size("own").alias("n"), F.explode(F.array_distinct("own")).alias("h")).join(small(right), ["n_words", "h"])
    met = met.filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) > radius)
    least = F.when(F.col("once"), F.ceil(similarity / (1 + similarity) * (F.col("m") + F.col("n")) - 1e-9)).otherwise(1)
    far = met.groupBy(*KEY, "item").agg(F.count("*").alias("both"), F.min(least).alias("least")).filter("both >= least").select(*KEY, "item")
    own = far.join(windows.select(*KEY, "own"), KEY)
    return own.join(small(items.select("item", "item_id", F.col("own").alias("item_own"))), "item").select(*KEY, "item", "item_id", "own", "item_own")


def candidates(d: DataFrame, items: DataFrame, similarity: float, small) -> DataFrame:
    """KEY, own: each window once that can reach the similarity with some item of its length, for all that its places say.

    A window of n shingles and an item of m must share similarity / (1 + similarity) * (n + m) of them
    at least. Windows are gathered by the stretch of m shingles that they start in; each has what
    it takes to form them.
    """
    at = items.select(F.explode(F.array_distinct("own")).alias("h"), "n_words", F.size("own").alias("m")).distinct()
    # An inner explode would have the optimizer test the array in a filter of its own, and compute all of it twice.
    hits = d.select("doc_id", "row_hash", "size", "own", F.explode_outer("places").alias("p"))
    hits = hits.withColumn("h", F.get("own", F.col("p"))).join(small(at), "h")
    need = F.ceil(similarity / (1 + similarity) * (F.least("m", F.size("own")) + F.col("m")) - 1e-9).cast("int")
    last = F.greatest(F.lit(0), F.col("size") - F.col("n_words"))
    hits = hits.withColumns({"need": F.greatest(F.lit(1), need), "last": last, "stretch": F.floor(F.col("p") / F.col("m")).cast("int")})
    hits = hits.withColumn("stretch", F.explode(F.array_distinct(F.array("stretch", F.greatest(F.lit(0), F.col("stretch") - 1)))))
    key = ["doc_id", "row_hash", "n_words", "m", "stretch", "need", "last"]
    part = F.slice("own", F.col("stretch") * F.col("m") + 1, 2 * F.col("m"))
    found = hits.select(*key, "p", part.alias("part")).groupBy(*key).agg(F.sort_array(F.collect_set("p")).alias("ps"), F.first("part").alias("part"))
    low = lambda i: F.greatest(F.col("stretch") * F.col("m"), F.get("ps", i + F.col("need") - 1) - F.col("m") + 1)
    high = lambda i: F.least((F.col("stretch") + 1) * F.col("m") - 1, F.get("ps", i), F.col("last"))
    between = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    starts = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.size("ps") - F.col("need")), lambda i: between(low(i), high(i)))))
    found = found.filter(F.size("ps") >= F.col("need")).withColumn("start", F.explode(starts))
    return found.select(*KEY, F.slice("part", F.col("start") - F.col("stretch") * F.col("m") + 1, F.col("m")).alias("own"))


def counted(own: Column, h: Column) -> Column:
    return F.size(F.filter(own, lambda x: x == h))


def shared(own: Column, item_own: Column) -> Column:
    """The sum of the smaller weights."""
    weights = F.transform(F.array_intersect(own, item_own), lambda h: F.least(counted(own, h), counted(item_own, h)))
    once = F.size(F.array_distinct(item_own)) == F.size(item_own)
    return F.when(once, F.size(F.array_intersect(own, item_own))).otherwise(F.aggregate(weights, F.lit(0), lambda a, x: a + x))


def best_windows(near: DataFrame, similarity: float) -> DataFrame:
    both, total = F.col("both"), F.size("own") + F.size("item_own")
    verified = near.withColumn("both", shared(F.col("own"), F.col("item_own"))).withColumn("similarity", both / (total - both)).filter(F.col("similarity") >= similarity)
    best = verified.groupBy("doc_id", "row_hash", "item_id").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "start", "n_words")).alias("best"))
    return best.select("doc_id", "row_hash", "item_id", (-F.col("best.s")).alias("similarity"), F.col("best.start").cast("long").alias("start"), F.col("best.n_words").cast("long").alias("n_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without those that hold a benchmark item; a null doc_id cannot be named and goes. Columns
    of any names are carried. Without items or documents, the rows as they are."""
    found = contaminated(docs, benchmark).select("doc_id", "row_hash").distinct()
    d = docs.filter(docs["doc_id"].isNotNull())
    d = d.select(F.struct(*[d[c] for c in d.columns]).alias("carried"), d["doc_id"].cast("long").alias("doc_id"), F.xxhash64(F.coalesce(d["text"].cast("string"), F.lit(""))).alias("row_hash"))
    return d.join(found.hint("merge"), ["doc_id", "row_hash"], "left_anti").select("carried.*")
