"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes what its predecessor kept, and its decisions take effect: the quality
classifier drops the documents that it rejects, line dedup drops repeated lines, the
Jaccard join keeps one document of each group, decontamination drops the documents that
hold a benchmark item, and packing places the token pieces of the rest. All but the last
return the columns of documents; n_chars follows the text.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.llm import decontam, jaccard_join, line_dedup, quality
from inkloom.llm.common import forget, materialize, written
from inkloom.llm.queries import packed_documents, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose score is at least the threshold; learnt from labels of the documents that came in. Null and
    empty texts are scored too; null ids go; other columns of any names are carried."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    carried = {c: f"__{i}" for i, c in enumerate(docs.columns) if c != "doc_id"}
    named = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(n) for c, n in carried.items()])
    kept = quality.score_quality(named, model, *carried.values()).filter(F.col("score") >= quality.THRESHOLD)
    return kept.select(*[F.col(carried.get(c, "doc_id")).alias(c) for c in docs.columns])


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines that at least three of them have, but for the largest doc_id of each. Rows that
    repeat a doc_id are one document; null ids go; a text that loses all its lines is empty."""
    out = line_dedup.drop_repeated_lines(docs, line_dedup.build_index(docs), indexed=True)
    return out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: of the smallest doc_id. Texts without words are all kept."""
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item; without items, all of them. A repeated doc_id is judged by each row's text."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document with their places; a null or empty text is its end mark alone, and repeated rows are documents of their own."""
    return packed_documents(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing_stage),
]

#: The classifier and the packer have no SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage is stored and read again; what it stored on its way is removed then."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = written()
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        forget(spark, before, 1)
    return STAGES[-1][1](spark, docs, sf_dir)
