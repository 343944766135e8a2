"""Documents from and to files, and pages from the network."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.functions.text import LINE_END, strip
from inkloom.sources.sink import write_files


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*\z", "")


def read_texts(spark: SparkSession, path: str, suffix: str = ".md") -> DataFrame:
    """name, stem, text of the files of one folder; each file is one row. Bytes that are no UTF-8 are an error."""
    found = spark.read.text(path, wholetext=True, pathGlobFilter=f"*{suffix}")
    name = F.col("_metadata.file_name")
    return found.select(name.alias("name"), stem(name).alias("stem"), F.validate_utf8("value").alias("text"))


def read_binaries(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return found.select(name.alias("name"), stem(name).alias("stem"), F.col("content").alias("data"))


def with_needle(rows: DataFrame, needle: str | None, column: str = "stem") -> DataFrame:
    """The rows whose stem (or url) contains needle, a literal and case-sensitive part; all of them without one."""
    return rows if needle is None else rows.filter(F.contains(column, F.lit(needle)))


def wiki_url(base: Column | str, page: Column) -> Column:
    base = F.lit(base) if isinstance(base, str) else base
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), page, F.lit(".md"))


def title_of(title: Column, name: Column) -> Column:
    """The first line of a title file that is not blank; the name where there is none."""
    first = strip(F.split(strip(F.coalesce(title, F.lit(""))), LINE_END, 2)[0])
    return F.when(first == "", name).otherwise(first)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"\A[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/?#]*)", 1))


def fetch(urls: DataFrame, get: Callable[[str], str], per_host: int = 2) -> DataFrame:
    """urls (url, …) with body and error. get is called once a row; a page that fails is a row with an error.

    No host has more than per_host requests at a time: its pages are dealt to so many slots, and a slot is in one
    task, which asks for one page after the other. Hosts are asked side by side. (A task run twice at a time, by speculation, is beyond that.)"""
    if per_host < 1:
        raise ValueError(f"a host needs a request at a time at least: {per_host}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bodies, errors = [], []
            for url in batch["url"]:
                try:
                    bodies.append(get(url)), errors.append(None)
                except Exception as e:
                    bodies.append(None), errors.append(str(e))
            yield batch.assign(body=bodies, error=errors)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema)
    dealt = urls.repartition(host(F.col("url")), F.pmod(F.xxhash64("url"), F.lit(per_host)))
    return dealt.mapInPandas(run, f"{fields}, body string, error string")


def http_get(timeout: int = 600) -> Callable[[str], str]:
    import urllib.request

    def get(url: str) -> str:
        with urllib.request.urlopen(url, timeout=timeout) as answer:
            return answer.read().decode()

    return get


def pdf_to_markdown(files: DataFrame, convert: Callable[[bytes], str]) -> DataFrame:
    """files (stem, data) -> stem, text; the converter is given, none is part of this package."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"stem": batch["stem"], "text": batch["data"].map(convert)})

    return files.select("stem", "data").mapInPandas(run, "stem string, text string")


def raw_text(md: Column) -> Column:
    """What is written of raw Markdown: one line feed more."""
    return F.concat(md, F.lit("\n"))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a store that Spark reads has path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_texts(docs: DataFrame, path: str, suffix: str = ".txt") -> None:
    """docs (stem, text), one file a stem, with the text's own bytes and no more."""
    write_files(docs, path, F.concat("stem", F.lit(suffix)), F.encode("text", "UTF-8"))
