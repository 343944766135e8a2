"""The stages of corpora one after the other: extract, clean, check, synthesize, encode.

A folder holds a Layer for each stage: raw, clean, audio and encoded, of any number of corpora; what a recipe,
a prompt or a title says of a corpus is looked up by its name. Each stage takes what the layer before has and
its own has not yet, so a chain that was stopped goes on where it was, and one that runs again changes nothing.
What is encoded says what it was made of: a chapter whose text has changed, and a book that has a chapter more,
are made anew. Audio goes once what was made of it is committed. What reaches the outside world, pages, a model,
a voice and an encoder, is given as Tools.

    python -m inkloom.plans.chain FOLDER [needle] --recipe NAME … [--skip extract clean qa audio] [--strict] [--files PATH]
"""

import argparse
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.functions.markdown import html_to_markdown
from inkloom.functions.noise import book_stem, strip_paper_noise
from inkloom.operators import audio, qa
from inkloom.operators.model import Client, clean_documents, http_client, pending
from inkloom.plans.recipe import RECIPES, Recipe, corpora, manifest, split_of
from inkloom.sources import files
from inkloom.sources.layers import Layer
from inkloom.sources.sink import write_files

STAGES = ("extract", "clean", "qa", "audio")
OK, FLAGGED, NO_CORPUS = 0, 1, 2
KEYS = ["corpus", "stem"]


@dataclass(frozen=True)
class Tools:
    client: Client | None = None
    get: Callable[[str], str] | None = None
    pdf: Callable[[bytes], str] | None = None
    speak: audio.Speak | audio.Voice | None = None
    encode: audio.Encode | None = None
    sleep: Callable[[float], None] | None = None
    profile: ResourceProfile | None = None  # what a task of speech asks of the cluster
    per_host: int = 2  # pages asked of one host at a time


LAYERS = {
    "raw": "corpus string, stem string, text string",
    "clean": "corpus string, stem string, text string, ok boolean",
    "audio": "corpus string, stem string, made_of string, segment int, frames binary, n_bytes bigint",
    "encoded": "corpus string, stem string, fmt string, made_of string, name string, piece int, data binary",
    "exported": "corpus string, stem string, kind string, path string, made_of string",
}


class Chain:
    """The layers of a folder, and the recipes of the corpora that a run is about."""

    def __init__(self, spark: SparkSession, folder: str, recipes: Sequence[Recipe], tools: Tools, needle: str | None = None, prompts: str | None = None):
        self.spark, self.folder, self.recipes, self.tools, self.needle = spark, folder.rstrip("/"), list(recipes), tools, needle
        keys = {"encoded": ("corpus", "stem", "fmt"), "exported": ("corpus", "stem", "kind", "path")}
        self.layers = {name: Layer(spark, f"{self.folder}/{name}", schema, keys.get(name, ("corpus", "stem"))) for name, schema in LAYERS.items()}
        self.prompts = prompts

    def read(self, layer: str) -> DataFrame:
        """What a layer has of the corpora of this run."""
        return self.layers[layer].read().filter(F.col("corpus").isin(*[r.name for r in self.recipes]))

    def add(self, layer: str, rows: DataFrame) -> None:
        self.layers[layer].add(rows)

    def corpora(self) -> DataFrame:
        """recipe.corpora with the prompts of a folder and the titles of title files. A run names a few corpora; the table has a row of each."""
        prompts = files.read_texts(self.spark, self.prompts, ".txt").select(F.col("stem").alias("name"), "text") if self.prompts else None
        where = {r.name: f"{self.folder}/{r.name}/title.txt" for r in self.recipes}
        found = [self.spark.read.text(p, wholetext=True).select(F.lit(name).alias("corpus"), F.col("value").alias("title")) for name, p in where.items() if files.exists(self.spark, p)]
        titles = reduce(DataFrame.unionByName, found) if found else None
        return corpora(self.spark, self.recipes, prompts, titles)

    def extract(self) -> None:
        """Pages that are not there yet, as Markdown with one line feed more; a page that fails stops the chain."""
        known = self.read("raw").select(*KEYS)
        todo = pending(manifest(self.spark, self.recipes), known, KEYS) if any(r.posts or r.pages for r in self.recipes) else None
        if todo is not None:
            if self.tools.get is None:
                raise ValueError("the recipe has pages to fetch, and there is nothing to fetch them with")
            # Pages of a wiki come all, whatever the needle; posts by a part of their URL.
            wanted = todo.filter(~F.col("html")).unionByName(files.with_needle(todo.filter("html"), self.needle, "url"))
            got = files.fetch(wanted, self.tools.get, self.tools.per_host)
            body = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("cannot fetch "), "url", F.lit(": "), "error"))).otherwise(F.col("body"))
            self.add("raw", got.select(*KEYS, files.raw_text(F.when(F.col("html"), html_to_markdown(body)).otherwise(body)).alias("text")))
        for r in self.recipes if self.tools.pdf is not None else []:
            source = f"{self.folder}/source/{r.name}"
            if files.exists(self.spark, source):
                pdfs = files.read_binaries(self.spark, source, ".pdf").withColumn("corpus", F.lit(r.name))
                text = files.pdf_to_markdown(pending(pdfs, known, KEYS), self.tools.pdf)
                md = strip_paper_noise(F.col("text")) if r.kind == "paper" else F.col("text")
                self.add("raw", text.select(F.lit(r.name).alias("corpus"), "stem", files.raw_text(md).alias("text")))

    def clean(self) -> None:
        todo = files.with_needle(pending(self.read("raw"), self.read("clean").select(*KEYS, "ok"), KEYS), self.needle)
        client = self.tools.client or {r.name: http_client(r.url, r.timeout) for r in self.recipes}
        options = {"sleep": self.tools.sleep} if self.tools.sleep else {}
        done = clean_documents(todo, KEYS, split_of(self.recipes), self.corpora(), client, retries={r.name: r.retries for r in self.recipes}, **options)
        self.add("clean", done.select(*KEYS, "text", (F.col("n_failed") == 0).alias("ok")))

    def check(self) -> DataFrame:
        """The report of the clean documents that are not ignored; one without a source is in it, without flags."""
        own = files.with_needle(self.read("clean"), self.needle)
        return qa.report(own.filter(~qa.ignored(F.concat("stem", F.lit(".txt")))), self.read("raw"), KEYS, found=True)

    def flagged(self, report: DataFrame, strict: bool) -> list[str]:
        """The corpora that end at the gate: those without any clean document, and with strict those with a flag."""
        there = {r["corpus"] for r in self.read("clean").select("corpus").distinct().collect()}
        flags = {r["corpus"] for r in report.filter("flags > 0").select("corpus").distinct().collect()} if strict else set()
        return [r.name for r in self.recipes if r.name not in there or r.name in flags]

    def chapters(self) -> DataFrame:
        """corpus, stem, text, book_stem, made_of"""
        titles = F.broadcast(self.corpora().select("corpus", book_stem(F.col("title"), F.col("corpus")).alias("book_stem")))
        return self.read("clean").join(titles, "corpus").select(*KEYS, "text", "book_stem", F.hex(F.xxhash64("text")).alias("made_of"))

    def speak(self, fmt: str, bitrate: str | None, keep_wav: bool) -> None:
        """Chapters and, of more than one, the book. Audio of a chapter is made again where only the book needs it and it is gone."""
        chapters = self.chapters()
        wanted = audio.works(chapters)
        made = self.read("encoded").filter(F.col("fmt") == fmt) if self.tools.encode else self.read("audio")
        todo = audio.unmade(wanted, made)
        missing = audio.to_speak(chapters, todo, self.read("audio"))
        self.add("audio", audio.synthesize(missing.select(*KEYS, "made_of", "text"), self.tools.speak, self.tools.profile))
        if self.tools.encode is None:
            return
        parts = self.read("audio").join(chapters.select(*KEYS, "made_of"), [*KEYS, "made_of"], "left_semi")
        books = todo.filter("is_book")
        own = audio.in_order(parts.join(todo.filter("NOT is_book").select(*KEYS), KEYS, "left_semi"), KEYS, "segment")
        rows = own.unionByName(audio.book_of(parts, books))
        plan = audio.encode_plan(todo.withColumn("name", F.concat("stem", F.lit(".wav"))), audio.formats(self.spark), fmt, bitrate, "stem", "made_of")
        streams = rows.join(plan.select(*KEYS, "made_of", "codec", "bitrate", F.col("target").alias("name")), KEYS)
        done = audio.encode_streams(streams, self.tools.encode, [*KEYS, "made_of", "name"])
        self.add("encoded", done.withColumn("fmt", F.lit(fmt)))
        if not keep_wav:
            done = self.read("encoded").filter(F.col("fmt") == fmt).select(*KEYS, "made_of").distinct()
            self.layers["audio"].drop(self.read("audio").select(*KEYS, "made_of").distinct().join(done, [*KEYS, "made_of"], "left_semi"))

    def export(self, path: str, keep_wav: bool = False) -> None:
        """What is not there yet, or was made anew, as files: raw/STEM.md, clean/STEM.txt, audio/NAME and title.txt under each corpus's
        name, with the bytes of the text and no more. What was written where is a layer of its own, committed after the files."""
        known = self.read("exported").filter(F.col("path") == path)

        def write(kind: str, rows: DataFrame, name: Column, data: Column, *order: str) -> None:
            todo = rows.join(known.filter(F.col("kind") == kind).select(*KEYS, "made_of"), [*KEYS, "made_of"], "left_anti")
            write_files(todo, path, F.concat_ws("/", "corpus", name), data, *order)
            self.layers["exported"].add(todo.select(*KEYS, F.lit(kind).alias("kind"), F.lit(path).alias("path"), "made_of").distinct())

        for layer, suffix in (("raw", ".md"), ("clean", ".txt")):
            texts = self.read(layer).withColumn("made_of", F.hex(F.xxhash64("text")))
            write(layer, texts, F.concat(F.lit(layer + "/"), "stem", F.lit(suffix)), F.encode("text", "UTF-8"))
        for fmt, *_ in audio.FORMATS if self.tools.encode else []:
            write(fmt, self.read("encoded").filter(F.col("fmt") == fmt), F.concat(F.lit("audio/"), "name"), F.col("data"), "piece")
        if keep_wav or not self.tools.encode:
            spoken = self.read("audio")
            whole = audio.works(self.chapters().join(spoken.select(*KEYS, "made_of").distinct(), [*KEYS, "made_of"], "left_semi"))
            rows = audio.in_order(spoken, KEYS, "segment").unionByName(audio.book_of(spoken, whole.filter("is_book")))
            write("wav", rows.join(whole.select(*KEYS, "made_of"), KEYS), F.concat(F.lit("audio/"), "stem", F.lit(".wav")), F.col("data"), "start")
        titles = self.corpora().select("corpus", F.lit("").alias("stem"), "title", F.col("title").alias("made_of"))
        write("title", titles, F.lit("title.txt"), F.encode(F.concat("title", F.lit("\n")), "UTF-8"))


def run(
    spark: SparkSession, folder: str, recipes: Recipe | Sequence[Recipe], tools: Tools, skip: Sequence[str] = (), strict: bool = False, needle: str | None = None,
    fmt: str = "mp3", bitrate: str | None = None, keep_wav: bool = False, prompts: str | None = None, export: str | None = None,
) -> tuple[int, DataFrame | None]:
    """(exit code, quality report). A corpus ends at a quality gate that fails: with strict when anything of it is flagged, and
    in any case when it has no clean document; the others go on, and the code says that one has ended. A folder that is not there is an
    error of its own. prompts: a folder of prompt files; export: where to write files, one a document."""
    if unknown := set(skip) - set(STAGES):
        raise ValueError(f"no stages: {', '.join(sorted(unknown))}; there are {', '.join(STAGES)}")
    audio.check_format(fmt)
    recipes = [recipes] if isinstance(recipes, Recipe) else list(recipes)
    if not files.exists(spark, folder):
        return NO_CORPUS, None
    chain, report, ended = Chain(spark, folder, recipes, tools, needle, prompts), None, []
    if "extract" not in skip:
        chain.extract()
    if "clean" not in skip:
        chain.clean()
    if "qa" not in skip:
        report = chain.check()
        ended = chain.flagged(report, strict)
    chain.recipes = [r for r in recipes if r.name not in ended]
    if "audio" not in skip and tools.speak is not None and chain.recipes:
        chain.speak(fmt, bitrate, keep_wav)
    if export:
        chain.recipes = recipes
        chain.export(export, keep_wav)
    return FLAGGED if ended else OK, report


def show(report: DataFrame) -> None:
    """A line a document, then their sum. The report is as long as the corpus: it is printed as it streams in."""
    for row in report.orderBy(*KEYS).toLocalIterator():
        print("  ".join(f"{k}={v}" for k, v in row.asDict().items()))
    total = qa.summary(report).first()
    print(f"{total['flags']} flags in {total['files']} files")


def main(arguments: Sequence[str] | None = None, tools: Tools | None = None) -> int:
    parser = argparse.ArgumentParser(description="Run the stages of one corpus or several.")
    parser.add_argument("folder")
    parser.add_argument("needle", nargs="?")
    parser.add_argument("--recipe", choices=sorted(RECIPES), required=True, action="append")
    parser.add_argument("--skip", nargs="*", default=[], choices=STAGES)
    parser.add_argument("--strict", action="store_true")
    parser.add_argument("--format", default="mp3", choices=[f[0] for f in audio.FORMATS])
    parser.add_argument("--bitrate")
    parser.add_argument("--keep-wav", action="store_true")
    parser.add_argument("--prompts", help="a folder with cleanup_prompt.txt and, for corpora that need one, an extension under their name")
    parser.add_argument("--files", help="a folder for one file a document")
    asked = parser.parse_args(arguments)
    spark = SparkSession.builder.getOrCreate()
    recipes = [RECIPES[name] for name in dict.fromkeys(asked.recipe)]
    code, report = run(spark, asked.folder, recipes, tools or Tools(get=files.http_get()), asked.skip, asked.strict, asked.needle, asked.format, asked.bitrate, asked.keep_wav, asked.prompts, asked.files)
    if report is not None:
        show(report)
    return code


if __name__ == "__main__":
    raise SystemExit(main())
