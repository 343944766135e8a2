"""A corpus as data: what is particular to one kind of document, and where its documents come from."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.operators.model import MODEL, NUM_CTX, RETRIES, TEMPERATURE, TIMEOUT_S
from inkloom.operators import model
from inkloom.operators.sections import LEVELS, Split, split_sections
from inkloom.sources.files import title_of, wiki_url

#: The name of the prompt that all corpora share; one of a corpus's own name extends it.
BASE_PROMPT = "cleanup_prompt"
URL = "http://localhost:11434/api/generate"


@dataclass(frozen=True)
class Recipe:
    name: str
    title: str
    kind: str = "blog"  # of LEVELS: where its documents are split
    split: Callable[[Column], Column] | None = None  # in place of kind: a text to an array of sections
    prompt: str = ""
    model: str = MODEL
    url: str = URL
    temperature: float = TEMPERATURE
    num_ctx: int = NUM_CTX
    timeout: int = TIMEOUT_S
    retries: int = RETRIES
    posts: tuple[str, ...] = ()  # URLs of HTML pages
    pages: tuple[str, ...] = ()  # names of wiki pages, in reading order
    pages_base: str = ""

    def __post_init__(self):
        if self.split is None and self.kind not in LEVELS:
            raise ValueError(f"{self.kind!r} is no kind of document; there are {', '.join(LEVELS)}")

    def sections(self) -> Split:
        return self.split or self.kind


# The three corpora that are known from the start, their pages in reading order.
PAPER = Recipe("rocksdb", "RocksDB: Evolution of Development Priorities", "paper")
BLOG = Recipe(
    "cloudflare-ebpf",
    "Cloudflare eBPF Replatforming",
    "blog",
    posts=(
        "https://ebpf.io/blog/cloudflare-replatforming-1/",
        "https://ebpf.io/blog/cloudflare-replatforming-2/",
        "https://ebpf.io/blog/cloudflare-replatforming-3/",
    ),
)
WIKI = Recipe(
    "rocksdb-tuning-guide",
    "RocksDB Wiki",
    "wiki",
    pages_base="https://raw.githubusercontent.com/wiki/facebook/rocksdb",
    pages=(
        "RocksDB-Overview",
        "RocksDB-Tuning-Guide",
        "MemTable",
        "Block-Cache",
        "Write-Buffer-Manager",
        "Compaction",
        "Universal-Compaction",
        "IO",
        "Iterator",
        "Prefix-Seek",
        "Column-Families",
        "Transactions",
        "Snapshot",
        "Read-only-and-Secondary-instances",
        "Delete-A-Range-Of-Keys",
        "Memory-usage-in-RocksDB",
    ),
)
RECIPES = {r.name: r for r in (PAPER, BLOG, WIKI)}


def corpora(spark: SparkSession, recipes: Sequence[Recipe], prompts: DataFrame | None = None, titles: DataFrame | None = None) -> DataFrame:
    """corpus, title, kind, asked (model.settings): what stages look up by a corpus's name, a row a recipe.

    prompts (name, text) has the prompt that all corpora share and, for those that need one, an extension under their own name;
    without the shared one, a recipe's own prompt is its base, and a corpus with neither is an error. titles
    (corpus, title) has the texts of title files; where there is none, or a blank one, the recipe's title holds."""
    columns = "corpus string, title string, kind string, own_prompt string, model string, temperature double, num_ctx int"
    rows = spark.createDataFrame([(r.name, r.title, r.kind, r.prompt, r.model, float(r.temperature), r.num_ctx) for r in recipes], columns)
    prompts = spark.createDataFrame([], "name string, text string") if prompts is None else prompts
    titles = spark.createDataFrame([], "corpus string, title string") if titles is None else titles
    rows = rows.withColumn("shared", F.lit(BASE_PROMPT))
    base = prompts.select(F.col("name").alias("shared"), F.col("text").alias("base"))
    extension = prompts.select(F.col("name").alias("corpus"), F.col("text").alias("extension"))
    found = rows.join(base, "shared", "left").join(extension, "corpus", "left").join(titles.withColumnRenamed("title", "in_file"), "corpus", "left")
    own = F.nullif("own_prompt", F.lit(""))
    system = model.prompt(F.coalesce("base", own, F.raise_error(F.concat(F.lit("no prompt for corpus "), "corpus"))), F.col("extension"))
    asked = F.struct(system.alias("system"), "model", "temperature", "num_ctx")
    return found.select("corpus", title_of(F.col("in_file"), F.col("title")).alias("title"), "kind", asked.alias("asked"))


def split_of(recipes: Sequence[Recipe]) -> Callable[[Column], Column]:
    """Sections by the recipe of a row's corpus."""

    def split(text: Column) -> Column:
        out = F.array().cast("array<string>")
        for r in recipes:
            out = F.when(F.col("corpus") == r.name, split_sections(text, r.sections())).otherwise(out)
        return out

    return split


def manifest(spark: SparkSession, recipes: Recipe | Sequence[Recipe]) -> DataFrame:
    """corpus, stem, url, html: what recipes download. The stem of a wiki page begins with its place in the reading order."""
    recipes = [recipes] if isinstance(recipes, Recipe) else recipes
    posts = [(r.name, u.rstrip("/").split("/")[-1], u, None, None, True) for r in recipes for u in r.posts]
    pages = [(r.name, f"{i:02d}_{p.lower()}", None, p, r.pages_base, False) for r in recipes for i, p in enumerate(r.pages)]
    rows = spark.createDataFrame(posts + pages, "corpus string, stem string, url string, page string, base string, html boolean")
    return rows.select("corpus", "stem", F.coalesce("url", wiki_url(F.col("base"), F.col("page"))).alias("url"), "html")
