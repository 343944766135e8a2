"""The stage before the others: a model proposes a recipe for a new kind of document from a sample of one."""

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.operators.model import MODEL, TEMPERATURE, Client, code_block, request_of
from inkloom.operators.sections import sample_text
from inkloom.sources.files import exists, write_texts

# Context and patience for the one long request.
NUM_CTX, TIMEOUT_S = 32768, 1200
SAMPLE_SUFFIXES = (".md", ".html", ".txt")

#: What the sample is embedded in; {playbook}, {sample} and {name} are put in. It asks for the fields of a Recipe.
TEMPLATE = """A corpus named "{name}" needs a Recipe. Its stages are described here:

<PLAYBOOK>
{playbook}
</PLAYBOOK>

This is one of its documents, in parts:

<SAMPLE>
{sample}
</SAMPLE>

Decide each field of the Recipe from what you see, with a sentence of reason:
- kind, one of paper, blog and wiki, where its headings are those of one; otherwise split, a function of a text column
  that returns an array of sections, which also takes out what no listener needs;
- prompt, only where code, tables, equations or figures, or terms that are hard to say, need more than the shared prompt;
- num_ctx, where a section may be long.

End with the Recipe alone in a ```python block.
"""


def build_prompt(name: Column, sample: Column, playbook: str) -> Column:
    """The request for a recipe. What is put in is never searched for further places to put something in."""
    pieces: list[Column] = []
    for piece in TEMPLATE.replace("{name}", "\0name\0").replace("{sample}", "\0sample\0").replace("{playbook}", "\0playbook\0").split("\0"):
        pieces.append({"name": name, "sample": sample, "playbook": F.lit(playbook)}[piece] if piece in ("name", "sample", "playbook") else F.lit(piece))
    return F.concat(*pieces)


def call_model(client: Client, prompt: str, model: str = MODEL) -> tuple[str, bool]:
    """(response, cut off). One try only, errors are raised; a response that was cut off is a warning, unlike a section's."""
    answer = client(request_of(prompt, None, model, TEMPERATURE, NUM_CTX))
    cut_off = answer.get("done_reason") == "length"
    if cut_off:
        logging.getLogger(__name__).warning("the answer reached the model's context limit and is cut off")
    return answer["response"], cut_off


@dataclass(frozen=True)
class Prepared:
    prompt: str
    response: str | None = None
    code: str | None = None
    saved: str | None = None
    cut_off: bool = False


def read_sample(spark: SparkSession, path: str) -> DataFrame:
    if not path.endswith(SAMPLE_SUFFIXES):
        raise ValueError(f"a sample is one of {', '.join(SAMPLE_SUFFIXES)}: {path}")
    return spark.read.text(path, wholetext=True).select(F.validate_utf8("value").alias("text"))


def prepare(spark: SparkSession, path: str, name: str, playbook: str, client: Client | None, out: str | None = None, first: int = 200, middle: int = 200, model: str = MODEL) -> Prepared:
    """The prompt and, with a client, the model's answer and the recipe in it, saved as the file
    out/name.py. The recipe is never run. Without a fenced block nothing is saved."""
    sample = read_sample(spark, path).select(build_prompt(F.lit(name), sample_text(F.col("text"), first, middle), playbook).alias("prompt"))
    prompt = sample.first()["prompt"]
    if client is None:
        return Prepared(prompt)
    response, cut_off = call_model(client, prompt, model)
    row = spark.createDataFrame([(response,)], "response string").select(code_block(F.col("response")).alias("code")).first()
    code, saved = row["code"], None
    if code and out:
        saved = f"{out.rstrip('/')}/{name}.py"
        if exists(spark, saved):
            raise FileExistsError(saved)
        write_texts(spark.createDataFrame([(name, code + "\n")], "stem string, text string"), out, ".py")  # with one line feed more
    return Prepared(prompt, response, code, saved, cut_off)
