"""Packing by powers of two: no sequence crosses documents, and none is padded.

A document of L tokens is cut into as many pieces of the capacity as it has and, of what is
left, one piece for each binary digit of its length, the longest first. Every piece is a
sequence of its own, at offset 0; its length is a power of two, so it stands in a bucket
with pieces of just that length and batches of a bucket need no padding. Sequences are
numbered without gaps, bucket by bucket from the shortest: a piece counts within its task
as it is cut, and the counts of the tasks before are added from a table of one row a task
and length. No bucket ever meets in one task.
"""

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkloom.llm import packing
from inkloom.llm.common import documents, materialize, of_worker
from inkloom.llm.packing import TokenIds

CAPACITY = 1024
END_ID = 0


def binary_pieces(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: those of the capacity, then the binary digits of the rest from the highest."""
    pieces = [(start, capacity) for start in range(0, n - capacity + 1, capacity)]
    start = n - n % capacity
    for bit in reversed(range((n % capacity).bit_length())):
        if n >> bit & 1:
            pieces.append((start, 1 << bit))
            start += 1 << bit
    return pieces


class ChunkIds(TokenIds):
    """Ids of texts by the ids of their chunks, white space and the word after it. A byte-level tokenizer never
    joins a word to the white space after it, so a text's ids are those of its chunks, one after the other, and
    a chunk of letters and closing signs has the ids of both. Both are tried out first; where they do not hold, and for texts
    with other white space than spaces and line feeds, whose runs must not be cut, the text is encoded as a whole.

    Most chunks are a space and a word, so they are held without that space; one that begins with a line feed is held as it is,
    any other behind BARE, which texts that are cut do not have. Letters alone go to the tokenizer's model without its other parts, which is
    tried out too."""

    CHUNK = re.compile("[ \n]*[^ \n]+|[ \n]+")
    OTHER = re.compile("[^\\S \n]|[\x1c-\x1f\u180e\u200b\ufeff]")
    OTHERS = tuple(filter(OTHER.match, map(chr, range(0x10000))))
    SIGNS = ".,;:!?"
    BARE = "\r"
    #: Texts whose missing chunks are learnt together.
    TEXTS = 64

    def __init__(self, model: str):
        super().__init__(model)
        self.parts = False  # what the older class takes apart is lower-cased
        alone = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        together = lambda parts: [i for p in parts for i in alone(p)]
        tried = ["One two,  three.\n\nFour\nfive 67 it's  ", " été\n naïve  \n— x", "a\n b c \nd"]
        self.chunks = all(alone(t) == together(self.CHUNK.findall(t)) for t in tried)
        self.signs = all(alone(w + s) == alone(w) + alone(s) for w in (" the", "Zebra", "\nÉté", " don") for s in (*self.SIGNS, "...", "?!", ".,"))
        self.line = alone("\n")
        self.letters = self.takes_letters_whole()

    @staticmethod
    def of_worker(model: str) -> "ChunkIds":
        return of_worker(("chunks", hash(model)), lambda: ChunkIds(model))

    def takes_letters_whole(self) -> bool:
        """Whether letters, with a space before them or none, are one word to the tokenizer, which only its model takes apart."""
        from tokenizers.pre_tokenizers import ByteLevel

        sign = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.space = sign(" ")[0][0]
        self.latin = {k: sign(chr(k))[0][0] for k in range(0x80, 0x100)} | {ord(" "): self.space}
        own, cuts = self.tokenizer, self.tokenizer.pre_tokenizer
        if own.normalizer is not None or cuts is None or any(not re.search(r"[^\w\s]|[\d_]", t.content) for t in own.get_added_tokens_decoder().values()):
            return False
        words = ("the", "Zebra", "ÉTÉ", "naïve", "Xylophone", "QUICKLY", "ªµº", "thheIngble", "s")
        whole = all([x for x, _ in cuts.pre_tokenize_str(lead + w)] == [self.as_bytes(lead + w)] for w in words for lead in (" ", ""))
        ids_of = lambda t: own.encode(t, add_special_tokens=False).ids
        same = lambda w: all(ids_of(lead + w) == [t.id for t in own.model.tokenize(self.as_bytes(lead + w))] for lead in (" ", ""))
        return whole and all(same(w) and ids_of("\n" + w) == self.line + ids_of(w) for w in words)

    def as_bytes(self, text: str) -> str:
        """Latin letters and spaces as the model has them, a sign for each byte."""
        return text.translate(self.latin)

    def key(self, chunk: str) -> str:
        if chunk[0] == " " and chunk[1:2] != "\n":
            return chunk[1:]
        return chunk if chunk[0] == "\n" else self.BARE + chunk

    def chunk(self, key: str) -> str:
        return key[1:] if key[:1] == self.BARE else key if key[:1] == "\n" else " " + key

    def keys_of(self, text: str) -> list[str]:
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
            return [self.key(c) for c in self.CHUNK.findall(text)]
        keys = text.replace("\n", " \n").split(" ")
        if keys[0]:
            keys[0] = self.BARE + keys[0]
        else:  # the text is empty or begins with white space
            del keys[0]
        return keys

    def encoded(self, words: list[str]) -> None:
        tokenize, flat, ends, done, rest = self.tokenizer.model.tokenize, [], [0], [], []
        for key in words:
            lead = key[:1] if key[:1] in (self.BARE, "\n") else ""
            bare = key[len(lead) :]
            if not self.letters or not bare.isalpha() or (not bare.isascii() and max(bare) >= "\u0100"):
                rest.append(key)
                continue
            if lead == "\n":
                flat += self.line
            flat += [t.id for t in tokenize(("" if lead else self.space) + (bare if bare.isascii() else self.as_bytes(bare)))]
            ends.append(len(flat))
            done.append(key)
        data = np.array(flat, "<u4").tobytes()
        for key, a, b in zip(done, ends, ends[1:]):
            self[key] = data[4 * a : 4 * b]
        if rest:
            chunks = {self.chunk(k): k for k in rest}
            found: dict[str, bytes] = {}
            self.encode_into(found, list(chunks))
            for chunk, key in chunks.items():
                self[key] = found[chunk]

    def learn(self, words: set[str]) -> None:
        if len(self) > packing.CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        todo, made = set(), []

        def want(key: str) -> None:
            if (known := self.older.get(key)) is not None:
                self[key] = known
            elif key not in self:
                todo.add(key)

        for key in words:
            if key in self.older:
                self[key] = self.older[key]
            elif self.signs and key[-1:] in self.SIGNS and (bare := (letters := key.rstrip(self.SIGNS)).lstrip(" \n" + self.BARE)).isalpha() and max(bare) < "\u0100":
                made.append((key, letters, signs := self.BARE + key[len(letters) :]))
                want(letters)
                want(signs)
            else:
                todo.add(key)
        self.encoded(list(todo))
        for key, letters, signs in made:
            self[key] = self[letters] + self[signs]

    def of_texts(self, texts: list[str]) -> Iterator[bytes]:
        for lo in range(0, len(texts), self.TEXTS):
            some = texts[lo : lo + self.TEXTS]
            cut = [None if not self.chunks or any(map(t.__contains__, self.OTHERS)) else self.keys_of(t) for t in some]
            keys = list(chain.from_iterable(k for k in cut if k is not None))
            # Each key is looked for once; what was found is at hand even where the cache then forgets it.
            held = list(map(self.get, keys))
            if missing := [i for i, ids in enumerate(held) if ids is None]:
                self.learn({keys[i] for i in missing})
                for i in missing:
                    held[i] = self[keys[i]]
            at = 0
            for text, own in zip(some, cut, strict=True):
                if own is None:
                    yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                else:
                    yield b"".join(held[at : at + len(own)])
                    at += len(own)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, and part and rank, which number_sequences
    takes, for docs (doc_id, text). A document is the ids of its text and end_id; a null or empty text is end_id alone, a row
    without doc_id none. Rows alike in doc_id are documents of their own. capacity must be a power of two.
    tokenizer: the path of a tokenizers file."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"the capacity must be a power of two: {capacity}")
    with open(tokenizer, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids_of, end, part = ChunkIds.of_worker(model.value), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        ranks: dict[int, int] = {}
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch["doc_id"], ids_of.of_texts(batch["text"].tolist()), strict=True):
                ids += end
                n = len(ids) // 4
                for start, length in binary_pieces(n, capacity):
                    rank = ranks.get(length, 0)
                    ranks[length] = rank + 1
                    out.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], n, part, rank))
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids", "doc_tokens", "part", "rank"])

    return documents(docs).mapInPandas(cut, "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, part bigint, rank bigint")


def number_sequences(pieces: DataFrame) -> DataFrame:
    """pieces of token_pieces, any columns more, with sequence_id and offset for part and rank. Sequences of one length have
    neighbouring numbers from the shortest length on, without gaps. An empty table gives an empty result."""
    stored = materialize(pieces, "pieces")
    each = materialize(stored.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    lengths = each.groupBy("length").agg(F.sum("n").alias("n"))  # a row a power of two
    bases = lengths.select("length", (F.sum("n").over(Window.orderBy("length")) - F.col("n")).alias("base"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    firsts = each.select("length", "part", before.alias("before")).join(F.broadcast(bases), "length")
    firsts = materialize(firsts.select("length", "part", (F.col("base") + F.col("before")).alias("first")), "piece-firsts")
    out = stored.join(firsts, ["length", "part"])
    return out.select(*[c for c in pieces.columns if c not in ("part", "rank")], (F.col("first") + F.col("rank")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))


def write_buckets(numbered: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder a length under path, so that a loader reads batches of one length."""
    numbered.withColumn("bucket", F.col("length")).write.mode(mode).partitionBy("bucket").parquet(path)
