"""Best-fit packing after a dominance reduction.

Lengths are whole numbers up to the capacity, so the whole instance is a histogram of at
most `capacity` counts, however many items there are; it is planned on the driver and
its size does not depend on the data. First Martello and Toth's reduction: a longest
item and a partner that no other feasible set can beat, a partner that fills the rest
exactly or one at least as long as anything else that still fits, are fixed as a
sequence for good, as often as both lengths last. The rest goes, longest first, to the
open sequence with the least room that takes it. Both work on runs of like items, so the
plan has some rows for each length. An item finds its place by its rank among the items
of its length: ranks within each stored partition, plus the counts of the partitions
before, so no length's items ever meet in one task.
"""

import bisect
import os
import re
from collections.abc import Iterator
from itertools import chain, filterfalse
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkloom.llm.common import documents, field_list, materialize, of_worker, with_column

CAPACITY = 4096
END_ID = 1
#: Words whose ids a worker remembers.
CACHED_WORDS = 300_000
#: Marks, a byte each, of the words that were met once.
MARKS = 1 << 22

#: length, first rank, items, items of a sequence, first sequence, offset in it
PlanRow = tuple[int, int, int, int, int, int]


class Plan:
    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, {k: n for k, n in counts.items() if n}
        self.used: dict[int, int] = {}
        self.rows: list[PlanRow] = []
        self.sequences = 0
        self.fixed = 0

    def put(self, length: int, items: int, each: int, sequence: int, offset: int) -> None:
        rank = self.used.get(length, 0)
        self.rows.append((length, rank, items, each, sequence, offset))
        self.used[length] = rank + items
        self.left[length] -= items
        if not self.left[length]:
            del self.left[length]

    def fix(self, longest: int, partner: int | None, times: int) -> None:
        first, self.sequences, self.fixed = self.sequences, self.sequences + times, self.fixed + times
        if partner == longest:
            self.put(longest, 2 * times, 2, first, 0)
            return
        self.put(longest, times, 1, first, 0)
        if partner:
            self.put(partner, times, 1, first, longest)

    def dominant(self, lengths: list[int], longest: int) -> tuple[int | None, int] | None:
        """A partner (None: no item fits) and how often both last, where nothing beats it; lengths ascend."""
        room, n = self.capacity - longest, self.left[longest]
        own = lengths[: bisect.bisect_right(lengths, room)]
        if own and own[-1] == longest and n == 1:
            own = own[:-1]
        if not own:
            return None, n
        best = own[-1]
        times = n // 2 if best == longest else min(n, self.left[best])
        if best == room:
            return best, times
        spare = lambda x: self.left[x] - (x == longest)
        small = [x for x in own[:3] for _ in range(min(3, spare(x)))][:3]
        if len(small) < 2 or small[0] + small[1] > room:
            return best, times
        if len(small) > 2 and sum(small) <= room:
            return None
        lo, hi, pair = 0, len(own) - 1, 0  # the largest sum of two that fit
        while lo <= hi:
            if lo == hi and spare(own[lo]) < 2:
                break
            total = own[lo] + own[hi]
            if total > room:
                hi -= 1
            else:
                pair = max(pair, total)
                lo += 1
        return (best, times) if best >= pair else None

    def reduce(self) -> None:
        again = True
        while again and self.left:
            again = False
            for longest in sorted(self.left, reverse=True):
                while longest in self.left:
                    found = self.dominant(sorted(self.left), longest)
                    if found is None or not found[1]:
                        break
                    self.fix(longest, *found)
                    again = True

    def best_fit(self) -> None:
        rooms: list[int] = []  # ascending; open[room]: runs of sequences (first, how many)
        open_: dict[int, list[tuple[int, int]]] = {}

        def opened(room: int, first: int, n: int) -> None:
            if room and n:
                if room not in open_:
                    bisect.insort(rooms, room)
                    open_[room] = []
                open_[room].append((first, n))

        for length in sorted(self.left, reverse=True):
            while n := self.left.get(length, 0):
                at = bisect.bisect_left(rooms, length)
                if at < len(rooms):
                    room = rooms[at]
                    first, many = open_[room].pop()
                    if not open_[room]:
                        del open_[room], rooms[at]
                else:
                    room, first = self.capacity, self.sequences
                    many = -(-n // (room // length))
                    self.sequences += many
                each = room // length
                full, rest = min(many, n // each), 0
                if full:
                    self.put(length, full * each, each, first, self.capacity - room)
                    opened(room - each * length, first, full)
                if full < many and (rest := n - full * each):
                    self.put(length, rest, rest, first + full, self.capacity - room)
                    opened(room - rest * length, first + full, 1)
                opened(room, first + full + bool(rest), many - full - bool(rest))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[PlanRow]:
    if bad := [k for k in counts if k is None or not 1 <= k <= capacity]:
        raise ValueError(f"lengths must be 1 to {capacity}: {bad[:5]}")
    p = Plan(counts, capacity)
    p.reduce()
    p.best_fit()
    return p.rows


def best_fit_pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """items with sequence_id and offset added, or replaced; items has a column length, 1 to capacity, and any others
    of any names.

    Sequences are gapless from offset 0 and hold at most capacity. Another length, or a null
    one, is an error. Alike items are items of their own. An empty table gives an empty result.
    """
    items = items.drop("sequence_id", "offset")
    # The caller's columns travel as one value: none of them can clash with a column in here.
    one = F.struct(*[items[c] for c in items.columns]).alias("item")
    stored = materialize(items.select(one, items["length"].cast("long").alias("length"), F.monotonically_increasing_id().alias("row")), "pack-items")
    stored = stored.withColumn("part", F.shiftright("row", 33))
    each = stored.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    each = materialize(each.select("part", "length", "n", F.coalesce(before, F.lit(0)).alias("before")), "pack-counts")
    counts = {r["length"]: r["n"] for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 6)

    ranked = stored.withColumn("rank", F.row_number().over(Window.partitionBy("part", "length").orderBy("row")) - 1)
    ranked = ranked.join(each.select("part", "length", "before").hint("merge"), ["part", "length"])
    ranked = ranked.select("item", "length", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = rows[:, 0] << 48 | rows[:, 1]
        for batch in batches:
            rank, length = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("rank", "length"))
            at = rows[np.searchsorted(keys, length << 48 | rank, side="right") - 1]
            since = rank - at[:, 1]
            batch = with_column(batch.select(["item"]), "sequence_id", at[:, 4] + since // at[:, 3], pa.int64())
            yield with_column(batch, "offset", at[:, 5] + since % at[:, 3] * at[:, 0], pa.int64())

    return ranked.mapInArrow(place, f"{field_list(ranked, 'length', 'rank')}, sequence_id bigint, offset bigint").select("item.*", "sequence_id", "offset")


class TokenIds(dict):
    """Little-endian ids by word. The tokenizer cuts at white space and drops it, so the ids of
    a text are those of its words, one after the other. One that also lower-cases and cuts between
    letters and signs, which is tried out first, lets words be taken apart: a word of Latin letters and full stops or commas has the ids of its
    letters, then those of its signs. Most words of a corpus come once, so a word stays only when it
    is met again in later texts: the first time leaves a mark, by its hash. When CACHED_WORDS are held, they become the older
    generation, from which words in use move back; the one before is forgotten."""

    #: Words of one call to the tokenizer, parted by its special token.
    TOGETHER = 64
    #: Texts whose words are held at a time.
    TEXTS = 128
    PARTING = "<|endoftext|>"

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.parting = self.tokenizer.token_to_id(self.PARTING)
        self.older: dict[str, bytes] = {}
        self.met, self.marked = bytearray(MARKS), 0
        self.passing: list[str] = []
        self.parts = self.lower_cases_and_parts_signs()
        self.whole = self.parts and self.takes_words_whole()

    @staticmethod
    def of_worker(model: str) -> "TokenIds":
        """One for all tasks of a worker process."""
        return of_worker(("tokens", hash(model)), lambda: TokenIds(model))

    def lower_cases_and_parts_signs(self) -> bool:
        """Whether words may be taken apart: the tokenizer says so by what it makes of words as texts have them."""
        same = lambda a, *b: self.tokenizer.encode(a, add_special_tokens=False).ids == [i for x in b for i in self.tokenizer.encode(x, add_special_tokens=False).ids]
        words = ("the", "Zebra", "ÉTÉ", "naïve", "Xylophone", "QUICKLY")
        return all(same(w + s, w.lower(), s) and same(w, w.lower()) for w in words for s in (".", ",", "...", ".,", ",,"))

    def takes_words_whole(self) -> bool:
        """Whether a word of small Latin letters has the ids that the tokenizer's model alone makes of its bytes."""
        from tokenizers.pre_tokenizers import ByteLevel

        sign = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.latin = {k: sign(chr(k))[0][0] for k in range(0x80, 0x100)}
        if any(not re.search(r"[^\w\s]|[\d_]", t.content) for t in self.tokenizer.get_added_tokens_decoder().values()):
            return False
        words = ("the", "zebra", "été", "naïve", "xylophone", "ªµº", "thheingble", "s", "ß", "straße")
        return all(self.tokenizer.encode(w, add_special_tokens=False).ids == [t.id for t in self.tokenizer.model.tokenize(self.as_bytes(w))] for w in words)

    def as_bytes(self, text: str) -> str:
        """Latin letters as the model has them, a sign for each byte."""
        return text if text.isascii() else text.translate(self.latin)

    def encoded(self, words: list[str]) -> None:
        if self.whole:
            tokenize, rest = self.tokenizer.model.tokenize, []
            for w in words:
                if w.isalpha() and w.islower() and (w.isascii() or max(w) < "\u0100"):
                    ids = [t.id for t in tokenize(self.as_bytes(w))]
                    self[w] = pack(f"<{len(ids)}I", *ids)
                else:
                    rest.append(w)
            words = rest
        self.encode_into(self, words)

    def encode_into(self, held: dict[str, bytes], words: list[str]) -> None:
        alone = [w for w in words if self.parting is None or self.PARTING in w]
        if alone:
            words = [w for w in words if w not in set(alone)]
            for word, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False), strict=True):
                held[word] = np.array(e.ids, "<u4").tobytes()
        for lo in range(0, len(words), 100 * self.TOGETHER):
            groups = [words[k : k + self.TOGETHER] for k in range(lo, min(lo + 100 * self.TOGETHER, len(words)), self.TOGETHER)]
            for group, e in zip(groups, self.tokenizer.encode_batch_fast([self.PARTING.join(g) for g in groups], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, "<u4")
                data, cuts = ids.tobytes(), (4 * np.flatnonzero(ids == self.parting)).tolist()
                for word, a, b in zip(group, [0, *(c + 4 for c in cuts)], [*cuts, len(data)], strict=True):
                    held[word] = data[a:b]

    def learn(self, words: set[str]) -> None:
        if len(self) > CACHED_WORDS:
            self.older = dict(self)
            self.clear()
            words = words | self.asked
        todo, made = set(), []
        for w in words:
            known = self.older.get(w)
            if known is not None:
                self[w] = known
                continue
            letters = (low := w.lower()).rstrip(".,")
            if self.parts and letters.isalpha() and (letters.isascii() or max(letters) < "\u0100") and letters != w:
                made.append((w, letters, signs := low[len(letters) :]))
                todo.update(x for x in (letters, signs) if x not in self)
            else:
                todo.add(w)
        self.encoded(list(todo))
        for w, letters, signs in made:
            self[w] = self[letters] + self[signs]
        todo.update(w for w, _, _ in made)
        self.mark(todo)

    def mark(self, words: set[str]) -> None:
        """Words without a mark get one, and are only passing."""
        if self.marked > MARKS // 4:
            self.met, self.marked = bytearray(MARKS), 0
        met = self.met
        for w in words:
            at = hash(w) % MARKS
            if not met[at]:
                met[at] = 1
                self.passing.append(w)
        self.marked += len(self.passing)

    def of_texts(self, texts: list[str]) -> Iterator[bytes]:
        for lo in range(0, len(texts), self.TEXTS):
            # The space and the line feed are ones that the tokenizer's pattern knows in any case; others stay within a word.
            words = [t.replace("\n", " ").split(" ") for t in texts[lo : lo + self.TEXTS]]
            self.asked: set[str] = set()
            if len(self) > CACHED_WORDS:
                self.asked = set(chain.from_iterable(words))
            self.learn(set(filterfalse(self.__contains__, chain.from_iterable(words))))
            for w in words:
                yield b"".join(map(self.__getitem__, w))
            for w in self.passing:
                self.pop(w, None)
            self.passing = []


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids (binary, little-endian unsigned 32-bit) for docs (doc_id, text).

    A document is the ids of its text and END_ID; one longer than capacity is cut into pieces
    of capacity ids, the last one shorter. A null or empty text is END_ID alone. tokenizer: the
    path of a tokenizers file whose pre-tokenizer drops white space.
    """
    with open(tokenizer, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids_of, end = TokenIds.of_worker(model.value), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch["doc_id"], ids_of.of_texts(batch["text"].tolist()), strict=True):
                ids += end
                for piece, lo in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[lo : lo + 4 * capacity]
                    out.append((doc_id, piece, lo // 4, len(part) // 4, part))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids"])

    return documents(docs).mapInPandas(cut, "doc_id bigint, piece int, start bigint, length bigint, ids binary")
