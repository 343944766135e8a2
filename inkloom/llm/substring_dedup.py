"""Substring dedup by relative Lempel-Ziv parsing against blocks of indexed text.

Windows of words that are equal have the same anchor: the gram of GRAM words in them with the
smallest hash. Text around anchors that occur nowhere else cannot repeat and is left aside. The
text around each of the others, as far as windows with that anchor reach, is dealt by the anchor
to blocks, so that all text a piece could repeat is in its own block, and is cut into factors
there:

* A block is indexed by a suffix array over its words. The longest factor at a place that a
  smaller doc_id holds too is shared with the nearest suffix before or after it that has a
  smaller doc_id.
* A piece is parsed greedily: the longest such factor, then the next one behind it.
* A factor of at least WINDOW words is a duplicate span. A window that crosses the boundary of
  two factors, and no longer than both together, is looked up at its own start. One that crosses
  two boundaries repeats nothing, or the middle factor would have been longer.

Words themselves are compared, not hashes; hashes only choose anchors and blocks. A piece that
a task meets several times is sent once, with the smallest doc_id that has it; the task's own row
turns the answers into places in its documents, so a passage that a third of all documents hold
costs a block an entry a task.
"""

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from inkloom.llm.blocks import deal_of, found_elsewhere, packed, unpacked
from inkloom.llm.common import WordHashes, covered, documents, mixed, rolling, runs_of, shards_for, smallest_places, with_row_hash, words_of

WINDOW = 13
#: Windows that one anchor can have; its gram has the other words.
SPAN = 6
#: Code points and bytes that a task gathers before it hands them on.
CHUNK_BYTES = 16 << 20
PIECES = "shard int, batch bigint, texts string, anchors binary, places binary, least binary, greatest binary, owners binary"
ANSWERS = "batch bigint, places binary, least binary, masks binary, owners binary"
FOUND = "doc_id bigint, row_hash bigint, starts array<int>, counts array<int>"


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each anchor, and the first and last start of the windows that have it."""
    span = min(SPAN, window)
    grams = rolling(hashes, window - span + 1)
    place, first, last = smallest_places(grams, span)
    return grams[place], first, last


def anchor_hashes(window: int) -> Callable:
    def make():
        cache = WordHashes()

        def of(text: str) -> tuple[np.ndarray, np.ndarray]:
            h = anchors(cache.of(words_of(text)), window)[0]
            return h, deal_of(h)

        return of

    return make


# -- the parse -----------------------------------------------------------------------


class Index:
    """A suffix array over texts of words, each with an id."""

    def __init__(self, texts: list[list[str]], ids: np.ndarray):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.start = np.cumsum(sizes) - sizes
        self.end = np.repeat(self.start + sizes, sizes)
        self.ids = np.repeat(np.asarray(ids, np.int64), sizes)
        codes = pd.factorize(np.array(list(chain.from_iterable(texts)), object))[0].astype(np.int64) + 1
        # ranks[k]: equal where the next 2**k words are, or all up to the end of both texts.
        self.ranks, width = [codes], 1
        while width < sizes.max(initial=1):
            low = np.zeros_like(codes)
            at = np.arange(len(codes))
            fits = np.flatnonzero(at + width < self.end)
            low[fits] = self.ranks[-1][fits + width]
            self.ranks.append(np.unique(self.ranks[-1] * (len(codes) + 2) + low, return_inverse=True)[1].astype(np.int64) + 1)
            width *= 2
        self.order = np.argsort(self.ranks[-1], kind="stable")
        self.longest = self.longest_earlier()

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at a and b begin with alike; 0 for a place of -1."""
        a, b, n = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        some = np.flatnonzero((a >= 0) & (b >= 0))
        for k in reversed(range(len(self.ranks))):
            x, y = a[some] + n[some], b[some] + n[some]
            fit = (x + (1 << k) <= self.end[a[some]]) & (y + (1 << k) <= self.end[b[some]])
            fit[fit] = self.ranks[k][x[fit]] == self.ranks[k][y[fit]]
            n[some[fit]] += 1 << k
        return n

    def nearest_smaller(self, ids: np.ndarray) -> np.ndarray:
        """For each rank the nearest one before it with a smaller id, or -1. What lies between is never smaller, so it can be jumped over."""
        to = np.arange(-1, len(ids) - 1)
        while True:
            at = np.flatnonzero(to >= 0)
            at = at[ids[to[at]] >= ids[at]]
            if not len(at):
                return to
            to[at] = to[to[at]]

    def longest_earlier(self) -> np.ndarray:
        """For each place the longest factor from it that a text with a smaller id holds too."""
        ids, n = self.ids[self.order], len(self.order)
        before, after = self.nearest_smaller(ids), self.nearest_smaller(ids[::-1])[::-1]
        place = lambda rank: np.where(rank >= 0, self.order[rank], -1)
        out = np.zeros(n, np.int64)
        out[self.order] = np.maximum(self.shared(self.order, place(before)), self.shared(self.order, place(np.where(after >= 0, n - 1 - after, -1))))
        return out

    def factors(self) -> np.ndarray:
        """The end of the greedy factor that each place is in; a word that is in no smaller id is a factor by itself."""
        starts, ends = np.zeros(len(self.order), bool), self.end
        at = self.start[self.start < len(ends)]
        at = at[ends[at] > at]
        while len(at):
            starts[at] = True
            limit = ends[at]
            at = at + np.maximum(1, self.longest[at])
            at = at[at < limit]
        places = np.flatnonzero(starts)
        return np.repeat(places + np.maximum(1, self.longest[places]), np.diff(np.append(places, len(starts))))

    def repeated(self, window: int) -> np.ndarray:
        """Flags of the places where a window starts that a text with a smaller id holds too, from the factors."""
        own = self.factors()
        at = np.arange(len(own))
        beyond = np.where(own < self.end, own[np.minimum(own, len(own) - 1)], own)
        out = at + window <= own
        crossing = np.flatnonzero(~out & (at + window <= beyond))
        out[crossing] = self.longest[crossing] >= window
        return out


# -- pieces to blocks, answers back -----------------------------------------------------


def pieces(window: int, n_shards: int) -> Callable:
    """Text around anchors that occur again, one row for each shard, and the owners of all of it in a row that only passes through."""

    def hand_on(number: int, held: dict[str, list]) -> pd.DataFrame:
        owners = [np.array(o[1:], np.int64) for o in held.values()]
        windows = np.array([t.count(" ") + 2 - window for t in held], np.int64)
        table = b"".join(len(x).to_bytes(8, "little") + x for x in (packed(np.array([len(o) for o in owners], np.int64)), packed(windows), *(np.concatenate(owners)[:, k].tobytes() for k in range(3))))
        rows = [(number % n_shards, number, None, None, None, None, None, table)]
        texts, hashes = np.array(list(held), object), np.array([o[0] for o in held.values()], np.uint64)
        least, greatest = np.array([o[:, 0].min() for o in owners]), np.array([o[:, 0].max() for o in owners])
        shard = (mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(n_shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            rows.append((int(shard[at[0]]), number, "\n".join(texts[at]), hashes[at].tobytes(), packed(at), least[at].tobytes(), greatest[at].tobytes(), None))
        return pd.DataFrame(rows, columns=["shard", "batch", "texts", "anchors", "places", "least", "greatest", "owners"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held, size, cache = TaskContext.get().partitionId() << 24, {}, 0, WordHashes()
        for batch in batches:
            for doc_id, row_hash, text, starts, counts in zip(batch["doc_id"], batch["row_hash"], batch["text"], batch["starts"], batch["counts"], strict=True):
                words = words_of(text)
                hashes, first, last = anchors(cache.of(words), window)
                wanted = np.concatenate([np.arange(a, a + n) for a, n in zip(starts, counts, strict=True)])
                for h, lo, hi in zip(hashes[wanted].tolist(), first[wanted].tolist(), (last[wanted] + window).tolist(), strict=True):
                    piece = " ".join(words[lo:hi])
                    own = held.get(piece)
                    if own is None:
                        held[piece] = own = [h]
                        size += len(piece)
                    own.append((doc_id, row_hash, lo))
                    size += 24
                if size >= CHUNK_BYTES:
                    yield hand_on(number, held)
                    number, held, size = number + 1, {}, 0
        if held:
            yield hand_on(number, held)

    return run


def answer(asked: list[tuple], window: int) -> Iterator[tuple]:
    """Of one block: batch, places, the smallest doc_id of each text there, and which of its windows a smaller doc_id has, as bits."""
    texts = pd.factorize(np.array(list(chain.from_iterable(a[1].split("\n") for a in asked)), object))
    code, distinct = texts[0], texts[1]
    anchor, least, greatest = (np.concatenate([np.frombuffer(a[k], kind) for a in asked]) for k, kind in ((2, np.uint64), (4, np.int64), (5, np.int64)))
    first = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(first, code, least)
    group = np.zeros(len(distinct), np.uint64)
    group[code] = anchor
    _, at, many = np.unique(group, return_inverse=True, return_counts=True)
    masks = np.zeros(len(distinct), np.uint8)
    todo = np.flatnonzero(many[at] > 1)  # a text alone around its anchor is one factor for all but its smallest doc_id
    if len(todo):
        index = Index([t.split(" ") for t in distinct[todo]], first[todo])
        repeats = index.repeated(window)
        for bit in range(min(SPAN, window)):
            place = index.start + bit
            fits = place < len(repeats)
            fits[fits] &= index.end[place[fits]] == index.end[index.start[fits]]
            masks[todo[fits]] |= repeats[place[fits]].astype(np.uint8) << bit
    tells = (greatest > first[code]) | ((masks[code] > 0) & (least == first[code]))
    lo = 0
    for a in asked:
        places = unpacked(a[3])
        mine = slice(lo, lo + len(places))
        lo += len(places)
        say = tells[mine]
        if say.any():
            yield a[0], packed(places[say]), first[code[mine]][say].tobytes(), masks[code[mine]][say].tobytes(), None


def answering(window: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["batch", "places", "least", "masks", "owners"]
        by_shard: dict[int, list] = {}
        for batch in batches:
            own = batch["texts"].isna()
            if own.any():
                yield batch.loc[own, ["batch", "owners"]].assign(places=None, least=None, masks=None)[columns]
            for shard, *row in batch.loc[~own, ["shard", "batch", "texts", "anchors", "places", "least", "greatest"]].itertuples(index=False):
                by_shard.setdefault(shard, []).append(row)
        for shard in list(by_shard):
            yield pd.DataFrame(list(answer(by_shard.pop(shard), window)), columns=columns)

    return run


def located(owners: bytes, answers: list[tuple], window: int) -> pd.DataFrame:
    """Runs of starts of repeated windows for each document of a batch that has any."""
    parts, at = [], 0
    while at < len(owners):
        n = int.from_bytes(owners[at : at + 8], "little")
        parts.append(owners[at + 8 : at + 8 + n])
        at += 8 + n
    counts, windows = unpacked(parts[0]), unpacked(parts[1])
    ids, row_hashes, starts = (np.frombuffer(p, np.int64) for p in parts[2:])
    first, mask = np.full(len(counts), np.iinfo(np.int64).max), np.zeros(len(counts), np.uint8)
    for places, least, masks in answers:
        here = unpacked(places)
        first[here], mask[here] = np.frombuffer(least, np.int64), np.frombuffer(masks, np.uint8)
    first, mask, every = (np.repeat(x, counts) for x in (first, mask.astype(np.int64), (1 << windows) - 1))
    own = np.where(ids > first, every, np.where(ids == first, mask, 0))
    if not own.any():
        return pd.DataFrame(columns=["doc_id", "row_hash", "starts", "counts"])
    docs, who = np.unique(np.stack([ids, row_hashes], 1), axis=0, return_inverse=True)
    key = np.concatenate([(who.ravel()[hit := np.flatnonzero(own >> bit & 1)] << 32) | (starts[hit] + bit) for bit in range(min(SPAN, window))])
    key = np.unique(key)
    cuts = np.flatnonzero(np.diff(key, prepend=-2) != 1)
    runs = pd.DataFrame({"who": key[cuts] >> 32, "first": (key[cuts] & 0xFFFFFFFF).astype(np.int32), "n": np.diff(np.append(cuts, len(key))).astype(np.int32)})
    out = [(docs[w, 0], docs[w, 1], g["first"].to_numpy(), g["n"].to_numpy()) for w, g in runs.groupby("who")]
    return pd.DataFrame(out, columns=["doc_id", "row_hash", "starts", "counts"])


def gathering(window: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[int, bytes] = {}
        answers: dict[int, list] = {}
        for batch in batches:
            for number, places, least, masks, owners in batch[["batch", "places", "least", "masks", "owners"]].itertuples(index=False):
                if owners is not None:
                    tables[number] = owners
                else:
                    answers.setdefault(number, []).append((places, least, masks))
        for number in list(tables):
            yield located(tables.pop(number), answers.pop(number, []), window)

    return run


def repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    """For each row of docs (doc_id, row_hash, text) with any: runs of starts of windows that a smaller doc_id holds too."""
    n = shards_for(docs)
    again = found_elsewhere(docs, anchor_hashes(window), "again")
    around = docs.join(again.hint("merge"), ["doc_id", "row_hash"]).dropDuplicates(["doc_id", "row_hash"])
    sent = around.select("doc_id", "row_hash", "text", "starts", "counts").mapInPandas(pieces(window, n), PIECES)
    answered = sent.repartition(n, "shard").mapInPandas(answering(window), ANSWERS)
    return answered.repartition(n, "batch").mapInPandas(gathering(window), FOUND)


def drop_repeated_phrases(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, spans (word offsets), kept (text) for every row of docs (doc_id, text).

    Words are runs of anything but ASCII white space. Each word goes that is covered by a
    window of consecutive words whose sequence also starts in a document with a smaller
    doc_id, judged on the input. Kept words are joined by one space. Null, empty and short
    texts lose nothing. Rows with one doc_id do not count against each other.
    """
    d = with_row_hash(documents(docs))
    found = repeated_windows(d, window)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, starts, counts in zip(batch["doc_id"], batch["text"], batch["starts"], batch["counts"], strict=True):
                words = words_of(text)
                if starts is None:
                    out.append((doc_id, len(words), 0, [], " ".join(words)))
                    continue
                spans = list(zip(*(x.tolist() for x in runs_of(covered(np.asarray(starts), np.asarray(counts), window, len(words)))), strict=True))
                kept, at = [], 0
                for a, b in spans:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                out.append((doc_id, len(words), len(words) - len(kept), [{"start": a, "end": b} for a, b in spans], " ".join(kept)))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "spans", "kept"])

    schema = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start: int, end: int>>, kept string"
    return d.join(found.hint("merge"), ["doc_id", "row_hash"], "left").select("doc_id", "text", "starts", "counts").mapInPandas(cut, schema)
