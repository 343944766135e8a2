"""Byte-level dedup of repeated strings by threshold-bounded interval expansion.

Two equal strings of LENGTH bytes have the same smallest hash among their 32-byte
grams, at the same place in them: their anchor. Strings whose anchor occurs once are
unique. Around the anchors that occur again, the occurrences of an anchor are sorted by
what follows, as in a Burrows-Wheeler transform, and extended backwards breadth first:
each level adds one byte on the left and splits every interval of occurrences by it,
keeping the order. At level i two neighbours of an interval share i bytes before the
anchor and their common prefix from it on, so common prefixes come by increasing value;
a string is a repeat where that sum reaches LENGTH. An interval of one occurrence, or of
occurrences that can no longer reach LENGTH, is dropped.

An anchor that is found nearly everywhere, such as one in a common passage, is more than a
task should hold. Its contexts that are alike are settled by counting them; one of each is cut
by ranges of levels: strings that start between a and b bytes before the anchor share the a
bytes before it and the LENGTH - b + 1 bytes from it on, so contexts are dealt anew by these,
range by range. What is still too large is cut into narrower ranges, down to single strings,
which are alike or not.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.llm.blocks import deal_of, found_elsewhere
from inkloom.llm.common import covered, documents, materialize, mixed, runs_of, shards_for, smallest_places, with_row_hash

LENGTH = 400
GRAM = 32
#: Bytes of context that a task gathers before it hands them on.
CHUNK_BYTES = 16 << 20
#: Occurrences that are extended together; those of one anchor stay together.
EXPAND_ROWS = 16_384
#: Bytes of one anchor's contexts and their owners that a task takes as they are; or a quarter of a task's even share, if
#: that is more, so that there are never more than four crowded anchors a task.
HOT_BYTES = 512 << 10
#: Ranges that the levels of a crowded anchor are cut into.
RANGES = 8
#: Rows of a frame that a task hands on, when it has as many.
OUT_ROWS = 200_000
CONTEXTS = "anchor bigint, level int, offset int, context binary, ids binary, hashes binary, starts binary, places bigint"
COLUMNS = [c.split()[0] for c in CONTEXTS.split(", ")]
ALIKE = ["anchor", "level", "offset", "context"]
REPEATS = "doc_id bigint, row_hash bigint, first int, n int"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    x = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))[data]
    factor, width = 0xD1342543DE82EF95, 1
    while width < GRAM:
        x = x[:-width] * np.uint64(factor) + x[width:]
        factor, width = factor * factor % 2**64, 2 * width
    return mixed(x)


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of each anchor, and the first and last start of the strings that have it."""
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    grams = gram_hashes(data)
    place, first, last = smallest_places(grams, length - GRAM + 1)
    return grams[place], place, first, last


def anchor_hashes(length: int):
    def make():
        def of(text: str) -> tuple[np.ndarray, np.ndarray]:
            h = anchors(np.frombuffer(text.encode(), np.uint8), length)[0]
            return h, deal_of(h)

        return of

    return make


def contexts(length: int):
    """The bytes around anchors that occur again, alike ones of a chunk once with all their owners."""

    def hand_on(held: dict) -> pd.DataFrame:
        rows = []
        for (anchor, offset, context), owners in held.items():
            who = np.array(owners, np.int64)
            rows.append((anchor, 0, offset, context, who[:, 0].tobytes(), who[:, 1].tobytes(), who[:, 2].tobytes(), len(who)))
        return pd.DataFrame(rows, columns=COLUMNS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}
        size = 0
        for batch in batches:
            for doc_id, row_hash, text, starts, counts in zip(batch["doc_id"], batch["row_hash"], batch["text"], batch["starts"], batch["counts"], strict=True):
                data = text.encode()
                hashes, at, first, last = anchors(np.frombuffer(data, np.uint8), length)
                signed = hashes.view(np.int64).tolist()
                for a, n in zip(starts, counts, strict=True):
                    for i in range(a, a + n):
                        lo = int(first[i])
                        key = (signed[i], int(at[i]) - lo, data[lo : int(last[i]) + length])
                        own = held.get(key)
                        if own is None:
                            held[key] = own = []
                            size += len(key[2])
                        own.append((doc_id, row_hash, lo))
                        size += 24
                if size >= CHUNK_BYTES:
                    yield hand_on(held)
                    held, size = {}, 0
        if held:
            yield hand_on(held)

    return run


def common_prefix(right: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that rows a and b of right share from the left on."""
    out = np.zeros(len(a), np.int32)
    for lo in range(0, len(a), 4096):
        x, y = a[lo : lo + 4096], b[lo : lo + 4096]
        differs = right[x] != right[y]
        n = np.where(differs.any(1), differs.argmax(1), right.shape[1])
        out[lo : lo + 4096] = np.minimum(n, np.minimum(size[x], size[y]))
    return out


def expand(group: np.ndarray, offset: np.ndarray, context: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Flags by occurrence and level: the string that starts level bytes before the anchor starts elsewhere too.
    group: the occurrences with one anchor; offset: bytes of context before the anchor. Contexts of a group differ."""
    n = len(context)
    repeat = np.zeros((n, length - GRAM + 1), bool)
    if n < 2:
        return repeat
    least = np.array([len(c) for c in context]) - length  # strings of a context, less one
    right, left = np.zeros((n, length), np.uint8), np.zeros((n, length - GRAM + 1), np.uint8)
    size = np.zeros(n, np.int32)
    for i, (c, o) in enumerate(zip(context, offset, strict=True)):
        after = np.frombuffer(c, np.uint8)[o : o + length]
        right[i, : len(after)], size[i] = after, len(after)
        left[i, :o] = np.frombuffer(c, np.uint8)[:o][::-1]
    low = offset - least
    order = np.array(sorted(range(n), key=lambda i: (group[i], context[i][offset[i] :])), np.int64)
    active, interval = order, group[order].astype(np.int64)
    shared = np.zeros(n, np.int32)  # with the occurrence before, within an interval
    same = np.flatnonzero(interval[1:] == interval[:-1]) + 1
    shared[same] = common_prefix(right, size, active[same - 1], active[same])
    for level in range(int(offset.max()) + 1):
        if level:
            byte = left[active, level - 1].astype(np.int64)
            key = interval * 256 + byte
            stays = offset[active] >= level
            best = np.maximum(shared, np.append(shared[1:], 0))
            stays &= best + offset[active] >= length
            moved = np.flatnonzero(stays)
            moved = moved[np.argsort(key[moved], kind="stable")]
            if not len(moved):
                break
            key = key[moved]
            head = np.diff(key, prepend=key[0] - 1) != 0
            kept = np.zeros(len(moved), np.int32)
            near = ~head
            near[1:] &= np.diff(moved) == 1
            near[0] = False
            kept[near] = shared[moved[near]]
            far = np.flatnonzero(~head & ~near)
            active = active[moved]
            if len(far):
                kept[far] = common_prefix(right, size, active[far - 1], active[far])
            shared, interval = kept, np.cumsum(head)
        best = np.maximum(shared, np.append(shared[1:], 0))
        hit = active[(best + level >= length) & (low[active] <= level)]
        repeat[hit, level] = True
    return repeat


def bunches(group: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of sorted groups with about `most` places each, never parting a group."""
    lo = 0
    while lo < len(group):
        hi = int(np.searchsorted(group, group[min(lo + most, len(group)) - 1], "right"))
        yield slice(lo, hi)
        lo = hi


def repeats(length: int, most: int = EXPAND_ROWS):
    """Runs of string starts that are found elsewhere, from all contexts of a partition's anchors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        owners: dict[tuple, list] = {}
        places: dict[tuple, int] = {}
        for batch in batches:
            for anchor, _, offset, context, *who, n in batch[COLUMNS].itertuples(index=False):
                key = (anchor, offset, bytes(context))
                owners.setdefault(key, []).append(np.array([np.frombuffer(x, np.int64) for x in who]))
                places[key] = places.get(key, 0) + n
        keys = list(owners)
        who = [np.concatenate(owners.pop(k), axis=1) for k in keys]
        _, group = np.unique(np.array([k[0] for k in keys], np.int64), return_inverse=True)
        many = np.array([places[k] > 1 for k in keys], bool)
        alone = np.bincount(group, minlength=1)[group] < 2 if len(keys) else np.zeros(0, bool)
        todo = np.flatnonzero(~alone & np.isin(group, group[~many]))
        todo = todo[np.argsort(group[todo], kind="stable")]
        parts, held = [], 0

        def add(i: int, a: int, b: int) -> None:
            nonlocal held
            m = who[i].shape[1]
            parts.append((who[i][0], who[i][1], who[i][2] + a, np.full(m, b - a)))
            held += m

        def taken() -> pd.DataFrame:
            nonlocal parts, held
            frame = pd.DataFrame(dict(zip(("doc_id", "row_hash", "first", "n"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))
            parts, held = [], 0
            return frame

        for i in np.flatnonzero(many).tolist():
            add(i, 0, len(keys[i][2]) - length + 1)
            if held >= OUT_ROWS:
                yield taken()
        for bunch in bunches(group[todo], most):
            mine = todo[bunch]
            flags = expand(group[mine], np.array([keys[i][1] for i in mine], np.int64), [keys[i][2] for i in mine], length)
            for i, flag in zip(mine.tolist(), flags, strict=True):
                _, offset, context = keys[i]
                n = len(context) - length + 1
                if not many[i]:
                    # by start, not by distance from the anchor
                    for a, b in zip(*(x.tolist() for x in runs_of(flag[offset - n + 1 : offset + 1][::-1])), strict=True):
                        add(i, a, b)
                if held >= OUT_ROWS:
                    yield taken()
        if parts:
            yield taken()

    return run


def whole(length: int):
    """All string starts of contexts that are known to be found elsewhere, for each owner."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            strings = batch["context"].map(len).to_numpy(np.int64) - length + 1
            owners = batch["ids"].map(len).to_numpy(np.int64) // 8
            columns = {c: np.frombuffer(b"".join(batch[of]), np.int64) for c, of in (("doc_id", "ids"), ("row_hash", "hashes"), ("first", "starts"))}
            yield pd.DataFrame({**columns, "n": np.repeat(strings, owners)})

    return run


def narrowed(width: int, part: int, length: int):
    """Contexts of levels from `level` to level + width - 1, cut into ranges of `part` levels. A piece holds the strings of
    one range; its anchor stands for the bytes that all strings of the range cover, so pieces that share a string meet."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for anchor, level, offset, context, ids, hashes, starts, n in batch[COLUMNS].itertuples(index=False):
                low, first = offset - (len(context) - length), np.frombuffer(starts, np.int64)
                for a in range(level, level + width, part):
                    b = min(a + part, level + width) - 1
                    lo, hi = max(low, a), min(offset, b)
                    if lo > hi:
                        continue
                    core = context[offset - a : offset + length - b]
                    key = xxhash.xxh3_64_intdigest(core, seed=(int(anchor) + a) % 2**64)
                    rows.append((key - 2**63, a, hi, context[offset - hi : offset - lo + length], ids, hashes, (first + (offset - hi)).tobytes(), n))
            yield pd.DataFrame(rows, columns=COLUMNS)

    return run


def runs_elsewhere(around: DataFrame, n: int, length: int) -> DataFrame:
    """REPEATS of all contexts (a stored table). No task takes more of one anchor than HOT_BYTES or a quarter of its even share."""

    def expanded(rows: DataFrame) -> DataFrame:
        return rows.repartition(n, "anchor").mapInPandas(repeats(length), REPEATS)

    rows, width, found = around, length - GRAM + 1, []
    while True:
        sizes = rows.groupBy("anchor").agg(F.sum(F.octet_length("context") + 3 * F.octet_length("ids")).alias("size"))
        sizes = materialize(sizes, "suffix-sizes")
        total, most = sizes.agg(F.sum("size"), F.max("size")).first()
        limit = max(HOT_BYTES, (total or 0) // (4 * n))
        if not most or most <= limit:
            found.append(expanded(rows))
            break
        hot = F.broadcast(sizes.filter(F.col("size") > limit).select("anchor"))  # 4 n at most
        found.append(expanded(rows.join(hot, "anchor", "left_anti")))
        crowd = rows.join(hot, "anchor", "left_semi")
        one = F.first(F.struct(*[F.substring(c, 1, 8).alias(c) for c in ("ids", "hashes", "starts")])).alias("one")
        alike = crowd.groupBy(*ALIKE).agg(one, F.sum("places").alias("places"))
        alike = materialize(alike.select(*ALIKE, "one.*", "places"), "suffix-alike")
        # What a task has gathered twice needs no asking; of the others the join's skewed parts can be split.
        asking = crowd.filter("places = 1").join(alike.filter("places > 1").select(*ALIKE).hint("merge"), ALIKE, "left_semi")
        found.append(crowd.filter("places > 1").select(*COLUMNS).unionByName(asking.select(*COLUMNS)).mapInPandas(whole(length), REPEATS))
        if width == 1:  # strings of one anchor and level are alike
            break
        part = -(-width // RANGES)
        rows = materialize(alike.mapInPandas(narrowed(width, part, length), CONTEXTS), "suffix-ranges")
        width = part
    return reduce(DataFrame.unionByName, found)


def drop_repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (byte offsets), kept (binary) for every row of docs (doc_id, text).

    Each byte of a text in UTF-8 goes that is covered by a string of length bytes which also
    starts anywhere else, in the same text or another, overlapping or not, judged on the
    input. Strings never cross texts. Null, empty and shorter texts lose nothing. Two rows
    alike in all are two places. kept can end in the middle of a code point, so it is binary.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    d = with_row_hash(documents(docs))
    n = shards_for(d)
    again = found_elsewhere(d, anchor_hashes(length), "again")
    # Rows alike in doc_id and text are all sent: each is a place of its own.
    around = d.join(again.hint("merge"), ["doc_id", "row_hash"]).mapInPandas(contexts(length), CONTEXTS)
    runs = runs_elsewhere(materialize(around, "suffix-contexts"), n, length)
    runs = runs.distinct().groupBy("doc_id", "row_hash").agg(F.collect_list("first").alias("firsts"), F.collect_list("n").alias("ns"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, firsts, ns in zip(batch["doc_id"], batch["text"], batch["firsts"], batch["ns"], strict=True):
                data = text.encode()
                if firsts is None:
                    out.append((doc_id, len(data), 0, [], data))
                    continue
                gone = covered(np.asarray(firsts, np.int64), np.asarray(ns, np.int64), length, len(data))
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((doc_id, len(data), len(data) - len(kept), [{"start": int(a), "end": int(b)} for a, b in zip(*runs_of(gone), strict=True)], kept))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start: int, end: int>>, kept binary"
    return d.join(runs.hint("merge"), ["doc_id", "row_hash"], "left").select("doc_id", "text", "firsts", "ns").mapInPandas(cut, schema)
