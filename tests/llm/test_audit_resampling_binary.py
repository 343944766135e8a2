import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from inkloom.llm import decompose, filter_audit, importance, jaccard_join, packing

WS = "[^\x20\x09-\x0d]+"
CLASHING = "doc_id bigint, text string, source string, part string, mask int, fp bigint, row bigint, rank int, length int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 7, 8, 9, 1, 2, "s") for i, t, s in rows], CLASHING)


def corpus(seed=4):
    r = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(300)] + ["THE", "Ünder", "中文", "a$b", "it's"]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    rows = [(1, None, None), (2, "", ""), (3, " \n\t", "s1"), (4, "x", "s1"), (None, say(60), "s1"), (5, "WORD " * 40, "s2")]
    hot = say(70)
    rows += [(i, hot, "hot") for i in range(100, 180)] + [(100, hot, "hot"), (None, hot, "hot"), (99, hot, None)]
    rows += [(i, say(r.randint(0, 120)), r.choice(["s1", "s2", "s3"])) for i in range(200, 260)]
    rows += [(300, say(20_000), "long"), (301, "y" * 200_000, "long"), (302, rows[90][1], "s3"), (302, say(30), "s3"), (302, say(30), "s3")]
    return rows


def plain_audit(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    docs = []
    for i, t, s in rows:
        t, words = t or "", re.findall(WS, t or "")
        fails = {f for f, bad in zip("ABCDE", [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), re.search("[#$%&*|]", t), i is not None and i > first[t]], strict=True) if bad}
        docs.append((s or "", fails, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        for order in itertools.permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            for step, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                all_fail = [d for d in docs if d[0] == part and f in d[1]]
                left = [d for d in left if f not in d[1]]
                out[part, "".join(order), step + 1] = [len(left), len(gone), len(all_fail) - len(gone), sum(d[1] == {f} for d in all_fail), sum(d[2] for d in gone), sum(d[3] for d in gone)]
    for part in {d[0] for d in docs}:
        for f in "ABCDE":
            steps = [k for k in out if k[0] == part and k[1][k[2] - 1] == f]
            total = sum(out[k][1] for k in steps)
            for k in steps:
                out[k].append(total)
    return out


@pytest.mark.parametrize("partitions", ["1", "23"])
def test_filter_audit(spark, partitions):
    """Against every order run one filter after the other; a hot text lies over many ranges with 23 of them."""
    rows = corpus()
    labels = [(i, r, r2) for i, r, r2 in zip(range(90, 310), itertools.cycle([0, 1, None]), itertools.cycle([1, 0, 0, None]), strict=False)] + [(100, 1, 0), (100, 0, 1), (None, 1, 1)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        masks = filter_audit.failures(frame(spark, rows))
        assert masks.count() == len(rows)
        table = spark.createDataFrame([(*x, "extra") for x in labels], "doc_id bigint, quality int, toxic int, part string")
        got = {tuple(r)[:3]: list(r)[3:] for r in filter_audit.audit(frame(spark, rows), table).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # A repeated doc_id is a document with the labels of its doc_id each time.
    assert got == plain_audit(rows, labels)


def test_a_text_over_several_ranges(spark, monkeypatch):
    """Copies in every range: what continues from another range is told by the smallest doc_id of all."""
    monkeypatch.setattr(filter_audit, "shards_for", lambda df: 8)
    seen = []
    stored = filter_audit.materialize
    monkeypatch.setattr(filter_audit, "materialize", lambda df, label: seen.append(stored(df, label)) or seen[-1])
    rows = [(i, "one text", "s") for i in range(400)] + [(i, "another", "s") for i in range(400, 410)]
    masks = {r["doc_id"]: r["mask"] for r in filter_audit.failures(frame(spark, rows)).collect()}
    assert sorted(i for i, m in masks.items() if not m & 16) == [0, 400]
    assert seen[0].filter("edge = 'one text'").count() > 2


def test_texts_that_share_a_fingerprint(spark, monkeypatch):
    """The sort and the comparisons are by the full text, so equal fingerprints alone make no duplicates."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(filter_audit, "shards_for", lambda df: 5)
    monkeypatch.setattr(filter_audit.F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    rows = [(i, f"text {i % 9}", "s") for i in range(120)]
    masks = {r["doc_id"]: r["mask"] for r in filter_audit.failures(frame(spark, rows)).collect()}
    assert sorted(i for i, m in masks.items() if not m & 16) == list(range(9))


def test_counters_add_up(spark):
    rows, labels = corpus(), spark.createDataFrame([(i, 1, i % 2) for i in range(90, 310)], "doc_id bigint, quality int, toxic int")
    masks = filter_audit.failures(frame(spark, rows))
    whole = filter_audit.counters(masks, labels)
    parts = [filter_audit.counters(masks.filter(c), labels) for c in ("part = 'hot'", "part <> 'hot'")]
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, filter_audit.summed(parts[0].unionByName(parts[1])).collect()))


def plain_resample(rows, target, n, buckets, least, percent):
    def runs(t):
        w = re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode())
        return len(w), [zlib.crc32(b" ".join(w[a : a + k])) % buckets for k in range(1, n + 1) for a in range(len(w) - k + 1)]

    docs = [(i, *runs(t)) for i, t, *_ in rows if i is not None]
    s, t = Counter(b for d in docs for b in d[2]), Counter(b for x in target for b in runs(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for i, words, own in docs:
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((d for d in out if d[5] >= least), key=lambda d: (-d[3], d[0], d[1]))
    for rank, d in enumerate(able[: percent * len(able) // 100]):
        d[4] = rank + 1
    return sorted((tuple(d[:5]) for d in out), key=repr)


@pytest.mark.parametrize(("n", "buckets", "percent"), [(1, 10_000, 10), (2, 97, 35), (3, 70_000, 100), (1, 50, 0)])
def test_resampling(spark, monkeypatch, n, buckets, percent):
    monkeypatch.setattr(importance, "shards_for", lambda df: 7)
    rows = corpus(6) + [(400 + i, "one text of many copies " * 5, "s") for i in range(50)] + [(400, "one text of many copies " * 5, "s")] * 3
    target = [None, "", "word1 word2 word3 the", "中文 word5 and WORD7-word9"]
    got = importance.resample(frame(spark, rows), spark.createDataFrame([(None, t, 1) for t in target], "item_id bigint, text string, n_words int"), n, buckets, percent=percent)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(rows, target, n, buckets, 20, percent)


def test_the_ring_gives_every_run():
    data = "One, two three-ÉÀ 中文 five5 ` six".encode()
    words = ["one", "two", "three", "ÉÀ", "中文", "five5", "six"]
    for n in (1, 2, 3, 9):
        want = sorted(zlib.crc32(" ".join(words[a : a + k]).encode()) for k in range(1, n + 1) for a in range(len(words) - k + 1))
        assert sorted(importance.run_hashes(data, n)) == want
        assert importance.n_words(len(want), n) == 7
    assert [importance.n_words(len(list(importance.run_hashes(b"a " * k, 4))), 4) for k in range(9)] == list(range(9))


def test_the_same_bucket_counts_from_any_partitioning(spark):
    rows = corpus(8)
    found = [importance.features(importance.documents(frame(spark, rows).repartition(k)), "doc_id", 2, 300) for k in (1, 9)]
    one, many = (importance.bucket_counts(f, 300) for f in found)
    assert one.sum() > 0 and np.array_equal(one, many)


@pytest.fixture(scope="module")
def tokenizer():
    return public_tokenizers.path("byte_bpe_50k.json")


def test_binary_packing(spark, tokenizer):
    """Tokens against the tokenizer's own, pieces against their rules, numbers without gaps."""
    r = random.Random(2)
    signs = ["it's", "don't.", "x,y", "Ünder!", "12.5%", "中文。", "#tag", "—", "THE", "naïve?!", "'", "a b", "é", "🙂", "<|endoftext|>"]
    say = lambda n: "".join(r.choice([*signs, f"word{r.randrange(99)}", "the"]) + r.choice([" ", " ", " ", "\n", "  ", " \n", "\n\n"]) for _ in range(n))
    rows = [(1, None, ""), (2, "", ""), (3, " ", ""), (4, "\n \n", ""), (5, "a\tb\r\n c \x1c d", ""), (5, "again", ""), (None, "lost", "")]
    rows += [(10 + i, say(r.randint(1, 90)), "") for i in range(40)] + [(60, say(6000), ""), (61, "x" * 40_000, ""), (62, "the " * 1023, ""), (62, "the " * 1023, "")]
    t = Tokenizer.from_file(tokenizer)
    pieces = decompose.token_pieces(frame(spark, rows).repartition(5), tokenizer)
    got = decompose.number_sequences(pieces).collect()
    assert sorted(x["sequence_id"] for x in got) == list(range(len(got)))
    by_number = sorted(got, key=lambda x: x["sequence_id"])
    assert [x["length"] for x in by_number] == sorted(x["length"] for x in got)
    assert {x["offset"] for x in got} == {0}
    held = Counter()
    for i, text, _ in rows:
        if i is not None:
            held[i, tuple([*t.encode(text or "", add_special_tokens=False).ids, 0])] += 1
    want = Counter()
    for (i, ids), many in held.items():
        n, start = len(ids), 0
        lengths = [1024] * (n // 1024) + [1 << b for b in range(9, -1, -1) if n % 1024 >> b & 1]
        for length in lengths:
            want[i, start, length, np.array(ids[start : start + length], "<u4").tobytes(), n] += many
            start += length
    assert Counter((x["doc_id"], x["start"], x["length"], bytes(x["ids"]), x["doc_tokens"]) for x in got) == want


@pytest.mark.parametrize("kind", [(decompose.ChunkIds, "byte_bpe_50k.json"), (packing.TokenIds, "word_bpe_49k.json")])
def test_words_are_forgotten_and_learnt_again(monkeypatch, kind):
    """A cache far smaller than the words of the texts gives the tokenizer's own ids all the same."""
    monkeypatch.setattr(packing, "CACHED_WORDS", 30)
    model = open(public_tokenizers.path(kind[1]), encoding="utf-8").read()
    ids_of, t, r = kind[0](model), Tokenizer.from_str(model), random.Random(1)
    for _ in range(25):
        texts = [" ".join(r.choice(["reouon", "The", "naïve", f"w{r.randrange(60)}", f"word{'abcdef'[r.randrange(6)]}"]) + r.choice(["", ".", ",", "?!"]) for _ in range(20)) for _ in range(4)]
        assert [np.frombuffer(b, "<u4").tolist() for b in ids_of.of_texts(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_words_that_come_once_are_not_kept():
    """Nor does a worker keep the words' ids when it goes on to another operator."""
    model = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    ids_of, r = packing.TokenIds.of_worker(model), random.Random(2)
    word = lambda: "".join(r.choice("abcdefgéèß") for _ in range(9))
    for _ in range(20):
        texts = [" ".join([*(word() for _ in range(40)), "the", "One,"]) for _ in range(20)]
        assert [np.frombuffer(b, "<u4").tolist() for b in ids_of.of_texts(texts)] == [ids_of.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    assert {"the", "One,"} <= set(ids_of) and len(ids_of) < 400  # of 16,000 words that come once
    assert packing.TokenIds.of_worker(model) is ids_of
    sets = pd.DataFrame({"doc_id": [1], "row_hash": [1], "text": ["a b c d e f"]})
    assert len(list(jaccard_join.sketching(2)(iter([sets])))) == 2
    assert packing.TokenIds.of_worker(model) is not ids_of


class Counted:
    """A tokenizer, and how many texts it was given."""

    def __init__(self, tokenizer):
        self.own, self.texts = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self.own, name)

    def encode(self, text, **options):
        self.texts += 1
        return self.own.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.own.encode_batch_fast(texts, **options)


def test_letters_go_to_the_model_alone(tokenizer):
    """New words of letters are most of what a corpus has to encode; the tokenizer's other parts took twice the time for them."""
    ids_of, t, r = decompose.ChunkIds(open(tokenizer, encoding="utf-8").read()), Tokenizer.from_file(tokenizer), random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCéüßñµª") for _ in range(r.randint(1, 12)))
    texts = ["\n".join(" ".join(word() + r.choice(["", "", ",", ".", "?!"]) for _ in range(9)) for _ in range(4)) for _ in range(150)]
    ids_of.tokenizer = Counted(ids_of.tokenizer)
    assert [np.frombuffer(b, "<u4").tolist() for b in ids_of.of_texts(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert ids_of.tokenizer.texts <= 3 and ids_of.letters  # closing signs, in one call a group of texts
    # Whatever white space stands where, with a tokenizer that takes letters whole and with one that is not known to.
    parts = [" ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r", "\xa0", "a", "Zb", "é", "é.", "été,", "x1", "it's", "中", "🙂", ".", "?!", "<|endoftext|>", "\u180e", "\u200b"]
    texts = ["", *parts, *("".join(r.choice(parts) for _ in range(r.randint(2, 9))) for _ in range(3000))]
    for letters in (True, False):
        ids_of.clear()
        ids_of.letters = letters
        assert [np.frombuffer(b, "<u4").tolist() for b in ids_of.of_texts(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_binary_pieces_cover_every_length():
    for n in range(1, 300):
        pieces = decompose.binary_pieces(n, 64)
        assert [s for s, _ in pieces] == [sum(k for _, k in pieces[:j]) for j in range(len(pieces))]
        assert sum(k for _, k in pieces) == n and all(k & (k - 1) == 0 and k <= 64 for _, k in pieces)
        assert len(pieces) == n // 64 + (n % 64).bit_count()


def test_a_tokenizer_that_keeps_no_chunks_apart(spark):
    """Where ids of chunks are not those of the text, the text is encoded whole; here the other word tokenizer, which drops white space."""
    path = public_tokenizers.path("word_bpe_49k.json")
    text = "One Two,  three.\n\nFour it's 5 été"
    got = decompose.token_pieces(frame(spark, [(1, text, "")]), path).orderBy("start").collect()
    assert np.frombuffer(b"".join(bytes(x["ids"]) for x in got), "<u4").tolist() == [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 0]


def test_buckets_are_written_by_length(spark, tokenizer, tmp_path):
    numbered = decompose.number_sequences(decompose.token_pieces(frame(spark, [(i, "the " * i, "") for i in range(1, 20)]), tokenizer))
    decompose.write_buckets(numbered, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.filter("bucket <> length").isEmpty() and back.count() == numbered.count()


def test_empty_tables(spark, tokenizer):
    none, labels = frame(spark, []), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(none, labels).collect() == []
    assert importance.resample(none, none).collect() == []
    assert decompose.number_sequences(decompose.token_pieces(none, tokenizer)).collect() == []
    some = frame(spark, [(1, "a few words", "s")])
    assert filter_audit.audit(some, labels).count() == 600
    assert [tuple(r)[0:2] for r in importance.resample(some, none).collect()] == [(1, 3)]
    with pytest.raises(ValueError, match="power of two"):
        decompose.token_pieces(some, tokenizer, 1000)
