"""The chain, its layers and its files: run again, stopped on the way, with several corpora, fed by a stream."""

import hashlib
import io
import os
import stat
import sys
import threading
import time
import wave
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from inkloom.operators import audio
from inkloom.plans import chain, recipe
from inkloom.sources import files, layers, sink
from inkloom.streaming import incremental

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not see this module


def frames_of(text):
    return hashlib.sha256(text.encode()).digest() * (1 + len(text) % 5)


def plain_wav(frames):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(24_000)
        w.writeframes(frames)
    return out.getvalue()


def encoded_as(codec, rate, wav):
    return f"{codec} {rate} ".encode() + wav


class Counted:
    """Tools that say how often they were used, and can be told to fail."""

    def __init__(self, spark):
        self.cleaned, self.spoken, self.encoded = (spark.sparkContext.accumulator(0) for _ in range(3))

    def tools(self, pages=None, **other):
        cleaned, spoken, encoded = self.cleaned, self.spoken, self.encoded

        def client(request):
            cleaned.add(1)
            return {"response": request["prompt"].replace("# ", "") + f" {request['system']}."}

        def speak(text):
            spoken.add(1)
            yield frames_of(text)

        def encode(wav, codec, rate):
            encoded.add(1)
            yield f"{codec} {rate} ".encode()
            yield from wav

        said = {"client": client, "get": lambda url: f"<h1>T.</h1><p>Text of {url}.</p>" if pages is None else pages[url], "speak": speak, "encode": encode, "sleep": lambda s: None}
        return chain.Tools(**said | other)

    def since(self, before=(0, 0, 0)):
        return tuple(a.value - b for a, b in zip((self.cleaned, self.spoken, self.encoded), before, strict=True))


def encoded_files(c):
    rows = c.layers["encoded"].read().orderBy("corpus", "name", "piece").collect()
    out = {}
    for r in rows:
        out[r["corpus"], r["name"]] = out.get((r["corpus"], r["name"]), b"") + bytes(r["data"])
    return out


def expected(c, corpus, book):
    texts = {r["stem"]: r["text"] for r in c.layers["clean"].read().filter(F.col("corpus") == corpus).collect()}
    out = {(corpus, f"{s}.mp3"): encoded_as("libmp3lame", "64k", plain_wav(frames_of(t))) for s, t in texts.items()}
    if len(texts) > 1:
        out[corpus, f"{book}.mp3"] = encoded_as("libmp3lame", "64k", plain_wav(b"".join(frames_of(texts[s]) for s in sorted(texts))))
    return out


def made(*stems, name="c", title="My: Book"):
    return recipe.Recipe(name, title, prompt="P", posts=tuple(f"https://h/{s}/" for s in stems))


def test_a_chain_that_runs_again(spark, tmp_path):
    """The second run changes nothing; the third has one document more, which adds a file and a new book; a text that changes is made anew."""
    folder, used = str(tmp_path / "corpus"), Counted(spark)
    assert chain.run(spark, folder, made("one", "two"), used.tools())[0] == chain.NO_CORPUS
    (tmp_path / "corpus").mkdir()
    assert chain.run(spark, folder, made("one", "two"), used.tools(), ["extract", "clean"])[0] == chain.FLAGGED
    assert chain.run(spark, folder, made("one", "two"), used.tools())[0] == chain.OK
    c = chain.Chain(spark, folder, [made("one", "two", "zero")], used.tools())
    first = encoded_files(c)
    assert first == expected(c, "c", "My Book") and len(first) == 3 and used.since() == (2, 2, 3)
    assert c.layers["audio"].batches() == []  # audio goes after the commit

    batches, before = {k: v.batches() for k, v in c.layers.items()}, used.since()
    assert chain.run(spark, folder, made("one", "two"), used.tools())[0] == chain.OK
    assert used.since(before) == (0, 0, 0) and {k: v.batches() for k, v in c.layers.items()} == batches

    assert chain.run(spark, folder, made("one", "two", "zero"), used.tools())[0] == chain.OK
    third = encoded_files(c)
    assert third == expected(c, "c", "My Book") and len(third) == 4
    assert {k: third[k] for k in first if k[1] != "My Book.mp3"} == {k: first[k] for k in first if k[1] != "My Book.mp3"}
    assert used.since(before) == (1, 3, 2)  # the book needs the older chapters' audio, but they are not encoded again

    before = used.since()
    c.layers["clean"].add(spark.createDataFrame([("c", "two", "Another text.", True)], chain.LAYERS["clean"]))
    assert chain.run(spark, folder, made("one", "two", "zero"), used.tools())[0] == chain.OK
    assert encoded_files(c) == expected(c, "c", "My Book") and used.since(before) == (0, 3, 2)


@pytest.mark.parametrize("keep", [False, True])
def test_a_chain_that_is_stopped(spark, tmp_path, keep):
    """Stopped while it encodes, nothing of it counts; stopped between the commit and the removal of audio, the next run removes it. Audio that is kept serves the next book."""
    folder, used = str(tmp_path), Counted(spark)

    def fails(wav, codec, rate):
        yield b"some"
        raise OSError("no encoder")

    with pytest.raises(Exception, match="no encoder"):
        chain.run(spark, folder, made("one", "two"), used.tools(encode=fails), keep_wav=keep)
    c = chain.Chain(spark, folder, [made("one", "two")], used.tools())
    assert c.layers["encoded"].batches() == [] and len(c.layers["audio"].batches()) == 1
    dropped = layers.Layer.drop
    try:
        layers.Layer.drop = lambda self, gone: (_ for _ in ()).throw(OSError("stopped"))
        if not keep:
            with pytest.raises(OSError, match="stopped"):
                chain.run(spark, folder, made("one", "two"), used.tools())
    finally:
        layers.Layer.drop = dropped
    assert chain.run(spark, folder, made("one", "two"), used.tools(), keep_wav=keep)[0] == chain.OK
    assert encoded_files(c) == expected(c, "c", "My Book")
    assert used.since() == (2, 2, 3)  # nothing was cleaned, spoken or encoded twice
    assert len(c.layers["audio"].batches()) == int(keep)
    chain.run(spark, folder, made("one", "two", "zero"), used.tools(), keep_wav=keep)
    assert used.since((2, 2, 3)) == (1, 1 if keep else 3, 2) and encoded_files(c) == expected(c, "c", "My Book")


def test_two_corpora_in_one_run(spark, tmp_path):
    """Each with its own split, title and prompt, one of them without an extension; they share stems. One ends at the gate, the other goes on."""
    (tmp_path / "prompts").mkdir()
    (tmp_path / "prompts" / "cleanup_prompt.txt").write_text("\nBase \n")
    (tmp_path / "prompts" / "b.txt").write_text(" More\n")
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "title.txt").write_text("\n Title of A \nnot this\n")
    pages = {f"https://h/{n}/{s}/": f"<h1>H.</h1><p>{n} {s}.</p><h2>I.</h2><p>End.</p>" for n in "ab" for s in ("one", "two")}
    both = [recipe.Recipe(n, "Own", kind, posts=tuple(u for u in pages if f"/{n}/" in u), retries=0) for n, kind in (("a", "blog"), ("b", "wiki"))]
    used, folder, out = Counted(spark), str(tmp_path), str(tmp_path / "out")
    with pytest.raises(Exception, match="no prompt for corpus"):
        chain.run(spark, folder, both, used.tools(pages), ["audio"])
    code, report = chain.run(spark, folder, both, used.tools(pages), prompts=str(tmp_path / "prompts"), export=out)
    c = chain.Chain(spark, folder, both, used.tools(), prompts=str(tmp_path / "prompts"))
    assert code == chain.OK and report.count() == 4 and report.filter("corpus = 'a'").count() == 2
    texts = {(r["corpus"], r["stem"]): r["text"] for r in c.layers["clean"].read().collect()}
    assert texts["a", "one"] == "H.\na one. Base.\n\n#I.\nEnd. Base." and texts["b", "two"].count("Base\n\nMore") == 0  # paragraphs of a section are one
    assert texts["b", "two"] == "H.\nb two. Base More.\n\n#I.\nEnd. Base More."
    want = expected(c, "a", "Title of A") | expected(c, "b", "Own")
    assert encoded_files(c) == want and len(want) == 6
    assert {r["corpus"]: r["title"] for r in c.corpora().select("corpus", "title").collect()} == {"a": "Title of A", "b": "Own"}
    found = {os.path.relpath(os.path.join(d, f), out): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(out) for f in fs if not f.startswith(".")}
    raw = {f"{r['corpus']}/raw/{r['stem']}.md": r["text"].encode() for r in c.layers["raw"].read().collect()}
    assert all(v.endswith(b"\n") and not v.endswith(b"\n\n") for v in raw.values())
    assert found == raw | {f"{n}/clean/{s}.txt": t.encode() for (n, s), t in texts.items()} | {f"{n}/audio/{f}": d for (n, f), d in want.items()} | {"a/title.txt": b"Title of A\n", "b/title.txt": b"Own\n"}
    # With the audio kept, and no encoder, the files are WAV, the book's too; nothing is written twice.
    at, plain = str(tmp_path / "plain"), used.tools(pages, encode=None)
    chain.run(spark, folder, both, plain, prompts=str(tmp_path / "prompts"), export=at)
    assert open(f"{at}/a/audio/Title of A.wav", "rb").read() == plain_wav(frames_of(texts["a", "one"]) + frames_of(texts["a", "two"]))
    assert open(f"{at}/b/audio/two.wav", "rb").read() == plain_wav(frames_of(texts["b", "two"]))
    os.remove(f"{at}/b/audio/two.wav")
    chain.run(spark, folder, both, plain, prompts=str(tmp_path / "prompts"), export=at)
    assert not os.path.exists(f"{at}/b/audio/two.wav")
    # With strict, a flag of b (a heading's sign is left) ends b alone.
    c.layers["clean"].add(spark.createDataFrame([("a", "one", "H.\na one. End. and more of it.", True), ("a", "two", "H.\na two. End. and more of it.", True)], chain.LAYERS["clean"]))
    before = used.since()
    code, report = chain.run(spark, folder, both, used.tools(pages), ["extract", "clean"], strict=True)
    assert code == chain.FLAGGED and {r["corpus"] for r in report.filter("flags > 0").collect()} == {"b"}
    assert used.since(before) == (0, 2, 3)  # a's new texts


def test_command_line(spark, tmp_path, capsys):
    used, folder = Counted(spark), str(tmp_path)
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "cleanup_prompt.txt").write_text("P")
    tools = used.tools()
    assert chain.main([folder, "replatforming-1", "--recipe", "cloudflare-ebpf", "--prompts", str(tmp_path / "p"), "--skip", "audio"], tools) == chain.OK
    shown = capsys.readouterr().out
    assert "cloudflare-replatforming-1" in shown and "residue=" in shown and "flags in 1 files" in shown
    # A needle that nothing has is no fault of a corpus that is there, not even with --strict; a corpus without clean documents is.
    assert chain.main([folder, "nowhere", "--recipe", "cloudflare-ebpf", "--skip", "extract", "clean", "audio", "--strict"], tools) == chain.OK
    assert chain.main([folder, "--recipe", "rocksdb", "--skip", "extract", "clean", "audio"], tools) == chain.FLAGGED
    with pytest.raises(ValueError, match="no stages"):
        chain.run(spark, folder, made("x"), tools, ["nothing"])
    with pytest.raises(ValueError, match="no audio format"):
        chain.run(spark, folder, made("x"), tools, fmt="flac")


def test_layers(spark, tmp_path):
    layer = layers.Layer(spark, str(tmp_path / "layer"), "corpus string, stem string, n int")
    rows = lambda *x: spark.createDataFrame(list(x), "corpus string, stem string, n int")
    held = lambda: sorted(map(tuple, layer.read().collect()))
    assert held() == [] and layer.add(rows()) is None and layer.batches() == []
    layer.add(rows(("007", "a", 1), ("007", "a", 2), ("007", "b", 3)))
    layer.add(rows(("007", "a", 4), ("x/y z", "a", 5)), "t-1")
    assert held() == [("007", "a", 4), ("007", "b", 3), ("x/y z", "a", 5)]
    assert layer.add(rows(("007", "b", 9)), "t-1") is None and len(layer.batches()) == 2  # a batch of that name is there
    os.remove(tmp_path / "layer" / f"batch={layer.batches()[1]}" / "_SUCCESS")  # as a write that was stopped
    assert held() == [("007", "a", 1), ("007", "a", 2), ("007", "b", 3)]
    layer.add(rows(("007", "a", 6)), "t-1")
    assert held() == [("007", "a", 6), ("007", "b", 3)]
    layer.drop(layer.read().filter("n = 3").select("corpus", "stem"))
    assert held() == [("007", "a", 6)]
    layer.drop(layer.read())
    assert held() == [] and layer.batches() == []


def test_starts(spark):
    """Sums before a row, equal to one pass in order, for a group that lies over many ranges."""
    import random

    r = random.Random(3)
    data = [("hot" if r.random() < 0.7 else f"g{r.randrange(5)}", f"s{i:04d}", r.randrange(50)) for i in range(900)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = {(x["g"], x["s"]): x["start"] for x in layers.starts(spark.createDataFrame(data, "g string, s string, n bigint").repartition(7), ["g"], ["s"], "n").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sums, want = {}, {}
    for g, s, n in sorted(data):
        want[g, s] = sums.get(g, 0)
        sums[g] = sums.get(g, 0) + n
    assert got == want


def beyond_five_digits(tmp_path, spark):
    """documents whose names, cut to five digits, are shared; the later doc_ids come first."""
    rows = [(i, f"src{i // 10 % 4}", 100 + i % 37) for i in (*range(100_079, 99_999, -1), *range(10_008, 10_000, -1))]
    spark.createDataFrame(rows, "doc_id bigint, source string, n_chars bigint").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_names_that_chapters_share_are_pending_once_none_is_made(spark, tmp_path):
    import duckdb

    from inkloom.plans import catalogue

    folder = beyond_five_digits(tmp_path, spark)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = sorted(db.execute(catalogue.SQL["audio_pending"]).fetchall())
    got = sorted(tuple(r) for r in catalogue.audio_pending(spark, folder).collect())
    assert got == want and len({r[:2] for r in got}) < len(got)


def test_chapters_that_share_a_name_lie_in_the_order_of_doc_ids(spark, tmp_path):
    from inkloom.plans import catalogue

    folder = beyond_five_digits(tmp_path, spark)
    names = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("source", catalogue.SPARK_NAME + " AS stem", "doc_id", "2 * n_chars AS n").collect()
    want, at = [], {}
    for corpus, stem, _, n in sorted(names):
        want.append((corpus, stem, n, 44 + at.get(corpus, 0)))
        at[corpus] = at.get(corpus, 0) + n
    assert sorted(tuple(r) for r in catalogue.book_ranges(spark, folder).collect()) == sorted(want)


def test_a_book_is_rows_in_order(spark):
    """Whatever the size of segments, their bytes in order are the file that the wave module writes."""
    texts = {"02": "second", "01": "first", "03": "", "book": "not this"}
    chapters = spark.createDataFrame([("c", s, t) for s, t in texts.items()], "corpus string, stem string, text string")
    for size in (7, 32, 1 << 20):
        segments = audio.synthesize(chapters, lambda t: iter([frames_of(t)] if t else []), size=size)
        assert segments.agg(F.max(F.length("frames"))).first()[0] <= size
        rows = audio.book_of(segments, spark.createDataFrame([("c", "book")], "corpus string, stem string")).orderBy("start").collect()
        data = b"".join(bytes(r["data"]) for r in rows)
        assert data == plain_wav(frames_of("first") + frames_of("second"))
        assert [r["start"] for r in rows] == [sum(len(x["data"]) for x in rows[:k]) for k in range(len(rows))]
        one = audio.in_order(segments.filter("stem = '02'"), ["stem"], "segment").orderBy("start").collect()
        assert b"".join(bytes(r["data"]) for r in one) == plain_wav(frames_of("second"))
    with pytest.raises(ValueError, match="more than a WAV file"):
        audio.wav_header(1 << 32)


def test_files_by_name(spark, tmp_path):
    """Pieces in order, a file a name, replaced when written again; a job that fails leaves nothing."""
    pieces = [(f"d{i % 3}/f{i % 7}", k, f"{i}-{k}\r\n\0é".encode()) for i in range(21) for k in range(4)]
    df = spark.createDataFrame(pieces + [("empty", 0, None), ("d0/f0", 99, b"")], "name string, place int, data binary").repartition(5)
    for _ in range(2):
        sink.write_files(df.withColumn("place2", F.col("data")), str(tmp_path / "out"), F.col("name"), F.col("data"), "place", "place2")
    want = {"empty": b""}
    for name, place, data in sorted(pieces, key=lambda x: (x[0], x[1], x[2])):
        want[name] = want.get(name, b"") + data
    found = lambda at: {os.path.relpath(os.path.join(d, f), at): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(at) for f in fs}
    assert found(tmp_path / "out") == want and not [d for d in os.listdir(tmp_path / "out") if d.startswith(".")]
    bad = df.withColumn("data", F.when((F.col("name") == "d1/f1") & (F.col("place") == 3), F.raise_error(F.lit("broken")).cast("binary")).otherwise(F.col("data")))
    with pytest.raises(Exception, match="broken"):
        sink.write_files(bad, str(tmp_path / "bad"), F.col("name"), F.col("data"), "place")
    assert not os.path.exists(tmp_path / "bad") or found(tmp_path / "bad") == {}
    files.write_texts(spark.createDataFrame([("a", "x\ny"), ("b", "")], "stem string, text string"), str(tmp_path / "texts"))
    assert found(tmp_path / "texts") == {"a.txt": b"x\ny", "b.txt": b""}


def test_a_stream_feeds_a_layer(spark, tmp_path):
    """Once each; a batch that comes again after a failure changes nothing."""
    (tmp_path / "in").mkdir()
    layer = layers.Layer(spark, str(tmp_path / "corpus" / "raw"), chain.LAYERS["raw"])
    rows = lambda d: d.select(F.lit("c").alias("corpus"), "stem", "text")
    go = lambda state: incremental.process_new(incremental.watch_texts(spark, str(tmp_path / "in")), rows, layer, str(tmp_path / state)).awaitTermination()
    (tmp_path / "in" / "a.md").write_text("Text of a.\n")
    go("state")
    go("state")
    (tmp_path / "in" / "b.md").write_text("Text of b.\n")
    go("state")
    assert sorted((r["stem"], r["text"]) for r in layer.read().collect()) == [("a", "Text of a.\n"), ("b", "Text of b.\n")]
    batches = layer.batches()
    go("state again")  # its first batch has the number of one that is committed
    assert layer.batches() == batches
    used = Counted(spark)
    code, _ = chain.run(spark, str(tmp_path / "corpus"), recipe.Recipe("c", "B", prompt="P"), used.tools())
    assert code == chain.OK and used.since() == (2, 2, 3)
    (tmp_path / "in" / "c.md").write_bytes(b"a\xff")
    with pytest.raises(Exception, match="(?i)utf"):
        go("state")


def test_requests_of_a_host_are_bounded(spark):
    """A server that counts the requests at a time, under two names."""
    counts, most, lock = {}, {}, threading.Lock()

    class Counting(BaseHTTPRequestHandler):
        def do_GET(self):
            host = self.headers["Host"]
            with lock:
                counts[host] = counts.get(host, 0) + 1
                most[host] = max(most.get(host, 0), counts[host])
            time.sleep(0.05)
            with lock:
                counts[host] -= 1
            self.send_response(404 if "bad" in self.path else 200)
            self.end_headers()
            self.wfile.write(self.path.encode())

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Counting)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        port = server.server_address[1]
        urls = [f"http://{h}:{port}/{p}{i}" for h in ("127.0.0.1", "localhost") for i in range(12) for p in ("bad" if i == 3 else "page",)]
        got = {r["url"]: (r["body"], r["error"]) for r in files.fetch(spark.createDataFrame([(u,) for u in urls], "url string").repartition(8), files.http_get(9), per_host=2).collect()}
    finally:
        server.shutdown()
    assert len(got) == 24 and sum(e is not None for _, e in got.values()) == 2
    assert all(b == "/" + u.rsplit("/", 1)[1] for u, (b, e) in got.items() if e is None)
    assert set(most.values()) <= {1, 2} and len(most) == 2
    hosts = spark.createDataFrame([("https://U:p@Ex.org:80/a?b@c",), ("x",)], "url string").select(files.host(F.col("url"))).collect()
    assert [r[0] for r in hosts] == ["ex.org:80", ""]


def test_voices_and_devices(spark, tmp_path, monkeypatch):
    class OutOfMemoryError(Exception):
        pass

    asked = []

    def load(device):
        asked.append(device)
        if device == "cuda":
            raise OutOfMemoryError("no room")
        return lambda text: iter([device.encode()])

    assert list(audio.Voice(load, "cuda").speak()("x")) == [b"cpu"] and asked == ["cuda", "cpu"]
    with pytest.raises(OSError):
        audio.Voice(lambda d: (_ for _ in ()).throw(OSError()), "cuda").speak()
    rows = spark.createDataFrame([("a", "x"), ("b", None)], "stem string, text string")

    def full(device):
        if device == "cuda":
            raise MemoryError("no room")
        return lambda text: iter([text.encode() * 2])

    assert sorted((r["stem"], r["segment"], bytes(r["frames"])) for r in audio.synthesize(rows, audio.Voice(full, "cuda")).collect()) == [("a", 0, b"xx"), ("b", 0, b"")]
    planned = audio.synthesize(rows, audio.Voice(full, "cuda"), audio.gpu_profile(0.5))
    assert "gpu" in planned._jdf.queryExecution().executedPlan().toString()


def test_encoder_by_pipes(tmp_path, monkeypatch):
    """A stand-in for ffmpeg, which is not here: it gives back what it is sent, behind its arguments."""
    program = tmp_path / "ffmpeg"
    program.write_text("#!/bin/sh\necho \"$@\"\ncase \"$*\" in *9k*) exit 3;; esac\nexec cat\n")
    program.chmod(program.stat().st_mode | stat.S_IEXEC)
    monkeypatch.setenv("PATH", f"{tmp_path}:{os.environ['PATH']}")
    data = [os.urandom(300_000) for _ in range(20)]
    got = b"".join(audio.encode(iter(data), "libopus", "48k"))
    head, body = got.split(b"\n", 1)
    assert body == b"".join(data) and head == b"-y -loglevel error -i pipe:0 -c:a libopus -b:a 48k -ac 1 -f opus pipe:1"
    with pytest.raises(RuntimeError, match="ended with 3"):
        list(audio.encode(iter(data), "libopus", "9k"))
    with pytest.raises(OSError, match="lost"):
        list(audio.encode((x if k < 3 else (_ for _ in ()).throw(OSError("lost")) for k, x in enumerate(data)), "libopus", "48k"))
    assert list(audio.cut([b"abc", b"", b"defgh"], 3)) == [b"abc", b"def", b"gh"]


def test_papers_from_pdf(spark, tmp_path):
    """A converter in place of the one that is not here; furniture goes, one line feed is added, a second run converts nothing."""
    (tmp_path / "source" / "p").mkdir(parents=True)
    for name in ("one", "two"):
        (tmp_path / "source" / "p" / f"{name}.pdf").write_bytes(name.encode())
    (tmp_path / "source" / "p" / "note.txt").write_text("no")
    used, converted = Counted(spark), spark.sparkContext.accumulator(0)

    def pdf(data):
        converted.add(1)
        return f"## {data.decode()}.\n**26**\nText [3].\n## **REFERENCES**\ngone"

    paper = recipe.Recipe("p", "Papers", "paper", prompt="P")
    for _ in range(2):
        chain.run(spark, str(tmp_path), paper, used.tools(pdf=pdf), ["clean", "audio"])
        c = chain.Chain(spark, str(tmp_path), [paper], used.tools())
        assert sorted((r["stem"], r["text"]) for r in c.read("raw").collect()) == [("one", "## one.\nText .\n"), ("two", "## two.\nText .\n")]
        assert converted.value == 2


def test_model_server(spark):
    """Requests as a server gets them, its answers, and its failures as values of their sections."""
    import json

    from inkloom.operators import model

    class Model(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            ok = "bad" not in asked["prompt"] and self.headers["Content-Type"] == "application/json"
            self.send_response(200 if ok else 500)
            self.end_headers()
            self.wfile.write(json.dumps({"response": f"{asked['system']}: {asked['prompt']}", "done_reason": "stop"}).encode() if ok else b"")

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Model)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        client = model.http_client(f"http://127.0.0.1:{server.server_address[1]}/api/generate", 30)
        docs = spark.createDataFrame([("a", "fine"), ("b", "bad")], "stem string, text string")
        got = {r["stem"]: (r["text"], r["n_failed"]) for r in model.clean_documents(docs, ["stem"], "blog", "S", client, retries=1, sleep=lambda s: None).collect()}
    finally:
        server.shutdown()
    assert got == {"a": ("S: fine", 0), "b": ("[CLEANUP FAILED]\n\nbad", 1)}
