import pytest
from pyspark.sql import functions as F

import __spark_entry__
from inkloom.functions import markdown, noise, speech
from inkloom.functions.text import each_match, lines, strip, word_count
from inkloom.operators import audio, model, qa, sections
from inkloom.plans import catalogue
from inkloom.plans import prepare, recipe
from inkloom.sources import files

SPACES = [chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


# Pages and their Markdown.
GOLDEN_PAGES = [
    ("<p>a</p><pre><code>x=1</code></pre><p>b</p>", "a\n```\n```\nb"),
    ("<p>lost<p>kept</p>tail", "kept"),
    ("<ul><li><p>x</p></li><li>y</li></ul>", "x\n- y"),
    ("<blockquote>a<pre>c</pre>d</blockquote>", "```\n```\n> acd"),
    ("<h2>T</h2><p>a</p><h3>Share on  social media:</h3><p>z</p>", "## T\na"),
    ("<div>orphan</div><h2>H</h2>", "## H"),
    ("<h2>use <code>x</code></h2><p>no &lt;b&gt; &amp;amp;</p>", "## use `x`\nno <b> &amp;"),
]


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, t string").coalesce(1)


def column(df, c):
    return [r[0] for r in df.orderBy("id").select(c).collect()]


def test_python_text_rules(spark):
    assert len(SPACES) == 29
    values = [f"{c}a{c}b{c}" for c in SPACES] + ["", "a\r\nb", "a\n", "\n", "a\n\n", "x​y"]
    df = texts(spark, values)
    assert column(df, strip(F.col("t"))) == [v.strip() for v in values]
    assert column(df, lines(F.col("t"))) == [v.splitlines() for v in values]
    assert column(df, word_count(F.col("t"))) == [len(v.split()) for v in values]


SPOKEN = {
    "See https://example.com/a/b.html#x.": "See example dot com slash a slash b dot html hash x.",
    "para one.\n\npara two.": "para one. para two.",
    "line one.\nline two.": "line one.\nline two.",
    "HTTP requests use http2 and HTTP/2.": "requests use http2 and /2.",
    "HTTPS://X.com": "://X.com",
    "(https://a.b/c_d?x=1&y=2).": "(a dot b slash c underscore d question mark x equals 1 ampersand y equals 2).",
    "http://h:8080/~u%20": "h:8080 slash ~u%20",
    "[x](https://a.b/)": "[x](a dot b slash)",
    "http://": "://",
    "see http://... ok": "see ... ok",
}


def test_spoken_urls(spark):
    assert column(texts(spark, SPOKEN), speech.verbalize_urls(F.col("t"))) == list(SPOKEN.values())
    assert column(texts(spark, ["a.\n\nb  c"]), speech.verbalize_urls(F.col("t"), keep_paragraphs=True)) == ["a.\n\nb c"]


def test_matches_are_replaced_in_one_pass(spark):
    """As Python's re.sub does, with any control character anywhere, at the ends, doubled, and in a replacement."""
    import random
    import re

    r, marks = random.Random(4), ["\x00", "\x01", "\x02", "\x01\x02", "\n", "[[a]]", "[[a|b]]", "[[a\x01|\x02b]]", "[[", "]]", "|", "é", "$1", "\\", " "]
    values = ["", "\x01", "[[a]]", "\x01[[a|b]]\x02", "[[a]][[b]]"] + ["".join(r.choice(marks) for _ in range(r.randint(1, 12))) for _ in range(300)]
    swap = lambda m: f"<{m[2] or ''}\x01{m[1]}[[x]]>"
    got = column(texts(spark, values), each_match(F.col("t"), noise.LINK, 2, lambda g: F.concat(F.lit("<"), g[1], F.lit("\x01"), g[0], F.lit("[[x]]>"))))
    assert got == [re.sub(r"\[\[([^\]|]+)(?:\|([^\]]+))?\]\]", swap, v) for v in values]
    assert column(texts(spark, ["a\x01 http://x.y/z b", "\x02", None]), speech.verbalize_urls(F.col("t"))) == ["a\x01 x dot y slash z b", "\x02", None]
    assert column(texts(spark, ["a\x01b [[c\x02|d]] Get\x01 SST", "## 5.1 T\x01\n\nx\x02."]), speech.narration(F.col("t"))) == ["a\x01b [[c\x02|d]] get\x01 ess ess tee.", "Now: section five point one, T\x01.\n\nx\x02."]


def test_pages_to_markdown(spark):
    got = column(texts(spark, [h for h, _ in GOLDEN_PAGES] + [None]), markdown.html_to_markdown(F.col("t")))
    assert got == [m for _, m in GOLDEN_PAGES] + [None]
    assert markdown.to_markdown("<pre>x=1</pre>", keep_code=True) == "```\nx=1\n```"


def test_noise(spark):
    wiki = {"[[A]] [[A|B]] [[A|B#c]] [[A| ]]": "A B A A", "[[X] y": "X y", "a ![d](x.png) b": "a  b", "### H ###": "### H", "##### Author: N\nx": "\nx"}
    assert column(texts(spark, wiki), noise.strip_wiki_noise(F.col("t"))) == list(wiki.values())
    paper = "a[19, 94]<sup>1</sup><br>b\n26:3\n**26**\nAuthors x\n\nkeep\n## **REFERENCES**\ngone"
    assert column(texts(spark, [paper]), noise.strip_paper_noise(F.col("t"))) == ["a b\n\nkeep"]
    assert column(texts(spark, ["My: Book!\nx", "", None, "?!"]), noise.book_stem(F.col("t"), F.lit("n"))) == ["My Book", "n", "n", "n"]
    assert column(texts(spark, ["https://a/b/c//", "x"]), noise.slug_from_url(F.col("t"))) == ["c", "x"]


def test_chunks_keep_everything(spark):
    values = ["", "a" * 30, "a" * 5 + "\n\n" + "b" * 5, "\n\n".join(["p" * 7] * 9), "z" * 50 + "\n\n" + "y"]
    got = column(texts(spark, values), sections.chunks(F.col("t"), 20))
    assert ["\n\n".join(c) for c in got] == values
    assert all(len(c) <= 18 or "\n\n" not in c for v, own in zip(values, got, strict=True) if len(v) > 20 for c in own)
    cut = column(texts(spark, values), sections.chunks(F.col("t"), 20, hard_limit=True))
    assert all(len(c) <= 20 for own in cut for c in own)
    assert ["".join(c).replace("\n", "") for c in cut] == [v.replace("\n", "") for v in values]


def test_report_anchors(spark):
    rows = catalogue.qa_report(spark, "/root/testdata/sf0.01").collect()
    assert [sum(r["flags"] == k for r in rows) for k in range(6)] == [132, 150, 432, 179, 106, 1]
    none = qa.summary(qa.report(*[spark.createDataFrame([], "id int, text string")] * 2, ["id"]), strict=False).first()
    assert (none["files"], none["exit_code"]) == (0, 1)


def test_repeated_lines(spark):
    long = "a line of more than fifteen"
    values = ["\n".join([long] * n) for n in range(6)] + ["\n".join([long, long + "!"] * 3)]
    assert column(texts(spark, values), qa.repeated_lines(qa.stripped_lines(F.col("t")))) == [0, 0, 0, 1, 1, 1, 2]


def test_model_failures():
    for answers, want in (
        ([{"response": "ok"}], ("ok", None, 1)),
        ([{"done_reason": "length"}, {"response": "ok"}], ("ok", None, 2)),
        ([OSError("500")] * 3, (None, "500", 3)),
    ):
        waits, left = [], list(answers)

        def client(_):
            a = left.pop(0)
            if isinstance(a, Exception):
                raise a
            return a

        assert model.attempt(client, {}, 2, waits.append) == want
        assert waits == [2, 4][: want[2] - 1]


def test_blank_documents_stay(spark):
    docs = spark.createDataFrame([("a", " \n"), ("b", ""), ("c", None), ("d", "x")], "stem string, text string")
    out = model.clean_documents(docs, ["stem"], "blog", "", lambda r: {"response": r["prompt"]})
    assert sorted(map(tuple, out.collect())) == [("a", "", 0, 0), ("b", "", 0, 0), ("c", "", 0, 0), ("d", "x", 1, 0)]


def test_requests_follow_the_recipe(spark):
    def client(request):
        assert request["model"] == "m" and request["options"] == {"temperature": 0.7, "num_ctx": 99} and request["think"] is False
        return {"response": request["system"] + request["prompt"]}

    docs = spark.createDataFrame([("a", "one|two")], "stem string, text string")
    out = model.clean_documents(docs, ["stem"], lambda t: F.split(t, r"\|"), "S", client, model="m", temperature=0.7, num_ctx=99, retries=0)
    assert out.first()["text"] == "Sone\n\nStwo"


def test_prepare(spark, tmp_path):
    (tmp_path / "doc.md").write_text("\n".join(map(str, range(1000))))
    path, asked = str(tmp_path / "doc.md"), []
    only = prepare.prepare(spark, path, "new", "P {name}", None)
    assert "P {name}" in only.prompt and "600 lines omitted" in only.prompt and 'named "new"' in only.prompt and only.response is None

    def client(request):
        asked.append(request)
        return {"response": "plan\n```python\nx = 1\n```\n", "done_reason": "length"}

    done = prepare.prepare(spark, path, "new", "P", client, str(tmp_path / "recipes"))
    assert (done.code, done.cut_off, len(asked), asked[0]["options"]["num_ctx"]) == ("x = 1\n", True, 1, 32768)
    assert "system" not in asked[0] and (tmp_path / "recipes" / "new.py").read_bytes() == b"x = 1\n\n" and done.saved.endswith("/new.py")
    assert prepare.prepare(spark, path, "other", "P", lambda r: {"response": "none"}, str(tmp_path / "recipes")).saved is None
    with pytest.raises(FileExistsError):
        prepare.prepare(spark, path, "new", "P", client, str(tmp_path / "recipes"))
    with pytest.raises(OSError):
        prepare.prepare(spark, path, "other", "P", lambda r: (_ for _ in ()).throw(OSError("no")))
    with pytest.raises(ValueError):
        prepare.prepare(spark, "doc.pdf", "x", "P", None)


def test_formats_and_recipes(spark):
    with pytest.raises(ValueError):
        audio.encode_plan(spark.createDataFrame([("c", "a.wav")], "corpus string, name string"), audio.formats(spark), "flac")
    with pytest.raises(ValueError):
        recipe.Recipe("n", "T", "book")
    assert [r["stem"] for r in recipe.manifest(spark, recipe.WIKI).orderBy("stem").collect()][2] == "02_memtable"
    assert recipe.corpora(spark, list(recipe.RECIPES.values())).select("corpus", "title").count() == 3
    assert audio.model_is_loaded(lambda u: '{"models": [1]}') and not audio.model_is_loaded(lambda u: "{}") and not audio.model_is_loaded(lambda u: 1 / 0)


def test_pending(spark):
    raw = spark.createDataFrame([("a",), ("b",), ("c",)], "stem string")
    done = spark.createDataFrame([("b", True), ("c", False)], "stem string, ok boolean")
    assert sorted(r["stem"] for r in model.pending(raw, done, ["stem"]).collect()) == ["a", "c"]


def test_files_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "01_a.md").write_text("one\ntwo")
    (tmp_path / "in" / "02_b.txt").write_text("no")
    found = files.read_texts(spark, str(tmp_path / "in"))
    assert [tuple(r) for r in found.collect()] == [("01_a.md", "01_a", "one\ntwo")]
    assert files.with_needle(found, "2").count() == 0
    (tmp_path / "in" / "03_c.bad").write_bytes(b"a\xff")
    with pytest.raises(Exception, match="(?i)utf"):
        files.read_texts(spark, str(tmp_path / "in"), ".bad").collect()
    got = files.fetch(spark.createDataFrame([("u",), ("bad",)], "url string"), lambda u: {"u": "page"}[u]).collect()
    assert [(r["body"], r["error"] is None) for r in got] == [("page", True), (None, False)]


def test_audio(spark):
    assert audio.encode_command("a.wav", "a.mp3", "libmp3lame", "64k")[-1] == "a.mp3"
    assert audio.choose_device("auto", True, lambda: 2**31, lambda: False, lambda s: None) == "cuda"
    assert audio.choose_device("auto", True, lambda: 0, lambda: False, lambda s: None) == "cpu"


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_queries_have_rows(spark, name):
    assert catalogue.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 200
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
