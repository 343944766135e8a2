"""Queries over the engine's operators, each with SQL that says the same in another engine's words.

The tables have no Markdown, so some queries first put some in by a plain expression that
both sides state alike.
"""

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.functions import blocks, markdown, noise, speech
from inkloom.operators import audio, model, qa, sections
from inkloom.plans import prepare
from inkloom.sources import files
from inkloom.sources.layers import starts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


# -- adapters: the same expression on both sides ---------------------------------------

HALF_OR_THRICE = "CASE WHEN doc_id % 5 = 0 THEN substring(text, 1, CAST(floor(length(text) / 2.0) AS int)) WHEN doc_id % 5 = 1 THEN concat(text, chr(10), text, chr(10), text) ELSE text END"
TAILS = "concat({}, CASE WHEN doc_id % 4 = 0 THEN concat(chr(10), '  12 ') WHEN doc_id % 4 = 1 THEN concat(chr(10), '12345') WHEN doc_id % 4 = 2 THEN concat(chr(10), '| a `b` ](x http') ELSE '' END)"
CLEAN = TAILS.format(HALF_OR_THRICE)
FRAGMENT = """CASE doc_id % 8 WHEN 0 THEN concat('x [[A]] y', chr(1), '[[', chr(2), 'q|', chr(1), 'r]]') WHEN 1 THEN 'x [[A|B]] y [[ C | D e ]]' WHEN 2 THEN concat('x [[A|B#c]] [[F| ]]', chr(2), chr(1)) WHEN 3 THEN '[[A] b' WHEN 4 THEN '![d](x.png) z'
    WHEN 5 THEN concat(chr(10), '### H ###', chr(10), 'z') WHEN 6 THEN concat(chr(10), '##### Author: N', chr(10), 'z') ELSE concat('a[19, 94] b[7]<sup>1</sup><br>c', chr(1), 'd') END"""


#: A line for each rule of page furniture, and one that has such a part within it.
FURNITURE_LINES = ["**26**", "26:3", "S. Dong et al.", noise.FULL_LINES[-1], *[p + " and more" for p in noise.LINE_STARTS], "see " + noise.LINE_PARTS[0] + "/x", "kept 26:3", "kept " + noise.LINE_STARTS[0]]
FURNITURE = "CASE WHEN doc_id % 3 = 0 THEN concat(" + ", ".join(f"chr(10), {sql_text(x)}" for x in FURNITURE_LINES) + ", chr(10), '## **REFERENCES**', chr(10), 'gone') ELSE '' END"
NOISY = f"concat(text, {FRAGMENT}, {FURNITURE})"
NAME = "concat(lpad(CAST(doc_id AS {0}), 5, '0'), '_', CASE doc_id % 5 WHEN 0 THEN 'memtable' WHEN 1 THEN 'transactions' WHEN 2 THEN 'io' WHEN 3 THEN 'iterator' ELSE 'snapshot' END)"
SPARK_NAME, DUCK_NAME = NAME.format("string"), NAME.format("varchar")
HEADINGS = "CASE WHEN {i} = 0 THEN '# ' WHEN {i} % 9 = 1 THEN '## ' WHEN {i} % 9 = 4 THEN '### ' WHEN {i} % 9 = 7 THEN '#### ' ELSE '' END"


def with_headings(docs: DataFrame) -> DataFrame:
    mark = lambda k: F.when(k == 0, "# ").when(k % 9 == 1, "## ").when(k % 9 == 4, "### ").when(k % 9 == 7, "#### ").otherwise("")
    return docs.withColumn("text", F.array_join(F.transform(F.split("text", "\n", -1), lambda x, k: F.concat(mark(k), x)), "\n"))


HEADED = "array_to_string(list_transform(string_split(text, chr(10)), lambda x, j: concat(" + HEADINGS.format(i="(j - 1)") + ", x)), chr(10))"

def sql_literal(x: str) -> str:
    return "concat(" + ", chr(10), ".join("'" + part.replace("'", "''") + "'" for part in x.split("\n")) + ")"


# White space and line ends in RE2's spelling.
WS = r"[\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NWS = WS.replace("[", "[^", 1)
EOL = r"(?:\r\n|[\n\x0B\f\r\x1C-\x1E\x{85}\x{2028}\x{2029}])"


def sql_strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def sql_lines(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN [] ELSE string_split_regex(regexp_replace({x}, '{EOL}$', ''), '{EOL}') END"


def sql_count(x: str, p: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '{p}')) AS BIGINT)"


def sql_residue(x: str) -> str:
    return " + ".join(sql_count(x, p) for p in ("#", r"\*\*", "`", f"(?m)^{WS}*\\|", r"\]\(", "http"))


SQL_CHECKED = f"""
    d AS (SELECT doc_id, {CLEAN} AS clean, text AS raw FROM documents),
    l AS (SELECT doc_id, unnest({sql_lines('clean')}) AS line FROM d),
    s AS (SELECT doc_id, line, {sql_strip('line')} AS st FROM l),
    n AS (SELECT doc_id, count(*) FILTER (WHERE regexp_full_match(line, '{WS}*\\p{{Nd}}{{1,4}}{WS}*')) AS orphan_numbers,
                 count(*) FILTER (WHERE st <> '' AND right(st, 1) NOT IN ('.', '?', '!')) AS dangling_lines FROM s GROUP BY doc_id),
    r AS (SELECT doc_id, count(*) AS repeated_lines FROM (SELECT doc_id, st FROM s WHERE length(st) > 15 GROUP BY doc_id, st HAVING count(*) >= 3) GROUP BY doc_id),
    q AS (SELECT d.doc_id, 'checked' AS status, {sql_residue('clean')} AS md_residue, coalesce(orphan_numbers, 0) AS orphan_numbers, coalesce(dangling_lines, 0) AS dangling_lines,
                 coalesce(repeated_lines, 0) AS repeated_lines, CAST({sql_count('clean', NWS + '+')} AS DOUBLE) / greatest({sql_count('raw', NWS + '+')}, 1) AS word_ratio
          FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN r ON d.doc_id = r.doc_id),
    report AS (SELECT *, CAST(md_residue <> 0 AS BIGINT) + CAST(orphan_numbers <> 0 AS BIGINT) + CAST(dangling_lines <> 0 AS BIGINT) + CAST(repeated_lines <> 0 AS BIGINT)
                 + CAST(NOT word_ratio BETWEEN {qa.RATIO_MIN} AND {qa.RATIO_MAX} AS BIGINT) AS flags FROM q)
"""


# -- quality checks ---------------------------------------------------------------------


@query(f"SELECT doc_id, {', '.join(f'{sql_count('text', p)} AS {n}' for n, p in (('hashes', '#'), ('stars', r'\*\*'), ('ticks', '`'), ('tables', f'(?m)^{WS}*\\|'), ('links', r'\]\('), ('urls', 'http')))}, {sql_residue('text')} AS total FROM documents")
def qa_markdown_residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = dict(zip(("hashes", "stars", "ticks", "tables", "links", "urls"), qa.RESIDUE, strict=True))
    d = documents(spark, sf_dir).withColumn("r", qa.markdown_residue(F.col("text")))
    return d.select("doc_id", *[F.col("r")[p].alias(n) for n, p in names.items()], qa.residue_total(F.col("r")).alias("total"))


@query("SELECT doc_id, CASE WHEN shown = '' THEN '0' ELSE shown END AS residue FROM (SELECT doc_id, concat_ws(', ', " + ", ".join(f"CASE WHEN {sql_count(CLEAN, sql_p)} > 0 THEN concat({sql_text(p)}, '=', {sql_count(CLEAN, sql_p)}) END" for p, sql_p in zip(qa.RESIDUE, ("#", r"\*\*", "`", f"(?m)^{WS}*\\|", r"\]\(", "http"), strict=True)) + ") AS shown FROM documents)")
def qa_residue_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", qa.shown(qa.markdown_residue(F.expr(CLEAN))).alias("residue"))


@query(f"WITH {SQL_CHECKED} SELECT doc_id, orphan_numbers FROM report")
def qa_orphan_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", qa.orphan_numbers(qa.stripped_lines(F.expr(CLEAN))).alias("orphan_numbers"))


@query(f"WITH l AS (SELECT doc_id, unnest({sql_lines('text')}) AS line FROM documents), s AS (SELECT doc_id, {sql_strip('line')} AS st FROM l) SELECT documents.doc_id, count(st) FILTER (WHERE st <> '' AND right(st, 1) NOT IN ('.', '?', '!')) AS dangling_lines FROM documents LEFT JOIN s ON documents.doc_id = s.doc_id GROUP BY documents.doc_id")
def qa_dangling_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", qa.dangling_lines(qa.stripped_lines(F.col("text"))).alias("dangling_lines"))


@query(f"WITH {SQL_CHECKED.replace(CLEAN, 'text')} SELECT doc_id, repeated_lines FROM report")
def qa_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", qa.repeated_lines(qa.stripped_lines(F.col("text"))).alias("repeated_lines"))


@query(f"WITH {SQL_CHECKED} SELECT doc_id, word_ratio FROM report")
def qa_word_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", qa.word_ratio(F.expr(CLEAN), F.col("text")).alias("word_ratio"))


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = documents(spark, sf_dir)
    return qa.report(raw.select("doc_id", F.expr(CLEAN).alias("text")), raw, ["doc_id"])


@query(f"WITH {SQL_CHECKED} SELECT * FROM report")
def qa_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(spark, sf_dir)


@query(f"WITH {SQL_CHECKED} SELECT count(*) AS files, CAST(sum(flags) AS BIGINT) AS flags, CAST(sum(flags) > 0 AS INT) AS exit_code FROM report")
def qa_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.summary(checked(spark, sf_dir))


@query(f"SELECT doc_id, {DUCK_NAME} AS name, regexp_matches({DUCK_NAME}, '{'|'.join(qa.IGNORED)}') AS ignored FROM documents WHERE contains({DUCK_NAME}, '1_')")
def qa_ignore_and_needle(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = documents(spark, sf_dir).select("doc_id", F.expr(SPARK_NAME).alias("name"))
    return named.filter(F.contains("name", F.lit("1_"))).withColumn("ignored", qa.ignored(F.col("name")))


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'no source' ELSE 'checked' END AS status FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id")
def qa_missing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    raw = docs.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return qa.report(docs, raw, ["doc_id"]).select("doc_id", "status")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def idempotent_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.pending(documents(spark, sf_dir).select("doc_id"), table(spark, sf_dir, "labels"), ["doc_id"])


# -- extraction ----------------------------------------------------------------------------


# The page's text is cut at block tags; a piece stays where the next tag closes a block, behind the mark of the tag before it where that opens one.
BLOCKS = "p|li|blockquote|h[1-6]"
SQL_MARKED = "regexp_replace(regexp_replace(article, '(?i)<br[^>]*>', chr(10), 'g'), '(?i)<(/?)(" + BLOCKS + ")(?:\\s[^>]*)?>', concat(chr(1), '\\1\\2', chr(2)), 'g')"
SQL_PLAIN = "regexp_replace(" + "".join("regexp_replace(" for _ in markdown.HIDDEN) + SQL_MARKED + "".join(f", '(?is)<{t}\\b.*?</{t}\\s*>', '', 'g')" for t in markdown.HIDDEN) + ", '<[^>]*>', '', 'g')"


SQL_MARK = """CASE WHEN starts_with(lower(pieces[i]), 'h') THEN concat(repeat('#', CAST(substring(pieces[i], 2, 1) AS INT)), ' ') WHEN starts_with(lower(pieces[i]), 'li') THEN '- ' WHEN starts_with(lower(pieces[i]), 'blockquote') THEN '> ' ELSE '' END"""


def sql_list(values) -> str:
    return "[" + ", ".join(map(sql_text, values)) + "]"


def sql_decoded(x: str) -> str:
    for sign, name in (("<", "lt"), (">", "gt"), ('"', "quot"), ("''", "#39"), ("&", "amp")):
        x = f"replace({x}, '&{name};', '{sign}')"
    return x


@query(f"""
    WITH a AS (SELECT page_id, string_split(regexp_replace(url, '/+$', ''), '/')[-1] AS slug, coalesce(nullif(regexp_extract(html, '(?s)<article[^>]*>.*?</article>'), ''), html) AS article FROM pages),
    s AS (SELECT page_id, slug, string_split({SQL_PLAIN}, chr(1)) AS pieces FROM a),
    b AS (SELECT page_id, slug, list_transform(list_filter(range(1, len(pieces)), lambda i: starts_with(pieces[i + 1], '/')), lambda i: CASE WHEN i = 1 THEN pieces[1] ELSE concat({SQL_MARK}, string_split(pieces[i], chr(2))[2]) END) AS blocks FROM s)
    SELECT page_id, slug, {sql_strip("array_to_string(list_filter(list_transform(blocks, lambda x: " + sql_strip(sql_decoded("x")) + "), lambda x: x <> ''), chr(10))")} AS markdown FROM b
""")
def html_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", noise.slug_from_url(F.col("url")).alias("slug"), markdown.html_to_markdown(F.col("html")).alias("markdown"))


#: Paragraphs of a page as blocks of other kinds, hidden elements, and a footer's heading.
OTHER_TAGS = "p h2 li blockquote h4 h6".split()
OTHER_BLOCKS = "replace(replace(html, '<p>', concat('<script>x</script><time>y</time><', tag, '>')), '</p>', concat('<code>z</code></', tag, '>'))"
FOOTED = f"CASE WHEN page_id % 3 = 0 THEN replace({OTHER_BLOCKS}, '</article>', '<h3>Share on  social media:</h3><p>gone</p></article>') ELSE {OTHER_BLOCKS} END"
SQL_FOOTER = "regexp_matches(lower(x), '^#+ share on\\s+social media:$')"


@query(f"""
    WITH t AS (SELECT page_id, html, {sql_list(OTHER_TAGS)}[page_id % {len(OTHER_TAGS)} + 1] AS tag FROM pages),
    a AS (SELECT page_id, coalesce(nullif(regexp_extract(h, '(?s)<article[^>]*>.*?</article>'), ''), h) AS article FROM (SELECT page_id, {FOOTED} AS h FROM t)),
    s AS (SELECT page_id, string_split({SQL_PLAIN.replace(SQL_MARKED, "regexp_replace(" + SQL_MARKED + ", '</?code>', '`', 'g')")}, chr(1)) AS pieces FROM a),
    b AS (SELECT page_id, list_transform(list_filter(range(1, len(pieces)), lambda i: starts_with(pieces[i + 1], '/')), lambda i: CASE WHEN i = 1 THEN pieces[1] ELSE concat({SQL_MARK}, string_split(pieces[i], chr(2))[2]) END) AS blocks FROM s),
    c AS (SELECT page_id, list_filter(list_transform(blocks, lambda x: {sql_strip(sql_decoded("x"))}), lambda x: x <> '') AS blocks FROM b),
    e AS (SELECT page_id, blocks, list_position(list_transform(blocks, lambda x: {SQL_FOOTER}), true) AS footer FROM c)
    SELECT page_id, {sql_strip("array_to_string(CASE WHEN coalesce(footer, 0) > 0 THEN blocks[1 : footer - 1] ELSE blocks END, chr(10))")} AS markdown FROM e
""")
def html_other_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = F.get(F.lit(OTHER_TAGS), (F.col("page_id") % len(OTHER_TAGS)).cast("int"))
    pages = table(spark, sf_dir, "pages").withColumn("tag", tag)
    return pages.select("page_id", markdown.html_to_markdown(F.expr(FOOTED)).alias("markdown"))


@query("SELECT page_id, string_split(regexp_replace(url, '/+$', ''), '/')[-1] AS slug FROM pages")
def slug_from_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", noise.slug_from_url(F.col("url")).alias("slug"))


def sql_each(x: str, pattern: str, groups: int, body: str) -> str:
    """x with every match of pattern replaced by body, in which g1, g2 ... stand for its groups: gaps and matches, zipped."""
    own = [f"regexp_extract_all({x}, '{pattern}', {i + 1})" for i in range(groups)]
    for i in range(groups):
        body = body.replace(f"g{i + 1}", f"coalesce({own[i]}[j], '')")
    gaps = f"string_split_regex({x}, '{pattern}')"
    return f"array_to_string(list_transform(range(1, len({gaps}) + 1), lambda j: concat({gaps}[j], CASE WHEN j <= len({own[0]}) THEN {body} ELSE '' END)), '')"


SQL_LINK = f"CASE WHEN {sql_strip('g2')} = '' OR contains(g2, '#') THEN {sql_strip('g1')} ELSE {sql_strip('g2')} END"


@query(f"""
    WITH a AS (SELECT doc_id, {NOISY} AS t FROM documents),
    b AS (SELECT doc_id, {sql_each('t', noise.LINK, 2, SQL_LINK)} AS t FROM a),
    c AS (SELECT doc_id, regexp_replace(regexp_replace(t, '\\[\\[([^\\]\\n|]+)\\]([^\\]]|$)', '\\1\\2', 'g'), '!\\[[^\\]]*\\]\\([^)]*\\)', '', 'g') AS t FROM b)
    SELECT doc_id, regexp_replace(regexp_replace(t, '(?m)^({WS}*#{{1,6}}{WS}.*?){WS}*#+{WS}*$', '\\1', 'g'), '(?m)^{WS}*#{{1,6}}{WS}*Author:.*$', '', 'g') AS text FROM c
""")
def wiki_strip_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", noise.strip_wiki_noise(F.expr(NOISY)).alias("text"))


SQL_FURNITURE = " OR ".join([f"regexp_full_match({sql_strip('x')}, {sql_text(p)})" for p in noise.FULL_LINES] + [f"starts_with({sql_strip('x')}, {sql_text(p)})" for p in noise.LINE_STARTS] + [f"contains(x, {sql_text(p)})" for p in noise.LINE_PARTS])


@query(f"""
    WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(replace({NOISY}, '<br>', ' '), '(?s)<sup>.*?</sup>', '', 'g'), '\\[\\p{{Nd}}+(?:{WS}*,{WS}*\\p{{Nd}}+)*\\]', '', 'g') AS t FROM documents),
    b AS (SELECT doc_id, string_split_regex(t, '(?m)^## \\*\\*REFERENCES\\*\\*')[1] AS t FROM a)
    SELECT doc_id, array_to_string(list_filter({sql_lines('t')}, lambda x: NOT ({SQL_FURNITURE})), chr(10)) AS text FROM b
""")
def paper_strip_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", noise.strip_paper_noise(F.expr(NOISY)).alias("text"))


# -- sections and chunks ----------------------------------------------------------------------


def sql_sections(pattern: str) -> str:
    return f"""
    WITH a AS (SELECT doc_id, string_split(regexp_replace({HEADED}, '(?m)^({pattern})', concat(chr(1), '\\1'), 'g'), chr(1)) AS parts FROM documents),
    b AS (SELECT doc_id, list_filter(list_transform(parts, lambda p: {sql_strip('p')}), lambda p: p <> '') AS parts FROM a)
    SELECT doc_id, CAST(unnest(range(len(parts))) AS INT) AS sec_idx, unnest(parts) AS section FROM b
    """


def split_documents(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    d = with_headings(documents(spark, sf_dir))
    return d.select("doc_id", F.posexplode(sections.split_sections(F.col("text"), kind)).alias("sec_idx", "section"))


@query(sql_sections("## "))
def split_paper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_documents(spark, sf_dir, "paper")


@query(sql_sections("#{2,3} "))
def split_blog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_documents(spark, sf_dir, "blog")


@query(sql_sections("#{1,4} ").replace("FROM documents", f"FROM (SELECT doc_id, regexp_replace(h, '(?m)^({WS}*#{{1,6}}{WS}.*?){WS}*#+{WS}*$', '\\1', 'g') AS text FROM (SELECT doc_id, {HEADED} AS h FROM documents))").replace(HEADED + ", '(?m)^(#{1,4} )'", "text, '(?m)^(#{1,4} )'"))
def split_wiki(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_documents(spark, sf_dir, "wiki")


@query(SQL["split_blog"])
def split_by_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sections by a table function."""
    return sections.split_by(with_headings(documents(spark, sf_dir)), lambda text: re.split(r"(?m)^(?=#{2,3} )", text))


@query("""
    WITH RECURSIVE d AS (SELECT doc_id, replace(text, chr(10), concat(chr(10), chr(10))) AS t FROM documents),
    p AS (SELECT doc_id, CASE WHEN length(t) <= 1000 THEN [t] ELSE string_split(t, concat(chr(10), chr(10))) END AS ps FROM d),
    r AS (SELECT doc_id, ps, 1 AS i, 0 AS chunk_idx, length(ps[1]) + 2 AS n FROM p
          UNION ALL SELECT doc_id, ps, i + 1, chunk_idx + CAST(n + length(ps[i + 1]) + 2 > 1000 AS INT),
                           length(ps[i + 1]) + 2 + CASE WHEN n + length(ps[i + 1]) + 2 > 1000 THEN 0 ELSE n END FROM r WHERE i < len(ps))
    SELECT doc_id, chunk_idx, string_agg(ps[i], concat(chr(10), chr(10)) ORDER BY i) AS text FROM r GROUP BY doc_id, chunk_idx
""")
def chunk_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir).withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n\n")))
    return sections.explode_chunks(d, None, 1000).select("doc_id", "chunk_idx", "text")


@query(f"""
    WITH a AS (SELECT doc_id, text, {sql_lines('text')} AS l FROM documents)
    SELECT doc_id, CASE WHEN len(l) <= 5 THEN text ELSE concat(array_to_string(l[1:3], chr(10)), chr(10), chr(10), '... [ ', len(l) - 5, ' lines omitted ] ...', chr(10), chr(10),
        array_to_string(l[len(l) // 2 + 1 : len(l) // 2 + 2], chr(10))) END AS sample FROM a
""")
def sample_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", sections.sample_text(F.col("text"), 3, 2).alias("sample"))


# -- speech ------------------------------------------------------------------------------------


def sql_spoken(x: str) -> str:
    body = f"regexp_replace(regexp_replace({x}, '^https?://', ''), '[.,;:!?)\\]}}''\"]+$', '')"
    for sign, word in speech.SPOKEN_SIGNS:
        body = f"replace({body}, '{sign}', ' {word} ')"
    return sql_strip(f"regexp_replace({body}, '{WS}+', ' ', 'g')")


SQL_URL_TEXT = "concat('See  ', url, ', via', chr(1), ' HTTP or  https. a', chr(2), ' (', url, ').')"
SQL_URL = "(https?://" + WS.replace("[", "[^<>\"''", 1) + "+)"


@query(f"""
    WITH a AS (SELECT page_id, {SQL_URL_TEXT} AS t FROM pages),
    b AS (SELECT page_id, {sql_each('t', SQL_URL, 1, "concat(" + sql_spoken('g1') + ", regexp_extract(g1, '[.,;:!?)\\]}''\"]+$'))")} AS t FROM a)
    SELECT page_id, {sql_strip(f"regexp_replace(regexp_replace(t, '(?i)\\bhttps?\\b', '', 'g'), '{WS}{{2,}}', ' ', 'g')")} AS spoken FROM b
""")
def verbalize_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", speech.verbalize_urls(F.expr(SQL_URL_TEXT)).alias("spoken"))


@query()
def narration_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An approximation of what a prompt asks for; there is nothing to be equal to."""
    return with_headings(documents(spark, sf_dir)).select("doc_id", speech.narration(F.col("text")).alias("spoken"))


#: Lines of documents as Markdown of every kind, by their places.
MARKED_LINE = """CASE (doc_id + {i}) % 12 WHEN 0 THEN concat('- ', x) WHEN 1 THEN concat('2. ', x) WHEN 2 THEN concat('> ', x) WHEN 3 THEN concat('| ', x, ' |') WHEN 4 THEN concat('|', x, '| b | ')
    WHEN 5 THEN concat('```', chr(10), x, chr(10), chr(10), '| c |') WHEN 6 THEN concat(x, chr(10), '```') WHEN 7 THEN concat('Fig. 3: ', x) WHEN 8 THEN concat('$$', chr(10), x, chr(10), '$$', chr(10), '$$ y $$')
    WHEN 9 THEN ' ' WHEN 10 THEN concat('## ', x) ELSE concat('a = b * 2', chr(10), x) END"""
SPARK_MARKED = f"array_join(transform(split(text, '\n', -1), (x, i) -> {MARKED_LINE.format(i='i')}), '\n')"
DUCK_MARKED = f"array_to_string(list_transform(string_split(text, chr(10)), lambda x, j: {MARKED_LINE.format(i='(j - 1)')}), chr(10))"
SQL_KIND = "CASE WHEN fenced THEN 'code' WHEN shown THEN 'equation' WHEN regexp_matches(line, " + sql_text(blocks.BLANK) + ") THEN '' " + " ".join(f"WHEN regexp_matches(line, {sql_text(p)}) THEN '{k}'" for k, p in blocks.KINDS.items()) + " ELSE 'text' END"


@query(f"""
    WITH a AS (SELECT doc_id, string_split({DUCK_MARKED}, chr(10)) AS lines FROM documents),
    l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM a),
    f AS (SELECT *, regexp_matches(line, {sql_text(blocks.FENCE)}) AS fence, sum(CAST(regexp_matches(line, {sql_text(blocks.FENCE)}) AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS fences FROM l),
    g AS (SELECT *, fence OR fences % 2 = 1 AS fenced FROM f),
    d AS (SELECT *, NOT fenced AND regexp_matches(line, {sql_text(blocks.DISPLAY)}) AS display FROM g),
    e AS (SELECT *, sum(CAST(display AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS displays FROM d),
    h AS (SELECT *, display OR (displays % 2 = 1 AND NOT fenced) AS shown FROM e),
    k AS (SELECT *, {SQL_KIND} AS kind, (fence AND fences % 2 = 1) OR (display AND displays % 2 = 1) AS opens, (fence AND fences % 2 = 0) OR (display AND displays % 2 = 0) AS closes FROM h),
    s AS (SELECT *, kind <> '' AND (coalesce(lag(kind) OVER w <> kind, true) OR opens OR lag(closes) OVER w OR kind IN {str(blocks.SINGLE)}) AS begins FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    n AS (SELECT *, sum(CAST(begins AS INT)) OVER (PARTITION BY doc_id ORDER BY i) - 1 AS block FROM s)
    SELECT doc_id, CAST(block AS INT) AS block, min(kind) AS kind, CAST(min(i) AS INT) AS first, CAST(max(i) AS INT) AS last, string_agg(line, chr(10) ORDER BY i) AS text FROM n WHERE kind <> '' GROUP BY doc_id, block
""")
def typed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.explode_blocks(documents(spark, sf_dir).withColumn("text", F.expr(SPARK_MARKED)), ["doc_id"])


def sql_integer_words(x: str) -> str:
    """Digits without leading zeros in words, by groups of three."""
    below = sql_list(["", *map(speech.number_word, range(1, 100))])
    n = f"CAST(ceil(length({x}) / 3.0) AS INT)"
    group = f"CAST(substring(lpad({x}, 3 * {n}, '0'), 3 * i + 1, 3) AS INT)"
    words = f"concat_ws(' ', CASE WHEN {group} >= 100 THEN concat({below}[{group} // 100 + 1], ' hundred') END, nullif({below}[{group} % 100 + 1], ''), nullif({sql_list(speech.SCALES)}[{n} - i], ''))"
    return f"CASE WHEN {x} = '0' THEN 'zero' ELSE array_to_string(list_filter(list_transform(range({n}), lambda i: CASE WHEN {group} = 0 THEN '' ELSE {words} END), lambda g: g <> ''), ' ') END"


COUNTED = "concat('Part ', {a}, ' of ', lang, ' has ', {b}, ' signs, ', {c}, ' x ', {d}, '; ', {b}, '.05, v{a}.2, ', {a}, 'GB.')"
COUNTS = {"a": "CAST(doc_id AS {0})", "b": "CAST(n_chars * 1001 AS {0})", "c": "CAST(n_chars % 1000 AS {0})", "d": "CAST(doc_id * 1000000 + 7 AS {0})"}


@query("WITH t AS (SELECT doc_id, lang, " + ", ".join(f"{c.format('VARCHAR')} AS {n}" for n, c in COUNTS.items()) + ") , w AS (SELECT doc_id, lang, a, " .replace(") , w", " FROM documents), w") + ", ".join(f"{sql_integer_words(n)} AS w{n}" for n in COUNTS)
       + " FROM t) SELECT doc_id, concat('Part ', wa, ' of ', lang, ' has ', wb, ' signs, ', wc, ' times ', wd, '; ', wb, ' point zero five, v', a, '.2, ', a, 'GB.') AS spoken FROM w")
def spoken_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.expr(COUNTED.format(**{n: c.format("string") for n, c in COUNTS.items()}).replace("v" + COUNTS["a"].format("string"), "v', " + COUNTS["a"].format("string") + ", '"))
    return table(spark, sf_dir, "documents").select("doc_id", speech.spoken_numbers(said).alias("spoken"))


TERMS = [short for short, _ in speech.SPELLINGS] + ["LSM", "DB::Get", "write_buffer_size", *speech.KEPT]
SPOKEN_TERMS = [long for _, long in speech.SPELLINGS] + [speech.FIRST_MENTION[1], "DB::Get", "write_buffer_size", *speech.KEPT]


@query(f"SELECT doc_id, concat('The ', {sql_list(SPOKEN_TERMS)}[doc_id % {len(TERMS)} + 1], ' of ', source, ', not ', {sql_list(SPOKEN_TERMS)}[doc_id * 7 % 20 + 1], '.') AS spoken FROM documents")
def spoken_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    term = lambda i: F.get(F.lit(TERMS), i.cast("int"))
    said = F.concat(F.lit("The "), term(F.col("doc_id") % len(TERMS)), F.lit(" of "), "source", F.lit(", not "), term(F.col("doc_id") * 7 % 20), F.lit("."))
    return table(spark, sf_dir, "documents").select("doc_id", speech.spelled(said).alias("spoken"))


def sql_facts(text: str, name: str) -> str:
    """The facts of each section of a text, counted."""
    parts = sql_sections("#{2,3} ").replace("FROM documents", f"FROM (SELECT doc_id, {text} AS text FROM documents)").replace(HEADED + ", '(?m)", "text, '(?m)")
    return f"SELECT doc_id, sec_idx, unnest(regexp_extract_all(section, {sql_text(qa.FACTS)})) AS fact, '{name}' AS side FROM ({parts})"


@query(f"""
    SELECT doc_id, sec_idx, fact, count(*) FILTER (WHERE side = 'raw') AS in_raw, count(*) FILTER (WHERE side = 'clean') AS in_clean
    FROM ({sql_facts(HEADED, 'raw')} UNION ALL {sql_facts(CLEAN.replace('text', HEADED), 'clean')}) GROUP BY doc_id, sec_idx, fact HAVING in_raw <> in_clean
""")
def qa_unfaithful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, names and acronyms of each section that are lost or added where the clean text is cut, tripled or has a tail."""
    raw = with_headings(documents(spark, sf_dir))
    own = lambda d: d.select("doc_id", F.posexplode(sections.split_sections(F.col("text"), "blog")).alias("sec_idx", "text"))
    return qa.unfaithful(own(raw), own(raw.withColumn("text", F.expr(CLEAN))), ["doc_id", "sec_idx"])


@query(f"SELECT page_id, length(html) - length(replace(html, '|', '')) AS bars, {sql_count("concat(chr(10), '```', chr(10), html)", '(?m)^```')} AS code, {sql_count(f"replace(html, '<p>', concat(chr(10), '| '))", '(?m)^[ \t\n\x0B\f\r]*\\|.*\\|[ \t\n\x0B\f\r]*$')} AS tables FROM pages")
def special_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    fenced, tabled = (speech.special_content(c) for c in (F.concat(F.lit("\n```\n"), html), F.replace(html, F.lit("<p>"), F.lit("\n| "))))
    bars = (F.length("html") - F.length(F.replace(html, F.lit("|"), F.lit("")))).cast("long")
    return table(spark, sf_dir, "pages").select("page_id", bars.alias("bars"), fenced["code"].alias("code"), tabled["table"].alias("tables"))


@query("SELECT doc_id, unnest(p) AS paragraph, CAST(unnest(range(len(p))) AS INT) AS idx FROM (SELECT doc_id, list_filter(string_split_regex(text, '\\n+'), lambda x: " + sql_strip("x") + " <> '') AS p FROM documents)")
def tts_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", F.posexplode(sections.spoken_paragraphs(F.col("text"))).alias("idx", "paragraph"))


@query("""
    WITH t AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN '' ELSE trim(regexp_extract(html, '<title>([^<]*)', 1)) END AS title, concat('book', page_id) AS name FROM pages),
    s AS (SELECT page_id, name, trim(regexp_replace(CASE WHEN title = '' THEN name ELSE title END, '[^\\p{L}\\p{N}_ .\\-]+', '', 'g')) AS stem FROM t)
    SELECT page_id, CASE WHEN stem = '' THEN name ELSE stem END AS stem FROM s
""")
def book_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.when(F.col("page_id") % 7 == 0, "").otherwise(F.regexp_extract("html", "<title>([^<]*)", 1))
    return table(spark, sf_dir, "pages").select("page_id", noise.book_stem(title, F.concat(F.lit("book"), "page_id")).alias("stem"))


# -- the model --------------------------------------------------------------------------------------


def echo_client(request: dict) -> dict:
    """In place of a model: gives the section back; one whose length is a multiple of 7 is always cut off."""
    return {"response": request["prompt"], "done_reason": "length" if len(request["prompt"]) % 7 == 0 else "stop"}


BLANK = "CASE WHEN doc_id % 50 = 7 THEN concat(' ', chr(10)) ELSE text END"


@query(f"""
    WITH s AS ({sql_sections('#{2,3} ').replace('FROM documents', f"FROM (SELECT doc_id, {HEADED} AS text FROM documents)").replace(HEADED + ", '(?m)", BLANK + ", '(?m)")})
    SELECT d.doc_id, coalesce(string_agg(CASE WHEN length(section) % 7 = 0 THEN concat({sql_literal(model.FAILED)}, section)
        ELSE {sql_strip(f"regexp_replace(section, '{WS}{{2,}}', ' ', 'g')")} END, concat(chr(10), chr(10)) ORDER BY sec_idx), '') AS text,
        count(section) AS n_sections, count(*) FILTER (WHERE length(section) % 7 = 0) AS n_failed
    FROM documents d LEFT JOIN s ON d.doc_id = s.doc_id GROUP BY d.doc_id
""")
def clean_corpus_fake_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = with_headings(documents(spark, sf_dir)).withColumn("text", F.expr(BLANK))
    return model.clean_documents(d, ["doc_id"], "blog", "", echo_client, max_chars=1_000_000, sleep=lambda s: None)


@query("SELECT doc_id, concat(" + sql_text('{"model":"' + model.MODEL + '","system":"S","prompt":') + ", CAST(to_json(text) AS VARCHAR), " + sql_text(f',"stream":false,"think":false,"options":{{"temperature":{model.TEMPERATURE},"num_ctx":{model.NUM_CTX}}}}}') + ") AS request FROM documents")
def request_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", model.request_json(F.lit("S"), F.col("text")).alias("request"))


@query("""
    SELECT doc_id, n_chars * 1000000 / 1e9 AS prefill_s, length(text) % 3 / 1e9 * 1e9 AS decode_s, n_chars % 100 AS prefill_tokens, CAST(0 AS BIGINT) AS decode_tokens,
           CASE WHEN n_chars = 0 THEN 0.0 ELSE (n_chars % 100) / (n_chars * 1000000 / 1e9) END AS prefill_rate, n_chars % 4 = 0 AS truncated FROM documents
""")
def response_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    fields = F.struct((n * 1000000).alias("prompt_eval_duration"), (F.length("text").cast("long") % 3 * 1000000000).alias("eval_duration"), (n % 100).alias("prompt_eval_count"), F.when(n % 4 == 0, "length").otherwise("stop").alias("done_reason"))
    out = table(spark, sf_dir, "documents").select("doc_id", model.response_timings(F.to_json(fields)).alias("t"))
    return out.select("doc_id", "t.prefill_s", "t.decode_s", "t.prefill_tokens", "t.decode_tokens", "t.prefill_rate", "t.truncated")


@query("SELECT doc_id, concat(" + ", ".join({"n": "concat('corpus-', doc_id)", "s": "text", "p": "'The playbook: {name}, {sample}.'"}.get(p, sql_text(p)) for p in prepare.TEMPLATE.replace("{name}", "\0n\0").replace("{sample}", "\0s\0").replace("{playbook}", "\0p\0").split("\0")) + ") AS prompt FROM documents")
def prepare_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("corpus-"), F.col("doc_id").cast("string"))
    return documents(spark, sf_dir).select("doc_id", prepare.build_prompt(name, F.col("text"), "The playbook: {name}, {sample}.").alias("prompt"))


@query("""
    SELECT page_id, string_split(regexp_replace(url, '/+$', ''), '/')[-1] AS stem, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/?#]*)', 1)) AS host
    FROM pages WHERE contains(url, 'a') AND page_id NOT IN (SELECT page_id FROM pages WHERE page_id % 3 = 0)
""")
def fetch_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is still to be fetched of pages by a part of their URL, with the hosts that are asked."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", noise.slug_from_url(F.col("url")).alias("stem"))
    todo = model.pending(files.with_needle(pages, "a", "url"), pages.filter("page_id % 3 = 0").select("page_id"), ["page_id"])
    return todo.select("page_id", "stem", files.host(F.col("url")).alias("host"))


@query(f"SELECT doc_id, CASE WHEN {sql_strip('t')} = '' THEN source ELSE {sql_strip(f"string_split_regex({sql_strip('t')}, '{EOL}')[1]")} END AS title FROM (SELECT doc_id, source, CASE WHEN doc_id % 9 = 0 THEN concat(' ', chr(10)) ELSE concat(chr(10), chr(9), text) END AS t FROM documents)")
def title_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.expr("CASE WHEN doc_id % 9 = 0 THEN concat(' ', chr(10)) ELSE concat(chr(10), chr(9), text) END")
    return table(spark, sf_dir, "documents").select("doc_id", files.title_of(found, F.col("source")).alias("title"))


@query(f"SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'Base.' ELSE concat('Base.', chr(10), chr(10), {sql_strip('text')}) END AS system FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id")
def system_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base prompt, and its extension where there is one: here the text of the documents that have labels."""
    docs = documents(spark, sf_dir)
    extensions = docs.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi").withColumnRenamed("text", "extension")
    return docs.select("doc_id").join(extensions, "doc_id", "left").select("doc_id", model.prompt(F.lit(" Base.\n"), F.col("extension")).alias("system"))


FENCED = "CASE WHEN turn % 2 = 1 THEN concat('Here:', chr(10), '```python', chr(10), text, CASE WHEN conv_id % 10 = 0 THEN concat(chr(10), '```', chr(10), 'inner', chr(10)) ELSE chr(10) END, '```', chr(10), 'end') ELSE text END"


@query(f"SELECT conv_id, turn, nullif(regexp_extract({FENCED}, '(?s)```python\\s*\\n(.*?)```', 1), '') AS code FROM conversations")
def code_block_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", model.code_block(F.expr(FENCED)).alias("code"))


# -- audio ---------------------------------------------------------------------------------------------


@query(f"""
    WITH n AS (SELECT source AS corpus, {DUCK_NAME} AS stem FROM documents),
    f AS (SELECT corpus, concat(stem, '.wav') AS name FROM n WHERE stem <> concat(corpus, '_book')
          UNION ALL SELECT corpus, concat(corpus, '_book.wav') FROM n GROUP BY corpus HAVING count(*) > 1)
    SELECT corpus, name, 'libopus' AS codec, '48k' AS bitrate, concat(regexp_replace(name, '\\.[^.]*$', ''), '.opus') AS target,
           CAST(row_number() OVER (PARTITION BY corpus ORDER BY name) AS INT) AS position FROM f
""")
def encode_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("corpus"), F.expr(SPARK_NAME).alias("stem"), F.concat("source", F.lit("_book")).alias("book_stem"))
    out = audio.encode_plan(audio.with_books(docs), audio.formats(spark), "opus")
    return out.withColumn("position", F.row_number().over(Window.partitionBy("corpus").orderBy("name")))


@query("SELECT asked, f.codec, coalesce(CAST(f.codec IS NOT NULL AS BOOLEAN), false) AS known FROM (SELECT DISTINCT source AS asked FROM documents UNION SELECT unnest(['mp3', 'opus', 'ogg', 'm4a', 'wav'])) a LEFT JOIN (VALUES " + ", ".join(f"('{f}', '{c}')" for f, c, *_ in audio.FORMATS) + ") f(fmt, codec) ON a.asked = f.fmt")
def encode_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known of the formats asked for; those that are not are errors of a plan."""
    asked = table(spark, sf_dir, "documents").select(F.col("source").alias("asked")).union(spark.createDataFrame([(x,) for x in ("mp3", "opus", "ogg", "m4a", "wav")], "asked string")).distinct()
    known = F.broadcast(audio.formats(spark).select(F.col("fmt").alias("asked"), "codec"))
    return asked.join(known, "asked", "left").select("asked", "codec", F.col("codec").isNotNull().alias("known"))


CHAPTERS = f"source AS corpus, {{name}} AS stem, concat(source, '_book') AS book_stem, CAST(n_chars AS {{string}}) AS made_of"


@query(f"""
    WITH c AS (SELECT {CHAPTERS.format(name=DUCK_NAME, string='VARCHAR')}, doc_id FROM documents),
    done AS (SELECT corpus, stem FROM c WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0 AND corpus <> 'src1'),
    todo AS (SELECT corpus, stem FROM c WHERE corpus <> 'src2' AND (corpus, stem) NOT IN (SELECT corpus, stem FROM done))
    SELECT corpus, stem, false AS is_book FROM todo
    UNION ALL SELECT corpus, concat(corpus, '_book'), true FROM c WHERE corpus <> 'src2' GROUP BY corpus HAVING count(*) > 1
""")
def audio_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters and books that are not encoded as they are now: of a corpus that has all of them, and its book, nothing; where a
    chapter is new or its text has changed, that chapter and the book."""
    own = table(spark, sf_dir, "documents").selectExpr("doc_id", *CHAPTERS.format(name=SPARK_NAME, string="string").replace(", concat(source", "|concat(source").replace(", CAST(n_chars", "|CAST(n_chars").replace("corpus, concat", "corpus|concat").split("|"))
    chapters = own.drop("doc_id")
    older = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("-"), "made_of")).otherwise(F.col("made_of"))
    made = own.filter("doc_id % 3 <> 0 AND corpus <> 'src1'").select("corpus", "stem", older.alias("made_of"))
    whole = audio.works(chapters.filter("corpus = 'src2'")).drop("is_book")
    return audio.unmade(audio.works(chapters), made.unionByName(whole)).drop("made_of")


@query(f"""
    WITH c AS (SELECT source AS corpus, {DUCK_NAME} AS stem, 2 * n_chars AS n_bytes FROM documents)
    SELECT corpus, stem, n_bytes, CAST(44 + coalesce(sum(n_bytes) OVER (PARTITION BY corpus ORDER BY stem ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM c
""")
def book_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each chapter's frames lie in the file of its corpus's book. Chapters that share a name, which the SQL leaves in any order, go by doc_id."""
    chapters = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("corpus"), F.expr(SPARK_NAME).alias("stem"), (2 * F.col("n_chars")).alias("n_bytes"))
    return starts(chapters, ["corpus"], ["stem", "doc_id"], "n_bytes").drop("doc_id").withColumn("start", F.col("start") + audio.HEADER_BYTES)
