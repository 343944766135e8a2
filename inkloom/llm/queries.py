"""The queries of this subpackage, each over its whole table, and their DuckDB SQL.

Queries add to an operator's own result only what their contract prints of it: digests,
counts and names. Where an operator has no SQL, its tests hold it against brute force.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.llm import decompose, decontam, exact_dedup, filter_audit, html_text, importance, jaccard_join, line_dedup, packing, pii, quality, substring_dedup, suffix_dedup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents")).drop("row_hash")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.drop_repeated_lines(docs, line_dedup.build_index(docs), indexed=True)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def spelled(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pii_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    n = [F.size(F.filter(F.col("spans")["kind"], F.lit(k).__eq__)).cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select("doc_id", *n, F.sha2(spelled(base), 256).alias("base_sha256"), spelled("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.drop_repeated_phrases(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_hash")


def packed_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    pieces = packing.token_pieces(docs, tokenizer or public_tokenizers.path("word_bpe_49k.json"))
    return packing.best_fit_pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.drop_repeated_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = decompose.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return decompose.number_sequences(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_line_dedup": op4_line_dedup,
    "op5_pii": op5_pii,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_html_text": op10_html_text,
    "op11_filter_audit": op11_filter_audit,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_binary_packing": op13_binary_packing,
}

SQL = {
    "op1_jaccard_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                     ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS own FROM d),
        x AS (SELECT doc_id, len(own) AS n, unnest(own) AS h FROM s),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id
                  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        r AS (SELECT doc_id AS node, doc_id AS other FROM d UNION SELECT r.node, p.b FROM r JOIN pairs p ON r.other = p.a)
        SELECT s.doc_id, CAST(len(s.own) AS BIGINT) AS n_shingles, m.component_id
        FROM s JOIN (SELECT node, min(other) AS component_id FROM r GROUP BY node) m ON s.doc_id = m.node
    """,
    "op2_exact_dedup": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
        k AS (SELECT doc_id, norm, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
              FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
        SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
    """,
    "op4_line_dedup": r"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
        k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        c AS (SELECT key, max(doc_id) AS last_id FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        s AS (SELECT k.doc_id, k.i, k.line, c.key IS NOT NULL AND k.doc_id < c.last_id AS gone FROM k LEFT JOIN c ON k.key = c.key)
        SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM s GROUP BY doc_id
    """,
    "op6_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        w AS (SELECT doc_id, unnest(range(1, len(words) - 11)) AS i, words FROM d WHERE len(words) >= 13),
        p AS (SELECT doc_id, i, array_to_string(words[i : i + 12], ' ') AS phrase FROM w),
        f AS (SELECT phrase, min(doc_id) AS first_id FROM p GROUP BY phrase),
        g AS (SELECT DISTINCT p.doc_id, p.i + unnest(range(13)) AS i FROM p JOIN f USING (phrase) WHERE p.doc_id > f.first_id),
        x AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
        s AS (SELECT x.doc_id, count(*) AS n, count(g.i) AS gone, string_agg(word, ' ' ORDER BY x.i) FILTER (WHERE g.i IS NULL) AS kept
              FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.i = g.i GROUP BY x.doc_id)
        SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN s ON d.doc_id = s.doc_id
    """,
    "op7_decontamination": r"""
        WITH t AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
        w AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM t),
        s AS (SELECT kind, id, len(w) AS n, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END AS own FROM w WHERE len(w) > 0),
        x AS (SELECT kind, id, n, unnest(own) AS h, unnest(range(len(own))) AS p FROM s),
        hits AS (SELECT DISTINCT a.id AS doc_id, a.n, a.p, b.n AS n_words FROM x a JOIN x b ON a.h = b.h WHERE a.kind = 'd' AND b.kind = 'b'),
        starts AS (SELECT DISTINCT doc_id, n_words, unnest(range(greatest(0, p - greatest(1, n_words - 4) + 1), least(p, greatest(0, n - n_words)) + 1)) AS start FROM hits),
        win AS (SELECT doc_id, n_words, start, s.own[start + 1 : start + greatest(1, n_words - 4)] AS own FROM starts JOIN s ON s.kind = 'd' AND s.id = doc_id),
        wh AS (SELECT doc_id, n_words, start, len(own) AS n, unnest(own) AS h FROM win),
        wc AS (SELECT doc_id, n_words, start, n, h, count(*) AS k FROM wh GROUP BY ALL),
        bc AS (SELECT id AS item_id, n AS n_words, h, count(*) AS k FROM x WHERE kind = 'b' GROUP BY ALL),
        sim AS (SELECT doc_id, item_id, n_words, start, sum(least(wc.k, bc.k)) AS shared, n + greatest(1, n_words - 4) AS total
                FROM wc JOIN bc USING (n_words, h) GROUP BY doc_id, item_id, n_words, start, n),
        ok AS (SELECT *, CAST(shared AS DOUBLE) / CAST(total - shared AS DOUBLE) AS similarity FROM sim WHERE 5 * shared >= 4 * (total - shared))
        SELECT doc_id, item_id, similarity, CAST(start AS BIGINT) AS start, CAST(n_words AS BIGINT) AS n_words
        FROM ok QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
    """,
    "op11_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
        f AS (SELECT doc_id, part, (CASE WHEN len(words) < 50 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END)
                  || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END)
                  || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END) || (CASE WHEN doc_id > first_id THEN 'E' ELSE '' END) AS fails FROM w),
        l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
        c AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
        k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM k a, k b, k c, k d, k e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
        q AS (SELECT filter_order, step, substring(filter_order, step, 1) AS own, substring(filter_order, 1, step - 1) AS earlier FROM s),
        r AS (SELECT part, filter_order, step, own, sum(n) FILTER (WHERE fails = '' OR NOT regexp_matches(fails, '[' || earlier || own || ']')) AS kept,
                     sum(n) FILTER (WHERE contains(fails, own) AND (earlier = '' OR translate(fails, earlier, '') = fails)) AS removed,
                     sum(n) FILTER (WHERE contains(fails, own) AND NOT (earlier = '' OR translate(fails, earlier, '') = fails)) AS redundant,
                     sum(n) FILTER (WHERE fails = own) AS unique_fails,
                     sum(good) FILTER (WHERE contains(fails, own) AND (earlier = '' OR translate(fails, earlier, '') = fails)) AS good_lost,
                     sum(toxic) FILTER (WHERE contains(fails, own) AND (earlier = '' OR translate(fails, earlier, '') = fails)) AS toxic_lost
              FROM c, q GROUP BY ALL)
        SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
               CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
               CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
        FROM r
    """,
    "op12_importance_resampling": r"""
        WITH t AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
        x AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM t),
        c AS (SELECT kind, id, word, count(*) AS k FROM (SELECT kind, id, unnest(words) AS word FROM x) GROUP BY ALL),
        crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)) AS step),
        v AS (SELECT word, list_transform(range(CAST(length(hex(encode(word))) / 2 AS BIGINT)), lambda i: CAST('0x' || substring(hex(encode(word)), 2 * i + 1, 2) AS BIGINT)) AS bytes
              FROM (SELECT DISTINCT word FROM c)),
        b AS (SELECT word, xor(list_reduce(list_concat([4294967295], bytes), lambda a, y: xor(step[(xor(a, y) & 255) + 1], a >> 8)), 4294967295) % 10000 AS bucket FROM v, crc),
        n AS (SELECT bucket, sum(k) FILTER (WHERE kind = 'd') AS s, sum(k) FILTER (WHERE kind = 'b') AS t FROM c JOIN b USING (word) GROUP BY bucket),
        a AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM n),
        g AS (SELECT bucket, floor(1000 * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(all_s + 10000 AS DOUBLE)) / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST(all_t + 10000 AS DOUBLE)))) AS gain FROM n, a),
        m AS (SELECT id, floor(CAST(sum(k * gain) AS DOUBLE) / sum(k)) AS weight FROM c JOIN b USING (word) JOIN g USING (bucket) WHERE kind = 'd' GROUP BY id),
        d AS (SELECT x.id AS doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
                     coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substring(sha256('2024:' || x.id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS score
              FROM x LEFT JOIN m ON x.id = m.id WHERE kind = 'd'),
        r AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place,
                     count(*) FILTER (WHERE n_features >= 20) OVER () AS able FROM d)
        SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
               CAST(CASE WHEN place <= 10 * able // 100 THEN place END AS BIGINT) AS rank FROM r
    """,
}
