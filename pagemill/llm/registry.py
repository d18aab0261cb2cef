"""Registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, exact_dedup, html_main_text, language_filters, line_dedup, ngram_jaccard, packing, pii, resampling, spelling, toxicity, warc
from .common import bounded_batches, read_table


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(read_table(spark, sf_dir, "documents"))
    return pii.digest_columns(found).withColumnRenamed("id", "doc_id")


#: Categories of the chain, in its order, over the labels' columns.
CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    chain = toxicity.fit_chain(docs, read_table(spark, sf_dir, "labels"), CATEGORIES)
    return toxicity.scores(docs, chain).withColumnsRenamed({"id": "doc_id", "rejected": "toxic"})


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    cut = line_dedup.without_runs(docs, line_dedup.repeated_runs(docs), "kept_text", "n_removed")
    return cut.select("doc_id", "n_removed", F.length("kept_text").cast("long").alias("n_chars_kept"),
                      F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_file("byte_bpe_50k.json")).withColumnRenamed(
        "id", "doc_id")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents"), public_file("byte_bpe_50k.tiktoken"),
                                  public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))
    return decided.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                          F.lower(F.hex("digest")).alias("text_sha256"))


def op7_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors["vec_id"] % 50 == 0).withColumnRenamed("id", "vec_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    warc.write(read_table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.near_duplicates(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return html_main_text.extract(pages, html_main_text.fit(pages)).withColumnRenamed("id", "page_id")


def _typo(doc_id, run):
    """A run without one code point, for one in 199 of the pairs of document and run."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % 199 == 0, F.concat(F.substring(run, 1, at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(read_table(spark, sf_dir, "documents"), rewrite=_typo)
    return spelling.variants(words)


def op12_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")

    def held_out(doc_id):
        return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2

    filters = language_filters.fit(docs.where(~held_out(F.col("doc_id"))))
    return language_filters.predict(docs, filters).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def _bounded(query):
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {f.__name__: _bounded(f) for f in (op1_pii, op2_line_dedup, op3_best_fit_packing, op4_toxicity, op5_byte_bpe, op6_exact_dedup,
                                   op7_hash_prefix_forest, op8_warc,
                                   op9_ngram_jaccard, op10_main_text, op11_spelling_variants, op12_language_filters,
                                   op13_importance_resampling)}

#: SQL for CRC-32: the table of its 256 bytes, and a state carried over a list of bytes.
_CRC_TABLE = ("list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: "
              "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i))")


def _crc32_sql(text: str, table: str) -> str:
    return f"""xor(4294967295, list_reduce(list_transform(generate_series(1, 2 * strlen({text}) - 1, 2),
                 lambda i: CAST('0x' || substr(hex(encode({text})), i, 2) AS BIGINT)),
                 lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1]), 4294967295))"""


ORACLES = {
    "op13_importance_resampling": rf"""
        WITH crc AS (SELECT {_CRC_TABLE} AS t),
             w AS (SELECT kind, doc_id, row_number() OVER () AS row, regexp_extract_all(
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
                   FROM (SELECT 's' AS kind, doc_id, text FROM documents
                         UNION ALL SELECT 't', item_id, text FROM benchmark)),
             f AS (SELECT kind, row, unnest(flatten(list_transform([1, 2, 3], lambda n: list_transform(
                          range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' '))))) AS feature FROM w),
             c AS (SELECT kind, row, feature, count(*) AS n FROM f GROUP BY ALL),
             b AS (SELECT feature, {_crc32_sql('feature', 't')} % 10000 AS bucket
                   FROM (SELECT DISTINCT feature FROM c), crc),
             totals AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE kind = 's'), 0) AS s,
                               coalesce(sum(n) FILTER (WHERE kind = 't'), 0) AS t FROM c JOIN b USING (feature) GROUP BY bucket),
             gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                                                      / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS gain FROM totals),
             d AS (SELECT row, sum(n) AS n_features, sum(n * gain) AS weight FROM c JOIN b USING (feature)
                   JOIN gains USING (bucket) WHERE kind = 's' GROUP BY row),
             scored AS (SELECT doc_id, len(ws) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
                               coalesce(weight, 0)::BIGINT AS weight,
                               (coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8)
                                AS BIGINT) + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
                        FROM w LEFT JOIN d USING (row) WHERE kind = 's'),
             fit AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
                     FROM scored WHERE n_words >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
        FROM scored LEFT JOIN fit USING (doc_id)""",
    "op11_spelling_variants": rf"""
        WITH RECURSIVE
             crc AS (SELECT {_CRC_TABLE} AS t),
             runs AS (SELECT doc_id, unnest(regexp_extract_all(
                             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
             counted AS (SELECT doc_id, run, count(*) AS n, doc_id || ':' || run AS named FROM runs
                         WHERE length(run) >= 6 GROUP BY ALL),
             hashed AS (SELECT run, n, {_crc32_sql('named', 't')} AS h FROM counted, crc),
             spelt AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT)
                                                         || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
                       FROM hashed),
             vocab AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
             gaps AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS cut, i
                      FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM vocab)),
             pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b
                              ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
                       UNION SELECT g.word, v.word, v.n FROM gaps g JOIN vocab v ON v.word = g.cut
                       UNION SELECT v.word, g.word, g.n FROM gaps g JOIN vocab v ON v.word = g.cut),
             best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
                      FROM pairs GROUP BY word),
             forms AS (SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near,
                              CASE WHEN b.near_n >= 5 * v.n THEN b.near END AS form,
                              CASE WHEN b.near_n >= 5 * v.n THEN b.near_n END AS form_n FROM vocab v LEFT JOIN best b USING (word)),
             chain AS (SELECT word, word AS last, form AS up FROM forms
                       UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.up)
        SELECT word, form, last AS root, n, n_near, form_n FROM forms JOIN (SELECT word, last FROM chain WHERE up IS NULL) USING (word)""",
    "op9_ngram_jaccard": r"""
        WITH RECURSIVE
             w AS (SELECT doc_id, list_filter(regexp_split_to_array(
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
             s AS (SELECT DISTINCT doc_id, unnest(
                          CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ') || chr(10)]
                               ELSE list_transform(generate_series(1, len(ws) - 4),
                                                   lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM w),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x
                        FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
             link AS (SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
                      WHERE 100 * x >= 80 * (na.n + nb.n - x)),
             edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
             reach AS (SELECT doc_id, doc_id AS other FROM documents
                       UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.other)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN n USING (doc_id)""",
    "op2_line_dedup": r"""
        WITH split_lines AS (
               SELECT doc_id, generate_subscripts(x, 1) - 1 AS line, unnest(x) AS raw
               FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
             trimmed AS (SELECT doc_id, line, raw, trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g')) AS t
                         FROM split_lines),
             l AS (SELECT doc_id, line, md5(t) AS h, len(string_split(t, ' ')) AS words,
                          row_number() OVER o AS n,
                          (sum(len(string_split(t, ' '))) OVER o - len(string_split(t, ' ')))::BIGINT AS pos
                   FROM trimmed WHERE t <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY line)),
             grams AS (SELECT *, md5(array_to_string(list(h) OVER s, '')) AS gram, sum(words) OVER s AS size
                       FROM l WINDOW s AS (PARTITION BY doc_id ORDER BY pos RANGE BETWEEN CURRENT ROW AND 24 FOLLOWING)),
             windows AS (SELECT doc_id, pos,
                                list({'gram': gram, 'n': n, 'end': pos + size, 'size': size}) OVER w AS found,
                                sum(words) OVER w AS span
                         FROM grams
                         WINDOW w AS (PARTITION BY doc_id ORDER BY pos RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)),
             marks AS (SELECT DISTINCT doc_id, g.n AS n, g.gram AS gram FROM (
                         SELECT doc_id, list_sort(list_filter(found, lambda x: x.size >= 25 AND x."end" <= pos + span))[1] AS g
                         FROM windows WHERE span >= 50) WHERE g IS NOT NULL),
             firsts AS (SELECT gram, first_value(doc_id) OVER f AS from_doc, first_value(n) OVER f AS from_n, doc_id, n
                        FROM marks WINDOW f AS (PARTITION BY gram ORDER BY doc_id, n)),
             seeds AS (SELECT DISTINCT doc_id, from_doc, n - from_n AS shift, n FROM firsts
                       WHERE doc_id <> from_doc OR n <> from_n),
             same AS (SELECT s.doc_id, s.from_doc, s.shift, a.n,
                             a.n - row_number() OVER (PARTITION BY s.doc_id, s.from_doc, s.shift ORDER BY a.n) AS island
                      FROM (SELECT DISTINCT doc_id, from_doc, shift FROM seeds) s
                      JOIN l a ON a.doc_id = s.doc_id
                      JOIN l b ON b.doc_id = s.from_doc AND b.n = a.n - s.shift AND b.h = a.h),
             hit AS (SELECT DISTINCT doc_id, from_doc, shift, island FROM same JOIN seeds USING (doc_id, from_doc, shift, n)),
             spans AS (SELECT s.doc_id, min(l.line) AS a, max(l.line) AS b FROM same s
                       JOIN hit USING (doc_id, from_doc, shift, island)
                       JOIN l ON l.doc_id = s.doc_id AND l.n = s.n
                       GROUP BY s.doc_id, s.from_doc, s.shift, s.island),
             gone AS (SELECT DISTINCT t.doc_id, t.line, t.t FROM trimmed t
                      JOIN spans p ON p.doc_id = t.doc_id AND t.line BETWEEN p.a AND p.b),
             kept AS (SELECT t.doc_id, string_agg(t.raw, chr(10) ORDER BY t.line) AS x FROM trimmed t
                      ANTI JOIN gone USING (doc_id, line) GROUP BY t.doc_id),
             cut AS (SELECT doc_id, count(*) FILTER (WHERE t <> '') AS n_removed FROM gone GROUP BY doc_id)
        SELECT d.doc_id, coalesce(c.n_removed, 0) AS n_removed,
               CASE WHEN d.text IS NULL THEN NULL ELSE length(coalesce(k.x, '')) END AS n_chars_kept,
               CASE WHEN d.text IS NULL THEN NULL ELSE sha256(coalesce(k.x, '')) END AS kept_sha256
        FROM documents d LEFT JOIN cut c USING (doc_id) LEFT JOIN kept k USING (doc_id)""",
    "op8_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
             d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
             g AS (SELECT *, CASE WHEN payload_bytes >= 100
                                  THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id
                   FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM g""",
    "op6_exact_dedup": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
             d AS (SELECT doc_id, length(x) AS n,
                          sha256(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM t),
             g AS (SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                          first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
                   FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
}
