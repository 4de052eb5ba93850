"""The registered query of each corpus operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, exact_dedup, licenses, mixing, near_dedup, neighbours, ngram_join, quality, sentence_pieces, token_files, token_links, vector_codes, word_pieces
from .common import scratch_path, table
from .registry import ORACLES, QUERIES, query
from .vector_codes_sql import comparison_sql as vector_codes_sql

__all__ = ["ORACLES", "QUERIES"]


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ranking = quality.fit(docs, table(spark, sf_dir, "labels"))
    rows = quality.features(docs, ["doc_id"]).select("doc_id", ranking.score().alias("score"))
    return rows.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= quality.CUT_SCORE).cast("int").alias("predicted"))


@query(sql="""
WITH groups AS (
    SELECT coalesce(text, '') AS content, max(doc_id) AS keep_id, count(*) AS group_size
    FROM documents GROUP BY 1
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(g.content) AS text_sha256
FROM documents d JOIN groups g ON coalesce(d.text, '') = g.content
""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


@query()
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query(sql="""
WITH RECURSIVE worded AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), sets AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
    FROM worded
), classes AS MATERIALIZED (
    SELECT min(doc_id) AS class, any_value(shingles) AS shingles, len(any_value(shingles)) AS n, list(doc_id) AS docs
    FROM sets WHERE len(shingles) > 0 GROUP BY list_sort(shingles)
), lines AS MATERIALIZED (
    SELECT class, n, unnest(shingles) AS shingle FROM classes
), links AS MATERIALIZED (
    SELECT a.class AS a, b.class AS b FROM lines a JOIN lines b ON a.shingle = b.shingle AND a.class <> b.class
    GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach(class, seen) AS (
    SELECT class, class FROM classes UNION SELECT r.class, l.b FROM reach r JOIN links l ON r.seen = l.a
), grouped AS (
    SELECT class, min(seen) AS component_id FROM reach GROUP BY class
), members AS (
    SELECT unnest(docs) AS doc_id, class FROM classes
)
SELECT s.doc_id, len(s.shingles) AS n_shingles, coalesce(g.component_id, s.doc_id) AS component_id,
       coalesce(g.component_id, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN members m USING (doc_id) LEFT JOIN grouped g USING (class)
""")
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_groups(table(spark, sf_dir, "documents"))


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_pieces.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), lone_space=True)


@query()
def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents")
    hashed = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("source_sha256"))
    ids = sentence_pieces.encode(hashed, model, ["doc_id", "source_sha256"])
    back = sentence_pieces.decode(ids, model, ["doc_id", "source_sha256", "ids"], out="decoded")
    plain = F.array_join(F.col("ids").cast("array<string>"), " ")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.crc32(plain.cast("binary")).alias("ids_crc32"),
                       F.sha2("decoded", 256).alias("decoded_sha256"), (F.sha2("decoded", 256) == F.col("source_sha256")).alias("exact"))


@query()
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    paths = chat.branches(chat.as_chain(rows.unionByName(extra)))
    return chat.read_back(chat.format_branches(paths)).withColumnRenamed("tree", "conv_id")


@query()
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return token_files.document_index(spark, path)


@query(sql=mixing.comparison_sql() + """
SELECT doc_id, nullif(s, chr(1)) AS source, nullif(l, chr(1)) AS lang, t AS topic, n_words AS n_tokens, chance, drawn FROM rated_docs
""")
def op10_target_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(mixing.WORD)).cast("long")
    rows = mixing.chances(docs, mixing.fit(docs))
    return rows.select("doc_id", "source", "lang", F.col("__topic").alias("topic"), words.alias("n_tokens"),
                       F.col("__chance").alias("chance"), F.col("__drawn").alias("drawn"))


@query()
def op11_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links.align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query(sql="""
WITH RECURSIVE worded AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), sets AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
    FROM worded
), classes AS MATERIALIZED (
    SELECT min(doc_id) AS class, any_value(shingles) AS shingles, len(any_value(shingles)) AS n, list(doc_id) AS docs
    FROM sets WHERE len(shingles) > 0 GROUP BY list_sort(shingles)
), lines AS MATERIALIZED (
    SELECT class, n, unnest(shingles) AS shingle FROM classes
), links AS MATERIALIZED (
    SELECT a.class AS a, b.class AS b FROM lines a JOIN lines b ON a.shingle = b.shingle AND a.class <> b.class
    GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(class, seen) AS (
    SELECT class, class FROM classes UNION SELECT r.class, l.b FROM reach r JOIN links l ON r.seen = l.a
), grouped AS (
    SELECT class, min(seen) AS component_id FROM reach GROUP BY class
), members AS (
    SELECT unnest(docs) AS doc_id, class FROM classes
)
SELECT s.doc_id, len(s.shingles) AS n_shingles, coalesce(g.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN members m USING (doc_id) LEFT JOIN grouped g USING (class)
""")
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


@query(sql=vector_codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))
