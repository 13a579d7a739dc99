"""Registered queries of the corpus operators, and their SQL checks where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake.llm import alignment, bpe, lines, packing, tokenfile, toxicity
from seawake.llm.collocations import collocations
from seawake.llm.common import documents, shared_folder, table
from seawake.llm.embeddings import near_vectors
from seawake.llm.exact import exact_groups
from seawake.llm.languages import languages_of
from seawake.llm.simhash import simhash_components
from seawake.llm.substrings import substring_digests
from seawake.llm.urls import judge


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(documents(spark, folder))


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = shared_folder(spark, "token-files")
    manifest = tokenfile.write_token_files(documents(spark, folder), target, _tokenizer("byte_bpe_50k.json"))
    rows = tokenfile.read_token_files(spark, target, manifest)
    return rows.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(documents(spark, folder), _tokenizer("byte_bpe_50k.json"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return languages_of(table(spark, folder, "pages"), documents(spark, folder))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(packing.pieces(documents(spark, folder), _tokenizer("word_bpe_49k.json")))
    return packed.select(
        F.col("id").alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_digests(documents(spark, folder))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = documents(spark, folder), table(spark, folder, "labels")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out(labels["doc_id"])))
    return toxicity.scores(docs, model).withColumn("held_out", toxicity.held_out(F.col("doc_id")))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages"))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(documents(spark, folder))


def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return lines.line_digests(docs, lines.deduplicated(docs))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment(documents(spark, folder), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(documents(spark, folder))


LLM_QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_token_files": op2_token_files,
    "op3_bpe": op3_bpe,
    "op4_language_id": op4_language_id,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_url_filter": op8_url_filter,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_line_dedup": op11_line_dedup,
    "op12_token_alignment": op12_token_alignment,
    "op13_collocations": op13_collocations,
}

LLM_ORACLES = {
    "op9_exact_dedup": """
        WITH normal AS (
            SELECT doc_id,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
               sha256(t) AS text_sha256
        FROM normal
        WINDOW same AS (PARTITION BY t)
    """,
    "op11_line_dedup": r"""
        WITH texts AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), split AS (
            SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM texts
        ), keyed AS (
            SELECT *, translate(
                trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
            ) AS key
            FROM split
        ), held AS (
            SELECT key, min(doc_id) AS first
            FROM keyed WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) > 1
        ), judged AS (
            SELECT k.doc_id, k.line, k.pos, h.key IS NOT NULL AND k.doc_id <> h.first AS dropped
            FROM keyed k LEFT JOIN held h ON k.key = h.key
        )
        SELECT doc_id,
               count(*) AS n_lines,
               count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op13_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]'
            )) AS piece
            FROM documents
        ), words AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), totals AS (
            SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang
        ), starts AS (
            SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
        ), windows AS (
            SELECT lang, w[i : i + k - 1] AS p, k FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(w)
        ), f AS (
            SELECT lang, p, k, count(*) AS f FROM windows GROUP BY lang, p, k HAVING count(*) >= 100
        ), cuts AS (
            SELECT c.lang, c.p, c.k, c.f AS a, x.f AS l, y.f AS r, n, (1000 * c.f::HUGEINT * n) // (x.f::HUGEINT * y.f) AS score, x.k AS cut
            FROM f c
            JOIN totals t ON c.lang = t.lang
            JOIN f x ON x.lang = c.lang AND x.k < c.k AND x.p = c.p[1 : x.k]
            JOIN f y ON y.lang = c.lang AND y.k = c.k - x.k AND y.p = c.p[x.k + 1 : c.k]
            WHERE c.k > 1
        ), best AS (
            SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) AS nth FROM cuts
        ), inner_parts AS (
            SELECT lang, p[i : i + j - 1] AS p, f FROM (
                SELECT lang, p, k, f, j, unnest(range(1, k - j + 2)) AS i
                FROM f, (SELECT unnest([2, 3, 4]) AS j) WHERE k > j
            )
        ), longer AS (
            SELECT lang, p, max(f) AS f FROM inner_parts GROUP BY lang, p
        ), ranked AS (
            SELECT b.lang, array_to_string(b.p, ' ') AS phrase, a, l, r, n, score,
                   row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.p, ' ')) AS rank
            FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.p = b.p
            WHERE nth = 1 AND (o.f IS NULL OR 100 * o.f < 100 * a)
        )
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
               n::BIGINT AS n, score::BIGINT AS score
        FROM ranked WHERE rank <= 2000
    """,
}
