"""The registered queries of the numbered operators over the given tables, and SQL where SQL can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import tidemark
from tidemark.llm import bpe, fingerprint, impact_search, minhash, mixing, periodic_runs, personal_data, quality, substring_dedup, suffix_tree, token_counts, topk, toxicity
from tidemark.llm.labelled import held_out
from tidemark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Words of a text, in DuckDB.
SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever folder they start in."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    root = os.path.dirname(os.path.dirname(os.path.abspath(tidemark.__file__)))
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


def query(name: str, sql: str | None = None):
    def register(run):
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return run(spark, sf_dir)

        QUERIES[name] = prepared
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_substring_dedup",
    f"""
WITH d AS (SELECT doc_id, {SQL_WORDS} AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS seq FROM starts),
firsts AS (SELECT seq, min(doc_id) AS first_doc FROM windows GROUP BY seq),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (seq) WHERE first_doc < doc_id
),
places AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM d),
left_over AS (
  SELECT doc_id, string_agg(words[p], ' ' ORDER BY p) AS kept FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
),
counts AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id) LEFT JOIN counts USING (doc_id)
""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept", "text_sha256")


@query("op3_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(table(spark, sf_dir, "documents"))


@query(
    "op4_near_dedup",
    f"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
),
d AS (SELECT doc_id, {SQL_WORDS} AS words FROM lowered),
sets AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words) - 3, 2)), lambda i: array_to_string(words[i:i + 4], ' '))) AS shingle
  FROM d WHERE len(words) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM sets a JOIN sets b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT u, v FROM common JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v WHERE 100 * common.n >= 75 * (a.n + b.n - common.n)
),
reach AS (SELECT doc_id AS u, doc_id AS v FROM d UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v),
lowest AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)
""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_mixing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


#: The vocabulary has this many tokens, with ids from 0; the next id is free for the end of a document.
COUNT_RANKS = "byte_bpe_multi_50k.tiktoken"
END_OF_DOCUMENT = 50256


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(COUNT_RANKS)
    path = scratch_path(spark, "token-files")
    return token_counts.document_counts(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, END_OF_DOCUMENT, path)


def encoded_and_decoded(docs: DataFrame) -> DataFrame:
    tokenizer = bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    return bpe.encode(docs, tokenizer, decoded=True)


@query("op8_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = encoded_and_decoded(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query(
    "op9_top_k",
    """
WITH finite AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scaled AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM finite),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM scaled q JOIN scaled c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels, apart = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out(2, 4)
    return quality.classified(docs, quality.fit(docs, labels, ~apart), apart)


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels, apart = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out(0, 5)
    return toxicity.classified(docs, toxicity.fit(docs, labels, ~apart), apart)


@query("op6_lm_scoring")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, apart = table(spark, sf_dir, "documents"), held_out(2, 7)
    return suffix_tree.score(docs, ~apart).withColumn("held_out", apart)


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.summarised(periodic_runs.find_runs(periodic_runs.with_periods(table(spark, sf_dir, "documents"))))


SQL_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    "op12_impact_search",
    f"""
WITH d AS (SELECT doc_id, {SQL_TERMS} AS terms FROM documents),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d),
tf AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
postings AS (SELECT doc_id, n, term, count(*) AS tf FROM tf GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term),
wanted AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({SQL_TERMS}) AS term FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN postings USING (term), totals GROUP BY item_id, doc_id
),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_personal_data")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal_data.summarised(personal_data.find_spans(docs, personal_data.fit(docs)))
