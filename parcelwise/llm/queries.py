"""The registered queries: each operator over the whole of its table."""

from __future__ import annotations

import public_tokenizers as vocab
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, bpe, fingerprints, html_text, importance, line_runs, maxent, minhash
from . import packing, passages, pseudonyms, ranked, vectors
from ..sources.scratch import Scratch

#: Callers pass a secret of their own; this one makes the registered query repeatable.
PII_KEY = "registered-query"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def gpt_tokenizer():
    """The vocabulary of byte_bpe_50k.json, from its rank file."""
    return packing.byte_bpe(vocab.path("byte_bpe_50k.tiktoken"), vocab.PATTERN,
                            {"<|endoftext|>": 50256})


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"),
                                   Scratch(spark, "minhash").save, size=4)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), gpt_tokenizer())


def op3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"),
                                Scratch(spark, "vectors").save)


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)
    return found.select("doc_id", "text", *[
        F.col(f"pii_counts.{k}").alias(f"n_{k}") for k in pseudonyms.KINDS])


def op5_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "labels"),
                               Scratch(spark, "importance").save)


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(table(spark, sf_dir, "documents"),
                                   Scratch(spark, "passages").save)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"),
                          vocab.path("byte_bpe_multi_50k.tiktoken"), vocab.PATTERN)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents"))


def op10_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents"), Scratch(spark, "maxent").save)


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                         Scratch(spark, "ranked").save)


def op12_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_runs.without_frequent(table(spark, sf_dir, "documents"),
                                      Scratch(spark, "lines").save)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def two_tokenizers() -> tuple[alignment.Side, alignment.Side]:
    return (alignment.byte_level(vocab.path("byte_bpe_50k.json"), vocab.PATTERN),
            alignment.pieces(vocab.path("piece_bpe_32k.model")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.meetings(table(spark, sf_dir, "documents"),
                              Scratch(spark, "alignment").save, two_tokenizers)


QUERIES = {f.__name__: f for f in (
    op1_minhash, op2_packing, op3_vectors, op4_pseudonyms, op5_importance, op6_passages,
    op7_bpe, op8_html_text, op9_fingerprints, op10_maxent, op11_ranked,
    op12_line_runs, op13_alignment)}
ORACLE_SQL: dict[str, str] = {
    "op11_ranked": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
            FROM documents),
        total AS (
            SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
        asked AS (
            SELECT item_id, term, count(*) AS repeats FROM (
                SELECT item_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
            GROUP BY ALL),
        held AS (
            SELECT r, doc_id, n, term, count(*) AS tf FROM (
                SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d)
            WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
        weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT
                AS w
            FROM held, total GROUP BY term, n_docs),
        scored AS (
            SELECT item_id, r, doc_id, sum(repeats * w * ((1000000000 * tf)
                // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN held USING (term), total
            GROUP BY ALL)
        SELECT item_id, rank, doc_id, score FROM (
            SELECT *, row_number() OVER (
                PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
            FROM scored WHERE score > 0)
        WHERE rank <= 20""",
    "op12_line_runs": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                string_split(coalesce(text, ''), chr(10)) AS lines
            FROM documents),
        l AS (
            SELECT r, place, lines[place] AS line, translate(
                regexp_replace(lines[place], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM (SELECT r, lines, unnest(range(1, len(lines) + 1)) AS place FROM d)),
        frequent AS (
            SELECT k FROM l WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10),
        kept AS (
            SELECT r, string_agg(line, chr(10) ORDER BY place) AS t, count(*) AS n
            FROM l WHERE k NOT IN (SELECT k FROM frequent) GROUP BY r)
        SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT
            AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)""",
}
