"""Queries of the operators over their whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careerpanel.llm import bpe, decontam, exact_dedup, hmm, html_text, jaccard, langid, lexical, quality, quality_rules, sharding, spelling, token_counts
from careerpanel.llm.common import fold

RANKS, TOKENIZER = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
SHARDS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def digests(coded: DataFrame) -> DataFrame:
    """The digest columns of ids and decoded texts."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(bpe.bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model, carry={"held_out": held_out}).select("doc_id", "held_out", "lang_pred", "score")


def op5_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 7) == 2
    return hmm.score(docs, hmm.fit(docs.where(~held_out)), carry={"held_out": held_out})


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.document_shards(table(spark, sf_dir, "documents"), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_bpe,
        op3_quality,
        op4_language_id,
        op5_hmm,
        op6_exact_dedup,
        op7_sharding,
        op8_jaccard_join,
        op9_decontamination,
        op10_html_text,
        op11_spelling_variants,
        op12_lexical_search,
        op13_quality_rules,
        pipeline,
    )
}

_PLAIN = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"
_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')"
_TERMS = _WORDS.replace("lower(coalesce(text, ''))", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
_GRAMS = "list_distinct([array_to_string(w[i : i + {n} - 1], ' ') for i in range(1, len(w) - {n} + 2)])"

ORACLE_SQL: dict[str, str] = {
    "op6_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_PLAIN} AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY t)""",
    # items of at least five words, as all of the table are
    "op9_decontamination": f"""
        WITH d AS (SELECT doc_id, unnest({_GRAMS.format(n=5)}) AS g FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
             b AS (SELECT item_id, {_GRAMS.format(n=5)} AS gs FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
             i AS (SELECT item_id, len(gs) AS n, unnest(gs) AS g FROM b)
        SELECT doc_id, item_id, any_value(n) AS n_shingles, count(*) AS n_shared, count(*) / any_value(n) AS containment
        FROM i JOIN d USING (g) GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n)""",
    "op12_lexical_search": f"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS w FROM documents),
             s AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
             i AS (SELECT DISTINCT item_id, text FROM benchmark),
             q AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS t FROM i),
             p AS (SELECT r, any_value(doc_id) AS doc_id, t, count(*) AS tf, any_value(m) AS m
                   FROM (SELECT r, doc_id, unnest(w) AS t, 50 + (50 * len(w) * n) // l AS m FROM d, s)
                   WHERE t IN (SELECT t FROM q) GROUP BY r, t),
             k AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS wt
                   FROM (SELECT t, count(*) AS df FROM p GROUP BY t), s),
             x AS (SELECT item_id, r, any_value(doc_id) AS doc_id,
                          CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
                   FROM q JOIN p USING (t) JOIN k USING (t) GROUP BY item_id, r)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
        WHERE rank <= 50""",
}
