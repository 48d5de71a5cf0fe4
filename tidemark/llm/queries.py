"""Registered queries of the operators: each over its whole table, by its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    balltree,
    bpe,
    chat,
    debruijn,
    language_ecoc,
    minhash,
    mixing,
    neighbours,
    quality_pu,
    rules_forest,
    sharding,
    style_tree,
    suffix_dedup,
)
from tidemark.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

PREDICTED = 0.3


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(prepare(spark, folder), folder)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return function

    return register


def rank_file() -> tuple[str, str]:
    """Path and pattern of the vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@query("op1_quality")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    scored = quality_pu.score_quality(docs, labels)
    return scored.withColumn("predicted", (F.col("score") >= PREDICTED).cast("int"))


@query("op2_html")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return style_tree.extract(table(spark, folder, "pages"))


@query("op3_language")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = language_ecoc.learn_and_identify(table(spark, folder, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query("op4_bpe")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest(table(spark, folder, "documents"), *rank_file(), ["doc_id"])


@query("op5_mix")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query("op6_rules")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return rules_forest.judge(docs, table(spark, folder, "labels").select("doc_id", "quality"))


@query("op7_suffix")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"))


@query(
    "op8_chat",
    r"""
    with turns as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
      union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
      union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    escaped as (
      select *,
        regexp_replace(regexp_replace(regexp_replace(text, '&(amp|lt|#91|#10);', '&amp;\1;', 'g'),
          '<(\||/?s>|/?<?/?SYS>|start_of_turn>|end_of_turn>)', '&lt;\1', 'g'), '\[(/?INST\])', '&#91;\1', 'g') as safe,
        lag(role) over w is not distinct from role as joins
      from turns window w as (partition by conv_id order by turn nulls first, role, text))
    select conv_id, count(*) as n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
      coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
      sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
      sum(length(safe) + case when joins then length('<|im_sep|>')
        else length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1 end)::bigint as formatted_chars
    from escaped group by conv_id
    """,
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    told = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], told.schema)
    return chat.digest(chat.format_conversations(told.union(extra)))


@query("op9_minhash")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), size=3, similar=85)


@query("op10_neighbours")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


@query("op11_shards")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.digest(table(spark, folder, "documents"))


SEARCH_SQL = r"""
    with words as (
      select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
    lengths as (select doc_id, count(*) as n from words group by doc_id),
    sums as (select count(*)::bigint as docs, sum(n)::bigint as all_terms from lengths),
    asked as (
      select item_id, term, count(*) as times from (
        select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark) group by all),
    counted as (select doc_id, term, count(*) as tf from words semi join asked using (term) group by all),
    weights as (
      select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w
      from counted, sums group by term),
    scored as (
      select item_id, doc_id,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // all_terms))))::bigint as score
      from counted join weights using (term) join lengths using (doc_id) join asked using (term), sums
      group by all),
    ranked as (
      select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
    select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""


@query("op12_search", SEARCH_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return balltree.rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_phrases")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return debruijn.collocations(table(spark, folder, "documents"))
