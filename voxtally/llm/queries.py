"""The corpus operators over the given tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtally.llm import bpe, decontaminate, divergence, hard_negatives, jaccard_join, language, page_text, personal_data, quality, secrets, suffix_tree, token_counts, warc

#: Folder of public vocabulary files; another one may be named in the environment.
TOKENIZERS = os.environ.get("VOXTALLY_TOKENIZERS", "/opt/tokenizers")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    return f"{TOKENIZERS}/{name}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.groups(table(spark, sf_dir, "documents"))


def op3_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op4_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_token_counts(table(spark, sf_dir, "documents"), vocabulary())


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    profiles = language.learn(documents.where(~language.held_out(documents)))
    found = language.identify(documents, profiles)
    return found.select("doc_id", language.held_out(found).alias("held_out"), "lang_pred", "score")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = quality.landed_statistics(table(spark, sf_dir, "documents"))
    trees = quality.learn(counted, table(spark, sf_dir, "labels"))
    return quality.judge(counted, trees).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return personal_data.digests(documents, personal_data.learn(documents))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_page_text": op3_page_text,
    "op4_suffix_tree": op4_suffix_tree,
    "op5_decontamination": op5_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_language": op7_language,
    "op8_secrets": op8_secrets,
    "op9_quality": op9_quality,
    "op10_warc": op10_warc,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_divergence": op12_divergence,
    "op13_personal_data": op13_personal_data,
}

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _worded(key: str, source: str) -> str:
    return f"(select {key}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') as w from {source})"


def _five_word_shingles(key: str, source: str) -> str:
    """Different shingles of each text of a table; a shorter text is one."""
    return f"""(
        select distinct {key}, unnest(case
            when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as shingle
        from {_worded(key, source)})"""


def jaccard_sql(k: int = 4, percent: int = 85) -> str:
    """Sizes and groups of ``documents``, linked where ``percent`` of the runs of ``k`` words are in common."""
    return f"""
        with recursive lowered as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
        worded as (select doc_id, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from lowered),
        gram as materialized (select distinct doc_id, unnest(case
            when len(w) >= {k} then list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))
            when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from worded),
        size as materialized (select doc_id, count(*) as n from gram group by all),
        shared as (select a.doc_id as x, b.doc_id as y, count(*) as s from gram a join gram b on a.g = b.g and a.doc_id <> b.doc_id group by all),
        link as materialized (select x, y from shared join size p on p.doc_id = x join size q on q.doc_id = y where 100 * s >= {percent} * (p.n + q.n - s)),
        reach(doc_id, other) as (select doc_id, doc_id from documents union select reach.doc_id, link.y from reach join link on link.x = reach.other)
        select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id
        from (select doc_id, min(other) as component_id from reach group by all) left join size using (doc_id)
    """


ORACLE_SQL: dict[str, str] = {
    "op2_jaccard_join": jaccard_sql(),
    "op5_decontamination": f"""
        with b as {_five_word_shingles('item_id', 'benchmark')},
        lengths as (select distinct least(5, len(string_split(shingle, ' '))) as k from b),
        d as (select distinct doc_id, array_to_string(w[i:i + k - 1], ' ') as shingle
            from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from {_worded('doc_id', 'documents')}, lengths where len(w) >= k)),
        size as (select item_id, count(*) as n from b group by all),
        shared as (select doc_id, item_id, count(*) as n_shared from d join b using (shingle) group by all)
        select doc_id, item_id, n as n_item_shingles, n_shared, n_shared / n as containment
        from shared join size using (item_id) where 10 * n_shared >= 8 * n
    """,
    "op10_warc": f"""
        with payload as (select page_id, coalesce(html, '') as html from pages),
        hashed as (select page_id, strlen(html) as payload_bytes, cast(cast(unhex(sha1(html)) as bit) as varchar) as bits from payload),
        coded as (
            select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
                substr('{_BASE32}', 1 + cast(list_sum(list_transform(range(5), lambda j:
                    cast(substr(bits, cast(5 * i + j + 1 as int), 1) as int) * (16 >> cast(j as int)))) as int), 1)), '') as payload_digest
            from hashed),
        first as (select *, min(page_id) over (partition by payload_digest) as original from coded)
        select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
            case when page_id = original then 'response' else 'revisit' end as record_type,
            case when page_id <> original then original end as refers_to
        from first
    """,
    "op11_hard_negatives": """
        with given as (select vec_id, label, embedding from embeddings
            where vec_id is not null and label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        v as materialized (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from given),
        scored as materialized (select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
                cast(coalesce(list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])), 0) as bigint) as score
            from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
        positive as (select anchor_id, other_id as positive_id, score as positive_score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
        select anchor_id, positive_id,
            cast(row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as int) as rank,
            other_id as negative_id, positive_score, score as negative_score
        from positive join scored using (anchor_id)
        where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        qualify rank <= 3
    """,
    "op12_divergence": r"""
        with given as materialized (select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
        word as materialized (select doc, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from given),
        kept as materialized (select lang, term, count(*) as n from word group by all having count(distinct doc) >= 3),
        lang_size as (select lang, count(*) as v, sum(n) as n from kept group by all),
        grp as materialized (select distinct lang, source from given),
        counted as materialized (select word.lang, source, term, count(*) as n from word join kept using (lang, term) group by all),
        size as (select grp.lang, grp.source, coalesce(sum(n), 0) as n from grp left join counted using (lang, source) group by all),
        p as materialized (select size.lang, size.source, kept.term, coalesce(counted.n, 0) as n,
                cast(1 + (1000000000::hugeint * (coalesce(counted.n, 0) + 1)) // (size.n + lang_size.v) as bigint) as p,
                cast(1 + (1000000000::hugeint * (kept.n + 1)) // (lang_size.n + lang_size.v) as bigint) as q
            from size join kept on size.lang = kept.lang join lang_size on lang_size.lang = size.lang
            left join counted on counted.lang = size.lang and counted.source = size.source and counted.term = kept.term),
        apart as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
            from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
        pair as (select a.lang, a.source, b.source as item, cast(coalesce(value, 0) as bigint) as value
            from grp a join grp b on a.lang = b.lang and a.source <> b.source
            left join apart on apart.lang = a.lang and apart.source = a.source and apart.item = b.source),
        more as (select lang, source, term as item, (p - q) * (p - q) // q as value from p where n > 0 and p > q)
        select lang, source, 'pair' as part, item, value, cast(row_number() over (partition by lang, source order by value desc, item) as int) as rank from pair
        union all
        select lang, source, 'term' as part, item, value, cast(row_number() over (partition by lang, source order by value desc, item) as int) as rank from more
        qualify rank <= 200
    """,
}
