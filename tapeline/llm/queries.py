"""The queries of this package and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapeline.llm.common import table


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies on this machine (and on every executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.llm.packing import best_fit_packing

    return best_fit_packing(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.llm.line_dedup import line_dedup

    return line_dedup(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.llm.license_scan import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.llm.bpe_codec import round_trip

    return round_trip(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"), pattern())


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.llm.importance import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.llm.sstable import token_shards

    return token_shards(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op9_ngram_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.llm.ngram_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), pairs=True)


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op9 that SQL can express, without the likelihood ratio."""
    rules = op9_ngram_quality_rules(spark, sf_dir)
    return rules.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.llm.topk import exact_top_k

    return exact_top_k(table(spark, sf_dir, "embeddings"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.llm.jaccard_join import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents"))


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.llm.target_resampling import target_resample

    return target_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.llm.vector_codes import vector_codes

    return vector_codes(table(spark, sf_dir, "embeddings"))


def vector_codes_sql(rounds: int = 4) -> str:
    """op13 in SQL: a table of codebooks (b) and one of nearest entries (n) for each round."""

    def nearest(k: int) -> str:
        return f"""n{k} as (select i, p, a // 256 as d, a % 256 as e from (
            select i, p.p, min(256 * cast(xx - 2 * list_dot_product(x, c) + cc as hugeint) + e) as a from p join b{k} b on p.p = b.p group by i, p.p))"""

    steps = [nearest(0)]
    for k in range(rounds):
        steps.append(f"""m{k} as (select p, e, list(s order by j) as c from (
            select n.p, n.e, j, floor(sum(x[j]) / count(*)) as s from n{k} n join p on n.i = p.i and n.p = p.p, unnest(range(1, len(x) + 1)) as t(j) group by n.p, n.e, j) group by p, e)""")
        steps.append(f"""b{k + 1} as (select p, e, c, list_dot_product(c, c) as cc from (select b.p, b.e, coalesce(m.c, b.c) as c from b{k} b left join m{k} m on b.p = m.p and b.e = m.e))""")
        steps.append(nearest(k + 1))
    return f"""
        with k as (select row_number() over (order by vec_id, embedding) as i, vec_id, label, list_transform(embedding, lambda y: floor(1024 * cast(y as double))) as v
                   from embeddings where embedding is not null and list_bool_and(list_transform(embedding, lambda y: y is not null and isfinite(y)))),
        p as (select i, p, x, list_dot_product(x, x) as xx from (select i, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] as x from k, unnest(range(4)) as t(p))),
        b0 as (select p, i - 1 as e, x as c, xx as cc from p where i <= 256),
        {", ".join(steps)},
        h as (select sha256(string_agg(cast(cast(c[j] as bigint) as varchar), ',' order by p, e, j)) as s from b{rounds}, unnest(range(1, len(c) + 1)) as t(j)),
        o as (select i, string_agg(printf('%02x', cast(e as bigint)), '' order by p) as code, cast(sum(d) as bigint) as error from n{rounds} group by i)
        select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, h.s as codebooks_sha256 from o join k using (i), h"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_line_dedup,
        op3_license_scan,
        op4_bpe_round_trip,
        op5_importance_resampling,
        op6_token_shards,
        op7_simhash_near_dedup,
        op8_token_counts,
        op9_ngram_quality_rules,
        op10_exact_top_k,
        op11_jaccard_join,
        op12_target_resampling,
        op13_vector_codes,
        quality_base_counts,
    )
}

ORACLES: dict[str, str] = {
    "quality_base_counts": r"""
        with w as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
        g as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w where len(ws) >= 3)),
        again as (select doc_id, i from g qualify count(*) over (partition by doc_id, g) > 1),
        covered as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from again) group by doc_id),
        c as (select w.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as bigint) as word_chars,
                     cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
                     list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines, cast(coalesce(covered.n, 0) as bigint) as n_repeat_words
              from w left join covered using (doc_id))
        select doc_id, n_words, word_chars, n_symbols, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, n_repeat_words,
               n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c""",
    "op10_exact_top_k": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v
                   from embeddings
                   where vec_id is not null and embedding is not null
                     and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
        s as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
              from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id and len(q.v) = len(c.v))
        select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
        from s qualify rank <= 20""",
    "op11_jaccard_join": r"""
        with w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
        k as (select doc_id, case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')]
                     else list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) end as ks from w),
        t as (select doc_id, len(ks) as n, unnest(ks) as s from k),
        c as (select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as o from t a join t b on a.s = b.s and a.doc_id < b.doc_id and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) group by all),
        l as (select a, b from c where 100 * o >= 90 * (na + nb - o)),
        e as (select a, b from l union all select b, a from l),
        r as (with recursive reach(x, y) as (select a, b from e union select reach.x, e.b from reach join e on reach.y = e.a) select x, min(y) as y from reach group by x)
        select doc_id, cast(len(ks) as bigint) as n_shingles, cast(least(doc_id, coalesce(y, doc_id)) as bigint) as component_id,
               case when len(ks) = 0 then 1 else count(*) over (partition by list_sort(ks)) end as class_size from k left join r on x = doc_id""",
    "op13_vector_codes": vector_codes_sql(),
}
