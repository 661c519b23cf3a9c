"""The operators over their given tables, each with its equivalent SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.llm import (
    bpe, editwalk, hardneg, hnsw, licenses, packing, prefix_trie, quotation, rules, simhash, suffixes, toxicity, warc)
from sondar.llm.ship import ship
from sondar.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_texts(docs, public_tokenizers.path("byte_bpe_50k.json"), ids=False)


@_query("op2_warc", """
    with bodies as (
        select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as digest from pages
    ), groups as (select digest, max(page_id) as response from bodies where n >= 1000 group by digest)
    select page_id, cast(n as bigint) as payload_bytes, digest as payload_digest,
           case when response <> page_id then 'revisit' else 'response' end as record_type,
           case when response <> page_id then response end as refers_to
    from bodies left join groups using (digest)""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder, payload=False).drop("url")


@_query("op3_suffix_arrays")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text")
    cut = suffixes.remove_repeats(docs)
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@_query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op5_edit_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editwalk.compare_with_next(table(spark, sf_dir, "documents"))


@_query("op6_hnsw", """
    with recursive sound as (
        select vec_id, label, embedding::double[] as v from embeddings
        where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
          and len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links as (
        select a.vec_id as u, b.vec_id as v from sound a join sound b
        on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
        where list_cosine_similarity(a.v, b.v) >= 0.98
    ), reach as (
        select vec_id as u, vec_id as v from embeddings
        union
        select reach.u, links.v from reach join links on reach.v = links.u
    )
    select e.vec_id, (select count(*) from links where links.u = e.vec_id) as n_links,
           r.component_id, r.component_id = e.vec_id as kept
    from embeddings e join (select u, min(v) as component_id from reach group by u) r on r.u = e.vec_id""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings")).drop("beam", "recall")


@_query("op7_quotations", """
    select conv_id, turn, lag(turn) over w as parent_turn, first_value(turn) over w as root_turn,
           cast(row_number() over w - 1 as integer) as depth, least(row_number() over w - 1, 2) as n_quoted,
           least(row_number() over w - 1, 2) as n_linked, text as body
    from conversations window w as (partition by conv_id order by turn)""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The given messages quote nothing, so they are first made to quote the two before.
    return quotation.threads(quotation.quoting(table(spark, sf_dir, "conversations")))


@_query("op8_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, full=False)


@_query("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    # lpad keeps the zeros that hex leaves out.
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op11_prefix_trie", """
    with turns as (
        select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} order by turn nulls first) as t
        from conversations where conv_id is not null group by conv_id
    ), hashed as (
        select conv_id, t, cast(xor(list_reduce(
            [4294967295] || list_transform(range(1, strlen(cast(conv_id as varchar)) + 1), lambda i: cast(ascii(substr(cast(conv_id as varchar), i, 1)) as bigint)),
            lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)
        ), 4294967295) % 9 as integer) as h from turns
    ), rebuilt as (
        select a.conv_id, coalesce(b.t[1:a.h], []) || a.t[a.h + 1:] as t
        from hashed a left join turns b on b.conv_id = a.conv_id - a.conv_id % 5
    ), nodes as (
        select d as depth, t[1:d] as p, min(conv_id) as conv_id, count(*) as n_convs,
               sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where len(t) = d), '')) as ends_sha256
        from (select conv_id, t, unnest(range(0, len(t) + 1)) as d from rebuilt) group by depth, p
    ), parents as (
        select n.*, u.conv_id as parent_conv_id from nodes n left join nodes u on u.depth = n.depth - 1 and u.p = n.p[1:n.depth - 1]
    ), children as (
        select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n from parents where depth > 0 group by all
    ), counted as (select n.*, coalesce(c.n, 0) as n_children from parents n left join children c using (conv_id, depth))
    select n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children,
           (select count(*) from counted s where s.depth >= n.depth and s.p[1:n.depth] = n.p and s.n_children = 0) as n_leaves,
           (select cast(sum((s.n_convs - 1) * coalesce(strlen(s.p[s.depth].text), 0)) as bigint)
            from counted s where s.depth >= n.depth and s.p[1:n.depth] = n.p) as saved_tokens, n.ends_sha256
    from counted n""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(prefix_trie.with_openings(prefix_trie.keys(table(spark, sf_dir, "conversations"))))


@_query("op12_hard_negatives", """
    with sound as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
               list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
        from embeddings where vec_id is not null and label is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    ), pairs as (
        select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
               cast(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) as bigint) as score
        from sound a join sound b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)
    ), positives as (
        select anchor_id, id as positive_id, score as positive_score from pairs where same
        qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
    )
    select anchor_id, positive_id, cast(row_number() over w as integer) as rank, id as negative_id, positive_score, score as negative_score
    from positives join pairs using (anchor_id)
    where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
    window w as (partition by anchor_id, positive_id order by score desc, id)
    qualify row_number() over w <= 3""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.mine(table(spark, sf_dir, "embeddings"), label=hardneg.relabelled())


@_query("op13_licenses")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(table(spark, sf_dir, "documents"))
