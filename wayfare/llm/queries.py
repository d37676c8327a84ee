"""The queries of the numbered operators, and their SQL where SQL can say the same."""

from __future__ import annotations

import string

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.bpe import encode_and_decode
from wayfare.llm.common import fresh, in_fold, read
from wayfare.llm.embedding_dedup import near_vectors
from wayfare.llm.exact_dedup import exact_groups
from wayfare.llm.language_id import fit_language_model, predict_language
from wayfare.llm.manifest import COLUMNS, folded, merkle_manifest, proof_digest, row_digest
from wayfare.llm.mixing import mix
from wayfare.llm.quality import fit_quality_model, score_quality
from wayfare.llm.sharding import shard_documents
from wayfare.llm.simhash import near_groups
from wayfare.llm.substring_dedup import drop_repeated_passages
from wayfare.llm.token_count import read_vocabulary, token_counts
from wayfare.llm.warc import read_archives, resolve, write_archives
from wayfare.llm.whitening import whiten
from wayfare.session import work_folder


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    placed, stretches = mix(read(spark, folder, "documents"))
    taken = stretches.groupBy("mark").agg(F.sum("words").alias("words"))
    return placed.join(taken, "mark", "left").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("words", F.lit(0)).alias("taken"), "source"
    )


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as the archives have it."""
    archives = work_folder(spark, "warc")
    write_archives(read(spark, folder, "pages"), archives)
    return resolve(read_archives(spark, archives)).select(
        "page_id",
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("target_page").alias("refers_to"),
        "problem",
    )


OP2_SQL = """
with p as (select page_id, coalesce(html, '') as payload from pages),
d as (select page_id, payload, sha1(payload) as hex, max(page_id) over (partition by payload) as best from p)
select page_id, octet_length(encode(payload))::bigint as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (1 + ((('0x' || substr(hex, ((i // 4) * 5 + 1)::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31))::int, 1)), '')
           as payload_digest,
       case when page_id = best then 'response' else 'revisit' end as record_type,
       case when page_id <> best then best end as refers_to, cast(null as varchar) as problem
from d
"""


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the copy of it that stays."""
    return exact_groups(read(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


OP3_SQL = """
with n as (
    select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
    from documents
)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = max(doc_id) over g as kept, sha256(norm) as text_sha256
from n window g as (partition by norm)
"""

def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens and words of every document under the pieces and scores of a public vocabulary."""
    import public_tokenizers

    vocabulary = read_vocabulary(str(public_tokenizers.path("piece_bpe_32k.model")))
    return token_counts(read(spark, folder, "documents"), *vocabulary).withColumnRenamed("id", "doc_id")


def op5_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector with its links and the smallest identifier that links reach."""
    return near_vectors(read(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


OP5_SQL = """
with recursive v as (
    select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings
),
usable as (
    select *, sqrt(list_dot_product(e, e)) as norm from v
    where label is not null and len(e) > 0 and list_count(e) = len(e)
      and len(list_filter(e, lambda x: not isfinite(x))) = 0 and list_dot_product(e, e) > 0
),
links as (
    select a.vec_id as a, b.vec_id as b from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id
    where list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98
),
reached(vec_id, other) as (
    select vec_id, vec_id from v
    union
    select r.vec_id, l.b from reached r join links l on r.other = l.a
)
select vec_id, (select count(*) from links where a = vec_id) as n_links, min(other) as component_id,
       vec_id = min(other) as kept
from reached group by vec_id
"""


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document, by a model of the labelled rows outside the held-out fold."""
    docs = read(spark, folder, "documents")
    model = fit_quality_model(docs, read(spark, folder, "labels"))
    return score_quality(docs, model).withColumnRenamed("id", "doc_id")


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its fingerprint and the smallest identifier that links reach."""
    return near_groups(read(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every document in sixteen shards of equal row counts."""
    docs = read(spark, folder, "documents")
    shards = shard_documents(docs, work_folder(spark, "shards"))
    text = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    return shards.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col(fresh(docs, "shard")).alias("shard"),
        F.col(fresh(docs, "slot")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, by a model of the rows outside the held-out fold."""
    docs = read(spark, folder, "documents")
    return predict_language(docs, fit_language_model(docs)).withColumnRenamed("id", "doc_id")


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's token ids and the text that they decode to, as digests."""
    import public_tokenizers

    found = encode_and_decode(read(spark, folder, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the words that earlier passages of twenty words or more hold already."""
    return drop_repeated_passages(read(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256")
    )


OP11_SQL = r"""
with d as (
    select row_number() over () as row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents
),
windows as (
    select row_id, doc_id, unnest(list_transform(range(1, len(words) - 18),
        lambda i: {'first': i, 'text': array_to_string(words[i:i + 19], ' ')})) as w
    from d where len(words) >= 20
),
later as (
    select row_id, w.first as start, row_number() over (partition by w.text order by doc_id nulls last, w.first) as turn
    from windows
),
gone as (select row_id, list(distinct place) as places from
    (select row_id, unnest(range(start, start + 20)) as place from later where turn > 1) group by row_id
)
select doc_id, len(words)::bigint as n_words, coalesce(len(places), 0)::bigint as n_removed,
       sha256(coalesce(array_to_string(case when places is null then words else
           list_transform(list_filter(range(1, len(words) + 1), lambda i: not list_contains(places, i)), lambda i: words[i])
       end, ' '), '')) as kept_sha256
from d left join gone using (row_id)
"""


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable vector on the leading components."""
    return whiten(read(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place in the manifest, and whether its text, lower-cased where 3 divides the checksum of its doc_id,
    still leads to the root."""
    docs = read(spark, folder, "documents")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lower).otherwise(F.col("text"))
    claimed = row_digest([altered if c == "text" else F.col(c) for c in COLUMNS])
    found = merkle_manifest(docs, carry={"claimed": claimed})
    found = found.withColumn("folded_root", folded(F.col("claimed"), F.col("path")))
    return found.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


OP13_SQL = """
with recursive crc as (
    select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda x, step:
        case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)) as entries
),
rows as (
    select row_number() over () as row_id, doc_id, source, lang, n_chars, text,
           case when xor(4294967295, list_reduce(list_prepend(4294967295,
                    list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
                    lambda a, b: xor(a >> 8, entries[(xor(a, b) & 255) + 1]))) % 3 = 0
                then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end as altered
    from documents, crc
),
parts as (
    select row_id, doc_id, lang, text, altered,
           coalesce(octet_length(encode(doc_id::varchar)) || ':' || doc_id, '-')
               || coalesce(octet_length(encode(source)) || ':' || source, '-')
               || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
               || coalesce(octet_length(encode(n_chars::varchar)) || ':' || n_chars, '-') as fields
    from rows
),
digests as (
    select row_id, doc_id, lang, sha256(fields || coalesce(octet_length(encode(text)) || ':' || text, '-')) as leaf,
           sha256(fields || coalesce(octet_length(encode(altered)) || ':' || altered, '-')) as claimed
    from parts
),
leaves as (
    select *, row_number() over (partition by lang order by doc_id nulls first, leaf, row_id) - 1 as place,
           count(*) over (partition by lang) as n
    from digests
),
nodes(lang, level, i, n, digest) as (
    select lang, 0, place, n, leaf from leaves
    union all
    select lang, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(digest, '' order by i))
    from nodes where n > 1 group by lang, level, i // 8, n
),
subroots as (
    select lang, digest, row_number() over (order by lang nulls first) - 1 as place, count(*) over () as n
    from nodes where n = 1
),
upper_nodes(level, i, n, digest) as (
    select 0, place, n, digest from subroots
    union all
    select level + 1, i // 8, (n + 7) // 8, sha256(string_agg(digest, '' order by i))
    from upper_nodes where n > 1 group by level, i // 8, n
),
steps as (
    select row_id, level, coalesce(string_agg(digest, '' order by i) filter (i < own), '') as l,
           coalesce(string_agg(digest, '' order by i) filter (i > own), '') as r
    from (
        select leaves.row_id, level, i, digest, place // (8 ** level)::bigint as own
        from leaves join nodes on leaves.lang is not distinct from nodes.lang and nodes.n > 1
            and i // 8 = place // (8 ** (level + 1))::bigint
    ) group by row_id, level, own
    union all
    select row_id, level, coalesce(string_agg(digest, '' order by i) filter (i < own), '') as l,
           coalesce(string_agg(digest, '' order by i) filter (i > own), '') as r
    from (
        select leaves.row_id, 1000 + level as level, i, upper_nodes.digest, subroots.place // (8 ** level)::bigint as own
        from leaves join subroots on leaves.lang is not distinct from subroots.lang
            join upper_nodes on upper_nodes.n > 1 and i // 8 = subroots.place // (8 ** (level + 1))::bigint
    ) group by row_id, level, own
),
paths as (
    select row_id, string_agg(l || r, '' order by level) as proof, list(l || '|' || r order by level) as steps
    from steps group by row_id
),
done as (
    select leaves.*, sha256(coalesce(proof, '')) as proof_sha256,
           list_reduce(list_prepend(claimed, coalesce(steps, [])),
               lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))) as folded_root
    from leaves left join paths using (row_id)
)
select doc_id, leaf, subroots.digest as subroot, upper_nodes.digest as root, proof_sha256, folded_root,
       folded_root = upper_nodes.digest as verified
from done join subroots on done.lang is not distinct from subroots.lang, upper_nodes where upper_nodes.n = 1
"""


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_warc": op2_warc,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_sharding": op8_sharding,
    "op9_language_id": op9_language_id,
    "op10_bpe": op10_bpe,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_merkle_manifest": op13_merkle_manifest,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op2_warc": OP2_SQL,
    "op3_exact_dedup": OP3_SQL,
    "op5_embedding_dedup": OP5_SQL,
    "op11_substring_dedup": OP11_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
