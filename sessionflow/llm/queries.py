"""Registered queries over training data: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.llm import (
    block_search,
    bpe_lexicon,
    chat_windows,
    jump_shards,
    minhash,
    mixing,
    ptolemy_clusters,
    quality_crf,
    suffix_dedup,
    suffix_tree_lm,
    token_align,
    toxicity,
    vector_dedup,
)
from sessionflow.llm.labelled import remainder


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, length=50).select(
        "doc_id",
        F.col("suffix_bytes").alias("n_bytes"),
        F.col("suffix_removed").alias("n_removed"),
        F.col("suffix_spans").alias("n_spans"),
        F.sha2("suffix_kept", 256).alias("kept_sha256"),
    )


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 4) == 2
    model = quality_crf.fit(docs, _read(spark, sf_dir, "labels"), usable=~held_out)
    score = F.col("quality_score")
    return quality_crf.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.7).cast("int").alias("predicted")
    )


#: The vocabulary of the registered encoding.
VOCABULARY = "word_bpe_49k.json"


def op3_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(VOCABULARY)
    lexicon = bpe_lexicon.build_lexicon(docs, path)
    encoded = bpe_lexicon.encode(docs, path, lexicon, with_decoded=True, keep_text=False)
    return encoded.select(
        "doc_id",
        F.col("bpe_tokens").alias("n_tokens"),
        F.sha2("bpe_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("bpe_decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.col("tox_severity").alias("severity"),
        F.col("tox_probability").alias("score"),
        F.col("tox_rejected").alias("toxic"),
    )


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"), width=4)


def op6_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"), 0.98)


def op7_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.scores(_read(spark, sf_dir, "documents"), remainder("doc_id", 5) == 1)


def op8_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_read(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


#: A conversation of control strings only, which the template has to bear.
_CONTROL = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op10_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(_CONTROL, "conv_id long, turn long, role string, text string")
    return chat_windows.digests(chat_windows.windows(rows.unionByName(control)))


#: The vocabularies of the registered alignment.
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = token_align.align(docs, *map(public_tokenizers.path, ALIGNED))
    return token_align.digests(token_align.link_counts(aligned, token_align.pair_counts(aligned)))


def op12_ptolemy_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ptolemy_clusters.clusters(_read(spark, sf_dir, "embeddings"), k=16, rounds=3, size=64, scale=64.0)
    return found.withColumn("centroid_sha256", F.sha2("centroid", 256)).drop("centroid")


#: Shards of the registered sharding.
SHARDS = 24


def op13_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = jump_shards.shard_rows(_read(spark, sf_dir, "documents"), SHARDS)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return sharded.select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("shard_no").alias("shard"),
        F.col("shard_slot").alias("slot"),
        F.col("shard_grown").alias("grown_shard"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, f in globals().items() if n.startswith("op")}


#: Sizes, the running level of the targets, and the running sum of each source in hash order.
_MIX = r"""
with d as (select doc_id, coalesce(source, chr(1114111)) as s,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15))::bigint as h from documents),
t as (select s, sum(size)::bigint as z from d group by s),
w as (select *, [3.0, 1.0, 2.0][(row_number() over (order by s) - 1) % 3 + 1]::double as w from t),
o as (select *, coalesce(sum(2 * z) over (order by 2 * z / w, s rows between unbounded preceding and 1 preceding), 0)::double as stopped,
    sum(w) over () - coalesce(sum(w) over (order by 2 * z / w, s rows between unbounded preceding and 1 preceding), 0) as open,
    1.5 * (sum(z) over ())::double as budget from w),
l as (select *, (budget - stopped) / open as level from o),
m as (select arg_min(level, stopped) as level from l where level * w <= 2 * z),
g as (select l.s, z, least((2 * z)::double, m.level * w) as target from l, m),
c as (select d.*, z, target, case when z > 0 then least(2, floor(target / z)) else 0 end as whole,
    sum(size) over (partition by d.s order by h) as upto from d join g using (s))
select doc_id, size, z as source_size, target, (size * (whole + case when whole < 2
    and upto <= floor(target) - whole * z then 1 else 0 end))::bigint as taken from c
"""


#: Three rounds written out; vectors are lists of whole numbers, each round a table of centroids.
_KEPT = """
with k as (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
    from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
c0 as (select cast(row_number() over (order by sha256('1:' || vec_id) nulls last, v) - 1 as int) as c, v as w from k
    order by c limit 16)"""
_NEAREST = """,
a{i} as (select r, min((d, c)) as best from (select r, c,
    cast(list_sum(list_transform(list_zip(v, w), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint) as d from k, c{i}) group by r)"""
_MEANS = """,
s{i} as (select c, place, sum(x) as s, count(*) as n from (select cast(best[2] as int) as c, unnest(v) as x, generate_subscripts(v, 1) as place
    from k join a{i} using (r)) group by 1, 2),
m{i} as (select c, list(cast((s - ((s % n + n) % n)) // n as bigint) order by place) as w from s{i} group by c),
c{j} as (select c{i}.c, coalesce(m{i}.w, c{i}.w) as w from c{i} left join m{i} using (c))"""
_CLUSTERS = (
    _KEPT
    + "".join(_NEAREST.format(i=i) + _MEANS.format(i=i, j=i + 1) for i in range(3))
    + _NEAREST.format(i=3)
    + """
select vec_id, cast(best[2] as int) as cluster, cast(best[1] as bigint) as distance, cast(sum(best[1]) over (partition by best[2]) as bigint) as cluster_inertia,
    cast(sum(best[1]) over () as bigint) as inertia, sha256(array_to_string(w, ',')) as centroid_sha256
from k join a3 using (r) join c3 on c3.c = best[2]"""
)
#: Vectors that take part, as lists of doubles; sums go from the first component to the last.
_USABLE = """
with recursive v as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
    where len(embedding) = len(list_filter(embedding, lambda x: x is not null and isfinite(x)))
    and len(list_filter(embedding, lambda x: x <> 0)) > 0)"""
_SEARCH = (
    _USABLE
    + """,
p as (select q.vec_id as query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.e, c.e),
    lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) as score
    from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score, vec_id) as rank from p)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 10
"""
)
_SIMILAR = (
    _USABLE
    + """,
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where list_cosine_similarity(a.e, b.e) >= 0.98),
t as (select a, a as b from l union select t.a, l.b from t join l on t.b = l.a),
c as (select a, min(b) as component_id from t group by a),
n as (select a, count(distinct b) as n_links from l group by a)
select vec_id, coalesce(n_links, 0)::bigint as n_links, coalesce(component_id, vec_id)::bigint as component_id,
    coalesce(component_id, vec_id) = vec_id as kept
from embeddings left join c on c.a = vec_id left join n on n.a = vec_id
"""
)


def oracle_sql() -> dict[str, str]:
    return {"op6_vector_dedup": _SIMILAR, "op8_block_search": _SEARCH, "op9_mixing": _MIX, "op12_ptolemy_clusters": _CLUSTERS}
