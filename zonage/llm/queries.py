"""Registered queries of the subpackage, one per operator, with DuckDB SQL
where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonage.session import read_table

from . import (bpe, centroids, decontaminate, exact_dedup, jaccard_join, licences, lm_score, negatives, quality, secrets,
               suffix_dedup, token_counts, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


@register("op7_exact_dedup", """
with t as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as h
           from documents),
g as (select h, max(doc_id) as keep_id, count(*) as group_size from t group by h)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, h as text_sha256 from t join g using (h)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return exact_dedup.exact_dedup(docs, extra={"text_sha256": F.sha2(F.col("_norm"), 256)})


_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""


@register("op5_decontaminate", f"""
with d as (select doc_id, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark),
bw as (select distinct item_id, list_aggregate(w[i + 1 : i + 10], 'string_agg', ' ') as win, least(len(w), 10) as n
       from b, unnest(range(0, greatest(len(w) - 10, 0) + 1)) as u(i) where len(w) > 0),
ns as (select distinct n from bw),
dw as (select doc_id, i, n, list_aggregate(w[i + 1 : i + n], 'string_agg', ' ') as win
       from (select doc_id, w, n, unnest(range(0, len(w) - n + 1)) as i from d, ns where len(w) >= n)),
h as (select doc_id, i, dw.n, item_id from dw join bw using (win) where dw.n = bw.n),
c as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(i, i + n)) as p from h) group by doc_id),
k as (select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as items
      from (select distinct doc_id, item_id::varchar as s from h) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (doc_id) left join k using (doc_id)
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"),
                                        read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@register("op9_byte_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.encode_and_decode(read_table(spark, sf_dir, "documents"), path, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(read_table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


def _held_out(folds: int, fold: int):
    """Whether a row isn't learnt from; rows without an id never are."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(True)).alias("held_out")


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Machine:
    """Fitted on labels of rows whose crc32(doc_id as text) mod 3 is not 1."""
    labels = read_table(spark, sf_dir, "labels")
    ours = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    return quality.train(read_table(spark, sf_dir, "documents"), ours)


@register("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.scores(read_table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    return scores.select("doc_id", _held_out(3, 1),
                         "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@register("op4_jaccard_join", r"""
with recursive d as (select doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as materialized (select distinct doc_id, array_to_string(w[i + 1 : i + 5], ' ') as g
    from d, unnest(range(0, greatest(len(w) - 4, 1))) as u(i) where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select x.doc_id as a, y.doc_id as b, count(*) as k from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by all),
l as materialized (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
e as (select a, b from l union all select b, a from l),
c(doc_id, root) as (select a, a from e union select e.b, c.root from c join e on c.doc_id = e.a),
r as (select doc_id, min(root) as root from c group by doc_id)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(root, d.doc_id) as component_id
from d left join n using (doc_id) left join r using (doc_id)
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_components(read_table(spark, sf_dir, "documents"))


@register("op2_secrets")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(secrets.written(base), 256).alias("base_sha256"),
                        secrets.written(F.col("spans")).alias("spans"))


@register("op6_suffix_dedup", """
with d as materialized (select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, '')))::bigint as n from documents),
w as (select doc_id, i, hash(substr(h, 2 * i + 1, 400)) as k from (select doc_id, h, unnest(range(0, n - 199)) as i from d)),
r as (select doc_id, i from w qualify count(*) over (partition by k) > 1),
o as (select doc_id, i, sum(gap) over (partition by doc_id order by i) as run from (
    select doc_id, i, case when i > lag(i) over (partition by doc_id order by i) + 200 then 1 else 0 end as gap from r)),
s as materialized (select doc_id, run, min(i) as a, max(i) + 200 as b from o group by doc_id, run),
t as (select doc_id, a, b, substr(h, 2 * b + 1, 2 * (coalesce(lead(a) over (partition by doc_id order by a), n) - b)) as rest
    from s join d using (doc_id)),
x as (select doc_id, sum(b - a)::bigint as removed, count(*) as spans, min(a) as a, string_agg(rest, '' order by a) as rest from t group by doc_id)
select doc_id, n as n_bytes, coalesce(removed, 0)::bigint as n_removed, coalesce(spans, 0)::bigint as n_spans,
       sha256(unhex(case when removed is null then h else substr(h, 1, 2 * a) || rest end)) as kept_sha256
from d left join x using (doc_id)
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        "kept_sha256")


@register("op3_lm_score")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model, counts = lm_score.train(docs.filter(fold != 1))
    return lm_score.score(docs, model, counts).select(
        "doc_id", _held_out(5, 1), "n_tokens", "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def _canonical_sql(text: str) -> str:
    """:func:`licences.canonical` in DuckDB SQL."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    out = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = f"regexp_replace({out}, {quoted(licences.COPYRIGHT)}, chr(10), 'g')"
    out = f"'  ' || regexp_replace({out}, {quoted(licences.PUNCTUATION)}, '  ', 'g') || '  '"
    for a, b in licences.SPELLINGS:
        out = f"replace({out}, ' {a.replace(' ', '  ')} ', ' {b.replace(' ', '  ')} ')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


def _op1_sql() -> str:
    known = ", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in licences.KNOWN)
    digests = ", ".join(f"('{n}', '{d}')" for n, d in licences.DIGESTS)
    return f"""
with known(licence, text) as (values {known}), digests(licence, digest) as (values {digests}),
k as (select digest, min(licence) as licence from (
        select licence, sha256(c) as digest from (select licence, {_canonical_sql("text")} as c from known) where c <> ''
        union all select licence, digest from digests) group by digest),
d as (select doc_id, sha256({_canonical_sql("text")}) as digest from documents),
l as (select doc_id, sha256({_canonical_sql("line")}) as digest
      from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line from documents) where line <> ''),
n as (select doc_id, string_agg(distinct licence, ',' order by licence) as notices, count(*) as n_notice_lines
      from l join k using (digest) group by doc_id)
select doc_id, digest, licence, coalesce(notices, '') as notices, coalesce(n_notice_lines, 0)::bigint as n_notice_lines
from d left join k using (digest) left join n using (doc_id)
"""


@register("op1_licences", _op1_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(read_table(spark, sf_dir, "documents"))
    return found.withColumn("notices", F.array_join("notices", ","))


@register("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    return toxicity.scores(docs, model).select(
        "doc_id", _held_out(5, 0), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def _op12_sql(k: int = 8, rounds: int = 10) -> str:
    """Rounds written out one after the other; sums and floors are exact."""
    near = """(select vec_id, x, arg_min(n, (d, n)) as n, min(d) as d from (
      select vec_id, x, n, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
      from v cross join {c}) group by vec_id, x)"""
    out = f"""with v as materialized (select vec_id, list_transform(embedding, lambda e: floor(1024 * e::double)::bigint) as x from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64),
c0 as materialized (select (row_number() over (order by sha256('3:' || vec_id)) - 1)::int as n, x as c from v
    qualify n < {k})"""
    for r in range(1, rounds + 1):
        out += f""",
m{r} as materialized (select n, list(s order by i) as m from (
    select n, i, floor(sum(x[i])::hugeint::decimal(38, 0) / count(*))::bigint as s
    from {near.format(c=f"c{r - 1}")}, range(1, 65) as t(i) group by n, i) group by n),
c{r} as materialized (select n, coalesce(m, c) as c from c{r - 1} left join m{r} using (n))"""
    return out + f""",
a as materialized {near.format(c=f"c{rounds}")}
select vec_id, n as cluster, d as distance, sum(d) over (partition by n)::bigint as cluster_inertia, sum(d) over ()::bigint as inertia,
       sha256(array_to_string(c, ',')) as centroid_sha256 from a join c{rounds} using (n)"""


@register("op12_centroids", _op12_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", F.sha2("centroid", 256)).drop("centroid")


@register("op13_hard_negatives", """
with v as materialized (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
       list_transform(embedding, lambda e: floor(256 * e::double)) as x from embeddings
    where label is not null and embedding is not null
      and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = len(embedding)),
s as materialized (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.x, b.x)::bigint as score
    from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    label = rows["label"].cast("long")
    return negatives.mine(rows, label=F.when(rows["vec_id"] % 7 == 0, (label + 1) % 10).otherwise(label))
