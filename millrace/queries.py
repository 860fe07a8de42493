"""Named queries of the curation operators over the driver's tables, each with its DuckDB SQL.

Sources, plans and log tables that the operators expect are derived from the tables at hand:
orders stand for jobs, lineitems for their outputs and series, labels for reviews.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scalars as S
from .operators import dedup, gates, graph, joins, ordered, review, select
from .plans import planning, status
from .sources import files
from .sources.tables import events, table
from .streaming import windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def query(sql: str | None) -> Callable:
    """Register a query by its name, with its SQL where SQL can express it."""

    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


# -- inventory, exact duplicates, gates -----------------------------------------------------------


@query("select sha256(text) as sha256, min(doc_id) as doc_id, count(*) as copies from documents group by 1")
def dedup_exact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", dedup.content_hash(F.col("text")).alias("sha256"))
    return docs.groupBy("sha256").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("""
with g as (select sha256(text) as sha256, count(*) as n, min(doc_id) as first from documents group by 1 having count(*) > 1)
select doc_id, g.sha256, n, first from documents join g on sha256(text) = g.sha256""")
def duplicate_groups(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", dedup.content_hash(F.col("text")).alias("sha256"))
    return dedup.duplicate_members(docs, "sha256", "doc_id")


@query("""
with h as (select *, sha256(text) as sha256, row_number() over (partition by sha256(text) order by doc_id) as r from documents)
select doc_id, sha256, list_distinct_sources as sources from h
join (select sha256 as k, list(distinct source order by source) as list_distinct_sources from h group by 1) on k = sha256
where r = 1""")
def first_with_provenance(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", dedup.content_hash(F.col("text")).alias("sha256"), F.array("source").alias("sources"))
    return dedup.first_per_hash(docs, "sha256", "doc_id", ("sources",)).withColumn("sources", F.array_sort("sources"))


@query("""
select source, count(*) as documents, sum(n_chars)::bigint as chars, count(distinct sha256(text)) as distinct_texts,
       count(*) filter (where lang = 'en') as english, count(*) filter (where n_chars < 500) as short
from documents group by source""")
def source_inventory(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy("source").agg(
        F.count("*").alias("documents"),
        F.sum("n_chars").alias("chars"),
        F.count_distinct(dedup.content_hash(F.col("text"))).alias("distinct_texts"),
        F.count_if(F.col("lang") == "en").alias("english"),
        F.count_if(F.col("n_chars") < 500).alias("short"),
    )


@query("""
select doc_id, case when contains(lower(text), 'license') then 'excluded_term:license'
                    when contains(lower(text), 'token') then 'excluded_term:token'
                    when source like 'src1%' and length(source) = 5 then 'excluded_glob:src1?' end as reason
from documents""")
def exclude_first_reason(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    term = gates.exclusion_reason(F.col("text"), ["license", "token"])
    return docs.select("doc_id", F.coalesce(term, gates.exclusion_reason(F.col("source"), (), ["src1?"])).alias("reason"))


@query("""
select doc_id, list_filter([case when n_chars < 300 then 'too_short' end, case when n_chars > 10000 then 'too_long' end,
       case when lang not in ('en', 'de') then 'language' end, case when quality = 0 then 'low_quality' end,
       case when toxic = 1 then 'toxic' end], lambda x: x is not null) as reasons
from documents left join labels using (doc_id)""")
def quality_reasons(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    checks = [(F.col("n_chars") < 300, "too_short"), (F.col("n_chars") > 10000, "too_long"), (~F.col("lang").isin("en", "de"), "language"), (F.col("quality") == 0, "low_quality"), (F.col("toxic") == 1, "toxic")]
    return docs.select("doc_id", gates.reasons(checks).alias("reasons"))


@query("""
with m as (select p_partkey, p_size * 20 as w, p_size * 10 as h, p_retailprice / 20 as c, p_size / 4.0 as s, p_retailprice / 10 as b from part)
select p_partkey, list_filter([case when w < 512 then 'width_below_minimum' end, case when h < 256 then 'height_below_minimum' end,
  case when c < 50 then 'contrast_below_minimum' end, case when s < 4 then 'sharpness_below_minimum' end,
  case when b < 24 then 'too_dark' end, case when b > 180 then 'too_bright' end], lambda x: x is not null) as reasons,
  round(least(30.0, 10 * log2(w * h / 1000000.0 + 1)) + least(25.0, c / 2.5) + least(30.0, s * 1.5) + greatest(0.0, 15 - abs(b - 128) / 8), 3) as score
from m""")
def measured_gate(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    m = part.select("p_partkey", (F.col("p_size") * 20).alias("width"), (F.col("p_size") * 10).alias("height"), (F.col("p_retailprice") / 20).alias("contrast"), (F.col("p_size") / 4.0).alias("sharpness"), (F.col("p_retailprice") / 10).alias("brightness"))
    policy = {"minimum_width": 512, "minimum_height": 256, "minimum_contrast": 50, "minimum_sharpness": 4, "brightness_range": (24, 180)}
    score = S.quality_score(*map(F.col, ("width", "height", "contrast", "sharpness", "brightness")), places=None)
    return m.select("p_partkey", gates.reasons(gates.quality_checks(policy)).alias("reasons"), F.round(score, 3).alias("score"))


@query("""
select event_id, case when event_type = 'error' then ['decode_failed'] else list_filter([case when value < 5 then 'duration_below_minimum' end,
  case when value > 90 then 'excessive_clipping' end], lambda x: x is not null) end as reasons from events""")
def decoded_gate(spark, sf_dir):
    state = F.when(F.col("event_type") == "error", "failed").otherwise("complete")
    checks = [(F.col("value") < 5, "duration_below_minimum"), (F.col("value") > 90, "excessive_clipping")]
    return table(spark, sf_dir, "events").select("event_id", gates.decoded_or(state, "decode_failed", checks).alias("reasons"))


@query("""
select p_partkey, case when p_brand = 'Brand#1' then 'exact' when p_type like 'ECON%' then 'reference' when p_name like '%ring' then 'texture' else 'train' end as role
from part""")
def tiered_roles(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    exact = spark.createDataFrame([("BRAND#1/ECONOMY", "exact")], "path string, role string")
    paths = part.select("p_partkey", "p_name", "p_type", F.when(F.col("p_brand") == "Brand#1", F.lit("Brand#1/Economy")).otherwise(F.concat_ws("/", "p_brand", "p_type", "p_name")).alias("path"))
    return gates.tiered_roles(paths, exact, "path", [("*/ECON*/*", "reference"), ("*ring", "texture")], "train").select("p_partkey", "role")


@query("""
select p_partkey, unnest(list_filter([case when p_size <= 20 then 'small' end, case when p_size between 10 and 40 then 'middle' end], lambda x: x is not null)) as channel
from part where p_brand <> 'Brand#3'""")
def channel_partition(spark, sf_dir):
    roles = F.array_compact(F.array(F.when(F.col("p_size") <= 20, F.lit("s")), F.when(F.col("p_size").between(10, 40), F.lit("m")), F.when(F.col("p_brand") == "Brand#3", F.lit("exclude"))))
    parts = table(spark, sf_dir, "part").select("p_partkey", roles.alias("roles"))
    return parts.select("p_partkey", F.explode(gates.channels(F.col("roles"), {"small": ["s"], "middle": ["m"]})).alias("channel"))


@query("""
select page_id, length(html)::bigint as chars, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) as title,
       len(regexp_extract_all(html, '(?i)<img'))::bigint as images, len(regexp_extract_all(html, '(?i)<a[ >]'))::bigint as links,
       len(regexp_extract_all(html, '(?i)<p[ >]'))::bigint as paragraphs, len(regexp_extract_all(html, 'https?://'))::bigint as urls
from (select page_id, coalesce(html, '') as html from pages)""")
def html_stats(spark, sf_dir):
    return files.html_stats(table(spark, sf_dir, "pages").select("page_id", "html")).drop("html")


@query("""
select conv_id, turn, length(text)::bigint as chars, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))::bigint as words,
       len(regexp_extract_all(text, '\\[pause:'))::bigint as pauses from conversations""")
def transcript_stats(spark, sf_dir):
    return files.transcript_stats(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")).drop("text")


# -- selection and splits ---------------------------------------------------------------------------


@query("""
select doc_id, sha256, quality from (
  select doc_id, sha256(text) as sha256, coalesce(quality, -1) as quality,
         row_number() over (partition by sha256(text) order by coalesce(quality, -1) desc, n_chars desc, doc_id desc) as r
  from documents left join labels using (doc_id)) where r = 1""")
def best_per_hash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", dedup.content_hash(F.col("text")).alias("sha256"))
    rows = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left").withColumn("quality", F.coalesce("quality", F.lit(-1)))
    return dedup.best_per_group(rows, "sha256", F.col("quality").desc(), F.col("n_chars").desc(), F.col("doc_id").desc()).select("doc_id", "sha256", "quality")


@query("""
select doc_id, lang, source, turn from (
  select doc_id, lang, source, row_number() over (partition by lang, source order by n_chars desc, doc_id) as turn from documents)
order by turn, lang, source limit 100""")
def stratified_round_robin(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return select.round_robin(docs, ["lang", "source"], [F.col("n_chars").desc(), F.col("doc_id")], 100).select("doc_id", "lang", "source", "turn")


_SPLITS = """
with g as (select group_id, row_number() over (order by sha256(group_id)) as r, count(*) over () as n
           from (select distinct source as group_id from documents)),
k as (select *, greatest(1, round_even(n * 0.10, 0)) as t, greatest(1, round_even(n * 0.10, 0)) as c, greatest(1, round_even(n * 0.15, 0)) as v from g),
splits as (select group_id, case when n < 4 then 'train' when r <= least(t, n - 3) then 'final_test'
   when r <= least(t, n - 3) + least(c, n - least(t, n - 3) - 2) then 'calibration'
   when r <= least(t, n - 3) + least(c, n - least(t, n - 3) - 2) + least(v, n - least(t, n - 3) - least(c, n - least(t, n - 3) - 2) - 1) then 'validation'
   else 'train' end as split from k)
"""
_FRACTIONS = {"final_test": 0.10, "calibration": 0.10, "validation": 0.15}


@query(_SPLITS + "select * from splits")
def group_safe_splits(spark, sf_dir):
    return select.group_safe_splits(table(spark, sf_dir, "documents").select("source"), F.col("source"), _FRACTIONS)


@query(_SPLITS + """
select sha256(text) as sha256, list(distinct split order by split) as splits
from documents join splits on source = group_id group by 1 having count(distinct split) > 1""")
def split_leakage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("group_id"), dedup.content_hash(F.col("text")).alias("sha256"))
    return select.split_leakage(docs.join(select.group_safe_splits(docs, F.col("group_id"), _FRACTIONS), "group_id"), "split", "sha256")


@query("""
with c as (select 'lang' as facet, lang as value, count(*) as n from documents group by 2 union all
           select 'source', source, count(*) from documents group by 2),
t as (select * from (values ('lang', 'en', 500), ('lang', 'es', 5000), ('lang', 'it', 10), ('source', 'src1', 60)) v(facet, value, target))
select facet, value, target, coalesce(n, 0) as n, greatest(0, target - coalesce(n, 0)) as gap from t left join c using (facet, value)""")
def balance_gaps(spark, sf_dir):
    targets = spark.createDataFrame([("lang", "en", 500), ("lang", "es", 5000), ("lang", "it", 10), ("source", "src1", 60)], "facet string, value string, target int")
    return select.gaps(select.facet_counts(table(spark, sf_dir, "documents"), ["lang", "source"]), targets)


@query("""
with r as (select o_orderkey, o_orderpriority, o_totalprice from orders where o_orderstatus = 'F'),
a as (select 'urgent' as category, o_orderkey from r where o_orderpriority = '1-URGENT' order by o_totalprice desc, o_orderkey limit 1),
b as (select 'dearest', o_orderkey from r where o_orderkey not in (select o_orderkey from a) order by o_totalprice desc, o_orderkey limit 1),
c as (select 'second', o_orderkey from r where o_orderkey not in (select o_orderkey from a union all select * from (select o_orderkey from b)) order by o_totalprice desc, o_orderkey limit 1)
select * from a union all select * from b union all select * from c""")
def reference_bank(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    dear = [F.col("o_totalprice").desc()]
    return select.pick_without_reuse(orders, "o_orderkey", [("urgent", F.col("o_orderpriority") == "1-URGENT", dear), ("dearest", F.lit(True), dear), ("second", F.lit(True), dear)])


@query("""
with a as (select 'voice' as characteristic, ['click', 'view', 'none'] as m union all select 'face', ['error', 'purchase']),
x as (select characteristic, (generate_subscripts(m, 1) - 1)::integer as rank, unnest(m) as modality from a)
select x.characteristic, x.rank, x.modality, count(e.event_id) as n from x left join events e on e.event_type = x.modality group by all""")
def authority_ranking(spark, sf_dir):
    authority = spark.createDataFrame([("voice", ["click", "view", "none"]), ("face", ["error", "purchase"])], "characteristic string, modalities array<string>")
    return select.authority_ranking(table(spark, sf_dir, "events").select(F.col("event_type").alias("modality")), authority)


# -- joins ----------------------------------------------------------------------------------------


@query("select doc_id, lang from documents where doc_id not in (select doc_id from labels)")
def pending_review_anti(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("""
with base as (select l_orderkey, l_linenumber, any_value(decision) as decision from (
  select l_orderkey, l_linenumber, first_value(l_returnflag) over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_extendedprice) as decision from lineitem where l_linenumber > 1) group by 1, 2),
art as (select o_orderkey, o_orderstatus as decision from orders where o_orderstatus <> 'O')
select j.l_orderkey, j.n, coalesce(base.decision, art.decision) as decision
from (select distinct l_orderkey, 2 as n from lineitem) j
left join base on base.l_orderkey = j.l_orderkey and base.l_linenumber = j.n left join art on art.o_orderkey = j.l_orderkey""")
def review_fallback(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    jobs = lines.select("l_orderkey").distinct().withColumn("n", F.lit(2))
    reviews = lines.where("l_linenumber > 1").withColumn("_o", F.struct("l_partkey", "l_suppkey", "l_extendedprice"))
    first = reviews.groupBy("l_orderkey", F.col("l_linenumber").alias("n")).agg(F.min_by("l_returnflag", "_o").alias("decision"))
    artifacts = table(spark, sf_dir, "orders").where("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("decision"))
    return joins.fallback_lookup(jobs, [(first, ["l_orderkey", "n"]), (artifacts, ["l_orderkey"])], "decision")


@query("""
select 'customer.nation' as "check", c_nationkey::varchar as key from (select distinct c_nationkey from customer where c_nationkey not in (select n_nationkey from nation where n_regionkey <> 2))
union all select 'nation.region', n_regionkey::varchar from (select distinct n_regionkey from nation where n_regionkey not in (select r_regionkey from region where r_regionkey < 3))""")
def fk_errors(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    a = joins.missing_keys(table(spark, sf_dir, "customer"), "c_nationkey", nation.where("n_regionkey <> 2"), "n_nationkey", "customer.nation")
    return a.unionByName(joins.missing_keys(nation, "n_regionkey", region.where("r_regionkey < 3"), "r_regionkey", "nation.region"))


@query("""
with e as (select distinct doc_id from documents where lang <> 'fr'), a as (select distinct doc_id from labels)
select coalesce(e.doc_id, a.doc_id) as doc_id, case when a.doc_id is null then 'missing' else 'extra' end as side
from e full outer join a on e.doc_id = a.doc_id where e.doc_id is null or a.doc_id is null""")
def key_differences(spark, sf_dir):
    return joins.key_differences(table(spark, sf_dir, "documents").where("lang <> 'fr'").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"), "doc_id")


@query("""
with claims as (select event_id as claim_id, case when event_type = 'click' then user_id end as shot, event_type || ':' || user_id as tag from events),
tasks as (select user_id as task_id, user_id as shot, list(distinct event_type || ':' || user_id) filter (where value > 20) as tags from events group by 1)
select claim_id, task_id from claims join tasks on (claims.shot is not null and claims.shot = tasks.shot) or (claims.shot is null and list_contains(tasks.tags, claims.tag))""")
def claim_match_or(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("tag", F.concat_ws(":", "event_type", F.col("user_id").cast("string")))
    claims = e.select(F.col("event_id").alias("claim_id"), F.when(F.col("event_type") == "click", F.col("user_id")).alias("shot"), "tag")
    tasks = e.groupBy(F.col("user_id").alias("task_id")).agg(F.collect_set(F.when(F.col("value") > 20, F.col("tag"))).alias("tags")).withColumn("shot", F.col("task_id"))
    return joins.either_key(claims, tasks, "shot", "tag", "tags", "claim_id", "task_id")


@query("""
select o_orderkey, l_linenumber, l_returnflag from orders left join (
  select l_orderkey, l_linenumber, l_returnflag, row_number() over (partition by l_orderkey order by (l_returnflag = 'R') desc, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as r from lineitem) t
on o_orderkey = l_orderkey and r = 1""")
def preferred_take(spark, sf_dir):
    takes = table(spark, sf_dir, "lineitem").withColumn("ord", F.struct(*LINE_ORDER)).withColumnRenamed("l_orderkey", "o_orderkey")
    return joins.preferred_match(table(spark, sf_dir, "orders").select("o_orderkey"), takes, "o_orderkey", F.col("l_returnflag") == "R", "ord").select("o_orderkey", "l_linenumber", "l_returnflag")


@query("""
with r as (select o_orderkey, o_orderdate as lo, o_orderdate + interval 60 day as hi from orders)
select l_orderkey, count(*) as n from lineitem join r on l_orderkey = o_orderkey where not l_shipdate between lo and hi group by 1""")
def outside_range(spark, sf_dir):
    ranges = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("lo"), (F.col("o_orderdate") + F.expr("interval 60 days")).alias("hi"))
    return joins.outside_range(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate"), ranges, "l_orderkey", "l_shipdate", "lo", "hi")


@query("""
select p.doc_id, p.h as planned_hash, sha256(d.text) as current_hash
from (select doc_id, case when lang = 'fr' then sha256('old') else sha256(text) end as h from documents) p
left join (select * from documents where n_chars >= 500) d using (doc_id)
where sha256(d.text) is distinct from p.h""")
def plan_drift(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", dedup.content_hash(F.col("text")).alias("h"))
    planned = docs.withColumn("h", F.when(F.col("lang") == "fr", F.sha2(F.lit("old").cast("binary"), 256)).otherwise(F.col("h")))
    return joins.drifted(planned, docs.where("n_chars >= 500"), "doc_id", "h").withColumnRenamed("h", "planned_hash")


@query("""
select d.doc_id, coalesce(case l.quality when 1 then 'approved' when 0 then 'rejected' end, 'pending') as decision
from documents d left join labels l using (doc_id)""")
def review_upsert(spark, sf_dir):
    old = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "approved").when(F.col("quality") == 0, "rejected").alias("decision"))
    new = table(spark, sf_dir, "documents").select("doc_id", F.lit("pending").alias("decision"))
    return joins.upsert(old, new, "doc_id", ["decision"])


# -- job states and plans ---------------------------------------------------------------------------

_JOBS = """
with outs as (select l_orderkey, count(*) as outputs, count(*) filter (where l_returnflag = 'N' and l_linestatus = 'O' and l_quantity > 45) as outputs_missing from lineitem group by 1),
jobs as (select o_orderkey as id, o_orderpriority as stage, o_custkey % 3 <> 0 as required,
   case when o_orderkey % 10 < 5 then 'complete' when o_orderkey % 10 = 5 then 'failed' when o_orderkey % 10 = 6 then 'running' when o_orderkey % 10 = 7 then null else 'pending' end as log_status,
   case when o_orderkey % 50 = 11 then 'queued' when o_orderkey % 50 = 27 then 'running' end as live_state,
   case when o_orderstatus = 'P' then 'rejected' when o_orderstatus = 'F' then 'approved' end as decision,
   o_orderstatus = 'F' and o_totalprice < 300000 as clean_approval, outputs, outputs_missing
 from orders left join outs on o_orderkey = l_orderkey),
states as (select *, case when log_status is null and live_state is null then 'graph_ready' when decision = 'rejected' then 'rejected' when live_state is not null then live_state
   when log_status in ('running', 'failed') then log_status
   when log_status = 'complete' then case when coalesce(outputs, 0) = 0 or coalesce(outputs_missing, 0) > 0 then 'output_missing' when clean_approval then 'approved' else 'output_present' end
   else 'graph_ready' end as state from jobs)
"""


def _jobs(spark, sf_dir):
    lost = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O") & (F.col("l_quantity") > 45)
    outs = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("outputs"), F.count_if(lost).alias("outputs_missing"))
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    jobs = table(spark, sf_dir, "orders").select(
        k.alias("id"),
        F.col("o_orderpriority").alias("stage"),
        (F.col("o_custkey") % 3 != 0).alias("required"),
        F.when(k % 10 < 5, "complete").when(k % 10 == 5, "failed").when(k % 10 == 6, "running").when(k % 10 == 7, None).otherwise("pending").alias("log_status"),
        F.when(k % 50 == 11, "queued").when(k % 50 == 27, "running").alias("live_state"),
        F.when(s == "P", "rejected").when(s == "F", "approved").alias("decision"),
        ((s == "F") & (F.col("o_totalprice") < 300000)).alias("clean_approval"),
    )
    return status.job_states(jobs.join(outs, "id", "left"))


@query(_JOBS + "select id, state from states")
def job_state(spark, sf_dir):
    return _jobs(spark, sf_dir).select("id", "state")


@query(_JOBS + """
select stage, count(*) as jobs, count(*) filter (where required) as required, count(*) filter (where required and state = 'approved') as approved,
  case when count(*) filter (where state in ('running', 'queued')) > 0 then 'active' when count(*) filter (where required and state = 'rejected') > 0 then 'failed'
       when count(*) filter (where required) > 0 and count(*) filter (where required) = count(*) filter (where required and state = 'approved') then 'complete'
       when count(*) filter (where required and state = 'failed') > 0 then 'failed' when count(*) filter (where required and state = 'output_missing') > 0 then 'blocked'
       when count(*) filter (where state = 'graph_ready') > 0 then 'ready' when count(*) filter (where required and state = 'output_present') > 0 then 'needs_approval' else 'blocked' end as status
from states group by stage""")
def stage_rollup(spark, sf_dir):
    return status.stage_rollup(_jobs(spark, sf_dir))


@query(_JOBS + "select count(*) as groups, count(*) filter (where a) as approved from (select bool_or(state = 'approved') as a from states group by id % 20)")
def storyboard_groups(spark, sf_dir):
    return status.groups_with_approval(_jobs(spark, sf_dir).withColumn("grp", F.col("id") % 20), "grp")


@query("""
select p_brand as kind, count(*) as total, count(*) filter (where b is not null) as present,
       coalesce(list(p_name || p_partkey order by p_name || p_partkey) filter (where b is null), []) as missing
from (select p_brand, p_name, p_partkey, l.k as b from part left join (select distinct l_partkey as k from lineitem where l_quantity > 48) l on l.k = p_partkey) group by 1""")
def readiness_audit(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("kind"), F.concat("p_name", F.col("p_partkey").cast("string")).alias("name"))
    sold = table(spark, sf_dir, "lineitem").where("l_quantity > 48").select(F.col("l_partkey").alias("p_partkey")).distinct()
    return status.readiness(parts.select("kind", "name"), parts.join(sold, "p_partkey").select("name", F.lit(True).alias("exists")))


@query("""
select r_name, p_size, seed, concat_ws('__', r_name, p_size, seed) as plan_id, sha256(concat_ws('__', r_name, p_size, seed)) as plan_hash
from region, (select distinct p_size from part), (select unnest([11, 22, 33]) as seed)""")
def matrix_plan(spark, sf_dir):
    sizes = table(spark, sf_dir, "part").select("p_size").distinct()
    return planning.matrix_plan([table(spark, sf_dir, "region").select("r_name"), sizes], {"seed": [11, 22, 33]}, ["r_name", "p_size", "seed"])


@query("""
with s as (select l_orderkey, l_quantity, list(distinct l_returnflag order by l_returnflag) over (partition by l_orderkey) as alts,
                  row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as r from lineitem),
o as (select l_orderkey, l_quantity, alts from s where r = 1)
select l_orderkey, 0 as take, 'master' as role, null as name, l_quantity as seconds from o
union all select l_orderkey, generate_subscripts(alts, 1)::integer, 'alternate', unnest(alts), l_quantity * 0.5 from o""")
def coverage_plan(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min_by("l_quantity", F.struct(*LINE_ORDER)).alias("l_quantity"), F.array_sort(F.collect_set("l_returnflag")).alias("alts"))
    return planning.coverage_plan(lines, "l_orderkey", "alts", "l_quantity")


# -- timelines and series ---------------------------------------------------------------------------

_LINES = "partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query(f"""
select l_orderkey, l_linenumber, l_partkey, l_extendedprice, round(coalesce(sum(l_quantity) over ({_LINES} rows between unbounded preceding and 1 preceding), 0), 6) as start_seconds,
       round(coalesce(sum(l_quantity) over ({_LINES} rows between unbounded preceding and 1 preceding), 0) + l_quantity, 6) as end_seconds from lineitem""")
def timeline_start(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER, "l_quantity")
    return ordered.timeline(lines, "l_orderkey", LINE_ORDER, "l_quantity").drop("l_quantity", "l_suppkey")


@query(f"""
with t as (select l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, sum(l_quantity) over ({_LINES} rows between unbounded preceding and current row) as upto,
  sum(l_quantity) over (partition by l_orderkey) as total, row_number() over ({_LINES}) = count(*) over (partition by l_orderkey) as last from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_extendedprice, round((upto - l_quantity) * (100.0 / total), 6) as source_start, case when last then 100.0 else round(upto * (100.0 / total), 6) end as source_end from t""")
def proportional_map(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER, "l_quantity").withColumn("whole", F.lit(100.0))
    out = ordered.proportional_map(lines, "l_orderkey", LINE_ORDER, "l_quantity", "whole")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "source_start", "source_end")


@query("""
with s as (select user_id, row_number() over (partition by user_id order by event_id) as i, event_id, value from events),
h as (select *, case when i % 3 <> 0 then value end as v from s),
w as (select *, last_value(case when v is not null then i end ignore nulls) over p as i0, last_value(v ignore nulls) over p as v0,
  first_value(case when v is not null then i end ignore nulls) over f as i1, first_value(v ignore nulls) over f as v1 from h
  window p as (partition by user_id order by i rows between unbounded preceding and current row), f as (partition by user_id order by i rows between current row and unbounded following))
select event_id, case when v is not null then v when i0 is null then v1 when i1 is null then v0 else v0 + (i - i0) * (v1 - v0) / (i1 - i0) end as filled from w""")
def gap_fill(spark, sf_dir):
    from pyspark.sql import Window

    i = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    s = table(spark, sf_dir, "events").select("user_id", "event_id", i.alias("i"), "value").withColumn("v", F.when(F.col("i") % 3 != 0, F.col("value")))
    return ordered.fill_gaps(s, "user_id", "i", "v").select("event_id", "filled")


@query("""
with recursive s as (select user_id, event_id, value, row_number() over (partition by user_id order by event_id) as i from events where value >= 5),
f as (select user_id, event_id, i, value as x from s where i = 1 union all
      select s.user_id, s.event_id, s.i, 0.35 * s.value + 0.65 * f.x from f join s on s.user_id = f.user_id and s.i = f.i + 1)
select user_id, event_id, x as smoothed from f""")
def ema_series(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return ordered.ema(e, "user_id", "event_id", "value", 0.35, F.col("value") >= 5)


@query("""
with k as (select user_id, event_id::double as t, value as v, lead(event_id::double) over w as t1, lead(value) over w as v1 from events where event_type = 'click' window w as (partition by user_id order by event_id)),
b as (select user_id, min(t) as lo, max(t) as hi, arg_min(v, t) as vlo, arg_max(v, t) as vhi from k group by 1),
q as (select user_id, event_id::double + 0.5 as at from events)
select q.user_id, q.at, case when q.at < b.lo then b.vlo when q.at >= b.hi then b.vhi else k.v + (q.at - k.t) / (k.t1 - k.t) * (k.v1 - k.v) end as value
from q left join b using (user_id) left join k on k.user_id = q.user_id and k.t <= q.at and q.at < k.t1""")
def keyframe_values(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    marks = e.where("event_type = 'click'").select("user_id", F.col("event_id").cast("double").alias("t"), "value")
    asked = e.select("user_id", (F.col("event_id") + F.lit(0.5)).cast("double").alias("at"))
    return ordered.interpolate_at(marks, asked, "user_id", "t", "value", "at")


@query("""
with recursive c as (select user_id, epoch(ts) % 86400 / 60 as cut from events),
k as (select distinct user_id, 0.0::double as kept from c union all
  select k.user_id, min(c.cut) from k join c on k.user_id = c.user_id and c.cut - k.kept >= 15 and c.cut > 15 and c.cut < 1425 group by k.user_id, k.kept),
spans as (select user_id, kept as x, lead(kept, 1, 1440.0) over (partition by user_id order by kept) as y from k),
parts as (select *, greatest(0, ceil((y - x) / 60 - 1))::int as n, unnest(range(greatest(0, ceil((y - x) / 60 - 1))::int + 1)) as i from spans),
cut_up as (select user_id, x + i * 60.0 as "start", case when i < n then x + i * 60.0 + 60.0 else y end as "end" from parts)
select * from cut_up where "end" - "start" >= 15""")
def scene_segments(spark, sf_dir):
    cuts = events(spark, sf_dir).select("user_id", (F.col("ts").cast("double") % 86400 / 60).alias("cut"), F.lit(1440.0).alias("duration"))
    return ordered.scene_segments(cuts, "user_id", "cut", "duration", 15.0, 60.0)


@query(r"""
with recursive t as (select conv_id, turn, regexp_split_to_array(text, '\s+') as ws from conversations),
f as (select conv_id || '-' || turn as seg, turn, unnest(ws) as w, unnest(range(len(ws))) as i from t),
w as (select seg, w, turn * 60 + i * 0.4::double as s, turn * 60 + i * 0.4::double + 0.35::double as e, row_number() over (partition by seg order by i) as j from f where w <> ''),
k as (select seg, 1::bigint as j from w where j = 1 union all
  select seg, j from (select k.seg, min(w.j) + 1 as j from k join w a on a.seg = k.seg and a.j = k.j join w on w.seg = k.seg and w.j >= k.j and w.e - a.s >= 4.5 group by k.seg, k.j) n where exists (select 1 from w where w.seg = n.seg and w.j = n.j)),
c as (select w.seg, k.j as chunk, w.* exclude (seg) from w asof join k on w.seg = k.seg and w.j >= k.j),
g as (select seg, chunk, min(s) as s, max_by(e, j) as e from c group by all),
r as (select *, lag(chunk) over (partition by seg order by chunk) as before, row_number() over (partition by seg order by chunk desc) = 1 as final from g),
m as (select seg, chunk, case when final and before is not null and e - s < 1.0 then before else chunk end as into_chunk from r),
z as (select c.seg, into_chunk, min(s) as s, max_by(e, j) as e, string_agg(w, ' ' order by j) as text from c join m on c.seg = m.seg and c.chunk = m.chunk group by all)
select seg, greatest(0.0, s - 0.05) as "start", e + 0.05 as "end", text from z where e + 0.05 - greatest(0.0, s - 0.05) >= 0.8""")
def word_chunks(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", r"\s+")).alias("i", "w"))
    words = turns.select("conv_id", F.struct("turn", "i").alias("o"), (F.col("turn") * 60 + F.col("i") * 0.4).alias("s"), (F.col("turn") * 60 + F.col("i") * 0.4 + 0.35).alias("e"), F.concat(F.lit(" "), "w").alias("w"))
    return ordered.word_chunks(words.withColumn("seg", F.concat_ws("-", "conv_id", F.col("o.turn"))), "seg", "o", "s", "e", "w")


_MARK = r"\[pause:\s*([0-9]+(?:\.[0-9]+)?)s?\]"


@query(f"""
with t as (select conv_id, turn, replace(text, 'a ', 'a [pause:1.5s] ') as text from conversations),
p as (select conv_id, turn, list_transform(regexp_split_to_array(text, '{_MARK}'), lambda x: length(x)) as gaps,
  list_transform(regexp_extract_all(text, '{_MARK}'), lambda x: length(x)) as widths, regexp_extract_all(text, '{_MARK}', 1) as s from t),
e as (select *, unnest(range(len(s))) as i from p)
select conv_id, turn, i, s[i + 1]::double as seconds, list_sum(gaps[1:i + 1]) + coalesce(list_sum(widths[1:i]), 0) as "offset" from e""")
def pause_offsets(spark, sf_dir):
    marked = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.replace("text", F.lit("a "), F.lit("a [pause:1.5s] ")).alias("text"))
    return ordered.pause_markers(marked, ["conv_id", "turn"], "text").select("conv_id", "turn", F.col("i").cast("long").alias("i"), "seconds", F.col("offset").cast("long").alias("offset"))


@query("select c_custkey, trim(regexp_replace(lower(c_name || ' / ' || c_mktsegment || '!'), '[^a-z0-9]+', '_', 'g'), '_') as token from customer")
def safe_tokens(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", S.safe_token(F.concat("c_name", F.lit(" / "), "c_mktsegment", F.lit("!"))).alias("token"))


@query("""
with b as (select user_id, event_id, epoch(ts) % 86400 as sec, value / 1000000 as energy from events),
c as (select distinct user_id, floor(sec / 600) * 600 as "start", floor(sec / 600) * 600 + 300 as "end" from b),
l as (select c.user_id, c."start", c."end", 20 * log10(sqrt(avg(energy) + 1e-12)) as level from c left join b on b.user_id = c.user_id and b.sec >= c."start" and b.sec < c."end" group by 1, 2, 3)
select user_id, "start", "end", round(level, 4) as level from l where level is null or level >= -48""")
def quiet_chunks(spark, sf_dir):
    e = events(spark, sf_dir)
    blocks = e.select("user_id", (F.col("ts").cast("double") % 86400).alias("at"), (F.col("value") / 1000000).alias("energy"))
    start = F.floor(F.col("at") / 600) * 600.0
    chunks = blocks.select("user_id", start.alias("start"), (start + 300).alias("end")).distinct()
    return ordered.drop_quiet(chunks, blocks, "user_id", "start", "end", "at", "energy").withColumn("level", F.round("level", 4))


@query(None)
def track_assign(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select("label", (F.col("vec_id") / 30).cast("int").alias("frame"), "vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return ordered.assign_tracks(v, "label", "frame", "vec_id", "x", "y", 0.2)


@query("""
select conv_id, turn, role, lead(role) over w as next_role, lead(turn) over w - turn as step from conversations window w as (partition by conv_id order by turn)""")
def turn_ordering(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.lead("role").over(w).alias("next_role"), (F.lead("turn").over(w) - F.col("turn")).alias("step"))


# -- vectors ----------------------------------------------------------------------------------------

_CENTROID = "cent as (select label, list(x order by i) as c from (select label, i, avg(embedding[i]::double) as x from embeddings, (select unnest(range(1, 65)) as i) group by 1, 2) group by 1)"


def _centroids(spark, sf_dir):
    dims = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = dims.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("c")).select("label", F.transform("c", lambda p: p["x"]).alias("c"))


@query(f"with {_CENTROID} select label, i, round(x / sqrt(sum(x * x) over (partition by label)), 5) as x from (select label, unnest(c) as x, generate_subscripts(c, 1) - 1 as i from cent)")
def label_centroid(spark, sf_dir):
    c = _centroids(spark, sf_dir).select("label", S.normalised(F.col("c")).alias("c"))
    return c.select("label", F.posexplode("c").alias("i", "x")).select("label", F.col("i").cast("long").alias("i"), F.round("x", 5).alias("x"))


@query(f"""
with {_CENTROID}, d as (select vec_id, 1 - list_dot_product(embedding::double[], c) / (sqrt(list_dot_product(embedding::double[], embedding::double[])) * sqrt(list_dot_product(c, c))) as d
  from embeddings join cent using (label))
select vec_id, round(d, 5) as distance, case when d < 0.45 then 'HOLDS' when d < 0.65 then 'DRIFTS' else 'NO MATCH' end as band from d""")
def cosine_band(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").join(_centroids(spark, sf_dir), "label")
    d = rows.select("vec_id", S.cosine_distance(F.col("embedding"), F.col("c")).alias("d"))
    return d.select("vec_id", F.round("d", 5).alias("distance"), gates.similarity_band(F.col("d")).alias("band"))


@query(f"""
with {_CENTROID}, d as (select vec_id, cent.label, 1 - list_dot_product(embedding::double[], c) / (sqrt(list_dot_product(embedding::double[], embedding::double[])) * sqrt(list_dot_product(c, c))) as d
  from embeddings, cent), r as (select *, lead(d) over (partition by vec_id order by d) - d as m, row_number() over (partition by vec_id order by d) as r from d)
select vec_id, label, round(m, 5) as margin from r where r = 1""")
def runner_up_margin(spark, sf_dir):
    # every vector against the centroid of every label, of which there are ten
    all_labels = _centroids(spark, sf_dir).agg(F.collect_list(F.struct("label", "c")).alias("cs"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding").crossJoin(F.broadcast(all_labels)).select("vec_id", "embedding", F.explode("cs").alias("k"))
    d = rows.select("vec_id", F.col("k.label").alias("label"), S.cosine_distance(F.col("embedding"), F.col("k.c")).alias("d"))
    return ordered.runner_up_margin(d, "vec_id", "d").select("vec_id", "label", F.round("margin", 5).alias("margin"))


_SUMMARY = """
with s as (select label, count(*) as cases, round(median(embedding[1]::double), 6) as distance, round(avg((embedding[2] > 0)::int), 6) as rate, bool_and(vec_id is not null) as hashes from embeddings group by 1)
"""


def _summaries(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.col("embedding")[0].cast("double").alias("d"), (F.col("embedding")[1] > 0).alias("face"))
    return e.groupBy("label").agg(F.count("*").alias("cases"), F.round(F.median("d"), 6).alias("distance"), F.round(F.avg(F.col("face").cast("int")), 6).alias("rate"), F.bool_and(F.col("vec_id").isNotNull()).alias("hashes"))


@query(_SUMMARY + "select * from s")
def candidate_summary(spark, sf_dir):
    return _summaries(spark, sf_dir)


@query(_SUMMARY + """
, r as (select *, row_number() over (order by distance, rate desc, label) as r, lead(distance) over (order by distance, rate desc, label) as d2, lead(rate) over (order by distance, rate desc, label) as r2
  from s where label > 1 and distance < (select min(distance) from s where label <= 1) )
select label, cases, distance, rate, hashes from r where r = 1 and not (coalesce(d2 = distance, false) and coalesce(r2 = rate, false))""")
def candidate_promotion(spark, sf_dir):
    s = _summaries(spark, sf_dir)
    base = s.where("label <= 1").agg(F.min("distance").alias("best"))
    rows = s.where("label > 1").crossJoin(F.broadcast(base))  # one row
    return select.unique_winner(rows, "label", F.col("distance") < F.col("best"), [F.col("distance"), F.col("rate").desc()], ["distance", "rate"]).drop("best")


# -- near duplicates and graphs -----------------------------------------------------------------------

#: Four smallest stretches of the MD5 hashes of a text's words, 16 bits each, stand for an image hash.
_HASH = """
h as (select doc_id, case when len(w) = 0 then null else
  (('0x' || substr(list_min(list_transform(w, lambda x: substr(x, 1, 8))), 5, 4))::bigint % 32768 * 281474976710656
   + ('0x' || substr(list_min(list_transform(w, lambda x: substr(x, 9, 8))), 5, 4))::bigint * 4294967296
   + ('0x' || substr(list_min(list_transform(w, lambda x: substr(x, 17, 8))), 5, 4))::bigint * 65536
   + ('0x' || substr(list_min(list_transform(w, lambda x: substr(x, 25, 8))), 5, 4))::bigint) end as h
 from (select doc_id, list_transform(list_distinct(list_filter(string_split(lower(text), ' '), lambda x: x <> '')), lambda x: md5(x)) as w from documents))
"""


def _hashes(spark, sf_dir):
    w = F.array_distinct(F.filter(F.split(F.lower("text"), " "), lambda x: x != ""))

    def low(at: int):
        return F.conv(F.substring(F.array_min(F.transform("w", lambda x: F.substring(x, at, 8))), 5, 4), 16, 10).cast("long")

    # checkpointed, so that words are hashed once for all joins
    docs = table(spark, sf_dir, "documents").select("doc_id", F.transform(w, lambda x: F.md5(x.cast("binary"))).alias("w"))
    h = low(1) % 32768 * 281474976710656 + low(9) * 4294967296 + low(17) * 65536 + low(25)
    return dedup.reliable(docs.select("doc_id", F.when(F.size("w") > 0, h).alias("h")))


@query(f"with {_HASH}, d as (select distinct h from h where h is not null) select x.h as x, y.h as y, bit_count(xor(x.h, y.h))::integer as distance from d x join d y on x.h < y.h and bit_count(xor(x.h, y.h)) <= 3")
def hamming_pairs(spark, sf_dir):
    return dedup.near_pairs(_hashes(spark, sf_dir), "h", 3).withColumn("distance", F.col("distance").cast("int"))


@query(f"""
with recursive {_HASH}, r as (select a.doc_id as x, b.doc_id as y from h a join h b on bit_count(xor(a.h, b.h)) <= 3),
t as (select doc_id as x, doc_id as y from documents union select t.x, r.y from t join r on t.y = r.x)
select x as doc_id, min(y) as cluster from t group by 1""")
def near_dup_clusters(spark, sf_dir):
    return dedup.near_duplicate_clusters(_hashes(spark, sf_dir), "doc_id", "h", 3)


_GRAPH = """
edges as (select distinct 'o' || l_orderkey as parent, 'l' || l_orderkey || '-' || l_linenumber as child from lineitem
  union select distinct 'l' || l_orderkey || '-' || l_linenumber, 'p' || l_partkey from lineitem where l_quantity > 48),
nodes as (select distinct id from (select parent as id from edges union all select child from edges)),
seeds as (select id from nodes where id like 'o%7'), gone as (select id from nodes where id like 'o%93')
"""


def _graph(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    line = F.concat(F.lit("l"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    a = l.select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("parent"), line.alias("child"))
    b = l.where("l_quantity > 48").select(line.alias("parent"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("child"))
    edges = a.union(b).distinct()
    nodes = edges.select(F.col("parent").alias("id")).union(edges.select("child")).distinct()
    return edges, nodes


@query(f"""
with recursive {_GRAPH}, hit as (select id from seeds union select id from gone union select child from hit join edges on parent = hit.id)
select id, id in (select id from seeds) as changed from hit where id not in (select id from gone)""")
def invalidation(spark, sf_dir):
    edges, _ = _graph(spark, sf_dir)
    edges = dedup.stored(edges)  # each round of the search reads them
    nodes = dedup.stored(edges.select(F.col("parent").alias("id")).union(edges.select("child")).distinct())
    now = nodes.where("not id like 'o%93'").withColumn("fingerprint", F.when(F.col("id").like("o%7"), "new").otherwise("same"))
    return graph.invalidated(now, nodes.withColumn("fingerprint", F.lit("same")), edges)


@query(f"with {_GRAPH} select parent, child, 'parent' as \"end\" from edges where parent like 'o%93' union all select parent, child, 'child' from edges where child like 'o%93'")
def dangling_edges(spark, sf_dir):
    edges, nodes = _graph(spark, sf_dir)
    return graph.dangling_edges(nodes.where("not id like 'o%93'"), edges)


@query("""
select o_orderkey from orders where o_orderstatus = 'P' or o_orderpriority in ('1-URGENT', '5-LOW')""")
def stale_stages(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    now = o.select("o_orderkey", graph.signature("o_custkey", "o_orderstatus").alias("signature"), F.sha2("o_orderpriority", 256).alias("outputs"))
    ledger = now.join(o.where("o_orderstatus <> 'P'").select("o_orderkey", "o_orderpriority"), "o_orderkey")
    ledger = ledger.select("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", "old").otherwise(F.col("signature")).alias("signature"), F.when(F.col("o_orderpriority") == "5-LOW", "lost").otherwise(F.col("outputs")).alias("outputs"))
    return graph.stale_stages(now, ledger, "o_orderkey").select("o_orderkey")


# -- records and reviews ------------------------------------------------------------------------------


@query("""
with d as (select event_id, case when event_id % 11 = 0 then '{"k": "x"}' when event_id % 13 = 0 then '{"j": 1}' when event_id % 17 = 0 then '{oops' else props end as doc from events)
select event_id, case when event_id % 11 = 0 then ['type:k'] when event_id % 13 = 0 then ['missing:k'] when event_id % 17 = 0 then ['unreadable'] else [] end as errors from d""")
def json_validate(spark, sf_dir):
    i = F.col("event_id")
    doc = F.when(i % 11 == 0, '{"k": "x"}').when(i % 13 == 0, '{"j": 1}').when(i % 17 == 0, "{oops").otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", S.json_errors(doc, {"k": "number"}).alias("errors"))


@query("""
select user_id, event_type as decision, event_id from (select *, row_number() over (partition by user_id order by event_id desc) as r from events where event_type in ('click', 'view')) where r = 1""")
def latest_decision(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("decision"), F.lit("user").alias("reviewed_by"))
    return review.latest_decisions(e, "user_id", "event_id", ("click", "view")).select("user_id", "decision", "event_id")


@query("""
select d.doc_id, case when l.doc_id is not null then 'complete' when d.lang = 'en' then 'running' else 'pending' end as status
from documents d left join (select distinct doc_id from labels) l using (doc_id)""")
def task_carry_over(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    prior = docs.where("lang = 'en'").select("doc_id", F.lit("running").alias("status"))
    return review.carry_over(docs.select("doc_id"), table(spark, sf_dir, "labels"), prior, "doc_id")


@query("""
select c_mktsegment, n as requirement, (case n when 1 then count(*) > 100 when 2 then min(c_acctbal) > -500 else avg(c_acctbal) > 4500 end) as passed
from customer, (select unnest([1, 2, 3]) as n) group by 1, 2""")
def goal_audit(spark, sf_dir):
    g = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.min("c_acctbal").alias("low"), F.avg("c_acctbal").alias("mean"))
    rows = F.array(*(F.struct(F.lit(i).alias("requirement"), ok.alias("passed")) for i, ok in ((1, F.col("n") > 100), (2, F.col("low") > -500), (3, F.col("mean") > 4500))))
    return g.select("c_mktsegment", F.explode(rows).alias("r")).select("c_mktsegment", "r.*")


@query("""
select user_id, count(distinct event_type) as have, case when count(distinct event_type) < 5 then ['half_missing'] else [] end as reasons from events group by 1""")
def pair_completeness(spark, sf_dir):
    seen = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_distinct("event_type").alias("have"))
    return seen.select("user_id", "have", gates.reasons([(F.col("have") < 5, "half_missing")]).alias("reasons"))


@query("""
select p_partkey, substr(regexp_replace(regexp_replace(lower(p_name || ' (' || p_type || ')'), '[^\\p{L}\\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 48) as slug,
       greatest(8, p_size - p_size % 8) as snapped from part""")
def slugs(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.slug(F.concat("p_name", F.lit(" ("), "p_type", F.lit(")"))).alias("slug"), S.snap_down(F.col("p_size")).alias("snapped"))


# -- event time ---------------------------------------------------------------------------------------


@query("select date_trunc('hour', ts) as window_start, event_type, count(*) as n, round(sum(value), 2) as total from events group by all")
def tumbling_windows(spark, sf_dir):
    out = windows.windowed_counts(events(spark, sf_dir), "1 hour")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 2).alias("total"))


@query("""
with g as (select user_id, ts, case when ts - lag(ts) over w < interval 30 minute then 0 else 1 end as new from events window w as (partition by user_id order by ts)),
s as (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from g)
select user_id, min(ts) as session_start, max(ts) + interval 30 minute as session_end, count(*) as n from s group by user_id, k""")
def user_sessions(spark, sf_dir):
    out = windows.sessions(events(spark, sf_dir))
    return out.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n")


# -- flagship -----------------------------------------------------------------------------------------


@query(_SPLITS + """
, e as (select d.doc_id, d.lang, d.source, d.n_chars, sha256(d.text) as sha256, coalesce(l.quality, -1) as quality from documents d left join labels l using (doc_id)
        where d.n_chars between 300 and 10000 and coalesce(l.toxic, 0) = 0 and coalesce(l.quality, 1) = 1),
b as (select *, row_number() over (partition by sha256 order by quality desc, n_chars desc, doc_id desc) as r from e),
t as (select *, row_number() over (partition by lang, source order by n_chars desc, doc_id) as turn from b where r = 1),
c as (select * from t order by turn, lang, source limit 200)
select c.doc_id, c.lang, c.source, c.turn, splits.split from c join splits on c.source = splits.group_id""")
def curated_selection(spark, sf_dir):
    """Gate, exact duplicates, balanced selection and group-safe splits in one chain."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "lang", "source", "n_chars", dedup.content_hash(F.col("text")).alias("sha256")).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    checks = [(~F.col("n_chars").between(300, 10000), "length"), (F.col("toxic") == 1, "toxic"), (F.col("quality") == 0, "low_quality")]
    passed = gates.gate(rows, checks).where("passed").withColumn("quality", F.coalesce("quality", F.lit(-1)))
    best = dedup.best_per_group(passed, "sha256", F.col("quality").desc(), F.col("n_chars").desc(), F.col("doc_id").desc())
    chosen = select.round_robin(best, ["lang", "source"], [F.col("n_chars").desc(), F.col("doc_id")], 200)
    splits = select.group_safe_splits(docs.select("source"), F.col("source"), _FRACTIONS)
    return chosen.join(splits.withColumnRenamed("group_id", "source"), "source").select("doc_id", "lang", "source", "turn", "split")


from . import record_queries  # noqa: E402, F401  registers more queries
from . import structure_queries  # noqa: E402, F401  registers more queries
