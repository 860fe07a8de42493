"""More named queries with their DuckDB SQL: records, labels, plans, joins and aggregates of the survey."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import scalars as S
from .operators import aggregates, dedup, gates, graph, joins, ordered, records, review, select
from .plans import planning, status
from .queries import LINE_ORDER, query
from .sources.tables import table

# -- records ------------------------------------------------------------------------------------------


@query("select event_id, (props::json ->> 'k')::bigint as k from events")
def tolerant_json(spark, sf_dir):
    answer = records.json_answers(F.concat(F.lit("noise {x} "), "props", F.lit(" tail {y}")), ["k"])
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(answer, "$.k").cast("long").alias("k"))


_STAGED = """
with j as (select o_orderkey, case o_orderpriority when '1-URGENT' then 'storyboard__' when '2-HIGH' then 'video__' when '3-MEDIUM' then 'character_sheet_' else 'other__' end || o_orderkey as job,
  case when o_orderstatus = 'P' then 'proof' end as phase, case when o_totalprice < 50000 then 'expansion' when o_totalprice > 300000 then 'first_review' end as priority, o_custkey % 7 as seconds, o_custkey % 4 as number from orders),
s as (select *, case when phase = 'proof' then 'proofs' when starts_with(job, 'storyboard__') then 'storyboards' when contains(job, 'character_sheet') or priority is not null then 'character_sheets'
  when starts_with(job, 'video__') and seconds = 5 then 'extended_sequences' when starts_with(job, 'video__') then 'scripted_clips' else 'character_sheets' end as stage from j)
"""


@query(_STAGED + """
select o_orderkey, stage, case when stage = 'character_sheets' then case priority when 'expansion' then false when 'first_review' then true else number <= 2 end else stage <> 'storyboards' end as required from s""")
def job_stages(spark, sf_dir):
    o, p = table(spark, sf_dir, "orders"), F.col("o_orderpriority")
    kind = F.when(p == "1-URGENT", "storyboard__").when(p == "2-HIGH", "video__").when(p == "3-MEDIUM", "character_sheet_").otherwise("other__")
    priority = F.when(F.col("o_totalprice") < 50000, "expansion").when(F.col("o_totalprice") > 300000, "first_review")
    jobs = o.select("o_orderkey", F.concat(kind, F.col("o_orderkey").cast("string")).alias("job"), F.when(F.col("o_orderstatus") == "P", "proof").alias("phase"), priority.alias("priority"), (F.col("o_custkey") % 7).alias("seconds"), (F.col("o_custkey") % 4).alias("number"))
    staged = jobs.withColumn("stage", records.stage_of(F.col("job"), F.col("phase"), F.col("priority"), F.col("seconds"), {"proof": "proofs"}))
    return staged.select("o_orderkey", "stage", records.is_required(F.col("stage"), F.col("priority"), F.col("number")).alias("required"))


@query("""
select p_partkey || '.' || name as claim_id, p_partkey, field, value from (
  select p_partkey, 'p_name' as field, 'p_name' as name, trim(p_name) as value from part union all select p_partkey, 'p_type', 'p_type', trim(p_type) from part
  union all select p_partkey, 'tags', 'tags.' || i, [p_brand, '', p_type][i + 1] from part, (select unnest([0, 1, 2]) as i)) where value <> ''""")
def claim_rows(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", F.array("p_brand", F.lit(""), "p_type").alias("tags"))
    return records.written_claims(parts, "p_partkey", ["p_name", "p_type"], ["tags"])


@query("""
with c as (select p_brand as concept, count(*) as n from part group by 1)
select p_partkey, position, concept, n, c.concept is not null as known from (select p_partkey, 0 as position, p_brand as concept from part union all select p_partkey, 1, p_type from part) left join c using (concept)""")
def concept_rows(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    concepts = part.groupBy(F.col("p_brand").alias("concept")).agg(F.count("*").alias("n"))
    return records.concept_lookup(part.select("p_partkey", F.array("p_brand", "p_type").alias("names")), concepts, "p_partkey", "names")


@query("""
with k as (select distinct l_orderkey, l_linenumber from lineitem), a as (select distinct l_orderkey, l_linenumber from lineitem where l_returnflag = 'R')
select * from k except select * from a""")
def composite_misses(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    accepted = lines.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber").distinct()
    return records.matched_or_missing(lines.select("l_orderkey", "l_linenumber").distinct(), accepted, ["l_orderkey", "l_linenumber"])[1]


@query("""
select source, list_filter([case when count(*) < 60 then 'few' end, case when count(*) filter (where lang = 'en') > greatest(1, count(*) * 0.3) then 'english_heavy' end, case when sum(n_chars) < 50000 then 'short' end], lambda x: x is not null) as warnings
from documents group by 1""")
def balance_warnings(spark, sf_dir):
    counts = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("lang") == "en").alias("english"), F.sum("n_chars").alias("chars"))
    checks = [(F.col("n") < 60, "few"), (F.col("english") > F.greatest(F.lit(1), F.col("n") * 0.3), "english_heavy"), (F.col("chars") < 50000, "short")]
    return records.warnings(counts, checks).select("source", "warnings")


@query("select user_id, count(*) as n, count(*) filter (where event_type = 'click') as covered, round(avg((event_type = 'click')::int), 6) as share, min(event_id) as first, max(event_id) as last from events group by 1")
def series_coverage(spark, sf_dir):
    return records.series_coverage(table(spark, sf_dir, "events"), "user_id", "event_id", F.col("event_type") == "click").withColumn("share", F.round("share", 6))


@query("select l_returnflag, count(*) as n, sum(l_quantity)::double as seconds from lineitem group by 1")
def label_totals(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", F.lit(0.0).alias("s"), F.col("l_quantity").cast("double").alias("e"))
    return records.label_totals(lines, "l_returnflag", "s", "e")


_AUDIT = """
with a as (select d.doc_id, case l.quality when 1 then 'approved' when 0 then 'rejected' end as review_state, list_filter([case when d.n_chars < 500 then 'source_missing' end, case when d.n_chars >= 500 and d.lang = 'fr' then 'source_changed' end,
  case when l.doc_id is null then 'result_missing' end, case when l.doc_id is null or l.toxic = 1 then 'raw_missing' end, case when l.doc_id is not null and coalesce(l.quality = 0, true) then 'low_quality' end], lambda x: x is not null) as errors
  from documents d left join labels l using (doc_id))
"""


def _audited(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", dedup.content_hash(F.col("text")).alias("h"))
    tasks = docs.select("doc_id", F.when(F.col("lang") == "fr", "old").otherwise(F.col("h")).alias("sha256"))
    sources = docs.where("n_chars >= 500").select("doc_id", F.col("h").alias("sha256_now"))
    results = table(spark, sf_dir, "labels").select("doc_id", "quality", F.when(F.col("toxic") != 1, "raw").alias("raw"), F.when(F.col("quality") == 1, "approved").when(F.col("quality") == 0, "rejected").alias("review_state"))
    return records.record_audit(tasks, sources, results, "doc_id", [(F.col("quality") == 0, "low_quality")])


@query(_AUDIT + "select doc_id, errors from a")
def record_audit(spark, sf_dir):
    return _audited(spark, sf_dir).select("doc_id", "errors")


@query(_AUDIT + """
select count(*) as total, count(*) filter (where len(errors) = 0) as valid, count(*) filter (where len(errors) > 0) as invalid,
  count(*) filter (where review_state = 'approved') as approved, count(*) filter (where review_state = 'rejected') as rejected, count(*) filter (where review_state = 'pending') as pending from a""")
def audit_summary(spark, sf_dir):
    return records.audit_summary(_audited(spark, sf_dir))


@query("""
select doc_id, case when doc_id in (select doc_id from documents where lang <> 'fr') then 'pending' else 'unknown' end as review_state,
  case when doc_id in (select doc_id from documents where lang <> 'fr') then 'unassigned' end as split from labels""")
def record_import(spark, sf_dir):
    good, unknown = records.import_records(table(spark, sf_dir, "labels").select("doc_id"), table(spark, sf_dir, "documents").where("lang <> 'fr'"), "doc_id")
    return good.select("doc_id", "review_state", "split").unionByName(unknown.select("doc_id", F.lit("unknown").alias("review_state"), F.lit(None).cast("string").alias("split")))


@query("""
with c as (select (select count(*) from documents) as assets, count(*) as tasks, count(quality) as complete, count(*) filter (where toxic = 1) as subjects,
  count(*) filter (where toxic = 1 and quality = 0) as isolated, count(*) filter (where quality = 1) as reviewed from labels)
select 'source_ingestion' as id, 'complete' as status, []::varchar[] as blockers from c union all
select 'structured_captioning', case when complete = tasks then 'complete' else 'blocked' end, case when complete = tasks then [] else ['results ' || complete || '/' || tasks] end from c union all
select 'identity_isolation', case when isolated = subjects then 'complete' else 'blocked' end, case when isolated = subjects then [] else ['isolations ' || isolated || '/' || subjects] end from c union all
select 'caption_review', case when reviewed = tasks then 'complete' else 'blocked' end, case when reviewed = tasks then [] else ['reviews ' || reviewed || '/' || tasks] end from c union all
select 'concept_datasets', 'blocked', ['no ready dataset'] from c union all select 'concept_training', 'blocked', ['training adapter'] from c""")
def intake_stages(spark, sf_dir):
    toxic = F.col("toxic") == 1
    counts = table(spark, sf_dir, "labels").agg(F.count("*").alias("tasks"), F.count("quality").alias("complete"), F.count_if(toxic).alias("subjects"), F.count_if(toxic & (F.col("quality") == 0)).alias("isolated"), F.count_if(F.col("quality") == 1).alias("reviewed"), F.lit(0).alias("datasets_ready"))
    assets = table(spark, sf_dir, "documents").agg(F.count("*").alias("assets"))  # one row each
    return records.intake_stages(counts.crossJoin(assets))


@query("select p_partkey, 'blocked_stub' as status, false as production_ready, false as consumed, p_type as reason from part where p_size > 45")
def stub_contracts(spark, sf_dir):
    return records.stubs(table(spark, sf_dir, "part").where("p_size > 45"), "p_partkey", "p_type")


@query("select o_orderkey, row_number() over (order by o_orderpriority <> '1-URGENT', o_orderkey) as rank from orders order by 2 limit 50")
def first_review_order(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return aggregates.ranked(o.select("o_orderkey", "o_orderpriority"), records.first_review_order(F.when(F.col("o_orderpriority") == "1-URGENT", "first_review"), F.col("o_orderkey")), 50).select("o_orderkey", F.col("rank").cast("long").alias("rank"))


@query("""
select event_id, case when value / 500 >= 0.18 then 'close_up' when value / 500 >= 0.07 then 'head_and_shoulders' when value / 500 >= 0.025 then 'medium' when event_type = 'view' then 'wide_or_full_body' else 'undetermined' end as size,
  strftime(make_timestamp(event_id * 1000 * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') as at from events""")
def shot_sizes(spark, sf_dir):
    poses = F.when(F.col("event_type") == "view", 1).otherwise(0)
    return table(spark, sf_dir, "events").select("event_id", records.shot_size(F.col("value") / 500, poses).alias("size"), records.iso_time(F.col("event_id") * 1000).alias("at"))


@query("""
select p_partkey, p_size < 25 as flagged from part""")
def narrow_ages(spark, sf_dir):
    text = F.concat_ws(" ", "p_name", F.col("p_size").cast("string"), F.when(F.col("p_size") < 25, "Years-old").otherwise("years"))
    return table(spark, sf_dir, "part").select("p_partkey", records.narrow_age(text).alias("flagged"))


@query("""
with q as (select l_orderkey, l_quantity as q, row_number() over (partition by l_orderkey order by abs(l_quantity - 25), l_quantity) as r from lineitem)
select l_orderkey, q as nearest from q where r = 1""")
def nearest_values(spark, sf_dir):
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_quantity").alias("q"))
    return lists.select("l_orderkey", records.nearest_in(F.col("q"), F.lit(25)).alias("nearest"))


@query("""
select vec_id, case when embedding[1] > 0.1 and embedding[1] - embedding[2] >= 0.07 and label <> 3 then 'own' when embedding[2] > 0.05 then 'other' else 'bad_data' end as result from embeddings""")
def margin_labels(spark, sf_dir):
    a, b = F.col("embedding")[0], F.col("embedding")[1]
    rules = [((a > F.lit(0.1).cast("float"), (a.cast("double") - b.cast("double")) >= 0.07, F.col("label") != 3), "own"), ((b > F.lit(0.05).cast("float"),), "other")]
    return table(spark, sf_dir, "embeddings").select("vec_id", records.margin_label(rules, "bad_data").alias("result"))


@query("""
with f as (select vec_id, list_transform(embedding[1:9], lambda x: x::double) as e from embeddings),
j as (select vec_id, i, ['left_hip', 'right_hip', 'nose'][i + 1] as name, e[3 * i + 1] / 4 as x, e[3 * i + 2] / 2 as y, case when e[3 * i + 1] < 0 or e[3 * i + 2] < 0 then 0.0 else e[3 * i + 3] end as confidence from f, (select unnest([0, 1, 2]) as i))
select vec_id, name, x, y, confidence from j union all
select a.vec_id, 'root', (a.x + b.x) / 2, (a.y + b.y) / 2, least(a.confidence, b.confidence) from j a join j b on a.vec_id = b.vec_id and a.i = 0 and b.i = 1 where least(a.confidence, b.confidence) > 0""")
def keypoint_joints(spark, sf_dir):
    joints = records.keypoint_joints(F.slice("embedding", 1, 9), ["left_hip", "right_hip", "nose"], F.lit(4.0), F.lit(2.0))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.explode(joints).alias("j")).select("vec_id", "j.*")


@query("""
with recursive p as (select label, vec_id // 30 as frame, vec_id, embedding[1]::double as x, embedding[2]::double as y, embedding[3]::double as c from embeddings),
f as (select label, frame, dense_rank() over (partition by label order by frame) as i, vec_id, x, y, c from p),
w as (select label, i, frame, vec_id, x, y from (select *, row_number() over (partition by label order by c desc, vec_id) as r from f where i = 1) where r = 1
  union all select label, i, frame, vec_id, x, y from (select f.*, row_number() over (partition by f.label order by sqrt((f.x - w.x) * (f.x - w.x) + (f.y - w.y) * (f.y - w.y)), f.c desc, f.vec_id) as r from w join f on f.label = w.label and f.i = w.i + 1) where r = 1)
select label, frame, vec_id from w""")
def performer_track(spark, sf_dir):
    e = F.col("embedding")
    poses = table(spark, sf_dir, "embeddings").select("label", F.floor(F.col("vec_id") / 30).alias("frame"), "vec_id", *(e[i].cast("double").alias(n) for i, n in enumerate(("x", "y", "c"))))
    return records.associate_performer(poses, "label", "frame", "vec_id", "x", "y", "c")


# -- joins, gates and aggregates that had no query ------------------------------------------------------


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by event_id desc) as r from events) where r = 1")
def last_row_wins(spark, sf_dir):
    return joins.last_wins(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("select p_partkey, p_brand || '/' || p_name as path from part where p_brand = (select min(p_brand) from part)")
def namespace_rows(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    first = part.agg(F.min("p_brand")).first()[0]
    return joins.in_namespace(part.select("p_partkey", F.concat_ws("/", "p_brand", "p_name").alias("path")), "path", first)


@query("select event_type as type, count(*) as n, (select count(*) from events where starts_with(event_type, 'c')) as with_prefix from events group by 1")
def type_histogram(spark, sf_dir):
    return aggregates.histogram(table(spark, sf_dir, "events").select("event_type"), "event_type", "c").select(F.explode("counts").alias("type", "n"), "with_prefix")


@query("select p_brand as owner, p_type as kind, p_size::varchar as field, count(distinct p_name) as n from part group by all")
def contract_fields(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("owner"), F.col("p_type").alias("kind"), F.col("p_size").cast("string").alias("field"), F.col("p_name").alias("value"), F.lit("part").alias("source"))
    nested = aggregates.nested_contracts(rows, "owner", "kind", "field", "value", "source")
    return nested.select("owner", "kind", F.explode("fields").alias("field", "values")).select("owner", "kind", "field", F.size("values").cast("long").alias("n"))


@query("""
select l_orderkey, coalesce(sum(l_quantity) filter (where l_returnflag = 'R'), 0)::double as master_seconds, coalesce(sum(l_quantity) filter (where l_returnflag <> 'R'), 0)::double as other_seconds,
  round(sum(l_quantity)::double / nullif(coalesce(sum(l_quantity) filter (where l_returnflag = 'R'), 0), 0), 6) as multiplier from lineitem group by 1""")
def timeline_totals(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", F.col("l_quantity").cast("double").alias("q"))
    return aggregates.timeline_totals(lines, "l_orderkey", "l_returnflag", "q", "R").withColumn("multiplier", F.round("multiplier", 6))


@query("""
select l_orderkey, list(l_quantity order by l_linenumber, l_partkey, l_suppkey, l_extendedprice)[1]::double as start, round(sum(l_quantity), 6)::double as seconds, list(l_returnflag order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as audio from lineitem group by 1""")
def sequence_rows(spark, sf_dir):
    shots = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct(*LINE_ORDER).alias("o"), F.col("l_quantity").cast("double").alias("q"), F.array("l_returnflag").alias("audio"))
    return aggregates.assemble_sequences(shots, "l_orderkey", "o", "q", "q", "audio")


@query("""
select o_orderkey, declared, counted from (select o_orderkey, o_custkey % 5 as declared, coalesce(n, 0) as counted from orders left join (select l_orderkey, count(*) as n from lineitem group by 1) on l_orderkey = o_orderkey) where declared <> counted""")
def wrong_totals(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 5).alias("d"))
    return aggregates.declared_totals(o, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "d")


@query("""
with r as (select row_number() over (order by event_type) as n, event_type as requirement, sum(value) > 0.2 * (select sum(value) from events) as passed from events group by 2)
select count(*) as total, count(*) filter (where passed) as passed, coalesce(list(requirement order by n) filter (where not passed), []) as blockers from r""")
def requirement_audit(spark, sf_dir):
    sums = table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum("value").alias("v"))
    whole = table(spark, sf_dir, "events").agg(F.sum("value").alias("all"))  # one row
    rows = select.global_rank(sums, "event_type", out="n").crossJoin(F.broadcast(whole))
    return aggregates.requirement_audit(rows.select("n", F.col("event_type").alias("requirement"), (F.col("v") > 0.2 * F.col("all")).alias("passed")))


@query("""
with m as (select label, vec_id % 3 as s, i, avg(embedding[i]::double) as x from embeddings, (select unnest(range(1, 65)) as i) group by 1, 2, 3), c as (select label, i, avg(x) as x from m group by 1, 2)
select label, i - 1 as i, round(x / sqrt(sum(x * x) over (partition by label)), 5) as x from c""")
def source_centroid(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("label", (F.col("vec_id") % 3).alias("s"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    c = aggregates.centroid(rows, "label", "s", "v")
    return c.select("label", F.posexplode("centroid").alias("i", "x")).select("label", F.col("i").cast("long").alias("i"), F.round("x", 5).alias("x"))


@query("select sha256(text) as sha256, list(distinct source order by source) as sources, list(distinct lang order by lang) as langs from documents group by 1")
def merged_blobs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(dedup.content_hash(F.col("text")).alias("sha256"), F.array("source").alias("sources"), F.array("lang").alias("langs"))
    return aggregates.merge_blobs(docs, "sha256", ["sources", "langs"])


@query("select p_name, path, p_size from (select p_name, p_partkey::varchar as path, p_size, row_number() over (partition by p_name order by p_size, p_partkey::varchar) as r from part) where r = 1")
def name_precedence(spark, sf_dir):
    return aggregates.precedence(table(spark, sf_dir, "part").select("p_name", F.col("p_partkey").cast("string").alias("path"), "p_size"), "p_name", "p_size")


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by event_id::varchar desc) as r from events) where r = 1")
def latest_report(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.col("event_id").cast("string").alias("path"))
    return aggregates.latest(e, "user_id", "path").drop("path")


@query("select doc_id, case when n_chars < 300 then 'ignored' else 'unmatched' end as leftover from documents where doc_id not in (select doc_id from labels)")
def leftover_rows(spark, sf_dir):
    return gates.partition_leftovers(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "labels"), "doc_id", F.col("n_chars") < 300).drop("n_chars")


@query("""
select vec_id, round(x / s - rx / s, 6) as rel_x, round(y / s - ry / s, 6) as rel_y from (
  select vec_id, x, y, case when max(y) over w > min(y) over w then max(y) over w - min(y) over w else 1 end as s, max(case when root then x end) over w as rx, max(case when root then y end) over w as ry
  from (select vec_id, label, embedding[1]::double as x, embedding[2]::double as y, vec_id = min(vec_id) over (partition by label) as root from embeddings) window w as (partition by label))""")
def root_relative(spark, sf_dir):
    from pyspark.sql import Window

    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"), (F.col("vec_id") == F.min("vec_id").over(Window.partitionBy("label"))).alias("root"))
    return ordered.root_relative(e, ["label"], "x", "y", F.col("root")).select("vec_id", F.round("rel_x", 6).alias("rel_x"), F.round("rel_y", 6).alias("rel_y"))


@query("""
select p_partkey, layer, z from (select p_partkey, 'base' as layer, 0 as z from part union all select p_partkey, 'logo', 2 from part where p_size > 25 union all select p_partkey, 'shadow', 1 from part where p_retailprice > 1000)""")
def render_layers(spark, sf_dir):
    return planning.layers(table(spark, sf_dir, "part"), "p_partkey", [("base", F.lit(True), 0), ("logo", F.col("p_size") > 25, 2), ("shadow", F.col("p_retailprice") > 1000, 1)])


@query("""
with have as (select distinct l_partkey::varchar as path from lineitem where l_quantity > 40),
i as (select l_orderkey, l_partkey::varchar as path from lineitem), m as (select l_orderkey, list(distinct path order by path) as missing from i where path not in (select path from have) group by 1)
select k.l_orderkey, coalesce(missing, []) as missing, case when missing is null then 'ready' else 'blocked' end as state from (select distinct l_orderkey from lineitem) k left join m using (l_orderkey)""")
def render_queue(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").cast("string").alias("path"), "l_quantity")
    queue = lines.groupBy("l_orderkey").agg(F.collect_set("path").alias("inputs"))
    files = lines.groupBy("path").agg(F.bool_or(F.col("l_quantity") > 40).alias("exists"))
    return planning.required_inputs(queue, files, "l_orderkey", "inputs").select("l_orderkey", "missing", "state")


@query("select event_type as kind, 2000 as least, count(*) as n from events group by 1 having count(*) < 2000")
def class_shortfalls(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"))
    return graph.class_shortfalls(e, e.select("kind").distinct().withColumn("least", F.lit(2000)))


@query("""
select doc_id, case when doc_id in (select doc_id from labels where quality = 1) then 'consumed' when doc_id in (select doc_id from labels) then 'prepared' else 'blocked' end as state from documents""")
def consumption_states(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return aggregates.consumption(table(spark, sf_dir, "documents"), labels, labels.where("quality = 1"), "doc_id")


@query("""
select d.doc_id, d.lang as claimed, l.seen as observed, case when l.seen is null then 'unobserved' when l.seen = d.lang then 'supported' when toxic = 1 then 'invalid' else 'contradicted' end as verdict
from documents d left join (select doc_id, case when quality = 1 then 'en' else 'de' end as seen, toxic from labels) l using (doc_id)""")
def claim_verdicts(spark, sf_dir):
    evidence = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "en").otherwise("de").alias("value"), F.when(F.coalesce(F.col("toxic"), F.lit(0)) != 1, "page").alias("reference"))
    return aggregates.disagreements(table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("value")), evidence, "doc_id")


@query("""
select user_id, list_filter([case when count(distinct event_type) <> 2 then 'half_missing' end, case when count(distinct value > 90) > 1 then 'rank_mismatch' end], lambda x: x is not null) as reasons
from events where event_type in ('click', 'view') group by 1 having count(distinct event_type) <> 2 or count(distinct value > 90) > 1""")
def module_pairs(spark, sf_dir):
    halves = table(spark, sf_dir, "events").where("event_type in ('click', 'view')").select("user_id", "event_type", (F.col("value") > 90).alias("rank"))
    return planning.incomplete_pairs(halves, "user_id", "event_type", "rank", ["click", "view"])


@query("select count(*) filter (where l_returnflag <> 'N') as hard, count(*) filter (where l_returnflag = 'N') as waiting, count(*) filter (where l_returnflag <> 'N') = 0 as may_start, count(*) = 0 as may_complete from lineitem")
def blocker_kinds(spark, sf_dir):
    return status.split_blockers(table(spark, sf_dir, "lineitem"), F.col("l_returnflag") == "N")


@query("select p_partkey, array_to_string(list_filter([trim(p_brand), case when p_type <> p_brand then trim(p_type) end], lambda x: x <> ''), ', ') as text from part")
def assembled_text(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", planning.assemble_text([F.col("p_brand"), F.col("p_type"), F.col("p_brand"), F.lit(" ")]).alias("text"))


@query("""
select o_orderkey, list_filter([case when o_orderstatus = 'P' then 'missing' end, case when o_totalprice < 100000 then 'empty' end, case when o_custkey % 3 <> 1 then 'not_mono' end], lambda x: x is not null) as reasons from orders""")
def technical_checks(spark, sf_dir):
    size = F.when(F.col("o_totalprice") < 100000, 0).otherwise(1)
    return table(spark, sf_dir, "orders").select("o_orderkey", review.technical_check(F.col("o_orderstatus") != "P", size, F.col("o_custkey") % 3).alias("reasons"))


@query("""
select e.event_id, e.user_id, coalesce(o.status, 'observed') as status from events e join (select user_id, case when max(value) > 200 then 'seen' end as status from events group by 1) o using (user_id)""")
def observation_fan_out(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    seen = e.groupBy("user_id").agg(F.when(F.max("value") > 200, "seen").alias("status"))
    return review.fan_out(seen, e.select("event_id", "user_id"), "user_id")


@query("select p_partkey, p_partkey % 100 / 7 as ratio_in, round((p_partkey % 100) / 7.0, 6) as ratio from part")
def rational_values(spark, sf_dir):
    k = F.col("p_partkey") % 100
    return table(spark, sf_dir, "part").select("p_partkey", (k / 7).alias("ratio_in"), S.rational(F.concat(k.cast("string"), F.lit("/7"))).alias("ratio"))
