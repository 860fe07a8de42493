"""Named queries over nested values, files and long series, with their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .functions import json_schema, nested
from .operators.dedup import shared_dir
from .plans import manifest
from .queries import query
from .sources import blobs, headers, versions
from .sources.tables import table
from .streaming import poses

# -- nested values -----------------------------------------------------------------------------------

#: A document's record as its schema wants it.
RECORD_SCHEMA = {
    "$schema": "https://json-schema.org/draft/2020-12/schema",
    "type": "object",
    "required": ["id", "lang", "size", "tags"],
    "properties": {
        "id": {"type": "integer"},
        "lang": {"enum": ["en", "de", "fr"]},
        "size": {"$ref": "#/$defs/size"},
        "tags": {"type": "array", "maxItems": 3, "items": {"type": "string", "minLength": 1, "pattern": "^[a-z]"}},
    },
    "additionalProperties": False,
    "$defs": {"size": {"type": "object", "required": ["chars"], "properties": {"chars": {"type": "integer", "minimum": 100}}, "additionalProperties": {"type": "boolean"}}},
}


@query("""
with r as (select doc_id, case when n_chars % 3 > 0 then lang end as lang, n_chars, source from documents)
select doc_id, '/lang' as path, 'required' as keyword from r where lang is null
union all select doc_id, '/lang', 'enum' from r where lang not in ('en', 'de', 'fr')
union all select doc_id, '/size/chars', 'type' from r where n_chars % 5 = 0
union all select doc_id, '/size/chars', 'minimum' from r where n_chars % 5 > 0 and n_chars < 100
union all select doc_id, '/size/extra', 'type' from r where n_chars % 7 = 0
union all select doc_id, '/tags/1', 'type' from r where n_chars % 11 = 0
union all select doc_id, '/tags/1', 'minLength' from r where n_chars % 11 = 1
union all select doc_id, '/tags/1', 'pattern' from r where n_chars % 11 = 1
union all select doc_id, '/note', 'additionalProperties' from r where n_chars % 13 = 0""")
def schema_errors(spark, sf_dir):
    n = F.col("n_chars")
    size = F.when(n % 5 == 0, F.to_json(F.struct(n.cast("string").alias("chars"), F.when(n % 7 == 0, n).alias("extra")))).otherwise(F.to_json(F.struct(n.alias("chars"), F.when(n % 7 == 0, n).alias("extra"))))
    tags = F.to_json(F.array(F.col("source"), F.when(n % 11 == 1, "").otherwise(F.col("source"))))
    tags = F.when(n % 11 == 0, F.format_string("[%s,%d]", F.to_json(F.array("source")).substr(F.lit(2), F.length(F.to_json(F.array("source"))) - 2), n)).otherwise(tags)
    lang = F.when((n % 3 > 0) & F.col("lang").isNotNull(), F.concat(F.lit('"lang":"'), F.col("lang"), F.lit('",'))).otherwise("")
    note = F.when(n % 13 == 0, F.lit(',"note":{}')).otherwise("")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit('{"id":'), F.col("doc_id").cast("string"), F.lit(","), lang, F.lit('"size":'), size, F.lit(',"tags":'), tags, note, F.lit("}")).alias("body"))
    return docs.select("doc_id", F.explode(json_schema.text_errors(F.col("body"), RECORD_SCHEMA)).alias("e")).select("doc_id", "e.*")


@query(r"""
select o_orderkey, sha256('{"customer":{"id":' || o_custkey || ',"names":{"a\"b":null,"z":"\u00e9' || o_orderpriority || '"}},"lines":[' ||
  (select string_agg('{"at":' || l_linenumber || ',"price":' || cast(l_extendedprice as varchar) || '}', ',' order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) from lineitem where l_orderkey = o_orderkey)
  || '],"open":' || (o_orderstatus = 'O')::varchar || ',"total":' || cast(o_totalprice as varchar) || '}') as sha256
from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey)""")
def canonical_hashes(spark, sf_dir):
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    names = F.create_map(F.lit("z"), F.concat(F.lit("é"), "o_orderpriority"), F.lit('a"b'), F.lit(None).cast("string"))
    orders = table(spark, sf_dir, "orders").join(lines, "o_orderkey").select(
        "o_orderkey",
        F.col("o_totalprice").alias("total"),
        F.struct(names.alias("names"), F.col("o_custkey").alias("id")).alias("customer"),
        (F.col("o_orderstatus") == "O").alias("open"),
        F.transform("lines", lambda x: F.struct(x["l_extendedprice"].alias("price"), x["l_linenumber"].alias("at"))).alias("lines"),
    )
    return orders.select("o_orderkey", nested.canonical_hash(orders, "total", "customer", "open", "lines").alias("sha256"))


@query("""
select page_id, case when starts_with(url, 'http://') then '/plain/' || substr(url, 8) when starts_with(url, 'https://') then '/secure/' || substr(url, 9) else url end as url,
  '/secure' as root, '/build-x/a' as kept, 'provenance/b' as other from pages""")
def rewritten_roots(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.struct(F.array(F.struct(F.replace("url", F.lit("://"), F.lit(":/")).alias("/build"))).alias("urls"), F.create_map(F.lit("https:"), F.lit("https:"), F.lit("k"), F.lit("/build-x/a"), F.lit("o"), F.lit("/build/a/b")).alias("more")).alias("doc"))
    out = nested.rewrite_roots(pages, ["doc"], {"http:": "/plain", "https:": "/secure"}, "provenance", "/build")
    return out.select("page_id", F.col("doc.urls")[0]["/build"].alias("url"), F.col("doc.more")["https:"].alias("root"), F.col("doc.more")["k"].alias("kept"), F.col("doc.more")["o"].alias("other"))

# -- files ------------------------------------------------------------------------------------------------


def _folder(spark) -> str:
    """A new folder that all executors share."""
    return f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"


def _big(number, digits=8):
    return F.unhex(F.lpad(F.hex(number), digits, "0"))


def _little(number, digits=8):
    return F.unhex(F.concat(*(F.substring(F.lpad(F.hex(number), digits, "0"), i, 2) for i in range(digits - 1, 0, -2))))


def _headers(spark, rows, key, kind):
    """What the header source reads of files that hold the contents of rows (key, content)."""
    root = _folder(spark)
    written = blobs.write_blobs(rows.select(F.concat(F.lit(root + "/"), F.col(key).cast("string"), F.lit(".bin")).alias("target"), "content"))
    blobs.require_copied(written)
    spark.dataSource.register(headers.HeaderSource)
    found = spark.read.format("file_headers").option("kind", kind).option("glob", "*.bin").load(root)
    return found.withColumn(key, F.regexp_extract("path", r"([0-9]+)\.bin$", 1).cast("long"))


@query("""
select s_suppkey, case when s_nationkey <> 7 then s_suppkey % 5000 + 1 end as width, case when s_nationkey <> 7 then s_nationkey + 1 end as height,
  24 + 10 * length(s_name) * s_nationkey as bytes from supplier""")
def image_headers(spark, sf_dir):
    """Pictures of growing length, some without a right signature; no more than one block is read of any."""
    s = table(spark, sf_dir, "supplier")
    mark = F.when(F.col("s_nationkey") == 7, F.unhex(F.lit("89504E470D0A1A0B"))).otherwise(F.unhex(F.lit("89504E470D0A1A0A")))
    content = F.concat(mark, F.unhex(F.lit("0000000D49484452")), _big(F.col("s_suppkey") % 5000 + 1), _big(F.col("s_nationkey") + 1), F.encode(F.repeat("s_name", F.col("s_nationkey") * 10), "UTF-8"))
    found = _headers(spark, s.select("s_suppkey", content.alias("content")), "s_suppkey", "image")
    return found.select("s_suppkey", F.when(F.col("bytes_read") <= headers.BLOCK, F.col("width")).alias("width"), "height", "bytes")


@query("""
select s_suppkey, s_nationkey % 2 + 1 as channels, 8000 + s_suppkey % 1000 as rate, (1000 * (s_nationkey + 1)) / ((8000 + s_suppkey % 1000) * 2.0 * (s_nationkey % 2 + 1)) as seconds from supplier""")
def audio_headers(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    channels, rate, size = (F.col("s_nationkey") % 2 + 1).cast("long"), 8000 + F.col("s_suppkey") % 1000, (F.col("s_nationkey").cast("long") + 1) * 1000
    text = lambda t: F.encode(F.lit(t), "UTF-8")
    fmt = F.concat(text("fmt "), _little(F.lit(16)), _little(F.lit(1), 4), _little(channels, 4), _little(rate), _little(rate * channels * 2), _little(channels * 2, 4), _little(F.lit(16), 4))
    content = F.concat(text("RIFF"), _little(size + 44), text("WAVELIST"), _little(F.lit(3)), text("abc\0"), fmt, text("data"), _little(size), F.unhex(F.repeat(F.lit("00"), size.cast("int"))))
    found = _headers(spark, s.select("s_suppkey", content.alias("content")), "s_suppkey", "wav")
    return found.select("s_suppkey", "channels", "rate", "seconds")


@query("""
with s as (select s_suppkey, case when s_nationkey = 3 then 'missing' when s_nationkey = 4 then 'ambiguous' when s_acctbal < 0 then 'changed' when s_nationkey = 5 then 'differs' else 'written' end as state from supplier)
select s_suppkey, 1 as run, state from s union all select s_suppkey, 2, case state when 'written' then 'identical' else state end from s""")
def copied_files(spark, sf_dir):
    """Two runs of one plan of verified copies."""
    s, root = table(spark, sf_dir, "supplier"), _folder(spark)
    place = lambda folder, name: F.concat(F.lit(f"{root}/{folder}/"), name)
    key = F.col("s_suppkey").cast("string")
    blobs.require_copied(blobs.write_blobs(s.where("s_nationkey <> 3").select(place("from", key).alias("target"), F.encode("s_name", "UTF-8").alias("content"))))
    blobs.require_copied(blobs.write_blobs(s.where("s_nationkey = 5").select(place("to", key).alias("target"), F.encode(F.lit("other"), "UTF-8").alias("content"))))
    twin = F.when(F.col("s_nationkey") == 4, F.lit("one")).otherwise(key)
    plan = s.select("s_suppkey", place("from", key).alias("source"), place("to", twin).alias("target"), F.sha2(F.when(F.col("s_acctbal") < 0, "x").otherwise(F.col("s_name")), 256).alias("expected"))
    runs = [blobs.copy_files(plan).select("source", F.lit(i).alias("run"), "state") for i in (1, 2)]
    return runs[0].unionByName(runs[1]).join(plan.select("source", "s_suppkey"), "source").select("s_suppkey", "run", "state")

# -- series -----------------------------------------------------------------------------------------------


@query("""
with recursive p as (select label, vec_id // 30 as frame, vec_id, embedding[64]::double as sure,
    [embedding[3 * j + 1]::double for j in range(21)] as x, [embedding[3 * j + 2]::double for j in range(21)] as y, [embedding[3 * j + 3]::double >= 0.05 for j in range(21)] as ok from embeddings),
q as (select *, len(list_filter(ok, lambda o: o)) as n from p),
c as (select *, list_sum([case when ok[j] then x[j] else 0 end for j in range(1, 22)]) / n as cx, list_sum([case when ok[j] then y[j] else 0 end for j in range(1, 22)]) / n as cy,
    dense_rank() over (partition by label order by frame) as k from q where n > 0),
s as (
  (select label, k, frame, vec_id, cx, cy, ok, [case when ok[j] then x[j] end for j in range(1, 22)] as sx, [case when ok[j] then y[j] end for j in range(1, 22)] as sy
   from c where k = 1 qualify row_number() over (partition by label order by sure desc, vec_id) = 1)
  union all
  (select c.label, c.k, c.frame, c.vec_id, c.cx, c.cy, c.ok,
     [case when c.ok[j] then 0.35 * c.x[j] + 0.65 * coalesce(s.sx[j], c.x[j]) else s.sx[j] end for j in range(1, 22)], [case when c.ok[j] then 0.35 * c.y[j] + 0.65 * coalesce(s.sy[j], c.y[j]) else s.sy[j] end for j in range(1, 22)]
   from s join c on c.label = s.label and c.k = s.k + 1 qualify row_number() over (partition by c.label order by sqrt((c.cx - s.cx) ** 2 + (c.cy - s.cy) ** 2), c.sure desc, c.vec_id) = 1)),
f as (select label, frame, vec_id as pose, len(list_filter(ok, lambda o: o)) as joints, list_sum([case when ok[j] then sx[j] else 0 end for j in range(1, 22)]) as x, list_sum([case when ok[j] then sy[j] else 0 end for j in range(1, 22)]) as y from s)
select a.label, a.frame, case when pose is null then 'lost' else 'followed' end as status, pose, coalesce(joints, 0) as joints, coalesce(x, 0) as x, coalesce(y, 0) as y
from (select distinct label, frame from p) a left join f on a.label = f.label and a.frame = f.frame""")
def performer_poses(spark, sf_dir):
    v = F.transform("embedding", lambda x: x.cast("double"))
    joints = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda j: F.struct(j.cast("string").alias("name"), F.get("v", 3 * j).alias("x"), F.get("v", 3 * j + 1).alias("y"), F.get("v", 3 * j + 2).alias("confidence")))
    rows = table(spark, sf_dir, "embeddings").withColumn("v", v).select("label", F.timestamp_seconds(F.floor(F.col("vec_id") / 30)).alias("t"), "vec_id", F.get("v", F.lit(63)).alias("sure"), joints.alias("joints"))
    found = poses.follow_performer(rows, "label", "t", "vec_id", "sure", "joints", floor=0.05)
    total = lambda c: F.aggregate("joints", F.lit(0.0), lambda t, j: t + j[c])
    return found.select("label", F.unix_seconds("t").alias("frame"), "status", "pose", F.size("joints").cast("long").alias("joints"), total("x").alias("x"), total("y").alias("y"))

# -- versions ---------------------------------------------------------------------------------------------


@query("""
select * from (select doc_id, lang, n_chars from documents where lang in ('en', 'de')
  union all select doc_id, lang, n_chars * 2 from documents where lang = 'fr')""")
def published_versions(spark, sf_dir):
    """Three languages published, one replaced, the rest dropped as no longer expected; an audit refuses the last write."""
    docs, folder = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), versions.VersionedFolder(spark, _folder(spark))
    folder.publish(docs, by="lang")
    folder.publish(docs.where("lang = 'fr'").withColumn("n_chars", F.col("n_chars") * 2), {"not empty": lambda df: not df.isEmpty()}, by="lang", expected=["en", "de", "fr"])
    try:
        folder.publish(docs.withColumn("n_chars", -F.col("n_chars")), {"positive": lambda df: df.where("n_chars < 0").isEmpty()})
    except versions.AuditFailed:
        return folder.read()
    raise AssertionError("an audit passed that must not")


@query("""
with a as (select doc_id, quality, toxic, case when toxic = 1 then 3 when quality = 0 then 2 else 1 end as v from labels)
select d.doc_id, case a.v when 3 then 'rejected' when 2 then 'pending' when 1 then 'approved' else 'unseen' end as decision, coalesce(a.v, 0) as version
from documents d left join a using (doc_id)""")
def decision_log(spark, sf_dir):
    """Approved first, then taken back, then rejected, compacted in between; a writer that started too early is refused."""
    labels, log = table(spark, sf_dir, "labels"), versions.DecisionLog(spark, _folder(spark), "doc_id")
    one = lambda where, what: labels.where(where).select("doc_id", F.lit(what).alias("decision"))
    early = log.append(one("true", "approved"))
    log.append(one("quality = 0", "pending"))
    try:
        log.append(one("true", "late"), early)
    except versions.Conflict:
        log.append(one("toxic = 1", "rejected"))
        log.compact()
        merged = log.merge(table(spark, sf_dir, "documents").select("doc_id"), {"decision": F.lit("unseen")})
        return merged.select("doc_id", "decision", F.col("_version").alias("version"))
    raise AssertionError("a late writer was not refused")

# -- manifests --------------------------------------------------------------------------------------------

_FORMATIONS = ("wide", "medium", "detail")


def _manifest(spark, sf_dir):
    """Customers stand for projects, orders for scenes, lines for shots; suppliers and return flags for concepts."""
    fields = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag"]
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), *fields).repartition("o_orderkey")  # dealt as they are: lists begun before would only be sorted, and spilled
    lines = lines.groupBy("o_orderkey").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("lines"))
    shot = lambda x, i: F.struct(
        F.concat(F.lit("s"), (i + 1).cast("string")).alias("id"),
        x["l_quantity"].alias("duration_seconds"),
        F.array(F.concat(F.lit("supplier"), (x["l_suppkey"] % 10).cast("string")), F.concat(F.lit("flag"), x["l_returnflag"])).alias("active_concepts"),
        F.transform(F.slice(F.array(*map(F.lit, _FORMATIONS)), 1, x["l_linenumber"] % 3 + 1), lambda f: F.struct(f.alias("id"))).alias("formations"),
    )
    scenes = table(spark, sf_dir, "orders").join(lines, "o_orderkey").select("o_custkey", F.col("o_orderkey").alias("ord"), F.col("o_orderkey").cast("string").alias("id"), F.transform("lines", shot).alias("shots"))
    k = F.col("s_suppkey") % 10
    concepts = table(spark, sf_dir, "supplier").select(F.concat(F.lit("supplier"), k.cast("string")).alias("id"), F.when(k % 2 == 0, "lora").otherwise("reference").alias("strategy"), F.when(k % 4 == 0, "ready").otherwise("pending").alias("status"), (k % 3).alias("media")).distinct()
    flags = spark.createDataFrame([("flagA", "prompt", None, 0), ("flagN", "prompt", None, 0)], "id string, strategy string, status string, media long")
    return manifest.compile_manifest(scenes, concepts.unionByName(flags), 24.0, "mod8_plus1", by="o_custkey")


_LINES = """
with l as (select o_custkey, l_orderkey, l_quantity, l_linenumber % 3 + 1 as n, l_suppkey % 10 as k, l_returnflag,
  row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as shot from lineitem join orders on l_orderkey = o_orderkey),
f as (select *, l_quantity / n as seconds, unnest(['wide', 'medium', 'detail'][1:n]) as formation, unnest(range(n)) as nth from l),
b as (select *, l_orderkey || '__s' || shot || '__' || formation as task, l_orderkey || '/s' || shot || '/' || formation as place,
  list_filter([case when l_returnflag = 'R' then 'flagR:unknown_concept' end, case when k % 2 = 0 and k % 4 > 0 then 'supplier' || k || ':pending' end, case when k % 2 = 1 and k % 3 = 0 then 'supplier' || k || ':missing_reference_media' end], lambda x: x is not null) as held,
  greatest(1, round_even(seconds * 24, 0)::bigint) as target,
  sum(seconds) over (partition by o_custkey order by l_orderkey, shot, nth rows between unbounded preceding and 1 preceding) as before from f)
"""


@query(_LINES + """
select o_custkey, 'keyframe' as kind, 'keyframe__' || task as id, '' as depends_on, array_to_string(held, '; ') as blockers, '' as inherited, len(held) = 0 as ready,
  'outputs/keyframes/' || place || '.png' as output, null::bigint as frames, round(seconds, 6) as seconds, null::double as start_seconds from b
union all select o_custkey, 'video', 'video__' || task, 'keyframe__' || task, 'approved key frame; approved motion direction', array_to_string(held, '; '), false, 'outputs/clips/' || place || '.mp4',
  target - (target - 1) % 8 + case when (target - 1) % 8 > 4 then 8 else 0 end, round(seconds, 6), null from b
union all select o_custkey, 'assembly', 'assembly__' || task, 'video__' || task, '', array_to_string(list_concat(['approved key frame', 'approved motion direction'], held), '; '), false, 'outputs/clips/' || place || '.mp4',
  null, round(seconds, 6), round(coalesce(before, 0), 6) from b""")
def compiled_manifest(spark, sf_dir):
    text = lambda c: F.array_join(c, "; ").alias(c)
    return _manifest(spark, sf_dir).select("o_custkey", "kind", "id", text("depends_on"), text("blockers"), text("inherited"), "ready", "output", "frames", "seconds", "start_seconds")


@query(_LINES + """
select o_custkey, l_orderkey::varchar as scene_id, count(*) as keyframes, count(*) as videos, count(*) filter (len(held) = 0) as ready, count(distinct shot) filter (len(held) > 0) as blocked_shots, round(sum(round(seconds, 6)), 3) as seconds
from b group by 1, 2""")
def manifest_counts(spark, sf_dir):
    return manifest.manifest_counts(_manifest(spark, sf_dir), "o_custkey").withColumn("seconds", F.round("seconds", 3))
