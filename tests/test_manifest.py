"""Literal cases of compile manifests."""

from pyspark.sql import functions as F

from millrace.plans import manifest

SHOT = "struct<id: string, duration_seconds: double, active_concepts: array<string>, formations: array<struct<id: string>>>"


def test_blockers_are_carried_and_times_run_on(spark):
    both, one = [("wide",), ("close",)], [("wide",)]
    scenes = [
        ("p", 1, "b", [("s1", 3.0, ["face", "place"], one), ("s2", 1.0, None, [])]),
        ("p", 0, "a", [("s1", 4.0, [], both), ("s2", 1.0, ["hat", "none", "face"], one)]),
        ("q", 0, "a", [("s1", 2.0, None, one)]),
        ("q", 1, "empty", []),
    ]
    concepts = [("face", "lora", "ready", 0), ("hat", "lora", None, 5), ("place", "reference", "ready", None), ("other", "reference", None, 0)]
    out = manifest.compile_manifest(spark.createDataFrame(scenes, f"project string, ord int, id string, shots array<{SHOT}>"), spark.createDataFrame(concepts, "id string, strategy string, status string, media long"), 24.0, "mod8_plus1")
    rows = {r.id: r for r in out.collect() if r.project == "p"}
    assert len(rows) == 12 and out.where("project = 'q'").count() == 3
    assert {i: r.blockers for i, r in rows.items() if r.kind == "keyframe"} == {"keyframe__a__s1__wide": [], "keyframe__a__s1__close": [], "keyframe__a__s2__wide": ["none:unknown_concept", "hat:unknown"], "keyframe__b__s1__wide": ["place:missing_reference_media"]}
    assert [rows[f"assembly__{t}"].start_seconds for t in ("a__s1__wide", "a__s1__close", "a__s2__wide", "b__s1__wide")] == [0.0, 2.0, 4.0, 5.0]
    video = rows["video__b__s1__wide"]
    assert (video.depends_on, video.blockers, video.inherited, video.ready, video.frames, video.seconds) == (["keyframe__b__s1__wide"], list(manifest.VIDEO_GATES), ["place:missing_reference_media"], False, 73, 3.0)
    assert rows["assembly__b__s1__wide"].inherited == [*manifest.VIDEO_GATES, "place:missing_reference_media"] and rows["assembly__b__s1__wide"].output == video.output == "outputs/clips/b/s1/wide.mp4"
    assert [r.id for r in rows.values() if r.ready] and all(r.kind == "keyframe" for r in rows.values() if r.ready)
    counts = {(r.project, r.scene_id): tuple(r)[2:] for r in manifest.manifest_counts(out).collect()}
    assert counts == {("p", "a"): (3, 3, 2, 1, 5.0), ("p", "b"): (1, 1, 0, 1, 3.0), ("q", "a"): (1, 1, 1, 0, 2.0)}


def test_frames(spark):
    frames = lambda s, rule: spark.range(1).select(manifest.video_frames(F.lit(s), 24.0, rule).alias("n")).first().n
    assert [frames(s, "none") for s in (0.0, 0.0625, 1.0)] == [1, 2, 24] and [frames(s, "mod8_plus1") for s in (0.0, 1.0, 13 / 24, 14 / 24)] == [1, 25, 9, 17]


def test_scenes_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(row):
        made.add(1)
        return row

    kind = "project string, ord int, id string, shots array<struct<id string, duration_seconds double, active_concepts array<string>, formations array<struct<id string>>>>"
    rows = [("p", i, f"scene{i}", [("s1", 2.0, ["c"], [("wide",), ("detail",)])]) for i in range(3)]
    scenes = spark.createDataFrame(spark.sparkContext.parallelize(rows, 1).map(counted), kind)
    concepts = spark.createDataFrame([("c", "lora", "pending", 0)], "id string, strategy string, status string, media long")
    got = manifest.compile_manifest(scenes, concepts, 24.0).where("kind = 'assembly'").collect()
    assert sorted((r.scene_id, r.start_seconds) for r in got) == [(f"scene{i}", 2.0 * i + j) for i in range(3) for j in range(2)]
    assert made.value == 3


def _sample(spark):
    rows = [(f"p{i % 3}", i, f"scene{i}", [(f"s{j}", 1.0 + j, [["c", "d"], ["d"], None, [], ["new", None]][(i + j) % 5], [("wide",), ("detail",)][: j % 3]) for j in range(i % 4)]) for i in range(24)]
    concepts = [("c", "lora", "pending", 0), ("d", "reference", "ready", 0)]
    return spark.createDataFrame(rows, f"project string, ord int, id string, shots array<{SHOT}>"), spark.createDataFrame(concepts, "id string, strategy string, status string, media long")


def test_opened_shots_are_not_dealt(spark):
    lines = manifest.compile_manifest(*_sample(spark), 24.0)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [next(i for i, c in enumerate(line + "x") if c.isalnum()) for line in lines]
    dealt = 0
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            assert not any("Generate" in x for x in lines[i:below]), line
            dealt += 1
    assert dealt == 3  # scenes, their sums by project, their starts


def test_many_lists_of_concepts_give_the_same_tasks(spark, monkeypatch):
    few = sorted(map(repr, manifest.compile_manifest(*_sample(spark), 24.0).collect()))
    monkeypatch.setattr(manifest, "MOST_LISTS", 0)
    assert sorted(map(repr, manifest.compile_manifest(*_sample(spark), 24.0).collect())) == few
    assert len(few) == 72 and sum("new:unknown_concept" in x for x in few) > 0


def test_scenes_alike_and_scenes_without_project_keep_their_tasks(spark):
    shots = [("s1", 2.0, ["c"], [("wide",)]), ("s2", 3.0, [], [("wide",)])]
    rows = [("p", 0, "a", shots), ("p", 0, "a", shots), (None, 0, "a", shots), (None, None, "z", shots)]
    concepts = spark.createDataFrame([("c", "lora", "pending", 0)], "id string, strategy string, status string, media long")
    got = manifest.compile_manifest(spark.createDataFrame(rows, f"project string, ord int, id string, shots array<{SHOT}>"), concepts, 24.0).where("kind = 'assembly'").collect()
    assert sorted(r.start_seconds for r in got if r.project == "p") == [0.0, 2.0, 5.0, 7.0]
    assert sorted((r.scene_id, r.start_seconds) for r in got if r.project is None) == [("a", 5.0), ("a", 7.0), ("z", 0.0), ("z", 2.0)]


def test_sums_before_entries_of_long_scenes(spark):
    values = [None if i % 7 == 0 else i / 8 for i in range(600)]
    ask = lambda xs: spark.createDataFrame([(xs,)], "x array<double>").select(manifest.sums_before(F.col("x")).alias("s")).first().s
    assert ask(values) == [sum(v or 0.0 for v in values[:i]) for i in range(600)]
    assert [ask(values[:n]) for n in (0, 1, 256, 257)] == [ask(values)[:n] for n in (0, 1, 256, 257)]


def test_scenes_of_few_kinds_are_dealt_without_lists(spark, monkeypatch):
    few = manifest.compile_manifest(*_sample(spark), 24.0)
    assert "struct<kind:bigint" in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(manifest, "kind_number", lambda concepts, formations: F.xxhash64(F.size(formations)))  # shared by kinds
    shared = manifest.compile_manifest(*_sample(spark), 24.0)
    assert "struct<kind:bigint" not in shared._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, shared.collect())) == sorted(map(repr, few.collect()))
