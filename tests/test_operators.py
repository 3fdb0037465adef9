import io
import json
import math
import random
import tarfile

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clipsieve.operators import annotation, assemble, dedup, judge, lineage, packing, robust, semantic, split, trajectory
from clipsieve.sources import manifest, registry, schemas, sinks

FULL = {"vmaf": [1, 5], "xhigh": {"vmaf": [2, 3]}}


def clip(spark, rows):
    lines = [(json.dumps(r),) for r in rows]
    return manifest.decode(spark.createDataFrame(lines, "value string"))


def test_judge(spark):
    d = clip(spark, [{"clip_id": "a", "source": "s", "metrics": {"vmaf": 2.5}}, {"clip_id": "b", "source": "s", "metrics": {"vmaf": 4}}, {"clip_id": "c", "source": "s", "metrics": {"vmaf": float("nan")}}, {"clip_id": "d", "source": "s"}])
    got = {r.clip_id: (r.kept_tier, [x.code for x in r.reject_reasons]) for r in judge.judge(d.drop("reject_reasons", "kept_tier"), judge.policy_table(spark, {"s": FULL})).collect()}
    assert got == {"a": ("xhigh", []), "b": ("high", []), "c": (None, ["vmaf"]), "d": (None, ["vmaf"])}
    with pytest.raises(PySparkException, match="no policy"):
        judge.judge(d.drop("reject_reasons", "kept_tier"), judge.policy_table(spark, {"t": FULL})).collect()
    with pytest.raises(ValueError):
        judge.validate_policy({"min_frame": 3})
    with pytest.raises(KeyError):
        semantic.config_reasons(F.col("v"), {"quality": 3})


def test_frame_camera(spark):
    d = spark.sql("""SELECT * FROM VALUES (1, array(named_struct('fx', 1000D, 'fy', 1000D, 'cx', 1D, 'cy', 1D)), array(1D, 1D)), (2, array(named_struct('fx', double('NaN'), 'fy', 1D, 'cx', 1D, 'cy', 1D)), array(1D)), (3, null, array()) AS t(id, intrinsics, scale_factors)""")
    d = d.withColumns({"width": F.lit(1280), "height": F.lit(720)})
    got = {r.id: [x.code for x in r.r] for r in d.select("id", judge.frame_camera_reasons((20.0, 120.0), 0.1, 0.1).alias("r")).collect()}
    assert got == {1: [], 2: ["intrinsics"], 3: ["intrinsics", "scale_cov"]}


def test_split_checks(spark):
    d = spark.createDataFrame([("o", str(i)) for i in range(10)] + [(None, "x")], "owner string, clip_id string")
    train, test = split.train_test(d, 3)
    assert train.count() + test.count() == 11 and test.where("owner = 'o'").count() == 3 and test.where("owner IS NULL").count() == 1
    split.check_split(train, test)
    with pytest.raises(ValueError):
        split.check_split(train, train)
    with pytest.raises(ValueError):
        split.check_owners(d, ["o", "p"])
    with pytest.raises(ValueError):
        split.eligible(d.withColumn("kept_tier", F.lit("high")), ("higher",))


def test_dedup_ties_and_corrections(spark):
    d = spark.createDataFrame([("k", None, 1), ("k", None, 1), ("k", None, 1), ("m", "a", 2), ("m", "a", 1), (None, "a", 1), (None, "a", 1)], "clip_id string, source string, n int")
    kept, lost = dedup.first_wins(d.repartition(3))
    assert kept.count() == 3 and sorted((str(r.clip_id), r.dropped_source) for r in lost.collect()) == [("None", "a"), ("k", None), ("k", None), ("m", "a")]
    m = spark.sql("SELECT named_struct('a', 1.0D, 'b', 2.0D, 'c', 3.0D) AS m, IF(id = 0, named_struct('a', 9.0D, 'b', CAST(NULL AS DOUBLE)), NULL) AS fix FROM range(2)")
    got = [tuple(r[0]) for r in m.select(judge.corrected(F.col("m"), F.col("fix"), ["a", "b"])).collect()]
    assert sorted(got) == [(1.0, 2.0, 3.0), (9.0, 2.0, 3.0)]
    twice = judge.policy_table(spark, {"s": {"min_frames": 1}})
    with pytest.raises(ValueError):
        judge.judge(spark.createDataFrame([("s",)], "source string"), twice.union(twice))


def test_work_items_and_requests_fail_closed(spark):
    from clipsieve.sources import items

    with pytest.raises(NotImplementedError):
        items.work_items(spark, "openvid", spark.createDataFrame([("a.tar",)], "path string"))
    d = spark.createDataFrame([("a", 2), ("b", 1), (None, 0)], "sample_id string, n int")
    assert [r.n for r in items.requested(d, ["b", "a"], "n").collect()] == [1, 2] and items.requested(d, [], "n", limit=1).first().n == 0
    with pytest.raises(ValueError):
        items.requested(d, ["a", "c"], "n")


def test_dedup_order(spark):
    d = spark.createDataFrame([("k", "abot", 1), ("k", "zod", 2), ("k", "dl3dv", 3), ("m", "abot", 4)], "clip_id string, source string, n int")
    kept, lost = dedup.first_wins(d)
    assert {(r.clip_id, r.source) for r in kept.collect()} == {("k", "dl3dv"), ("m", "abot")}
    assert {(r.dropped_source, r.kept_source) for r in lost.collect()} == {("abot", "dl3dv"), ("zod", "dl3dv")}
    with pytest.raises(ValueError):
        dedup.check_injective(spark.createDataFrame([("a", "x"), ("b", "x")], "i string, k string"), "i", "k")


def test_plan_and_tar(spark):
    d = spark.createDataFrame([("p", i, s) for i, s in enumerate([5, 6, 20, 1, 2, 9])], "p string, i int, s int")
    got = [r.shard for r in packing.plan_shards(d, 10, "p", "i", "s").orderBy("i").collect()]
    assert got == [0, 1, 2, 3, 3, 4]
    m = spark.createDataFrame([(1, "k", "video.mp4", b"vv"), (1, "k", "meta.json", b"{}"), (1, "j", "meta.json", b"[]"), (1, "j", "other", b"")], "shard int, key string, name string, content binary")
    r = packing.tar_shards(m).first()
    assert tarfile.open(fileobj=io.BytesIO(bytes(r.tar))).getnames() == ["j.meta.json", "k.meta.json", "k.video.mp4"]
    back = packing.read_tars(spark.createDataFrame([("t", r.tar)], "path string, content binary"))
    assert {(x.key, x.name, bytes(x.content)) for x in back.collect()} == {("j", "meta.json", b"[]"), ("k", "meta.json", b"{}"), ("k", "video.mp4", b"vv")}
    with pytest.raises(PySparkException):
        spark.range(1).select(packing.partition_of(F.lit(None).cast("string"), F.lit(False))).collect()


def test_trajectories_agree(spark):
    rng = np.random.default_rng(1)
    c = rng.normal(size=(6, 3))
    frames = spark.createDataFrame([("a", i, *map(float, p)) for i, p in enumerate(c)] + [("b", 0, 0.0, 0.0, 0.0)], "k string, i int, x double, y double, z double")
    eye = np.eye(4)
    poses = []
    for p in c:
        m = eye.copy()
        m[:3, 3] = p
        poses.append(m.ravel().tolist())
    arr = spark.createDataFrame([("a", poses), ("b", poses[:1]), ("c", None), ("d", [[float("nan")] * 16] * 3)], "clip_id string, poses array<array<double>>")
    f = {r.k: r for r in trajectory.frame_stats(frames, "k", "i").collect()}
    g = {r.clip_id: r for r in trajectory.pose_stats(arr).collect()}
    step = np.linalg.norm(np.diff(c, axis=0), axis=1)
    for name, want in {"path": step.sum(), "disp": np.linalg.norm(c[-1] - c[0]), "vel_med": np.median(step), "vel_p95": np.percentile(step, 95), "diag": np.linalg.norm(np.ptp(c, axis=0))}.items():
        assert f["a"][name] == pytest.approx(want) and g["a"][name] == pytest.approx(want), name
    assert g["a"].rot_deg == pytest.approx(0, abs=1e-5)
    assert not f["b"].ok and f["b"].path is None and [g[k].ok for k in "abcd"] == [True, False, False, False]


def test_robust(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=(40, 3))
    s, r, t = robust.similarity(a, 2.3 * a + 1)
    assert s == pytest.approx(2.3, abs=1e-9)
    with pytest.raises(ValueError):
        robust.robust_scale(a[:2], a[:2])
    d = spark.createDataFrame([("c", v) for v in (6.0, 6.1, float("nan"), 60.0, 5.9)], "clip_id string, ratio double")
    got = robust.mad_scale(d).first()
    assert got.scale == pytest.approx(6.0, abs=0.01) and (got.valid, got.inliers) == (4, 3)
    few = spark.createDataFrame([("c", 1.0), ("c", None)], "clip_id string, ratio double")
    assert robust.mad_scale(few).first().scale is None
    g = spark.createDataFrame([("c", i, v) for i, v in enumerate([10.0, -1.0, 20.0, 900.0])] + [("e", 0, -1.0)], "k string, i int, v double")
    assert [x.v for x in robust.fill_gaps(g, "k", "i", "v", F.lit(7.0)).orderBy("k", "i").collect()] == [10.0, 15.0, 20.0, 20.0, 7.0]


def good(**more):
    words = " ".join(["stone"] * 88)
    return {"vlm_entity_density": 3, "vlm_quality": 4.0, "reject_flags": [], "scene_type": "real_world", "scene_transition": {"label": "none", "count": 0, "timestamps_sec": [], "evidence": ""}, "dense_caption": words} | more


def test_annotation(spark):
    tr = lambda **m: {"label": "possible", "count": 2, "timestamps_sec": [1, 2.5], "evidence": "cut"} | m
    cases = {
        "ok": (good(), []), "flag_twice": (good(reject_flags=["blurry", "blurry"]), ["flags"]), "density_bool": (good(vlm_entity_density=True), ["density"]), "quality_text": (good(vlm_quality="4"), ["quality"]),
        "short": (good(dense_caption="a b"), ["caption_words"]), "wording": (good(dense_caption=" ".join(["stone"] * 70) + " camera"), ["caption_wording"]), "extra": (good(x=1), ["keys"]), "tr_ok": (good(scene_transition=tr()), []),
        "tr_sort": (good(scene_transition=tr(timestamps_sec=[2, 1])), ["transition_order"]), "tr_count": (good(scene_transition=tr(count=1)), ["transition_mismatch"]), "tr_none": (good(scene_transition=tr(label="none")), ["transition_none"]),
        "words60": (good(dense_caption=" ".join(["stone"] * 60)), []), "words151": (good(dense_caption=" ".join(["stone"] * 151)), ["caption_words"]),
    }
    rows = [(k, json.dumps(v)) for k, (v, _) in cases.items()] + [("list", "[1]"), ("junk", "{"), ("fenced", "```json\n" + json.dumps(good()) + "\n```")]
    d = spark.createDataFrame(rows, "k string, raw string").select("k", annotation.response_errors(F.col("raw"), F.lit(10.0)).alias("e"))
    got = {r.k: r.e for r in d.collect()}
    assert {k: got[k] for k in cases} == {k: e for k, (_, e) in cases.items()}
    assert got["list"] == got["junk"] == ["not_object"] and got["fenced"] == []


def test_manifest(spark, tmp_path):
    f = tmp_path / "o.jsonl"
    f.write_text('{"clip_id": "a", "kept_tier": null, "metrics": {"vmaf": NaN, "new": 1}, "mine": 5}\n\n{"clip_id": "b"}\n')
    r = {x.clip_id: x for x in manifest.read_manifest(spark, str(f)).collect()}
    assert math.isnan(r["a"].metrics.vmaf) and "mine" in r["a"].extra and r["a"].judged and not r["b"].judged and r["b"].mode == "default" and r["b"].scale_factors == []
    f.write_text('{"clip_id": "a"}\nnot json\n')
    with pytest.raises(PySparkException, match="malformed"):
        manifest.read_manifest(spark, str(f)).collect()
    assert [x.owner for x in manifest.read_owners(spark, str(f)).collect()] == ["o"]
    (tmp_path / "k.txt").write_text('x\n{"clip_id": "y", "kept_tier": null}\n{"clip_id": "z"}\n')
    assert {x.clip_id for x in manifest.kept_ids(spark, str(tmp_path / "k.txt")).collect()} == {"x", "z"}
    with pytest.raises(ValueError):
        manifest.numbered(spark, str(f))


def test_sources_and_sinks(spark, tmp_path):
    for n in ("video.mp4", "poses.npy"):
        (tmp_path / "c1").mkdir(exist_ok=True)
        (tmp_path / "c1" / n).write_bytes(b"1")
    got = manifest.clip_directories(spark, str(tmp_path), "s").first()
    assert got.clip_id == "c1" and got.video_path.endswith("video.mp4") and got.intrinsics_path is None
    with pytest.raises(PySparkException, match="unknown source"):
        registry.with_mode(spark.createDataFrame([("nope",)], "source string")).collect()
    d = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    out = str(tmp_path / "t")
    assert sinks.write_missing(d, out, "k") is d and sinks.write_missing(d, out, "k").count() == 0 and spark.read.parquet(out).count() == 2
    sinks.write_overlay(d, str(tmp_path / "ov"))
    with pytest.raises(PySparkException):
        sinks.write_overlay(d, str(tmp_path / "ov"))
    assert set(schemas.CLIP_FIELDS) >= {"clip_id", "metrics"}


def test_assemble(spark):
    rows = [{"clip_id": c, "source": s, "num_frames": n, "metrics": {"vmaf": 2.0}} for c, s, n in (("a", "zod", 81), ("a", "dl3dv", 81), ("b", "zod", 80), ("c", "zod", 160))]
    d = clip(spark, rows).drop("reject_reasons", "kept_tier").withColumn("vlm", F.lit(None).cast("struct<vlm_quality:double,reject_flags:array<string>,scene_transition:struct<count:int>,dense_caption:string>"))
    files = spark.createDataFrame([(s, c, n) for c, s in (("a", "zod"), ("a", "dl3dv"), ("b", "zod")) for n in assemble.REQUIRED] + [("zod", "c", "video.mp4")], "source string, clip_id string, name string")
    judged, kept, lost = assemble.assemble(d, files, judge.policy_table(spark, {"zod": FULL, "dl3dv": FULL}))
    assert judged.count() == 3 and [(r.source, r.clip_id) for r in kept.collect()] == [("dl3dv", "a")] and lost.count() == 1
    rep = {r.source: r for r in assemble.report(judged, kept, lost).collect()}
    assert rep["zod"].reject_histogram == {"offspec_length": 1} and rep["zod"].collisions == 1


def test_lineage(spark):
    d = spark.createDataFrame([("a", 16.0, 1280, 720, 200, 200, 200), ("b", 30.0, 1280, 720, 200, 200, 199), ("z", 16.0, 1280, 720, 200, 200, 200)], "clip_id string, fps double, width int, height int, num_frames int, pose_frames int, intr_frames int")
    tasks, rejected = lineage.plan_tasks(d, spark.createDataFrame([("a",), ("b",)], "clip_id string"))
    assert [(r.clip_id, r.target_frames) for r in tasks.collect()] == [("a", 160)]
    assert {r.clip_id: r.reason for r in rejected.collect()} == {"b": "fps", "z": "not_kept"}


def test_stream(spark, tmp_path):
    from clipsieve.streaming import ingest

    src = tmp_path / "in"
    src.mkdir()
    (src / "1.jsonl").write_text('{"clip_id": "a"}\nbad\n{"clip_id": "a"}\n')
    (src / "2.jsonl").write_text('{"clip_id": "b"}\n{"clip_id": "a"}\n')
    q = ingest.run_once(ingest.unseen(ingest.clip_stream(spark, str(src), 1).select("clip_id"), "clip_id"), ingest.batch_folder(str(tmp_path / "out")), str(tmp_path / "ck"))
    q.awaitTermination()
    assert sorted(r.clip_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_validate(spark):
    from clipsieve.operators import validate

    eye = np.eye(4).ravel().tolist()
    bent = (np.eye(4) * [2, 1, 1, 1]).ravel().tolist()
    flip = (np.eye(4) * [-1, 1, 1, 1]).ravel().tolist()
    low = [*eye[:12], 1.0, 0.0, 0.0, 1.0]
    d = spark.createDataFrame([("a", [eye]), ("b", [bent]), ("c", [flip]), ("d", [low]), ("e", []), ("f", [[float("nan")] * 16]), ("g", None)], "k string, poses array<array<double>>")
    got = {r.k: r.p for r in d.select("k", validate.pose_defects(F.col("poses")).alias("p")).collect()}
    assert got == {"a": [], "b": ["orthonormal", "handed"], "c": ["handed"], "d": ["bottom_row"], "e": ["shape"], "f": ["finite"], "g": ["shape"]}
    c = spark.createDataFrame([("a", 24.2, 121, [eye] * 121, [(1.0, 1.0)] * 121), ("b", 30.0, 5, [eye], [(0.0, 1.0)])], "k string, fps double, num_frames int, poses array<array<double>>, intrinsics array<struct<fx:double,fy:double>>")
    assert {r.k: r.d for r in c.select("k", validate.clip_defects(24.0).alias("d")).collect()} == {"a": [], "b": ["pose_count", "intrinsics_count", "length", "fps", "focal"]}
    t = spark.createDataFrame([("x", 81), ("y", 81), ("z", 160)], "output_clip_id string, n int")
    g = spark.createDataFrame([("x", 81), ("y", 80), ("w", 1)], "output_clip_id string, n int")
    assert {r[0]: r[1] for r in validate.delivery_defects(t, g, equal=("n",)).collect()} == {"x": [], "y": ["n"], "z": ["missing"], "w": ["stray"]}
    w = spark.createDataFrame([("k", s, e) for s, e in ((3.0, 0.1), (3.1, 0.1), (2.9, 0.1), (9.0, 0.1), (3.0, 0.9))], "k string, scale double, nrmse double")
    r = validate.window_consensus(w, "k").first()
    assert r.scale == pytest.approx(3.0) and (r.windows, r.inliers) == (5, 3)


def test_plan_shards_runs_on_over_lanes(spark):
    rng = random.Random(3)
    rows = [(p, i, rng.choice([0, 1, 3, 4, 9, 25])) for p, n in (("a", 90), ("b", 7), (None, 31)) for i in range(n)]
    want, state = {}, {}
    for p, i, s in rows:  # the registered SQL's one greedy plan a partition
        used, shard = state.get(p, (None, -1))
        used, shard = (s, shard + 1) if used is None or used + s > 20 else (used + s, shard)
        state[p] = used, shard
        want[p, i] = shard
    d = spark.createDataFrame(rows, "p string, i int, s int")
    for lane_rows in (1, 4, 100):
        got = packing.plan_shards(d, 20, "p", "i", "s", lane_rows=lane_rows).collect()
        assert len(got) == len(rows) and {(r.p, r.i): r.shard for r in got} == want, lane_rows


def test_jobs(spark):
    from clipsieve.plans import jobs

    d = spark.createDataFrame([("o", f"c{i}", "high" if i % 2 else None, 100 + i, True, 10, "c") for i in range(20)], "owner string, clip_id string, kept_tier string, num_frames int, judged boolean, bytes long, source string")
    train, test, rep = jobs.build_recipe(d, per_owner=3, repeats={"o": 2})
    assert (train.count(), test.count(), rep.first().virtual) == (7, 3, 14)
    with pytest.raises(ValueError):
        jobs.build_recipe(d, repeats={"nobody": 2})
    a, b = jobs.build_window_view(d, 50, per_owner=3)
    assert a.count() + b.count() == 20 and not {r.clip_id for r in a.collect()} & {r.clip_id for r in b.collect()}
    p = jobs.pack(d, 25)
    assert p.where("wds_partition = 'rejected'").select("wds_shard").distinct().count() == 5
    with pytest.raises(PySparkException):
        jobs.pack(d.withColumn("judged", F.lit(False))).collect()


def test_facts(spark):
    base = {"perspective_type": "uncertain", "visual_style": "two-dimensional animation", "scene_description": "A stone path by a wall.", "scene_dynamics": ""}
    cases = {
        "ok": (base, []), "extra": (base | {"x": 1}, ["keys"]), "enum": (base | {"visual_style": "oil"}, ["visual_style"]), "camera": (base | {"scene_dynamics": "The camera moves on."}, ["scene_dynamics:camera_motion"]),
        "space": (base | {"scene_description": " A wall"}, ["scene_description:space"]), "static": (base | {"scene_dynamics": "Static"}, ["scene_dynamics:empty_word"]), "number": (base | {"scene_description": 5}, ["scene_description:type"]), "long": (base | {"scene_dynamics": "ab " * 700 + "c"}, ["scene_dynamics:length"]),
    }
    d = spark.createDataFrame([(k, json.dumps(v)) for k, (v, _) in cases.items()] + [("no", "[]")], "k string, raw string")
    got = {r.k: r.e for r in d.select("k", annotation.fact_errors(F.col("raw")).alias("e")).collect()}
    assert {k: got[k] for k in cases} == {k: e for k, (_, e) in cases.items()} and got["no"] == ["not_object"]
    own = {r.k: r.e for r in d.select("k", annotation.fact_errors(F.col("raw"), {"walls": r"\bwall\b"}).alias("e")).collect()}
    assert own["ok"] == ["scene_description:walls"]
    r = spark.range(1).select(annotation.acceptable_envelope(F.lit("stop"), F.lit(2000), F.lit(8)).alias("a"), annotation.acceptable_envelope(F.lit("length"), F.lit(9000), F.lit(8)).alias("b"), annotation.serialise_facts(F.lit("Style"), F.lit("A wall."), F.lit("")).alias("c")).first()
    assert tuple(r) == (True, False, "Style. A wall.")


def test_sentence_policies(spark):
    from clipsieve.operators.sentences import STATIC_RULES, Rule, sentence_errors

    rules = [*STATIC_RULES, Rule("walks", "scene_description", r"\bwalks\b", unless_before=r"\banother\b", unless_next=r"\s+of\b", perspective="third_person", opening=r"A\s+man\b", first_sentence=True)]
    rows = {
        "still": {"scene_dynamics": "Leaves fall. The boats are motionless."}, "walk": {"perspective_type": "third_person", "scene_description": "A man walks on."}, "other": {"perspective_type": "third_person", "scene_description": "A man and another walks on."},
        "walks_of": {"perspective_type": "third_person", "scene_description": "A man by walks of stone."}, "first": {"perspective_type": "first_person", "scene_description": "A man walks."}, "later": {"perspective_type": "third_person", "scene_description": "A wall. A man walks."}, "none": {},
    }
    d = spark.createDataFrame([(k, json.dumps(v)) for k, v in rows.items()] + [("null", None), ("junk", "{")], "k string, raw string")
    got = {r.k: r.e for r in d.select("k", sentence_errors(F.col("raw"), rules).alias("e")).collect()}
    assert got == {"still": ["static_absence"], "walk": ["walks"], "other": [], "walks_of": [], "first": [], "later": [], "none": [], "null": [], "junk": []}
