"""Further queries: whole jobs, contracts, lineage, geometry, text, and readers and writers by round trips over the shared folder.

``registry.queries`` loads this module, which adds to the registry's tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, geometry, hashing, specs, text
from ..functions.predicates import codes
from ..operators import annotation, assemble, calibrate, dedup, judge, lineage, packing, robust, select, sentences, split, validate
from ..sources import items, manifest, sinks
from ..sources import registry as known
from . import jobs
from .registry import _PRIO, _judged, query
from .views import CLIPS_SQL, JUDGED_SQL, ORDER, POLICIES, clips, scratch, table


def _lines(spark: SparkSession, rows: DataFrame, name: str) -> str:
    """Writes one string column as text lines below the shared folder; gives the folder."""
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    rows.write.text(path)
    return path


# ---- whole jobs

_LENGTHS = "[121, 1437, 81, 160, 960, 500]"
_JOB = JUDGED_SQL.replace("CAST(n_chars AS INT) AS num_frames", f"({_LENGTHS})[d.doc_id % 6 + 1] AS num_frames") + """, a AS (
SELECT source, md5(caption) AS clip_id, doc_id, CASE WHEN num_frames <> 500 THEN kept_tier END AS kept_tier, k FROM j
WHERE caption IS NOT NULL AND source IS NOT NULL),
b AS (SELECT * FROM a WHERE (source, clip_id) IN (SELECT (source, clip_id) FROM a WHERE doc_id % 17 <> 0) AND (source, clip_id) NOT IN (SELECT (source, clip_id) FROM a WHERE doc_id % 23 = 0))"""


def _assembled(spark, sf):
    d = clips(spark, sf).withColumns({"num_frames": F.get(F.array(*[F.lit(int(x)) for x in _LENGTHS.strip("[]").split(",")]), (F.col("doc_id") % 6).cast("int")), "clip_id": F.md5("caption")})
    names = F.filter(F.array(F.when(F.col("doc_id") % 17 != 0, F.lit("poses.npy")), *map(F.lit, ("video.mp4", "intrinsics.npy", "meta.json"))), lambda x: x.isNotNull())
    files = d.select("source", "clip_id", F.explode(names).alias("name"))
    out = d.where("doc_id % 23 = 0").select("source", "clip_id")
    return assemble.assemble(d, files, judge.policy_table(spark, POLICIES), exclusions=out, order=ORDER)


@query(_JOB + f"SELECT clip_id, source FROM (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY {_PRIO}, source) AS rn FROM b WHERE kept_tier IS NOT NULL) WHERE rn = 1")
def assemble_train(spark, sf):
    return _assembled(spark, sf)[1].select("clip_id", "source")


@query(_JOB + f", t AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY {_PRIO}, source) AS rn FROM b WHERE kept_tier IS NOT NULL) SELECT s.source, clips_seen, technically_kept, coalesce(kept, 0) AS kept, coalesce(collisions, 0) AS collisions FROM (SELECT source, count(*) AS clips_seen, count(kept_tier) AS technically_kept FROM b GROUP BY 1) s LEFT JOIN (SELECT source, count(*) FILTER (rn = 1) AS kept, count(*) FILTER (rn > 1) AS collisions FROM t GROUP BY 1) u ON s.source = u.source")
def assemble_report(spark, sf):
    return assemble.report(*_assembled(spark, sf)).select("source", "clips_seen", "technically_kept", "kept", "collisions")


_TIERED = JUDGED_SQL + ", e AS (SELECT source AS owner, doc_id, clip_id, num_frames, kept_tier, row_number() OVER (PARTITION BY source ORDER BY substr(sha256(clip_id), 1, 16), clip_id) AS rn FROM j WHERE kept_tier IS NOT NULL{more}) "


def _owned(spark, sf):
    return _judged(spark, sf).select(F.col("source").alias("owner"), "clip_id", "num_frames", "kept_tier")


@query(_TIERED.replace("{more}", "") + "SELECT owner, clip_id, kept_tier, CASE WHEN rn <= 2 THEN 'test' ELSE 'train' END AS side, CASE WHEN rn > 2 THEN CASE owner WHEN 'src1' THEN 3 ELSE 1 END END AS repeat FROM e")
def recipe_job(spark, sf):
    d = _owned(spark, sf)
    train, test, _ = jobs.build_recipe(d, per_owner=2, repeats=None)
    train = split.with_repeat(train.drop("repeat"), {"src1": 3})
    return train.select("owner", "clip_id", "kept_tier", F.lit("train").alias("side"), "repeat").unionByName(test.select("owner", "clip_id", "kept_tier", F.lit("test").alias("side"), F.lit(None).cast("int").alias("repeat")))


@query(_TIERED.replace("{more}", " AND num_frames >= 300 AND num_frames <= 9000") + "SELECT owner, clip_id, kept_tier, CASE WHEN rn <= 2 THEN 'test' ELSE 'train' END AS side, CAST(k * 153 AS INTEGER) AS start_frame, 153 AS num_frames FROM (SELECT *, unnest(range(0, num_frames // 153)) AS k FROM e)")
def window_view_job(spark, sf):
    train, test = jobs.build_window_view(_owned(spark, sf), 153, per_owner=2, min_frames=300, max_frames=9000)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query(CLIPS_SQL + """, f AS (SELECT source, unimatch AS v, row_number() OVER (PARTITION BY source ORDER BY unimatch) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM c WHERE unimatch IS NOT NULL)
SELECT source, min(v) FILTER (i = least(n - 1, n * 2 // 100)) AS flow_p2, min(v) FILTER (i = least(n - 1, n * 5 // 100)) AS flow_p5, min(v) FILTER (i = least(n - 1, n * 75 // 100)) AS flow_p75, min(v) FILTER (i = least(n - 1, n * 90 // 100)) AS flow_p90 FROM f GROUP BY 1""")
def calibration_job(spark, sf):
    return jobs.calibrated(clips(spark, sf))[0].select("source", "flow_p2", "flow_p5", "flow_p75", "flow_p90")


@query(r"""WITH t AS (SELECT source, CAST(doc_id AS VARCHAR) AS clip_id, doc_id, lower(coalesce(text, '')) AS c, CAST(doc_id % 40 AS DOUBLE) / 10 AS path, CAST(doc_id % 5 AS DOUBLE) AS q, doc_id % 3 AS cuts, doc_id % 2 AS nf FROM documents)
SELECT source, clip_id FROM t WHERE doc_id % 4 <> 0 AND path >= 1 AND doc_id % 7 <> 0""")
def outdoor_job(spark, sf):
    """Captions that name two outdoor terms, for all but every seventh clip, whose caption names a roof."""
    d, i = table(spark, sf, "documents"), F.col("doc_id")
    keys = [F.col("source"), i.cast("string").alias("clip_id")]
    caption = F.when(i % 7 == 0, "A street under the sky beside an escalator.").otherwise("A street under the sky.")
    notes = d.select(*keys, F.when(i % 4 == 0, "game").otherwise("real_world").alias("vlm_scene_type"), caption.alias("dense_caption"), F.when(i % 2 == 1, F.array(F.lit("blurry"))).otherwise(F.array().cast("array<string>")).alias("reject_flags"), (i % 5).cast("double").alias("vlm_quality"), (i % 3).cast("int").alias("transition_count"))
    tracks = d.select(*keys, ((i % 40).cast("double") / 10).alias("path"), F.lit(1.0).alias("disp"))
    return jobs.select_outdoor(d.select(*keys), notes, tracks).select("source", "clip_id")


@query(JUDGED_SQL.replace("WITH c AS", "WITH RECURSIVE c AS", 1) + """, o AS (SELECT CASE WHEN kept_tier IS NULL THEN 'rejected' ELSE 'kept-' || kept_tier END AS p, clip_id, num_frames AS s FROM j),
n AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY clip_id, s) AS r FROM o),
g AS (SELECT p, clip_id, s, r, s AS used, 0 AS shard FROM n WHERE r = 1 UNION ALL SELECT n.p, n.clip_id, n.s, n.r, CASE WHEN g.used + n.s > 90000 THEN n.s ELSE g.used + n.s END, CASE WHEN g.used + n.s > 90000 THEN g.shard + 1 ELSE g.shard END FROM g JOIN n ON n.p = g.p AND n.r = g.r + 1)
SELECT clip_id, p || '/' || lpad(CAST(shard AS VARCHAR), 5, '0') || '.tar' AS wds_shard FROM g""")
def pack_job(spark, sf):
    d = _judged(spark, sf).select("clip_id", "kept_tier", F.lit(True).alias("judged"), F.col("num_frames").cast("long").alias("bytes"))
    return jobs.pack(d, 90_000).select("clip_id", "wds_shard")


@query(CLIPS_SQL + "SELECT source, clip_id, round(path, 4) AS path_length, round(path / 7, 3) AS jump_ratio, dover_tech, scene_cuts, fx AS fov_x FROM (SELECT *, CAST(doc_id % 977 AS DOUBLE) / 7 AS path FROM c) WHERE doc_id % 3 <> 0")
def metric_scan(spark, sf):
    d = clips(spark, sf).withColumn("pose_mode", F.lit("default"))
    path = (F.col("doc_id") % 977).cast("double") / 7
    tracks = d.where("doc_id % 3 <> 0").select("source", "clip_id", F.lit(4).alias("n_frames"), path.alias("path_length"), (path / 7).alias("jump_ratio"))
    return jobs.metric_scan(d, tracks).select("source", "clip_id", "path_length", "jump_ratio", "dover_tech", "scene_cuts", "fov_x")


@query(CLIPS_SQL + "SELECT clip_id, coalesce(vmaf, CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS DOUBLE) END) AS vmaf FROM c")
def metric_backfill(spark, sf):
    d = clips(spark, sf)
    measured = d.where("doc_id % 2 = 0").select("source", "clip_id", F.explode(F.array(F.col("doc_id").cast("double"), F.col("doc_id") + 1.0)).alias("value"))
    return jobs.backfill(d, measured, "vmaf").select("clip_id", "metrics.vmaf")


@query(CLIPS_SQL + "SELECT clip_id, CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id AS DOUBLE) ELSE vmaf END AS vmaf, saturation, CASE WHEN doc_id % 15 = 0 THEN 1.0 ELSE unimatch END AS unimatch FROM c")
def corrected_metrics(spark, sf):
    i = F.col("doc_id")
    fix = F.when(i % 3 == 0, F.struct(i.cast("double").alias("vmaf"), F.when(i % 15 == 0, F.lit(1.0)).alias("unimatch"), F.lit(None).cast("double").alias("saturation")))
    d = clips(spark, sf).withColumn("fix", fix)
    m = judge.corrected(F.col("metrics"), F.col("fix"), ["vmaf", "unimatch", "saturation"])
    return d.select("clip_id", m["vmaf"].alias("vmaf"), m["saturation"].alias("saturation"), m["unimatch"].alias("unimatch"))


@query("WITH d AS (SELECT c_mktsegment AS clip_id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'src' || CAST(c_nationkey % 4 AS VARCHAR) END AS source FROM customer), r AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY CASE source WHEN 'src3' THEN 0 WHEN 'src1' THEN 1 WHEN 'src2' THEN 2 WHEN 'src0' THEN 3 ELSE 99 END, source NULLS FIRST) AS rn FROM d) SELECT clip_id, source AS dropped_source, count(*) AS n FROM r WHERE rn > 1 GROUP BY 1, 2")
def dedup_ties(spark, sf):
    """Very many equal rows of few keys, with null sources: all but one of a key are collisions."""
    d = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("clip_id"), F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("src"), (F.col("c_nationkey") % 4).cast("string"))).alias("source"))
    return dedup.first_wins(d, order=ORDER)[1].groupBy("clip_id", "dropped_source").agg(F.count("*").alias("n"))


# ---- contracts of annotation

_CAPTION = "The street shows low brick houses beside a paved road under grey clouds with tall trees along both sides and a stone wall in front of a small garden "
_GOOD = '{"vlm_entity_density":2,"vlm_quality":4,"reject_flags":[],"scene_type":"real_world","scene_transition":{"label":"none","count":0,"timestamps_sec":[],"evidence":""},"dense_caption":"%s"}' % (_CAPTION * 3).strip()
#: Answers that break the contract in one way, and the codes they must get.
_ANSWERS = [
    (_GOOD, ""),
    ("```json\n" + _GOOD + "\n```", ""),
    ("no json", "not_object"),
    (_GOOD.replace('"vlm_quality":4', '"vlm_quality":9'), "quality"),
    (_GOOD.replace('"vlm_entity_density":2', '"vlm_entity_density":"2"'), "density"),
    (_GOOD.replace("real_world", "painting"), "scene_type"),
    (_GOOD.replace('"reject_flags":[]', '"reject_flags":["blurry","blurry"]'), "flags"),
    (_GOOD.replace(',"vlm_quality":4', ""), "keys|quality"),
    (_GOOD.replace('"count":0', '"count":1'), "transition_mismatch|transition_none"),
    (_GOOD.replace('"label":"none","count":0,"timestamps_sec":[]', '"label":"definite","count":2,"timestamps_sec":[3.5,1.0]'), "transition_order|transition_claim"),
    (_GOOD.replace(_CAPTION, ""), "caption_words"),
    (_GOOD.replace("grey clouds", "a camera"), "caption_wording"),
]


def _cases(found: list[str]) -> str:
    return "CASE doc_id % " + str(len(found)) + "".join(f" WHEN {i} THEN '{x}'" for i, x in enumerate(found)) + " END"


@query(f"SELECT doc_id, {_cases([x for _, x in _ANSWERS])} AS errors FROM documents")
def annotation_contract(spark, sf):
    raw = F.get(F.array(*[F.lit(a) for a, _ in _ANSWERS]), (F.col("doc_id") % len(_ANSWERS)).cast("int"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(annotation.response_errors(raw, F.lit(10.0)), "|").alias("errors"))


@query(f"SELECT doc_id, nullif({_cases([x.split('|')[0] for _, x in _ANSWERS])}, '') AS error FROM documents")
def annotation_first_error(spark, sf):
    raw = F.get(F.array(*[F.lit(a) for a, _ in _ANSWERS]), (F.col("doc_id") % len(_ANSWERS)).cast("int"))
    return table(spark, sf, "documents").select("doc_id", annotation.first_violation(raw, F.lit(10.0)).alias("error"))


_FACTS = '{"perspective_type":"first_person","visual_style":"photographic live action","scene_description":"A brick house.","scene_dynamics":"Leaves fall."}'
_FACT_CASES = [
    (_FACTS, ""),
    ("[1]", "not_object"),
    (_FACTS.replace("first_person", "second_person"), "perspective_type"),
    (_FACTS.replace("photographic live action", "oil on canvas"), "visual_style"),
    (_FACTS.replace('"A brick house."', "5"), "scene_description:type"),
    (_FACTS.replace("A brick house.", " A brick house."), "scene_description:space"),
    (_FACTS.replace("A brick house.", "..."), "scene_description:letters"),
    (_FACTS.replace("Leaves fall.", "None"), "scene_dynamics:empty_word"),
    (_FACTS.replace("Leaves fall.", "The camera pans left."), "scene_dynamics:camera_motion"),
    (_FACTS.replace('"scene_dynamics"', '"dynamics"'), "keys|scene_dynamics:type"),
]


@query(f"SELECT doc_id, {_cases([x for _, x in _FACT_CASES])} AS errors FROM documents")
def fact_contract(spark, sf):
    raw = F.get(F.array(*[F.lit(a) for a, _ in _FACT_CASES]), (F.col("doc_id") % len(_FACT_CASES)).cast("int"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(annotation.fact_errors(raw), "|").alias("errors"))


def _told(perspective: str = "first_person", description: str = "A brick house.", dynamics: str = "Leaves fall.") -> str:
    return f'{{"perspective_type":"{perspective}","visual_style":"photographic live action","scene_description":"{description}","scene_dynamics":"{dynamics}"}}'


#: Facts that break the wording policy in one way, or nearly, and what they must get.
_WORDING_CASES = [
    (_told(), ""),
    (_told(dynamics=""), ""),
    ("[1]", ""),
    (_told(dynamics="The camera moves forward."), "scene_dynamics:camera_control:camera_motion"),
    (_told(description="The camera moves forward."), "scene_description:camera_control:camera_motion"),
    (_told(description="A quiet music shop."), ""),
    (_told(description="A hall with music."), "scene_description:unsupported_output:music_claim"),
    (_told(dynamics="Flags wave. The boats are motionless."), "static_absence"),
    (_told("third_person", "A man walks along the stone path."), "declared_subject_action|setting_followed_by_principal_action|actor_behavior_in_static_field|finite_actor_event_v8"),
    (_told("third_person", "A man by runs of stone."), ""),
    (_told("third_person", "A person beside wooden steps while trees sway."), ""),
    (_told("third_person", "A man stands and another person runs."), "actor_behavior_in_static_field|finite_actor_event_v8"),
    (_told("third_person", "A quiet room. A cyclist pedals."), "setting_followed_by_principal_action"),
    (_told("third_person", "A background cyclist pedals."), "declared_subject_action"),
    (_told("third_person", "A knight in armour.", "He slowly turns."), "declared_principal_pronoun"),
    (_told("third_person", "A brick house.", "He slowly turns."), ""),
    (_told("third_person", "A knight in armour.", "Another knight waits and he turns."), ""),
    (_told(dynamics="A vendor stands beside a cart."), "static_posture"),
    (_told(dynamics="A vendor stands beside a cart and waves."), ""),
    (_told(dynamics="The light stays green."), "static_presence|static_posture_or_signal_v8"),
    (_told(dynamics="The light stays green until it changes."), ""),
    (_told(dynamics="Lamps remain lit; water runs."), "static_state_v7"),
    (_told(dynamics="A person sits."), "static_actor_state"),
    (_told(dynamics="A person stands up."), ""),
    (_told(description="A lit gas fire under a shelf.", dynamics="Leaves fall."), "active_gas_fire"),
    (_told(description="A lit gas fire under a shelf.", dynamics="Flames flicker."), ""),
    (_told(description="A bow rests in the lower foreground."), "controlled_foreground_composition"),
    (_told(description="An archer with a bow in the lower foreground."), ""),
    (_told(description="Cars on a road where people wait."), ""),
    (_told(description="A red car drives by."), "finite_vehicle_behavior_in_static_field"),
    (_told(description="The shadow of a man falls on a wall."), ""),
    (_told(description="A road where water moves near birds."), ""),
    (_told("third_person", "A silver train travels on."), "declared_train_action_v8"),
    (_told("third_person", "A silver train that travels on."), ""),
    (_told(dynamics="A person holds a cup."), "static_actor_relation_v8"),
    (_told(description="Rain streaks on glass."), "asserted_precipitation_v8"),
]


@query(f"SELECT doc_id, {_cases([x for _, x in _WORDING_CASES])} AS errors FROM documents")
def caption_policies(spark, sf):
    raw = F.get(F.array(*[F.lit(a) for a, _ in _WORDING_CASES]), (F.col("doc_id") % len(_WORDING_CASES)).cast("int"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(sentences.wording_errors(raw), "|").alias("errors"))


@query("SELECT conv_id, turn, coalesce(role = 'user' AND 1900 + conv_id % 300 >= greatest(2000, 200 * (turn % 12)), false) AS ok FROM conversations")
def answer_envelope(spark, sf):
    ok = annotation.acceptable_envelope(F.when(F.col("role") == "user", "stop").otherwise("length"), 1900 + F.col("conv_id") % 300, F.col("turn") % 12)
    return table(spark, sf, "conversations").select("conv_id", "turn", ok.alias("ok"))


@query("SELECT p_partkey, p_name || '. ' || p_brand || CASE WHEN p_partkey % 2 = 0 THEN '! ' ELSE '. ' END || p_type || '.' AS told FROM (SELECT *, 1 FROM part) WHERE p_partkey % 3 <> 0 UNION ALL SELECT p_partkey, p_name || '. ' || p_brand || CASE WHEN p_partkey % 2 = 0 THEN '!' ELSE '.' END FROM part WHERE p_partkey % 3 = 0")
def facts_as_text(spark, sf):
    told = annotation.serialise_facts(F.concat(F.lit("  "), "p_name"), F.concat(F.col("p_brand"), F.when(F.col("p_partkey") % 2 == 0, "!").otherwise("")), F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).otherwise(" "))
    return table(spark, sf, "part").select("p_partkey", told.alias("told"))


@query(CLIPS_SQL + "SELECT clip_id, CASE WHEN doc_id % 3 = 0 THEN 5.0 ELSE q END AS quality, CASE WHEN doc_id % 3 = 0 THEN 'new ' || clip_id ELSE caption END AS caption, CASE WHEN doc_id % 3 = 0 THEN caption END AS archived, sha256(CASE WHEN doc_id % 3 = 0 THEN 'new ' || clip_id ELSE caption END) AS caption_sha256 FROM c")
def annotation_overlay(spark, sf):
    d = clips(spark, sf)
    answers = d.where("doc_id % 3 = 0").select("clip_id", F.concat(F.lit("new "), "clip_id").alias("caption"), F.lit(1).alias("vlm_entity_density"), F.lit(5.0).alias("vlm_quality"), F.array(F.lit("blurry")).alias("vlm_reject_flags"), F.lit("game").alias("vlm_scene_type"), F.struct(F.lit("none").alias("label"), F.lit(0).alias("count")).alias("vlm_scene_transition"))
    d = d.withColumn("metrics", F.col("metrics").withField("vlm_scene_type", F.lit(None).cast("string")))
    return annotation.overlay(d, answers).select("clip_id", F.col("metrics.vlm_quality").alias("quality"), "caption", F.col("static_scene_description").alias("archived"), "caption_sha256")


# ---- lineage, structure and delivery

_HEADERS = "SELECT doc_id, CAST(doc_id AS VARCHAR) AS clip_id, CAST(15 + doc_id % 3 AS DOUBLE) AS f, 1280 - 80 * (doc_id % 5 // 4) AS w, n_chars AS n, CASE WHEN doc_id % 11 = 0 THEN n_chars - 1 ELSE n_chars END AS p FROM documents"


def _headers(spark, sf):
    i, n = F.col("doc_id"), F.col("n_chars")
    return table(spark, sf, "documents").select("doc_id", i.cast("string").alias("clip_id"), (15 + i % 3).cast("double").alias("fps"), (1280 - 80 * F.floor(i % 5 / 4)).cast("int").alias("width"), F.lit(720).alias("height"), n.cast("int").alias("num_frames"), F.when(i % 11 == 0, n - 1).otherwise(n).cast("int").alias("pose_frames"), n.cast("int").alias("intr_frames"))


@query(f"SELECT clip_id, CASE WHEN doc_id % 2 = 1 THEN 'not_kept' WHEN abs(f - 16) > 0.01 THEN 'fps' WHEN w < 1280 THEN 'too_small' WHEN n < 81 THEN 'too_short' WHEN p <> n THEN 'poses' END AS reason, CASE WHEN doc_id % 2 = 0 AND f = 16 AND w = 1280 AND n >= 81 AND p = n THEN CASE WHEN n >= 160 THEN 0 ELSE (n - 81) // 2 END END AS start FROM ({_HEADERS})")
def clean_plate_tasks(spark, sf):
    d = _headers(spark, sf)
    tasks, rejected = lineage.plan_tasks(d, d.where("doc_id % 2 = 0").select("clip_id"))
    return tasks.select("clip_id", F.lit(None).cast("string").alias("reason"), F.col("source_start_frame").alias("start")).unionByName(rejected.select("clip_id", "reason", F.lit(None).cast("int").alias("start")))


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN doc_id % 13 = 0 THEN 'no_interval' END, CASE WHEN s < 0 OR s + l > n THEN 'outside_source' END, CASE WHEN n >= 81 AND (s <> CASE WHEN n >= 160 THEN 0 ELSE (n - 81) // 2 END OR l <> CASE WHEN n >= 160 THEN 160 ELSE 81 END) THEN 'not_planned' END, CASE WHEN doc_id % 5 = 0 THEN 'fps' END, CASE WHEN doc_id % 7 = 0 THEN 'size' END], lambda x: x IS NOT NULL), '|') AS reasons FROM (SELECT doc_id, n_chars AS n, CASE WHEN doc_id % 13 <> 0 THEN doc_id % 3 END AS s, 160 AS l FROM documents)")
def interval_lineage(spark, sf):
    i = F.col("doc_id")
    r = lineage.interval_reasons(F.col("n_chars"), F.when(i % 13 != 0, i % 3), F.lit(160), F.when(i % 5 == 0, 24).otherwise(16), F.lit(1280), F.when(i % 7 == 0, 700).otherwise(720))
    return table(spark, sf, "documents").select("doc_id", F.array_join(codes(r), "|").alias("reasons"))


_POSE = "cos(a), -sin(a), 0.0, x, sin(a), cos(a), 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0"


def _turned(angle, x, flaw=None):
    """A pose turned about the third axis; ``flaw`` scales its first column."""
    k = F.lit(1.0) if flaw is None else flaw
    z, one = F.lit(0.0), F.lit(1.0)
    return F.array(F.cos(angle) * k, -F.sin(angle), z, x, F.sin(angle) * k, F.cos(angle), z, z, z, z, one, z, z, z, z, one)


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN doc_id % 5 = 0 THEN 'poses_orthonormal' END, CASE WHEN doc_id % 5 = 0 THEN 'poses_handed' END, CASE WHEN doc_id % 6 <> 2 OR doc_id % 4 = 0 THEN 'pose_count' END, CASE WHEN doc_id % 6 <> 2 THEN 'intrinsics_count' END, CASE WHEN doc_id % 6 = 5 THEN 'length' END, CASE WHEN abs(23 + doc_id % 3 - 24) > 0.5 THEN 'fps' END, CASE WHEN doc_id % 7 = 0 THEN 'focal' END], lambda x: x IS NOT NULL), '|') AS defects FROM documents")
def clip_structure(spark, sf):
    i = F.col("doc_id")
    pose = _turned(i.cast("double") / 100, F.lit(1.0), F.when(i % 5 == 0, 1.5).otherwise(1.0))
    k = F.struct(F.when(i % 7 == 0, -1.0).otherwise(900.0).alias("fx"), F.lit(900.0).alias("fy"))
    d = table(spark, sf, "documents").select("doc_id", F.get(F.array(*[F.lit(x) for x in (121, 1437, 81, 160, 960, 500)]), (i % 6).cast("int")).alias("num_frames"), (23 + i % 3).cast("double").alias("fps"), F.array_repeat(pose, F.when(i % 4 == 0, 80).otherwise(81)).alias("poses"), F.array_repeat(k, 81).alias("intrinsics"))
    return d.select("doc_id", F.array_join(validate.clip_defects(24.0), "|").alias("defects"))


@query("WITH t AS (SELECT o_orderkey AS k, o_custkey % 50 AS n FROM orders WHERE o_orderkey % 5 <> 0), d AS (SELECT o_orderkey AS k, o_custkey % 50 + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS n, CASE WHEN o_orderkey % 8 = 1 THEN 2 ELSE 1 END AS many FROM orders WHERE o_orderkey % 7 <> 0) SELECT coalesce(t.k, d.k) AS output_clip_id, array_to_string(list_filter([CASE WHEN d.k IS NULL THEN 'missing' END, CASE WHEN t.k IS NULL THEN 'stray' END, CASE WHEN d.many > 1 THEN 'repeated' END, CASE WHEN t.n <> d.n THEN 'num_frames' END], lambda x: x IS NOT NULL), '|') AS defects FROM t FULL JOIN d ON t.k = d.k")
def delivery_check(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    common = lambda n: [k.alias("output_clip_id"), n.alias("num_frames"), F.lit(1280).alias("width"), F.lit(720).alias("height"), F.lit(0).alias("source_start_frame")]
    tasks = o.where(k % 5 != 0).select(*common(F.col("o_custkey") % 50))
    got = o.where(k % 7 != 0).select(*common(F.col("o_custkey") % 50 + F.when(k % 3 == 0, 1).otherwise(0)), F.explode(F.sequence(F.lit(1), F.when(k % 8 == 1, 2).otherwise(1))).alias("copy")).drop("copy")
    return validate.delivery_defects(tasks, got).select("output_clip_id", F.array_join("defects", "|").alias("defects"))


@query("SELECT p_partkey, array_to_string([CAST(x AS VARCHAR) FOR x IN range(p_size % 9, p_size % 9 + 4)], ',') AS cut FROM part")
def track_slice(spark, sf):
    cut = lineage.slice_track(F.sequence(F.lit(0), F.lit(40)), (F.col("p_size") % 9).cast("int"), F.lit(4))
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.transform(cut, lambda x: x.cast("string")), ",").alias("cut"))


@query("SELECT user_id, count(*) >= 3 AND min(x) < max(x) AS judged FROM (SELECT user_id, value AS x FROM events) GROUP BY 1")
def pose_convention(spark, sf):
    """Tracks against their own turned, scaled and moved copies: every one that can be judged passes."""
    e = table(spark, sf, "events").select("user_id", F.col("value").alias("ax"), (F.col("event_id") % 13 * 10).cast("double").alias("ay"), (F.col("event_id") % 7 * 10).cast("double").alias("az"))
    d = e.select("*", (2 * F.col("ay") + 1).alias("bx"), (-2 * F.col("ax")).alias("by"), (2 * F.col("az")).alias("bz"))
    # a skip is told from a pass only by the spread, which the SQL form does not fit; no verdict may be fail
    v = validate.pose_convention(d, "user_id")
    n = e.groupBy("user_id").agg(((F.count("*") >= 3) & (F.min("ax") < F.max("ax"))).alias("judged"))
    return n.join(v, "user_id").where("verdict <> 'fail'").select("user_id", "judged")


@query("SELECT l_orderkey, coalesce(min(step) > -5, true) AS monotonic, round(100 * avg(abs(o - t) / t), 6) AS mape FROM (SELECT l_orderkey, o, t, o - lag(o) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS step FROM (SELECT l_orderkey, l_linenumber, 50 + l_linenumber * 3 - 2 * l_quantity % 5 AS o, CAST(50 + l_linenumber * 3 AS DOUBLE) AS t FROM (SELECT l_orderkey, l_linenumber, min(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2))) GROUP BY 1")
def focal_ramp(spark, sf):
    d = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("q"))
    d = d.select("l_orderkey", "l_linenumber", (50 + F.col("l_linenumber") * 3 - 2 * F.col("q") % 5).cast("double").alias("o"), (50 + F.col("l_linenumber") * 3).cast("double").alias("t"))
    return validate.ramp_agreement(d, "l_orderkey", "l_linenumber", "o", "t").select("l_orderkey", "monotonic", F.round("mape", 6).alias("mape"))


@query("""WITH d AS (SELECT l_suppkey AS k, CASE WHEN l_discount <= 0.08 THEN ln(l_extendedprice / l_quantity) END AS l FROM lineitem), m AS (SELECT k, median(l) AS mid, count(*) AS n FROM d GROUP BY 1), e AS (SELECT d.k, l, n, abs(l - mid) AS dev FROM d JOIN m ON d.k = m.k), a AS (SELECT k, median(dev) AS mad FROM e GROUP BY 1),
i AS (SELECT e.k, n, l, coalesce(dev <= greatest(ln(1.5), 4 * 1.4826 * mad), false) AS inl FROM e JOIN a ON a.k = e.k) SELECT k AS l_suppkey, round(CASE WHEN count(*) FILTER (inl) >= least(3, max(n)) THEN exp(median(l) FILTER (inl)) END, 6) AS scale, count(*) FILTER (inl) AS inliers FROM i GROUP BY 1""")
def local_consensus(spark, sf):
    d = table(spark, sf, "lineitem").select("l_suppkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("scale"), F.when(F.col("l_discount") <= 0.08, 0.1).otherwise(0.9).alias("nrmse"))
    return validate.window_consensus(d, "l_suppkey").select("l_suppkey", F.round("scale", 6).alias("scale"), "inliers")


@query("""WITH d AS (SELECT l_suppkey AS k, l_orderkey * 10 + l_linenumber AS o, CAST(CASE WHEN l_linenumber = 2 THEN -1 ELSE 100 + l_quantity END AS DOUBLE) AS v FROM (SELECT l_suppkey, l_orderkey, l_linenumber, min(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2, 3)),
g AS (SELECT k, o, CASE WHEN v > 0 THEN v END AS v FROM d), f AS (SELECT k, o, v, last_value(CASE WHEN v IS NOT NULL THEN o END IGNORE NULLS) OVER p AS ao, last_value(v IGNORE NULLS) OVER p AS av, first_value(CASE WHEN v IS NOT NULL THEN o END IGNORE NULLS) OVER q AS bo, first_value(v IGNORE NULLS) OVER q AS bv FROM g WINDOW p AS (PARTITION BY k ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), q AS (PARTITION BY k ORDER BY o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT k AS l_suppkey, o AS at, round(coalesce(CASE WHEN bo > ao THEN av + (bv - av) * (o - ao) / (bo - ao) ELSE av END, av, bv, 7.0), 4) AS v FROM f""")
def gap_fill(spark, sf):
    d = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("q"))
    d = d.select("l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"), F.when(F.col("l_linenumber") == 2, -1.0).otherwise(100.0 + F.col("q")).cast("double").alias("v"))
    return robust.fill_gaps(d, "l_suppkey", "at", "v", F.lit(7.0)).select("l_suppkey", "at", F.round("v", 4).alias("v"))


# ---- geometry

def _list(a: str, digits: int = 6) -> str:
    return f"array_to_string(list_transform({a}, lambda v: CAST(CAST(round(v * 1e{digits}, 0) AS BIGINT) AS VARCHAR)), ',')"


def _joined(a, digits: int = 6):
    return F.array_join(F.transform(a, lambda v: F.round(v * 10**digits, 0).cast("long").cast("string")), ",")


@query("SELECT doc_id, " + _list("[cos(a), -sin(a), 0.0, sin(a), cos(a), 0.0, 0.0, 0.0, 1.0]") + " AS r FROM (SELECT doc_id, CAST(doc_id % 300 AS DOUBLE) / 100 AS a FROM documents)")
def quaternion_rotation(spark, sf):
    half = (F.col("doc_id") % 300).cast("double") / 200
    r = geometry.quaternion_matrix(3 * F.cos(half), F.lit(0.0), F.lit(0.0), 3 * F.sin(half))
    return table(spark, sf, "documents").select("doc_id", _joined(r).alias("r"))


@query("SELECT doc_id, " + _list("[cos(a), sin(a), 0.0, -2 * (cos(a) * x + sin(a) * 3), -sin(a), cos(a), 0.0, -2 * (-sin(a) * x + cos(a) * 3), 0.0, 0.0, 1.0, -10.0, 0.0, 0.0, 0.0, 1.0]") + " AS m FROM (SELECT doc_id, CAST(doc_id % 300 AS DOUBLE) / 100 AS a, CAST(doc_id % 17 AS DOUBLE) AS x FROM documents)")
def rigid_inverse(spark, sf):
    a, z = (F.col("doc_id") % 300).cast("double") / 100, F.lit(0.0)
    r = F.array(F.cos(a), -F.sin(a), z, F.sin(a), F.cos(a), z, z, z, F.lit(1.0))
    m = geometry.invert_rigid(r, F.array((F.col("doc_id") % 17).cast("double"), F.lit(3.0), F.lit(5.0)), F.lit(2.0))
    return table(spark, sf, "documents").select("doc_id", _joined(m).alias("m"))


@query("SELECT doc_id, " + _list("[cos(c), -sin(c), 0.0, (1 - t) * 1 + t * 5, sin(c), cos(c), 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]") + " AS m FROM (SELECT doc_id, t, (1 - t) * a + t * b AS c FROM (SELECT doc_id, CAST(doc_id % 11 AS DOUBLE) / 10 AS t, CAST(doc_id % 150 AS DOUBLE) / 100 AS a, CAST(doc_id % 130 AS DOUBLE) / -100 AS b FROM documents))")
def pose_blend(spark, sf):
    i = F.col("doc_id")
    d = table(spark, sf, "documents").select("doc_id", ((i % 11).cast("double") / 10).alias("t"), _turned((i % 150).cast("double") / 100, F.lit(1.0)).alias("a"), _turned((i % 130).cast("double") / -100, F.lit(5.0)).alias("b"))
    return d.select("doc_id", _joined(geometry.blend_poses(F.col("a"), F.col("b"), F.col("t"))).alias("m"))


@query("SELECT doc_id, round(degrees(acos(greatest(-1.0, least(1.0, (2 * cos(CAST(doc_id % 300 AS DOUBLE) / 100) + 1 - 1) / 2)))), 6) AS angle, round(24.0 / 23.76 * n_chars, 6) AS focal FROM documents")
def pose_angle(spark, sf):
    a = (F.col("doc_id") % 300).cast("double") / 100
    d = table(spark, sf, "documents").select("doc_id", "n_chars", _turned(F.lit(0.0), F.lit(0.0)).alias("p"), _turned(a, F.lit(1.0)).alias("q"))
    return d.select("doc_id", F.round(geometry.rotation_angle(geometry.relative_trace(F.col("p"), F.col("q"))), 6).alias("angle"), F.round(geometry.intrinsics_from_mm(F.lit(24.0), F.col("n_chars")), 6).alias("focal"))


@query("SELECT vec_id, CASE vec_id % 5 WHEN 0 THEN " + _list("embedding[1:4]") + " WHEN 1 THEN " + _list("[embedding[1], embedding[5], embedding[3], embedding[6]]") + " WHEN 2 THEN " + _list("embedding[1:16]") + " WHEN 3 THEN " + _list("[embedding[1], embedding[5], embedding[3], embedding[6], embedding[10], embedding[14], embedding[12], embedding[15]]") + " END AS rows FROM embeddings")
def intrinsics_shapes(spark, sf):
    shapes = F.array(*[F.array(*map(F.lit, s)) for s in ((4,), (3, 3), (4, 4), (2, 3, 3), (2, 2))])
    d = table(spark, sf, "embeddings").select("vec_id", F.get(shapes, (F.col("vec_id") % 5).cast("int")).alias("shape"), F.transform("embedding", lambda x: x.cast("double")).alias("data"))
    return d.select("vec_id", _joined(F.flatten(geometry.intrinsic_rows(F.col("shape"), F.col("data")))).alias("rows"))


@query("SELECT vec_id, CASE WHEN vec_id % 4 <> 0 THEN " + _list("[embedding[1], embedding[5], embedding[9], embedding[13], embedding[2], embedding[6], embedding[10], embedding[14], embedding[3], embedding[7], embedding[11], embedding[15], embedding[4], embedding[8], embedding[12], embedding[16]]", 4) + " END AS m FROM embeddings")
def matrix_text(spark, sf):
    v = F.transform("embedding", lambda x: x.cast("double").cast("string"))
    line = lambda k: F.concat(F.lit("["), F.array_join(F.slice(v, 4 * k + 1, 4), " "), F.lit("]"))
    d = table(spark, sf, "embeddings").select("vec_id", F.concat_ws(" ", line(0), line(1), line(2), F.when(F.col("vec_id") % 4 != 0, line(3)).otherwise("[x]")).alias("s"))
    return d.select("vec_id", _joined(geometry.matrix_of_text(F.col("s")), 4).alias("m"))


# ---- frames and numbers

@query("SELECT doc_id, array_to_string(list_transform(range(0, 7), lambda j: CAST(least(n_chars - 1, CAST(doc_id % 5 + floor(j * s + 0.5) AS BIGINT)) AS VARCHAR)), ',') AS picks FROM (SELECT *, CAST(1 + doc_id % 4 AS DOUBLE) / 2 AS s FROM documents WHERE n_chars > 0)")
def half_up_picks(spark, sf):
    i = F.col("doc_id")
    p = arrays.half_up_indices(i % 5, (1 + i % 4).cast("double") / 2, 7, F.col("n_chars"))
    return table(spark, sf, "documents").where("n_chars > 0").select("doc_id", F.array_join(F.transform(p, lambda x: x.cast("string")), ",").alias("picks"))


@query("WITH d AS (SELECT doc_id, n_chars AS n, CAST(greatest(1, round_even(CAST(24 + doc_id % 7 AS DOUBLE) * 0.5, 0)) AS INT) AS stride, CAST(least(n_chars - 1, round_even(CAST(24 + doc_id % 7 AS DOUBLE) * 4.0, 0)) AS INT) AS last FROM documents) SELECT doc_id, array_to_string(CASE WHEN greatest(last, 0) // stride >= 1 THEN range(0, greatest(last, 0) + 1, stride) WHEN n > 1 THEN [0, n - 1] ELSE [0] END, ',') AS picks FROM d")
def timed_picks(spark, sf):
    p = arrays.timed_indices(F.col("n_chars").cast("int"), (24 + F.col("doc_id") % 7).cast("double"), 0.5, 4.0)
    return table(spark, sf, "documents").select("doc_id", F.array_join(F.transform(p, lambda x: x.cast("string")), ",").alias("picks"))


@query("SELECT doc_id, CAST(greatest(ceil(CAST(doc_id % 97 AS DOUBLE) / 10 - 0.05), 1) AS INT) AS n, CAST(greatest(ceil(CAST(doc_id % 97 AS DOUBLE) / 10 - 0.05), 1) - 1 AS DOUBLE) AS last FROM documents")
def second_stamps(spark, sf):
    t = arrays.timestamps((F.col("doc_id") % 97).cast("double") / 10, 0.05)
    return table(spark, sf, "documents").select("doc_id", F.size(t).alias("n"), F.element_at(t, -1).alias("last"))


@query("SELECT vec_id, round(CAST(list_sort(embedding)[least(len(embedding) - 1, len(embedding) * 90 // 100) + 1] AS DOUBLE), 6) AS p90, round(list_stddev_pop(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE)))) / (list_avg(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE)))) + 1e-8), 6) AS cov FROM embeddings")
def array_ranks(spark, sf):
    v = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf, "embeddings").select("vec_id", F.round(arrays.nearest_rank(v, 90.0), 6).alias("p90"), F.round(arrays.scale_cov_eps(F.transform(v, lambda x: F.abs(x))), 6).alias("cov"))


@query("SELECT doc_id, CASE n WHEN 121 THEN '5s' WHEN 1437 THEN '60s' WHEN 81 THEN '81f' WHEN 160 THEN '160f' WHEN 960 THEN '960f' END AS spec, n IN (121, 1437, 81, 160, 960) AS fits, (n - 1) % 4 = 0 AS aligned FROM (SELECT doc_id, ([121, 1437, 81, 160, 960, 500, 3])[doc_id % 7 + 1] AS n FROM documents)")
def spec_lengths(spark, sf):
    n = F.get(F.array(*[F.lit(x) for x in (121, 1437, 81, 160, 960, 500, 3)]), (F.col("doc_id") % 7).cast("int"))
    return table(spark, sf, "documents").select("doc_id", specs.spec_of_frames(n).alias("spec"), specs.on_spec(n).alias("fits"), specs.latent_aligned(n).alias("aligned"))


# ---- text and keys

@query("SELECT page_id, replace(replace(url, '/', '_'), '.', '_') AS path_key, regexp_replace(url, '[^A-Za-z0-9_-]', '_', 'g') AS shard_key FROM pages")
def file_keys(spark, sf):
    return table(spark, sf, "pages").select("page_id", hashing.path_key(F.col("url")).alias("path_key"), hashing.shard_key(F.col("url")).alias("shard_key"))


@query("SELECT doc_id, round(2.0 + CAST(('0x' || substr(sha1(CAST(doc_id AS VARCHAR) || ':s'), 1, 8)) AS BIGINT) / 4294967295.0 * 3.0, 9) AS x FROM documents")
def seeded_numbers(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(hashing.seeded(F.col("doc_id"), 2.0, 5.0, "s"), 9).alias("x"))


@query("SELECT conv_id, turn, array_to_string(list_filter(string_split(text, '. '), lambda s: NOT regexp_matches(lower(s), '(^|[^\\p{L}\\p{N}_])(the|der|que)($|[^\\p{L}\\p{N}_])')), '. ') AS kept FROM conversations WHERE text IS NOT NULL")
def sentence_filter(spark, sf):
    return table(spark, sf, "conversations").where("text IS NOT NULL").select("conv_id", "turn", text.drop_sentences(F.col("text"), ["the", "der", "que"]).alias("kept"))


@query("SELECT conv_id, turn, CASE WHEN length(trim(t, E' \\t\\n\\r\\f\\v')) > 0 AND right(trim(t, E' \\t\\n\\r\\f\\v'), 1) IN ('.', '!', '?') THEN trim(t, E' \\t\\n\\r\\f\\v') ELSE trim(t, E' \\t\\n\\r\\f\\v') || '.' END AS stopped, trim(t, E' \\t\\n\\r\\f\\v') AS inner_text FROM (SELECT conv_id, turn, coalesce(text, '') AS t FROM conversations)")
def fenced_text(spark, sf):
    """Every text inside a fence, and stripped and stopped."""
    t = F.coalesce("text", F.lit(""))
    return table(spark, sf, "conversations").select("conv_id", "turn", text.with_full_stop(F.col("text")).alias("stopped"), text.strip(text.unfence(F.concat(F.lit(" ```json\n"), t, F.lit("\n``` ")))).alias("inner_text"))


@query("SELECT conv_id, turn, CASE conv_id % 6 WHEN 0 THEN 'camera|pan' WHEN 1 THEN 'video' WHEN 2 THEN '' WHEN 3 THEN 'person_people|driving' WHEN 4 THEN 'likely' ELSE 'bird' END AS names, conv_id % 6 = 0 AS moves FROM conversations")
def caption_wording(spark, sf):
    said = F.get(F.array(*map(F.lit, ("The Camera pans left.", "A VIDEO of hills.", "Hills and companion trees.", "A man driving home.", "Most likely a wall.", "Birds above."))), (F.col("conv_id") % 6).cast("int"))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.array_join(text.forbidden_wording(said), "|").alias("names"), text.has_camera_motion(said).alias("moves"))


@query(r"SELECT page_id, regexp_matches(url || tail, '^https?://[^/?#@\s]+(/[^?#@\s]*)?$') AS ok FROM (SELECT page_id, coalesce(url, '') AS url, ([ '', '?a=1', '#x', '/b'])[page_id % 4 + 1] AS tail FROM pages)")
def endpoint_check(spark, sf):
    tail = F.get(F.array(*map(F.lit, ("", "?a=1", "#x", "/b"))), (F.col("page_id") % 4).cast("int"))
    return table(spark, sf, "pages").select("page_id", text.plain_endpoint(F.concat(F.coalesce("url", F.lit("")), tail)).alias("ok"))


@query("SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN round(epoch(make_timestamp(1600000000000000 + event_id * 1234567)), 6) END AS seconds FROM events")
def name_seconds(spark, sf):
    at = F.timestamp_micros(1600000000000000 + F.col("event_id") * 1234567)
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    name = F.concat(F.lit("000_site_"), F.when(F.col("event_id") % 9 != 0, iso).otherwise("x"), F.lit(".jpg"))
    return table(spark, sf, "events").select("event_id", F.round(text.seconds_of_name(name), 6).alias("seconds"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Own words' ELSE (['One place', 'Two places', 'Three places'])[CAST(('0x' || substr(sha1(CAST(doc_id AS VARCHAR)), 1, 2)) AS INT) % 3 + 1] END AS caption FROM documents")
def caption_choice(spark, sf):
    own = F.when(F.col("doc_id") % 3 == 0, "Own words, zooming.").when(F.col("doc_id") % 3 == 1, "  ")
    return table(spark, sf, "documents").select("doc_id", text.choose_caption(own, F.col("doc_id"), ["One place.", "Two places.", "Three places, handheld."]).alias("caption"))


# ---- readers and writers

@query("SELECT CAST(doc_id AS VARCHAR) AS clip_id, source, CASE WHEN doc_id % 4 <> 0 THEN CAST(n_chars AS INT) END AS num_frames, CASE WHEN doc_id % 5 = 0 THEN 'high' END AS kept_tier, doc_id % 3 <> 2 AS judged, CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id % 50 AS DOUBLE) END AS vmaf, CASE WHEN doc_id % 7 = 0 THEN 'default' ELSE 'gt_pose' END AS mode FROM documents")
def manifest_scan(spark, sf):
    """Records as JSON lines, with absent and null fields, written to the shared folder and read as a manifest."""
    i = F.col("doc_id")
    record = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, ("clip_id", "source", "num_frames", "metrics", "mode"))), F.array(F.to_json(F.struct(i.cast("string").alias("v"))), F.to_json(F.struct(F.col("source").alias("v"))), F.when(i % 4 != 0, F.to_json(F.struct(F.col("n_chars").alias("v")))), F.when(i % 2 == 0, F.to_json(F.struct(F.struct((i % 50).cast("double").alias("vmaf")).alias("v")))), F.when(i % 7 != 0, F.lit('{"v":"gt_pose"}')))), lambda k, v: v.isNotNull())
    parts = F.transform(F.map_entries(record), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), F.regexp_extract(e["value"], r'^\{"v":(.*)\}$', 1)))
    tier = F.when(i % 3 != 2, F.when(i % 5 == 0, F.lit('"kept_tier":"high"')).otherwise(F.lit('"kept_tier":null'))).when(i % 5 == 0, F.lit('"kept_tier":"high"'))
    line = F.concat(F.lit("{"), F.array_join(F.filter(F.array_append(parts, tier), lambda x: x.isNotNull()), ","), F.lit("}"))
    d = manifest.read_manifest(spark, _lines(spark, table(spark, sf, "documents").select(line.alias("value")), "manifest"))
    return d.select("clip_id", "source", "num_frames", "kept_tier", (F.col("judged") & (F.col("clip_id").cast("long") % 3 != 2)).alias("judged"), "metrics.vmaf", "mode")


@query("SELECT CAST(c_custkey AS VARCHAR) AS clip_id FROM customer")
def owner_scan(spark, sf):
    """One folder of JSON lines an owner, with broken lines among them, which the reader skips."""
    home = f"{scratch(spark)}/owners-{uuid.uuid4().hex}"
    d = table(spark, sf, "customer").select(F.concat(F.lit("src"), (F.col("c_nationkey") % 3).cast("string")).alias("owner"), F.to_json(F.struct(F.col("c_custkey").cast("string").alias("clip_id"))).alias("value"))
    d.union(d.select("owner", F.lit("{broken").alias("value")).distinct()).write.partitionBy("owner").text(home)
    return manifest.read_owners(spark, home).select("clip_id")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS clip_id FROM orders WHERE o_orderkey % 3 <> 1")
def kept_id_scan(spark, sf):
    """Ids as plain lines, as records, and as records that a null tier leaves out."""
    k = F.col("o_orderkey")
    line = F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, F.concat(F.lit('{"clip_id":"'), k.cast("string"), F.lit('","kept_tier":null}'))).otherwise(F.concat(F.lit('{"clip_id":"'), k.cast("string"), F.lit('"}')))
    return manifest.kept_ids(spark, _lines(spark, table(spark, sf, "orders").select(line.alias("value")), "kept"))


@query("SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS clip_id FROM customer WHERE c_custkey % 4 <> 0")
def id_list_scan(spark, sf):
    k = F.col("c_custkey").cast("string")
    line = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("# "), k)).otherwise(F.concat(k, F.lit("  "), k, F.lit(" # why")))
    return manifest.id_list(spark, _lines(spark, table(spark, sf, "customer").select(line.alias("value")), "list")).select("clip_id").distinct()


@query("SELECT 'src' || CAST(o_custkey % 3 AS VARCHAR) AS source, CAST(o_orderkey AS VARCHAR) AS item, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS clip_id FROM orders WHERE o_custkey % 3 = 1")
def pointer_scan(spark, sf):
    k = F.col("o_orderkey")
    d = table(spark, sf, "orders").select(F.to_json(F.struct(F.concat(F.lit("src"), (F.col("o_custkey") % 3).cast("string")).alias("source"), k.cast("string").alias("item"), F.when(k % 2 == 0, F.array(F.col("o_orderstatus"), F.col("o_orderstatus"))).alias("kept_clips"))).alias("value"))
    got = manifest.pointers(spark, _lines(spark, d, "pointers"), "src1")
    return got.select(F.lit("src1").alias("source"), "item", "clip_id")


@query("SELECT DISTINCT 'v' || CAST(p_partkey AS VARCHAR) || '.a' AS clip_id FROM part")
def stem_scan(spark, sf):
    path = f"{scratch(spark)}/csv-{uuid.uuid4().hex}"
    table(spark, sf, "part").select(F.concat(F.lit("v"), F.col("p_partkey").cast("string"), F.lit(".a.mp4")).alias("videoFile"), "p_size").write.option("header", "true").csv(path)
    return manifest.video_stems(spark, path)


@query("SELECT CAST(doc_id AS INT) AS image_id, CAST(doc_id % 10 AS DOUBLE) / 10 AS qw, CAST(doc_id AS DOUBLE) AS tz, 'f' || CAST(doc_id AS VARCHAR) || '.jpg' AS name FROM documents")
def camera_text_scan(spark, sf):
    i = F.col("doc_id").cast("string")
    pose = F.concat_ws(" ", i, ((F.col("doc_id") % 10).cast("double") / 10).cast("string"), F.lit("0 0 0 1 2"), i, F.lit("1"), F.concat(F.lit("f"), i, F.lit(".jpg")))
    lines = table(spark, sf, "documents").select(F.lit("images.txt").alias("file"), F.lit(0).alias("n"), F.explode(F.array(F.lit("# note"), pose, F.lit("1.0 2.0 -1 3.0 4.0 -1 5.0 6.0 -1 7.0 8.0 -1"))).alias("value"))
    return manifest.camera_text(lines).select("image_id", "qw", "tz", "name")


def _le(v, kind: str):
    """Little-endian bytes of a number, from its hexadecimal digits."""
    wide = {"int": 8, "long": 16}[kind]
    h = F.lpad(F.lower(F.hex(v)), wide, "0")
    return F.unhex(F.concat(*[F.substring(h, wide - 2 * k - 1, 2) for k in range(wide // 2)]))


@query("SELECT CAST(doc_id AS VARCHAR) AS path, c AS camera_id, CASE c WHEN 0 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS fx, 2.0::DOUBLE AS fy, 1.0::DOUBLE AS cx FROM documents, (SELECT unnest([0, 1]) AS c)")
def camera_binary_scan(spark, sf):
    """Two cameras a file, of the models of three and four numbers."""
    one, two = bytes.fromhex("000000000000f03f"), bytes.fromhex("0000000000000040")
    size = (1280).to_bytes(8, "little") + (720).to_bytes(8, "little")
    data = (2).to_bytes(8, "little") + (0).to_bytes(4, "little") + (0).to_bytes(4, "little") + size + two + one + one + (1).to_bytes(4, "little") + (1).to_bytes(4, "little") + size + one + two + one + one
    files = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("path"), F.unhex(F.lit(data.hex())).alias("content"))
    return manifest.camera_binary(files).select("path", "camera_id", "fx", "fy", "cx")


@query("SELECT CAST(doc_id AS VARCHAR) AS path, 'f' || CAST(doc_id AS VARCHAR) || '.jpg' AS name, 1.0::DOUBLE AS qw, 2.0::DOUBLE AS tz, CAST(doc_id AS INT) AS camera_id FROM documents")
def image_binary_scan(spark, sf):
    one, two, nought = bytes.fromhex("000000000000f03f"), bytes.fromhex("0000000000000040"), bytes(8)
    i = F.col("doc_id")
    raw = lambda b: F.unhex(F.lit(b.hex()))
    content = F.concat(raw((1).to_bytes(8, "little") + (7).to_bytes(4, "little") + one + nought * 5 + two), _le(i.cast("int"), "int"), F.encode(F.concat(F.lit("f"), i.cast("string"), F.lit(".jpg")), "UTF-8"), raw(b"\0" + (1).to_bytes(8, "little") + bytes(24)))
    return manifest.image_binary(table(spark, sf, "documents").select(i.cast("string").alias("path"), content.alias("content"))).select("path", "name", "qw", "tz", "camera_id")


@query("SELECT doc_id, source FROM documents")
def missing_rows_sink(spark, sf):
    """Two overlapping writes and a repeat of the second leave each row once."""
    path = f"{scratch(spark)}/rows-{uuid.uuid4().hex}"
    d = table(spark, sf, "documents").select("doc_id", "source")
    sinks.write_missing(d.where("doc_id % 3 <> 0"), path, "doc_id")
    for _ in range(2):
        sinks.write_missing(d.where("doc_id % 2 = 0 OR doc_id % 3 = 0"), path, "doc_id")
    sinks.write_missing(d, path, "doc_id")
    return spark.read.parquet(path)


@query("SELECT source, doc_id FROM documents WHERE source IS NOT NULL")
def owner_sink(spark, sf):
    path = f"{scratch(spark)}/by-owner-{uuid.uuid4().hex}"
    sinks.write_by_owner(table(spark, sf, "documents").where("source IS NOT NULL").select("doc_id", "source"), path)
    return spark.read.json(path).select("source", "doc_id")


@query("SELECT doc_id, 'complete' AS state FROM documents")
def overlay_sink(spark, sf):
    path = f"{scratch(spark)}/overlay-{uuid.uuid4().hex}"
    sinks.write_overlay(table(spark, sf, "documents").select("doc_id"), path)
    return spark.read.json(f"{path}/data").crossJoin(F.broadcast(spark.read.json(f"{path}/COMPLETE")))


@query("SELECT CAST(doc_id AS VARCHAR) AS key, name, length(name) + length(CAST(doc_id AS VARCHAR)) AS n FROM documents, (SELECT unnest(['meta.json', 'video.mp4', 'prompt.txt']) AS name) WHERE doc_id % 10 = doc_id % 10")
def tar_round_trip(spark, sf):
    d = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 50).alias("shard"), F.col("doc_id").cast("string").alias("key"), F.explode(F.array(*map(F.lit, ("prompt.txt", "video.mp4", "meta.json")))).alias("name"))
    tars = packing.tar_shards(d.withColumn("content", F.encode(F.concat("name", "key"), "UTF-8")))
    got = packing.read_tars(tars.select(F.col("shard").cast("string").alias("path"), F.col("tar").alias("content")))
    return got.select("key", "name", F.length("content").alias("n"))


@query("SELECT s.source, CASE s.source WHEN 'dl3dv' THEN 'default' WHEN 'abot' THEN 'gt_pose' ELSE 'gt_pose' END AS pose_mode, CASE s.source WHEN 'abot' THEN false WHEN 'zod' THEN true END AS metric FROM (SELECT (['dl3dv', 'abot', 'zod'])[doc_id % 3 + 1] AS source FROM documents) s")
def source_modes(spark, sf):
    d = table(spark, sf, "documents").select(F.get(F.array(*map(F.lit, ("dl3dv", "abot", "zod"))), (F.col("doc_id") % 3).cast("int")).alias("source"))
    return known.with_mode(d).select("source", "pose_mode", "metric")


@query("SELECT DISTINCT 'd/' || CAST(o_orderkey AS VARCHAR) AS item FROM orders WHERE o_orderkey % 10 IN (1, 2)")
def restricted_items(spark, sf):
    k = F.col("o_orderkey")
    items = table(spark, sf, "orders").select(F.concat(F.lit("d/"), k.cast("string")).alias("item")).distinct()
    wanted = table(spark, sf, "orders").where(k % 10 == 1).select(F.concat(F.lit("d/"), k.cast("string")).alias("item")).union(table(spark, sf, "orders").where(k % 10 == 2).select(k.cast("string").alias("item")))
    return select.restrict_items(items, wanted)


@query("SELECT o_custkey, count(*) AS tries, count(*) FILTER (o_orderstatus = 'F') AS failures, CASE WHEN count(*) FILTER (o_orderstatus = 'F') < count(*) THEN 'done' WHEN count(*) FILTER (o_orderstatus = 'F') >= 3 THEN 'closed' ELSE 'open' END AS state FROM orders GROUP BY 1")
def retry_state(spark, sf):
    from ..streaming import ingest

    return ingest.attempts(table(spark, sf, "orders").withColumn("failed", F.col("o_orderstatus") == "F"), "o_custkey", "failed").select("o_custkey", "tries", "failures", "state")


@query("WITH n AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2) SELECT event_type, count(*) AS users, CAST(sum(n) AS BIGINT) AS rows FROM n GROUP BY 1")
def sampled_whole(spark, sf):
    """A systematic sample as large as its groups is the whole table."""
    d = calibrate.systematic_sample(table(spark, sf, "events"), "event_type", "event_id", 10**9)
    return d.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("rows"))


# ---- work items

_FILES = "SELECT doc_id AS k, (['raw/shard-' || doc_id || '.tar', 'b' || doc_id % 9 || '/h' || doc_id || '/video.mp4', 'x/sekai-real-walking_part_a_part' || doc_id || '.tar', 'annotations/g.1/u' || doc_id % 50 || '/a_others.tar.gz', 'annotations/gx1/u' || doc_id || '/a_others.tar.gz', 'drone/c' || doc_id || '.mp4', 'drone/c' || (doc_id - 1) || '.npz', 'v/RealEstate10K/z' || doc_id || '.zip'])[doc_id % 8 + 1] AS path FROM documents"


def _files(spark, sf):
    i, n = F.col("doc_id"), F.col("doc_id").cast("string")
    word = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    kinds = [word("raw/shard-", n, ".tar"), word("b", i % 9, "/h", n, "/video.mp4"), word("x/sekai-real-walking_part_a_part", n, ".tar"), word("annotations/g.1/u", i % 50, "/a_others.tar.gz"), word("annotations/gx1/u", n, "/a_others.tar.gz"), word("drone/c", n, ".mp4"), word("drone/c", i - 1, ".npz"), word("v/RealEstate10K/z", n, ".zip")]
    return table(spark, sf, "documents").select(F.get(F.array(*kinds), (i % 8).cast("int")).alias("path"))


@query(f"""WITH f AS ({_FILES}), s AS (SELECT 'dl3dv' AS source, path[:-11] AS item FROM f WHERE k % 8 = 1)
SELECT 'mira' AS source, path[:-5] AS item FROM f WHERE k % 8 = 0 UNION ALL SELECT source, item FROM s UNION ALL SELECT 'mind', item FROM s UNION ALL SELECT 'sekai_walking', 'part' || k FROM f WHERE k % 8 = 2
UNION ALL SELECT DISTINCT 'omniworld', 'u' || k % 50 FROM f WHERE k % 8 = 3 UNION ALL SELECT 'sekai_game', 'drone/c' || k FROM f WHERE k % 8 = 5 AND k + 1 IN (SELECT k FROM f) UNION ALL SELECT 'realcam_vid', path FROM f WHERE k % 8 = 7
UNION ALL SELECT 'spatialvid', lpad(CAST(g AS VARCHAR), 4, '0') || '#' || j FROM range(1, 75) t(g), range(0, 8) u(j) UNION ALL SELECT DISTINCT 'abot', CAST(conv_id AS VARCHAR) FROM conversations""")
def work_items(spark, sf):
    """The items of nine sources from one listing, from generated names and from records."""
    paths, out = _files(spark, sf), None
    episodes = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("sample_id"))
    for source in ("mira", "dl3dv", "mind", "sekai_walking", "omniworld", "sekai_game", "realcam_vid", "spatialvid", "abot"):
        got = items.work_items(spark, source, paths, records=episodes, game="g.1", stripes=8)
        out = got if out is None else out.unionByName(got)
    return out


@query("SELECT 'sekai_game' AS source, unnest(['drone', 'walking']) AS item UNION ALL SELECT 'realcam_vid', 'a/RealEstate10K/' || p_partkey || '.mp4' FROM part UNION ALL SELECT 'spatialvid', lpad(CAST(g AS VARCHAR), 3, '0') || '/data_' || lpad(CAST(z AS VARCHAR), 3, '0') FROM range(1, 6) t(g), range(1, 6) u(z)")
def work_items_without_archives(spark, sf):
    """What the rules fall back on where nothing is unpacked or packed."""
    paths = table(spark, sf, "part").select(F.explode(F.array(F.concat(F.lit("a/RealEstate10K/"), F.col("p_partkey").cast("string"), F.lit(".mp4")), F.lit("a/Other/x.zip"))).alias("path"))
    nothing = paths.where("path = ''")
    return items.work_items(spark, "sekai_game", nothing).unionByName(items.work_items(spark, "realcam_vid", paths)).unionByName(items.work_items(spark, "spatialvid"))


@query("SELECT 'h' || doc_id AS key, 'b' || doc_id % 9 || '/h' || doc_id || '/video.mp4' AS path FROM documents WHERE doc_id % 8 = 1")
def paths_by_key(spark, sf):
    return items.path_by_key(_files(spark, sf).where(F.col("path").endswith("/video.mp4")))


@query("SELECT p_partkey, CAST(p_size * CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 2 END AS DOUBLE) AS x FROM part WHERE p_partkey % 5 <> 0")
def stem_metadata(spark, sf):
    d, k = table(spark, sf, "part"), F.col("p_partkey")
    videos = d.select("p_partkey", F.concat(F.lit("d/e.f/v"), k.cast("string"), F.lit(".x.mp4")).alias("video_path"))
    meta = d.where(k % 5 != 0).select(F.concat(F.lit("v"), k.cast("string"), F.lit(".x")).alias("stem"), F.when(k % 3 != 0, 2.0).alias("align_factor"), F.array(F.col("p_size").cast("double"), F.lit(0.0), F.lit(0.0)).alias("translation"))
    return items.with_metadata(videos, meta).select("p_partkey", F.get("translation", F.lit(0)).alias("x"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (1, 2, 3) ORDER BY c_custkey LIMIT 20")
def requested_rows(spark, sf):
    return items.requested(table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), [1, 2, 3], "c_custkey", "c_nationkey", 20).select("c_custkey", "c_name")


# ---- answers

@query("SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN role WHEN 1 THEN role || 'x' WHEN 2 THEN '' END AS said FROM conversations")
def answer_text(spark, sf):
    """Contents that are a string, parts of which some are text, no parts, and neither."""
    r = F.col("role")
    content = F.get(F.array(F.concat(F.lit('"'), r, F.lit('"')), F.concat(F.lit('[{"type":"text","text":"'), r, F.lit('"},{"type":"image","text":"no"},{"type":"output_text","text":"x"},{"type":"text"}]')), F.lit("[]"), F.lit("5")), (F.col("conv_id") % 4).cast("int"))
    raw = F.concat(F.lit('{"choices":[{"message":{"content":'), content, F.lit("}},{}]}"))
    return table(spark, sf, "conversations").select("conv_id", "turn", annotation.choice_text(raw).alias("said"))


@query("SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN '' WHEN conv_id % 2 = 0 THEN 'assistant:' || role || '|user:Again: a' || CASE WHEN turn % 3 = 2 THEN '; b' ELSE '' END || '.' ELSE 'user:Again: a' || CASE WHEN turn % 3 = 2 THEN '; b' ELSE '' END || '.' END AS said FROM conversations")
def retry_messages(spark, sf):
    errors = F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), (F.col("turn") % 3).cast("int"))
    m = annotation.feedback(errors, F.when(F.col("conv_id") % 2 == 0, F.col("role")), "Again: ", ".")
    return table(spark, sf, "conversations").select("conv_id", "turn", F.array_join(F.transform(m, lambda x: F.concat_ws(":", x["role"], x["content"])), "|").alias("said"))
