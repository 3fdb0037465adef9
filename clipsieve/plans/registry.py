"""Queries over the driver's tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, geometry, hashing, specs, text
from ..functions.predicates import codes
from ..operators import assemble, calibrate, dedup, judge, lineage, packing, robust, select, semantic, split, trajectory, validate
from ..streaming import ingest
from .views import CLIPS_SQL, JUDGED_SQL, ORDER, POLICIES, clips, scratch, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _judged(spark, sf):
    return judge.judge(clips(spark, sf), judge.policy_table(spark, POLICIES))


@query(JUDGED_SQL + "SELECT clip_id, source, kept_tier, array_to_string(k, '|') AS reasons FROM j")
def judge_tiers(spark, sf):
    return _judged(spark, sf).select("clip_id", "source", "kept_tier", F.array_join(codes("reject_reasons"), "|").alias("reasons"))


@query(JUDGED_SQL + ", e AS (SELECT source, unnest(k) AS code FROM j) SELECT source, code, count(*) AS n FROM e GROUP BY ALL")
def reject_histogram(spark, sf):
    return judge.reject_histogram(_judged(spark, sf))


@query(JUDGED_SQL + "SELECT source, count(*) FILTER (kept_tier = 'xhigh') AS promoted, count(kept_tier) AS kept FROM j GROUP BY 1")
def xhigh_promotions(spark, sf):
    return _judged(spark, sf).groupBy("source").agg(F.count_if(F.col("kept_tier") == "xhigh").alias("promoted"), F.count("kept_tier").alias("kept"))


@query(
    JUDGED_SQL
    + """SELECT source, s AS stored, kept_tier AS judged, CASE WHEN s IS NOT DISTINCT FROM kept_tier THEN 'ok' WHEN s IS NULL AND doc_id % 3 = 0 THEN 'explained' ELSE 'bad' END AS verdict, count(*) AS n
FROM (SELECT *, CASE WHEN doc_id % 10 < 7 THEN kept_tier WHEN doc_id % 10 < 9 THEN NULL ELSE 'high' END AS s FROM j) GROUP BY ALL"""
)
def policy_confusion(spark, sf):
    j = _judged(spark, sf)
    stored = j.select("clip_id", "source", F.when(F.col("doc_id") % 10 < 7, F.col("kept_tier")).when(F.col("doc_id") % 10 < 9, F.lit(None)).otherwise("high").alias("stored_tier"), F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("recipe_lineage_x"))).otherwise(F.array(F.lit("vmaf=1"))).alias("stored_reasons"))
    return judge.agreement(stored, j)


_HITS = "list_filter([CASE WHEN cuts > 0 THEN 'scene_transition' END, CASE WHEN list_contains(flags, 'near_static') THEN 'near_static' END, CASE WHEN list_contains(flags, 'blurry') THEN 'blurry' END, CASE WHEN list_contains(flags, 'watermark') THEN 'watermark' END, CASE WHEN coalesce(q, 0) < 3 THEN 'quality_lt3' END, CASE WHEN coalesce(q, 0) < 4 THEN 'quality_lt4' END], lambda x: x IS NOT NULL)"


@query(CLIPS_SQL + f", h AS (SELECT clip_id, CASE WHEN annotated THEN {_HITS} ELSE [] END AS h FROM c) SELECT clip_id, array_to_string(h, ',') AS hits, list_has_any(h, ['scene_transition', 'near_static', 'blurry', 'single_color', 'quality_lt3']) AS wide, list_has_any(h, ['scene_transition', 'near_static', 'blurry', 'single_color', 'quality_lt4', 'watermark', 'ui_overlay', 'text_heavy']) AS elite FROM h")
def semantic_presets(spark, sf):
    d = clips(spark, sf).select("clip_id", semantic.audit_hits(F.col("vlm")).alias("h"))
    return d.select("clip_id", F.array_join("h", ",").alias("hits"), semantic.preset_drops(F.col("h"), "wide").alias("wide"), semantic.preset_drops(F.col("h"), "elite").alias("elite"))


@query(CLIPS_SQL + "SELECT source, count(*) FILTER (cuts > 0) AS scene_transition, count(*) FILTER (list_contains(flags, 'near_static')) AS near_static, count(*) FILTER (list_contains(flags, 'blurry')) AS blurry, 0::BIGINT AS single_color, count(*) FILTER (list_contains(flags, 'watermark')) AS watermark, 0::BIGINT AS ui_overlay, 0::BIGINT AS text_heavy, 0::BIGINT AS low_light, count(*) FILTER (coalesce(q, 0) < 3) AS quality_lt3, count(*) FILTER (coalesce(q, 0) < 4) AS quality_lt4 FROM c WHERE annotated GROUP BY 1")
def semantic_audit(spark, sf):
    return semantic.audit_counts(clips(spark, sf), F.col("vlm"))


@query(CLIPS_SQL + """SELECT clip_id, array_to_string(list_filter([CASE WHEN num_frames < 500 THEN 'path_min' END, CASE WHEN num_frames > 9000 THEN 'path_max' END, CASE WHEN NOT annotated THEN 'vlm_missing' END,
CASE WHEN annotated AND coalesce(q < 2, true) THEN 'q_min' END, CASE WHEN annotated AND cuts > 0 THEN 'transition' END, CASE WHEN annotated AND len(list_filter(flags, lambda f: f <> 'blurry')) > 0 THEN 'flags' END], lambda x: x IS NOT NULL), '|') AS reasons FROM c""")
def semantic_config(spark, sf):
    block = {"path_min_m": 500, "path_max_m": 9000, "quality_min": 2, "transition_max": 0, "flags_allowed": ["blurry"]}
    return clips(spark, sf).select("clip_id", F.array_join(codes(semantic.config_reasons(F.col("vlm"), block, F.col("num_frames").cast("double"))), "|").alias("reasons"))


@query(CLIPS_SQL + """, g AS (SELECT clip_id, doc_id % 2 = 0 AS ext, * EXCLUDE (clip_id) FROM c) SELECT clip_id, array_to_string(list_filter([
CASE WHEN CASE WHEN ext THEN NOT (fx - 5 BETWEEN 25 AND 120) OR NOT (fx + 5 BETWEEN 25 AND 120) ELSE NOT (fx BETWEEN 25 AND 120) END THEN 'fov_x' END,
CASE WHEN CASE WHEN ext THEN NOT (fy - 5 BETWEEN 25 AND 120) OR NOT (fy + 5 BETWEEN 25 AND 120) ELSE NOT (fy BETWEEN 25 AND 120) END THEN 'fov_y' END,
CASE WHEN NOT (CASE WHEN ext THEN fdm ELSE fd END BETWEEN 0 AND 0.2) THEN 'focal_div' END,
CASE WHEN NOT (list_stddev_pop(scale_factors) / abs(list_avg(scale_factors)) BETWEEN 0 AND 0.06) THEN 'scale_cov' END], lambda x: x IS NOT NULL), '|') AS reasons FROM g""")
def camera_gates(spark, sf):
    return clips(spark, sf).select("clip_id", F.array_join(codes(judge.camera_reasons((25.0, 120.0), 0.2, 0.06)), "|").alias("reasons"))


@query(CLIPS_SQL + "SELECT clip_id, array_to_string(list_filter([CASE WHEN NOT (fx BETWEEN 25 AND 120) THEN 'fov_x' END, CASE WHEN NOT (fy BETWEEN 25 AND 120) THEN 'fov_y' END, CASE WHEN NOT (fd BETWEEN 0 AND 0.2) THEN 'focal_div' END, CASE WHEN NOT (CAST(doc_id % 20 AS DOUBLE) / 100 BETWEEN 0 AND 0.1) THEN 'scale_cov' END], lambda x: x IS NOT NULL), '|') AS reasons FROM c")
def camera_gates_median(spark, sf):
    return clips(spark, sf).select("clip_id", F.array_join(codes(judge.median_camera_reasons((25.0, 120.0), 0.2, 0.1)), "|").alias("reasons"))


def _owners(spark, sf):
    return table(spark, sf, "documents").select(F.col("source").alias("owner"), F.col("doc_id").alias("clip_id"), F.col("n_chars").alias("num_frames"))


_RANKED = "WITH d AS (SELECT source AS owner, doc_id AS clip_id, n_chars AS num_frames, row_number() OVER (PARTITION BY source ORDER BY substr(sha256(CAST(doc_id AS VARCHAR)), 1, 16), doc_id) AS rn FROM documents) "


@query(_RANKED + "SELECT owner, clip_id, CASE WHEN rn <= 5 THEN 'test' ELSE 'train' END AS side FROM d")
def split_train_test(spark, sf):
    train, test = split.train_test(_owners(spark, sf), 5)
    return train.select("owner", "clip_id", F.lit("train").alias("side")).unionByName(test.select("owner", "clip_id", F.lit("test").alias("side")))


@query(_RANKED + "SELECT owner, count(*) AS eligible, count(*) FILTER (rn <= 5) AS test, count(*) FILTER (rn > 5) AS train, CASE owner WHEN 'src1' THEN 3 WHEN 'src2' THEN 2 ELSE 1 END AS repeat, count(*) FILTER (rn > 5) * CASE owner WHEN 'src1' THEN 3 WHEN 'src2' THEN 2 ELSE 1 END AS virtual FROM d GROUP BY 1")
def recipe_report(spark, sf):
    d = _owners(spark, sf)
    return split.split_report(d, split.train_test(d, 5)[1], {"src1": 3, "src2": 2})


@query(_RANKED + "SELECT owner, clip_id, CAST(k * 153 AS INTEGER) AS start_frame, 153 AS num_frames FROM (SELECT *, unnest(range(0, CAST(floor(num_frames / 153) AS BIGINT))) AS k FROM d WHERE rn > 5)")
def window_view(spark, sf):
    return split.window_rows(split.train_test(_owners(spark, sf), 5)[0], 153)


@query("WITH d AS (SELECT source AS owner, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY substr(sha256(CAST(doc_id AS VARCHAR)), 1, 16), doc_id) AS rn FROM documents WHERE n_chars >= 160 AND n_chars <= 9000) SELECT owner, count(*) AS clips, count(*) FILTER (rn <= 5) AS test_clips, CAST(sum(n_chars // 153) AS BIGINT) AS windows FROM d GROUP BY 1")
def window_report(spark, sf):
    d = split.fits(_owners(spark, sf), 153, 160, 9000)
    n = split.train_test(d, 5)[1].groupBy("owner").agg(F.count("*").alias("test_clips"))
    return d.groupBy("owner").agg(F.count("*").alias("clips"), F.sum(F.size(split.windows(F.col("num_frames"), 153))).alias("windows")).join(n, "owner").select("owner", "clips", "test_clips", "windows")


@query("WITH d AS (SELECT doc_id, CAST(greatest(2, CAST(round_even(CAST(24 + doc_id % 7 AS DOUBLE) * 5, 0) AS INT)) AS INT) AS span, n_chars AS n, 24 + doc_id % 7 AS fps FROM documents) SELECT CASE WHEN w = 0 THEN CAST(doc_id AS VARCHAR) ELSE CAST(doc_id AS VARCHAR) || '_w' || lpad(CAST(w AS VARCHAR), 3, '0') END AS window_id, CAST(least(n - 1, w * span) AS INT) AS first, CAST(least(n - 1, w * span + CAST(round_even(120 * span / 121, 0) AS INT)) AS INT) AS last FROM (SELECT *, unnest(range(0, n // span)) AS w FROM d WHERE fps >= 24 AND n >= span)")
def spec_windows(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("clip_id"), (24 + F.col("doc_id") % 7).cast("double").alias("fps"), F.col("n_chars").cast("int").alias("num_frames"))
    w = split.source_windows(d, 5.0, 24.0, 121)
    return w.select("window_id", F.get("frames", F.lit(0)).alias("first"), F.element_at("frames", -1).alias("last"))


_PRIO = "CASE source WHEN 'src3' THEN 0 WHEN 'src1' THEN 1 WHEN 'src2' THEN 2 WHEN 'src0' THEN 3 ELSE 99 END"


def _keyed(spark, sf):
    return table(spark, sf, "documents").select(F.md5("text").alias("clip_id"), "source", "doc_id")


@query(f"SELECT clip_id, source, doc_id FROM (SELECT md5(text) AS clip_id, source, doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY {_PRIO}, source, doc_id) AS rn FROM documents WHERE source <> 'src5') WHERE rn = 1 UNION ALL SELECT md5(text), source, doc_id FROM documents WHERE source = 'src5'")
def dedup_priority(spark, sf):
    return dedup.first_wins(_keyed(spark, sf), order=ORDER, exempt=("src5",), then=("doc_id",))[0]


@query(f"WITH r AS (SELECT md5(text) AS clip_id, source, first_value(source) OVER w AS kept_source, row_number() OVER w AS rn FROM documents WHERE source <> 'src5' WINDOW w AS (PARTITION BY md5(text) ORDER BY {_PRIO}, source, doc_id)) SELECT clip_id, source AS dropped_source, kept_source FROM r WHERE rn > 1")
def dedup_collisions(spark, sf):
    return dedup.first_wins(_keyed(spark, sf), order=ORDER, exempt=("src5",), then=("doc_id",))[1]


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT item_id FROM benchmark)")
def exclusion_anti(spark, sf):
    return dedup.drop_listed(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id")), ("doc_id",))


@query("SELECT l_orderkey, array_to_string(list_sort(list_filter(['A', 'N', 'R'], lambda x: NOT list_contains(h, x))), ',') AS missing, len(h) = 3 AS complete FROM (SELECT l_orderkey, array_agg(DISTINCT l_returnflag) AS h FROM lineitem GROUP BY 1)")
def payload_complete(spark, sf):
    d = dedup.complete_payload(table(spark, sf, "lineitem"), ("A", "N", "R"), ("l_orderkey",), "l_returnflag")
    return d.select("l_orderkey", F.array_join("missing", ",").alias("missing"), "complete")


@query("SELECT regexp_replace(p_type, '[^A-Za-z0-9_-]', '_', 'g') AS key, count(DISTINCT name) AS ids FROM (SELECT p_type, p_type || p_brand AS name FROM part) GROUP BY 1 HAVING count(DISTINCT name) > 1")
def colliding_keys(spark, sf):
    d = table(spark, sf, "part").select(F.concat("p_type", "p_brand").alias("name"), hashing.shard_key(F.col("p_type")).alias("key"))
    return dedup.colliding_keys(d, "name", "key")


@query("SELECT c_custkey AS id, 'left' AS side FROM (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0 EXCEPT SELECT o_custkey FROM orders WHERE o_custkey % 11 <> 0) UNION ALL SELECT o_custkey, 'right' FROM (SELECT o_custkey FROM orders WHERE o_custkey % 11 <> 0 EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)")
def member_difference(spark, sf):
    left, right = table(spark, sf, "customer").select(F.col("c_custkey").alias("id")), table(spark, sf, "orders").select(F.col("o_custkey").alias("id")).distinct()
    return dedup.set_difference(left.where("id % 7 <> 0"), right.where("id % 11 <> 0"))


@query("WITH v AS (SELECT l_returnflag, list_sort(array_agg(l_extendedprice)) AS p, list_sort(array_agg(l_quantity)) AS q FROM lineitem GROUP BY 1) SELECT l_returnflag, p[1 + least(len(p) - 1, CAST(floor(0.02 * len(p)) AS BIGINT))] AS l_extendedprice_p2, p[1 + least(len(p) - 1, CAST(floor(0.75 * len(p)) AS BIGINT))] AS l_extendedprice_p75, q[1 + least(len(q) - 1, CAST(floor(0.9 * len(q)) AS BIGINT))] AS l_quantity_p90 FROM v")
def calibration_percentiles(spark, sf):
    return calibrate.nearest_ranks(table(spark, sf, "lineitem"), "l_returnflag", {"l_extendedprice": [2, 75], "l_quantity": [90]})


@query(CLIPS_SQL + "SELECT source, count(*) AS n, count(*) FILTER (list_contains(flags, 'blurry')) / count(*) AS rate_blurry, count(*) FILTER (list_contains(flags, 'watermark')) / count(*) AS rate_watermark FROM c GROUP BY 1")
def calibration_flag_rates(spark, sf):
    return calibrate.flag_rates(clips(spark, sf).select("source", F.col("metrics.vlm_reject_flags").alias("f")), "source", "f", ["blurry", "watermark"])


@query("WITH v AS (SELECT o_orderpriority AS source, list_sort(array_agg(o_totalprice)) AS p FROM orders GROUP BY 1), m AS (SELECT source, p, len(p) AS n FROM v), a AS (SELECT source, p[1 + least(n - 1, CAST(floor(0.05 * n) AS BIGINT))] AS lo, p[1 + least(n - 1, CAST(floor(0.75 * n) AS BIGINT))] AS hi, p[1 + least(n - 1, CAST(floor(0.9 * n) AS BIGINT))] AS top FROM m) SELECT source, lo AS unimatch_lo, hi AS unimatch_hi, top AS vmaf_hi FROM a")
def calibrated_policy(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("source"), F.col("o_totalprice").alias("flow"), F.col("o_totalprice").alias("vmaf"), F.col("o_totalprice").alias("sat"), F.col("o_totalprice").alias("dover"))
    m = calibrate.nearest_ranks(o, "source", {"flow": [2, 5, 75, 90], "dover": [25, 50], "vmaf": [90, 97], "sat": [90, 97]})
    p = calibrate.policy_rows(m, elite=True)
    return p.select("source", p["unimatch"][0].alias("unimatch_lo"), p["unimatch"][1].alias("unimatch_hi"), p["vmaf"][1].alias("vmaf_hi"))


@query("WITH r AS (SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS i, greatest(1, count(*) OVER (PARTITION BY o_orderstatus) // 50) AS step FROM orders) SELECT o_orderstatus, o_orderkey FROM r WHERE i % step = 0 AND i / step < 50")
def systematic_sample(spark, sf):
    return calibrate.systematic_sample(table(spark, sf, "orders").select("o_orderstatus", "o_orderkey"), "o_orderstatus", "o_orderkey", 50)


@query("""WITH f AS (SELECT user_id, event_id, value AS x, CAST(event_id % 17 AS DOUBLE) AS y FROM events),
s AS (SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS step FROM f WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
g AS (SELECT user_id, count(*) AS n, sum(step) AS path, median(step) AS vel_med, quantile_cont(step, 0.95) AS vel_p95, max(step) AS max_seg, sqrt((arg_max(x, event_id) - arg_min(x, event_id)) ** 2 + (arg_max(y, event_id) - arg_min(y, event_id)) ** 2) AS disp, sqrt((max(x) - min(x)) ** 2 + (max(y) - min(y)) ** 2) AS diag FROM s GROUP BY 1)
SELECT user_id, n, n >= 2 AS ok, round(path, 4) AS path, round(disp, 6) AS disp, round(diag, 6) AS diag, round(path / diag, 4) AS tort, round(disp / path, 6) AS straight, round(vel_med, 6) AS vel_med, round(vel_p95, 6) AS vel_p95, round(max_seg, 6) AS max_seg FROM g""")
def traj_stats_frames(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", F.col("value").alias("x"), (F.col("event_id") % 17).cast("double").alias("y"))
    d = trajectory.frame_stats(e, "user_id", "event_id", ("x", "y"))
    return d.select("user_id", "n", "ok", *[F.round(c, 4 if c in ("path", "tort") else 6).alias(c) for c in ("path", "disp", "diag", "tort", "straight", "vel_med", "vel_p95", "max_seg")])


def _poses(spark, sf):
    v = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf, "embeddings").select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.slice(v, i * 16 + 1, 16)).alias("poses"))


def _c(k, f):
    return f"CAST(embedding[{16 * f + k + 1}] AS DOUBLE)"


_SEG = [f"sqrt(({_c(3, f + 1)} - {_c(3, f)}) ** 2 + ({_c(7, f + 1)} - {_c(7, f)}) ** 2 + ({_c(11, f + 1)} - {_c(11, f)}) ** 2)" for f in range(3)]


@query(f"SELECT vec_id, true AS ok, round({' + '.join(_SEG)}, 6) AS path, round(list_median([{', '.join(_SEG)}]), 6) AS vel_med, round(greatest({', '.join(_SEG)}), 6) AS max_seg, round(sqrt(({_c(3, 3)} - {_c(3, 0)}) ** 2 + ({_c(7, 3)} - {_c(7, 0)}) ** 2 + ({_c(11, 3)} - {_c(11, 0)}) ** 2), 6) AS disp FROM embeddings")
def traj_stats_arrays(spark, sf):
    d = trajectory.pose_stats(_poses(spark, sf), keep=("vec_id",))
    return d.select("vec_id", "ok", *[F.round(c, 6).alias(c) for c in ("path", "vel_med", "max_seg", "disp")])


@query("WITH b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = lag(l_linenumber) OVER w + 1 THEN 0 ELSE 1 END AS new FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)), i AS (SELECT *, sum(new) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS island FROM b) SELECT l_orderkey, CAST(island AS BIGINT) AS island, min(l_linenumber) AS s, max(l_linenumber) AS e, count(*) AS parts FROM i GROUP BY 1, 2")
def gaps_islands(spark, sf):
    d = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("s"), F.col("l_linenumber").alias("e")).distinct()
    return trajectory.islands(d, "l_orderkey", "s", "e")


_MODE = "CASE WHEN i % 2 = 0 THEN 'gt_pose' ELSE 'default' END"


@query(
    CLIPS_SQL
    + """SELECT clip_id, CASE WHEN dover_tech IS NULL OR dover_aes IS NULL THEN 'dover_missing' WHEN (dover_tech + dover_aes) / 2 < CASE WHEN i % 2 = 0 THEN 0.25 ELSE 0.5 END THEN 'dover_low' WHEN unimatch < 5 THEN 'frozen_img' WHEN i % 2 <> 0 AND CAST(doc_id % 20 AS DOUBLE) / 100 >= 0.10 THEN 'scale_cov' ELSE 'ok' END AS quality,
CASE WHEN num_frames < 81 THEN 'short' WHEN fd < 0.1 AND unimatch / 10 < CASE WHEN i % 2 = 0 THEN 1.0 ELSE 0.5 END THEN 'static_cam' WHEN unimatch / 10 > 0 AND (saturation / 50) / (unimatch / 10) > 0.5 THEN 'jump_cut' WHEN fd > 3 THEN 'too_fast' WHEN fx > 25 THEN 'rot_cut' ELSE 'ok' END AS motion FROM c"""
)
def dynamic_select(spark, sf):
    c = clips(spark, sf)
    i = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    d = c.select("clip_id", F.when(i % 2 == 0, "gt_pose").otherwise("default").alias("mode"), "metrics.dover_tech", "metrics.dover_aes", "metrics.unimatch", "camera.scale_cov", F.col("num_frames").alias("n_frames"), F.col("camera.focal_div").alias("ang_med"), F.col("camera.fov_x").alias("ang_max"), (F.col("metrics.unimatch") / 10).alias("span_m"), (F.col("metrics.saturation") / 50).alias("max_seg"))
    return d.select("clip_id", select.quality_verdict(F.col("mode")).alias("quality"), select.motion_verdict(F.col("mode")).alias("motion"))


def _listed(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


@query(f"WITH f AS (SELECT conv_id, turn, trim(regexp_replace(lower(coalesce(text, '')), '\\s+', ' ', 'g')) AS t FROM conversations) SELECT conv_id, turn, CASE WHEN len(list_filter({_listed(text.INDOOR)}, lambda w: contains(t, w))) > 0 THEN 'indoor' WHEN len(list_filter({_listed(text.OUTDOOR)}, lambda w: contains(t, w))) >= 2 THEN 'outdoor' ELSE 'unclear' END AS verdict FROM f")
def outdoor_classify(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", text.outdoor_class(F.col("text")).alias("verdict"))


@query(CLIPS_SQL + "SELECT clip_id, source FROM c ORDER BY len(flags), coalesce(q, 0) DESC, cuts, source, clip_id LIMIT 100")
def best_first_topk(spark, sf):
    d = clips(spark, sf).select("clip_id", "source", F.col("metrics.vlm_reject_flags").alias("flags"), F.col("metrics.vlm_quality").alias("quality"), F.col("metrics.vlm_scene_transition.count").alias("cuts"))
    return select.best_first(d, 100).select("clip_id", "source")


@query("SELECT conv_id, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations WHERE role = 'assistant') WHERE rn = 1")
def first_accepted_attempt(spark, sf):
    return select.first_accepted(table(spark, sf, "conversations").dropDuplicates(["conv_id", "turn"]), "conv_id", "turn", F.col("role") == "assistant").select("conv_id", "turn", "text")


@query("SELECT c_custkey AS item FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_custkey NOT IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 15)")
def pending_items(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("item"), "o_orderstatus")
    return select.pending(table(spark, sf, "customer").select(F.col("c_custkey").alias("item")), o.where("o_orderstatus = 'F'").select("item"), o.limit(0).select("item"), o, 15)


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 7")
def per_source_cap(spark, sf):
    return select.per_source_cap(table(spark, sf, "documents").select("doc_id", "source"), 7, order=("doc_id",))


@query("SELECT doc_id, CAST(CAST('0x' || md5(CAST(doc_id AS VARCHAR)) AS UHUGEINT) % 37 AS INT) AS shard, substr(sha1(CAST(doc_id AS VARCHAR)), 1, 16) AS item_hash, CAST(CAST('0x' || substr(sha1(CAST(doc_id AS VARCHAR)), 1, 8) AS UBIGINT) AS BIGINT) AS seed FROM documents".replace("CAST('0x' || md5(CAST(doc_id AS VARCHAR)) AS UHUGEINT) % 37", "((CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 16) AS UBIGINT) % 37) * (18446744073709551616::UHUGEINT % 37) + CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 17, 16) AS UBIGINT) % 37) % 37"))
def stable_hashes(spark, sf):
    return table(spark, sf, "documents").select("doc_id", hashing.md5_shard(F.col("doc_id"), 37).alias("shard"), hashing.item_hash(F.col("doc_id")).alias("item_hash"), hashing.seed_integer(F.col("doc_id")).alias("seed"))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)*')) AS INT) AS words, CASE WHEN trim(coalesce(text, ''), E' \t\n\r\f\v') = '' THEN 0 ELSE CAST(len(regexp_split_to_array(trim(coalesce(text, ''), E' \t\n\r\f\v'), '\s+')) AS INT) END AS blanks FROM documents")
def caption_word_count(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.word_count(F.col("text")).alias("words"), text.blank_separated_count(F.col("text")).alias("blanks"))


_MOTION_SQL = "|".join(p.replace("'", "''") for p in text.CAMERA_MOTION)


@query(r"SELECT conv_id, turn, trim(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, '') || tail, '(?i)" + _MOTION_SQL + r"', '', 'g'), '\s{2,}', ' ', 'g'), '\s+([,.;])', '\1', 'g'), '([,;]\s*){2,}', ', ', 'g'), ' ,;.'), E' \t\n\r\f\v') AS stripped FROM (SELECT *, (['', ' The camera pans left, zooming in.', ' A tracking shot ; handheld.'])[conv_id % 3 + 1] AS tail FROM conversations)")
def caption_strip(spark, sf):
    """Every whole text, two thirds of them with camera wording at their end, stripped of it."""
    tail = F.get(F.array(*map(F.lit, ("", " The camera pans left, zooming in.", " A tracking shot ; handheld."))), (F.col("conv_id") % 3).cast("int"))
    return table(spark, sf, "conversations").select("conv_id", "turn", text.strip_camera_motion(F.concat(F.coalesce("text", F.lit("")), tail)).alias("stripped"))


@query("""WITH RECURSIVE o AS (SELECT source, doc_id, n_chars AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents),
p AS (SELECT source, doc_id, s, r, s AS used, 0 AS shard FROM o WHERE r = 1 UNION ALL
SELECT o.source, o.doc_id, o.s, o.r, CASE WHEN p.used + o.s > 20000 THEN o.s ELSE p.used + o.s END, CASE WHEN p.used + o.s > 20000 THEN p.shard + 1 ELSE p.shard END FROM p JOIN o ON o.source = p.source AND o.r = p.r + 1)
SELECT source, doc_id, shard FROM p""")
def pack_plan(spark, sf):
    d = table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    return packing.plan_shards(d, 20_000, "source", "doc_id", "n_chars").select("source", "doc_id", "shard")


@query("SELECT source, doc_id, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 200 AS INT) AS group_id FROM documents")
def archive_groups(spark, sf):
    return packing.archive_groups(table(spark, sf, "documents").select("source", "doc_id"), 200, "source", "doc_id")


@query(JUDGED_SQL + "SELECT clip_id, CASE WHEN kept_tier IS NULL THEN 'rejected' ELSE 'kept-' || kept_tier END AS part FROM j")
def tier_partitions(spark, sf):
    return _judged(spark, sf).select("clip_id", packing.partition_of(F.col("kept_tier"), F.lit(True)).alias("part"))


@query("WITH p AS (SELECT DISTINCT o_orderstatus AS source, l_orderkey AS item, l_partkey AS clip FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R') SELECT source, item, array_to_string(list_sort(array_agg(clip)), ',') AS clips FROM p GROUP BY 1, 2")
def recipe_export(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderstatus").alias("source"), F.col("l_orderkey").alias("item"), F.concat_ws("/", "l_orderkey", "l_partkey").alias("clip_id"), "l_returnflag")
    got = lineage.export_pointers(li.where("l_returnflag = 'R'"), li)[0]
    ids = F.array_sort(F.transform("kept_clips", lambda c: F.split(c, "/")[1].cast("long")))
    return got.select("source", "item", F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").alias("clips"))


@query(CLIPS_SQL + "SELECT clip_id, CASE WHEN num_frames >= 160 THEN 0 WHEN num_frames >= 81 THEN (num_frames - 81) // 2 END AS start, CASE WHEN num_frames >= 160 THEN 160 WHEN num_frames >= 81 THEN 81 END AS frames FROM c")
def slice_plans(spark, sf):
    p = specs.slice_plan(F.col("num_frames"))
    return clips(spark, sf).select("clip_id", p["start"].alias("start"), p["frames"].alias("frames"))


@query("SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'recipe_lineage_not_in_a_kept_source' ELSE '' END AS reasons FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') ON c_custkey = o_custkey")
def lineage_check(spark, sf):
    kept = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("clip_id"))
    return lineage.kept_source_reasons(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), kept, "a", "o_custkey").select("o_orderkey", F.array_join(codes("lineage_reasons"), "|").alias("reasons"))


@query("SELECT o_orderkey, array_to_string(list_filter([CASE WHEN abs(f - 16) > 0.01 THEN 'fps' END, CASE WHEN w < 720 THEN 'not_landscape' END, CASE WHEN w < 1280 THEN 'too_small' END, CASE WHEN n < 81 THEN 'too_short' END, CASE WHEN n <> p THEN 'poses' END], lambda x: x IS NOT NULL), '|') AS reasons FROM (SELECT o_orderkey, CAST(15 + o_orderkey % 3 AS DOUBLE) AS f, 600 + o_custkey % 1000 AS w, o_orderkey % 200 AS n, o_custkey % 200 AS p FROM orders)")
def source_contract(spark, sf):
    d = table(spark, sf, "orders").select("o_orderkey", (15 + F.col("o_orderkey") % 3).cast("double").alias("fps"), (600 + F.col("o_custkey") % 1000).alias("width"), F.lit(720).alias("height"), (F.col("o_orderkey") % 200).alias("num_frames"), (F.col("o_custkey") % 200).alias("pose_frames"), (F.col("o_orderkey") % 200).alias("intr_frames"))
    return d.select("o_orderkey", F.array_join(codes(lineage.source_reasons()), "|").alias("reasons"))


@query("SELECT vec_id, round(list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), lambda e, x: 0.9 * e + (1.0 - 0.9) * x), 9) AS ema, round(list_stddev_pop(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) / abs(list_avg(list_transform(embedding, lambda x: CAST(x AS DOUBLE)))), 5) AS cov FROM embeddings")
def ema_fold(spark, sf):
    v = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf, "embeddings").select("vec_id", F.round(F.element_at(arrays.ema(v, 0.9), -1), 9).alias("ema"), F.round(arrays.scale_cov_abs(v), 5).alias("cov"))


@query("SELECT part_id, round(k0 + (k1 - k0) * 0.5, 6) AS mid, k1 AS at_key, 5 AS n FROM (SELECT p_partkey AS part_id, p_retailprice AS k0, CAST(p_size AS DOUBLE) AS k1 FROM part)")
def keyframe_interp(spark, sf):
    full = arrays.interpolate(F.array("p_retailprice", F.col("p_size").cast("double"), F.lit(7.0)), F.lit(5))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("part_id"), full.alias("a")).select("part_id", F.round(F.get("a", F.lit(1)), 6).alias("mid"), F.get("a", F.lit(2)).alias("at_key"), F.size("a").alias("n"))


@query("SELECT doc_id, CASE WHEN m = 1 THEN '0' ELSE array_to_string(list_transform(range(0, m), lambda i: CAST(round_even(i * (n - 1) / (m - 1), 0) AS INT)), ',') END AS picks FROM (SELECT doc_id, n_chars AS n, greatest(1, least(8, n_chars)) AS m FROM documents)")
def even_indices(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(F.transform(arrays.even_indices(F.col("n_chars"), 8), lambda i: i.cast("string")), ",").alias("picks"))


@query("""WITH r AS (SELECT l_suppkey, l_extendedprice / l_quantity AS r, ln(l_extendedprice / l_quantity) AS l FROM lineitem), m AS (SELECT l_suppkey, median(l) AS mid, count(*) AS n FROM r GROUP BY 1),
d AS (SELECT r.l_suppkey, r.r, abs(l - mid) AS dev, n FROM r JOIN m ON r.l_suppkey = m.l_suppkey), q AS (SELECT l_suppkey, median(dev) AS mad FROM d GROUP BY 1)
SELECT d.l_suppkey, CASE WHEN max(n) >= 3 THEN round(avg(r) FILTER (dev <= greatest(1e-6, 1.0 * 1.4826 * mad)), 5) END AS scale, max(n) AS valid, count(*) FILTER (dev <= greatest(1e-6, 1.0 * 1.4826 * mad)) AS inliers FROM d JOIN q ON q.l_suppkey = d.l_suppkey GROUP BY 1""")
def mad_scale(spark, sf):
    r = table(spark, sf, "lineitem").select("l_suppkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("ratio"))
    return robust.mad_scale(r, "l_suppkey", sigmas=1.0).select("l_suppkey", F.round("scale", 5).alias("scale"), "valid", "inliers")


@query("SELECT l_orderkey, round(sum(1 / (l_extendedprice + 1e-8) * l_quantity * l_extendedprice) / (sum(1 / (l_extendedprice + 1e-8) * l_quantity * l_quantity) + 1e-8), 5) AS ratio FROM lineitem GROUP BY 1")
def frame_ratios(spark, sf):
    return robust.frame_ratios(table(spark, sf, "lineitem"), ("l_orderkey",), "l_quantity", "l_extendedprice").select("l_orderkey", F.round("ratio", 5).alias("ratio"))


@query("WITH r AS (SELECT l_returnflag, s, median(abs(s * l_quantity - l_extendedprice / 1000) / (l_extendedprice / 1000)) AS residual FROM lineitem, (SELECT unnest([0.5, 1.0, 1.5, 2.0]) AS s) GROUP BY 1, 2) SELECT l_returnflag, CAST(arg_min(s, residual) AS DOUBLE) AS scale, round(min(residual), 6) AS residual FROM r GROUP BY 1")
def scale_sweep(spark, sf):
    d = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", (F.col("l_extendedprice") / 1000).alias("far"))
    return robust.best_scale(d, "l_returnflag", "l_quantity", "far", [0.5, 1.0, 1.5, 2.0]).select("l_returnflag", "scale", F.round("residual", 6).alias("residual"))


@query("SELECT user_id, CASE WHEN count(*) >= 3 AND greatest(max(value) - min(value), max(event_id % 13) - min(event_id % 13), max(event_id % 7) - min(event_id % 7)) > 1e-12 THEN 2.5 END AS scale, CAST(count(*) AS INT) AS points FROM events GROUP BY 1")
def umeyama_scale(spark, sf):
    """The scale of tracks against turned, moved and 2.5 times larger copies of themselves."""
    e = table(spark, sf, "events").select("user_id", F.col("value").alias("sx"), (F.col("event_id") % 13).cast("double").alias("sy"), (F.col("event_id") % 7).cast("double").alias("sz"))
    p = e.select("user_id", "sx", "sy", "sz", (2.5 * F.col("sy") + 1).alias("dx"), (-2.5 * F.col("sx")).alias("dy"), (2.5 * F.col("sz")).alias("dz"))
    return robust.scale_by_clip(p, "user_id").select("user_id", F.round("scale", 6).alias("scale"), "points")


@query("SELECT doc_id, round(degrees(2 * atan(1280 / (2 * f))), 6) AS fov, round(abs(f - g) / ((f + g) / 2 + 1e-8), 9) AS divergence FROM (SELECT doc_id, CAST(500 + doc_id % 900 AS DOUBLE) AS f, CAST(500 + doc_id % 700 AS DOUBLE) AS g FROM documents)")
def camera_scalars(spark, sf):
    f, g = (500 + F.col("doc_id") % 900).cast("double"), (500 + F.col("doc_id") % 700).cast("double")
    return table(spark, sf, "documents").select("doc_id", F.round(geometry.fov_degrees(F.lit(1280.0), f), 6).alias("fov"), F.round(geometry.focal_divergence(f, g), 9).alias("divergence"))


@query(JUDGED_SQL + """, k AS (SELECT md5(caption) AS clip_id, doc_id, source, kept_tier FROM j WHERE kept_tier IS NOT NULL AND doc_id NOT IN (SELECT item_id FROM benchmark))
SELECT clip_id, source, kept_tier, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY CASE source WHEN 'src3' THEN 0 WHEN 'src1' THEN 1 WHEN 'src2' THEN 2 WHEN 'src0' THEN 3 ELSE 99 END, source, doc_id) AS rn FROM k) WHERE rn = 1""")
def assembled_train_list(spark, sf):
    d = _judged(spark, sf).where("kept_tier IS NOT NULL")
    d = dedup.drop_listed(d, table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id")), ("doc_id",))
    d = d.select(F.md5("caption").alias("clip_id"), "source", "kept_tier", "doc_id")
    return dedup.first_wins(d, order=ORDER, then=("doc_id",))[0]


@query("SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS n FROM events GROUP BY 1")
def stream_counts(spark, sf):
    """The events as a file stream, counted in micro-batches; each batch is its own folder, so a repeat overwrites."""
    import uuid

    home = f"{scratch(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, sf, "events").schema
    s = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    ingest.run_once(ingest.unseen(s, "event_id"), ingest.batch_folder(f"{home}/rows"), f"{home}/state").awaitTermination()
    return spark.read.parquet(f"{home}/rows").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("n"))


@query("SELECT l_suppkey, round(1000 * regr_slope(1 / l_extendedprice, 1 / l_quantity), 6) AS slope, round(1e6 * regr_intercept(1 / l_extendedprice, 1 / l_quantity), 4) AS intercept FROM lineitem GROUP BY 1")
def disparity_fit(spark, sf):
    d = validate.disparity_fit(table(spark, sf, "lineitem"), "l_suppkey", "l_extendedprice", "l_quantity")
    return d.select("l_suppkey", F.round(1000 * F.col("slope"), 6).alias("slope"), F.round(1e6 * F.col("intercept"), 4).alias("intercept"))


@query("SELECT l_returnflag, decile, count(*) AS n, round(median(l_quantity / l_extendedprice), 10) AS ratio FROM (SELECT *, CAST(ntile(10) OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice, l_quantity) AS INT) AS decile FROM lineitem) GROUP BY 1, 2")
def decile_ratios(spark, sf):
    d = validate.decile_ratios(table(spark, sf, "lineitem"), "l_returnflag", "l_quantity", "l_extendedprice")
    return d.select("l_returnflag", "decile", "n", F.round("ratio", 10).alias("ratio"))


@query("SELECT o_custkey, array_to_string(list_sort(list_filter(['F', 'O', 'P'], lambda x: NOT list_contains(h, x))), ',') AS missing, len(h) = 3 AS complete FROM (SELECT o_custkey, array_agg(DISTINCT o_orderstatus) AS h FROM orders GROUP BY 1)")
def complete_groups(spark, sf):
    d = validate.complete_groups(table(spark, sf, "orders"), "o_custkey", "o_orderstatus", ["F", "O", "P"])
    return d.select("o_custkey", F.array_join("missing", ",").alias("missing"), "complete")


@query("SELECT conv_id, turn, arg_max(role, CAST(length(text) AS BIGINT) * 10 + CASE role WHEN 'user' THEN 1 ELSE 0 END) AS role FROM conversations GROUP BY 1, 2")
def last_split_wins(spark, sf):
    c = table(spark, sf, "conversations").withColumn("split", F.length("text").cast("long") * 10 + F.when(F.col("role") == "user", 1).otherwise(0))
    return validate.merge_split_frames(c, "conv_id", "split", "turn", "role").select("conv_id", "turn", "role")


@query("SELECT doc_id, CASE WHEN n_chars % 70000 <= 0 OR n_chars % 70000 >= 65535 THEN -1.0 ELSE round(2.0 / (1.0 / 100 + CAST(n_chars % 70000 AS DOUBLE) / 65535 * (1.0 / 0.5 - 1.0 / 100)), 9) END AS depth FROM documents")
def depth_decode(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(validate.decode_depth(F.col("n_chars") % 70000, 0.5, 100.0, 2.0), 9).alias("depth"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import more  # noqa: F401  adds its queries

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import more  # noqa: F401

    return dict(ORACLES)
