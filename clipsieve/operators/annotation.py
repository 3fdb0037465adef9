"""Validation of annotation responses: the six-field contract, retries, and overlays on clip records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import CAMERA_MOTION, blank_separated_count, forbidden_wording, unfence, with_full_stop, word_count

# Closed vocabularies of the contract and its key sets.
REJECT_FLAGS = ("text_heavy", "watermark", "ui_overlay", "blurry", "near_static", "low_light", "nsfw", "single_color")
SCENE_TYPES = ("real_world", "rendered", "game", "animation", "mixed")
LABELS = ("none", "possible", "definite")
TOP_KEYS = ("dense_caption", "reject_flags", "scene_transition", "scene_type", "vlm_entity_density", "vlm_quality")
TRANSITION_KEYS = ("count", "evidence", "label", "timestamps_sec")
PERSPECTIVES = ("first_person", "third_person", "uncertain")
STYLES = ("photographic live action", "three-dimensional computer-generated imagery", "two-dimensional animation", "mixed or uncertain visual medium")
TEXT_LIMITS = {"visual_style": (1, 160), "scene_description": (1, 5000), "scene_dynamics": (0, 2000)}
PERSPECTIVE_KEYS = ("perspective_type", "scene_description", "scene_dynamics", "visual_style")
SCHEMA = "struct<vlm_entity_density:string,vlm_quality:string,reject_flags:array<string>,scene_type:string,scene_transition:struct<label:string,count:string,timestamps_sec:array<string>,evidence:string>,dense_caption:string>"


def _kind(v: Column, path: str) -> Column:
    """Type of a field of a VARIANT: OBJECT..., ARRAY..., STRING, BIGINT, DECIMAL..., BOOLEAN; null where absent."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _bound(value: Column, then) -> Column:
    """``then`` of a column that is computed once a row, however often it is used."""
    return F.transform(F.array(value), then)[0]


def _kinds(v: Column, at: str, names) -> Column:
    return F.struct(*[_kind(v, f"{at}.{k}").alias(k) for k in names])


def _read(raw: Column, then) -> Column:
    """``then`` of a struct of a JSON text, parsed once: v, typed, and the sorted keys of the whole (keys) and of its transition (tkeys)."""
    keys = lambda x: F.array_sort(F.json_object_keys(x))
    parsed = lambda js: F.struct(F.try_parse_json(js).alias("v"), F.from_json(js, SCHEMA).alias("typed"), keys(js).alias("keys"), keys(F.get_json_object(js, "$.scene_transition")).alias("tkeys"))
    return _bound(unfence(raw), lambda js: _bound(parsed(js), then))


def response_errors(raw: Column, duration: Column) -> Column:
    """Ordered error codes of a JSON text under the six-field contract; empty accepts. Nothing is repaired."""
    return _read(raw, lambda r: _response_errors(r, duration))


def _response_errors(r: Column, duration: Column) -> Column:
    stamps = F.transform(r["typed"]["scene_transition"]["timestamps_sec"], lambda x: x.try_cast("double"))
    names = F.struct(F.schema_of_variant(r["v"]).alias("whole"), _kinds(r["v"], "$", TOP_KEYS).alias("top"), _kinds(r["v"], "$.scene_transition", TRANSITION_KEYS).alias("tr"), stamps.alias("stamps"))
    return _bound(names, lambda k: F.when(~F.coalesce(k["whole"].startswith("OBJECT"), F.lit(False)), F.array(F.lit("not_object"))).otherwise(_object_errors(r, k, duration)))


def _object_errors(r: Column, k: Column, duration: Column) -> Column:
    typed, kinds, tkinds, stamps = r["typed"], k["top"], k["tr"], k["stamps"]
    whole = lambda t: F.coalesce(t == "BIGINT", F.lit(False))
    number = lambda t: F.coalesce((t == "BIGINT") | t.startswith("DECIMAL") | (t == "DOUBLE"), F.lit(False))
    text = lambda t: F.coalesce(t == "STRING", F.lit(False))
    is_list = lambda t: F.coalesce(t.startswith("ARRAY"), F.lit(False))
    tr = typed["scene_transition"]
    count, label, evidence = tr["count"].try_cast("int"), tr["label"], tr["evidence"]
    same = lambda x, names: F.coalesce(x == F.array(*map(F.lit, sorted(names))), F.lit(False))
    tr_ok = same(r["tkeys"], TRANSITION_KEYS)
    flags = typed["reject_flags"]
    words = word_count(typed["dense_caption"])
    stamps_ok = F.coalesce(is_list(tkinds["timestamps_sec"]) & F.forall(stamps, lambda x: x.isNotNull()), F.lit(False))
    in_order = F.coalesce((stamps == F.array_sort(stamps)) & F.forall(stamps, lambda x: (x >= 0) & (x <= duration + 1)), F.lit(False))
    none_ok = (count == 0) & (F.size(stamps) == 0) & (evidence == "")
    parts = [
        ("keys", ~same(r["keys"], TOP_KEYS)),
        ("density", ~(number(kinds["vlm_entity_density"]) & typed["vlm_entity_density"].try_cast("double").isin(1.0, 2.0, 3.0))),
        ("quality", ~(number(kinds["vlm_quality"]) & typed["vlm_quality"].try_cast("double").isin(1.0, 2.0, 3.0, 4.0, 5.0))),
        ("flags", ~(is_list(kinds["reject_flags"]) & F.coalesce((F.size(F.array_distinct(flags)) == F.size(flags)) & (F.size(F.array_except(flags, F.array(*map(F.lit, REJECT_FLAGS)))) == 0), F.lit(False)))),
        ("scene_type", ~F.coalesce(typed["scene_type"].isin(*SCENE_TYPES), F.lit(False))),
        ("transition", ~tr_ok),
        ("transition_label", tr_ok & ~F.coalesce(label.isin(*LABELS), F.lit(False))),
        ("transition_count", tr_ok & ~(whole(tkinds["count"]) & F.coalesce(count >= 0, F.lit(False)))),
        ("transition_stamps", tr_ok & ~stamps_ok),
        ("transition_order", tr_ok & stamps_ok & ~in_order),
        ("transition_mismatch", tr_ok & stamps_ok & whole(tkinds["count"]) & (F.size(stamps) != count)),
        ("transition_evidence", tr_ok & ~text(tkinds["evidence"])),
        ("transition_none", tr_ok & (label == "none") & ~F.coalesce(none_ok, F.lit(False))),
        ("transition_claim", tr_ok & label.isin("possible", "definite") & ~F.coalesce((count >= 1) & (evidence != ""), F.lit(False))),
        ("caption", ~text(kinds["dense_caption"])),
        ("caption_words", text(kinds["dense_caption"]) & ~words.between(60, 150)),
        ("caption_wording", text(kinds["dense_caption"]) & (F.size(forbidden_wording(F.coalesce(typed["dense_caption"], F.lit("")))) > 0)),
    ]
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in parts]), lambda n: n.isNotNull())


def first_violation(raw: Column, duration: Column) -> Column:
    """The raising variant: the first error code, counting words by white space; null accepts."""

    def found(r: Column) -> Column:
        few = F.when(~blank_separated_count(r["typed"]["dense_caption"]).between(60, 150), F.lit("caption_words"))
        return F.coalesce(F.get(F.filter(_response_errors(r, duration), lambda c: c != "caption_words"), F.lit(0)), few)

    return _read(raw, found)


def acceptable_envelope(finish: Column, prompt_tokens: Column, frames: Column) -> Column:
    """A finished response whose prompt has the tokens that all frames need."""
    return F.coalesce((finish == "stop") & (prompt_tokens >= F.greatest(F.lit(2000), 200 * frames)), F.lit(False))


def choice_text(raw: Column) -> Column:
    """The text of a response's first choice: its content if that is a string, else the texts of its text parts, joined. Null where
    there is no choice or its content is neither."""
    at = "$.choices[0].message.content"
    v = F.try_parse_json(raw)
    kind = _kind(v, at)
    parts = F.from_json(F.get_json_object(raw, at), "array<struct<type:string,text:string>>")
    texts = F.transform(F.filter(parts, lambda p: p["type"].isin("text", "output_text")), lambda p: F.coalesce(p["text"], F.lit("")))
    return F.when(kind == "STRING", F.try_variant_get(v, at, "string")).when(kind.startswith("ARRAY"), F.array_join(F.coalesce(texts, F.array().cast("array<string>")), ""))


def feedback(errors: Column, previous: Column, before: str, after: str) -> Column:
    """The messages (role, content) that ask for a rejected answer anew: the answer itself if there is one, then ``before``, the errors
    joined by semicolons, and ``after``. None without errors."""
    say = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    ask = say("user", F.concat(F.lit(before), F.array_join(errors, "; "), F.lit(after)))
    none = F.array().cast("array<struct<role:string,content:string>>")
    return F.when(F.size(errors) > 0, F.when(previous.isNotNull(), F.array(say("assistant", previous), ask)).otherwise(F.array(ask))).otherwise(none)


def fact_errors(raw: Column, guards: dict[str, str] | None = None) -> Column:
    """Ordered errors of the four-field contract: exact keys, the two enums, then for each text its type, length, outer
    white space and control characters, English letters, and the names of the guards (name to pattern) that it matches.
    Without ``guards``, wording of camera motion is the one guard."""
    js = unfence(raw)
    v = F.try_parse_json(js)
    guards = {"camera_motion": "|".join(CAMERA_MOTION)} if guards is None else guards
    get = lambda k: F.get_json_object(js, f"$.{k}")
    no = lambda c: ~F.coalesce(c, F.lit(False))
    parts = [
        ("not_object", no(F.schema_of_variant(v).startswith("OBJECT"))),
        ("keys", no(F.array_sort(F.json_object_keys(js)) == F.array(*map(F.lit, PERSPECTIVE_KEYS)))),
        ("perspective_type", no(get("perspective_type").isin(*PERSPECTIVES))),
        ("visual_style", no(get("visual_style").isin(*STYLES))),
    ]
    for field, (low, high) in TEXT_LIMITS.items():
        t, is_text = get(field), F.coalesce(_kind(v, f"$.{field}") == "STRING", F.lit(False))
        parts += [
            (f"{field}:type", ~is_text),
            (f"{field}:length", is_text & ~F.length(t).between(low, high)),
            (f"{field}:space", is_text & t.rlike(r"^\s|\s$|[\x00-\x1f\x7f]")),
            (f"{field}:letters", is_text & (t != "") & ~t.rlike("[A-Za-z]")),
        ]
        if field == "scene_dynamics":
            parts.append((f"{field}:empty_word", is_text & F.lower(t).isin("none", "n/a", "no motion", "no movement", "static")))
        parts += [(f"{field}:{name}", is_text & t.rlike(f"(?i){pattern}")) for name, pattern in guards.items()]
    found = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in parts]), lambda n: n.isNotNull())
    return F.when(F.array_contains(found, "not_object"), F.array(F.lit("not_object"))).otherwise(found)


def serialise_facts(style: Column, description: Column, dynamics: Column) -> Column:
    return F.concat_ws(" ", with_full_stop(style), with_full_stop(description), F.when(F.coalesce(F.trim(dynamics), F.lit("")) != "", with_full_stop(dynamics)))


def overlay(records: DataFrame, answers: DataFrame, key: str = "clip_id", fields=("vlm_entity_density", "vlm_quality", "vlm_reject_flags", "vlm_scene_type", "vlm_scene_transition"), archive: str = "static_scene_description") -> DataFrame:
    """Records with the five annotation metrics and the caption laid over, the old caption archived; records without an
    answer stay. Two answers for one key raise. Both sides carry their provenance as sha256."""
    one = answers.groupBy(key).agg(F.count("*").alias("__n"), F.first(F.struct("caption", *fields)).alias("__a"))
    one = one.withColumn("__a", F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("two answers for "), F.col(key).cast("string"))).cast(one.schema["__a"].dataType)).otherwise(F.col("__a"))).drop("__n")
    j = records.join(one, key, "left")
    got = F.col("__a").isNotNull()
    metrics = F.col("metrics")
    for f in fields:
        metrics = metrics.withField(f, F.when(got, F.col(f"__a.{f}")).otherwise(F.col(f"metrics.{f}")))
    return j.withColumns({"metrics": metrics, archive: F.when(got, F.col("caption")), "caption": F.when(got, F.col("__a.caption")).otherwise(F.col("caption")), "caption_sha256": F.sha2(F.when(got, F.col("__a.caption")).otherwise(F.col("caption")), 256)}).drop("__a")
