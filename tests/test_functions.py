import math

import pytest
from pyspark.sql import functions as F

from clipsieve.functions import arrays, geometry, hashing, predicates, specs, text


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_gates_and_nan(spark):
    nan, null = F.lit(float("nan")), F.lit(None).cast("double")
    r = one(spark, predicates.range_fails(nan, F.lit(0.0), F.lit(5.0)), predicates.range_fails(null, F.lit(0.0), F.lit(5.0)), predicates.range_fails(nan, null, null), predicates.range_fails(F.lit(5.0), F.lit(0.0), F.lit(5.0)), predicates.over_fails(null, F.lit(1)), predicates.over_fails(F.lit(1), F.lit(1)))
    assert list(r) == [True, True, False, False, True, False]


def test_windows_and_indices(spark):
    from clipsieve.operators.split import windows

    r = one(spark, windows(F.lit(152), 153), windows(F.lit(306), 153), arrays.even_indices(F.lit(1), 8), arrays.even_indices(F.lit(10), 4), arrays.timed_indices(F.lit(100), F.lit(16.0), 0.5, 2.0), arrays.timed_indices(F.lit(5), F.lit(16.0), 0.5, 2.0), arrays.timestamps(F.lit(2.1)), arrays.timestamps(F.lit(0.0)))
    assert list(r) == [None, [0, 153], [0], [0, 3, 6, 9], [0, 8, 16, 24, 32], [0, 4], [0.0, 1.0, 2.0], [0.0]]


def test_cov_and_ranks(spark):
    empty = F.array().cast("array<double>")
    r = one(spark, arrays.scale_cov_eps(empty), arrays.scale_cov_abs(F.array(F.lit(1.0), F.lit(-1.0))), arrays.scale_cov_abs(F.array(F.lit(-1.0), F.lit(-3.0))), arrays.nearest_rank(F.array(F.lit(3.0), F.lit(1.0), F.lit(None), F.lit(2.0)), 50), arrays.nearest_rank(empty, 50), arrays.nearest_rank(F.array(F.lit(1.0), F.lit(2.0)), 100))
    assert r[0] == math.inf and r[1] == math.inf and r[2] == 0.5 and r[3] == 2.0 and r[4] is None and r[5] == 2.0


def test_ema(spark):
    nan = float("nan")
    r = one(spark, arrays.ema(F.array(F.lit(nan), F.lit(1.0), F.lit(nan), F.lit(3.0)), 0.5))[0]
    assert math.isnan(r[0]) and r[1:] == [1.0, 1.0, 2.0]


def test_hashes(spark):
    import hashlib

    r = one(spark, hashing.split_rank(F.lit("abc")), hashing.split_rank(F.lit(None).cast("string")), hashing.md5_shard(F.lit("x"), 37), hashing.shard_key(F.lit("a/b.c-d_e")), hashing.seeded(F.lit("a"), 1.0, 3.0, "s"))
    assert int(r[0], 16) == 13436514500253700074
    assert r[1] == hashlib.sha256(b"").hexdigest()[:16]
    assert r[2] == int(hashlib.md5(b"x").hexdigest(), 16) % 37
    assert r[3] == "a_b_c-d_e"
    assert r[4] == pytest.approx(1 + 2 * int(hashlib.sha1(b"a:s").hexdigest()[:8], 16) / 0xFFFFFFFF)


def test_text(spark):
    r = one(
        spark, text.word_count(F.lit("well-known men's  v2 x")), text.outdoor_class(F.lit("A street under the  SKY")), text.outdoor_class(F.lit("indoor street sky")), text.outdoor_class(F.lit(None).cast("string")),
        text.strip_camera_motion(F.lit("A wall. The camera pans left , then stops.")), text.unfence(F.lit('```json\n{"a": 1}\n```')), text.strip(F.lit("\t a \n")), text.has_camera_motion(F.lit("Panning over")),
    )
    assert r[0] == 4 and r[1] == "outdoor" and r[2] == "indoor" and r[3] == "unclear" and "camera" not in r[4] and " ," not in r[4]
    assert r[5] == '{"a": 1}' and r[6] == "a" and r[7]


def test_geometry(spark):
    m = lambda a: F.array(*[F.lit(float(v)) for v in a])
    turn = [0, -1, 0, 0, 1, 0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1]
    eye = [1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1]
    r = one(spark, geometry.rotation_angle(geometry.relative_trace(m(eye), m(turn))), geometry.quaternion_matrix(*[F.lit(v) for v in (0.0, 0.0, 0.0, 0.0)]), geometry.invert_rigid(m([0, -1, 0, 1, 0, 0, 0, 0, 1]), m([1, 2, 3])))
    assert r[0] == pytest.approx(90.0) and r[1] == [1, 0, 0, 0, 1, 0, 0, 0, 1] and r[2][3] == pytest.approx(-2.0)


def test_specs(spark, monkeypatch):
    assert specs.parse_spec("5s") == (121, 24) and specs.parse_spec("33@12") == (33, 12.0)
    with pytest.raises(ValueError):
        specs.parse_spec("7s")
    monkeypatch.setenv("HERE_IT_IS", "x")
    assert specs.expand({"a": ["${HERE_IT_IS}/b", "${NOT_SET_AT_ALL}"]}) == {"a": ["x/b", "${NOT_SET_AT_ALL}"]}
    r = one(spark, *[specs.slice_plan(F.lit(n)) for n in (80, 81, 152, 160)], specs.spec_of_frames(F.lit(81)), specs.on_spec(F.lit(None).cast("int")), specs.latent_aligned(F.lit(121)))
    assert r[0] is None and tuple(r[1]) == (0, 81) and tuple(r[2]) == (35, 81) and tuple(r[3]) == (0, 160)
    assert r[4] == "81f" and r[5] is False and r[6] is True
