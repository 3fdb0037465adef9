"""Camera geometry on scalar columns and on poses stored as arrays of 16 numbers, row by row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fov_degrees(size: Column, focal: Column) -> Column:
    return F.degrees(2 * F.atan(size / (2 * focal)))


def focal_divergence(fx: Column, fy: Column) -> Column:
    return F.abs(fx - fy) / ((fx + fy) / 2 + 1e-8)


def unit_clip(x: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))


def rotation_angle(trace: Column) -> Column:
    """Degrees of the rotation with this trace."""
    return F.degrees(F.acos(unit_clip((trace - 1) / 2)))


def relative_trace(a: Column, b: Column) -> Column:
    """Trace of A'B of the rotation blocks of two poses: the sum of the nine products."""
    out = F.lit(0.0)
    for i in (0, 1, 2, 4, 5, 6, 8, 9, 10):
        out = out + a[i] * b[i]
    return out


def quaternion_matrix(w: Column, x: Column, y: Column, z: Column) -> Column:
    """Nine entries of the rotation of a quaternion; a zero quaternion is the identity's scale of one."""
    n = F.sqrt(w * w + x * x + y * y + z * z)
    n = F.when(n == 0, F.lit(1.0)).otherwise(n)
    w, x, y, z = (v / n for v in (w, x, y, z))
    return F.array(1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w), 2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y))


def invert_rigid(r: Column, t: Column, scale: Column | None = None) -> Column:
    """16 numbers of the inverse of [R|t], its translation times ``scale``."""
    s = F.lit(1.0) if scale is None else scale
    back = [-(r[j] * t[0] + r[j + 3] * t[1] + r[j + 6] * t[2]) * s for j in range(3)]
    rows = [v for j in range(3) for v in (r[j], r[j + 3], r[j + 6], back[j])]
    return F.array(*rows, F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))


def intrinsics_from_mm(focal_mm: Column, width: Column, sensor_mm: float = 23.76) -> Column:
    return focal_mm / sensor_mm * width


def intrinsic_rows(shape: Column, data: Column) -> Column:
    """Rows (fx, fy, cx, cy) of a flattened array of shape (4), (k, 4), (3, 3) or (k, 3, 3); null for any other shape."""
    is_ = lambda *dims: (F.size(shape) == len(dims)) & F.lit(True) & _all([shape[i] == d for i, d in enumerate(dims) if d])
    row = lambda places, width: lambda k: F.array(*[F.get(data, (k * width + p).cast("int")) for p in places])
    many = lambda n, f: F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), f)).otherwise(F.array().cast("array<array<double>>"))
    plain, matrix = row((0, 1, 2, 3), 4), row((0, 4, 2, 5), 9)
    return F.when(is_(4), many(F.lit(1), plain)).when(is_(3, 3), many(F.lit(1), matrix)).when(is_(None, 4), many(shape[0], plain)).when(is_(None, 3, 3), many(shape[0], matrix))


def _all(tests: list[Column]) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & F.coalesce(t, F.lit(False))
    return out


def matrix_of_text(text: Column) -> Column:
    """16 numbers of a pose whose text gives its columns, one bracket each; null unless there are 16."""
    v = F.transform(F.regexp_extract_all(text, F.lit(r"[^\[\]\s]+"), 0), lambda x: x.try_cast("double"))
    return F.when((F.size(v) == 16) & F.forall(v, lambda x: x.isNotNull()), F.array(*[F.get(v, F.lit(4 * (i % 4) + i // 4)) for i in range(16)]))


def quaternion_of(m: Column) -> list[Column]:
    """(w, x, y, z) of the rotation block of a pose of 16 numbers that turns by less than 180 degrees."""
    w = F.sqrt(F.greatest(F.lit(0.0), 1 + m[0] + m[5] + m[10])) / 2
    w = F.when(w == 0, F.lit(1e-12)).otherwise(w)
    return [w, (m[9] - m[6]) / (4 * w), (m[2] - m[8]) / (4 * w), (m[4] - m[1]) / (4 * w)]


def blend_poses(a: Column, b: Column, t: Column) -> Column:
    """The pose at ``t`` of the way from ``a`` to ``b``: translation on the line, rotation on the arc between them."""

    def blended(p: Column) -> Column:
        q, r = quaternion_of(p[0]), quaternion_of(p[1])
        return F.struct(F.array(*q).alias("q"), F.array(*r).alias("r"))

    def along(s: Column) -> Column:
        dot = sum((s["q"][i] * s["r"][i] for i in range(1, 4)), s["q"][0] * s["r"][0])
        sign = F.when(dot < 0, -1.0).otherwise(1.0)
        angle = F.acos(unit_clip(F.abs(dot)))
        near = angle < 1e-6
        u = F.when(near, 1 - t).otherwise(F.sin((1 - t) * angle) / F.sin(angle))
        v = F.when(near, t).otherwise(F.sin(t * angle) / F.sin(angle)) * sign
        return F.array(*[u * s["q"][i] + v * s["r"][i] for i in range(4)])

    turned = F.transform(F.transform(F.transform(F.array(F.array(a, b)), blended), along), lambda q: quaternion_matrix(q[0], q[1], q[2], q[3]))[0]
    move = [(1 - t) * a[i] + t * b[i] for i in (3, 7, 11)]
    return F.transform(F.array(turned), lambda r: F.array(*[v for k in range(3) for v in (r[3 * k], r[3 * k + 1], r[3 * k + 2], move[k])], F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)))[0]
