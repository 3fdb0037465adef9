"""Readers of JSON-lines manifests, side-cars, listings and id lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import schemas


def decode(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Clip records from a column ``value`` of JSON lines. Blank lines are skipped; a malformed line raises if strict,
    else goes. Absent metrics, camera and lists become empty; mode defaults to default. Unknown top-level keys, and
    ``extra``, stay as raw JSON in extra, in which NaN survives; unknown nested keys are dropped. ``judged`` tells a
    null kept_tier from an absent one."""
    d = lines.select(F.col("value").alias("_line")).where(F.trim("_line") != "")
    # NaN is legal in the lines and not in JSON functions, so keys are read with it quoted
    keys = F.json_object_keys(F.regexp_replace("_line", r"(?<=[:\[,\s])(-?Infinity|NaN)(?=\s*[,\]}])", "null"))
    d = d.withColumn("_keys", keys)
    bad = F.col("_keys").isNull()
    d = d.where(~bad) if not strict else d.withColumn("_line", F.when(bad, F.raise_error(F.concat(F.lit("malformed line: "), F.substring("_line", 1, 80))).cast("string")).otherwise(F.col("_line")))
    d = d.withColumn("r", F.from_json("_line", schemas.CLIP, {"allowNonNumericNumbers": "true"}))
    raw = F.from_json("_line", "map<string,string>", {"allowNonNumericNumbers": "true"})
    other = F.map_filter(raw, lambda k, v: ~k.isin(*schemas.CLIP_FIELDS))
    empty = {"metrics": F.from_json(F.lit("{}"), schemas.METRICS), "camera": F.from_json(F.lit("{}"), schemas.CAMERA), "scale_factors": F.array().cast("array<double>"), "reject_reasons": F.array().cast("array<string>"), "mode": F.lit("default")}
    cols = [(F.coalesce(F.col(f"r.{c}"), empty[c]) if c in empty else F.col(f"r.{c}")).alias(c) for c in schemas.CLIP_FIELDS]
    return d.select(*cols, F.when(F.size(other) > 0, F.to_json(other)).alias("extra"), F.array_contains("_keys", "kept_tier").alias("judged"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return decode(spark.read.text(path))


def read_owners(spark: SparkSession, path: str) -> DataFrame:
    """One file an owner, named by it; blank and malformed lines are skipped."""
    d = spark.read.schema(schemas.OWNER).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    return d.where(F.col("_bad").isNull()).drop("_bad").withColumn("owner", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.jsonl?)?$", 1))


def first_lines(spark: SparkSession, path: str, limit: int) -> DataFrame:
    """The first ``limit`` parsed records of each file, in the order of the lines' places."""
    d = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("seq"))
    d = d.where(F.json_object_keys("value").isNotNull())
    w = Window.partitionBy("file").orderBy("at", "seq")
    return d.withColumn("n", F.row_number().over(w)).where(F.col("n") <= limit).select("file", "n", "value")


def numbered(spark: SparkSession, path: str, id_col: str = "sample_id") -> DataFrame:
    """Input rows of an annotation run with their line number; ids must be plain and unique, and there must be one."""
    text = spark.read.option("wholetext", True).text(path)
    d = text.select(F.posexplode(F.split("value", r"\r?\n")).alias("line", "value")).where(F.trim("value") != "")
    d = d.select((F.col("line") + 1).alias("line"), F.get_json_object("value", f"$.{id_col}").alias(id_col), "value")
    bad = d.where(~F.coalesce(F.col(id_col).rlike(r"^[A-Za-z0-9_.-]+$"), F.lit(False))).limit(1).collect()
    if bad:
        raise ValueError(f"line {bad[0]['line']}: bad {id_col}")
    twice = d.groupBy(id_col).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{id_col} {twice[0][0]} occurs more than once")
    if d.isEmpty():
        raise ValueError("no rows")
    return d


def side_cars(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(clip_id, response) from one JSON file a clip; unreadable ones have a null response."""
    d = spark.read.option("wholetext", True).text(path).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1).alias("clip_id"), "value")
    return d.select("clip_id", F.from_json(F.get_json_object("value", "$.response"), schema).alias("response"))


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """(list, clip_id): white-space separated ids; # begins a comment; the list is the file's name."""
    d = spark.read.text(path).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.txt)?$", 1).alias("list"), F.explode(F.split(F.regexp_replace("value", r"#.*$", ""), r"\s+")).alias("clip_id"))
    return d.where("clip_id <> ''").distinct()


def kept_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids from plain lines or JSON records: a null kept_tier is left out, an absent one counts. No id at all raises."""
    d = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> ''")
    keys = F.json_object_keys("v")
    null_tier = F.array_contains(keys, "kept_tier") & F.get_json_object("v", "$.kept_tier").isNull()
    ids = d.where(~F.coalesce(null_tier, F.lit(False))).select(F.when(keys.isNotNull(), F.get_json_object("v", "$.clip_id")).otherwise(F.col("v")).alias("clip_id")).where("clip_id IS NOT NULL").distinct()
    if ids.isEmpty():
        raise ValueError(f"no kept ids in {path}")
    return ids


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, clip_id, name) of all files below ``path``; contents are not read."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    parts = F.split("path", "/")
    return d.select("path", "length", "modificationTime", F.element_at(parts, -2).alias("clip_id"), F.element_at(parts, -1).alias("name"))


def clip_directories(spark: SparkSession, path: str, source: str) -> DataFrame:
    """One record a directory that holds a video: video.mp4, else the first other one by name."""
    d = listing(spark, path)
    has = lambda n: F.max(F.when(F.col("name") == n, F.col("path")))
    g = d.groupBy("clip_id").agg(F.coalesce(has("video.mp4"), F.min(F.when(F.col("name").endswith(".mp4"), F.col("path")))).alias("video_path"), has("poses.npy").alias("pose_path"), has("intrinsics.npy").alias("intrinsics_path"), has("prompt.txt").alias("prompt_path"))
    return g.where("video_path IS NOT NULL").withColumn("source", F.lit(source))


def pointers(spark: SparkSession, path: str, source: str) -> DataFrame:
    """(item, clip_id) of one source's recipe pointers; clip_id is null for whole items."""
    d = spark.read.schema("source string, item string, kept_clips array<string>").json(path).where(F.col("source") == source)
    return d.select("item", F.explode_outer("kept_clips").alias("clip_id")).distinct()


def video_stems(spark: SparkSession, path: str, column: str = "videoFile") -> DataFrame:
    d = spark.read.option("header", "true").csv(path)
    return d.select(F.regexp_replace(F.col(column), r"\.[^.]*$", "").alias("clip_id")).where("clip_id IS NOT NULL").distinct()


def camera_text(lines: DataFrame) -> DataFrame:
    """Poses of a COLMAP image list given as rows (file, n, value): (file, image_id, qw..qz, tx..tz, name), pose lines being
    those of ten fields or more."""
    f = F.split(F.trim("value"), r"\s+")
    d = lines.where(~F.trim("value").startswith("#") & (F.size(f) >= 10)).withColumn("f", f)
    num = lambda i: F.col("f")[i].try_cast("double")
    d = d.where(F.col("f")[0].rlike(r"^\d+$") & F.col("f")[9].rlike(r"[A-Za-z]"))
    return d.select("file", F.col("f")[0].cast("int").alias("image_id"), *[num(i + 1).alias(n) for i, n in enumerate(("qw", "qx", "qy", "qz", "tx", "ty", "tz"))], F.col("f")[9].alias("name"))


def npy_arrays(files: DataFrame) -> DataFrame:
    """(path, shape, data) of NumPy files given as (path, content), flattened to doubles; unreadable ones have null data."""
    import pandas as pd

    def load(batches):
        import io

        import numpy as np

        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    a = np.load(io.BytesIO(content), allow_pickle=False)
                    out.append((path, list(a.shape), a.astype(float).ravel().tolist()))
                except (ValueError, OSError, EOFError):
                    out.append((path, None, None))
            yield pd.DataFrame(out, columns=["path", "shape", "data"])

    return files.select("path", "content").mapInPandas(load, "path string, shape array<int>, data array<double>")


# Of each camera model of the binary format, how many numbers follow and where fx, fy, cx and cy are among them.
CAMERA_MODELS = {0: (3, (0, 0, 1, 2)), 1: (4, (0, 1, 2, 3)), 2: (4, (0, 0, 1, 2)), 3: (5, (0, 1, 2, 3)), 4: (8, (0, 1, 2, 3))}


def _records(files: DataFrame, read, schema: str, most: int = 10_000) -> DataFrame:
    """Rows that ``read`` makes of the bytes of each file (path, content), given on in frames of at most ``most`` rows, of many small files or of
    a part of a large one; a file cut short raises."""
    import itertools

    import pandas as pd

    names = ["path", *(c.strip().split(" ")[0] for c in schema.split(","))]

    def rows(batches):
        for pdf in batches:
            found = ((path, *r) for path, content in zip(pdf["path"], pdf["content"], strict=True) for r in read(content))
            while part := list(itertools.islice(found, most)):
                yield pd.DataFrame(part, columns=names)

    return files.select("path", "content").mapInPandas(rows, f"path string, {schema}")


def camera_binary(files: DataFrame) -> DataFrame:
    """(path, camera_id, fx, fy, cx, cy) of binary camera files given as (path, content)."""

    def read(data: bytes):
        import struct

        at = 8
        for _ in range(struct.unpack_from("<Q", data)[0]):
            ident, model = struct.unpack_from("<ii", data, at)
            many, where = CAMERA_MODELS.get(model, CAMERA_MODELS[1])
            numbers = struct.unpack_from(f"<{many}d", data, at + 24)
            at += 24 + 8 * many
            yield (ident, *(numbers[k] for k in where))

    return _records(files, read, "camera_id int, fx double, fy double, cx double, cy double")


def image_binary(files: DataFrame) -> DataFrame:
    """(path, name, qw, qx, qy, qz, tx, ty, tz, camera_id) of binary image files given as (path, content); their points are passed over."""

    def read(data: bytes):
        import struct

        at = 8
        for _ in range(struct.unpack_from("<Q", data)[0]):
            pose, camera = struct.unpack_from("<7d", data, at + 4), struct.unpack_from("<i", data, at + 60)[0]
            end = data.index(b"\0", at + 64)
            yield (data[at + 64 : end].decode(), *pose, camera)
            at = end + 9 + 24 * struct.unpack_from("<Q", data, end + 1)[0]

    return _records(files, read, "name string, qw double, qx double, qy double, qz double, tx double, ty double, tz double, camera_id int")
