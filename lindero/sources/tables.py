"""Readers that say what they do with bad input, and writers that never destroy what is being read."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(_path(spark, path))


def schema_of(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema_of(schema))


#: The order of lines: their file's name, where their part of the file begins, and their place in that part.
PLACE = "place"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(value, place) of text files, ``place`` growing by file name and then by line, however the files are split."""
    return spark.read.text(path).select("value", *_placed(True))


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType, strict: bool = False, place: bool = False) -> DataFrame:
    """Objects of JSON lines. Blank lines go; so do malformed ones and values that are no objects (numbers, arrays, also
    arrays of objects), on which ``strict`` raises. A value of another type than its column's is null. A missing file is
    an empty table. ``place``: the lines' order as one more column of that name."""
    more = schema_of("place struct<file: string, start: long, line: long>").fields if place else []
    if not exists(spark, path):
        return empty(spark, T.StructType([*schema_of(schema).fields, *more]))
    kept = [PLACE] if place else []
    lines = (lines_of(spark, path) if place else spark.read.text(path)).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("line"), *kept).filter("line <> ''")
    is_object = F.col("line").startswith("{") & F.try_parse_json("line").isNotNull()
    if strict:
        lines = lines.select(F.when(is_object, F.col("line")).otherwise(F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring("line", 1, 200)))).alias("line"), *kept)
    else:
        lines = lines.filter(is_object)
    return lines.select(F.from_json("line", schema_of(schema)).alias("o"), *kept).select("o.*", *kept)


def read_keyed_lines(spark: SparkSession, path: str, schema: str | T.StructType, key: str) -> DataFrame:
    """Objects of JSON lines by ``key``: of those with one key the last line counts, that of the last file by name, those
    without any go."""
    rows = read_json_lines(spark, path, schema, place=True).filter(F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) != "")
    own = F.struct(*[F.col(f"`{c}`") for c in schema_of(schema).names])
    return rows.groupBy(key).agg(F.max_by(own, PLACE).alias("_row")).select("_row.*")


def read_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One object per file, over as many lines as it has."""
    return spark.read.schema(schema_of(schema)).option("multiLine", True).json(path)


def _placed(place: bool) -> list[Column]:
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    return [at.alias(PLACE)] if place else []


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], place: bool = False) -> DataFrame:
    """CSV with a header, every column text; with ``place`` the rows' order, as :func:`read_json_lines` has it."""
    rows = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.select("*", *_placed(place)) if place else rows


def read_export(spark: SparkSession, csv: str | None, jsonl: str | None, columns: Sequence[str], place: bool = False) -> DataFrame:
    """The CSV if it is there, else the JSON lines, else FileNotFoundError."""
    if csv and exists(spark, csv):
        return read_csv(spark, csv, columns, place)
    if jsonl and exists(spark, jsonl):
        return read_json_lines(spark, jsonl, T.StructType([T.StructField(c, T.StringType()) for c in columns]), place=place)
    raise FileNotFoundError(f"neither {csv} nor {jsonl} is there")


def decoded(content: Column) -> Column:
    """Bytes as text; what is no UTF-8 is replaced."""
    return F.make_valid_utf8(content.cast("string"))


def read_pages(spark: SparkSession, glob: str) -> DataFrame:
    """(path, html) of whole files, sorted by nothing: order them by path where order matters. Bytes that are no UTF-8
    are replaced."""
    return spark.read.format("binaryFile").load(glob).select("path", decoded(F.col("content")).alias("html"))


def read_published(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A published CSV with the types of ``schema``; whatever is wrong with it, an empty table of them."""
    kind = schema_of(schema)
    try:
        df = spark.read.schema(kind).option("header", True).option("enforceSchema", False).option("multiLine", True).option("escape", '"').csv(path)
        df.limit(1).collect()
        return df
    except Exception:  # not there, another header, not readable
        return empty(spark, kind)


def read_snapshots(spark: SparkSession, root: str, meta: str) -> DataFrame:
    """Snapshots below ``root``: the columns ``meta`` of each ``meta.json``, its folder, and the html and markdown that its
    ``files`` name (null where they are not there). Bytes that are no UTF-8 are replaced."""
    kind = T.StructType([*schema_of(meta).fields, *schema_of("files struct<page_html: string, page_md: string>").fields])
    told = spark.read.option("recursiveFileLookup", True).schema(kind).option("multiLine", True).option("pathGlobFilter", "meta.json").json(root)
    told = told.select("*", F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("snapshot_path"))

    def plain(c: Column) -> Column:
        return F.regexp_replace(c, "^file:/*", "/")

    def texts(glob: str, name: str) -> DataFrame:
        files = spark.read.option("recursiveFileLookup", True).format("binaryFile").option("pathGlobFilter", glob).load(root)
        return files.select(plain(F.col("path")).alias(f"_{name}"), decoded(F.col("content")).alias(name))

    out = told.withColumn("_html", plain(F.col("files.page_html"))).withColumn("_markdown", plain(F.col("files.page_md")))
    return out.join(texts("*.html", "html"), "_html", "left").join(texts("*.md", "markdown"), "_markdown", "left").drop("_html", "_markdown")


def latest_modified(spark: SparkSession, glob: str) -> str | None:
    """The path that was changed last (the later name of equals), or none."""
    found = file_system(spark, glob).globStatus(_path(spark, glob)) or []
    return max(((s.getModificationTime(), s.getPath().toString()) for s in found), default=(0, None))[1]


def listed_paths(documents: DataFrame, column: str = "archived_snapshot_paths") -> DataFrame:
    """(place, path): the paths that documents list, without empty ones."""
    return documents.select(F.posexplode(column).alias("place", "path")).filter(F.coalesce(F.trim("path"), F.lit("")) != "")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A page or a table kept for a look, written by the driver."""
    out = file_system(spark, path).create(_path(spark, path), True)
    out.write(bytearray(text.encode()))
    out.close()


def read_versioned(spark: SparkSession, root: str, schema: str | T.StructType) -> DataFrame:
    """The current version of a table of :mod:`store`; empty if there is none."""
    return store.rows_of(spark, root, store.version(spark, root), schema_of(schema))


def write_versioned(df: DataFrame, root: str) -> str:
    """``df`` as a new version below ``root``, in place of all rows. A table may so be replaced by a plan that reads it.
    Nothing that is current is ever moved or deleted: a reader, also one after a crash at any point, sees the old or the
    new version."""
    return f"{root}/{store.replace(df, root).path}"


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """CSV with a header; a folder with the header alone for an empty table."""
    df.select(*columns or df.columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_document(spark: SparkSession, path: str, value: object) -> None:
    """A JSON document, written by the driver (summaries and manifests)."""
    out = file_system(spark, path).create(_path(spark, path), True)
    out.write(bytearray(json.dumps(value, ensure_ascii=False, indent=2, default=str).encode()))
    out.close()


def read_document(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect()))


def overlay_document(spark: SparkSession, path: str, values: dict) -> dict:
    """Keys of a document replaced or added; a missing document is empty."""
    merged = (read_document(spark, path) if exists(spark, path) else {}) | values
    write_document(spark, path, merged)
    return merged


def latest_usable(runs: DataFrame, probe) -> dict | None:
    """The latest run (by end, else start) for which ``probe`` (a dict of its columns) is true. Runs are driver-side
    manifests; rows come one at a time."""
    order = F.coalesce(F.nullif("ended_at", F.lit("")), F.col("started_at"))
    return next((r.asDict(True) for r in runs.orderBy(order.desc_nulls_last()).toLocalIterator() if probe(r.asDict(True))), None)
