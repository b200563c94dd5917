"""What the operators of this subpackage share: shared folders, files in them, null-safe input columns."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_root(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``. Where it is unset and all runs on one machine (tests),
    one is made and set; on a cluster that is an error, as executors would not see it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors and the driver share")
        root = "file://" + tempfile.mkdtemp(prefix="lindero-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's part of the shared folder."""
    return f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Remove what the operators of this application have written below the shared folder. Results that were not
    collected or written elsewhere can't be read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Shuffle partitions to a file of a narrow table.
NARROW = 16


def written(df: DataFrame, name: str, narrow: bool = False, compression: str | None = None, number: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and outlives executors. ``compression``: the session's, if
    none.

    ``narrow``: rows of a few numbers. The plan's own tasks make them, and one more exchange brings them into fewer files
    (a sixteenth of the session's shuffle partitions, so that they grow with it), as each file costs the store several
    calls. ``number``: a column to add, with
    a different number in each row; the tasks that write give it, so that a task that runs again changes nothing.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    rows = df.repartition(-(-int(spark.conf.get("spark.sql.shuffle.partitions")) // NARROW)) if narrow else df
    rows = rows.withColumn(number, F.monotonically_increasing_id()) if number else rows
    rows.write.parquet(path, compression=compression)
    return spark.read.schema(rows.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions_of(df: DataFrame) -> int:
    """Number of input splits of ``df``; it grows with the input and no job runs."""
    return max(1, df.rdd.getNumPartitions())


#: Rows and bytes of the Arrow batches that texts are handed to Python in. Spark's default is 10,000 rows, however long.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def limit_batches(df: DataFrame) -> DataFrame:
    """``df``; the session's Arrow batches are limited to BATCH_ROWS and BATCH_BYTES unless they are smaller already, so
    that a batch of very long texts does not outgrow a worker."""
    conf = df.sparkSession.conf
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(name, None)
        number = int(now) if now and now.lstrip("-").isdigit() else 0
        if not 0 < number <= most:
            conf.set(name, str(most))
    return df


#: How the caches of this worker process are emptied, by their names.
CACHES: dict[str, Callable[[], object]] = {}
_owner = [""]
Batches = Iterator[pa.RecordBatch]


def begin(owner: str) -> None:
    """A task of the operator ``owner`` starts in this worker: what other operators have cached here goes."""
    if _owner[0] != owner:
        for clear in CACHES.values():
            clear()
        _owner[0] = owner


def end() -> None:
    """Buffers that a task no longer needs go back to the machine: workers live on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def frugal(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, leaving a worker that is used again no larger than its own caches make it."""
    owner = run.__module__

    def all_of(batches: Batches) -> Batches:
        begin(owner)
        try:
            yield from run(batches)
        finally:
            end()

    return all_of


def filesystem(uri: str):
    """(pyarrow file system, path in it) for any store that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def put_file(uri: str, chunks: Sequence[bytes | memoryview]) -> int:
    """Write a file under a temporary name and move it into place, so that a rerun task replaces it whole."""
    store, path = filesystem(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    size = 0
    with store.open_output_stream(part) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    store.move(part, path)
    return size


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def joined(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join by sorting both sides, at every size: no table that grows with the input is broadcast."""
    return rows.join(groups.hint("merge"), keys, how)


def salted_lookup(rows: DataFrame, groups: DataFrame, keys: list[str], spread: Column, salts: int = 8, how: str = "left") -> DataFrame:
    """Join of ``rows`` with ``groups``, every key met in ``salts`` tasks instead of one.

    The rows of a key are dealt over salts by ``spread`` and each group is there under every salt, so that a key with a
    third of all rows is a third / ``salts`` of them in a task at most, before adaptive execution splits it further.
    """
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return joined(dealt, copies, [*keys, "_salt"], how).drop("_salt")


def numbered(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with a different value in each row that every later read of them finds again: the file and the place in
    it where they come from one folder of Parquet files, else a number in a table written for it."""
    try:
        return docs.select("*", F.concat_ws("#", "_metadata.file_path", F.lpad(F.col("_metadata.row_index").cast("string"), 12, "0")).alias(column))
    except AnalysisException:
        return written(docs, "numbered", compression="zstd", number=column)
