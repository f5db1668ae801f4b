"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import gc
import time
import uuid
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: spark.checkpoint.dir, or the warehouse where that is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{at.rstrip('/')}/tidewright"


def _delete(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may be gone at exit; the folder is then left to the cluster's own retention
        pass


def new_path(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back, which cuts its lineage and survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of steps that are over and staged: Spark removes them once the driver has collected what stood for
    them, on the side of Python first, whose notices reach the other side a little later."""
    for _ in range(2):
        gc.collect()
        time.sleep(0.3)
        spark.sparkContext._jvm.System.gc()


#: Rows of a few numbers each that may be broadcast; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000
#: A key with more than 1/HOT_SHARE of the rows is hot, so fewer than HOT_SHARE keys are, whatever the input.
HOT_SHARE = 1000


def checked(small: DataFrame, most: int | None = None) -> DataFrame:
    """A staged table of short rows, marked for a broadcast if it has few enough of them."""
    return F.broadcast(small) if small.count() <= (MOST_BROADCAST if most is None else most) else small


def join_by_key(rows: DataFrame, entries: DataFrame, keys: list[str]) -> DataFrame:
    """rows (staged) with the entries (staged, one for each key) of their keys, by inner join. Hot keys meet a broadcast of fewer
    than HOT_SHARE entries; the rest is joined by sort and merge, where no key has more than 1/HOT_SHARE of the rows."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(stage(counts.filter(F.col("n") > rows.count() / HOT_SHARE).select(*keys), "hot-keys"))
    common = rows.join(F.broadcast(entries.join(hot, keys)), keys)
    return common.unionByName(rows.join(hot, keys, "left_anti").join(entries.hint("merge"), keys))


def numbered(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """docs, staged with a number of its own for each row, and that column's name: ids may be null or repeated."""
    (row,) = fresh(docs.columns, "row")
    return stage(docs.withColumn(row, F.monotonically_increasing_id()), label), row


def without_rows(rows: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """rows without those whose number is in gone (one column), which is broadcast up to a checked number."""
    gone = stage(gone.select(F.col(gone.columns[0]).alias(row)), "gone")
    return rows.join(F.broadcast(gone) if gone.count() <= MOST_BROADCAST else gone, row, "left_anti")


def bound_batches(spark: SparkSession, n: int = 1000) -> None:
    """For an application to call, never for an operator: lower its session's Arrow batches to n rows. Whole texts are long, and
    the buffers of a batch are held on both sides of the pipe, so executors need less memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= n:
        spark.conf.set(key, str(n))


@contextmanager
def batch_rows(spark: SparkSession, n: int):
    """While it lasts, Arrow batches have at most n rows, which bounds memory where rows hold long lists."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def fresh(taken, *names: str) -> list[str]:
    """The names, each lengthened until no column in taken has it."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def crc_of(id_col: str) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))


def is_held_out(id_col: str = "doc_id") -> Column:
    return (crc_of(id_col) % 5) == 0


def unit_hash(id_col: str) -> Column:
    """A number from 0 to 1 that depends on the id alone, apart from the fold of is_held_out."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def slices(lengths, most: int):
    """Ranges of consecutive rows whose lengths sum to at most `most`; a longer row stands alone."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


#: Bytes of text that per_text() holds as Python strings at once; a longer text stands alone.
BYTES_AT_ONCE = 1 << 22


def text_slices(column: pa.Array, most: int = BYTES_AT_ONCE):
    """(first row, last row + 1) of runs of rows of a string column of a bounded size. A batch itself is bounded by Spark in bytes."""
    return slices(pc.fill_null(pc.binary_length(column), 0).to_pylist(), most)


def per_text(docs: DataFrame, id_col: str, text_col: str, fields: str, rows_of) -> DataFrame:
    """id_col and the fields of the rows that rows_of gives for each text, null being the empty text. Ids of any type pass
    through Arrow as they are, nulls included; a field that is named as the id gets another name."""
    added = T._parse_datatype_string(fields)
    names = fresh([id_col], *added.names)
    schema = T.StructType([docs.schema[id_col], *[T.StructField(n, f.dataType) for n, f in zip(names, added.fields, strict=True)]])
    arrow = to_arrow_schema(added)

    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                at, rows = [], []
                for i, text in enumerate(batch.column(1).slice(a, b - a).to_pylist(), a):
                    found = rows_of(text or "")
                    at += [i] * len(found)
                    rows += found
                columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)
