"""Helpers of the training-text operators."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshroad.session import materialize, new_table_path  # materialize is shared by the operators of this folder

# A side of a join is broadcast only if it has been counted and has at most so many rows of a few numbers each.
BROADCAST_ROWS = 1_000_000
# Rows that Python objects are made of at a time; Arrow batches may hold many more.
ROWS_AT_ONCE = 1_000
# Settings that hold many whole texts in memory at a time: Spark's own value, and the one used here.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "2m"), "spark.sql.parquet.columnarReaderBatchSize": ("4096", "512")}
# Without it the files of a shuffle stay until the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named table of a data folder, with only the given columns if any are given."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def release() -> None:
    """Give memory back to the system: a Python worker stays for the tasks of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function for `mapInArrow` that releases its memory at the end of a task."""

    @functools.wraps(run)
    def tidied(batches):
        yield from run(batches)
        release()

    return tidied


def small_batches(spark: SparkSession) -> None:
    """Read and hand texts to Python in smaller batches, unless the session has sizes of its own.

    A batch is held several times over for each task: as columns on the heap, as vectors outside it, as the worker's copy and
    as its objects. Spark's own bounds are 4,096 rows read and 64 MB handed over, whatever the length of the texts.
    """
    for setting, (own, small) in BATCHES.items():
        if spark.conf.get(setting) == own:
            spark.conf.set(setting, small)


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """`mapInArrow` in small batches for a function of all batches of a task."""
    small_batches(df.sparkSession)
    return df.mapInArrow(tidy(run), schema)


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch]],
              schema: str | T.StructType) -> DataFrame:
    """`mapInArrow` for a function of one batch; `make` builds it once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                made = work(batch.slice(start, ROWS_AT_ONCE))
                if isinstance(made, pa.RecordBatch):
                    yield made
                else:
                    yield from made

    return df.mapInArrow(tidy(run), schema)


def batch_of(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def with_columns_from(df: DataFrame, inputs: Sequence[str], make: Callable[[], Callable], added: Sequence[T.StructField],
                      keep: Sequence[str] | None = None) -> DataFrame:
    """Add columns that Python computes from the columns `inputs`, a batch at a time.

    `make()` gives a function from a list of Arrow arrays (one for each input) to a list of Arrow arrays or
    lists (one for each added column). The columns in `keep` (all of them by default) pass unchanged; those
    with a clashing name are replaced.
    """
    names = {f.name for f in added}
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    unique = [F.col(f"`{c}`") for c in dict.fromkeys([*kept, *inputs])]
    source = df.select(*unique)
    schema = T.StructType([source.schema[c] for c in kept] + list(added))
    types = [pa_type(f.dataType) for f in added]

    def build():
        work = make()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = work([batch.column(c) for c in inputs])
            made = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(out, types)]
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=[*kept, *(f.name for f in added)])

        return one

    return map_arrow(source, build, schema)


def pa_type(kind: T.DataType) -> pa.DataType:
    simple = {T.StringType: pa.string(), T.BinaryType: pa.binary(), T.LongType: pa.int64(), T.IntegerType: pa.int32(),
              T.DoubleType: pa.float64(), T.FloatType: pa.float32(), T.BooleanType: pa.bool_()}
    return pa.list_(pa_type(kind.elementType)) if isinstance(kind, T.ArrayType) else simple[type(kind)]


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is made and run inside leaves no shuffle files behind; for results that are read once."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


class Scratch:
    """Tables in the shared folder, each until the last step that reads it is done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Like `materialize`, and without the files of its shuffles."""
        path = self.paths[name] = new_table_path(self.spark, name)
        with shuffles_removed(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no result and no later step reads."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def semi_join(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows of `df` whose key is in `ids`: by broadcast if `ids` is counted and small, else by a shuffle."""
    if ids.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(ids), on, "left_semi")
    return df.join(ids.hint("shuffle_merge"), on, "left_semi")
