"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage

WORD_GAP = "[\\x20\\x09-\\x0D]+"
SHARE = 256                 # a key of more than one row in so many is hot


def ship(module_name: str) -> None:
    """Pickle the functions of a module by value, so executors need no
    installed copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read back:
    expensive steps run once and a lost executor costs no recomputation."""
    return cut_lineage(df, f"llm-{name}")


def let(value: Column, body) -> Column:
    """Bind ``value`` once inside an expression: ``body`` gets a variable that
    can be used many times, also inside lambdas, without recomputing it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def crc_mod(col: str, mod: int) -> Column:
    """crc32 of the column as text, modulo ``mod``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def named(column: str) -> Column:
    """The column of exactly this name, also where the name holds a dot or a back-quote."""
    return F.col("`" + column.replace("`", "``") + "`")


def as_row(columns: list[str], name: str = "row") -> Column:
    """The columns as one struct ``name``: their names cannot clash with an operator's own."""
    return F.struct(*[named(c).alias(c) for c in columns] or [F.lit(0).alias("_")]).alias(name)


def of_row(columns: list[str], name: str = "row") -> list[Column]:
    """The columns of the struct ``name`` again."""
    return [F.col(name).getField(c).alias(c) for c in columns]


def join_by_share(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` left-joined with ``table`` (one row per ``key``, nulls are a key
    like any other; ``count`` says how many of the rows have it), without
    ``count``. Keys of more than one row in ``SHARE`` - there can be no more than
    ``SHARE`` of them - are broadcast; the other rows are shuffled by the key, also
    where Spark, going by the files of ``table``, would broadcast it too."""
    values = [c for c in table.columns if c not in (key, count)]
    total = table.agg(F.sum(named(count))).first()[0] or 0
    heavy = named(count) * SHARE > total
    packed = F.struct(*[named(c).alias(c) for c in values])
    hot = table.where(heavy).select(named(key).alias("__hot_key"), packed.alias("__hot"))
    # 0, but not as a constant: that would leave the join's keys, and hot rows would meet again in one task
    none = F.least(named(count), F.lit(0)).cast("long")
    cold = table.where(~heavy).select(named(key).alias("__cold_key"), none.alias("__cold_spread"), packed.alias("__cold"))
    marked = (rows.select(as_row(rows.columns), named(key).alias("__key"))
              .join(F.broadcast(hot), F.col("__key").eqNullSafe(F.col("__hot_key")), "left"))
    # rows of a hot key need no partner any more: a number of their own spreads them over all tasks
    marked = marked.withColumn("__spread", F.when(F.col("__hot").isNotNull(), F.xxhash64(F.monotonically_increasing_id()).bitwiseOR(F.lit(1)))
                               .otherwise(F.lit(0).cast("long")))
    same = F.col("__key").eqNullSafe(F.col("__cold_key")) & (F.col("__spread") == F.col("__cold_spread"))
    joined = marked.hint("merge").join(cold, same, "left").withColumn("__found", F.coalesce("__hot", "__cold"))
    return joined.select(*of_row(rows.columns), *[F.col("__found").getField(c).alias(c) for c in values])


def carried(row: DataFrame, name: str, ddl: str) -> StructType:
    """Schema of the struct column ``name`` (the caller's own columns, whatever
    their names) followed by the fields of ``ddl``."""
    return StructType([row.schema[name], *StructType.fromDDL(ddl).fields])


def freed(run):
    """``run`` (batches to batches) that gives the memory of its task back to the
    system at the end: the worker process lives on beside the next stage's tasks."""
    def wrapped(batches):
        yield from run(batches)
        import ctypes
        import gc
        import pyarrow as pa
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):                   # another C library: it decides by itself
            pass
    return wrapped


def text_column(batch, column: str = "text", row: str | None = None):
    """The column, or where ``row`` is given the field ``column`` of that struct."""
    return batch.column(column) if row is None else batch.column(row).field(column)


def packed_rows(batch, size: int = 8 << 20, column: str = "text", row: str | None = None):
    """Split an Arrow batch into runs of rows whose texts hold about ``size``
    bytes, so that work memory follows bytes and not row counts."""
    import numpy as np
    n = batch.num_rows
    if n == 0:
        return
    import pyarrow.compute as pc
    lens = pc.fill_null(pc.binary_length(text_column(batch, column, row)), 0)
    lens = np.asarray(lens.to_numpy(zero_copy_only=False), dtype=np.int64)
    ends = np.cumsum(lens)
    start = 0
    while start < n:
        base = ends[start] - lens[start]
        stop = int(np.searchsorted(ends, base + size, side="right"))
        stop = max(stop, start + 1)
        yield batch.slice(start, stop - start)
        start = stop
