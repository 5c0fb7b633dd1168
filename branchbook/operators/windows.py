"""Window helpers (W6, W12-W15) that hold at scale.

A window without a partition key runs in one task. That is fine on an already
aggregated frame of a bounded size (branches, products, months) and is used
there. For frames that grow with the data, ``running_total`` and ``carried_forward``
scan sorted slices instead: rows are range-partitioned and sorted once, each task
scans its slice in order, and what a slice needs from the slices before it (one row per
slice) is added afterwards. Rows are exchanged once, and a key or value that many rows
share is spread over as many slices as its rows fill when the order goes on below it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchbook.session import stored


def prior_period(value: str, keys: list[str], idx: str = "period_idx") -> Column:
    """Value of the calendar month before (idx - 1) in the same keys; null across a gap.

    A RANGE frame of exactly one step back, unlike ``lag`` which takes the
    previous row whatever its month.
    """
    return F.sum(value).over(Window.partitionBy(*keys).orderBy(idx).rangeBetween(-1, -1))


def year_to_date(value: str, keys: list[str], year: str, idx: str = "period_idx") -> Column:
    """Running sum within the year."""
    w = Window.partitionBy(*keys, year).orderBy(idx).rangeBetween(Window.unboundedPreceding, 0)
    return F.sum(value).over(w)


def centred_mean(value: str, keys: list[str], order: str, window: int) -> Column:
    """Pandas ``rolling(window, center=True, min_periods=1).mean()`` as a ROWS frame."""
    o = (window - 1) // 2
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(window - 1 - o), o)
    return F.avg(value).over(w)


SLICE = "__slice"


def scanned_slices(df: DataFrame, order: list[Column], scan: Callable[[Iterator[pa.Table]], Iterator[pa.Table]], extra: T.StructType,
                   partitions: int | None = None, name: str = "slices") -> DataFrame:
    """The rows in sorted slices, each scanned in order, written to the shared folder.

    ``scan`` takes the tables of one slice, in order, and yields them with the columns
    ``extra``. The column ``__slice`` numbers the slices in the order of their rows.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([*df.schema.fields, *extra.fields, T.StructField(SLICE, T.IntegerType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId()
        for t in scan(pa.Table.from_batches([b]) for b in batches):
            yield from t.append_column(SLICE, pa.array(np.full(t.num_rows, here, dtype=np.int32))).to_batches()

    sliced = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return stored(sliced.mapInArrow(task, schema), name)


def _checked_sum(x: np.ndarray, carry: int) -> np.ndarray:
    """Running sum of 64-bit integers from ``carry`` on; raises instead of wrapping around."""
    if abs(carry) + float(np.abs(x.astype(np.float64)).sum()) >= 9e18:
        raise OverflowError("running total beyond 64 bits")
    return np.cumsum(x) + carry


def running_total(df: DataFrame, value: str, order: list[Column], out: str = "running",
                  partitions: int | None = None) -> DataFrame:
    """W6 for frames of any size: ROWS running sum in a total order, as a prefix scan.

    1. one range exchange and a sort give each task a contiguous slice; the task adds
       its values up as it reads them, and the slices are stored with their sums,
    2. the last sum of each slice (one row per slice) becomes the next slices' carry-in,
       broadcast (its rows are bounded by the number of slices).
    Integers and decimals are added exactly, doubles in the order of the rows; a null adds
    nothing. The order must be total (end it with a unique key) for a stable result.
    """
    kind = df.schema[value].dataType
    decimal = isinstance(kind, T.DecimalType)
    if decimal:  # two exact integers: whole units, and the rest in units of the last place
        unit = F.lit("1e-%d" % kind.scale).cast(f"decimal({kind.scale + 1},{kind.scale})")
        parts = [F.floor(value).cast("bigint"), ((F.col(value) - F.floor(value)) / unit).cast("bigint")]
    else:
        parts = [F.col(value).cast("double" if isinstance(kind, T.FractionalType) else "bigint")]
    n_parts = len(parts)

    def scan(tables: Iterator[pa.Table]) -> Iterator[pa.Table]:
        carry = [0] * n_parts
        for t in tables:
            for i in range(n_parts):
                x = t.column(f"__v{i}").fill_null(0).to_numpy()
                run = np.cumsum(x) + carry[i] if x.dtype == np.float64 else _checked_sum(x, int(carry[i]))
                if len(run):
                    carry[i] = run[-1]
                t = t.append_column(f"__r{i}", pa.array(run))
            yield t

    sums = T.StructType([T.StructField(f"__r{i}", T.DoubleType() if isinstance(kind, (T.DoubleType, T.FloatType)) else T.LongType()) for i in range(n_parts)])
    r = scanned_slices(df.withColumns({f"__v{i}": p for i, p in enumerate(parts)}), order, scan, sums, partitions, "running-total")
    own = F.col("__r0")
    if decimal:
        own = (own.cast(f"decimal(38,{kind.scale})") + F.col("__r1").cast("decimal(20,0)") * unit).cast(f"decimal(38,{kind.scale})")
    r = r.withColumn("__own", own)
    total = r.groupBy(SLICE).agg(F.sum(value).alias("__sum"))
    before = F.sum("__sum").over(Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1))
    carry_in = total.select(SLICE, before.alias("__before"))
    joined = r.join(F.broadcast(carry_in), SLICE)
    return joined.withColumn(out, F.col("__own") + F.coalesce("__before", F.lit(0))).select(*df.columns, out)
