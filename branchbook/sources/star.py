"""The star schema of the reference, built from the driver's tables.

Mapping (see FIXTURES.md): branch = the supplier's nation, account = part,
client category = the customer's market segment, operation date = ship date.

``fact_operations`` is derived once per input folder and written as parquet
partitioned by month (``period_idx``) into the session's shared scratch folder,
like the reference's month-partitioned warehouse table. Every query then reads
that table, so the six-way source join is paid once, month filters prune whole
partitions and losing an executor costs a re-read, not a re-join.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from branchbook.functions.periods import raw_period_of
from branchbook.operators.joins import checked_broadcast
from branchbook.session import scratch_dir

SLICE_ROWS = 1_000_000  # facts that one task sorts and writes
# Bump when the mapping or the layout changes so old warehouse copies are not reused.
WAREHOUSE_VERSION = "v4"

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

FACT_COLUMNS = (
    "filial_id", "inc_gk", "operation_date", "period", "period_idx",
    "sender_category", "weight", "cnt", "summa",
)

# Fixed values of the mapping.
B2C_SEGMENT = "HOUSEHOLD"
DOMESTIC_MAX_SIZE = 25  # p_size <= 25 -> 'DOM', else 'INT'


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def _source_key(spark: SparkSession, sf_dir: str) -> str:
    """Names, lengths and times of all source files, listed by the file system that holds them."""
    h = hashlib.sha1(WAREHOUSE_VERSION.encode())
    for t in SOURCE_TABLES:
        p, fs = _fs(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        if not fs.exists(p):
            continue
        files, found = fs.listFiles(p, True), []
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath().toString()}:{f.getLen()}:{f.getModificationTime()}")
        h.update("\n".join(sorted(found)).encode())
    return h.hexdigest()[:16]


class Star:
    """Fact and dimension tables of one input folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.materialize = materialize
        self._fact: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # -- dimensions -------------------------------------------------------
    def dim_filials(self) -> DataFrame:
        """Branch dim: 25 nations with their region (fixed size: broadcast is safe)."""
        n = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.table("region").select("r_regionkey", "r_name")
        return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").alias("filial_id"),
            F.col("n_name").alias("filial_name"),
            F.col("r_name").alias("region"),
        )

    def dim_products(self) -> DataFrame:
        """Product dim: one row per account (part)."""
        return self.table("part").select(
            F.col("p_partkey").alias("inc_gk"),
            F.col("p_name").alias("inc_name"),
            F.col("p_type").alias("product"),
            F.col("p_brand").alias("subcategory"),
            F.when(F.col("p_size") <= DOMESTIC_MAX_SIZE, F.lit("DOM")).otherwise(F.lit("INT")).alias("direction"),
        )

    # -- fact ---------------------------------------------------------------
    def fact_mapped(self) -> DataFrame:
        """The source join that defines ``fact_operations`` (lazy, not written).

        Join order keeps the big side narrow: orders is reduced to
        (orderkey, category) against customer before it meets lineitem;
        supplier is reduced to (suppkey, branch) against the 25-row nation
        table; part is reduced to (partkey, size). The supplier and part sides
        are broadcast only under the checked size limit.
        """
        li = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"
        )
        o = self.table("orders").select("o_orderkey", "o_custkey")
        c = self.table("customer").select("c_custkey", "c_mktsegment")
        order_cat = o.join(checked_broadcast(c), o.o_custkey == c.c_custkey).select(
            "o_orderkey",
            F.when(F.col("c_mktsegment") == B2C_SEGMENT, F.lit("B2C")).otherwise(F.lit("B2B")).alias("sender_category"),
        )
        s = self.table("supplier").select("s_suppkey", "s_nationkey")
        n = self.table("nation").select("n_nationkey")
        supp_branch = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select(
            "s_suppkey", F.col("n_nationkey").alias("filial_id")
        )
        p = self.table("part").select("p_partkey", "p_size")

        j = (
            li.join(order_cat, li.l_orderkey == order_cat.o_orderkey)
            .join(checked_broadcast(supp_branch), li.l_suppkey == supp_branch.s_suppkey)
            .join(checked_broadcast(p), li.l_partkey == p.p_partkey)
        )
        d = F.col("l_shipdate").cast("date")
        return j.select(
            F.col("filial_id"),
            F.col("l_partkey").alias("inc_gk"),
            d.alias("operation_date"),
            raw_period_of(d).alias("period"),
            (F.year(d) * 12 + F.month(d)).cast("int").alias("period_idx"),
            F.col("sender_category"),
            (F.col("l_quantity") * F.col("p_size") / 10).cast("decimal(10,3)").alias("weight"),
            F.col("l_quantity").cast("int").alias("cnt"),
            (
                F.col("l_extendedprice").cast("decimal(18,2)")
                * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
            ).cast("decimal(18,2)").alias("summa"),
        )

    def sliced_fact(self) -> DataFrame:
        """The facts in slices of about ``SLICE_ROWS`` in the order of their dates, each sorted by month and date.

        The slices come from the counts of ``lineitem`` by date (a calendar's rows), so the
        source join runs once; a range exchange would run it once more for its sample.
        A date of many rows is spread over several slices by its rows' content. There are few
        files per month, a month is spread over many tasks at scale (there are only ~83) and
        rows are clustered by date, so parquet min/max stats prune dates.
        """
        day = F.col("l_shipdate").cast("date").alias("__day")
        dates = self.table("lineitem").groupBy(day).agg(F.count(F.lit(1)).alias("__n"))
        upto = Window.orderBy("__day").rowsBetween(Window.unboundedPreceding, 0)
        dates = dates.withColumn("__upto", F.sum("__n").over(upto)).collect()
        n = max(1, -(-max((r["__upto"] for r in dates), default=0) // SLICE_ROWS))
        starts = self.spark.createDataFrame([(r["__day"], r["__upto"] - r["__n"], r["__n"]) for r in dates],
                                            "__day date, __before bigint, __n bigint")
        f = self.fact_mapped()
        place = F.col("__before") + F.pmod(F.xxhash64(*FACT_COLUMNS), F.col("__n"))
        j = f.join(F.broadcast(starts), F.col("operation_date").eqNullSafe(F.col("__day")))
        return j.repartitionById(n, F.floor(place / SLICE_ROWS).cast("int")).select(*FACT_COLUMNS).sortWithinPartitions(
            "period_idx", "operation_date")

    def warehouse_base(self) -> str:
        return f"{scratch_dir(self.spark)}/warehouse/{_source_key(self.spark, self.sf_dir)}"

    def finished_copy(self) -> str | None:
        """A complete copy of the fact table (one with ``_SUCCESS``), if any."""
        base = self.warehouse_base()
        p, fs = _fs(self.spark, f"{base}/fact-*/_SUCCESS")
        found = fs.globStatus(p)
        if not found:
            return None
        return sorted(str(st.getPath().getParent().toString()) for st in found)[0]

    def build_fact(self) -> str:
        """Write the month-partitioned fact table unless a finished copy exists.

        Each builder writes its own folder (``fact-<id>``); readers take the first
        folder with ``_SUCCESS``. Concurrent builders cannot clobber each other and
        a job killed mid-write leaves a folder nobody reads.
        """
        done = self.finished_copy()
        if done is not None:
            return done
        path = f"{self.warehouse_base()}/fact-{uuid.uuid4().hex[:12]}"
        self.sliced_fact().write.mode("errorifexists").option("maxRecordsPerFile", 4_000_000).partitionBy("period_idx").parquet(path)
        return self.finished_copy() or path

    def fact(self) -> DataFrame:
        """``fact_operations`` (columns in FACT_COLUMNS order)."""
        if self._fact is None:
            if self.materialize:
                self._fact = self.spark.read.parquet(self.build_fact()).select(*FACT_COLUMNS)
            else:
                self._fact = self.fact_mapped()
        return self._fact


_STARS: dict[tuple[int, str], Star] = {}


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The Star of a folder, one per session."""
    key = (id(spark), os.path.abspath(sf_dir) if "://" not in sf_dir else sf_dir)
    if key not in _STARS:
        _STARS[key] = Star(spark, sf_dir)
    return _STARS[key]
