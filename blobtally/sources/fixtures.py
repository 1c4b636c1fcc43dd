"""Input tables derived from the driver's testdata (see FIXTURES.md).

The object store tables the jobs consume are derived, in Spark, from ``lineitem`` and
``orders`` so that they grow with the scale factor:

* one blob per (order, line) of ``lineitem``; four consecutive orders share a blob file;
* one object per order, its uri list naming its lines' blobs (plus edge cases: empty tokens,
  uris missing from the index, null/empty uri, null/zero size, a look-alike archive bucket);
* a file index with some files missing or pathless, and file lengths with some files missing,
  empty, or shorter than what is referenced.

The same definitions as DuckDB text live in ``blobtally.plans.oracle``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blobtally.sources import tables

# Fixed parameters of the fixtures and of every query over them (FIXTURES.md §3).
ARCHIVE_BUCKET = "archive"
KEY_DELIMITER = "_"
MAX_BYTES = 4194304
FILES_PER_GROUP, GROUPS_PER_TAIL = 16, 4
FILES_PER_BLOCK = 50
# Region start keys of the key-value fixture (sorted; the empty key opens the first region).
START_KEYS = [b"", b"000000300", b"000000700", b"000001200"]
CELL_FAMILY = "f"


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


class Fixtures:
    """Lazily built fixture DataFrames for one testdata folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def _lines(self) -> DataFrame:
        """One row per distinct (order, line): lineitem repeats some pairs."""
        return (self.table("lineitem")
                .groupBy("l_orderkey", "l_linenumber")
                .agg((F.max(F.col("l_quantity").cast("bigint")) * 1024).alias("q")))

    @cached_property
    def blob_index(self) -> DataFrame:
        file_id = F.floor(F.col("l_orderkey") / 4).cast("bigint")
        # Blobs lie back to back in their file, in (order, line) order. The window partition is
        # one blob file: at most 4 orders x 7 lines, bounded by construction.
        before = (Window.partitionBy("file_id").orderBy("l_orderkey", "l_linenumber")
                  .rowsBetween(Window.unboundedPreceding, -1))
        df = (self._lines
              .withColumn("file_id", file_id)
              .select(
                  F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("uri"),
                  "file_id",
                  F.concat(F.lit("b"), _s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("blob_id"),
                  F.coalesce(F.sum("q").over(before), F.lit(0)).cast("bigint").alias("start"),
                  F.col("q").alias("length")))
        return tables.read_blob_index(self.spark, df)

    @cached_property
    def objects(self) -> DataFrame:
        """Decoded object table: object_key, uri (comma list), size."""
        orders = self.table("orders").select("o_orderkey", "o_orderstatus")
        line_tokens = self._lines.select(
            F.col("l_orderkey").alias("k"),
            F.col("l_linenumber").cast("int").alias("n"),
            F.col("q"),
            F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber"),
                     F.when(F.col("l_linenumber") == 7, F.lit(",")).otherwise(F.lit(""))).alias("t"))
        missing_tokens = (orders.filter(F.col("o_orderkey") % 10 == 0)
                          .select(F.col("o_orderkey").alias("k"), F.lit(9).alias("n"),
                                  F.lit(1024).cast("bigint").alias("q"),
                                  F.concat(_s("o_orderkey"), F.lit("-9")).alias("t")))
        # Per order at most 8 tokens, so the ordered list is bounded by construction.
        per_order = (line_tokens.unionByName(missing_tokens)
                     .groupBy("k")
                     .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "t"))),
                                                   lambda x: x["t"]), ",").alias("u"),
                          F.sum("q").cast("bigint").alias("total")))
        key = F.col("o_orderkey")
        bucket = (F.when(F.col("o_orderstatus") == "F", F.lit("archive"))
                  .when(F.col("o_orderstatus") == "O", F.lit("archived2"))
                  .otherwise(F.lit("photos")))
        df = (orders.join(per_order, key == F.col("k"), "left")
              .select(F.concat(bucket, F.lit("/"), _s(key)).alias("object_key"),
                      F.when(key % 50 == 7, F.lit("")).otherwise(F.col("u")).alias("uri"),
                      F.when(key % 41 == 3, F.lit(0).cast("bigint"))
                      .when(key % 43 == 5, F.lit(None).cast("bigint"))
                      .otherwise(F.col("total")).alias("size")))
        return df

    @cached_property
    def objects_raw(self) -> DataFrame:
        """The object table as the store keeps it: three byte columns."""
        o = self.objects
        df = o.select(F.encode("object_key", "UTF-8").alias("row_key"),
                      F.encode("uri", "UTF-8").alias("uri"),
                      F.unhex(F.lpad(F.hex("size"), 16, "0")).alias("size"))
        return tables.read_objects(self.spark, df)

    @cached_property
    def file_index(self) -> DataFrame:
        fid = F.col("file_id")
        df = (self.table("orders")
              .select(F.floor(F.col("o_orderkey") / 4).cast("bigint").alias("file_id"))
              .distinct()
              .filter(fid % 89 != 13)
              .select(fid, F.when(fid % 97 == 11, F.lit(None).cast("string"))
                      .otherwise(F.concat(F.lit("/blobstore/f"), _s(fid))).alias("path")))
        return tables.read_file_index(self.spark, df)

    @cached_property
    def file_lengths(self) -> DataFrame:
        fid = F.col("file_id")
        total = F.sum("length")
        df = (self.blob_index
              .filter(fid % 61 != 5)
              .groupBy("file_id")
              .agg(F.when(fid % 53 == 2, F.lit(0).cast("bigint"))
                   .when(fid % 59 == 4, F.floor(total / 2).cast("bigint"))
                   .otherwise(total.cast("bigint")).alias("length"))
              .select(F.concat(F.lit("/blobstore/f"), _s(fid)).alias("path"), "length"))
        return tables.read_file_lengths(self.spark, df)

    @cached_property
    def cell_source(self) -> DataFrame:
        """Records for the key-value operators: customers keyed by a zero-padded id."""
        return self.table("customer").select(
            F.encode(F.lpad(_s("c_custkey"), 9, "0"), "UTF-8").alias("row_key"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"))

    @cached_property
    def run_times(self) -> DataFrame:
        """Run instants for the run-layout operators: one per order date."""
        return self.table("orders").select("o_orderkey", F.col("o_orderdate").alias("run_ts"))
