"""Keyed tables: rows in hash buckets of a key, changed bucket by bucket, each change written aside and made valid by one small file."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.plans.lineage import cut

#: A project's first change of more rows than this a bucket makes more buckets, up to the most.
BUCKET_ROWS, LEAST_BUCKETS, MOST_BUCKETS = 250_000, 16, 4096
LOG = "seq long, project_uuid string, bucket int, version string, buckets int"
PLACE = ("project_uuid", "bucket", "version")


def fitting(rows: int) -> int:
    """A number of buckets for so many rows: a power of two."""
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << max(0, -(-rows // BUCKET_ROWS) - 1).bit_length()))


def bucket_of(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


class KeyedTable:
    """A table of one schema under path, by project. Files are never changed: a change writes new versions of the buckets that it touches under
    data/, and then one file in _log/ that names them. Before that file nobody sees the change, after it everybody does; a run that breaks off
    leaves files that no log names. One writer a project at a time. buckets: of a project's first change; by default as fits its rows, and
    replace() can deal them anew.
    """

    def __init__(self, spark: SparkSession, path: str, ddl: str, buckets: int | None = None):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.schema = T.StructType([f for f in spark.createDataFrame([], ddl).schema if f.name not in PLACE])

    def _read(self, part: str, schema: T.StructType | str) -> DataFrame:
        try:
            reader = self.spark.read.schema(schema)
            return reader.json(f"{self.path}/{part}") if part == "_log" else reader.parquet(f"{self.path}/{part}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def log(self) -> DataFrame:
        """(project_uuid, bucket, version, buckets, seq): the valid version of every bucket."""
        newest = F.max_by(F.struct("version", "buckets", "seq"), F.col("seq"))
        return self._read("_log", LOG).groupBy("project_uuid", "bucket").agg(newest.alias("n")).select("project_uuid", "bucket", "n.*")

    def _data(self) -> DataFrame:
        places = "project_uuid string, bucket int, version string"
        return self._read("data", T.StructType([*self.schema.fields, *self.spark.createDataFrame([], places).schema.fields]))

    def _out(self, rows: DataFrame) -> DataFrame:
        return rows.select("project_uuid", *self.schema.names)

    def every(self) -> DataFrame:
        """The valid rows of all projects."""
        return self._out(self._data().join(self.log().select(*PLACE), list(PLACE), "left_semi"))

    def rows(self, project: str, buckets: list[int] | None = None) -> DataFrame:
        """The valid rows of a project, or of some of its buckets; others are not read."""
        valid = self.log().where(F.col("project_uuid") == project)
        named: dict[str, list[int]] = {}
        for r in valid.where(F.col("bucket").isin(buckets) if buckets is not None else F.lit(True)).collect():  # a row for each bucket
            named.setdefault(r["version"], []).append(r["bucket"])
        chosen = F.lit(False)
        for version, own in named.items():
            chosen |= (F.col("version") == version) & F.col("bucket").isin(own)
        return self._out(self._data().where((F.col("project_uuid") == project) & chosen))

    def _number(self, project: str) -> tuple[int | None, int]:
        """The project's number of buckets, if it has any, and the number of the next change."""
        last = self._read("_log", LOG).agg(F.max(F.when(F.col("project_uuid") == project, F.col("seq"))).alias("seq"), F.max_by("buckets", F.when(F.col("project_uuid") == project, F.col("seq"))).alias("buckets")).first()
        return last["buckets"], (last["seq"] or 0) + 1

    def _write(self, rows: DataFrame, project: str, version: str) -> None:
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
        placed = rows.select(F.lit(project).alias("project_uuid"), F.col("bucket"), F.lit(version).alias("version"), *typed)
        placed.repartition("bucket").write.partitionBy(*PLACE).mode("append").parquet(f"{self.path}/data")

    def _commit(self, project: str, touched: list[int], version: str, buckets: int, seq: int) -> None:
        rows = self.spark.createDataFrame([(seq, project, b, version, buckets) for b in touched], LOG)
        rows.coalesce(1).write.mode("append").json(f"{self.path}/_log")

    def replace(self, project: str, rows: DataFrame, by: list[str], buckets: int | None = None) -> list[int]:
        """The project's rows are rows from now on, even none. by: the columns whose hash deals them; buckets: a new number of these."""
        before, seq = self._number(project)
        rows, version = cut(rows), uuid.uuid4().hex
        buckets = buckets or before or self.buckets or fitting(rows.count())
        self._write(rows.withColumn("bucket", bucket_of(by, buckets)), project, version)
        touched = list(range(max(before or 0, buckets)))
        self._commit(project, touched, version, buckets, seq)
        return touched

    def update(self, project: str, rows: DataFrame, by: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Merge rows into the project: merge(existing, incoming) of the touched buckets replaces these; others are neither read nor
        written. by: columns that follow from the key, so that rows of one key share a bucket. Returns the touched buckets."""
        buckets, seq = self._number(project)
        rows, version = cut(rows), uuid.uuid4().hex
        buckets = buckets or self.buckets or fitting(rows.count())
        touched = sorted(r["bucket"] for r in rows.select(bucket_of(by, buckets).alias("bucket")).distinct().collect())  # at most the buckets
        if touched:
            merged = merge(self.rows(project, touched).drop("project_uuid"), rows)
            self._write(merged.withColumn("bucket", bucket_of(by, buckets)), project, version)
            self._commit(project, touched, version, buckets, seq)
        return touched

    def stale(self) -> DataFrame:
        """(project_uuid, bucket, version) of the versions that are valid no longer, or never were: their folders under data/ may go once no reader uses them."""
        found = self._data().select(*PLACE).distinct()
        return found.join(self.log().select(*PLACE), list(PLACE), "left_anti")
