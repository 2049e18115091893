"""Tables kept between the jobs of one operator, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowaudit.session import fresh_path


class Scratch:
    """Writes intermediate tables below ``spark.checkpoint.dir`` and removes those no longer read."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.label = label
        self._paths: dict[int, str] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` once and return a reader of the files; they outlive any executor."""
        path = fresh_path(self.spark, self.label)
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(kept)] = path
        return kept

    def drop(self, kept: DataFrame) -> None:
        """Remove the files of a frame made by ``keep``; it must not be read any more."""
        remove(self.spark, self._paths.pop(id(kept)))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the store's own file system."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def apart(key: Column) -> Column:
    """A join key equal to the given bigint key that Spark does not take for the grouped column.

    A lookup that was grouped by the key just before would be joined without another exchange, and
    adaptive execution splits a hot partition only where both sides of the join have their own.
    """
    return F.bitwise_not(key)
