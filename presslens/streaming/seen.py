"""The links seen so far, as a table of hashes in buckets.

A bucket is the first digits of the hash. A batch of links reads the buckets that it touches, by their paths, and adds to each a folder with
its own number; only hashes of earlier batches count as seen, so a batch that is repeated finds what it found before and
replaces what it wrote. A bucket with ``MOST`` folders is put together in one before it is read: the union is written as a folder of its
own, numbered below zero, and then the others go; until they do, hashes are there twice, which changes nothing. So a batch
reads at most ``MOST`` folders a bucket, however many batches there were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.operators.merge import dedup_first
from presslens.sources.files import delete

SCHEMA = "hash string, bucket string, batch long"
MOST = 8


class SeenState:
    def __init__(self, spark: SparkSession, path: str, digits: int = 2, most: int = MOST):
        self.spark, self.path, self.digits, self.most = spark, path.rstrip("/"), digits, most

    def hashed(self, rows: DataFrame, link: str) -> DataFrame:
        """``rows`` plus hash and bucket of their link."""
        made = rows.withColumn("hash", F.sha1(F.coalesce(F.col(link), F.lit("")).cast("binary")))
        return made.withColumn("bucket", F.substring("hash", 1, self.digits))

    def _folders(self, bucket: str) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/bucket={bucket}")
        store = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in store.listStatus(path)] if store.exists(path) else []
        return [int(n.partition("=")[2]) for n in names if n.startswith("batch=")]

    def _read(self, folders: dict[str, list[int]]) -> DataFrame:
        paths = [f"{self.path}/bucket={b}/batch={n}" for b, own in folders.items() for n in own]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("basePath", self.path).parquet(*paths)

    def _write(self, hashes: DataFrame) -> None:
        out = hashes.select("hash", "bucket", "batch").repartition("bucket").sortWithinPartitions("bucket", "hash")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(self.path)

    def known(self, buckets: list[str], number: int) -> DataFrame:
        """The hashes of earlier batches in these buckets."""
        earlier = {b: [n for n in self._folders(b) if n < number] for b in buckets}
        full = {b: own for b, own in earlier.items() if len(own) >= self.most}
        if full:
            # A name below all others of the bucket, so that a union that was cut short is not taken for a whole one.
            lowest = -max(abs(n) + 1 for own in full.values() for n in own)
            self._write(self._read(full).select("hash", "bucket").distinct().withColumn("batch", F.lit(lowest).cast("long")))
            for b, own in full.items():
                for n in own:
                    delete(self.spark, f"{self.path}/bucket={b}/batch={n}")
                earlier[b] = [lowest]
        return self._read(earlier)

    def unseen(self, rows: DataFrame, link: str, order: list, number: int) -> DataFrame:
        """Of rows with ``hashed`` columns those whose link no earlier batch had, the first of each link."""
        touched = [r[0] for r in rows.select("bucket").distinct().collect()]  # at most 16 to the number of digits
        known = self.known(touched, number).select("hash").distinct()
        return dedup_first(rows.join(known, "hash", "left_anti"), "hash", order)

    def add(self, rows: DataFrame, number: int) -> None:
        """Note the hashes of ``rows`` as those of a batch; what an earlier try of this batch noted goes."""
        self._write(rows.select("hash", "bucket").distinct().withColumn("batch", F.lit(number).cast("long")))
