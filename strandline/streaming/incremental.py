"""Incremental ingest: new files as a stream, every batch merged into the current state of a table.

The checkpoint of the stream replaces lists of what has been attempted: a restart only reads what is new. State is a folder of
versions; a batch writes the next version and then moves the pointer, so a reader never sees a half-written table and a batch
that is run twice gives the same state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.catalogue import upsert


def _versions(spark: SparkSession, state: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(state)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{state}/{n}/_SUCCESS")))


def current(spark: SparkSession, state: str) -> DataFrame | None:
    v = _versions(spark, state)
    return spark.read.parquet(f"{state}/v{v[-1]}") if v else None


def merge_batch(state: str, key: str, order: list[Column], first: tuple[str, ...] = ()):
    """A `foreachBatch` function that keeps the last supplied value of every column per key. `order` columns are part of the
    state, so late rows of older time lose against newer ones."""

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        done = [v for v in _versions(spark, state) if v <= epoch]
        base = spark.read.parquet(f"{state}/v{done[-1]}") if done and done[-1] < epoch else (spark.read.parquet(f"{state}/v{done[-2]}") if len(done) > 1 else None)
        rows = batch if base is None else base.unionByName(batch.select(*base.columns))
        upsert(rows, key, order, first).write.mode("overwrite").parquet(f"{state}/v{epoch}")

    return run


def ingest(spark: SparkSession, source: str, schema, state: str, checkpoint: str, key: str, order: list[Column], first: tuple[str, ...] = (), max_files: int = 1000) -> DataFrame:  # noqa: ANN001
    """Read what is new below `source` (Parquet) and merge it; returns the current state."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    q = stream.writeStream.foreachBatch(merge_batch(state, key, order, first)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    out = current(spark, state)
    return out if out is not None else spark.createDataFrame([], schema)


def windowed_counts(stream: DataFrame, time: str = "ts", kind: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts per kind and time window with a watermark for late rows (batch or streaming input)."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")
