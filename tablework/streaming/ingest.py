"""Structured Streaming: topic ingest, append of unseen ids, running maximum."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

# The topics of the sensor feed.
TOPICS = ("vehicle_data", "gps_data", "traffic_data", "weather_data", "emergency_data")

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def kafka_options(servers: str, topics: list[str], starting: str = "earliest") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": starting}


def read_kafka(spark: SparkSession, servers: str, topics: list[str]) -> DataFrame:
    """Topic and text of each message (needs Spark's Kafka connector on the class path)."""
    messages = spark.readStream.format("kafka").options(**kafka_options(servers, topics)).load()
    return messages.select("topic", F.col("value").cast("string").alias("value"), "timestamp")


def read_files(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def typed(messages: DataFrame, value: str, schema: str) -> DataFrame:
    """Parse the JSON value; a message that does not fit the schema keeps nulls."""
    parsed = messages.withColumn("_m", F.from_json(value, schema))
    return parsed.select(*[c for c in messages.columns if c != value], "_m.*")


def route_topics(messages: DataFrame, topic: str, path: str, checkpoint: str) -> StreamingQuery:
    """Append every message below the folder of its topic, as one exactly-once file sink."""
    return (
        messages.writeStream.format("parquet").partitionBy(topic)
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _run_of(spark: SparkSession, checkpoint: str) -> str:
    """Id of the stream, which lives as long as its checkpoint: a new checkpoint is a new run, a restart is not."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def _batch_path(path: str, run: str, batch: int) -> str:
    return f"{path}/run={run}/batch={batch}"


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(schema).parquet(path) if exists else None


@contextmanager
def _state_on_disk(spark: SparkSession):
    """Settings for streams started inside: state in RocksDB, and a stream on available data ends when it has read them.

    Every batch commits every partition of the state, so a batch must not cost more the more keys are stored: it saves its
    changes and not the files of the store, and the state has no more partitions than a few per core, whatever the
    number that suits a join of the whole table. A stream that is started again keeps the number it has.
    """
    partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    names = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false",
             "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true", "spark.sql.shuffle.partitions": str(partitions)}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _first_seen(order: list[str], time: str | None, forget_ms: int | None) -> StatefulProcessor:
    """Per key: the first row of the first batch that has the key. Rows behind the watermark come out marked late."""

    class FirstSeen(StatefulProcessor):
        def init(self, handle):
            self.seen = handle.getValueState("seen", "known boolean", forget_ms)

        def handleInputRows(self, key, rows, timers):
            mark = timers.getCurrentWatermarkInMs() if time else None
            first = least = None
            for row in rows:
                if mark and row[time] is not None and row[time].timestamp() * 1000 < mark:
                    yield Row(**row.asDict(), _late=True)
                    continue
                # nulls first
                at = tuple((row[c] is not None, row[c]) for c in order)
                if first is None or at < least:
                    first, least = row, at
            if first is not None and not self.seen.exists():
                self.seen.update((True,))
                yield Row(**first.asDict(), _late=False)

        def handleInitialState(self, key, stored, timers):
            self.seen.update((True,))

        def close(self):
            pass

    return FirstSeen()


def _seeds(spark: SparkSession, path: str, checkpoint: str, stream: DataFrame) -> DataFrame:
    """Rows stored by other runs as a second source of the stream, written once, when its checkpoint is new."""
    seeds = f"{checkpoint}-known"
    if _stored(spark, seeds, stream.schema) is None:
        known = _stored(spark, path, stream.schema)
        rows = known.select(*stream.columns) if known else spark.createDataFrame([], stream.schema)
        rows.write.parquet(seeds)
    return spark.readStream.schema(stream.schema).parquet(seeds)


def append_unseen(stream: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """Write only rows whose key was not stored by an earlier batch; the first row wins inside a batch.

    The keys are state of the stream, in RocksDB: a batch looks up its own keys, whatever the number of stored ones, and
    combines the rows of a key before the shuffle. A key is new when its first and its last batch are the current one. A
    stream that starts with a new checkpoint on a filled store reads the stored keys once, in its first batch, so nothing
    is accepted twice. Each batch owns the folder ``run=<stream id>/batch=<id>`` and overwrites it when it is retried. A null
    key is a key like any other.
    """
    spark, rest = stream.sparkSession, [c for c in stream.columns if c not in keys]
    both = stream.withColumn("_known", F.lit(False)).unionByName(_seeds(spark, path, checkpoint, stream).withColumn("_known", F.lit(True)))
    # the time of a batch is logged with it, so a retried batch has it again
    marked = both.withColumn("_batch", F.current_timestamp())
    state = marked.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"), F.min("_batch").alias("_first"), F.max("_batch").alias("_last"), F.max("_known").alias("_known"))
    now = F.current_timestamp()
    fresh = state.where(~F.col("_known") & (F.col("_first") == now) & (F.col("_last") == now)).select(*keys, "_r.*").select(*stream.columns)

    def write(rows: DataFrame, batch: int):
        rows.write.mode("overwrite").parquet(_batch_path(path, _run_of(rows.sparkSession, checkpoint), batch))

    with _state_on_disk(spark):
        return fresh.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_unseen_for_a_time(stream: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str, *, time: str | None = None,
                             lateness: str | None = None, forget_ms: int | None = None) -> StreamingQuery:
    """``append_unseen`` with late rows set aside and keys that are forgotten, by a state function per key.

    With ``time`` (a timestamp column) and ``lateness`` (an interval such as ``"1 hour"``), rows that lie further behind the
    newest row of earlier batches are written below ``<path>-late`` instead, and their keys are not looked up. ``forget_ms``
    drops a key that long after it was accepted, by the clock, so that the state stays bounded; it comes back as a new one.
    The function runs in Python, once per key of a batch: where neither is needed, ``append_unseen`` is much faster.
    """
    spark, columns = stream.sparkSession, stream.columns
    schema = T.StructType([*stream.schema.fields, T.StructField("_late", T.BooleanType())])
    known = _stored(spark, path, stream.schema) if not _stored(spark, f"{checkpoint}/metadata", stream.schema) else None
    timed = stream.withWatermark(time, lateness) if time else stream
    clock = "ProcessingTime" if time or forget_ms else "None"
    first = timed.groupBy(*keys).transformWithState(
        _first_seen(order, time, forget_ms), schema, "Append", clock, known.select(*keys).distinct().groupBy(*keys) if known else None)

    def write(rows: DataFrame, batch: int):
        here = _run_of(rows.sparkSession, checkpoint)
        rows = rows.persist()
        rows.where("NOT _late").select(*columns).write.mode("overwrite").parquet(_batch_path(path, here, batch))
        if time:
            rows.where("_late").select(*columns).write.mode("overwrite").parquet(_batch_path(f"{path}-late", here, batch))
        rows.unpersist()

    with _state_on_disk(spark):
        return first.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unseen_within(stream: DataFrame, keys: list[str], time: str, horizon: str) -> DataFrame:
    """Bounded-state variant: an id that returns after the horizon is accepted again."""
    return stream.withWatermark(time, horizon).dropDuplicatesWithinWatermark(keys)


def running_max(stream: DataFrame, keys: list[str], value: str, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the maximum per key as state; every batch writes the keys whose maximum it touched, below its run."""
    highest = stream.groupBy(*keys).agg(F.max(value).alias("highest"))

    def write(rows: DataFrame, batch: int):
        rows.write.mode("overwrite").parquet(_batch_path(path, _run_of(rows.sparkSession, checkpoint), batch))

    with _state_on_disk(stream.sparkSession):
        return (
            highest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )


def current(spark: SparkSession, checkpoints: list[str], keys: list[str]) -> DataFrame:
    """(keys, highest) of running maxima, from the state of their streams: one row per key and stream, whatever was read."""
    states = [spark.read.format("statestore").load(checkpoint) for checkpoint in checkpoints]
    rows = [s.select(*[F.col(f"key.{k}") for k in keys], F.col("value")[s.schema["value"].dataType.names[0]].alias("highest")) for s in states]
    return reduce(DataFrame.unionByName, rows).groupBy(*keys).agg(F.max("highest").alias("highest"))
