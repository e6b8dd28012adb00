"""Structured Streaming: incremental forms of the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def watch(spark: SparkSession, path: str, schema: T.StructType, form: str = "json", glob: str | None = None, files_per_trigger: int = 1000) -> DataFrame:
    """T4, T5: rows of the files of a folder, each file once, new ones as they arrive."""
    r = spark.readStream.schema(schema).format(form).option("maxFilesPerTrigger", files_per_trigger)
    return (r.option("pathGlobFilter", glob) if glob else r).load(path)


def append(stream: DataFrame, out: str, checkpoint: str, once: bool = True, every: str = "300 seconds", form: str = "parquet") -> StreamingQuery:
    """Appends a stream's rows to files, each exactly once over restarts; all there is, or in intervals."""
    w = stream.writeStream.format(form).option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=every)).start()


def append_new(stream: DataFrame, out: str, checkpoint: str, key: str, make: Callable[[DataFrame], DataFrame] = lambda d: d) -> StreamingQuery:
    """Of each batch, the rows whose key isn't in the output yet, through ``make``, the first of each key. A batch that is run again after a failure adds nothing twice."""

    def step(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates([key])
        try:
            new = new.join(spark.read.parquet(out).select(key), key, "left_anti")
        except Exception as e:  # nothing written yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        make(new).write.mode("append").parquet(out)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def recent(df: DataFrame, at: str, hours: float, now) -> DataFrame:
    """Rows of the last hours up to ``now``, the newest first."""
    return df.where((F.col(at) > now - F.expr(f"interval {int(hours * 3600)} seconds")) & (F.col(at) <= now)).orderBy(F.col(at).desc())


def tumbling(events: DataFrame, at: str, by: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Extension: counts and sums by event-time window; rows later than the watermark are dropped."""
    e = events.withColumn("_at", F.col(at).cast("timestamp"))
    e = e.withWatermark("_at", late) if events.isStreaming else e
    return e.groupBy(F.window("_at", width).alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")


def sessions(events: DataFrame, at: str, by: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Extension: sessions of a key, closed by a gap."""
    e = events.withColumn("_at", F.col(at).cast("timestamp"))
    e = e.withWatermark("_at", late) if events.isStreaming else e
    return e.groupBy(F.session_window("_at", gap).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n")


def distinct_within(events: DataFrame, key: str, at: str, late: str = "1 hour") -> DataFrame:
    """Extension: the first row of each key within the watermark."""
    return events.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late).dropDuplicatesWithinWatermark([key]).drop("_at")


def value_counts(events: DataFrame, by: str, value: str) -> DataFrame:
    """How often each key has each value: the state that ``stats_of_counts`` is told from, for batches and streams alike."""
    return events.where(F.col(value).isNotNull()).groupBy(by, F.col(value).alias("value")).agg(F.count("*").alias("n"))


def stats_of_counts(counts: DataFrame, by: str) -> DataFrame:
    """Count, mean (whole numbers divided without rest) and 95th percentile (the value at place floor(0.95 n) of the sorted ones, from 0) by key, exactly."""
    w = Window.partitionBy(by)
    run = counts.withColumn("_upto", F.sum("n").over(w.orderBy("value"))).withColumn("_all", F.sum("n").over(w))
    whole = dict(counts.dtypes)["value"] in ("tinyint", "smallint", "int", "bigint")
    total = F.sum(F.col("value") * F.col("n"))
    mean = F.floor(total / F.sum("n")).cast("long") if whole else total / F.sum("n")
    p95 = F.min(F.when(F.col("_upto") > F.least(F.col("_all") - 1, F.floor(F.col("_all") * 0.95)), F.col("value")))
    return run.groupBy(by).agg(F.sum("n").alias("n"), mean.alias("mean"), p95.alias("p95"))


def running_stats(events: DataFrame, by: str, value: str) -> DataFrame:
    """Of a batch."""
    return stats_of_counts(value_counts(events, by, value), by)


def write_running_stats(stream: DataFrame, by: str, value: str, out: str, checkpoint: str) -> StreamingQuery:
    """Of a stream: its counts are kept as state, and each batch writes the statistics anew."""

    def step(batch: DataFrame, _: int) -> None:
        stats_of_counts(batch, by).write.mode("overwrite").parquet(out)

    return value_counts(stream, by, value).writeStream.outputMode("complete").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def session_log(turns: DataFrame, session: str, order: str, tokens: str, keep: int = 10) -> DataFrame:
    """Of each session its turns, tokens, and the tokens of the newest ``keep`` turns. Newest turns are picked within tasks first."""
    r = F.row_number().over(Window.partitionBy(session).orderBy(F.col(order).desc()))
    kept = turns.select(session, order, tokens).withColumn("_r", r).where(F.col("_r") <= keep).groupBy(F.col(session).alias("_session")).agg(F.coalesce(F.sum(tokens), F.lit(0)).alias("kept_tokens"))
    all_ = turns.groupBy(session).agg(F.count("*").alias("turns"), F.sum(tokens).alias("tokens"))
    return all_.join(kept, all_[session].eqNullSafe(kept["_session"])).drop("_session")
