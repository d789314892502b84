"""Streaming counterparts: scoring a stream and watching it for drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallymark.functions.columns import safe_ratio
from tallymark.plans.scoring import check_contract, score
from tallymark.sources.ingest import SourceUnreadable
from tallymark.spec import TableSpec

EPSILON = 1e-4  # share used for an empty histogram bin


def read_parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream the Parquet files of a path (one file, a folder, or a pattern); siblings are not read."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    plain = path.rstrip("/")
    if not any(c in plain for c in "*?[{") and _is_file(spark, plain):
        # a streaming source has to be a folder
        folder, _, name = plain.rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def _is_file(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile()


def write_stream(
    df: DataFrame, sink: str, checkpoint: str, mode: str = "append", available_now: bool = True
) -> StreamingQuery:
    """Write to Parquet files with exactly-once bookkeeping in the checkpoint folder."""
    writer = (
        df.writeStream.format("parquet").outputMode(mode).option("path", sink)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def score_stream(
    model: PipelineModel, stream: DataFrame, sink: str, checkpoint: str, labels=None,
    available_now: bool = True,
) -> StreamingQuery:
    """The batch scoring plan on a stream: narrow, stateless, one row out per row in."""
    return write_stream(score(model, stream, labels), sink, checkpoint, "append", available_now)


def score_checked_stream(
    model: PipelineModel, stream: DataFrame, spec: TableSpec, sink: str, rejected: str, checkpoint: str, labels=None,
    available_now: bool = True,
) -> StreamingQuery:
    """Score the rows that meet the contract, set the others aside with the names of the rules they break.

    Both sinks hold a folder a micro-batch (``batch=<number>``), which is replaced as a whole. A batch that runs again after a failure
    holds the same rows, so its folders end up as if it had run once; ``read_batches`` reads a sink.
    """
    absent = [c for c in spec.raw_features if c not in stream.columns]
    if absent:
        raise SourceUnreadable(f"missing columns {absent}")

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist(StorageLevel.DISK_ONLY)  # both sinks read it
        try:
            valid, broken = check_contract(held, spec)
            score(model, valid, labels).write.mode("overwrite").parquet(f"{sink}/batch={number}")
            broken.write.mode("overwrite").parquet(f"{rejected}/batch={number}")
        finally:
            held.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_batches(spark: SparkSession, sink: str) -> DataFrame:
    """All batches of a sink of ``score_checked_stream``."""
    return spark.read.parquet(sink).drop("batch")


def window_profile(
    stream: DataFrame,
    ts: str,
    value: str,
    category: str,
    known: Sequence[str],
    edges: Sequence[float],
    window: str = "1 day",
    watermark: str = "1 hour",
) -> DataFrame:
    """Per tumbling window: rows, null rate, share of unseen categories and histogram counts.

    ``edges`` are the inner bin edges of the reference histogram; bins are right-closed. State is
    one short row per open window, whatever arrives.
    """
    x = F.col(value)
    bins = len(edges) + 1
    place = sum((F.when(x > float(e), 1).otherwise(0) for e in edges), F.lit(0))
    counts = [F.count(F.when(x.isNotNull() & (place == i), 1)).alias(f"b{i}") for i in range(bins)]
    wall_clock = isinstance(stream.schema[ts].dataType, T.TimestampNTZType)
    if wall_clock:  # windows need an instant: read the wall clock as UTC, whatever the session zone
        stream = stream.withColumn(
            ts, F.from_utc_timestamp(F.col(ts).cast("timestamp"), F.current_timezone())
        )
    timed = stream.withWatermark(ts, watermark) if stream.isStreaming else stream
    grouped = timed.groupBy(F.window(ts, window).alias("w")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(x.isNull(), 1)).alias("nulls"),
        F.count(F.when(~F.col(category).isin(list(known)), 1)).alias("unseen"),
        *counts,
    )
    return grouped.select(
        (
            F.to_utc_timestamp("w.start", F.current_timezone()).cast("timestamp_ntz")
            if wall_clock
            else F.col("w.start")
        ).alias("window_start"),
        "n", "nulls", "unseen",
        F.array(*[f"b{i}" for i in range(bins)]).alias("bins"),
    )


def drift(
    profile: DataFrame, expected: Sequence[float]
) -> DataFrame:
    """Null rate, unseen rate and population stability index of each window against the reference
    shares ``expected``."""
    held = sum((F.col("bins")[i] for i in range(len(expected))), F.lit(0)).cast("double")
    terms = []
    for i, share in enumerate(expected):
        a = F.greatest(F.coalesce(safe_ratio(F.col("bins")[i], held), F.lit(0.0)), F.lit(EPSILON))
        e = F.lit(max(float(share), EPSILON))
        terms.append((a - e) * F.log(a / e))
    return profile.select(
        "window_start", "n",
        safe_ratio("nulls", "n").alias("null_rate"),
        safe_ratio("unseen", "n").alias("unseen_rate"),
        sum(terms, F.lit(0.0)).alias("psi"),
    )


def with_open_windows(
    written: DataFrame, arrived: DataFrame, expected: Sequence[float], **profile
) -> DataFrame:
    """Drift of all windows once a stream has ended: the ``written`` ones and those still open then.

    ``arrived`` holds the rows the stream has read; only windows that were not written are taken from it.
    """
    every = drift(window_profile(arrived, **profile), expected)
    tail = every.join(written.select("window_start"), "window_start", "left_anti")
    return written.select(*every.columns).unionByName(tail)


def drift_stream(
    stream: DataFrame, expected: Sequence[float], sink: str, checkpoint: str, **profile
) -> StreamingQuery:
    """Write the drift of every closed window."""
    return write_stream(drift(window_profile(stream, **profile), expected), sink, checkpoint)
