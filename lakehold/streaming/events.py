"""Access events as a Structured Streaming source.

- Source: a directory of JSON-lines files, explicit schema (no inference), blank lines
  skipped by the JSON reader; a malformed line is kept with its text in ``_corrupt_record``
  and null fields, so Silver's ``not_null(event_id)`` quarantines it -- nothing is lost
  and nothing crashes the drain.
- Drain: ``trigger(availableNow=True)`` processes everything pending and stops, whatever time
  it takes. Each micro-batch is one partition of Bronze, named by the stream's identity (the id that its checkpoint
  keeps) and its batch id. A batch that is replayed, because its commit was lost, first removes
  what any run wrote under that name, and nothing else: several sources land side by side, and a
  renewed checkpoint, which has a new identity, touches nothing that was landed before.
- A file that an earlier stream has landed is not landed again: each batch's files (path and time of
  modification) are recorded before it counts, and a stream leaves out what others recorded.
- ``cleanSource=archive`` moves consumed files to an archive directory outside the source path.
- In-stream validation is report-only: rows and rule failures are observed while the batch is
  written, in the same pass, and kept in the landing log with the batch.
- Live counts by type: stateful aggregation, state = one row per event type.
"""
from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehold.contracts import CONTRACTS, Contract
from lakehold.functions.rules import STATELESS
from lakehold.operators.keys import with_position
from lakehold.sources.lake import Lake, new_run_id
from lakehold.sources.scratch import new_path

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("reader_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("book_id", T.LongType()),
    T.StructField("event_ts", T.StringType()), T.StructField("_corrupt_record", T.StringType())])


def event_source(spark: SparkSession, source_dir: str, archive_dir: str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(EVENT_SCHEMA).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", "_corrupt_record")
         .option("pathGlobFilter", "*.jsonl"))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(source_dir).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                                     F.col("_metadata.file_modification_time").alias("_modified"))


def kafka_event_source(spark: SparkSession, bootstrap: str, topic: str,
                       starting_offsets: str = "earliest") -> DataFrame:
    """Events from a Kafka topic, decoded with the same schema as the file queue; a value
    that is not valid JSON keeps its text in ``_corrupt_record``. Needs the Kafka
    connector on the classpath (not available in this environment, so untested here)."""
    fields = T.StructType([f for f in EVENT_SCHEMA.fields if f.name != "_corrupt_record"])
    try:
        raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
               .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    except Exception as exc:  # data source not found
        raise RuntimeError("Kafka connector not on the classpath; use the file queue source") from exc
    text = F.col("value").cast("string")
    parsed = F.from_json(text, fields, {"mode": "PERMISSIVE"})
    return raw.select(parsed.alias("e"), text.alias("_text")).select(
        "e.*", F.when(F.col("e").isNull() | F.col("e.event_id").isNull() & F.col("e.event_type").isNull(),
                      F.col("_text")).alias("_corrupt_record"))


def rule_counts(batch: DataFrame, c: Contract) -> list[Column]:
    """Aggregates: rows, failures of each (stateless) event rule, and malformed lines."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for r in c.rules:
        aggs.append(F.count_if(F.coalesce(STATELESS[r.kind](batch, c, r, None), F.lit(False))).alias(f"{r.kind}:{r.column}"))
    aggs.append(F.count_if(F.col("_corrupt_record").isNotNull()).alias("malformed"))
    return aggs


LANDING = T.StructType([
    T.StructField("dataset", T.StringType()), T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("drain", T.StringType()), T.StructField("run_id", T.StringType()), T.StructField("landed_at", T.StringType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.LongType()))])
FILES = "_file string, _modified timestamp"


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint keeps for its stream, as long as it exists."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"].replace("-", "")


def landings(lake: Lake) -> DataFrame:
    """One row per landed micro-batch; of a replayed one, the last."""
    log = lake.read_json("logs", "landings", LANDING)
    return log.groupBy("drain").agg(F.max_by(F.struct(*LANDING.names), "landed_at").alias("l")).select("l.*")


def landed_files(lake: Lake, but_not: str) -> DataFrame | None:
    """Files that other streams have landed."""
    name = "landed_files"
    others = [s for s in lake.list_partitions("logs", name, "stream") if s != but_not]
    base = lake.path("logs", name)
    return lake.spark.read.schema(FILES).option("recursiveFileLookup", "true").parquet(*[f"{base}/stream={s}" for s in others]) if others else None


def drain_events(spark: SparkSession, lake: Lake, source_dir: str | DataFrame,
                 archive_dir: str | None = None, run_id: str | None = None,
                 contract: Contract = CONTRACTS["access_events"], source_name: str | None = None) -> dict:
    """Drain everything pending into Bronze as partition ``run_id``. ``source_dir`` is the
    file-queue directory, or a prepared streaming DataFrame (e.g. from ``kafka_event_source``) with
    the same columns. Each source has a checkpoint of its own, by ``source_name``."""
    run_id = run_id or new_run_id()
    run_ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(timespec="seconds")
    prepared = isinstance(source_dir, DataFrame)
    source = source_dir if prepared else event_source(spark, source_dir, archive_dir)
    checkpoint = lake.path("logs", f"checkpoints/{source_name or ('events_bronze_stream' if prepared else 'events_bronze')}")
    metrics: dict[str, int] = {}
    batches: list[int] = []

    def land(batch: DataFrame, batch_id: int) -> None:
        stream = stream_identity(spark, checkpoint)
        drain = f"{stream}-{batch_id:012d}"
        for run in lake.bronze_runs("access_events"):
            lake.delete("bronze", f"access_events/run_id={run}/drain_batch={drain}")
        if "_modified" in batch.columns:
            known = landed_files(lake, stream)
            batch = batch if known is None else batch.join(known.distinct(), ["_file", "_modified"], "left_anti")
        # numbered while the rows are in scan order
        placed = with_position(batch).withColumns({"_source": F.lit("stream" if prepared else "file"), "_ingested_at": F.lit(run_ts)})
        seen = Observation()
        observed = placed.observe(seen, *rule_counts(placed, contract))
        lake.put_partition(observed, "bronze", "access_events", f"run_id={run_id}/drain_batch={drain}")
        counts = {k: int(v) for k, v in seen.get.items()}
        if "_modified" in batch.columns:
            landed = spark.read.schema(FILES).parquet(f"{lake.path('bronze', 'access_events')}/run_id={run_id}/drain_batch={drain}")
            lake.put_partition(landed.distinct(), "logs", "landed_files", f"stream={stream}/batch={batch_id}")
        at = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat()
        lake.append_json("logs", "landings", spark.createDataFrame(
            [("access_events", stream, batch_id, drain, run_id, at, counts)], LANDING))
        for k, v in counts.items():
            metrics[k] = metrics.get(k, 0) + v
        batches.append(batch_id)

    (source.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return {"run_id": run_id, "rows": metrics.get("rows", 0), "metrics": metrics, "batches": len(batches)}


def _counted(stream: DataFrame, replace: Callable[[DataFrame], None], checkpoint: str) -> None:
    """Count a stream by event type with state (complete mode); each trigger replaces the snapshot, an
    idempotent write."""
    counts = stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("total"))

    def write(batch: DataFrame, epoch_id: int) -> None:
        replace(batch)

    (counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


COUNTS = "event_type string, total long"


def live_counts_by_type(spark: SparkSession, lake: Lake, source_dir: str) -> DataFrame:
    """Count per event type over everything received so far; empty before the first event."""
    _counted(event_source(spark, source_dir), lambda rows: lake.write(rows, "gold", "events_by_type_live"), lake.path("logs", "checkpoints/events_by_type"))
    if not lake.exists("gold", "events_by_type_live"):
        return spark.createDataFrame([], COUNTS)
    return lake.read("gold", "events_by_type_live").select("event_type", "total")


def stream_counts_by_type(spark: SparkSession, table: str) -> DataFrame:
    """A stored events table, one file or a folder of any number of them, read as a stream and
    counted per type. The snapshot lies below the session's shared folder."""
    target = new_path(spark, "stream-counts")
    folder, _, name = table.rstrip("/").rpartition("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    single = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isFile()
    reader = spark.readStream.schema(spark.read.parquet(table).schema)
    stream = reader.option("pathGlobFilter", name).parquet(folder) if single else reader.parquet(table)
    _counted(stream, lambda rows: rows.write.mode("overwrite").parquet(f"{target}/snapshot"), f"{target}/checkpoint")
    snapshot = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/snapshot")
    if not snapshot.getFileSystem(spark._jsc.hadoopConfiguration()).exists(snapshot):
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).parquet(f"{target}/snapshot")
