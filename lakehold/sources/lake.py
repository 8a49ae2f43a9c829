"""The layered lake: raw, bronze, silver, gold, quarantine, catalog and logs under one root.

Paths are Hadoop paths (local, HDFS, object store); all IO goes through Spark.
- Bronze is append-only, partitioned by ``run_id``; readers take given runs or the latest.
- Quarantine is one table per dataset, partitioned by ``run_id``; a ledger records the
  batches already reprocessed.
- Silver, Gold and catalogue tables are replaced by versions: a new one is written beside the old and counts
  from the moment its marker stands, so readers see the old rows or the new and a failed write
  changes nothing. The version before stays for readers that began with it.
- Partitions (a run, a micro-batch) are written into a staging folder and moved to their place whole.
- Run records, alerts, lineage edges and the ledger are appended as JSON lines; ``compact_log`` turns many of them
  into versions of a Parquet table.
"""
from __future__ import annotations

import datetime as _dt
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from lakehold.contracts import STREAM_DATASETS
from lakehold.operators.keys import DRAIN, with_position

VERSION, COMMITTED = "v-", "_committed"   # folder of a version; the marker of a whole one
# compacted logs: the table's suffix, its own columns, folders of appended records
COMPACTED, CORRUPT, FOLDER = "_compacted", "_corrupt_record", "_folder"
OF_RECORDS = re.compile("[0-9a-f]{32}")
LOCK_HOURS = 24
LAYERS = ("raw", "bronze", "silver", "gold", "quarantine", "catalog", "logs")


class TableMissing(FileNotFoundError):
    pass


def new_run_id(now: _dt.datetime | None = None) -> str:
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return f"{now:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


def with_control_columns(df: DataFrame, source: str, run_id: str, run_ts: str) -> DataFrame:
    """Bronze copy of ``df``: unchanged data plus ``_ingested_at``, ``_source``, ``run_id`` and where
    each row stood in its source (``_ordinal``, and ``_file`` and ``_block`` of a file scan), the
    arrival order used for keep-first. The position is taken on the scan, before anything moves a
    row, and stored with it; positions that ``df`` brings along stay."""
    if "_ordinal" not in df.columns:
        try:
            df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
        except AnalysisException:   # not a file scan: the order of its partitions is all there is
            pass
    cols = {"_ingested_at": F.lit(run_ts), "_source": F.lit(source)}
    return with_position(df).withColumns({**cols, "run_id": F.lit(run_id)})


class Lake:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        if fmt not in ("parquet", "csv"):
            raise ValueError("format must be parquet or csv")
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    # ---- paths ---------------------------------------------------------------------
    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root}/{layer}/{name}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _children(self, layer: str, name: str) -> list[str]:
        fs, p = self._fs(self.path(layer, name))
        return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []

    def _versions(self, layer: str, name: str) -> list[str]:
        """The written versions of a replaced table, oldest first."""
        fs, p = self._fs(self.path(layer, name))
        made = self.spark._jvm.org.apache.hadoop.fs.Path
        return [v for v in self._children(layer, name) if v.startswith(VERSION) and fs.exists(made(f"{p}/{v}/{COMMITTED}"))]

    def location(self, layer: str, name: str) -> str:
        """Where a table's rows lie now: its last written version, or the folder itself."""
        versions = self._versions(layer, name)
        return f"{self.path(layer, name)}/{versions[-1]}" if versions else self.path(layer, name)

    def exists(self, layer: str, name: str) -> bool:
        fs, p = self._fs(self.path(layer, name))
        if not fs.exists(p):
            return False
        return bool(self._versions(layer, name)) or not any(c.startswith(VERSION) for c in self._children(layer, name))

    def delete(self, layer: str, name: str) -> None:
        fs, p = self._fs(self.path(layer, name))
        if fs.exists(p):
            fs.delete(p, True)

    def put_partition(self, df: DataFrame, layer: str, name: str, partition: str) -> DataFrame:
        """Write a partition whole, in place of what stands there: files are staged and moved by one rename (on
        object stores, where a rename is a copy, readers may see a part of it for a moment). Returns its rows."""
        staged, target = f"{self.path(layer, name)}/_staging/{uuid.uuid4().hex}", f"{self.path(layer, name)}/{partition}"
        df.write.parquet(staged)
        fs, p = self._fs(target)
        fs.delete(p, True)
        fs.mkdirs(p.getParent())
        if not fs.rename(self.spark._jvm.org.apache.hadoop.fs.Path(staged), p):
            raise OSError(f"could not move {staged} to {target}")
        return self.spark.read.parquet(target)

    def list_partitions(self, layer: str, name: str, column: str = "run_id") -> list[str]:
        """Partition values present under a table (directory listing, no data read)."""
        fs, p = self._fs(self.path(layer, name))
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            n = st.getPath().getName()
            if st.isDirectory() and n.startswith(column + "=") and self._has_data(fs, st.getPath()):
                out.append(n.split("=", 1)[1])
        return sorted(out)

    def _has_data(self, fs, path) -> bool:
        """Whether a data file lies below (an unfinished write leaves only temporary ones)."""
        for st in fs.listStatus(path):
            n = st.getPath().getName()
            if not n.startswith(("_", ".")) and (st.isFile() or self._has_data(fs, st.getPath())):
                return True
        return False

    def has_rows_of(self, layer: str, name: str) -> bool:
        """Whether a table holds data files, of no row maybe: a folder alone is no table."""
        if not self.exists(layer, name):
            return False
        return self._has_data(*self._fs(self.location(layer, name)))

    # ---- generic tables ----------------------------------------------------------------
    def _reader(self):
        r = self.spark.read
        if self.fmt == "csv":
            return r.option("header", True).option("inferSchema", True).format("csv")
        return r.format("parquet")

    def read(self, layer: str, name: str) -> DataFrame:
        path = self.path(layer, name)
        try:
            if not self.exists(layer, name):
                raise TableMissing(f"no {layer} data for {name} at {path}")
            return self._reader().load(self.location(layer, name))
        except AnalysisException as exc:
            raise TableMissing(f"no {layer} data for {name} at {path}") from exc

    def write(self, df: DataFrame, layer: str, name: str, fmt: str | None = None) -> None:
        """Replace a table: write the next version, then mark it as written. ``fmt`` is the lake's where not given."""
        base, before = self.path(layer, name), self._children(layer, name)
        written = self._versions(layer, name)
        number = max((int(v.split("-")[1]) for v in before if v.startswith(VERSION)), default=-1) + 1
        target = f"{base}/{VERSION}{number:09d}-{uuid.uuid4().hex[:8]}"
        if (fmt or self.fmt) == "csv":
            df.write.option("header", True).csv(target)
        else:
            df.write.parquet(target)
        fs, marker = self._fs(f"{target}/{COMMITTED}")
        fs.create(marker).close()
        # the version before stays; older ones, and files from before there were versions, go
        for old in before:
            if (old < written[-1]) if written and old.startswith(VERSION) else not old.startswith(VERSION):
                fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{old}"), True)

    # ---- raw files ------------------------------------------------------------------------
    def read_raw_csv(self, name: str, schema: T.StructType) -> DataFrame:
        """CSV with a header. Columns are matched to the contract *by name* (a source that
        lost or gained columns is not mis-aligned); declared types are applied leniently
        (``try_cast``: unparsable -> null); an empty field is null; a line with the wrong
        number of fields keeps its text in ``_corrupt_record``, which fails every contract."""
        path = self.path("raw", f"{name}.csv")
        header = self.spark.read.option("header", True).csv(path).columns
        text = T.StructType([T.StructField(h, T.StringType(), True) for h in header]
                            + [T.StructField("_corrupt_record", T.StringType(), True)])
        raw = (self.spark.read.option("header", True).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", "_corrupt_record").schema(text).csv(path))
        raw = with_position(raw.select("*", F.col("_metadata.file_path").alias("_file"),
                                       F.col("_metadata.file_block_start").alias("_block")))
        declared = {f.name: f.dataType for f in schema.fields}
        cols = []
        for h in header:
            t = declared.get(h)
            cols.append(F.col(h).try_cast(t).alias(h) if t is not None and not isinstance(t, T.StringType)
                        else F.col(h))
        return raw.select(*cols, "_corrupt_record", "_file", "_block", "_ordinal")

    # ---- bronze -----------------------------------------------------------------------------
    def write_bronze(self, df: DataFrame, name: str, source: str, run_id: str, run_ts: str) -> int:
        """Write a run's partition, replacing what an earlier attempt of the run left; the number of
        rows, from the written files. A source without rows gives a partition without rows."""
        partition = f"run_id={run_id}"
        if name in STREAM_DATASETS:   # next to drained micro-batches, at their depth
            partition += "/drain_batch=run"
        placed = with_control_columns(df, source, run_id, run_ts).drop("run_id", DRAIN)
        return self.put_partition(placed, "bronze", name, partition).count()

    def bytes_of(self, layer: str, name: str, partitions: list[str] | None = None,
                 column: str = "run_id") -> int:
        """Stored size of a table (or of some of its partitions), from the file system."""
        base = self.path(layer, name)
        paths = [f"{base}/{column}={p}" for p in partitions] if partitions else [self.location(layer, name)]
        total = 0
        for path in paths:
            fs, p = self._fs(path)
            if fs.exists(p):
                total += int(fs.getContentSummary(p).getLength())
        return total

    def bronze_runs(self, name: str) -> list[str]:
        return self.list_partitions("bronze", name)

    def read_bronze(self, name: str, run_ids: list[str] | None = None) -> DataFrame:
        """Bronze rows of the given runs (default: the latest run). Partition pruning keeps
        the scan to those runs. Rows of streams say in ``_drain`` which micro-batch (or the run itself) landed
        them: positions are unique within it."""
        runs = run_ids or self.bronze_runs(name)[-1:]
        if not runs:
            raise TableMissing(f"no bronze data for {name}")
        base = self.path("bronze", name)
        # runs may differ in columns: returned rows carry provenance, drains are cut by batch
        reader = self.spark.read.option("basePath", base).option("mergeSchema", "true")
        # list only the selected run partitions, not the table's whole history
        rows = reader.parquet(*[f"{base}/run_id={r}" for r in runs])
        return rows.withColumn(DRAIN, F.col("drain_batch").cast("string")).drop("drain_batch") if "drain_batch" in rows.columns else rows

    # ---- quarantine -------------------------------------------------------------------------
    def write_quarantine(self, rows: DataFrame, name: str, run_id: str) -> None:
        """Write a run's quarantine partition, replacing what an earlier attempt of the run left."""
        self.put_partition(rows.drop("run_id"), "quarantine", name, f"run_id={run_id}")

    def read_quarantine(self, name: str) -> DataFrame:
        """All batches; a column that came with a later one is null in the others."""
        if not self.list_partitions("quarantine", name):
            raise TableMissing(f"no quarantine data for {name}")
        return self.spark.read.option("mergeSchema", "true").parquet(self.path("quarantine", name))

    LEDGER_SCHEMA = T.StructType([T.StructField("dataset", T.StringType()),
                                  T.StructField("run_id", T.StringType()),
                                  T.StructField("processed_by", T.StringType()),
                                  T.StructField("processed_at", T.StringType())])

    def record_processed(self, name: str, run_ids: list[str], by_run: str, at: str) -> None:
        rows = [(name, r, by_run, at) for r in run_ids]
        df = self.spark.createDataFrame(rows, self.LEDGER_SCHEMA)
        self.append_json("quarantine", "_ledger", df)

    def read_ledger(self) -> DataFrame:
        return self.read_json("quarantine", "_ledger", self.LEDGER_SCHEMA)

    # ---- logs ------------------------------------------------------------------------------
    def append_json(self, layer: str, name: str, df: DataFrame) -> None:
        """Append records as a folder of their own: writers of one log do not meet in one."""
        df.coalesce(1).write.json(f"{self.path(layer, name)}/{uuid.uuid4().hex}")

    def read_json(self, layer: str, name: str, schema: str | T.StructType) -> DataFrame:
        """The records of a log: compacted ones, and those of folders that are not compacted yet."""
        if not self.exists(layer, name):
            return self.spark.createDataFrame([], schema)
        reader = (self.spark.read.schema(schema).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true"))
        compacted = self._compacted(layer, name, schema)
        if compacted is None:
            return reader.json(self.path(layer, name))
        done, folders = self._compacted_folders(layer, name, compacted), self._children(layer, name)
        rows = compacted.where(F.col(CORRUPT).isNull()).drop(CORRUPT, FOLDER)
        rest = [f"{self.path(layer, name)}/{f}" for f in folders if f not in done]
        return rows.unionByName(reader.json(rest)) if rest else rows

    def _compacted(self, layer: str, name: str, schema: str | T.StructType) -> DataFrame | None:
        table = f"{name}{COMPACTED}"
        if not self.exists(layer, table):
            return None
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        fields = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType()), T.StructField(FOLDER, T.StringType())])
        return self.spark.read.schema(fields).parquet(self.location(layer, table))

    def _compacted_folders(self, layer: str, name: str, compacted: DataFrame) -> set[str]:
        """Folders that still stand beside their compacted records: at most those of two passes."""
        found = [f for f in self._children(layer, name) if OF_RECORDS.fullmatch(f)]
        return {r[FOLDER] for r in compacted.where(F.col(FOLDER).isin(found)).select(FOLDER).distinct().collect()}

    def compact_log(self, layer: str, name: str, schema: str | T.StructType, least: int = 256) -> bool:
        """Once ``least`` folders wait, write their records and the compacted ones as the table's next version; lines that
        do not parse keep their text there. Readers see a record once: a folder counts until a version holds it. Folders
        go one pass later, for the sake of readers that began before, so a log lists at most twice ``least`` folders and
        the files of two versions. A pass that dies leaves the version before. One writer at a time: a lock that a dead
        job leaves stops compaction, nothing else, and gives way after LOCK_HOURS."""
        folders = [f for f in self._children(layer, name) if OF_RECORDS.fullmatch(f)]
        if len(folders) < least:
            return False
        fs, lock = self._fs(f"{self.path(layer, name)}{COMPACTED}.lock")
        if fs.exists(lock) and time.time() - fs.getFileStatus(lock).getModificationTime() / 1000 > LOCK_HOURS * 3600:
            fs.delete(lock, False)
        if not fs.createNewFile(lock):
            return False
        try:
            before = self._compacted(layer, name, schema)
            done = set() if before is None else self._compacted_folders(layer, name, before)
            todo = [f"{self.path(layer, name)}/{f}" for f in folders if f not in done]
            if len(todo) < least:
                return False
            fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
            rows = self.spark.read.schema(T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])).option(
                "columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", "true").json(todo)
            folder = F.regexp_extract(F.col("_metadata.file_path"), "/([0-9a-f]{32})/[^/]*$", 1)
            rows = rows.select("*", folder.alias(FOLDER))
            n_files = 1 + (0 if before is None else self.bytes_of(layer, f"{name}{COMPACTED}") >> 27)
            self.write((rows if before is None else before.unionByName(rows)).coalesce(n_files), layer, f"{name}{COMPACTED}", "parquet")
            for f in done:
                fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(layer, name)}/{f}"), True)
            return True
        finally:
            fs.delete(lock, False)
