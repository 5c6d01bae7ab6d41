"""Exporting typed result tables as Parquet, by table and job."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidemill.sources.tables import Tables, bucket_of


#: Folders over which an export's jobs are dealt by hash. Part of the layout: a folder's later exports have to use the same number.
BUCKETS = 64
_READY = "_READY"


def _files(spark: SparkSession, at: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, at: str) -> list[str]:
    path, files = _files(spark, at)
    return sorted(x.getPath().getName() for x in files.listStatus(path)) if files.exists(path) else []


def _put(spark: SparkSession, path: str) -> None:
    """Put drafts that were whole in place of the folders that they are of, and delete the others. What a lost driver left half done goes on."""
    for draft in (f"{path}/{n}" for n in _names(spark, path) if n.startswith("_draft-")):
        at, files = _files(spark, draft)
        inside = _names(spark, draft)
        if _READY in inside:
            for name in (n for n in inside if n.startswith("job_bucket=")):
                files.delete(_files(spark, f"{path}/{name}")[0], True)
                if not files.rename(_files(spark, f"{draft}/{name}")[0], _files(spark, f"{path}/{name}")[0]):
                    raise OSError(f"can't put {draft}/{name} in place")
            for name in (n for n in _names(spark, path) if n.startswith("job=")):
                files.delete(_files(spark, f"{path}/{name}")[0], True)
        files.delete(at, True)


def export(rows: DataFrame, path: str) -> None:
    """Write a table over what the folder holds of the same jobs; other jobs keep their rows. Columns keep their types, also where all are null; no rows write nothing.

    Jobs are dealt over ``BUCKETS`` folders and stand sorted by job in their files, so the number of files does not grow with the number of jobs; a large bucket fills several
    files. Buckets of the new jobs are written again as a whole: as a draft, which is put in place once it is complete. An export whose driver is lost changes nothing before
    that, and is completed by the next one after it. One export at a time may write to a folder. Folders of single jobs (``job=...``), as earlier versions wrote, are taken over.

    The path is in any file system that Hadoop's clients reach (``s3a://bucket/folder`` too).
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    _put(spark, path)
    held, draft = _names(spark, path), f"{path}/_draft-{uuid.uuid4().hex}"

    def write(some: DataFrame) -> None:
        some = some.withColumn("job_bucket", bucket_of(F.col("job_id"), BUCKETS))
        some.hint("rebalance", F.col("job_bucket")).sortWithinPartitions("job_bucket", "job_id").write.mode("append").partitionBy("job_bucket").parquet(draft)

    try:
        write(rows)
        made = {n for n in _names(spark, draft) if n.startswith("job_bucket=")}
        old = [f"{path}/{n}" for n in held if made and (n in made or n.startswith("job="))]
        if old:
            # Other jobs of these buckets, with all the columns that they have.
            new = spark.read.parquet(draft).select("job_id").distinct()
            before = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(*old)
            write(before.join(new, before.job_id.eqNullSafe(new.job_id), "left_anti"))
        if made:
            _files(spark, draft)[1].create(_files(spark, f"{draft}/{_READY}")[0], True).close()
    finally:
        _put(spark, path)


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.root, self.attempt = options["path"].rstrip("/"), uuid.uuid4().hex

    def _files(self) -> tuple[pa.fs.FileSystem, str]:
        return pa.fs.FileSystem.from_uri(self.root)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        files, base = self._files()
        part, open_, made = uuid.uuid4().hex[:12], {}, []
        draft = f"{base}/_drafts/{self.attempt}"
        files.create_dir(draft, recursive=True)
        try:
            for batch in iterator:
                at = batch.column("job_id")
                edges = [0, *(i for i in range(1, len(at)) if at[i] != at[i - 1]), len(at)] if len(at) else [0]
                for a, b in zip(edges, edges[1:], strict=False):
                    job, own = at[a].as_py(), batch.slice(a, b - a)
                    if job not in open_:
                        while open_:  # rows are sorted by job
                            open_.popitem()[1].close()
                        name = f"{part}-{len(made)}.parquet"
                        made.append((f"{draft}/{name}", f"{base}/{quote(job, safe='')}/{name}"))
                        open_[job] = pa.parquet.ParquetWriter(made[-1][0], own.schema, filesystem=files)
                    open_[job].write_batch(own)
        finally:
            for writer in open_.values():
                writer.close()
        return _Written(made)

    def commit(self, messages: list[_Written | None]) -> None:
        """Put the files in place: of each job that was written, the old ones go."""
        files, base = self._files()
        made = [x for m in messages if m for x in m.files]
        for folder in sorted({to.rsplit("/", 1)[0] for _, to in made}):
            if files.get_file_info(folder).type == pa.fs.FileType.Directory:
                files.delete_dir_contents(folder)
            else:
                files.create_dir(folder, recursive=True)
        for draft, to in made:
            files.move(draft, to)
        self._forget(files, base)

    def abort(self, messages: list[_Written | None]) -> None:
        self._forget(*self._files())

    def _forget(self, files: pa.fs.FileSystem, base: str) -> None:
        for folder in (f"{base}/_drafts/{self.attempt}", f"{base}/_drafts"):
            info = files.get_file_info(folder)
            if info.type == pa.fs.FileType.Directory and (folder.endswith(self.attempt) or not files.get_file_info(pa.fs.FileSelector(folder))):
                files.delete_dir(folder)


class ObjectSink(DataSource):
    """A sink for stores that Arrow's file systems reach: ``df.write.format("tidemill_objects").mode("append").save("s3://bucket/folder?endpoint_override=...")``.

    Rows are sorted by ``job_id``; each job gets files of its own in a folder named by its id, in place of those that were there. Files are written as drafts and put in
    place once all are there; if a task fails for good the drafts go and nothing has changed.
    """

    @classmethod
    def name(cls) -> str:
        return "tidemill_objects"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)


def to_objects(rows: DataFrame, path: str, tasks: int = 64) -> None:
    """Export through ``ObjectSink``. A large job is dealt over several tasks, each of which writes a file of it."""
    rows.sparkSession.dataSource.register(ObjectSink)
    rows.repartitionByRange(tasks, "job_id", F.xxhash64(*rows.columns)).sortWithinPartitions("job_id").write.format("tidemill_objects").mode("append").save(path)


def finalize(tables: Tables, to: str, day: date, jobs: list[str] | None = None, since: datetime | None = None) -> DataFrame:
    """Export all typed tables, or some jobs of them: rows by ``table`` and ``job_id``. Jobs that only append get a folder for each day, so no day replaces another's.

    With ``since`` (UTC), only jobs that were saved after it are read and written: the log tells them, and only their buckets are opened.
    """
    modes, out = tables.read("api_job").select("job_id", F.coalesce("save_mode", F.lit("overwrite")).alias("mode")), None
    changed = None
    if since is not None:
        log = tables.read("api_job_log").filter((F.col("status") == "SUCCESS") & (F.col("executed_at") > F.lit(since).cast("timestamp_ntz")))
        changed = (log.filter(F.col("job_id").isin(jobs)) if jobs is not None else log).select("job_id").distinct()
    elif jobs is not None:
        changed = tables.spark.createDataFrame([(j,) for j in jobs], "job_id string")
    for name in tables.typed_tables():
        schema = tables.schemas[name]
        rows = tables.results(name) if changed is None else tables.rows_of_keys(name, changed)
        rows = rows.join(modes, "job_id", "left")
        plain = [f.name for f in schema if f.name not in ("id", "updated_at")]
        export(rows.filter("mode is null or mode = 'overwrite'").select(*plain), f"{to}/{name}/latest")
        export(rows.filter("mode != 'overwrite'").select(*plain), f"{to}/{name}/{day:%Y%m%d}")
        counts = rows.groupBy("job_id").agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "job_id", "n")
        out = counts if out is None else out.union(counts)
    return out
