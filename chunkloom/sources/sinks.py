"""Points, keyed upserts, logs, notifications and dumps as Parquet and JSON tables.

Defined cases: of rows that agree in key and version any one stays, the same in each run; null keys are a key;
columns beyond those named are kept; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.functions import dates

# Keys that every chunk must have before it is embedded, and the payload's columns.
REQUIRED_KEYS = (
    "doc_id", "source", "title", "level", "chunk_type", "primary_type", "has_text", "has_code", "has_table", "split_group_id", "content", "token_count",
    "parent_chunk_id", "parent_titles", "prev_chunk_id", "next_chunk_id", "sibling_chunk_ids", "kb_ids",
)
PAYLOAD = (*REQUIRED_KEYS, "summary")


def with_payload_defaults(chunks: DataFrame) -> DataFrame:
    """Defaults for what a chunk may lack: type flags from its type, no knowledge bases, an empty summary."""
    kind = F.col("chunk_type")
    own = {
        "primary_type": kind, "has_text": kind == "text", "has_code": kind == "code", "has_table": kind == "table",
        "split_group_id": F.lit(None).cast("int"), "kb_ids": F.lit(None).cast("array<string>"), "summary": F.lit(""),
    }
    return chunks.withColumns({c: v if c not in chunks.columns else F.coalesce(F.col(c), v.cast(chunks.schema[c].dataType)) for c, v in own.items()})


def first_missing_key(columns: list[str]) -> str | None:
    return next((k for k in REQUIRED_KEYS if k not in columns), None)


def points(chunks: DataFrame) -> DataFrame:
    """``collection, id, payload`` of linked chunks with ``user_id``, and their vectors where they have some."""
    rows = with_payload_defaults(chunks)
    if missing := first_missing_key(rows.columns):
        raise ValueError(f"missing key: {missing}")
    vectors = [c for c in ("vector", "embed_ok", "sparse") if c in rows.columns]
    return rows.select(F.col("user_id").alias("collection"), F.col("chunk_id").alias("id"), F.struct(*PAYLOAD).alias("payload"), *vectors)


def latest(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row of highest ``version`` for each key: the state after upserts in that order."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(version)))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


class KeyedTable:
    """Rows by key in Parquet: each version is a folder that a repeated write overwrites, the latest version of a key counts.

    So a write that is tried again after a lost driver changes nothing, and no reader sees half of one.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys

    def upsert(self, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/version={version}")

    def exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return files.exists(path) and len(files.listStatus(path)) > 0

    def current(self) -> DataFrame:
        rows = self.spark.read.option("mergeSchema", True).option("basePath", self.path).parquet(f"{self.path}/version=*")
        return latest(rows, self.keys, "version").drop("version")


class PointSink:
    """Collections of points with vectors, by ``collection, id``; ``replace`` drops a re-ingested document's older points.

    ``upsert`` gives ``(error, message)`` as an external store's client would.
    """

    def __init__(self, spark: SparkSession, path: str, size: int, replace: bool = False):
        self.table, self.documents = KeyedTable(spark, f"{path}/points", ["collection", "id"]), KeyedTable(spark, f"{path}/documents", ["collection", "doc_id"])
        self.path, self.size, self.replace, self.spark = path, size, replace, spark

    def collections(self) -> DataFrame:
        """Each collection's configuration: cosine distance, vector size, and the payload's keyword indexes."""
        names = self.table.current().select("collection").distinct()
        return names.select("collection", F.lit("cosine").alias("distance"), F.lit(self.size).alias("size"), F.array(F.lit("doc_id"), F.lit("kb_ids")).alias("indexes"))

    def upsert(self, point_rows: DataFrame, version: int, batch: int = 250) -> tuple[bool, str]:
        """Writes points in batches of ``batch`` of a collection, sorted by document so that a reader skips the others' row groups."""
        try:
            rows = point_rows.withColumn("_doc", F.col("payload.doc_id"))
            self.table.upsert(rows.repartition("collection", "_doc").sortWithinPartitions("collection", "_doc").drop("_doc"), version)
            self.documents.upsert(point_rows.select("collection", F.col("payload.doc_id").alias("doc_id")).distinct().withColumn("since", F.lit(version)), version)
        except Exception as error:  # noqa: BLE001  the caller is told, as by a remote store
            return True, str(error)[:500]
        return False, "success"

    def current(self) -> DataFrame:
        if not self.replace:
            return self.table.current()
        rows = self.spark.read.option("basePath", f"{self.path}/points").parquet(f"{self.path}/points/version=*")
        last = self.documents.current().withColumnRenamed("doc_id", "_doc").withColumnRenamed("collection", "_c")
        own = rows["collection"].eqNullSafe(last["_c"]) & F.col("payload.doc_id").eqNullSafe(last["_doc"]) & (rows["version"] == last["since"])
        return latest(rows.join(last, own, "left_semi"), ["collection", "id"], "version").drop("version")


def log_record(rows: DataFrame, start: Column, end: Column) -> DataFrame:
    """Job records ``id, user_id, doc, task{error, msg}, time{start, elapsed, end, tz}`` of ``rows(job_id, user_id, doc_id, status, msg)``."""
    a, b = dates.local_time(start), dates.local_time(end)
    time = F.struct(a.alias("start"), dates.elapsed(a, b).alias("elapsed"), b.alias("end"), F.lit(dates.ZONE).alias("tz"))
    task = F.struct((F.col("status") != "done").alias("error"), F.col("msg").alias("msg"))
    return rows.select(F.col("job_id").alias("id"), "user_id", F.col("doc_id").alias("doc"), task.alias("task"), time.alias("time"))


def notifications(status: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(finished, failed)``: one message for each job that has ended, for its queue."""
    body = F.to_json(F.struct("job_id"))
    ended = status.filter(F.col("status").isin("done", "failed")).select("job_id", "status", body.alias("body"))
    return ended.filter("status = 'done'").drop("status"), ended.filter("status = 'failed'").drop("status")


def callbacks(status: DataFrame, stage: str) -> DataFrame:
    """Status messages ``type, id, user-id, stage, jobSuccessful`` of jobs that have ended, one a stage."""
    ended = status.filter(F.col("status").isin("done", "failed"))
    return ended.select(F.lit("document").alias("type"), F.col("job_id").alias("id"), F.col("user_id").alias("user-id"), F.lit(stage).alias("stage"), (F.col("status") == "done").alias("jobSuccessful"))


def dump_json(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines, to look at."""
    rows.write.mode("overwrite").json(path)


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with rows of equal keys replaced and the others of ``new`` added."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def inserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` and the rows of ``new`` whose keys it lacks."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))


def replaced(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with rows replaced where ``new`` has their keys; other rows of ``new`` are not added."""
    known = new.join(old.select(*keys), keys, "left_semi")
    return old.join(known.select(*keys), keys, "left_anti").unionByName(known)


def batches(rows: DataFrame, key: str, size: int = 250, parts: int = 1) -> DataFrame:
    """``batch``: number of the group of ``size`` rows that a row is sent in, by collection.

    With ``parts`` a collection's rows are numbered in so many stretches of keys' hashes, so that no task sees all of a
    large one; ``batch`` then counts within ``part``.
    """
    if parts == 1:
        place = F.row_number().over(W.partitionBy("collection").orderBy(key)) - 1
        return rows.withColumn("batch", F.floor(place / size).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    place = F.row_number().over(W.partitionBy("collection", "part").orderBy(key)) - 1
    return rows.withColumn("batch", F.floor(place / size).cast("int"))


def send(rows: DataFrame, key: str, post: Callable[[list], None], size: int = 250) -> None:
    """Posts rows to an external store in batches of ``size`` from each partition."""

    def run(part):
        held = []
        for row in part:
            held.append(row.asDict(True))
            if len(held) == size:
                post(held)
                held = []
        if held:
            post(held)

    rows.repartition("collection", key).foreachPartition(run)
