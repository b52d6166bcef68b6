"""The ingest job as a stream of job messages.

Delivery: a message takes effect once.  The checkpoint repeats a batch that did not end, and a batch's points,
job records and messages are versions of keyed tables that a repeated batch overwrites; a document that comes
again replaces its points.

Defined cases: messages that repeat a job are one; a document that is missing, empty or makes the ingest fail
ends as failed with its reason, and the others go on; null ids fail; an empty stream writes nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from chunkloom.plans.ingest import rejected
from chunkloom.sources import sinks
from chunkloom.sources.files import JOB
from chunkloom.sources.shared import scratch, settled, stored

MOST_FAILURES = 64
Ingest = Callable[[DataFrame], DataFrame]


def job_stream(spark: SparkSession, path: str, per_trigger: int = 1) -> DataFrame:
    """Job messages from JSON files that arrive in a folder."""
    return spark.readStream.schema(JOB).option("maxFilesPerTrigger", per_trigger).json(path)


def fetched(jobs: DataFrame, documents: DataFrame) -> DataFrame:
    """Jobs with their documents by ``object_key``; ``markdown`` is null where there is none."""
    wanted = jobs.dropDuplicates(["job_id"]).select("job_id", "user_id", F.col("object_key").alias("doc_id"))
    return wanted.join(documents.drop("user_id").dropDuplicates(["doc_id"]), "doc_id", "left")


class JobTables:
    """What the jobs leave below a folder: points, states, records, messages of ended jobs, status callbacks."""

    def __init__(self, spark: SparkSession, out: str, vector_size: int, replace: bool = True):
        self.points = sinks.PointSink(spark, f"{out}/store", vector_size, replace)
        self.states = sinks.KeyedTable(spark, f"{out}/states", ["job_id", "status"])
        self.records = sinks.KeyedTable(spark, f"{out}/records", ["id", "user_id"])
        self.finished, self.failed = (sinks.KeyedTable(spark, f"{out}/{q}", ["job_id"]) for q in ("finished", "failed"))
        self.callbacks = sinks.KeyedTable(spark, f"{out}/callbacks", ["id", "stage"])

    def status(self) -> DataFrame:
        """The last state of each job: started, then done or failed."""
        rank = F.when(F.col("status") == "started", 0).otherwise(1)
        return sinks.latest(self.states.current().withColumn("_at", F.struct("version_at", rank)), ["job_id"], "_at").drop("_at", "version_at")


def _ingested(found: DataFrame, ingest: Ingest, tables: JobTables, number: int) -> tuple[list[str], dict[str, str]]:
    """Points of a batch's documents, written; ``(bad, reasons)``: where the whole fails, halves are tried, down to single documents.

    Only ids are held here, those of a batch of ``maxFilesPerTrigger`` files of messages.  After ``MOST_FAILURES`` failed
    tries the fault is not a document's: what is left fails with it.
    """
    error, said = True, ""
    try:
        made = settled(lambda: ingest(found))
        error, said = tables.points.upsert(made, number)
    except Exception as bad:  # noqa: BLE001  one document must not end the others
        said = str(bad)
    if not error:
        return [], {}
    ids = [r.doc_id for r in found.select("doc_id").distinct().collect()]
    if len(ids) <= 1:
        return ids, {i: said[:500] for i in ids}
    good, reasons, failures = None, {}, 0
    parts = [ids[: len(ids) // 2], ids[len(ids) // 2 :]]
    while parts:
        some = parts.pop()
        if failures >= MOST_FAILURES:
            reasons |= {i: said[:500] for i in some}
            continue
        try:
            made = settled(lambda: ingest(found.filter(F.col("doc_id").isin(some))))
            good = made if good is None else good.unionByName(made)
        except Exception as bad:  # noqa: BLE001
            failures, said = failures + 1, str(bad)
            if len(some) == 1:
                reasons[some[0]] = said[:500]
            else:
                parts += [some[: len(some) // 2], some[len(some) // 2 :]]
    if good is not None:
        error, said = tables.points.upsert(good, number)
        if error:
            reasons = {i: said for i in ids}
    return list(reasons), reasons


def run_jobs(stream: DataFrame, documents: DataFrame, ingest: Ingest, out: str, checkpoint: str, vector_size: int = 64, go_on: Callable[[], bool] | None = None, poll: float = 0.5) -> JobTables:
    """Ingest the documents that the messages name, then stop; earlier where ``go_on()`` (such as a file's presence) is false.

    Every job is recorded as started, then as done or failed, with one message for the finished or the failed queue.
    """
    spark = stream.sparkSession
    tables = JobTables(spark, out, vector_size)

    def one(batch: DataFrame, number: int) -> None:
        with scratch():  # a batch's tables go with it, what it leaves is in its keyed tables
            run_batch(batch, number)

    def run_batch(batch: DataFrame, number: int) -> None:
        found = stored(fetched(batch, documents))
        began = F.lit(time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime())).cast("timestamp")
        started = found.select("job_id", "user_id", "doc_id", F.lit("started").alias("status"), F.lit(None).cast("string").alias("msg"), F.lit(number).alias("version_at"))
        tables.states.upsert(stored(started), 2 * number)
        good = found.filter("markdown is not null").drop("job_id")
        refused = {r.doc_id: r.error for r in rejected(good).collect()}
        fine = good.filter(~F.col("doc_id").isin(list(refused))) if refused else good
        bad, reasons = _ingested(fine, ingest, tables, number) if not fine.isEmpty() else ([], {})
        reasons = refused | reasons
        reason: Column = F.when(F.col("markdown").isNull(), "no such document")
        for doc, said in reasons.items():
            reason = reason.when(F.col("doc_id").eqNullSafe(F.lit(doc)), said)
        ended = found.select("job_id", "user_id", "doc_id", reason.alias("why"))
        ended = ended.select("job_id", "user_id", "doc_id", F.when(F.col("why").isNull(), "done").otherwise("failed").alias("status"), F.coalesce("why", F.lit("success")).alias("msg"))
        ended = stored(ended.withColumn("version_at", F.lit(number)))
        tables.states.upsert(ended, 2 * number + 1)
        tables.records.upsert(sinks.log_record(ended, began, F.current_timestamp()), number)
        for table, rows in zip((tables.finished, tables.failed), sinks.notifications(ended)):
            table.upsert(rows, number)
        tables.callbacks.upsert(sinks.callbacks(ended, "embedding"), number)

    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    while not query.awaitTermination(poll):
        if go_on is not None and not go_on():
            query.stop()
            break
    return tables


class Heartbeat(StreamingQueryListener):
    """Counts progress reports; a worker is alive while the count rises."""

    def __init__(self):
        self.beats, self.errors, self.last, self.running = 0, [], 0.0, False

    def _beat(self):
        self.beats, self.last, self.running = self.beats + 1, time.monotonic(), True

    def alive(self, within: float = 30.0) -> bool:
        """Whether a report came within so many seconds and no query has ended since."""
        return self.running and time.monotonic() - self.last <= within

    def onQueryStarted(self, event):
        self._beat()

    def onQueryProgress(self, event):
        self._beat()

    def onQueryIdle(self, event):
        self._beat()

    def onQueryTerminated(self, event):
        self.running = False
        if event.exception:
            self.errors.append(event.exception)
