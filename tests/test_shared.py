"""Tables that only serve to make another one do not outlive it."""

import os

import pytest
from pyspark.sql import functions as F

from chunkloom.plans.ingest import ingest, linked_chunks
from chunkloom.queries import SMALL
from chunkloom.sources.shared import fresh, scratch, settled, stored
from chunkloom.streaming import jobs

TEXTS = ("# a\n\nsome words\n\n## b\n\n| x |\n| - |\n| 1 |\n", "plain text\n" * 200)


def tables(spark):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/tables"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_only_the_result_of_linked_chunks_stays(spark, md):
    before = tables(spark)
    out = linked_chunks(md(*TEXTS), use=SMALL)
    assert len(tables(spark) - before) == 1 and out.count() > 2


def test_a_batch_of_jobs_leaves_no_tables(spark, md):
    before, folder = tables(spark), fresh(spark, "jobs")
    docs = md(*TEXTS)
    docs.select(F.col("doc_id").alias("job_id"), "user_id", F.col("doc_id").alias("object_key")).write.json(f"{folder}/messages")
    made = jobs.run_jobs(jobs.job_stream(spark, f"{folder}/messages", 4), docs, lambda rows: ingest(rows, use=SMALL), f"{folder}/out", f"{folder}/checkpoint")
    assert made.points.current().count() > 2 and tables(spark) == before


def test_scratch_keeps_what_is_named_and_clears_up_after_errors(spark):
    before = tables(spark)
    out = settled(lambda: settled(lambda: stored(spark.range(5))).filter("id > 1"))
    assert out.count() == 3 and len(tables(spark) - before) == 1
    with pytest.raises(ValueError), scratch():
        stored(spark.range(3))
        raise ValueError
    assert len(tables(spark) - before) == 1
