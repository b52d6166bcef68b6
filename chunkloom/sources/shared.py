"""Tables in the folder that all executors share.

A step whose rows several later steps read is written once, so that it is neither computed again for
each reader nor lost with an executor.  The folder is ``spark.checkpoint.dir``; a local one is made only
where that is unset.  Tables that only serve to make another one go when that is written (:func:`settled`,
:func:`scratch`), so that a long plan does not hold every step's copy of the texts at once.
"""

from __future__ import annotations

import gc
import tempfile
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scope = threading.local()


def fresh(spark: SparkSession, kind: str) -> str:
    """The path of a new folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="chunkloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet, and a reader of it; such a reader is given back as it is."""
    if getattr(df, "_stored_at", None):
        return df
    spark = df.sparkSession
    path = fresh(spark, "tables")
    if (own := getattr(_scope, "tables", None)) is not None:
        own[path] = spark
    df.write.parquet(path, compression="zstd")
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


@contextmanager
def scratch() -> Iterator[set[str]]:
    """Deletes the tables stored inside, but those whose paths are put into the set given; shuffle files of finished steps go too."""
    outer, own, kept = getattr(_scope, "tables", None), {}, set()
    _scope.tables = own
    try:
        yield kept
    finally:
        _scope.tables = outer
        if outer is not None:
            outer.update({p: s for p, s in own.items() if p in kept})
        for path, spark in own.items():
            if path not in kept:
                at = spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        for spark in set(own.values()):
            _release(spark)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``make`` gives, stored; what ``make`` stored on the way is deleted."""
    with scratch() as kept:
        out = stored(make())
        kept.add(out._stored_at)
    return out


def _release(spark: SparkSession) -> None:
    """Spark drops the shuffle files of plans that nothing refers to when the driver's garbage is collected, which may be late."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
