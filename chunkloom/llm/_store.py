"""Shared-folder tables that cut lineage, and row identity.

Executors may vanish at any time, so nothing here keeps the only copy of an intermediate result on
one machine: a table written below ``spark.checkpoint.dir`` is visible to every executor and to the
driver.  The setting is read from the session; a local folder is made only where it is unset.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a new local one only where that is unset."""
    base = spark.conf.get(_SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="chunkloom-")
        spark.conf.set(_SETTING, base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/chunkloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a reader of it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._shared_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more.

    Spark's cleaner acts when the driver's garbage is collected; a long driver program with a small
    heap may not collect for half an hour, while finished shuffles fill the executors' disks.  A second
    round follows, as the first only frees what Python's references held on to.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, th, text)``: rows are known by id and a hash of the text, as ids may be null or repeat.

    Rows equal in both are one document read twice: they get equal results.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def same_doc(a: DataFrame, b: DataFrame):
    """Null-safe equality on the key of :func:`keyed`."""
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["th"] == b["th"])


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and all other columns in one struct, so that no operator's output clashes with them."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *rest).alias("_rest"))


def unpacked(df: DataFrame, docs: DataFrame, **instead) -> DataFrame:
    """The columns of ``docs`` from rows of :func:`packed`; ``instead`` gives new values by name."""
    own = {c: F.col(c) if c in ("doc_id", "text") else F.col(f"_rest.`{c}`") for c in docs.columns}
    return df.select(*[instead.get(c, v).alias(c) for c, v in own.items()])
