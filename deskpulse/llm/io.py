"""Reading tables and cutting lineage in the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; a
    scratch folder is made only where that setting is absent (tests), and
    only for a single-machine master. The copy survives lost executors.
    """
    scratch_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@contextlib.contextmanager
def shuffles_given_back(spark: SparkSession):
    """Shuffle files of tables that are made and run (``cut``) in here go when they have run (a session setting, put back at the end).

    Spark keeps them until the driver happens to collect its garbage; an operator of several wide steps would
    hold all their files at once until then.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def release(spark: SparkSession) -> None:
    """Lets Spark see which checkpoints nothing refers to any more; it deletes them where the session says so."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder (see ``cut``), for tables that a job writes and reads again."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="deskpulse-"))
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lets Spark hand Python at most ``rows`` rows at a time from now on (a session setting; smaller values stay).

    Operators work through a batch in slices, so larger batches only cost memory: with whole texts, Spark's 10,000 rows
    lie several times over in the executor and in its Python workers.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def tidy(run):
    """``run`` for ``mapInArrow``; at its end the worker gives freed memory back to the system.

    Python workers live on between tasks and stages, and what one task needed for its longest
    texts would otherwise stay with each of them.
    """

    def tidied(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return tidied


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))
