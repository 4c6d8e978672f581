"""Intermediates that several reports use.

A report builds them lazily, so its filters reach the inputs and calling it
runs no job.  For a run of the whole suite ``materialize(tables)`` turns on
sharing for that set of inputs: each intermediate is then written once as
parquet in the shared checkpoint folder (``spark.checkpoint.dir``) and later
reports scan it.  The lineage is cut there and survives lost executors.  A
new ``Tables`` starts lazily again, so changed sources mean new inputs.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame

from deskpulse.session import ensure_checkpoint_dir


def materialize(t):
    """Share intermediates between the reports on ``t`` from now on."""
    t._small.setdefault("_shared", {})
    t._small.setdefault("_locks", defaultdict(threading.Lock))
    t._small.setdefault("_run_id", uuid.uuid4().hex[:12])
    return t


def shared(t, key: str, cfg, build: Callable[[], DataFrame]) -> DataFrame:
    """The intermediate ``key`` for this input set and configuration: built
    lazily, or, after ``materialize``, written on first use and scanned.
    Callers in several threads wait for the writer of their key only."""
    memo = t._small.get("_shared")
    if memo is None:
        return build()
    tag = key + "-" + hashlib.sha1(repr(cfg).encode()).hexdigest()[:10]
    with t._small["_locks"][tag]:
        if tag not in memo:
            df = build()
            spark = df.sparkSession
            base = ensure_checkpoint_dir(spark)
            if base is None:
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            path = f"{base.rstrip('/')}/deskpulse-shared/{spark.sparkContext.applicationId}/{t._small['_run_id']}/{tag}"
            df.write.mode("overwrite").parquet(path)
            memo[tag] = spark.read.parquet(path)
        return memo[tag]
