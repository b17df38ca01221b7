"""The shared folder, and lineage cuts through it."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local master, where all run in one process, may go without that setting (tests); elsewhere it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="confluo-"))
    return _LOCAL[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder as Parquet and read again: computed once, safe to lose executors."""
    path = f"{shared_dir(df.sparkSession)}/confluo/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def spent(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` gave and that nothing reads any more."""
    for df in tables:
        jvm, hadoop = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(df._written_to)
        where.getFileSystem(hadoop).delete(where, True)


#: Bytes of a batch that goes to a Python worker: texts may be long, and a batch is held whole on both sides.
BATCH = "4m"

_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for an application, so that their Python workers can import it, and bounds
    the batches they get.

    The driver serves the file from its own temporary folder, which goes with the driver."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    folder = _shipped[context.applicationId] = tempfile.TemporaryDirectory()
    target = f"{folder.name}/{top.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, f"{top.name}/{p.relative_to(top)}")
    context.addPyFile(target)


def map_arrow(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """mapInArrow, with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def bitmap(names: DataFrame, column: str, bits: int) -> np.ndarray:
    """A filter of fixed size, 2**bits bits, of the low bits of a long column: built by the executors, sent back once."""
    bit = F.col(column).bitwiseAND((1 << bits) - 1) + 1
    parts = names.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros(1 << bits >> 3, np.uint8)
    for p in parts.collect():
        some = np.frombuffer(p["bits"], np.uint8)
        out[(p["part"] - 1) * 4096 :][: len(some)] = some
    return out


def in_bitmap(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which of the longs may be in the bitmap; no member is missed."""
    at = names & (len(bits) * 8 - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
