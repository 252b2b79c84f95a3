"""Helpers shared by the operators: column picking, written tables, salted lookups."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII characters that separate words; ``bytes.split()`` splits at exactly these.
WHITESPACE = re.compile(rb"[\x20\x09-\x0D]")

#: Bytes of text that a per-document loop holds in Python objects at once.
BLOCK = 1 << 20

#: The folder of the tables that the block around takes away again (see :func:`own_tables`).
_own: ContextVar[str | None] = ContextVar("own", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **wanted: tuple[str, str]) -> DataFrame:
    """The columns ``out=(name, type)`` of ``df`` and no other.

    Picks by exact position, so extra columns may have any name, also one that
    differs from a wanted name in case only or that an operator uses itself."""
    place = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(place))])
    return plain.select(*[F.col(f"c{place.index(name)}").cast(kind).alias(out)
                          for out, (name, kind) in wanted.items()])


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="sluice-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor costs no more than its running tasks. Within
    :func:`own_tables` the table goes with the block, else when the driver ends."""
    own = _own.get()
    return _write(df, f"{own}/{uuid.uuid4().hex}-{name}") if own else keep(df, name)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`materialize`, for a table that outlives the block around it."""
    folder = f"{shared_dir(df.sparkSession)}/sluice-llm/{uuid.uuid4().hex}"
    system, place = _place(df.sparkSession, folder)
    out = _write(df, f"{folder}/{name}")
    system.deleteOnExit(place)
    return out


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def own_tables(spark: SparkSession) -> Iterator[None]:
    """What :func:`materialize` writes within the block is deleted at its end.

    The block must evaluate what it needs and :func:`keep` it. The folder is the block's
    own, so blocks in other threads, and lazy frames made before it, are not touched."""
    folder = f"{shared_dir(spark)}/sluice-llm/{uuid.uuid4().hex}"
    token = _own.set(folder)
    try:
        yield
    finally:
        _own.reset(token)
        system, place = _place(spark, folder)
        system.delete(place, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that the block runs hand ``rows`` rows at a time to Python, for rows that are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: A group is hot if it holds more than 1/1000 of all rows, so at most 1000 are.
HOT_SHARE = 1000
HOT_ROWS = 10_000
SALTS = 64


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int,
           spread: str, sizes: DataFrame | None = None) -> DataFrame:
    """Left-join each row to its group by ``key`` without one task per hot group.

    ``groups`` has one row per key and its number of rows in ``size``; ``total``
    is the number of rows. More than ``total / HOT_SHARE`` rows can be held by
    at most HOT_SHARE groups, so the list of hot keys has a proven bound and is
    broadcast; rows of hot keys are dealt by a hash of ``spread`` to SALTS
    copies of their group's row. ``sizes``: keys and sizes alone, where ``groups`` is dear to
    make twice."""
    least = max(HOT_ROWS, total // HOT_SHARE)
    hot = (groups if sizes is None else sizes).where(F.col(size) > least).select(key, F.lit(True).alias("__hot"))
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    left = (rows.join(F.broadcast(hot), key, "left")
            .withColumn("__salt", F.coalesce(salt, F.lit(0))).drop("__hot"))
    copies = F.when(F.col(size) > least, F.sequence(F.lit(0), F.lit(SALTS - 1)))
    right = groups.withColumn("__salt", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
    return left.join(right, [key, "__salt"], "left").drop("__salt")


def values(column: pa.Array) -> Iterator:
    """The values of a column one by one, so that a batch's texts are never all Python
    objects at once."""
    for value in column:
        yield value.as_py()


def word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of about BLOCK bytes, cut between words."""
    at = 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        if end < len(data):
            cut = WHITESPACE.search(data, end)
            end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end
