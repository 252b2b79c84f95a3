"""Governed source files: listing, eligibility, identity.

Executors list the contract directories, one row per entry, and hash the files in small
reads, so no file's content is ever a row. Files lie where every executor can open them: a
shared file system, or a store that pyarrow knows. A stream's files come as rows
with content instead (:func:`files_from_binary`)."""

from __future__ import annotations

import hashlib
import os
import re
import stat
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.contracts import BUILT_IN_REGISTRY, ContractRegistry
from sluice.session import ensure_checkpoint_dir

#: Bytes of a file read at once for its hash, and entries of one batch of a listing.
HASH_BYTES = 64 << 10
BATCH = 4096

_LOCAL = re.compile(r"\A(?:file:(?://)?)?(/.*)\Z", re.DOTALL)


def local_path(path: str) -> str | None:
    """The plain path of a file URI or absolute path; None for other stores."""
    found = _LOCAL.match(path)
    return found[1] if found else None


def _store(path: str):
    """The pyarrow file system of a URI and the path in it."""
    from pyarrow import fs
    scheme, rest = path.split("://", 1)
    authority, _, place = rest.partition("/")
    system, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, f"{root.rstrip('/')}/{place}"


def open_bytes(path: str) -> BinaryIO:
    """A file for reading, from any executor."""
    local = local_path(path)
    if local is not None:
        return open(local, "rb", buffering=1 << 20)
    import io
    system, place = _store(path)
    return io.BufferedReader(system.open_input_file(place), 1 << 20)


def file_sha256(path: str) -> str:
    digest = hashlib.sha256()
    with open_bytes(path) as file:
        while some := file.read(HASH_BYTES):
            digest.update(some)
    return digest.hexdigest()


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def eligible_name(name: Column | str) -> Column:
    """Exactly ``.csv``, not starting with ``.``/``~``/``#``, not ending ``~``."""
    n = _col(name)
    return n.endswith(".csv") & ~n.rlike("\\A[.~#]") & ~n.endswith("~") & (F.length(n) > 4)


def content_sha256(content: Column | str) -> Column:
    """Lowercase SHA-256 hex of the exact bytes (BOM and CRLF included)."""
    return F.sha2(_col(content), 256)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark's file sources print it: scheme, authority and absolute path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(place).toString().rstrip("/")


def source_identifier(path: Column | str, root: str) -> Column:
    """The POSIX path relative to ``root``; null when outside it.

    Both are compared in their qualified form (see :func:`qualified`)."""
    prefix = root.rstrip("/") + "/"
    p = _col(path)
    return F.when(p.startswith(prefix), F.substring(p, len(prefix) + 1, 1 << 20))


def source_identity(contract_id: Column | str, contract_version: Column | str,
                    source_path: Column | str, content_hash: Column | str) -> Column:
    """SHA-256 of the compact JSON payload with keys in sorted order."""
    payload = F.to_json(F.struct(
        _col(content_hash).alias("content_sha256"),
        _col(contract_id).alias("contract_id"),
        _col(contract_version).cast("int").alias("contract_version"),
        _col(source_path).alias("source_path"),
    ))
    return F.sha2(F.encode(payload, "UTF-8"), 256)


# Why a contract's directory cannot be listed.
MISSING_ROOT = "missing_root"
MISSING_DIRECTORY = "missing_directory"
NOT_A_DIRECTORY = "not_a_directory"
SYMBOLIC_LINK = "symbolic_link"
OUTSIDE_ROOT = "outside_root"
SOURCE_ACCESS = "source_access"

LISTING_SCHEMA = ("source_identifier string, contract_id string, contract_version int, length long, "
                  "content_sha256 string, source_id string, path string")
ENTRY_SCHEMA = ("directory string, name string, path string, type string, is_link boolean, resolved string, "
                "length long, failure string")
_ENTRIES = pa.schema([("directory", pa.string()), ("name", pa.string()), ("path", pa.string()), ("type", pa.string()),
                      ("is_link", pa.bool_()), ("resolved", pa.string()), ("length", pa.int64()), ("failure", pa.string())])


def _local_state(root: str, directory: str) -> str | None:
    """Why a directory under a root cannot be listed; None if it can."""
    if not os.path.exists(root):
        return MISSING_ROOT
    if os.path.islink(root):
        return SYMBOLIC_LINK
    if not os.path.isdir(root):
        return NOT_A_DIRECTORY
    place = os.path.join(root, directory)
    if not os.path.exists(place):
        return MISSING_DIRECTORY
    step = root
    for part in directory.split("/"):
        step = os.path.join(step, part)
        if os.path.islink(step):
            return SYMBOLIC_LINK
    if not os.path.isdir(place):
        return NOT_A_DIRECTORY
    inside = os.path.realpath(place).startswith(os.path.realpath(root).rstrip("/") + "/")
    return None if inside else OUTSIDE_ROOT


def _local_entries(root: str, directory: str) -> Iterator[tuple]:
    """Name, path, type, is_link, resolved path and length of every entry."""
    for entry in os.scandir(os.path.join(root, directory)):
        try:
            found = entry.stat()  # of what a link points to
        except OSError:
            found = None
        kind = ("lost" if found is None else "file" if stat.S_ISREG(found.st_mode)
                else "directory" if stat.S_ISDIR(found.st_mode) else "other")
        yield (entry.name, entry.path, kind, entry.is_symlink(), os.path.realpath(entry.path),
               found.st_size if found else None)


def _store_state(root: str, directory: str) -> str | None:
    from pyarrow import fs
    for path, missing in ((root, MISSING_ROOT), (f"{root}/{directory}", MISSING_DIRECTORY)):
        system, place = _store(path)
        kind = system.get_file_info(place).type
        if kind != fs.FileType.Directory:
            return missing if kind == fs.FileType.NotFound else NOT_A_DIRECTORY
    return None


def _store_entries(root: str, directory: str) -> Iterator[tuple]:
    """The same in a store; these have no links."""
    from pyarrow import fs
    system, place = _store(f"{root}/{directory}")
    kinds = {fs.FileType.File: "file", fs.FileType.Directory: "directory"}
    for info in system.get_file_info(fs.FileSelector(place)):
        path = f"{root}/{directory}/{info.base_name}"
        yield info.base_name, path, kinds.get(info.type, "other"), False, path, info.size


def directory_entries(spark: SparkSession, root: str, registry: ContractRegistry = BUILT_IN_REGISTRY) -> DataFrame:
    """One row per entry of every contract directory, listed by executors.

    Columns: :data:`ENTRY_SCHEMA`. A directory that cannot be listed gives one row with its
    ``failure`` and no name. ``resolved`` is the path without links."""
    root = qualified(spark, root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = local_path(root)
        state, entries = (_local_state, _local_entries) if local is not None else (_store_state, _store_entries)
        base = root if local is None else local
        scheme = "" if local is None else root[:len(root) - len(local)]
        for batch in batches:
            for directory in batch.column(0).to_pylist():
                out: list[tuple] = []
                try:
                    failure = state(base, directory)
                    if failure is None:
                        for name, path, *rest in entries(base, directory):
                            out.append((directory, name, scheme + path, *rest, None))
                            if len(out) == BATCH:
                                yield pa.RecordBatch.from_pylist([dict(zip(_ENTRIES.names, r, strict=True)) for r in out], _ENTRIES)
                                out = []
                except OSError:
                    failure = SOURCE_ACCESS
                if failure is not None:
                    out.append((directory, None, None, None, None, None, None, failure))
                yield pa.RecordBatch.from_pylist([dict(zip(_ENTRIES.names, r, strict=True)) for r in out], _ENTRIES)

    directories = registry.to_frame(spark).select("directory").distinct()
    return directories.repartition(len(registry.contracts)).mapInArrow(run, ENTRY_SCHEMA)


def discovery_failures(spark: SparkSession, root: str,
                       registry: ContractRegistry = BUILT_IN_REGISTRY) -> DataFrame:
    """One row per contract whose directory cannot be listed, or which holds an
    eligible name that is a link.

    Columns: source_identifier (the directory), contract_id, contract_version, source_id
    (of the directory, so that a verdict can be joined), failure_category."""
    return _failures(directory_entries(spark, root, registry), spark, registry)


def _failures(entries: DataFrame, spark: SparkSession, registry: ContractRegistry) -> DataFrame:
    link = F.when(eligible_name("name") & F.col("is_link"), F.lit(SYMBOLIC_LINK))
    bad = entries.groupBy("directory").agg(F.max(F.coalesce("failure", link)).alias("failure_category"))
    found = registry.to_frame(spark).select("directory", "contract_id", "contract_version").join(
        F.broadcast(bad.where("failure_category is not null")), "directory")  # a row per registered contract
    return found.select(F.col("directory").alias("source_identifier"), "contract_id", "contract_version", source_identity(
        "contract_id", "contract_version", "directory", F.lit(None).cast("string")).alias("source_id"),
        "failure_category")


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            try:
                found = file_sha256(path)
            except OSError:  # the parser reports it
                found = None
            yield pa.RecordBatch.from_pydict({"path": [path], "content_sha256": [found]}, pa.schema(
                [("path", pa.string()), ("content_sha256", pa.string())]))


def list_source_files(spark: SparkSession, root: str,
                      registry: ContractRegistry = BUILT_IN_REGISTRY) -> DataFrame:
    """S1 + S3 + S5 - S7: the regular files directly in every listable contract directory whose
    names are eligible, with contract, hash and identity columns (:data:`LISTING_SCHEMA`).

    Directories that cannot be listed, or hold an eligible link, give no rows here and one
    row each in :func:`discovery_failures`. The listing is checkpointed, so files are hashed
    once; each is one task's work, which holds HASH_BYTES of it."""
    ensure_checkpoint_dir(spark)
    entries = directory_entries(spark, root, registry).checkpoint()
    good = entries.join(F.broadcast(_failures(entries, spark, registry).select(
        F.col("source_identifier").alias("directory"))), "directory", "left_anti")
    good = good.where(eligible_name("name") & (F.col("type") == "file"))
    files = good.join(F.broadcast(registry.to_frame(spark).select("directory", "contract_id", "contract_version")), "directory")
    paths = files.select("path").distinct()
    hashes = paths.repartition(max(1, min(int(paths.count()), 100_000))).mapInArrow(
        _hashes, "path string, content_sha256 string")
    files = files.join(hashes, "path").withColumn("source_identifier", F.concat_ws("/", "directory", "name"))
    return files.withColumn("source_id", source_identity(
        "contract_id", "contract_version", "source_identifier", "content_sha256")).select(
        *[c.split()[0] for c in LISTING_SCHEMA.split(", ")]).checkpoint()


def files_from_binary(raw: DataFrame, root: str, registry: ContractRegistry = BUILT_IN_REGISTRY) -> DataFrame:
    """S1-S7 over a ``binaryFile`` frame (batch or streaming): the listing with a content column."""
    spark = raw.sparkSession
    root = qualified(spark, root)
    reg = F.broadcast(registry.to_frame(spark).select(
        F.col("directory").alias("_dir"), "contract_id", "contract_version"))
    rel = source_identifier("path", root)
    name = F.regexp_extract(rel, "([^/]*)\\z", 1)
    parent = F.regexp_extract(rel, "\\A(.*)/[^/]*\\z", 1)
    files = (
        raw.select(rel.alias("source_identifier"), name.alias("_name"),
                   parent.alias("_parent"), "length", "path", "content")
        .where(eligible_name("_name"))
        .join(reg, F.col("_parent") == F.col("_dir"), "inner")
    )
    out = files.select(
        "source_identifier", "contract_id", "contract_version", "length",
        content_sha256("content").alias("content_sha256"),
        "path", "content",
    ).withColumn("source_id", source_identity(
        "contract_id", "contract_version", "source_identifier", "content_sha256"))
    return out.select(*[c.split()[0] for c in LISTING_SCHEMA.split(", ")], "content")


def discover_sources(spark: SparkSession, root: str,
                     registry: ContractRegistry = BUILT_IN_REGISTRY) -> DataFrame:
    """S1 + O1: the eligible files ordered by relative path.

    Raises if a contract's directory cannot be listed; see
    :func:`discovery_failures` for the same finding as rows (one per contract)."""
    bad = {r["source_identifier"]: r["failure_category"] for r in discovery_failures(spark, root, registry).collect()}
    if bad:
        raise FileNotFoundError(f"source directories cannot be listed: {bad}")
    return list_source_files(spark, root, registry).orderBy("source_identifier")


def select_sources(requests: DataFrame, listing: DataFrame, request_col: str = "requested_path",
                   entries: DataFrame | None = None) -> DataFrame:
    """Every requested path must match exactly one discovered file.

    Returns the requests, repeated ones as often as given, with ``match_count`` and
    ``selection`` = ``SELECTED`` or ``source_selection`` (the failure category). With the
    ``entries`` of :func:`directory_entries` a request for a link is refused even if what
    it points to was discovered."""
    found = listing.groupBy(F.col("source_identifier").alias("_sid")).agg(
        F.count(F.lit(1)).alias("match_count"))
    out = requests.join(found, F.col(request_col) == F.col("_sid"), "left").drop("_sid")
    out = out.withColumn("match_count", F.coalesce("match_count", F.lit(0).cast("long")))
    fits = F.col("match_count") == 1
    if entries is not None:
        links = entries.where("is_link").select(F.concat_ws("/", "directory", "name").alias("_link")).distinct()
        out = out.join(links, F.col(request_col) == F.col("_link"), "left")
        fits = fits & F.col("_link").isNull()
    out = out.withColumn("selection", F.when(fits, F.lit("SELECTED")).otherwise(F.lit("source_selection")))
    return out.drop("_link")
