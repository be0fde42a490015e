"""Writers and registry snapshots (SNK4/SNK5 results, T9).

A retried task or a re-run job rewrites the same files; registry snapshots are
replaced only by a run with the same key.  Nothing is ever written over a path
the same plan reads from.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import re
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memberpulse.session import child_names, path_exists, qualified, remove_path, replace_path

# The function that copies files travels to executors by value, so a job needs no copy of the library there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Versions of a published report that stay readable.
KEEP_VERSIONS = 2


def overwrite_report(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    """SNK1: replace the whole report table, a path (with a ``/``) or a catalog name.

    The rows are written aside and moved in when they are complete, so a run that fails
    leaves the report as it was; what such a run left aside is overwritten by the next.
    A reader between the removal and the move finds no table: see :func:`publish_report`.
    """
    aside = f"{target.rstrip('/')}__next"
    if "/" in target:
        df.write.mode("overwrite").format(fmt).save(aside)
        replace_path(df.sparkSession, aside, target.rstrip("/"))
    else:
        df.write.mode("overwrite").format(fmt).saveAsTable(aside)
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {target}")
        df.sparkSession.sql(f"ALTER TABLE {aside} RENAME TO {target}")


# --- reports in versions --------------------------------------------------------------------

def _versions(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n[1:]) for n in child_names(spark, folder) if re.fullmatch(r"v\d+", n))


def _complete(spark: SparkSession, folder: str) -> list[int]:
    return [v for v in _versions(spark, folder) if path_exists(spark, f"{folder}/v{v:08d}/_SUCCESS")]


def _version_folder(spark: SparkSession, target: str) -> str:
    """Where a report's versions lie: the path itself, or beside the tables of a view's database."""
    if "/" in target:
        return target.rstrip("/")
    database, name = ([spark.catalog.currentDatabase()] + target.split("."))[-2:]
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}__versions"


def publish_report(df: DataFrame, target: str, fmt: str = "parquet", keep: int = KEEP_VERSIONS) -> str:
    """SNK1 without a gap: write the next version of a report, then switch to it in one step.

    ``target``: a path (with a ``/``), read by :func:`read_report`, or the name of a catalog
    view.  A version is a folder of its own.  For a path the one step is the marker that the
    committer writes last; for a name it is the replacement of the view.  Readers before it
    see the former version, readers after it the new one, and a run that fails anywhere
    leaves the report as it was.  The last ``keep`` versions stay for readers that still use
    them.  Two runs at once write versions of different numbers, or one of them fails.
    Returns the version's path.
    """
    spark, folder = df.sparkSession, _version_folder(df.sparkSession, target)
    number = max(_versions(spark, folder), default=0) + 1
    path = f"{folder}/v{number:08d}"
    df.write.mode("errorifexists").format(fmt).save(path)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        raise OSError(f"{path} has no _SUCCESS marker: mapreduce.fileoutputcommitter.marksuccessfuljobs must be on")
    if "/" not in target:
        spark.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT * FROM {fmt}.`{path}`")
    for old in [v for v in _versions(spark, folder) if v < number][: -(keep - 1) or None]:
        remove_path(spark, f"{folder}/v{old:08d}")
    return path


def read_report(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """The report's current version: whole, whenever it is read."""
    if "/" not in target:
        return spark.table(target)
    done = _complete(spark, target.rstrip("/"))
    if not done:
        raise FileNotFoundError(f"no published version of {target}")
    return spark.read.format(fmt).load(f"{target.rstrip('/')}/v{done[-1]:08d}")


# --- date partitions ------------------------------------------------------------------------

def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast ``df`` to a target schema by name; missing or unknown columns fail (no silent drift)."""
    wanted = {f.name for f in schema.fields}
    missing, unknown = sorted(wanted - set(df.columns)), sorted(set(df.columns) - wanted)
    if missing or unknown:
        raise ValueError(f"columns don't match the target schema: missing {missing}, unknown {unknown}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


@contextmanager
def dynamic_overwrite(spark: SparkSession):
    """Inside, an overwrite of a catalog table replaces the written partitions only (its writers take no option for it)."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def overwrite_partitions(df: DataFrame, target: str, partition_col: str = "date",
                         schema: T.StructType | None = None, fmt: str = "parquet") -> None:
    """SNK2: replace only the date partitions present in ``df`` (dynamic overwrite).

    ``target``: a path (with a ``/``) or a catalog table, which must exist, partitioned by
    ``partition_col``; the rows are cast to the table's own schema, and a column too few or
    too many fails.  For a path, ``schema`` gives it.  Each row goes to its own ``date``
    partition (T14).
    """
    spark = df.sparkSession
    if "/" not in target:
        partitions = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
        if partitions != [partition_col]:
            raise ValueError(f"{target} is partitioned by {partitions}, not by {partition_col}")
        with dynamic_overwrite(spark):
            conform(df, spark.table(target).schema).write.mode("overwrite").insertInto(target)
        return
    if schema is not None:
        df = conform(df, schema)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).format(fmt).save(target))


# --- raw archive ----------------------------------------------------------------------------

def archive_path(root: str, as_of, name: str) -> str:
    """SNK3 location: ``{root}/{YYYYMMDD}/{name}`` (FN10)."""
    if not isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = _dt.date.fromisoformat(str(as_of))
    return f"{root.rstrip('/')}/{as_of.strftime('%Y%m%d')}/{name}"


def manifest_path(archived: str) -> str:
    """Where an archived dump's list of files, lengths and digests lies."""
    folder, name = archived.rstrip("/").rsplit("/", 1)
    return f"{folder}/_manifests/{name}"


MANIFEST = "source string, file string, length bigint, sha256 string"


def _copy_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copy each file in blocks to a temporary name, move it in, report its length and digest."""
    from pyarrow import fs

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            store, source = fs.FileSystem.from_uri(row["source"])
            there, target = fs.FileSystem.from_uri(row["target"])
            there.create_dir(target.rsplit("/", 1)[0], recursive=True)
            digest, length, aside = hashlib.sha256(), 0, f"{target}.{uuid.uuid4().hex}.part"
            with store.open_input_stream(source) as read, there.open_output_stream(aside) as write:
                while block := read.read(4 << 20):
                    digest.update(block)
                    length += len(block)
                    write.write(block)
            if there.get_file_info(target).type != fs.FileType.NotFound:
                there.delete_file(target)                            # of a former attempt of this task
            there.move(aside, target)
            out.append({"source": row["source"], "file": row["target"], "length": length, "sha256": digest.hexdigest()})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("source", pa.string()), ("file", pa.string()),
                                                         ("length", pa.int64()), ("sha256", pa.string())]))


def archive_raw(spark: SparkSession, source: str, root: str, as_of, name: str) -> str:
    """SNK3: copy the landed files under the run date, byte for byte; returns the path.

    A dump of one file becomes one object of that name, a dump of several a folder with the
    files' own places.  Tasks copy the files, in blocks, each under a
    temporary name first.  A manifest beside the archive (``_manifests``) holds every file's
    length and SHA-256; the copy fails if its lengths differ from the listing's.  A re-run
    replaces the archive.
    """
    path = archive_path(root, as_of, name)
    landed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    files = [_uri(f) for f in landed.inputFiles()]                   # as listed for the read, empty ones too
    if not files:
        raise FileNotFoundError(f"nothing landed in {source}")
    remove_path(spark, path)
    base, target = (_uri(qualified(spark, p)) for p in (source, path))
    work = spark.createDataFrame([(f, target + f[len(base):]) for f in files], "source string, target string")
    work = work.repartition(min(len(files), 10_000), "source")
    work.mapInArrow(_copy_files, MANIFEST).write.mode("overwrite").json(manifest_path(path))
    size = landed.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    copied = spark.read.schema(MANIFEST).json(manifest_path(path)).agg(F.count("*"), F.sum("length")).first()
    if tuple(copied) != (len(files), size):
        raise OSError(f"{source}: {len(files)} files of {size} bytes landed, {copied[0]} of {copied[1]} were archived")
    return path


def check_archive(spark: SparkSession, archived: str) -> DataFrame:
    """``(file, length, sha256, intact)``: every file of an archive's manifest, read again."""
    manifest = spark.read.schema(MANIFEST).json(manifest_path(archived))
    held = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(archived).select(
        F.regexp_replace("_metadata.file_path", "^file:/+", "file:///").alias("file"), F.sha2("content", 256).alias("found"))
    empty = F.col("found").isNull() & (F.col("length") == 0)         # a scan leaves empty files out
    return manifest.join(held, "file", "left").select(
        "file", "length", "sha256", F.coalesce(F.col("found") == F.col("sha256"), empty).alias("intact"))


def _uri(path: str) -> str:
    return re.sub("^file:/+", "file:///", path.rstrip("/"))


def write_snapshot(df: DataFrame, path: str, replace: bool = False) -> None:
    """Write a registry snapshot, the next version of the table.

    ``replace``: a retry of the same run may write its own snapshot again.
    """
    df.write.mode("overwrite" if replace else "errorifexists").parquet(path)
