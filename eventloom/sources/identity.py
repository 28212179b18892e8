"""Identity tables: one row per key, in buckets of which an update rewrites those it meets.

Rows lie by a hash of their key in folders ``data-<buckets>/slot=/version=``, the hash by which
Spark buckets tables, one file per folder and sorted by key.  A manifest names the version in
force of each slot; manifests are numbered, and the newest one that Spark marked complete
counts.  So a reader never sees half an update, an update that stopped leaves the last one in
force, and the folders of untouched slots stay as they are.

An update claims the number of its manifest by creating a file.  A second one that began
meanwhile finds the claim, or a newer manifest, and is refused.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import trimmed
from ..operators.identity import latest_per_key
from ..session import discard, scratch_path

# Key column first.  ``seq`` orders entries of one key.
IDENTITY_SCHEMAS = {
    "forward": "player_id string, goc_id string, numeric_id string, seq bigint",
    "reverse": "goc_id string, numeric_id string, hashed_id string, seq bigint",
    "numeric": "numeric_id string, hashed_id string, goc_id string, seq bigint",
}

MANIFEST_SCHEMA = "buckets int, slot int, version string, n_rows bigint"
# Manifests, and the folders they name, that stay for readers that began with them.
KEPT_MANIFESTS = 2
# A table has at least so many buckets, and twice as many once they hold more rows than this.
FEWEST_BUCKETS = 4
BUCKET_ROWS = 1_000_000


class ConcurrentUpdate(RuntimeError):
    """Another update of the same identity table is under way or came first."""


def _folder(spark: SparkSession, path: str):
    """Hadoop's path and file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str, folder: str, name: str) -> list[int]:
    """Numbers of the complete folders ``<folder>/<name>=<number>``, in order."""
    pattern, system = _folder(spark, f"{path}/{folder}/{name}=*/_SUCCESS")
    found = system.globStatus(pattern) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def _manifests(spark: SparkSession, path: str) -> list[int]:
    return _numbers(spark, path, "manifests", "number")


def _manifest(spark: SparkSession, path: str, number: int) -> list:
    """A row per slot; as many as the table has buckets."""
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/manifests/number={number}")
    return rows.collect()


def _slot(key: str, buckets: int) -> Column:
    """The bucket Spark puts a key in."""
    return F.pmod(F.hash(key), F.lit(buckets)).cast("int")


def _bucketed(spark: SparkSession, path: str, kind: str, buckets: int) -> str:
    """The name, in this session's catalog, of the folder as a bucketed table."""
    folder = f"{path}/data-{buckets}"
    name = f"eventloom_{kind}_{hashlib.md5(folder.encode()).hexdigest()}"
    quoted = folder.replace("\\", "\\\\").replace("'", "\\'")
    key = IDENTITY_SCHEMAS[kind].split()[0]
    manage = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(manage)
    try:
        # folders are listed, also where the catalog could keep partitions
        spark.conf.set(manage, "false")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({IDENTITY_SCHEMAS[kind]}, slot INT, version STRING) "
            f"USING parquet PARTITIONED BY (slot, version) CLUSTERED BY ({key}) SORTED BY ({key}) "
            f"INTO {buckets} BUCKETS LOCATION '{quoted}'"
        )
    finally:
        spark.conf.set(manage, before)
    spark.catalog.refreshTable(name)  # other sessions may have written
    return name


def _before_buckets(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A table of the older layout, whole versions; empty where there is none."""
    numbers = _numbers(spark, path, ".", "version")
    if not numbers:
        return spark.createDataFrame([], IDENTITY_SCHEMAS[kind])
    return spark.read.schema(IDENTITY_SCHEMAS[kind]).parquet(f"{path}/version={numbers[-1]}")


def _read(spark: SparkSession, path: str, kind: str, rows: list, bucketed: bool) -> DataFrame:
    schema = IDENTITY_SCHEMAS[kind]
    if not rows:
        return spark.createDataFrame([], schema)
    if not bucketed:
        folders = [f"{path}/data-{r.buckets}/slot={r.slot}/version={r.version}" for r in rows]
        return spark.read.schema(schema).parquet(*folders)
    table = spark.table(_bucketed(spark, path, kind, rows[0].buckets))
    in_force = F.concat_ws("/", "slot", "version").isin([f"{r.slot}/{r.version}" for r in rows])
    columns = [c.split()[0] for c in schema.split(", ")]
    return table.where(in_force).select(*columns)


def read_identity(
    spark: SparkSession, path: str, kind: str = "forward", bucketed: bool = False
) -> DataFrame:
    """The table: a row per key, keys trimmed; empty where none was written yet.

    ``bucketed`` reads it as a table bucketed and sorted by its key.  A join with rows in
    ``identity_buckets`` partitions by the key takes it as it lies, without a shuffle.  AQE does
    not split hot partitions there, so it is for joins with one row per key, as
    ``resolve_by_distinct_keys`` makes them.
    """
    numbers = _manifests(spark, path)
    if not numbers:
        return _before_buckets(spark, path, kind)
    rows = [r for r in _manifest(spark, path, numbers[-1]) if r.n_rows]
    return _read(spark, path, kind, rows, bucketed)


def identity_buckets(spark: SparkSession, path: str) -> int | None:
    """How many buckets the table has; none before it was written in buckets."""
    numbers = _manifests(spark, path)
    return _manifest(spark, path, numbers[-1])[0].buckets if numbers else None


def release_claim(spark: SparkSession, path: str) -> None:
    """Forget the claim of an update whose driver was lost."""
    target, system = _folder(spark, f"{path}/claims")
    system.delete(target, True)


def merge_identity(entries: DataFrame, path: str, kind: str = "forward") -> None:
    """Replace the rows of the keys in ``entries``; the greatest ``seq`` wins, new ones ties.

    Keys are trimmed; entries with a blank key are left out.  Only the buckets of incoming
    keys are read and written anew.  When the buckets hold too many rows, all are dealt to
    twice as many once.  Raises ``ConcurrentUpdate`` where another update came between.
    """
    spark = entries.sparkSession
    numbers = _manifests(spark, path)
    number = numbers[-1] + 1 if numbers else 1
    claim, system = _folder(spark, f"{path}/claims/{number}")
    system.mkdirs(claim.getParent())
    if not system.createNewFile(claim):
        raise ConcurrentUpdate(f"update {number} of {path} is under way; if its driver was lost, release_claim")
    incoming_at = scratch_path(spark, "identity-entries")
    try:
        if _manifests(spark, path) != numbers:
            raise ConcurrentUpdate(f"update {number} of {path} has come first")
        incoming = _incoming(entries, kind)
        incoming.write.parquet(incoming_at)
        incoming = spark.read.schema(incoming.schema).parquet(incoming_at)
        _update(spark, path, kind, incoming, numbers, number)
    finally:
        system.delete(claim, False)
        discard(spark, incoming_at)
    _drop_old(spark, path, kind, [*numbers, number])


def _incoming(entries: DataFrame, kind: str) -> DataFrame:
    """The newest entry of each key."""
    key, *rest = [c.split()[0] for c in IDENTITY_SCHEMAS[kind].split(", ")]
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in rest[:-1]]
    rows = entries.select(trimmed(key).alias(key), *texts, F.col("seq").cast("bigint")).where(F.col(key) != "")
    return latest_per_key(rows, [key], [F.col("seq"), *[F.col(c) for c in rest[:-1]]])


def _update(spark, path: str, kind: str, incoming: DataFrame, numbers: list[int], number: int) -> None:
    key = IDENTITY_SCHEMAS[kind].split()[0]
    columns = incoming.columns
    current = _manifest(spark, path, numbers[-1]) if numbers else []
    n_new = incoming.count()
    n_rows = sum(r.n_rows for r in current) + n_new
    buckets = current[0].buckets if current else FEWEST_BUCKETS
    while n_rows > buckets * BUCKET_ROWS:
        buckets *= 2
    if current and buckets == current[0].buckets:
        # at most one row per bucket
        slots = {r.slot for r in incoming.select(_slot(key, buckets).alias("slot")).distinct().collect()}
        touched = [r for r in current if r.slot in slots]
        kept = [r for r in current if r.slot not in slots]
        old = _read(spark, path, kind, [r for r in touched if r.n_rows], bucketed=True)
    else:
        slots, kept = set(range(buckets)), []
        old = (
            _read(spark, path, kind, [r for r in current if r.n_rows], bucketed=False)
            if numbers else _before_buckets(spark, path, kind)
        )
    newer = F.col("new.seq").isNotNull() & (F.col("old.seq").isNull() | (F.col("new.seq") >= F.col("old.seq")))
    newer = F.col(f"old.{key}").isNull() | newer | (F.col("old.seq").isNull() & F.col(f"new.{key}").isNotNull())
    rows = old.alias("old").join(incoming.alias("new"), key, "full_outer").select(
        key, *[F.when(newer, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in columns[1:]]
    )
    version = f"{number:08d}-{uuid.uuid4().hex[:8]}"
    table = _bucketed(spark, path, kind, buckets)
    laid = rows.repartition(buckets, key).select(
        *columns, _slot(key, buckets).alias("slot"), F.lit(version).alias("version")
    )
    laid.write.mode("append").insertInto(table)
    spark.catalog.refreshTable(table)
    written = spark.table(table).where(F.col("version") == version).groupBy("slot").agg(F.count("*").alias("n"))
    counts = {r.slot: r.n for r in written.collect()}
    manifest = [(r.buckets, r.slot, r.version, r.n_rows) for r in kept]
    manifest += [(buckets, s, version, counts.get(s, 0)) for s in sorted(slots)]
    named = spark.createDataFrame(manifest, MANIFEST_SCHEMA).coalesce(1)
    named.write.mode("overwrite").parquet(f"{path}/manifests/number={number}")


def _drop_old(spark: SparkSession, path: str, kind: str, numbers: list[int]) -> None:
    """Folders that only older manifests name, then those manifests."""
    kept, gone = numbers[-KEPT_MANIFESTS:], numbers[:-KEPT_MANIFESTS]

    def folders(of: list[int]) -> set[tuple]:
        return {(r.buckets, r.slot, r.version) for n in of for r in _manifest(spark, path, n)}

    if gone:
        for buckets, slot, version in folders(gone) - folders(kept):
            target, system = _folder(spark, f"{path}/data-{buckets}/slot={slot}/version={version}")
            system.delete(target, True)
        for number in gone:
            target, system = _folder(spark, f"{path}/manifests/number={number}")
            system.delete(target, True)
