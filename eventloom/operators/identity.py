"""Player ids to platform ids as joins, and the upserts that register new ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import trimmed
from ..session import scratch_path


def latest_per_key(entries: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The newest entry of each key.

    An aggregate, not a ranking window: each task first reduces its own rows, so
    a key with very many entries is never gathered in one place.
    """
    rest = [c for c in entries.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return entries.groupBy(*keys).agg(newest.alias("newest")).select(*keys, "newest.*")


def _lookup(identity: DataFrame, key: str, value: str, unique: bool) -> DataFrame:
    """One ``(player_key, goc_id)`` row per key, keys trimmed, blank ids left out.

    A ``unique`` table has one row per trimmed key already and is only read.
    """
    if unique:
        return identity.select(
            F.col(key).alias("player_key"), F.col(value).alias("goc_id")
        ).where("player_key <> '' AND goc_id <> ''")
    order = [F.col("seq")] if "seq" in identity.columns else []
    pairs = identity.select(
        trimmed(key).alias("player_key"), F.col(value).alias("goc_id"), *order
    ).where("player_key <> '' AND goc_id <> ''")
    # Grouped by the key and its hash, the pairs are not laid out by the key alone, so
    # a join shuffles them again.  AQE splits hot join partitions only where a shuffle
    # feeds the join directly; straight from the aggregate it could not.
    groups = pairs.groupBy("player_key", F.xxhash64("player_key"))
    if not order:
        return groups.agg(F.max("goc_id").alias("goc_id")).select("player_key", "goc_id")
    newest = groups.agg(F.max(F.struct("seq", "goc_id")).alias("newest"))
    return newest.select("player_key", "newest.goc_id")


def _join_key() -> Column:
    """The key rows are joined by.

    Rows that need no lookup get keys that match nothing and spread evenly;
    left blank they would all hash to one task.
    """
    spread = F.concat(F.lit("\x00"), F.xxhash64("packet", "ts").cast("string"))
    return F.when(F.col("reason").isNull(), F.col("player_key")).otherwise(spread)


def resolve_ids(
    events: DataFrame,
    identity: DataFrame,
    key: str = "player_id",
    value: str = "goc_id",
    unique: bool = False,
) -> DataFrame:
    """Add ``goc_id`` to interpreted events, empty where the player is unknown.

    ``unique`` says that ``identity`` has one row per key, as ``read_identity`` gives it.

    A plain outer join with no hint: Spark broadcasts the identity side only when
    its measured size allows, else it joins by shuffle and AQE splits the
    partitions of players that own too many rows.
    """
    lookup = _lookup(identity, key, value, unique)
    keyed = events.withColumn("join_key", _join_key())
    joined = keyed.join(lookup.withColumnRenamed("player_key", "join_key"), "join_key", "left")
    return joined.drop("join_key").withColumn("goc_id", F.coalesce("goc_id", F.lit("")))


def resolve_by_distinct_keys(
    events: DataFrame,
    identity: DataFrame,
    key: str = "player_id",
    value: str = "goc_id",
    unique: bool = False,
    max_hot_keys: int = 10_000,
    buckets: int | None = None,
) -> DataFrame:
    """The same result, looking every distinct player up once.

    First the distinct keys are counted and resolved, which shuffles one row per player and
    task instead of one per event, and written down.  Then events meet the table of pairs:
    Spark broadcasts it if its size on disk allows, and the events need no shuffle.  Else
    they are joined by shuffle, the events of hot players dealt out over several salts.  A
    player, known or not, is hot above ``1 / max_hot_keys`` of all events, so no more than
    ``max_hot_keys`` can be.

    ``buckets`` says that ``identity`` is bucketed by its key into so many.  The distinct
    players are then dealt out alike and the identity side is joined as it lies.

    ``events`` is read more than once, so it must give the same rows each time, as
    files do.  Its first reading needs nothing but the keys.
    """
    if max_hot_keys < 1:
        raise ValueError("max_hot_keys must be positive")
    spark = events.sparkSession
    counted = (
        events.where(F.col("reason").isNull()).groupBy("player_key").agg(F.count("*").alias("n"))
    )
    if buckets is not None:
        counted = counted.repartition(buckets, "player_key")
    table = scratch_path(spark, "player-pairs")
    lookup = _lookup(identity, key, value, unique)
    counted.join(lookup, "player_key", "left").select(
        F.col("player_key").alias("join_key"), "goc_id", "n"
    ).write.parquet(table)
    pairs = spark.read.schema("join_key string, goc_id string, n bigint").parquet(table)
    total = pairs.agg(F.sum("n")).first()[0] or 0
    hot_rows = max(1, -(-total // max_hot_keys))
    salts = F.ceil(F.col("n") / hot_rows).cast("int")
    sized = pairs.withColumn("salts", salts)
    # max_hot_keys rows at most: more than so many cannot exceed their share
    hot = sized.where("salts > 1").select("join_key", "salts")
    keyed = events.withColumn("join_key", _join_key())
    # the salt comes from the row, not from chance, so a retried task repeats it
    salt = F.pmod(F.xxhash64("ts", "event_value"), F.coalesce("salts", F.lit(1))).cast("int")
    salted = keyed.join(hot, "join_key", "left").withColumn("salt", salt).drop("salts")
    copies = sized.where(F.col("goc_id").isNotNull()).select(
        "join_key", "goc_id", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    )
    joined = salted.join(copies, ["join_key", "salt"], "left").drop("join_key", "salt")
    return joined.withColumn("goc_id", F.coalesce("goc_id", F.lit("")))


def distinct_players(events: DataFrame, key: str = "user_id") -> DataFrame:
    """The distinct players of raw or interpreted events."""
    return events.select(key).distinct()


def unresolved_keys(unresolved: DataFrame, identity: DataFrame | None = None) -> DataFrame:
    """The worklist of players to register: one row per key, with its event count."""
    # Counting by all three ids hashes; only the few rows left are sorted for max.
    counted = (
        unresolved.where("player_key <> ''")
        .groupBy("player_key", "user_id", "numeric_user_id")
        .agg(F.count("*").alias("n"))
    )
    keys = counted.groupBy(F.col("player_key").alias("player_id")).agg(
        F.max("user_id").alias("hashed_id"),
        F.max("numeric_user_id").alias("numeric_id"),
        F.sum("n").alias("events"),
    )
    if identity is None:
        return keys
    known = identity.where("goc_id <> ''").select(trimmed("player_id").alias("player_id"))
    return keys.join(known, "player_id", "left_anti")


# -- registration ------------------------------------------------------------


def _registered(worklist: DataFrame, assigned: DataFrame) -> DataFrame:
    """Worklist rows that got an id; a blank one counts as not registered."""
    ids = assigned.select(trimmed("player_id").alias("player_id"), "goc_id").where("goc_id <> ''")
    return worklist.join(ids.groupBy("player_id").agg(F.max("goc_id").alias("goc_id")), "player_id")


def forward_entries(worklist: DataFrame, assigned: DataFrame, seq: int) -> DataFrame:
    """Player id -> platform id and numeric id."""
    return _registered(worklist, assigned).select(
        "player_id", "goc_id", "numeric_id", F.lit(seq).cast("bigint").alias("seq")
    )


def reverse_entries(worklist: DataFrame, assigned: DataFrame, seq: int) -> DataFrame:
    """Platform id -> numeric id and hashed id.

    When several players share a platform id the highest player id is kept.
    """
    rows = _registered(worklist, assigned).groupBy("goc_id").agg(
        F.max(F.struct("player_id", "numeric_id", "hashed_id")).alias("last")
    )
    return rows.select(
        "goc_id", "last.numeric_id", "last.hashed_id", F.lit(seq).cast("bigint").alias("seq")
    )


def numeric_entries(worklist: DataFrame, assigned: DataFrame, seq: int) -> DataFrame:
    """Numeric id -> hashed id and platform id, for players that have one."""
    rows = _registered(worklist, assigned).where("numeric_id <> ''").groupBy("numeric_id").agg(
        F.max(F.struct("player_id", "hashed_id", "goc_id")).alias("last")
    )
    return rows.select(
        "numeric_id", "last.hashed_id", "last.goc_id", F.lit(seq).cast("bigint").alias("seq")
    )


def upsert(current: DataFrame, incoming: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """Both tables by key, the newest entry winning and ``incoming`` winning ties."""
    both = current.withColumn("_side", F.lit(0)).unionByName(incoming.withColumn("_side", F.lit(1)))
    newest = latest_per_key(both, [key], [F.col(order), F.col("_side")])
    return newest.drop("_side").select(*current.columns)
