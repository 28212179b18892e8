"""Even shards that keep linked documents together, by balanced label propagation.

Documents of one link (here: of equal text) want to be in one shard.  Labels are shards.  In
each round a join counts how much of each link lies in each shard, the link names the shards
that can hold it, those with most of it first, and its documents elsewhere ask to move there.
Two shards exchange what both ask for, and a shard lets in more as far as its quota has room.
Rounds go on while fewer pairs of a link are cut apart.

Documents without links have no neighbours to move to; they are dealt last, by a running sum,
and fill each shard exactly to its quota.  Running sums go over blocks of hashed keys, in two
levels, so no window holds a shard or a link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, drop_table, keep_table

# Rows of a block of a running sum.
BLOCK_ROWS = 4096
# Links with more rows move and are numbered in pieces of about so many.
PIECE_ROWS = 256
BUCKETS = 1024
_SUPER_BITS = 10


def _before(*order) -> Window:
    return Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def running_sum(rows: DataFrame, by: list[str], n: int, load: str = "load") -> DataFrame:
    """``rows`` (node, key, load, ...) with ``upto``: the sum of ``load`` so far, per ``by``.

    The order is that of the unsigned ``key``, a hash, and then of ``node``.  ``n`` is about
    the number of rows; it sets the size of the blocks, not the result.
    """
    bits = max(0, (n // BLOCK_ROWS).bit_length() - _SUPER_BITS)
    rows = rows.withColumn("block", F.shiftrightunsigned("key", 64 - _SUPER_BITS - bits))
    sums = rows.groupBy(*by, "block").agg(F.sum(load).alias("held"))
    sums = keep_table(sums.withColumn("super", F.shiftright("block", bits)), "shard-blocks")
    # 1024 rows for each of ``by``, whatever the size of the table
    supers = sums.groupBy(*by, "super").agg(F.sum("held").alias("held"))
    in_all = _before("super").partitionBy(*by) if by else _before("super")
    supers = supers.select(*by, "super", F.coalesce(F.sum("held").over(in_all), F.lit(0)).alias("earlier"))
    in_super = _before("block").partitionBy(*by, "super")
    starts = (
        sums.withColumn("before", F.coalesce(F.sum("held").over(in_super), F.lit(0)))
        .join(supers, [*by, "super"])
        .select(*by, "block", (F.col("before") + F.col("earlier")).alias("start"))
    )
    in_block = (
        Window.partitionBy(*by, "block")
        # unsigned order: blocks are cut from the highest bits
        .orderBy(F.shiftrightunsigned("key", 1), "key", "node")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        rows.withColumn("own", F.sum(load).over(in_block))
        .join(keep_table(starts, "shard-blocks"), [*by, "block"])
        .withColumn("upto", F.col("own") + F.col("start"))
        .drop("own", "start", "block")
    )


def _per_shard(values: list[int], shard) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col(shard) + 1)


def _piece(links: Column, node: str, count: str, salt: Column) -> Column:
    """A key for each piece of a link; a piece has about ``PIECE_ROWS`` rows."""
    pieces = F.ceil(F.col(count) / PIECE_ROWS)
    return F.xxhash64(links, F.pmod(F.xxhash64(F.lit(3), salt, node), pieces))


def _loads(places: DataFrame, shards: int) -> list[int]:
    held = [0] * shards
    for row in places.groupBy("shard").agg(F.sum("load").alias("load")).collect():
        held[row["shard"]] = row["load"]
    return held


def propagate(
    nodes: DataFrame, members: DataFrame, quotas: list[int], *, rounds: int = 12, seed: int = 1
) -> DataFrame:
    """``nodes`` (node, load) and ``members`` (node, link) to node, load, shard.

    Every node starts in a shard by hash.  A node in several links follows the one with most
    in its shard of choice.  Moves are let in by buckets of hashed links, so quotas hold but
    for the start by hash and for about a bucket; ``fill`` makes them exact.  ``rounds``
    bounds the work: rounds end before when nothing is cut or two in a row do not lessen it;
    the best one counts.  Every other round a link turns to shards that have room for all of it
    first; in between those with most of it come first, which shards exchange for.
    """
    shards = len(quotas)
    places = keep_table(
        nodes.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "node"), F.lit(shards)).cast("int")), "shard-places"
    )
    sizes = keep_table(
        members.join(nodes, "node")
        .groupBy("link")
        .agg(F.sum("load").alias("total"), F.count("*").alias("count")),
        "shard-links",
    )
    best, least, stale = places, None, 0
    for turn in range(rounds + 1):
        votes = keep_table(
            members.join(places, "node").groupBy("link", "shard").agg(F.sum("load").alias("held")), "shard-votes"
        )
        cut = _cut(votes)
        stale = stale + 1 if least is not None and cut >= least else 0
        if least is None or cut < least:
            if best is not places:
                drop_table(best)
            best, least = places, cut
        if cut == 0 or stale == 2 or turn == rounds:
            drop_table(votes)
            break
        after = _round(members, places, sizes, votes, quotas, F.lit(seed + turn), by_room=turn % 2 == 1)
        if places is not best:
            drop_table(places)
        places = after
        drop_table(votes)
    if places is not best:
        drop_table(places)
    return best


def _cut(votes: DataFrame) -> float:
    """Pairs within a link that lie in different shards, over the link's size; summed."""
    square = F.sum(F.col("held").cast("double") * F.col("held"))
    cut = votes.groupBy("link").agg((F.sum("held") - square / F.sum("held")).alias("cut")).agg(F.sum("cut"))
    return round(cut.first()[0] or 0.0, 6)


def _exchange(asked: list[list[int]], free: list[int]) -> list[list[int]]:
    """What may move from shard to shard: as much as comes back, and shares of what is free."""
    n = len(free)
    allowed = [[min(asked[f][t], asked[t][f]) for t in range(n)] for f in range(n)]
    for t in range(n):
        more = [asked[f][t] - allowed[f][t] for f in range(n)]
        given = min(sum(more), free[t])
        for f in range(n):
            allowed[f][t] += given * more[f] // max(1, sum(more))
    return allowed


def _round(members, places, sizes, votes, quotas, salt, by_room: bool) -> DataFrame:
    held = _loads(places, len(quotas))
    free = [max(0, q - h) for q, h in zip(quotas, held)]
    # a link has at most as many rows here as there are shards
    # without regard to what is free, a home can hold its quota, by exchange
    room = F.col("held") + _per_shard(free, "shard")
    if not by_room:
        room = F.greatest(room, _per_shard(quotas, "shard"))
    full = (F.col("room") < F.col("total")).cast("int") if by_room else F.lit(0)
    rank = Window.partitionBy("link").orderBy(
        full, F.col("held").desc(), F.xxhash64(salt, "link", "shard"), "shard"
    )
    earlier = rank.rowsBetween(Window.unboundedPreceding, -1)
    upto = rank.rowsBetween(Window.unboundedPreceding, 0)
    # as a table, so that the join with it can split a link with very many documents
    homes = keep_table(
        votes.join(sizes, "link")
        .withColumn("room", room)
        .withColumn("before", F.coalesce(F.sum("room").over(earlier), F.lit(0)))
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("before") < F.col("total"))
        .withColumn("wants", F.greatest(F.lit(0), F.least("room", F.col("total") - F.col("before")) - F.col("held")))
        .withColumn("upto", F.sum("wants").over(upto))
        .groupBy("link", "count")
        .agg(
            F.array_sort(F.collect_list(F.struct("rank", "shard", "upto", "held"))).alias("homes"),
            F.max("upto").alias("wanted"),
        )
        .where(F.col("wanted") > 0),
        "shard-homes",
    )
    # documents outside the homes are shared out by what each home has room for
    chance = F.pmod(F.xxhash64(salt, "node"), F.lit(1 << 40)) / float(1 << 40)
    asking = (
        members.join(places, "node")
        .join(homes, "link")
        .where(~F.exists("homes", lambda h: h.shard == F.col("shard")))
        .withColumn("drawn", chance * F.col("wanted"))
        .withColumn("home", F.get(F.filter("homes", lambda h: h.upto > F.col("drawn")), F.lit(0)))
        .where(F.col("home").isNotNull())
        .select(
            "node", "load", F.col("shard").alias("from"), F.col("home.shard").alias("to"),
            F.col("home.held").alias("pull"),
            # cut anew in each round, so that what was left over is not one piece again
            _piece(F.col("link"), "node", "count", salt).alias("piece"),
        )
    )
    moves = keep_table(
        asking.groupBy("node", "load", "from", "to")
        .agg(F.sum("pull").alias("pull"), F.min("piece").alias("piece"))
        .groupBy("node", "load", "from")
        .agg(F.max(F.struct("pull", "to", "piece")).alias("best"))
        .select(
            "node", "load", "from", "best.to",
            F.pmod(F.xxhash64(salt, "best.piece"), F.lit(BUCKETS)).alias("bucket"),
        ),
        "shard-moves",
    )
    # whole buckets of moves as long as the room between two shards lasts
    buckets = moves.groupBy("from", "to", "bucket").agg(F.sum("load").alias("load"))
    asked = [[0] * len(quotas) for _ in quotas]
    for row in buckets.groupBy("from", "to").agg(F.sum("load").alias("load")).collect():
        asked[row["from"]][row["to"]] = row["load"]
    allowed = F.element_at(
        F.element_at(F.array(*[F.array(*[F.lit(v).cast("long") for v in r]) for r in _exchange(asked, free)]), F.col("from") + 1),
        F.col("to") + 1,
    )
    so_far = Window.partitionBy("from", "to").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    let_in = buckets.withColumn("upto", F.sum("load").over(so_far)).where(F.col("upto") <= allowed)
    moved = moves.join(let_in.select("from", "to", "bucket"), ["from", "to", "bucket"]).select("node", "to")
    after = keep_table(
        places.join(moved, "node", "left").select("node", "load", F.coalesce("to", "shard").alias("shard")),
        "shard-places",
    )
    drop_table(moves)
    drop_table(homes)
    return after


def quotas_of(total: int, shards: int) -> list[int]:
    """``total`` in whole parts that differ by one at most."""
    return [total * (s + 1) // shards - total * s // shards for s in range(shards)]


def fill(rows: DataFrame, quotas: list[int], n: int) -> DataFrame:
    """``rows`` (node, load, key, shard or null, ...) with a shard for all, to the quotas.

    Of a shard above its quota the rows beyond it, by their running sum, are dealt anew with
    those that have none.  A row goes where the middle of its load falls, so with loads of one
    the quotas are met exactly, else but for half a load at either end.
    """
    shards = len(quotas)
    placed = rows.where(F.col("shard").isNotNull())
    held = _loads(placed, shards)
    over = [s for s in range(shards) if held[s] > quotas[s]]
    if over:
        full = F.col("shard").isin(over)
        ranked = running_sum(placed.where(full), ["shard"], max(1, n * len(over) // shards))
        stays = (F.col("upto") - F.col("load") / 2) <= _per_shard(quotas, "shard")
        ranked = ranked.withColumn("shard", F.when(stays, F.col("shard"))).select(*rows.columns)
        rows = keep_table(rows.where(F.col("shard").isNull() | ~full).unionByName(ranked), "shard-filled")
        placed = rows.where(F.col("shard").isNotNull())
        held = _loads(placed, shards)
    rest = rows.where(F.col("shard").isNull())
    total = rest.agg(F.sum("load")).first()[0] or 0
    gaps = [max(0, q - h) for q, h in zip(quotas, held)]
    ends = [sum(gaps[: s + 1]) for s in range(shards)]
    scale = ends[-1] / total if total else 1.0
    place = (F.col("upto") - F.col("load") / 2) * F.lit(float(scale))
    bounds = F.array(*[F.lit(float(e)) for e in ends[:-1]])
    dealt = running_sum(rest, [], n).withColumn("place", place)
    dealt = dealt.withColumn("shard", F.size(F.filter(bounds, lambda e: e <= F.col("place"))).cast("int"))
    return placed.unionByName(dealt.select(*rows.columns))


def shard_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 24,
    law: str = "rows",
    rounds: int = 12,
    seed: int = 1,
) -> DataFrame:
    """Per row doc_id, size, text_crc32, link, law, shard, slot, grown_shard.

    Rows of equal text are linked.  ``law`` "rows" makes the numbers of rows of any two shards
    differ by one at most, "bytes" their sizes (UTF-8 bytes and 8) by about the size of one
    document.  Links that fit a shard stay whole but where quotas run out, larger ones take as few
    shards as there is room for.  ``slot`` numbers the rows of a shard from 0.

    A null text counts as empty, also for ``text_crc32``, and is linked with empty ones.  Null
    ids and repeated rows are rows like others.  An empty table gives no rows; fewer rows than
    shards leave some shards empty.  Other columns are left out, whatever their names.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"law must be 'rows' or 'bytes', not {law!r}")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select(
        "doc_id",
        (F.octet_length("text") + 8).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
        # only says what should be together; a clash of hashes would link two texts
        F.xxhash64("text", F.crc32("text")).alias("link"),
    )
    # written once, so the numbers of rows hold for all that follows
    rows = keep_table(rows.withColumn("node", F.monotonically_increasing_id()), "shard-rows")
    load = F.lit(1).cast("long") if law == "rows" else F.col("size")
    rows = rows.withColumn("load", load)
    sums = rows.agg(F.count("*"), F.sum("load")).first()
    n, total = sums[0], sums[1] or 0
    quotas = quotas_of(total, shards)
    repeated = keep_table(
        rows.groupBy("link").agg(F.count("*").alias("count")).where(F.col("count") > 1), "shard-repeated"
    )
    linked = keep_table(rows.join(repeated, "link").select("node", "load", "link", "count"), "shard-linked")
    places = propagate(
        linked.select("node", "load"), linked.select("node", "link"), quotas, rounds=rounds, seed=seed
    )
    placed = linked.join(places.select("node", "shard"), "node").select(
        "node", "shard", _piece(F.col("link"), "node", "count", F.lit(seed)).alias("key")
    )
    alone = F.xxhash64(F.lit(seed + 1), "node")
    found = rows.join(placed, "node", "left").withColumn("key", F.coalesce("key", alone))
    found = keep_table(found, "shard-found")
    filled = keep_table(fill(found, quotas, n), "shard-filled")
    numbered = running_sum(filled.withColumn("one", F.lit(1).cast("long")), ["shard"], max(1, n // shards), "one")
    return numbered.select(
        "doc_id", "size", "text_crc32", "link", F.lit(law).alias("law"), "shard",
        (F.col("upto") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir)).drop("link")


QUERIES = {"op12_label_propagation": op12_label_propagation}
SQL: dict[str, str] = {}
