"""Mix sources to target weights: exact block quotas dealt to shards by a splitting tree.

Every source is cut into blocks of about equal words by a hash, which also permutes them.
A target becomes a number of blocks to draw, the last one cut between two documents.  The
blocks of all sources are dealt to output shards: a tree halves the shards again and again,
and at each node a multivariate hypergeometric draw says how many blocks of each source go
left.  Each shard then takes its quotas from the permuted blocks and orders its rows by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, keep_table

WORD = r"[^\x20\x09-\x0D]+"


def _size(text_col: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")


def _key(seed: int, *columns: str) -> Column:
    """A hash to order or deal by; the same on every run."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns])


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...], share: float, most: float
) -> DataFrame:
    """``sizes`` (source, size) to source, source_size, target; targets fill up to their limits.

    All uncapped targets have the same ratio to their weights, the level.  Sources meet their
    limits in the order of limit over weight, so the level is that of the first in this order
    which stays below its limit, with all before it capped.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    # windows over one row per source
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("rank", F.row_number().over(by_name)).select(
        "source",
        "source_size",
        "rank",
        F.get(listed, (F.col("rank") - 1) % len(weights)).alias("weight"),
        (F.col("source_size") * F.lit(float(most))).alias("limit"),
    )
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    before = Window.orderBy(F.col("limit") / F.col("weight"), "rank").rowsBetween(
        Window.unboundedPreceding, -1
    )
    zero = F.lit(0.0)
    levels = (
        ranked.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn(
            "level",
            (F.col("budget") - F.coalesce(F.sum("limit").over(before), zero))
            / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), zero)),
        )
        .withColumn("open", F.col("level") * F.col("weight") < F.col("limit"))
    )
    first_open = F.min(
        F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), "rank", "level"))
    ).over(everything)
    return levels.withColumn("found", first_open).select(
        "source",
        "source_size",
        "rank",
        F.when(
            F.col("found").isNotNull(),
            F.least("limit", F.col("found.level") * F.col("weight")),
        )
        .otherwise(F.col("limit"))
        .alias("target"),
    )


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Deal ``quotas`` (rank, quota) to ``shards`` (a power of two): shard, rank, quota.

    A node is a row with its shards and an array of quotas.  Its left half gets half of the
    node's blocks, chosen at random without replacement: block by block, with the chance of
    places left over blocks left.  The counts per source are then multivariate hypergeometric,
    and both halves add up to the node exactly.
    """
    nodes = quotas.agg(
        F.array_sort(F.collect_list(F.struct("rank", "quota"))).alias("q")
    ).select(
        F.lit(0).alias("low"),
        F.lit(shards).alias("high"),
        F.col("q.rank").alias("ranks"),
        F.col("q.quota").alias("quotas"),
    )
    total = "aggregate(quotas, 0L, (a, x) -> a + x)"
    chance = (
        f"(xxhash64({seed}, low, high, i, u) & 9007199254740991L) / 9007199254740992.0D"
    )
    draw = (
        f"aggregate(sequence(0, size(quotas) - 1), "
        f"named_struct('places', {total} div 2, 'blocks', {total}, 'left', cast(array() as array<bigint>)), "
        f"(s, i) -> aggregate("
        f"  if(quotas[i] > 0, sequence(1L, quotas[i]), cast(array() as array<bigint>)), "
        f"  named_struct('places', s.places, 'blocks', s.blocks, 'took', 0L), "
        f"  (t, u) -> if({chance} < t.places / cast(t.blocks as double), "
        f"    named_struct('places', t.places - 1, 'blocks', t.blocks - 1, 'took', t.took + 1), "
        f"    named_struct('places', t.places, 'blocks', t.blocks - 1, 'took', t.took)), "
        f"  t -> named_struct('places', t.places, 'blocks', t.blocks, "
        f"                    'left', concat(s.left, array(t.took)))), "
        f"s -> s.left)"
    )
    while shards > 1:
        shards //= 2
        nodes = nodes.withColumn("left", F.expr(draw)).select(
            "ranks",
            F.explode(
                F.expr(
                    "array(named_struct('low', low, 'high', (low + high) div 2, 'quotas', left), "
                    "named_struct('low', (low + high) div 2, 'high', high, "
                    "'quotas', zip_with(quotas, left, (a, b) -> a - b)))"
                )
            ).alias("n"),
        )
        nodes = nodes.select(
            F.col("n.low").cast("int").alias("low"),
            F.col("n.high").cast("int").alias("high"),
            "ranks",
            F.col("n.quotas").alias("quotas"),
        )
    return nodes.select(
        F.col("low").alias("shard"), F.explode(F.arrays_zip("ranks", "quotas")).alias("z")
    ).select("shard", F.col("z.ranks").alias("rank"), F.col("z.quotas").alias("quota"))


class Mix:
    """A mix of ``docs``: what each row contributes, and the mixed rows.

    ``weights`` go to the sources in code point order, null last, and repeat.  Targets share
    ``share`` of all words by weight, none over ``most`` times its source, the excess going to
    the others by weight.  A source is drawn whole as often as its target has room, then in
    blocks of about ``block_words`` (more, if there would be over ``most_blocks`` of them);
    the last block is cut between two rows, so what is
    taken misses the target by half a document at most.  Nothing but the hash of source, id,
    size and text decides, so reruns agree however rows are partitioned.

    Null or empty text has size 0 and is never drawn, nor is anything of a source without
    words (target 0).  A null id or source is a value like others.  Repeated rows count one by
    one: where the cut falls among rows that agree in all these, reruns agree on how many of
    them are drawn, not on which.  An empty table gives an empty mix.  Other columns are carried.
    """

    def __init__(
        self,
        docs: DataFrame,
        *,
        id_col: str = "doc_id",
        text_col: str = "text",
        source_col: str = "source",
        weights: tuple[float, ...] = (5.0, 2.0, 1.0),
        share: float = 1.5,
        most: float = 2.0,
        block_words: int = 20_000,
        blocks_per_shard: int = 32,
        most_blocks: int = 1 << 20,
        seed: int = 1,
    ):
        self.docs, self.seed = docs, seed
        self.columns = (id_col, text_col, source_col)
        sized = keep_table(self._sized(), "mix-sizes")
        self.targets = keep_table(source_targets(sized, weights, share, most), "mix-targets")
        drawn = self.targets.agg(F.sum("target")).first()[0] or 0.0
        # the tree's root goes through all blocks, so blocks grow once they would be too many
        self.block_words = max(block_words, -(-int(drawn) // most_blocks))
        blocks = self._dealt(sized).groupBy("rank", "block").agg(F.sum("size").alias("words"))
        self.blocks = keep_table(self._drawn(blocks, sized), "mix-blocks")
        n = self.blocks.agg(F.sum("draws")).first()[0] or 0
        self.shards = 1 << max(0, (n // blocks_per_shard).bit_length())
        self.sized, self._plan = sized, None

    def _sized(self, *more: Column) -> DataFrame:
        doc, text, source = self.columns
        return self.docs.select(
            F.col(doc).alias("id"),
            F.col(source).alias("source"),
            _size(text).alias("size"),
            F.xxhash64(text).alias("text_hash"),
            *more,
        )

    def _dealt(self, sized: DataFrame) -> DataFrame:
        """Rows with words, in their blocks."""
        targets = self.targets.select(
            F.col("source").alias("of"), "source_size", "target", "rank"
        )
        n_blocks = F.ceil(F.col("source_size") / self.block_words)
        return (
            sized.where(F.col("size") > 0)
            .join(targets, F.col("source").eqNullSafe(F.col("of")))
            .withColumn("key", _key(self.seed, "id", "size", "text_hash"))
            .withColumn("block", F.pmod(F.xxhash64(F.lit(self.seed), "key"), n_blocks))
            .drop("of")
        )

    def _drawn(self, blocks: DataFrame, sized: DataFrame) -> DataFrame:
        """Per block how often it is drawn whole, and up to which key it is drawn once more.

        ``last_rows`` is the number of rows with the last key that are drawn once more, null
        if all of them are.
        """
        # per source over its blocks, not its rows
        earlier = Window.partitionBy("rank").orderBy("block").rowsBetween(
            Window.unboundedPreceding, -1
        )
        full = F.floor(F.col("target") / F.col("source_size"))
        rest = F.col("target") - F.col("whole") * F.col("source_size") - F.col("before")
        blocks = (
            blocks.join(self.targets.select("rank", "source_size", "target"), "rank")
            .withColumn("whole", full)
            .withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
            .withColumn("rest", rest)
            .select(
                "rank",
                "block",
                (F.col("whole") + (F.col("rest") >= F.col("words")).cast("long")).alias("whole"),
                F.when((F.col("rest") > 0) & (F.col("rest") < F.col("words")), F.col("rest")).alias(
                    "part"
                ),
            )
        )
        blocks = keep_table(blocks, "mix-block-words")
        # one block of a source at most is cut
        cut = blocks.where(F.col("part").isNotNull()).select("rank", "block", "part")
        earlier = Window.partitionBy("rank", "block").orderBy("key").rowsBetween(
            Window.unboundedPreceding, -1
        )
        # rows with the same key are equally long, so the cut falls after a number of them
        longest = F.col("size") / F.col("rows")
        keys = (
            self._dealt(sized)
            .join(cut, ["rank", "block"])
            .groupBy("rank", "block", "part", "key")
            .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
            .withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
            .withColumn(
                "fit",
                F.least("rows", F.floor((F.col("part") - F.col("before")) / longest + 0.5)),
            )
            .where("fit > 0")
            .groupBy("rank", "block")
            .agg(F.max(F.struct("key", "fit", "rows")).alias("last"))
        )
        partly = F.col("last.fit") < F.col("last.rows")
        return blocks.join(keys, ["rank", "block"], "left").select(
            "rank",
            "block",
            "whole",
            F.col("last.key").alias("last_key"),
            F.when(partly, F.col("last.fit")).alias("last_rows"),
            (F.col("whole") + F.col("last").isNotNull().cast("long")).alias("draws"),
        )

    def plan(self) -> DataFrame:
        """rank, block, whole, last_key, last_rows, copies: draws of each block, their shards."""
        if self._plan is None:
            shards = self.shard_draws().groupBy("rank", "block").agg(
                F.array_sort(F.collect_list(F.struct("draw", "shard"))).alias("copies")
            )
            self._plan = keep_table(self.blocks.join(shards, ["rank", "block"]), "mix-plan")
        return self._plan

    def taken(self) -> DataFrame:
        """id, source, size, source_size, target, taken, shards: a row per row of the input."""
        columns = ["id", "source", "size", "source_size", "target"]
        dealt = self._dealt(self.sized).join(self.plan(), ["rank", "block"], "left")
        mixed = (
            self._cut(dealt)
            .withColumn("shards", F.coalesce(self._copies()["shard"], F.array().cast("array<int>")))
            .select(*columns, (F.col("size") * F.size("shards")).alias("taken"), "shards")
        )
        targets = self.targets.select(F.col("source").alias("of"), "source_size", "target")
        empty = (
            self.sized.where(F.col("size") == 0)
            .join(targets, F.col("source").eqNullSafe(F.col("of")))
            .select(
                *columns,
                F.lit(0).cast("long").alias("taken"),
                F.array().cast("array<int>").alias("shards"),
            )
        )
        return mixed.unionByName(empty)

    @staticmethod
    def _copies() -> Column:
        """The draws of its block that a row takes part in."""
        times = F.col("whole") + F.when(F.col("once_more"), 1).otherwise(0)
        return F.slice("copies", F.lit(1), times.cast("int"))

    def _cut(self, dealt: DataFrame) -> DataFrame:
        """``dealt`` rows with ``once_more``: whether the cut of their block lies after them.

        Only where the cut falls among rows with the same key are these numbered: per task of
        a written table, after the counts of the tasks before it.
        """
        if self.plan().where("last_rows is not null").isEmpty():
            return dealt.withColumn("once_more", F.col("key") <= F.col("last_key"))
        among = F.coalesce(
            F.col("last_rows").isNotNull() & (F.col("key") == F.col("last_key")), F.lit(False)
        )
        plain = dealt.where(~among).withColumn("once_more", F.col("key") <= F.col("last_key"))
        same = keep_table(
            dealt.where(among).withColumn("at", F.monotonically_increasing_id()), "mix-same-keys"
        ).withColumn("task", F.shiftright("at", 33))
        before = Window.partitionBy("rank").orderBy("task").rowsBetween(
            Window.unboundedPreceding, -1
        )
        # one key of a source at most is cut, so a source's rows here are those of one key
        counts = same.groupBy("rank", "task").count().select(
            "rank", "task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier")
        )
        within = Window.partitionBy("rank", "task").orderBy("at")
        numbered = (
            same.withColumn("n", F.row_number().over(within))
            .join(keep_table(counts, "mix-same-counts"), ["rank", "task"])
            .withColumn("once_more", F.col("n") + F.col("earlier") <= F.col("last_rows"))
        )
        return plain.unionByName(numbered.select(*plain.columns))

    def shard_draws(self) -> DataFrame:
        """rank, block, draw (from 0), shard: which shard gets which draw of a block."""
        draws = self.blocks.where("draws > 0").select(
            "rank", "block", F.explode(F.sequence(F.lit(0), F.col("draws").cast("int") - 1)).alias("draw")
        )
        order = Window.partitionBy("rank").orderBy(
            "draw", F.xxhash64(F.lit(self.seed), "draw", "block"), "block"
        )
        draws = draws.withColumn("place", F.row_number().over(order).cast("long"))
        quotas = self.blocks.groupBy("rank").agg(F.sum("draws").alias("quota"))
        split = split_quotas(quotas, self.shards, self.seed)
        earlier = Window.partitionBy("rank").orderBy("shard")
        places = (
            split.withColumn("upto", F.sum("quota").over(earlier))
            .where("quota > 0")
            .select(
                "rank",
                "shard",
                F.explode(F.sequence(F.col("upto") - F.col("quota") + 1, F.col("upto"))).alias("place"),
            )
        )
        return draws.join(places, ["rank", "place"]).select("rank", "block", "draw", "shard")

    def rows(self) -> DataFrame:
        """The mixed rows, as columns of the input: shard by shard, shuffled within."""
        row = F.struct(*[F.col(f"`{c}`") for c in self.docs.columns]).alias("row")
        dealt = self._dealt(self._sized(row)).join(self.plan(), ["rank", "block"])
        return (
            self._cut(dealt)
            .withColumn("copy", F.explode(self._copies()))
            .select("row", "key", F.col("copy.draw").alias("draw"), F.col("copy.shard").alias("shard"))
            .repartition("shard")
            .sortWithinPartitions("shard", F.xxhash64("key", "draw"))
            .select("row.*")
        )


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = Mix(documents(spark, sf_dir)).taken()
    return taken.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "shards"
    )


QUERIES = {"op8_mix_sources": op8_mix_sources}
SQL: dict[str, str] = {}
