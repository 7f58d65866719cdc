"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents of a source are permuted by a hash of their id and cut into blocks of about
equal row counts. A source's quota is a whole number of copies of all its blocks plus
the first blocks of one more copy; its last block is filled document by document. The
block copies of all sources are then split among the output shards: at every node of
a binary tree a random half of the node's block copies goes left. The number each
source gets there is exactly a multivariate-hypergeometric draw, block copies are
never dealt twice, and the quotas add up at every level. Inside a shard rows are
ordered by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.shared import WORD, stored

SEED = "mix-1"
#: Weights by rank of the source in code-point order, repeating; null comes last.
WEIGHTS = (1, 2, 3)
#: A document is drawn this often at most.
MAX_COPIES = 3
#: Rows of a block; large tables have larger blocks, so their list stays small.
BLOCK_ROWS, BLOCKS = 64, 50_000
#: Rounds that fill what the last block leaves open with the largest that fit.
FILL_ROUNDS = 2
SHARDS = 16


def permutation_key(doc_id: Column) -> Column:
    """60 bits of md5 of the seeded id."""
    text = F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def source_plan(sizes: DataFrame, weights=WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """Per source: rows, source_size, target, whole copies, words beyond them, blocks.

    Targets share the total by weight; one that would pass ``most`` times its source
    stops there and the rest is shared again. In order of size by weight the stopped
    sources come first, so one pass over the sources finds them.
    """
    sources = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("source_size")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sources.withColumn("sid", F.row_number().over(by_name))
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("sid") - 1) % len(weights) + 1
    )
    sources = sources.withColumn("weight", weight.cast("long"))
    everything = Window.partitionBy(F.lit(0))
    by_ratio = everything.orderBy(
        F.col("source_size") / F.col("weight"), "sid"
    )
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)

    def wide(c):
        return c.cast("decimal(38,0)")

    total, all_weights = (
        F.sum("source_size").over(everything),
        F.sum("weight").over(everything),
    )
    rest = total - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    open_weights = all_weights - F.coalesce(F.sum("weight").over(before), F.lit(0))
    stops = wide(most * F.col("source_size")) * wide(open_weights) < wide(
        F.col("weight")
    ) * wide(rest)
    sources = sources.withColumn("stops", stops)
    held = F.sum(F.when(F.col("stops"), most * F.col("source_size")).otherwise(0))
    free = F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight")))
    shared = (
        F.col("weight") * (total - held.over(everything))
    ).cast("double") / free.over(everything).cast("double")
    rows = F.sum("n_rows").over(everything)
    block_rows = F.greatest(F.lit(BLOCK_ROWS), F.ceil(rows / F.lit(BLOCKS)))
    planned = sources.select(
        "sid",
        "source",
        "source_size",
        F.when(F.col("stops"), (most * F.col("source_size")).cast("double"))
        .otherwise(shared)
        .alias("target"),
        F.greatest(F.lit(1), F.ceil(F.col("n_rows") / block_rows))
        .cast("long")
        .alias("n_blocks"),
    )
    whole = F.when(
        F.col("source_size") > 0,
        F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size"))),
    ).otherwise(0)
    return planned.withColumn("whole", whole.cast("int")).withColumn(
        "part", F.col("target") - F.col("whole") * F.col("source_size")
    )


def split_blocks(blocks: DataFrame, shards: int) -> DataFrame:
    """(sid, block) -> shards of its copies, by the splitting tree."""
    copies = blocks.filter("copies > 0").select(
        "sid",
        "block",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
        F.lit(0).alias("low"),
        F.lit(shards).alias("high"),
    )
    width, level = shards, 0
    while width > 1:
        node = Window.partitionBy("low")
        draw = F.xxhash64(F.lit(SEED), F.lit(level), "sid", "block", "copy")
        place = F.row_number().over(node.orderBy(draw, "sid", "block", "copy"))
        middle = F.expr("low + (high - low + 1) div 2").cast("int")
        share = (middle - F.col("low")) / (F.col("high") - F.col("low"))
        left = place <= F.round(F.count(F.lit(1)).over(node) * share)
        copies = copies.withColumn("left", left).select(
            "sid",
            "block",
            "copy",
            F.when(F.col("left"), F.col("low")).otherwise(middle).alias("low"),
            F.when(F.col("left"), middle).otherwise(F.col("high")).alias("high"),
        )
        width, level = -(-width // 2), level + 1
    dealt = F.array_sort(F.collect_list(F.struct("copy", "low")))
    return (
        copies.groupBy("sid", "block")
        .agg(dealt.alias("dealt"))
        .select("sid", "block", F.col("dealt.low").alias("dealt"))
    )


def mix(docs: DataFrame, shards: int = SHARDS, whole_rows: bool = False) -> DataFrame:
    """One row per document: doc_id, ``size`` (words), ``source_size``, ``target``
    and ``shards``, the output shard of each of its copies (none: the mix leaves it
    out); with ``whole_rows`` also ``row``, all its columns.

    A null text has no words; a null source is a source of its own, after all
    others. A source without words has target 0. Every source's drawn words are at
    its target but for what no further document of its last block fits into; a
    document is drawn three times at most. Rows that repeat are documents of their
    own. The draw depends on ids, sizes and sources alone, so reruns agree. An empty
    table gives an empty result.
    """
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    whole = [F.struct(*docs.columns).alias("row")] if whole_rows else []
    sized = docs.select(
        "doc_id",
        "source",
        size.alias("size"),
        permutation_key(F.col("doc_id")).alias("u"),
    )
    sizes = stored(sized, "sizes")
    plan = stored(source_plan(sizes), "sources")
    facts = plan.withColumnRenamed("source", "name")
    rows = sizes
    if whole_rows:
        rows = docs.select(
            F.col("doc_id"),
            F.col("source"),
            size.alias("size"),
            permutation_key(F.col("doc_id")).alias("u"),
            *whole,
        )

    def placed(df: DataFrame) -> DataFrame:
        block = F.expr("shiftright(shiftright(u, 20) * n_blocks, 40)")
        return df.join(facts, F.col("source").eqNullSafe(F.col("name"))).withColumn(
            "block", block
        )

    blocks = stored(block_quotas(placed(sizes)), "blocks")
    dealt = stored(split_blocks(blocks, shards), "dealt")
    quotas = blocks.join(dealt, ["sid", "block"], "left").select(
        "sid", "block", "room", "dealt"
    )
    rows = _last_block(placed(rows).join(quotas, ["sid", "block"]))
    drawn = F.coalesce(
        F.slice("dealt", 1, F.col("whole") + F.col("more").cast("int")),
        F.array().cast("array<int>"),
    )
    return rows.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        drawn.alias("shards"),
        *(["row"] if whole_rows else []),
    )


def block_quotas(placed: DataFrame) -> DataFrame:
    """Per block: copies to draw, and ``room``, the words left for it in the copy
    that is drawn in part."""
    upto = Window.partitionBy("sid").orderBy("block")
    return (
        placed.groupBy("sid", "block", "whole", "part")
        .agg(F.sum("size").alias("words"))
        .withColumn("upto", F.sum("words").over(upto))
        .withColumn("room", F.col("part") - (F.col("upto") - F.col("words")))
        .withColumn("copies", F.col("whole") + (F.col("room") > 0).cast("int"))
        .select("sid", "block", "room", "copies")
    )


def _last_block(rows: DataFrame) -> DataFrame:
    """``more``: whether a document is in the copy drawn in part. First in order of
    the permutation, then the largest documents that still fit."""
    block = Window.partitionBy("sid", "block")

    def running(*order):
        upto = block.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return F.sum("size").over(upto)

    first = running("u", "doc_id", "size") <= F.col("room")
    rows = rows.withColumn("more", (F.col("room") > 0) & first)
    for _ in range(FILL_ROUNDS):
        taken = F.sum(F.when(F.col("more"), F.col("size")).otherwise(0)).over(block)
        rows = rows.withColumn("left", F.col("room") - taken)
        rows = rows.withColumn(
            "fits", ~F.col("more") & (F.col("size") <= F.col("left"))
        )
        largest = running(F.desc("fits"), F.desc("size"), "u", "doc_id")
        more = F.col("more") | (F.col("fits") & (largest <= F.col("left")))
        rows = rows.withColumn("more", more)
    return rows


def mixed_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is drawn, by shard
    and in shuffled order inside a shard."""
    rows = mix(docs, shards, whole_rows=True)
    rows = rows.select("row", F.posexplode("shards").alias("copy", "shard"))
    return (
        rows.withColumn("place", F.xxhash64(F.lit(SEED), "row.doc_id", "copy"))
        .repartition("shard", F.pmod("place", F.lit(64)))
        .sortWithinPartitions("shard", "place")
        .select("row.*")
    )
