"""Shards of near-equal bytes by a k-d tree over document metadata.

Every document is a point: its size, language, source and id, each scaled to the
range it has in the whole table. A node is split along its widest dimension at the
weighted median of that dimension; documents with the same coordinate are told apart
by a hash. Medians come from histograms: all nodes of a level are counted at once,
then the bin that holds each median is counted again more finely, until what is left
in it does not matter. Only one row per node and histogram bin is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.shared import stored

SHARDS = 16
BINS = 4096
#: A median may be off by this share of a shard's bytes.
TOLERANCE = 0.0005
#: Rows of a run in which slots are numbered, on average.
SLOT_ROWS = 4096
TIE_BITS = 31


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, one number per dimension, and the row's place in the
    table as it is read (``at``), which tells repeated rows apart once it is stored."""
    text = F.coalesce("text", F.lit(""))

    def name_number(name: str) -> Column:
        return F.coalesce(F.crc32(F.col(name).cast("binary")), F.lit(-1)).cast("double")

    doc_id = F.coalesce(F.col("doc_id").cast("double"), F.lit(-1.0))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        name_number("lang").alias("x0"),
        name_number("source").alias("x1"),
        F.log2(F.octet_length(text) + 1.0).alias("x2"),
        doc_id.alias("x3"),
        F.monotonically_increasing_id().alias("at"),
    )


DIMENSIONS = ("x0", "x1", "x2", "x3")


def points(meta: DataFrame) -> DataFrame:
    """``keys``: per dimension the coordinate scaled to 31 bits, above a hash."""
    ends = [f(d).alias(f"{d}_{f.__name__}") for d in DIMENSIONS for f in (F.min, F.max)]
    limits = meta.agg(*ends).first()
    tie = F.pmod(F.xxhash64("doc_id", "text_crc32", "size", "at"), F.lit(1 << TIE_BITS))

    def key(d: str) -> Column:
        least = limits[f"{d}_min"] or 0.0
        span = (limits[f"{d}_max"] or 0.0) - least
        share = (F.col(d) - least) / span if span > 0 else F.lit(0.0)
        return F.floor(share * ((1 << 31) - 1)).cast("long") * (1 << TIE_BITS) + tie

    return meta.select(
        "doc_id",
        "size",
        "text_crc32",
        "at",
        F.array(*[key(d) for d in DIMENSIONS]).alias("keys"),
        F.lit(0).alias("low"),
    )


def _widest(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per node: its widest dimension, the keys it spans there, and half its bytes
    in proportion to the shards on the left."""
    spans = rows.groupBy("low").agg(
        F.sum("size").alias("bytes"),
        *[
            f(F.col("keys")[i]).alias(f"{f.__name__}{i}")
            for i in range(len(DIMENSIONS))
            for f in (F.min, F.max)
        ],
    )
    # The place is the second sort field, so of equal widths the first one counts.
    widths = F.greatest(
        *[
            F.struct(
                F.shiftright(F.col(f"max{i}"), TIE_BITS)
                - F.shiftright(F.col(f"min{i}"), TIE_BITS),
                F.lit(-i).alias("place"),
                F.col(f"min{i}").alias("first"),
                F.col(f"max{i}").alias("last"),
            )
            for i in range(len(DIMENSIONS))
        ]
    )
    middle = F.expr("low + (high - low + 1) div 2").cast("int")
    return (
        nodes.join(spans, "low")
        .withColumn("widest", widths)
        .select(
            "low",
            middle.alias("middle"),
            (-F.col("widest.place")).alias("dim"),
            F.col("widest.first").alias("first"),
            F.col("widest.last").alias("last"),
            F.lit(0).cast("long").alias("before"),
            (F.col("bytes") * (middle - F.col("low")) / (F.col("high") - F.col("low")))
            .alias("goal"),
            (F.col("bytes") / (F.col("high") - F.col("low"))).alias("share"),
            F.col("bytes").alias("inside"),
        )
    )


def _finer(rows: DataFrame, medians: DataFrame) -> DataFrame:
    """The medians with the bin that holds them in place of their span."""
    key = F.element_at("keys", F.col("dim") + 1)
    width = F.ceil((F.col("last") - F.col("first") + 1) / F.lit(float(BINS)))
    bins = (
        rows.join(F.broadcast(medians), "low")
        .withColumn("key", key)
        .filter(F.col("key").between(F.col("first"), F.col("last")))
        .groupBy(
            "low", F.floor((F.col("key") - F.col("first")) / width).alias("bin")
        )
        .agg(
            F.sum("size").alias("in_bin"),
            F.min("key").alias("bin_first"),
            F.max("key").alias("bin_last"),
        )
    )
    upto = F.sum("in_bin").over(Window.partitionBy("low").orderBy("bin"))
    found = (
        bins.withColumn("upto", upto)
        .join(F.broadcast(medians), "low")
        .filter(F.col("before") + F.col("upto") >= F.col("goal"))
        .groupBy("low")
        .agg(
            F.min(F.struct("bin", "bin_first", "bin_last", "in_bin", "upto")).alias("b")
        )
    )
    return medians.join(found, "low").select(
        "low",
        "middle",
        "dim",
        F.col("b.bin_first").alias("first"),
        F.col("b.bin_last").alias("last"),
        (F.col("before") + F.col("b.upto") - F.col("b.in_bin")).alias("before"),
        "goal",
        "share",
        F.col("b.in_bin").alias("inside"),
    )


def _cuts(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """low, middle, dim, cut: keys below ``cut`` go left."""
    medians = stored(_widest(rows, nodes), "medians")
    while True:
        medians = stored(_finer(rows, medians), "medians")
        open_ = (F.col("last") > F.col("first")) & (
            F.col("inside") > F.col("share") * TOLERANCE
        )
        if not medians.filter(open_).limit(1).count():
            break
    nearer = F.col("goal") - F.col("before") > F.col("inside") / 2
    cut = F.when(nearer, F.col("last") + 1).otherwise(F.col("first"))
    return stored(medians.select("low", "middle", "dim", cut.alias("cut")), "cuts")


def _shards_of(points_: DataFrame, shards: int) -> DataFrame:
    """Rows with ``low``, the shard. Node tables have one row per shard at most, so
    they are broadcast."""
    rows = points_
    nodes = rows.select(F.lit(0).alias("low"), F.lit(shards).alias("high")).limit(1)
    width = shards
    while width > 1:
        cuts = _cuts(rows, nodes.filter("high - low > 1"))
        below = F.element_at("keys", F.col("dim") + 1) < F.col("cut")
        moved = F.when(F.col("middle").isNull() | below, F.col("low"))
        rows = rows.join(F.broadcast(cuts), "low", "left").select(
            *[c for c in rows.columns if c != "low"],
            moved.otherwise(F.col("middle")).alias("low"),
        )
        split = nodes.join(F.broadcast(cuts), "low", "left")
        nodes = stored(
            split.select(
                "low", F.coalesce("middle", "high").alias("high")
            ).unionByName(
                split.filter("middle is not null").select(
                    F.col("middle").alias("low"), "high"
                )
            ),
            "nodes",
        )
        width = -(-width // 2)
    return rows


def with_slots(rows: DataFrame, shards: int) -> DataFrame:
    """``slot``: places in a shard from 0 without gaps. Rows are numbered in short
    runs of a hash; each run starts where those before it end."""
    n = rows.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    runs = max(1, -(-n // (shards * SLOT_ROWS)))
    rows = rows.withColumn(
        "run", F.pmod(F.xxhash64("doc_id", "text_crc32", "at"), F.lit(runs))
    )
    counts = rows.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("shard").orderBy("run")
    begins = counts.select(
        "shard", "run", (F.sum("n").over(upto) - F.col("n")).alias("begin")
    )
    place = Window.partitionBy("shard", "run").orderBy("doc_id", "text_crc32", "at")
    return (
        rows.join(begins, ["shard", "run"])
        .withColumn("slot", F.col("begin") + F.row_number().over(place) - 1)
        .drop("run", "begin", "at")
    )


def kd_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    Shards have near-equal bytes (size: bytes of the text plus 1). A null text is
    empty; a null language, source or id is a coordinate of its own below all
    others. Rows with the same id and text are dealt out like any others: their places
    in the table as read tell them apart. Only ``doc_id``, ``text``, ``lang`` and ``source`` are read; an empty
    table gives an empty result.
    """
    meta = stored(metadata(docs), "metadata")
    rows = _shards_of(points(meta), shards).select(
        "doc_id", "size", "text_crc32", "at", F.col("low").alias("shard")
    )
    return with_slots(stored(rows, "sharded"), shards)


def sharded_documents(docs: DataFrame, target_bytes: int = 256 << 20) -> DataFrame:
    """``docs`` with ``shard``, in as many shards as leave ``target_bytes`` in each;
    rows of a shard lie together. Rows with the same id and text are dealt over the
    shards that the tree gives them, in proportion to the rows it gives each. A column
    of ``docs`` named ``shard`` is replaced; other names are kept, whatever they are.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))
    crc, size = F.crc32(text.cast("binary")), F.octet_length(text) + 1
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-total // target_bytes))
    key = ["doc_id", "text_crc32", "size"]
    upto = Window.partitionBy(*key).orderBy("shard")
    found = (
        kd_shards(docs, shards)
        .groupBy(*key, "shard")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(upto))
        .groupBy(*key)
        .agg(
            F.sort_array(F.collect_list(F.struct("upto", "shard"))).alias("places"),
            F.max("upto").alias("n"),
        )
    )
    same = (
        F.col("row.doc_id").eqNullSafe(F.col("doc_id"))
        & (crc == F.col("text_crc32"))
        & (size == F.col("size"))
    )
    draw = F.pmod(F.xxhash64("at"), F.col("n"))
    place = F.get(F.filter("places", lambda one: one["upto"] > draw), F.lit(0))
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "shard"]
    return (
        rows.withColumn("at", F.monotonically_increasing_id())
        .join(found, same)
        .select(*kept, place["shard"].alias("shard"))
        .repartition("shard")
        .sortWithinPartitions("shard", "doc_id")
    )
