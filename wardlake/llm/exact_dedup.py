"""Exact duplicates by an extendible-hash index on shared files.

Keys are 64-bit hashes of the normalised texts. A directory maps the leading bits
of a key to a bucket: where a bucket holds too many distinct keys, the directory
doubles and the bucket splits on its next bit. The index is built bucket by bucket:
texts of one bucket and key are told apart by their bytes and chained, so two texts
that share a hash stay apart. Every document is then looked up in the bucket that owns
its key, and finds its chain place there by a SHA-256 digest of its text. Copies are
folded before the exchange, so a text that makes up a third of all rows reaches its
owner as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.shared import WHITE, stored

#: Distinct keys a bucket holds before it splits.
BUCKET_KEYS = 1024
#: Leading bits the directory can use; it has 2**16 entries at most, so it may be
#: broadcast. Buckets of larger indexes hold as many more keys.
MAX_DEPTH = 16
#: Bits of a key.
KEY_BITS = 64
#: What leads to a text: its bucket, its key and, along the chain, its digest.
ADDRESS = ["depth", "bucket", "key", "digest"]


def normalised(text="text"):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, " ")


def _keyed(docs: DataFrame, key_bits: int = KEY_BITS) -> DataFrame:
    plain = docs.select("doc_id", normalised().alias("plain"))
    leading = F.lit(-1 << (KEY_BITS - key_bits)).cast("long")
    return plain.withColumn("key", F.xxhash64("plain").bitwiseAND(leading))


def _slot(key: str = "key"):
    return F.shiftrightunsigned(key, 64 - MAX_DEPTH)


def directory(entries: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """slot -> (depth, bucket): the shallowest depth at which its bucket is not
    overfull. It begins with as many bits as full buckets of all keys would need.
    Rows: at most 2**MAX_DEPTH."""
    slots = entries.groupBy(_slot().alias("slot")).agg(
        F.countDistinct("key").alias("keys")
    )
    total = slots.agg(F.coalesce(F.sum("keys"), F.lit(0)).alias("n")).first()["n"]
    capacity = max(bucket_keys, -(-total * 4 // (1 << MAX_DEPTH)))
    begin = min(MAX_DEPTH, max(0, (total // capacity).bit_length()))
    deep = slots.select(
        "slot", "keys", F.explode(F.sequence(F.lit(begin), F.lit(MAX_DEPTH))).alias("depth")
    ).withColumn("bucket", F.expr(f"shiftright(slot, {MAX_DEPTH} - depth)"))
    loads = deep.groupBy("depth", "bucket").agg(F.sum("keys").alias("load"))
    fits = loads.filter((F.col("load") <= capacity) | (F.col("depth") == MAX_DEPTH))
    return (
        deep.join(fits, ["depth", "bucket"])
        .groupBy("slot")
        .agg(F.min(F.struct("depth", "bucket")).alias("at"))
        .select("slot", "at.depth", "at.bucket")
    )


def owned(keyed: DataFrame, owners: DataFrame) -> DataFrame:
    """``keyed`` with the bucket of each key. The directory has 2**MAX_DEPTH rows at
    most, which is what lets it be broadcast."""
    placed = keyed.withColumn("slot", _slot())
    return placed.join(F.broadcast(owners), "slot").drop("slot")


def build_index(
    docs: DataFrame, entries: DataFrame, owners: DataFrame, key_bits: int = KEY_BITS
) -> DataFrame:
    """The index: one row per distinct text with its bucket, the chain place among
    texts of equal key, its digest, smallest id, number of rows, and ``head``, the
    place of the row that stays."""
    texts = (
        owned(_keyed(docs, key_bits), owners)
        .groupBy("depth", "bucket", "key", "plain")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .withColumn("digest", F.unhex(F.sha2("plain", 256)))
    )
    least = F.min(F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "place"))
    heads = owned(entries, owners).groupBy(*ADDRESS).agg(least["place"].alias("head"))
    chain = Window.partitionBy("depth", "bucket", "key").orderBy("digest")
    index = (
        texts.select(*ADDRESS, "keep_id", "group_size")
        .join(heads, ADDRESS)
        .repartition("depth", "bucket")
        .withColumn("chained", F.row_number().over(chain) - 1)
        .sortWithinPartitions(*ADDRESS)
    )
    return stored(index, "index")


def exact_duplicates(docs: DataFrame, key_bits: int = KEY_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space becomes one space;
    a null text is empty. The row with the smallest id of a group stays. Ids that
    are null are larger than all others; a group without any id keeps one of its
    rows. Of repeated rows (same id, same text) one stays. Only ``doc_id`` and
    ``text`` are read. An empty table gives an empty result. Shorter keys make longer
    chains and the same result.
    """
    entries = stored(
        _keyed(docs, key_bits).select(
            "doc_id",
            "key",
            F.unhex(F.sha2("plain", 256)).alias("digest"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "entries",
    )
    owners = stored(directory(entries), "directory")
    index = build_index(docs, entries, owners, key_bits)
    found = owned(entries, owners).join(index.drop("chained"), ADDRESS)
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("place") == F.col("head")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are (see above)."""
    key = F.struct("digest", "doc_id")
    kept = exact_duplicates(docs).filter("kept").select(
        F.struct(F.col("text_sha256").alias("digest"), F.col("keep_id").alias("doc_id")).alias("key")
    )
    rows = docs.select(
        F.sha2(normalised(), 256).alias("digest"), "doc_id", F.struct(*docs.columns).alias("row")
    )
    # By one key, of which no part is joined on alone: whole rows are exchanged once.
    distinct = rows.select(key.alias("key"), "row").dropDuplicates(["key"])
    return distinct.join(kept, "key", "left_semi").select("row.*")
