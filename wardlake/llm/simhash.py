"""SimHash near-duplicates by anchor-point covering.

The 64 bits of a fingerprint fall into three blocks (23, 23 and 18 bits, the last
padded with zeros). The anchors of a block are the words of the perfect binary
[23, 12] code of radius 3: every block value lies within 3 bits of exactly one
anchor. Of two fingerprints that differ in at most 4 bits, some two blocks differ in
at most 2 bits together, so a value halfway lies within one bit, in one of the two
blocks, of either side. Its anchor pair is therefore within the covering radius plus
half the threshold of both: a fingerprint goes to the pairs whose distances are at
most (3, 4) or (4, 3), about 29 in all, and is compared with what meets it there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.llm.components import component_roots
from wardlake.llm.shared import in_workers, stored, text_of
from wardlake.llm.text import blocks, lowered, words

SHINGLE_WORDS = 4
THRESHOLD = 4
SEED = 42
#: Generator polynomial, length, check bits and radius of the code.
GENERATOR, LENGTH, CHECK_BITS, RADIUS = 0b101011100011, 23, 11, 3
#: (lowest bit, width) of the blocks of a fingerprint.
BLOCKS = ((0, 23), (23, 23), (46, 18))
#: Fingerprints compared with each other in one piece of work.
TILE = 4096


def fingerprints_of(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the texts of a block."""
    data = lowered(data)
    starts, ends, first = words(data, offs)
    out = np.zeros(len(offs) - 1, np.uint64)
    count = np.diff(first)
    if not len(starts):
        return out
    # One space after each word and nothing else between words.
    keep = np.zeros(len(data) + 1, bool)
    covered = np.zeros(len(data) + 1, np.int8)
    covered[starts] += 1
    covered[ends] -= 1
    keep[:-1] = np.cumsum(covered[:-1]) > 0
    at = np.cumsum(keep) - keep
    order = np.arange(len(starts))
    lead, tail = at[starts] + order, at[ends - 1] + order + 1
    plain = np.full(int(tail[-1]) + 1, 32, np.uint8)
    inside = np.flatnonzero(keep)
    plain[at[inside] + np.searchsorted(starts, inside, "right") - 1] = data[inside]
    text = plain.tobytes()

    shingles = np.maximum(count - (SHINGLE_WORDS - 1), np.minimum(count, 1))
    row = np.repeat(np.arange(len(count)), shingles)
    begin = np.cumsum(shingles) - shingles
    word = first[:-1][row] + np.arange(len(row)) - begin[row]
    last = np.minimum(word + SHINGLE_WORDS, first[1:][row]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (
            digest(text[a:b], SEED)
            for a, b in zip(lead[word].tolist(), tail[last].tolist(), strict=True)
        ),
        np.uint64,
        len(word),
    )
    bits = np.unpackbits(
        hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    )
    some = np.flatnonzero(shingles)
    ones = np.add.reduceat(bits, begin[some], axis=0, dtype=np.int32)
    set_bits = 2 * ones > shingles[some, None]
    packed = np.packbits(set_bits, axis=1, bitorder="little")
    out[some] = np.ascontiguousarray(packed).view(np.uint64).ravel()
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            fingerprints_of(data, offs)
            for _, _, data, offs in blocks(batch.column("text"))
        ]
        whole = np.concatenate(found) if found else np.zeros(0, np.uint64)
        names = [name for name in batch.schema.names if name != "text"]
        yield pa.record_batch(
            [*map(batch.column, names), pa.array(whole.view(np.int64))],
            names=[*names, "fp"],
        )


def fingerprints(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, more, fp long) of every document; a text without words has 0."""
    rows = text_of(docs, *more)
    fields = [field for field in rows.schema.fields if field.name != "text"]
    return in_workers(rows).mapInArrow(
        _fingerprint_batches, T.StructType([*fields, T.StructField("fp", T.LongType())])
    )


def _syndromes(values: np.ndarray) -> np.ndarray:
    """Remainders of the values as polynomials, by the generator."""
    rest = values.astype(np.int64)
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        rest ^= ((rest >> bit) & 1) * (GENERATOR << (bit - CHECK_BITS))
    return rest


def error_patterns() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each syndrome, the patterns of up to RADIUS + 1 bits that have it: start
    of its run (one entry more than syndromes), patterns, and their excess over
    RADIUS."""
    patterns = np.array(
        [
            sum(1 << bit for bit in bits)
            for weight in range(RADIUS + 2)
            for bits in combinations(range(LENGTH), weight)
        ],
        np.int64,
    )
    excess = np.maximum(np.bitwise_count(patterns).astype(np.int64) - RADIUS, 0)
    found = _syndromes(patterns)
    order = np.lexsort((excess, found))
    start = np.searchsorted(found[order], np.arange((1 << CHECK_BITS) + 1))
    return start, patterns[order], excess[order]


def block_anchors(values: np.ndarray, table: tuple) -> tuple[np.ndarray, ...]:
    """(row, anchor, excess) for all anchors within RADIUS + 1 of each value."""
    start, patterns, excess = table
    found = _syndromes(values)
    many = start[found + 1] - start[found]
    row = np.repeat(np.arange(len(values)), many)
    place = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    at = start[found][row] + place
    return row, values[row] ^ patterns[at], excess[at]


def anchor_pairs(fp: np.ndarray, table: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all anchor pairs a fingerprint goes to."""
    rows, keys = [], []
    values = fp.astype(np.uint64)
    parts = []
    for low, width in BLOCKS:
        part = (values >> np.uint64(low)) & np.uint64((1 << width) - 1)
        parts.append(block_anchors(part.astype(np.int64), table))
    for pair, (u, v) in enumerate(combinations(range(len(BLOCKS)), 2)):
        for a, b in ((u, v), (v, u)):
            # ``a`` may be one bit beyond the radius, ``b`` has its own anchor; the
            # pair of both own anchors is taken once.
            far_row, far, far_excess = parts[a]
            own_row, own, own_excess = parts[b]
            own = own[own_excess == 0]
            if (a, b) != (u, v):
                beyond = far_excess > 0
                far_row, far = far_row[beyond], far[beyond]
            left, right = (far, own[far_row]) if a == u else (own[far_row], far)
            rows.append(far_row)
            keys.append((pair << 46) | (left << 23) | right)
    return np.concatenate(rows), np.concatenate(keys)


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = error_patterns()
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        for low in range(0, len(fp), 4096):
            some = fp[low : low + 4096]
            row, key = anchor_pairs(some.view(np.uint64), table)
            yield pa.record_batch(
                [pa.array(key), pa.array(some[row])], names=["anchor", "fp"]
            )


def _linked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all values connected at THRESHOLD; fewer links than values."""
    left = np.arange(len(values))
    near, far = [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            one = front.pop()
            hit = np.bitwise_count(values[left] ^ values[one]) <= THRESHOLD
            new = left[hit]
            front.extend(new.tolist())
            far.append(new)
            near.append(np.full(len(new), one))
            left = left[~hit]
    if not near:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(near), np.concatenate(far)


def _compare(keys: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal keys. Short runs are compared by shifts of the
    whole column, long ones each by itself."""
    edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.append(edge, len(keys)))
    near, far = [], []
    short = np.repeat(size <= 8, size)
    k, v = keys[short], fp[short]
    for shift in range(1, 8):
        if shift >= len(k):
            break
        same = np.flatnonzero(k[shift:] == k[:-shift])
        if not len(same):
            break
        hit = same[np.bitwise_count(v[same] ^ v[same + shift]) <= THRESHOLD]
        near.append(v[hit])
        far.append(v[hit + shift])
    for a, n in zip(edge[size > 8].tolist(), size[size > 8].tolist(), strict=True):
        i, j = _linked(fp[a : a + n])
        near.append(fp[a : a + n][i])
        far.append(fp[a : a + n][j])
    if not near:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(near), np.concatenate(far)


def _compare_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by piece; a piece may go on in the next batch."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        piece = table.column("piece").to_numpy()
        cut = int(np.searchsorted(piece, piece[-1])) if len(piece) else 0
        rest = table.slice(cut)
        if cut:
            yield _links(table.slice(0, cut))
    if rest is not None and rest.num_rows:
        yield _links(rest)


def _links(table: pa.Table) -> pa.RecordBatch:
    near, far = _compare(
        table.column("piece").to_numpy(),
        table.column("fp").to_numpy().view(np.uint64),
    )
    return pa.record_batch(
        [pa.array(near.view(np.int64)), pa.array(far.view(np.int64))],
        names=["a", "b"],
    )


def fingerprint_links(distinct: DataFrame, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints at most THRESHOLD bits apart.

    Enough links are given for the components: a chain of them joins any two that
    meet at an anchor and link. An anchor with more than ``tile`` fingerprints is
    worked on in pairs of tiles, which are dealt to different tasks, so no task
    holds more than two tiles of it.
    """
    rows = in_workers(distinct.select("fp")).mapInArrow(_anchor_batches, "anchor long, fp long")
    crowded = (
        rows.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > tile)
        .select("anchor", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    )
    crowded = stored(crowded, "crowded")
    tiles = F.coalesce("tiles", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    dealt = (
        rows.join(crowded, "anchor", "left")
        .withColumn("own", own)
        .select(
            "anchor",
            "fp",
            "own",
            F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"),
        )
        .select(
            F.xxhash64(
                "anchor", F.least("own", "other"), F.greatest("own", "other")
            ).alias("piece"),
            "fp",
        )
    )
    pieces = dealt.repartition("piece").sortWithinPartitions("piece")
    return pieces.mapInArrow(_compare_batches, "a long, b long").distinct()


def _members(prints: DataFrame, least: Column) -> DataFrame:
    """(fp, least, root) of every distinct fingerprint."""
    distinct = stored(prints.groupBy("fp").agg(F.min(least).alias("least")), "distinct")
    roots = component_roots(fingerprint_links(distinct))
    member = distinct.join(
        roots.withColumnRenamed("node", "fp"), "fp", "left"
    ).select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return stored(member, "members")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id.

    Texts link when their fingerprints differ in 4 bits or fewer; a component is all
    that links lead to, and its id the smallest doc_id in it. A null or empty text
    has fingerprint zero and links like any other. Null ids are never smallest.
    Repeated rows get a row each. Only ``doc_id`` and ``text`` are read; an empty
    table gives an empty result.
    """
    prints = stored(fingerprints(docs), "prints")
    member = _members(prints, F.col("doc_id"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = member.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _row_key() -> Column:
    """A digest of id and text together; a null id is told from all others."""
    doc_id = F.concat(F.lit("+"), F.col("doc_id").cast("string"))
    text = F.coalesce("text", F.lit(""))
    return F.md5(F.concat_ws("\n", F.coalesce(doc_id, F.lit("-")), text).cast("binary"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest id, null ids
    last, and of different texts with that id the one with the smallest digest. An id
    may repeat, so a row is found again by id and text together."""
    prints = stored(fingerprints(docs, _row_key().alias("row_key")), "prints")
    least = F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "row_key")
    chosen = _members(prints, least).groupBy("root").agg(F.min("least").alias("least"))
    rows = docs.withColumn("__key", _row_key()).join(
        chosen.select(F.col("least.row_key").alias("__key")), "__key"
    )
    return rows.dropDuplicates(["__key"]).select(*docs.columns)
