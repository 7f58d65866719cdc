"""Removal of byte strings that occur more than once, by suffix sorting.

A window of 400 bytes is assigned to its anchor, the 64-byte string in it whose hash
is smallest; equal windows have the same anchor, so only windows of anchors that occur
twice need to be compared, and those of one anchor can be compared by themselves.
The stretches of text around such anchors are dealt by anchor, sorted by a two-stage
suffix sort, and neighbours with a common prefix of a whole window are repeats.

Equal texts are taken together first. An anchor that occurs very often is dealt in
portions; what is distinct within a portion is then compared across portions by the
digest of the window. Nothing is capped.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.shared import in_workers, stored, text_of
from wardlake.llm.suffix_array import window_runs
from wardlake.llm.text import BYTE_VALUES, INVERSE, blocks, mixed, powers

WINDOW = 400
ANCHOR = 64
#: Places of a window at which its anchor can lie.
PLACES = WINDOW - ANCHOR + 1
#: Longest stretch handled at once; longer texts are cut, overlapping by a window.
STRETCH = 1 << 20
#: Low bits of a hash that are replaced by the place, so that the first of equals wins.
PLACE_BITS = 21
#: Stretches of one anchor that are sorted together.
PORTION = 4096
#: Bytes of stretches that are sorted together.
SORTED_BYTES = 400_000


def anchors(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first window, number of windows, hash) of all anchors of the texts: runs
    of windows with the same anchor at the same place. Windows by place in the text."""
    n = len(data)
    if n < WINDOW:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    with np.errstate(over="ignore"):
        terms = BYTE_VALUES[data] * powers(n)
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms)))
        inverse = np.full(n - ANCHOR + 1, INVERSE, np.uint64)
        inverse[0] = 1
        inverse = np.cumprod(inverse, dtype=np.uint64)
        hashes = mixed((prefix[ANCHOR:] - prefix[:-ANCHOR]) * inverse)
    del terms, prefix, inverse
    low = np.uint64((1 << PLACE_BITS) - 1)
    ranked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    pad = -len(ranked) % PLACES
    grid = np.append(ranked, np.full(pad, ~np.uint64(0))).reshape(-1, PLACES)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - WINDOW + 1
    least = np.minimum(behind[:count], ahead[PLACES - 1 : PLACES - 1 + count])
    place = (least & low).astype(np.int64)
    row = np.searchsorted(offs, np.arange(count), "right") - 1
    inside = np.arange(count) + WINDOW <= offs[1:][row]
    new = np.ones(count, bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    new |= np.concatenate(([True], ~inside[:-1]))
    # A run ends where the next begins or where windows leave the text.
    first = np.flatnonzero(new & inside)
    run = np.cumsum(new) - 1
    length = np.bincount(run, inside, minlength=int(run[-1]) + 1).astype(np.int64)
    return (
        row[first],
        first - offs[row[first]],
        length[run[first]],
        hashes[place[first]].view(np.int64),
    )


def stretches(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of one text that share no window and miss none."""
    for low in range(0, max(1, len(data) - WINDOW + 1), STRETCH):
        yield low, data[low : low + STRETCH + WINDOW - 1]


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tid = batch.column("tid")
        for low, _, data, offs in blocks(batch.column("text"), STRETCH):
            found = []
            if len(offs) == 2:
                for at, part in stretches(data):
                    row, first, count, key = anchors(part, np.array([0, len(part)]))
                    found.append((row, first + at, count, key))
            else:
                found.append(anchors(data, offs))
            row, first, count, key = map(np.concatenate, zip(*found, strict=True))
            yield pa.record_batch(
                [
                    tid.take(pa.array(row + low)),
                    pa.array(first),
                    pa.array(count),
                    pa.array(key),
                ],
                names=["tid", "first", "windows", "anchor"],
            )


def _stretch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of all windows of each anchor that occurs elsewhere."""
    for batch in batches:
        rows, first, windows, piece, crowded, parts = [], [], [], [], [], []
        held = 0
        texts, spots = batch.column("text"), batch.column("spots")
        for i in range(batch.num_rows):
            data = texts[i].as_buffer()
            for spot in spots[i].as_py():
                a, n = spot["first"], spot["windows"]
                rows.append(i)
                first.append(a)
                windows.append(n)
                piece.append(spot["piece"])
                crowded.append(spot["crowded"])
                parts.append(data[a : a + n - 1 + WINDOW].to_pybytes())
                held += n - 1 + WINDOW
            if held > 8 << 20 or i == batch.num_rows - 1:
                yield pa.record_batch(
                    [
                        batch.column("tid").take(pa.array(rows, pa.int64())),
                        pa.array(first, pa.int64()),
                        pa.array(windows, pa.int64()),
                        pa.array(piece, pa.int64()),
                        pa.array(crowded, pa.bool_()),
                        pa.array(parts, pa.binary()),
                    ],
                    names=["tid", "first", "windows", "piece", "crowded", "bytes"],
                )
                rows, first, windows, piece, crowded, parts = [], [], [], [], [], []
                held = 0


FOUND = "tid binary, start long, stop long, high long, low long, many int"


def _sort_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by piece; whole pieces are gathered up to SORTED_BYTES."""
    rest: list[pa.Table] = []
    held = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        size = np.array([len(b) for b in table.column("bytes").to_pylist()], np.int64)
        piece = table.column("piece").to_numpy()
        begin = 0
        edges = np.append(np.flatnonzero(np.diff(piece)) + 1, len(piece))
        upto = np.concatenate(([0], np.cumsum(size)))
        last = rest[-1].column("piece")[-1].as_py() if rest else None
        if rest and len(piece) and piece[0] != last and held >= SORTED_BYTES:
            yield from _repeats(pa.concat_tables(rest))
            rest, held = [], 0
        for edge in edges[:-1].tolist():
            if held + upto[edge] - upto[begin] >= SORTED_BYTES:
                rest.append(table.slice(begin, edge - begin))
                yield from _repeats(pa.concat_tables(rest))
                rest, held, begin = [], 0, edge
        rest.append(table.slice(begin))
        held += int(upto[-1] - upto[begin])
    if rest:
        yield from _repeats(pa.concat_tables(rest))


def _repeats(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Spans of repeated windows; for crowded anchors also every distinct window."""
    if not table.num_rows:
        return
    parts = table.column("bytes").to_pylist()
    windows = table.column("windows").to_pylist()
    number: dict[tuple[bytes, int], int] = {}
    which = np.array(
        [
            number.setdefault(key, len(number))
            for key in zip(parts, windows, strict=True)
        ]
    )
    segments = [key[0] for key in number]
    counts = np.array([key[1] for key in number], np.int64)
    copies = np.bincount(which)
    order, run = window_runs(segments, counts.tolist(), WINDOW)
    size = np.array([len(s) for s in segments], np.int64)
    begin = np.cumsum(size) - size
    owner = np.searchsorted(begin, order, "right") - 1
    total = np.bincount(run, copies[owner])
    again = np.zeros(int(size.sum()) + 1, bool)
    again[order] = total[run] >= 2
    crowded = np.zeros(len(segments), bool)
    crowded[which] = table.column("crowded").to_numpy()

    out: dict[str, list] = {k: [] for k in ("row", "start", "stop", "high", "low", "n")}

    def put(row, start, stop, digest, n):
        for name, value in zip(out, (row, start, stop, *digest, n), strict=True):
            out[name].append(value)

    first = table.column("first").to_numpy()
    for row, k in enumerate(which.tolist()):
        flags = again[begin[k] : begin[k] + counts[k]]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False]))))
        for a, b in edge.reshape(-1, 2).tolist():
            put(row, first[row] + a, first[row] + b - 1 + WINDOW, (0, 0), 0)
    if crowded.any():
        holder = np.full(len(segments), -1)
        holder[which] = np.arange(len(which))
        head = np.concatenate(([True], run[1:] != run[:-1]))
        for at, k, n in zip(
            order[head].tolist(), owner[head].tolist(), total.tolist(), strict=True
        ):
            if crowded[k]:
                a = at - begin[k]
                digest = xxhash.xxh3_128_intdigest(segments[k][a : a + WINDOW])
                halves = np.array(
                    [digest >> 64, digest & (1 << 64) - 1], np.uint64
                ).view(np.int64)
                start = first[holder[k]] + a
                put(holder[k], start, start + WINDOW, halves.tolist(), min(2, int(n)))
    yield pa.record_batch(
        [
            table.column("tid").combine_chunks().take(pa.array(out["row"], pa.int64())),
            *[pa.array(out[k], pa.int64()) for k in ("start", "stop", "high", "low")],
            pa.array(out["n"], pa.int32()),
        ],
        names=["tid", "start", "stop", "high", "low", "many"],
    )


def union_of(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of what the spans cover; spans that touch are one."""
    if not len(starts):
        return starts, stops
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.concatenate(([True], starts[1:] > stops[:-1]))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return starts[new], stops[last]


def _cut_batches(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, removed, spans, digest, kept, cuts = [], [], [], [], [], []
            copies = batch.column("copies").to_pylist()
            for i in range(batch.num_rows):
                data = batch.column("text")[i].as_buffer().to_pybytes()
                found = batch.column("spans")[i].as_py() or []
                if copies[i] > 1 and len(data) >= WINDOW:
                    found = [{"start": 0, "stop": len(data)}]
                starts, stops = union_of(
                    np.array([s["start"] for s in found], np.int64),
                    np.array([s["stop"] for s in found], np.int64),
                )
                at, parts = 0, []
                for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                    parts.append(data[at:a])
                    at = b
                rest = b"".join([*parts, data[at:]])
                n_bytes.append(len(data))
                removed.append(len(data) - len(rest))
                spans.append(len(starts))
                digest.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    kept.append(rest)
                    cuts.append(
                        [
                            {"start": a, "stop": b}
                            for a, b in zip(
                                starts.tolist(), stops.tolist(), strict=True
                            )
                        ]
                    )
            columns = {
                "tid": batch.column("tid"),
                "n_bytes": pa.array(n_bytes, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()),
                "kept_sha256": pa.array(digest, pa.string()),
            }
            if with_text:
                columns["kept"] = pa.array(kept, pa.binary())
                kind = pa.list_(
                    pa.struct([("start", pa.int64()), ("stop", pa.int64())])
                )
                columns["removed_spans"] = pa.array(cuts, kind)
            yield pa.record_batch(columns)

    return run


def repeated_spans(texts: DataFrame, portion: int = PORTION) -> DataFrame:
    """(tid, start, stop) of stretches whose windows all occur elsewhere, for distinct
    texts (tid, text)."""
    seen = stored(
        in_workers(texts.select("tid", "text")).mapInArrow(
            _anchor_batches, "tid binary, first long, windows long, anchor long"
        ),
        "anchors",
    )
    often = (
        seen.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("anchor", F.ceil(F.col("n") / portion).alias("portions"))
    )
    # Stored, so that both sides are exchanged for the join alone and an anchor with
    # very many places can be split.
    often = stored(often, "often")
    piece = F.when(F.col("portions") == 1, F.col("anchor")).otherwise(
        F.xxhash64("anchor", F.pmod(F.xxhash64("tid", "first"), F.col("portions")))
    )
    spots = (
        seen.join(often, "anchor")
        .select(
            "tid",
            F.struct(
                "first",
                "windows",
                piece.alias("piece"),
                (F.col("portions") > 1).alias("crowded"),
            ).alias("spot"),
        )
        .groupBy("tid")
        .agg(F.collect_list("spot").alias("spots"))
    )
    cut = texts.select("tid", "text").join(spots.hint("shuffle_hash"), "tid")
    parts = cut.select("tid", "text", "spots").mapInArrow(
        _stretch_batches,
        "tid binary, first long, windows long, piece long, crowded boolean, bytes binary",
    )
    found = stored(
        parts.repartition("piece")
        .sortWithinPartitions("piece")
        .mapInArrow(_sort_batches, FOUND),
        "found",
    )
    spans = found.filter("many = 0").select("tid", "start", "stop")
    # Windows of crowded anchors that are single in their portion but not in all.
    digests = found.filter("many > 0")
    repeated = (
        digests.groupBy("high", "low")
        .agg(F.sum("many").alias("n"), F.min("many").alias("least"))
        .filter("n > 1 and least = 1")
        .select("high", "low")
    )
    late = digests.filter("many = 1").join(repeated, ["high", "low"])
    return spans.unionByName(late.select("tid", "start", "stop"))


def without_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with
    ``with_text`` also ``kept`` (the bytes that stay; they need not be valid UTF-8)
    and ``removed_spans``.

    Every byte that lies in a string of 400 bytes which starts at another place too,
    in the same or another document, is removed; strings are judged on the input. A
    null text is empty, and texts of fewer than 400 bytes stay whole. A text that
    two rows share is removed whole if it has 400 bytes. Ids may be null or repeat.
    Only ``doc_id`` and ``text`` are read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    keyed = text_of(docs).withColumn("tid", F.unhex(F.sha2("text", 256)))
    ids = stored(keyed.select("doc_id", "tid"), "ids")
    name = f"corpus_texts_{uuid.uuid4().hex}"
    # As many buckets as shuffle partitions: each is written by one task, and what is
    # grouped by tid later meets the texts without moving them again.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        keyed.groupBy("tid")
        .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
        .write.bucketBy(buckets, "tid")
        .saveAsTable(name)
    )
    try:
        texts = spark.table(name)
        spans = (
            repeated_spans(texts)
            .groupBy("tid")
            .agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
        )
        kept = texts.join(spans.hint("shuffle_hash"), "tid", "left")
        more = (
            ", kept binary, removed_spans array<struct<start:bigint,stop:bigint>>"
            if with_text
            else ""
        )
        results = stored(
            in_workers(kept.select("tid", "text", "copies", "spans")).mapInArrow(
                _cut_batches(with_text),
                "tid binary, n_bytes long, n_removed long, n_spans long, "
                "kept_sha256 string" + more,
            ),
            "kept",
        )
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return ids.join(results, "tid").drop("tid")
