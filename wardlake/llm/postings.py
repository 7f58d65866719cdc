"""Positional inverted index of a table of texts.

A term is a run of digits, letters and characters beyond ASCII, A-Z in lower case.
Texts are indexed in blocks of about a megabyte, so every posting list is bounded and
the lists of a frequent term lie in many rows, which Spark can deal to many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.shared import in_workers, text_of
from wardlake.llm.text import (
    BLOCK_BYTES,
    IS_TERM,
    blocks,
    distinct_spans,
    gathered,
    lowered,
    words,
)

#: The same terms as a pattern for texts in lower case.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: Column) -> Column:
    """All terms of a text in order, repeats included; none where it is null."""
    return F.regexp_extract_all(
        F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALL), F.lit(TERM), F.lit(0)
    )


def _block_index(block: int, doc_ids: pa.Array, data, offs) -> pa.RecordBatch:
    """The rows of one block: its documents first, then a row for each term."""
    data = lowered(data)
    starts, ends, first = words(data, offs, IS_TERM)
    which, sample = distinct_spans(data, starts, ends)
    order = np.sort((which << 32) | np.arange(len(which))) & ((1 << 32) - 1)
    limits = np.concatenate(([0], np.cumsum(np.bincount(which, minlength=len(sample)))))
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[order]
    new = np.ones(len(row), bool)
    new[1:] = row[1:] != row[:-1]
    if len(row):
        new[limits[:-1]] = True
    begin = np.flatnonzero(new)
    tf = np.diff(np.append(begin, len(row)))
    n_docs = np.zeros(len(sample), np.int64)
    max_tf = np.zeros(len(sample), np.int64)
    if len(row):
        term_of = np.searchsorted(limits, begin, "right") - 1
        n_docs = np.bincount(term_of, minlength=len(sample))
        np.maximum.at(max_tf, term_of, tf)
    steps = order.copy()
    steps[1:] -= order[:-1]
    steps[limits[:-1]] = order[limits[:-1]]
    flat = np.ascontiguousarray(steps, "<i4")
    places = pa.Array.from_buffers(
        pa.binary(),
        len(sample),
        [None, pa.py_buffer((limits * 4).astype(np.int32)), pa.py_buffer(flat)],
    )

    def column(head, rest, kind) -> pa.Array:
        return pa.concat_arrays([pa.array([head], kind), rest.cast(kind)])

    none = pa.nulls(len(sample))
    ids = pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids)
    size = pa.array([np.diff(first).astype(np.int32)], pa.list_(pa.int32()))
    return pa.record_batch(
        {
            "block": pa.array(np.full(len(sample) + 1, block)),
            "term": column(
                None, gathered(data, starts[sample], ends[sample]), pa.string()
            ),
            "n_docs": column(len(doc_ids), pa.array(n_docs), pa.int64()),
            "max_tf": column(0, pa.array(max_tf), pa.int64()),
            "places": column(None, places, pa.binary()),
            "doc_ids": pa.concat_arrays([ids, none.cast(ids.type)]),
            "lengths": pa.concat_arrays([size, none.cast(size.type)]),
        }
    )


def places_of(packed: bytes) -> np.ndarray:
    """The places of one posting list, in rising order."""
    return np.cumsum(np.frombuffer(packed, "<i4"), dtype=np.int64)


def _index_batches(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for low, high, data, offs in blocks(batch.column("text"), limit):
                yield _block_index(block, doc_ids.slice(low, high - low), data, offs)
                block += 1

    return run


def positional_index(docs: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """block long, term string, n_docs long, max_tf long, places binary, doc_ids
    array, lengths array<int>.

    Each block of documents has one row without a term, whose arrays give the
    documents and their numbers of terms, and a row for each of its terms: in how many
    documents it stands, how often at most in one, and all its places, counted through
    the terms of the block: the first and then each one's distance to the one before,
    as 32-bit numbers. A document lies in one block
    whole. A null or empty text has no terms. Block numbers hold for one evaluation,
    so store the index before reading it twice.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"block long, term string, n_docs long, max_tf long, places binary, "
        f"doc_ids array<{kind}>, lengths array<int>"
    )
    return in_workers(text_of(docs)).mapInArrow(_index_batches(limit), schema)


def indexed_documents(index: DataFrame) -> DataFrame:
    """(block, row, doc_id, n_words) of every document of an index."""
    zipped = F.arrays_zip("doc_ids", "lengths")
    return index.filter("term IS NULL").select(
        "block", F.posexplode(zipped).alias("row", "one")
    ).select(
        "block",
        "row",
        F.col("one.doc_ids").alias("doc_id"),
        F.col("one.lengths").cast("long").alias("n_words"),
    )
