"""Packing token sequences by Karmarkar-Karp multiway differencing.

Documents become token ids, long ones are cut at every full sequence, and a rest of
more than half a sequence once more, at the half, so that windows can be filled. The
remaining pieces are dealt by a hash to blocks of a bounded number of pieces. In a block every
piece starts as a partial partition that has it in one window and nothing in the
others; the two partitions of the largest imbalance are merged, the heavy windows of
one with the light windows of the other, until one is left. Where a window exceeds
the capacity, the block is divided again into one window more.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.shared import in_workers, stored, text_of
from wardlake.llm.text import blocks, distinct_spans, same_bytes, span_keys

CAPACITY = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
#: Pieces of a block, on average.
BLOCK_PIECES = 768
#: Words whose ids a worker keeps.
KEPT_WORDS = 1_000_000
LATE_WORDS = 100_000
PIECES = "start long, length long, doc_tokens long, ids_crc32 long"

#: White space at which a text may be cut without changing any id.
CUTS = np.zeros(256, bool)
CUTS[[9, 10, 13, 32]] = True


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Token ids of words, remembered by a key of the word, and used for words of the
    same bytes only.

    The tokenizer never joins text across the white space of ``CUTS``, so a text's
    ids are the ids of its words, and a word is tokenized once per worker for as long
    as it is remembered.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes, and the word of each
        self.known_word = np.zeros(0, np.int64)
        self.late = np.zeros(0, np.uint64)  # the same for words not merged yet
        self.late_word = np.zeros(0, np.int64)
        self.limits = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.text = np.zeros(0, np.uint8)  # the words' bytes, and where each ends
        self.text_limits = np.zeros(1, np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 where it is new."""
        out = np.full(len(hashes), -1, np.int64)
        for keys, word in ((self.known, self.known_word), (self.late, self.late_word)):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[at] == hashes
                out[hit] = word[at[hit]]
        return out

    def _known(
        self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> np.ndarray:
        """Number of each word, -1 where no word of its bytes is remembered."""
        word = self._find(keys)
        at = np.flatnonzero(word >= 0)
        low, high = self.text_limits[word[at]], self.text_limits[word[at] + 1]
        same = same_bytes(data, starts[at], ends[at], self.text, low, high)
        word[at[~same]] = -1
        return word

    def _add(self, hashes: np.ndarray, texts: list[bytes]) -> None:
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_limits = np.concatenate(
            [self.text_limits, len(self.text) + np.cumsum(size)]
        )
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(texts), np.uint8)])
        found = [text.decode("utf-8", "replace") for text in texts]
        encoded = self.tokenizer.encode_batch_fast(found, add_special_tokens=False)
        ids = [one.ids for one in encoded]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(count.sum()))
        word = np.arange(len(ids)) + len(self.limits) - 1
        self.limits = np.concatenate([self.limits, len(self.ids) + np.cumsum(count)])
        self.ids = np.concatenate([self.ids, flat])
        keys = np.concatenate([self.late, hashes])
        words = np.concatenate([self.late_word, word])
        if len(keys) > LATE_WORDS:
            keys = np.concatenate([self.known, keys])
            words = np.concatenate([self.known_word, words])
        order = np.argsort(keys)
        if len(keys) > LATE_WORDS:
            self.known, self.known_word = keys[order], words[order]
            keys, words, order = keys[:0], words[:0], order[:0]
        self.late, self.late_word = keys[order], words[order]

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
        """Ids of all texts of a block and the offset of each text's first."""
        inside = ~CUTS[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offs] = True
        before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
        after = np.concatenate((inside[1:], [False])) & ~edge[1:]
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        first = np.searchsorted(starts, offs)
        keys = span_keys(data, starts, ends)
        which, sample = distinct_spans(data, starts, ends, keys)
        distinct = keys[sample]
        if len(self.limits) > KEPT_WORDS:
            self.forget()
        word = self._known(distinct, data, starts[sample], ends[sample])
        new = np.flatnonzero(word < 0)
        if len(new):
            text = data.tobytes()
            at = sample[new]
            spans = zip(starts[at].tolist(), ends[at].tolist(), strict=True)
            self._add(distinct[new], [text[a:b] for a, b in spans])
            word[new] = np.arange(len(self.limits) - 1 - len(new), len(self.limits) - 1)
        begin = self.limits[word]
        count = self.limits[word + 1] - begin
        begin, count = begin[which], count[which]
        ends_at = np.cumsum(count)
        total = int(ends_at[-1])
        step = np.arange(total) - np.repeat(ends_at - count, count)
        ids = self.ids[np.repeat(begin, count) + step]
        return ids, np.concatenate(([0], ends_at))[first]


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def _pieces(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _word_ids(path)
        for batch in batches:
            for low, _, data, offs in blocks(batch.column("text")):
                ids, first = known.encode(data, offs)
                yield _piece_batch(
                    batch.column("doc_id"), low, ids, first, capacity, with_ids
                )

    return run


def _piece_batch(doc_ids, low, ids, first, capacity, with_ids) -> pa.RecordBatch:
    tail = np.array([END_ID], "<u4")
    out: dict[str, list] = {k: [] for k in ("row", "start", "length", "all", "crc")}
    kept = []
    for row in range(len(first) - 1):
        one = np.concatenate([ids[first[row] : first[row + 1]].astype("<u4"), tail])
        cuts = [*range(0, len(one), capacity), len(one)]
        if cuts[-1] - cuts[-2] > capacity // 2 and cuts[-1] - cuts[-2] < capacity:
            cuts.insert(-1, cuts[-2] + capacity // 2)
        for start, end in zip(cuts, cuts[1:], strict=False):
            part = one[start:end]
            out["row"].append(low + row)
            out["start"].append(start)
            out["length"].append(len(part))
            out["all"].append(len(one))
            out["crc"].append(zlib.crc32(part.tobytes()))
            if with_ids:
                kept.append(part.astype(np.int32))
    columns = {
        "doc_id": doc_ids.take(pa.array(out["row"], pa.int64())),
        "start": pa.array(out["start"], pa.int64()),
        "length": pa.array(out["length"], pa.int64()),
        "doc_tokens": pa.array(out["all"], pa.int64()),
        "ids_crc32": pa.array(out["crc"], pa.int64()),
    }
    if with_ids:
        columns["ids"] = pa.array(kept, pa.list_(pa.int32()))
    return pa.record_batch(columns)


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Every document's ids and the end id, cut into pieces of ``capacity`` at most.
    A null or empty text is the end id alone."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {PIECES}" + (", ids array<int>" if with_ids else "")
    return in_workers(text_of(docs)).mapInArrow(_pieces(path, capacity, with_ids), schema)


def difference(lengths: list[int], windows: int) -> list[list[int]]:
    """Indices of ``lengths`` per window, by multiway differencing."""
    heap = []
    for index, length in enumerate(lengths):
        # Window sums in falling order, and the pieces of each; windows that a
        # partial partition has left empty are not stored.
        heap.append((-length, index, [length], [[index]]))
    heapq.heapify(heap)
    number = len(lengths)
    while len(heap) > 1:
        _, _, sums, parts = heapq.heappop(heap)
        _, _, other_sums, other_parts = heapq.heappop(heap)
        # The heaviest of one meets the lightest of the other, empty windows too.
        free = windows - len(sums)
        merged = list(zip(other_sums[:free], other_parts[:free], strict=True))
        for i, (total, part) in enumerate(zip(sums, parts, strict=True)):
            j = windows - 1 - i
            if j < len(other_sums):
                total, part = total + other_sums[j], part + other_parts[j]
            merged.append((total, part))
        merged.sort(key=lambda pair: -pair[0])
        sums = [a for a, _ in merged]
        least = sums[-1] if len(sums) == windows else 0
        heapq.heappush(heap, (least - sums[0], number, sums, [b for _, b in merged]))
        number += 1
    found = heap[0][3] if heap else []
    return found + [[] for _ in range(windows - len(found))]


def windows_of(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows within the capacity; their number rises from the least possible."""
    windows = max(1, -(-sum(lengths) // capacity))
    while True:
        found = difference(lengths, windows)
        if all(sum(lengths[i] for i in part) <= capacity for part in found):
            return [part for part in found if part]
        windows += 1


def _pack_block(capacity: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(
            ["length", "doc_id", "start", "ids_crc32"],
            ascending=[False, True, True, True],
            kind="stable",
        ).reset_index(drop=True)
        lengths = pieces["length"].tolist()
        full = [i for i, n in enumerate(lengths) if n == capacity]
        rest = [i for i, n in enumerate(lengths) if n < capacity]
        found = [[i] for i in full]
        if rest:
            parts = windows_of([lengths[i] for i in rest], capacity)
            found += [[rest[i] for i in part] for part in parts]
        sequence = np.zeros(len(lengths), np.int64)
        offset = np.zeros(len(lengths), np.int64)
        for number, part in enumerate(found):
            at = 0
            for i in part:
                sequence[i], offset[i] = number, at
                at += lengths[i]
        first = np.int64(pieces["block"].iloc[0]) << 24
        pieces = pieces.drop(columns="block")
        return pieces.assign(sequence_id=first + sequence, offset=offset)

    return run


def packed(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids_crc32, sequence_id
    and offset; with ``with_ids`` also the ids.

    Every id of every document, with the end id after its last, lies in exactly one
    piece; a sequence holds ``capacity`` ids at most and its offsets have no gap. A
    null or empty text is the end id alone. Rows that repeat, or have no id, are
    documents of their own. Only ``doc_id`` and ``text`` are read; an empty table
    gives an empty result.
    """
    pieces = stored(
        token_pieces(docs, path or tokenizer_path(), capacity, with_ids), "pieces"
    )
    count = pieces.count()
    n_blocks = max(1, -(-count // BLOCK_PIECES))
    block = F.pmod(
        F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens"), F.lit(n_blocks)
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {PIECES}" + (", ids array<int>" if with_ids else "")
    return (
        pieces.withColumn("block", block)
        .groupBy("block")
        .applyInPandas(
            _pack_block(capacity), f"{schema}, sequence_id long, offset long"
        )
    )
