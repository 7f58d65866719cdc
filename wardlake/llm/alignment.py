"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes differently. Every token of a text, of either one,
points to the token farthest to the right that it overlaps; doubling the pointers
until nothing moves brings each token to the last one of its connected component. The
components are the groups between the places where tokens of both end. This is done
for about a megabyte of text at once, in arrays.

How many documents hold a pair of ids linked is counted in Spark: a block of
documents sends each of its pairs once, with the number of its documents that hold
it, and gets back the count of the whole corpus and whether it is the best of the
pair's first id. Documents refer to the pairs of their block by number.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.shared import in_workers, stored

#: Bytes of text aligned at once, and bytes whose pairs are numbered together.
STEP_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
#: The two id numbers of a pair are kept in one: first * PAIR_BASE + second.
PAIR_BASE = 1 << 20
#: Texts of these characters only, whose Unicode classes are settled, are encoded by
#: a second library that has the same vocabulary and splits them alike.
SETTLED = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ‐-‧‰-⁞]*")
FIGURES = "n_a long, n_b long, n_groups long, n_links long"


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return tuple(map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))


def _byte_alphabet() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: bytes with a visible Latin-1
    character stand for themselves, the others follow from U+0100 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Ids of space + text by a byte-level vocabulary, and the bytes of each id."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        alphabet = _byte_alphabet()
        special = {one.content for one in self.whole.get_added_tokens_decoder().values()}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        ranks = {}
        for token, number in vocabulary.items():
            plain = token not in special
            one = bytes(map(alphabet.get, token)) if plain else token.encode()
            self.bytes[number] = one
            if plain:
                ranks[one] = number
        self.fast = tiktoken.Encoding(
            "pair", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> list[int]:
        if SETTLED.fullmatch(text):
            return self.fast.encode_ordinary(" " + text)
        return self.whole.encode(" " + text, add_special_tokens=False).ids


class Pieces:
    """Ids of a text by a piece vocabulary, which adds the space, and their bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.encode = model.encode
        self.bytes = [
            bytes([int(model.id_to_piece(i)[3:-1], 16)])
            if model.is_byte(i)
            else model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(model.get_piece_size())
        ]


@lru_cache(maxsize=2)
def _encoders(first: str, second: str) -> tuple:
    a, b = ByteLevel(first), Pieces(second)
    sizes = [np.fromiter(map(len, one.bytes), np.int64) for one in (a, b)]
    texts = [
        [f"{i}{end}".encode() for i in range(len(one.bytes)) for end in ",|;"]
        for one in (a, b)
    ]
    return a, b, *sizes, *texts


def token_ids(text: str | None, a: ByteLevel, b: Pieces) -> tuple[list, list]:
    """Ids of both, none at all where either one's bytes are not space + text."""
    if not text:
        return [], []
    ids_a, ids_b = a.encode(text), b.encode(text)
    plain = b" " + text.encode()
    for ids, table in ((ids_a, a.bytes), (ids_b, b.bytes)):
        if b"".join(map(table.__getitem__, ids)) != plain:
            return [], []
    return ids_a, ids_b


def terminal_labels(
    start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The terminal token of each token of both kinds, as an index of the first kind.

    Both kinds cover the same bytes without gaps. Where the farthest token is of
    either kind, because both end there, the one of the first kind is meant.
    """
    n = len(start_a)
    reach_b = np.searchsorted(start_b, end_a) - 1  # the last that begins inside
    reach_a = np.searchsorted(start_a, end_b) - 1
    farther = end_b[reach_b] > end_a
    points = np.concatenate([np.where(farther, n + reach_b, np.arange(n)), reach_a])
    while True:
        doubled = points[points]
        if np.array_equal(doubled, points):
            return points[:n], points[n:]
        points = doubled


def _ends(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(sizes[ids])
    return ends - sizes[ids], ends


def links_of(start_a, end_a, start_b, end_b) -> tuple[np.ndarray, np.ndarray]:
    """Token indices (first kind, second kind) of all pairs that overlap."""
    low = np.searchsorted(end_b, start_a, "right")
    many = np.searchsorted(start_b, end_a) - low
    left = np.repeat(np.arange(len(start_a)), many)
    return left, low[left] + np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many)


def _aligned(texts: list[str | None], encoders: tuple) -> tuple[dict, np.ndarray, ...]:
    """Figures of each text, and its distinct pairs: (row, pair, times)."""
    a, b, size_a, size_b, text_a, text_b = encoders
    both = [token_ids(text, a, b) for text in texts]
    count_a = np.fromiter((len(x) for x, _ in both), np.int64, len(both))
    count_b = np.fromiter((len(x) for _, x in both), np.int64, len(both))
    ids_a = np.fromiter(chain.from_iterable(x for x, _ in both), np.int64, count_a.sum())
    ids_b = np.fromiter(chain.from_iterable(x for _, x in both), np.int64, count_b.sum())
    out = {"n_a": count_a, "n_b": count_b}
    out |= {"n_groups": np.zeros_like(count_a), "n_links": np.zeros_like(count_a)}
    out["sha"] = [""] * len(both)
    none = np.zeros(0, np.int64)
    if not len(ids_a):
        return out, none, none, none
    row_a = np.repeat(np.arange(len(both)), count_a)
    places = *_ends(ids_a, size_a), *_ends(ids_b, size_b)
    label_a, label_b = terminal_labels(*places)
    terminal = label_a == np.arange(len(label_a))
    number = np.cumsum(terminal) - 1
    out["n_groups"] = np.bincount(row_a[terminal], minlength=len(both))

    # Ids in the order in which a group lists them, each with the sign that follows.
    group_a, group_b = number[label_a], number[label_b]
    kind = np.concatenate([group_a * 2, group_b * 2 + 1])
    order = np.argsort(kind, kind="stable")
    kind = kind[order]
    sign = np.full(len(kind), 2)
    step = kind[1:] - kind[:-1]
    sign[:-1] = np.where(step == 0, 0, np.where(kind[:-1] & 1, 2, 1))
    code = np.concatenate([ids_a * 3, ids_b * 3 + 3 * len(size_a)])[order] + sign
    table = text_a + text_b
    limits = np.concatenate(([0], np.cumsum(count_a + count_b))).tolist()
    for row in np.flatnonzero(count_a).tolist():
        listed = map(table.__getitem__, code[limits[row] : limits[row + 1]].tolist())
        out["sha"][row] = hashlib.sha256(b"".join(listed)[:-1]).hexdigest()

    left, right = links_of(*places)
    out["n_links"] = np.bincount(row_a[left], minlength=len(both))
    pair = ids_a[left] * PAIR_BASE + ids_b[right]
    order = np.lexsort((pair, row_a[left]))
    pair, row = pair[order], row_a[left][order]
    new = np.flatnonzero(
        np.concatenate(([True], (pair[1:] != pair[:-1]) | (row[1:] != row[:-1])))
    )
    return out, row[new], pair[new], np.diff(np.append(new, len(pair)))


def _packed(values: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the largest needs, after that number."""
    top = int(values.max(initial=0))
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


def _block_batch(block: int, ids: pa.Array, figures: list[dict], pairs: list) -> pa.RecordBatch:
    """Rows of a block: its pairs first, then its documents."""
    rows, keys, times = (np.concatenate(x) for x in zip(*pairs, strict=True))
    distinct, number, n_docs = np.unique(keys, return_inverse=True, return_counts=True)
    limits = np.searchsorted(rows, np.arange(len(ids) + 1)).tolist()
    which, often = [], []
    for low, high in zip(limits, limits[1:], strict=False):
        which.append(_packed(np.diff(number[low:high], prepend=0)))
        often.append(_packed(times[low:high]))
    columns = {
        "block": pa.array(np.full(len(ids) + 1, block)),
        "pairs": pa.array([distinct] + [None] * len(ids), pa.list_(pa.int64())),
        "n_docs": pa.array([n_docs] + [None] * len(ids), pa.list_(pa.int64())),
        "doc_id": pa.concat_arrays([pa.nulls(1, ids.type), ids]),
    }
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        every = np.concatenate([one[name] for one in figures]).tolist()
        columns[name] = pa.array([None, *every], pa.int64())
    sha = chain.from_iterable(one["sha"] for one in figures)
    columns["groups_sha256"] = pa.array([None, *sha], pa.string())
    columns["which"] = pa.array([None, *which], pa.binary())
    columns["times"] = pa.array([None, *often], pa.binary())
    return pa.record_batch(columns)


def _align_batches(paths: tuple[str, str], step: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(*paths)
        block = TaskContext.get().partitionId() << 32
        ids, figures, pairs, done, held = [], [], [], 0, 0
        for batch in batches:
            size = np.array(
                [len(x) if x else 0 for x in batch.column("text").to_pylist()], np.int64
            )
            ends = np.cumsum(size)
            low = 0
            while low < batch.num_rows:
                before = ends[low] - size[low]
                high = max(low + 1, int(np.searchsorted(ends, before + step, "right")))
                texts = batch.column("text").slice(low, high - low).to_pylist()
                one, row, pair, times = _aligned(texts, encoders)
                ids.append(batch.column("doc_id").slice(low, high - low))
                figures.append(one)
                pairs.append((row + held, pair, times))
                held += high - low
                done += int(ends[high - 1] - before)
                low = high
                if done >= limit:
                    yield _block_batch(block, pa.concat_arrays(ids), figures, pairs)
                    block += 1
                    ids, figures, pairs, done, held = [], [], [], 0, 0
        if held:
            yield _block_batch(block, pa.concat_arrays(ids), figures, pairs)

    return run


def _sum_block(documents: pa.Table, counts: pa.Table) -> pa.Table:
    """Adds what the pairs of a block are worth to its documents."""
    count = np.zeros(counts.num_rows, np.int64)
    best = np.zeros(counts.num_rows, bool)
    at = counts.column("at").to_numpy()
    count[at] = counts.column("count").to_numpy()
    best[at] = counts.column("best").to_numpy(zero_copy_only=False)
    n_best, total = [], []
    for which, times in zip(
        documents.column("which").to_pylist(), documents.column("times").to_pylist(), strict=True
    ):
        number, often = np.cumsum(_unpacked(which)), _unpacked(times)
        n_best.append(int(often[best[number]].sum()))
        total.append(int((often * count[number]).sum()))
    return (
        documents.drop_columns(["block", "which", "times"])
        .append_column("n_best", pa.array(n_best, pa.int64()))
        .append_column("count_sum", pa.array(total, pa.int64()))
    )


def aligned_blocks(
    docs: DataFrame, paths: tuple[str, str], step: int = STEP_BYTES, limit: int = BLOCK_BYTES
) -> DataFrame:
    """One row of pairs for each block of documents, and one row for each document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"block long, pairs array<long>, n_docs array<long>, doc_id {kind}, {FIGURES}, "
        "groups_sha256 string, which binary, times binary"
    )
    rows = in_workers(docs.select("doc_id", "text"))
    return rows.mapInArrow(_align_batches(paths, step, limit), schema)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, count, best) from rows (pair, n_docs): in how many documents a pair of
    ids is linked, and whether no pair of the same first id is in more."""
    counts = pairs.groupBy("pair").agg(F.sum("n_docs").alias("count"))
    first = F.shiftright("pair", PAIR_BASE.bit_length() - 1)
    counts = stored(counts.withColumn("a", first), "counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best")
    )


def alignment(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256,
    n_best and count_sum.

    Texts are encoded with a space before them by both tokenizers (byte-level first,
    pieces second). A null or empty text, and one that either tokenizer does not give
    back byte by byte, has no tokens: all figures 0 and an empty digest; it counts for
    no pair. Links are all pairs of token occurrences that share bytes; the count of a
    pair of ids is the number of documents, repeated rows each by itself, that hold
    it. Only ``doc_id`` and ``text`` are read; an empty table gives an empty result.
    """
    blocks = stored(
        aligned_blocks(docs, paths or tokenizer_paths()), "aligned", compression="zstd"
    )
    heads = blocks.filter("pairs IS NOT NULL")
    pairs = heads.select(
        "block", F.posexplode(F.arrays_zip("pairs", "n_docs")).alias("at", "one")
    ).select(
        F.col("block").alias("block"),
        "at",
        F.col("one.pairs").alias("pair"),
        F.col("one.n_docs").alias("n_docs"),
    )
    counts = pairs.select("block", "at", "pair").join(pair_counts(pairs), "pair").drop("pair")
    kind = docs.schema["doc_id"].dataType.simpleString()
    documents = blocks.filter("pairs IS NULL").drop("pairs", "n_docs")
    return (
        in_workers(documents)
        .groupBy("block")
        .cogroup(counts.groupBy("block"))
        .applyInArrow(
            _sum_block,
            f"doc_id {kind}, {FIGURES}, groups_sha256 string, n_best long, count_sum long",
        )
    )
