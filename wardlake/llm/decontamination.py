"""Benchmark decontamination through a positional inverted index.

The index keeps the places of every term of the corpus. A benchmark item is looked up
as its phrases: all windows of ten consecutive words, or the whole item where it is
shorter. Of a phrase the rarest word in the corpus leads: its posting lists give the
blocks and starts that come into question, and the lists of the other words, rarest
first, each moved by the word's place in the phrase, are intersected with them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.postings import (
    indexed_documents,
    places_of,
    positional_index,
    terms_of,
)
from wardlake.llm.shared import in_workers, stored

PHRASE_WORDS = 10
MATCHES = "block long, row int, phrase string, start long, n long, away long"


def phrases_of(items: DataFrame, words: int = PHRASE_WORDS) -> DataFrame:
    """Distinct (item_id string, phrase): the windows of ``words`` terms of each item,
    joined by spaces; an item of fewer terms is one phrase, one of none has no phrase.
    """
    last = F.greatest(F.size("terms") - words, F.lit(0))
    window = F.slice("terms", F.col("at") + 1, words)
    return (
        items.select(F.col("item_id").cast("string"), terms_of(F.col("text")).alias("terms"))
        .filter(F.size("terms") > 0)
        .select("item_id", "terms", F.explode(F.sequence(F.lit(0), last)).alias("at"))
        .select("item_id", F.array_join(window, " ").alias("phrase"))
        .distinct()
    )


def _plans(postings: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, lead, terms, moves) of phrases all of whose terms are in the index:
    terms with their places in the phrase, the rarest first."""
    counts = postings.groupBy("term").agg(F.sum("n_docs").alias("df"))
    spread = phrases.select("phrase").distinct().select(
        "phrase", F.posexplode(F.split("phrase", " ")).alias("move", "term")
    )
    step = F.struct("df", "move", "term")
    return (
        spread.join(counts, "term", "left")
        .groupBy("phrase")
        .agg(
            F.sort_array(F.collect_list(step)).alias("steps"),
            F.count_if(F.col("df").isNull()).alias("unknown"),
        )
        .filter("unknown = 0")
        .select(
            "phrase",
            F.col("steps.term")[0].alias("lead"),
            F.col("steps.term").alias("terms"),
            F.col("steps.move").alias("moves"),
        )
    )


def starts_of(
    lists: list[np.ndarray], moves: list[int], first: np.ndarray, slop: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, away) of the phrase's occurrences. ``lists`` are the places of its
    terms and ``moves`` their places in the phrase; ``first`` is each document's first
    place. A start is where the phrase would begin by its first list; every other
    list must have a place in the same document at most ``slop`` off, and ``away`` is
    the largest such distance."""
    start = lists[0] - moves[0]
    # Most starts end here: is there any place near enough, in whichever document?
    for places, move in zip(lists[1:], moves[1:], strict=True):
        low = start + (move - slop)
        at = np.searchsorted(places, low)
        inside = at < len(places)
        start = start[inside][places[at[inside]] <= low[inside] + 2 * slop]
        if not len(start):
            return start, start, start
    row = np.searchsorted(first, start + moves[0], "right") - 1
    away = np.zeros(len(start), np.int64)
    if not slop:
        whole = (start >= first[row]) & (start + len(moves) <= first[row + 1])
        return row[whole], start[whole], away[whole]
    for places, move in zip(lists[1:], moves[1:], strict=True):
        after = np.searchsorted(places, start + move)
        best = np.full(len(start), slop + 1)
        for at in (after - 1, after):
            inside = (at >= 0) & (at < len(places))
            place = places[np.clip(at, 0, len(places) - 1)]
            inside &= (place >= first[row]) & (place < first[row + 1])
            distance = np.abs(place - move - start)
            best = np.where(inside, np.minimum(best, distance), best)
        stay = best <= slop
        start, row = start[stay], row[stay]
        away = np.maximum(away[stay], best[stay])
    return row, start, away


def _known_terms(lists: pa.Table, wanted: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Of each phrase's terms, in one array, the row of its posting list; and the first
    of each phrase. Phrases with a term that the block has not are left out."""
    terms = pa.chunked_array(
        [c.flatten() for c in wanted.column("terms").chunks], pa.string()
    )
    at = pc.fill_null(pc.index_in(terms, lists.column("term").combine_chunks()), -1)
    size = pc.list_value_length(wanted.column("terms")).to_numpy().astype(np.int64)
    begin = np.cumsum(size) - size
    at = at.to_numpy().astype(np.int64)
    return at, begin[np.minimum.reduceat(at, begin) >= 0]


def _match_block(slop: int):
    def run(lists: pa.Table, wanted: pa.Table) -> pa.Table:
        parts: list[tuple] = []
        if wanted.num_rows:
            lists, wanted = lists.combine_chunks(), wanted.combine_chunks()
            at, begins = _known_terms(lists, wanted)
            moves = pc.list_flatten(wanted.column("moves")).to_numpy().tolist()
            size = pc.list_value_length(wanted.column("terms")).to_numpy()
            number = np.repeat(np.arange(len(size)), size)[begins].tolist()
            packed, at = lists.column("places"), at.tolist()
            head = pc.index(pc.is_null(lists.column("term")), True).as_py()
            lengths = lists.column("lengths")[head].values.to_numpy()
            first = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
            places: dict[int, np.ndarray] = {}
            for i, low in zip(number, begins.tolist(), strict=True):
                high = low + int(size[i])
                for term in at[low:high]:
                    if term not in places:
                        places[term] = places_of(packed[term].as_buffer())
                found = [places[term] for term in at[low:high]]
                row, start, away = starts_of(found, moves[low:high], first, slop)
                if len(row):
                    n = np.full(len(row), high - low)
                    parts.append((row, start - first[row], n, away, np.full(len(row), i)))
        none = np.zeros(0, np.int64)
        whole = map(np.concatenate, zip(*parts, strict=True)) if parts else [none] * 5
        row, start, n, away, which = whole
        block = (lists if lists.num_rows else wanted).column("block")[0].as_py()
        phrase = wanted.column("phrase").take(pa.array(which)) if parts else pa.array([], pa.string())
        return pa.table(
            {
                "block": pa.array(np.full(len(row), block)),
                "row": pa.array(row.astype(np.int32)),
                "phrase": phrase,
                "start": pa.array(start),
                "n": pa.array(n),
                "away": pa.array(away),
            }
        )

    return run


def phrase_matches(index: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """(block, row, phrase, start, n, away): occurrences of ``phrases(phrase)`` in the
    documents of a stored index.

    With ``slop`` 0 these are the exact ones. Otherwise they are those by proximity:
    each word of the phrase stands at most ``slop`` places from where it would stand
    if the phrase began at ``start``, counted from its rarest word; ``away`` is the
    largest distance, 0 for an exact occurrence. ``start`` counts the document's words
    from 0, and may lie outside it by up to ``slop``.
    """
    words = phrases.select(F.explode(F.split("phrase", " ")).alias("term")).distinct()
    postings = stored(
        index.filter("term IS NOT NULL").join(words, "term"), "postings"
    )
    plans = stored(_plans(postings, phrases), "plans")
    wanted = postings.select("block", F.col("term").alias("lead")).join(plans, "lead")
    wanted = stored(wanted.select("block", "phrase", "terms", "moves"), "wanted")
    lists = postings.select("block", "term", "places", F.lit(None).cast("array<int>").alias("lengths"))
    heads = index.filter("term IS NULL").select("block", "term", "places", "lengths")
    lists = lists.union(heads).join(wanted.select("block").distinct(), "block")
    return (
        in_workers(lists)
        .groupBy("block")
        .cogroup(wanted.groupBy("block"))
        .applyInArrow(_match_block(slop), MATCHES)
    )


def _digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, ",").cast("binary"), 256)


def contamination(
    docs: DataFrame, items: DataFrame, words: int = PHRASE_WORDS
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256 and
    contaminated.

    Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case;
    a null or empty text has none. ``n_hit`` counts the words inside any occurrence of
    a phrase (see ``phrases_of``), ``n_items`` the items with such a phrase, whose ids
    the digest joins in text order (of the empty text where there are none). Items of
    one id are one item; an item without an id marks words, but is not counted. Rows
    of documents that repeat, or have no id, get a row each. Of ``docs`` only
    ``doc_id`` and ``text`` are read, of ``items`` only ``item_id`` and ``text``; empty
    tables are allowed on both sides.
    """
    index = stored(positional_index(docs), "index", compression="zstd")
    named = stored(phrases_of(items, words), "phrases")
    matches = stored(phrase_matches(index, named), "matches")
    place = Window.partitionBy("block", "row").orderBy("start", "n")
    before = F.max(F.col("start") + F.col("n")).over(place.rowsBetween(Window.unboundedPreceding, -1))
    new = F.col("start") + F.col("n") - F.greatest("start", F.coalesce(before, F.lit(0)))
    spans = matches.select("block", "row", "start", "n").distinct()
    hits = (
        spans.select("block", "row", F.greatest(new, F.lit(0)).alias("new"))
        .groupBy("block", "row")
        .agg(F.sum("new").alias("n_hit"))
    )
    found = (
        matches.select("block", "row", "phrase")
        .distinct()
        .join(named.filter("item_id IS NOT NULL"), "phrase")
        .groupBy("block", "row")
        .agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    )
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return (
        indexed_documents(index)
        .join(hits, ["block", "row"], "left")
        .join(found, ["block", "row"], "left")
        .select(
            "doc_id",
            "n_words",
            n_hit.alias("n_hit"),
            F.size(ids).cast("long").alias("n_items"),
            _digest(ids).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
        )
    )
