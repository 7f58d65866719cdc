"""Ranked lexical search by pipelined term partitioning.

Every term has one owner stage, by the share of documents that hold it: the rarest
come first. The items of the query go in bundles through the stages. A bundle visits
each slice of the documents by itself, and carries for every item the documents that
can still be among its best and their integer scores so far. At a stage the bundle
meets, by a cogroup, the posting lists that the stage owns in that slice, and adds
their contributions.

What is carried stays small without losing a result: contributions are never
negative, so the score of the k-th best document so far, the highest over all slices,
is a floor. A document that cannot reach it even with the largest contributions of
all later terms is let go.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.postings import places_of, positional_index, terms_of
from wardlake.llm.shared import in_workers, stored

BEST = 50
#: Shares of the documents that divide the stages: a term held by at most the first
#: belongs to the first stage, and so on.
STAGE_SHARES = (1 / 64, 1 / 16, 1 / 4, 1.0)
#: Items of a bundle, on average, and blocks of the index in a slice (a power of 2).
BUNDLE_ITEMS = 256
SLICE_BLOCKS_LOG = 5
#: Fixed values of the scoring rule.
WEIGHT_SCALE, SCORE_SCALE, TF_SCALE, LENGTH_SCALE, LEAST_M = 1000, 10**9, 1000, 20, 50


def query_items(items: DataFrame) -> DataFrame:
    """(item_id, item, terms): distinct items with a term; ``item`` tells them apart."""
    terms = F.array_sort(F.array_distinct(terms_of(F.col("text"))))
    key = F.concat_ws("\n", F.lit("item"), F.col("item_id").cast("string"), F.array_join(terms, " "))
    return (
        items.select("item_id", F.md5(key.cast("binary")).alias("item"), terms.alias("terms"))
        .filter(F.size("terms") > 0)
        .distinct()
    )


def _weight(df: Column, n_docs: int) -> Column:
    return F.floor(
        WEIGHT_SCALE * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * df + 1))
    ).cast("long")


def _most(max_tf: Column) -> Column:
    """No document gets more for a term than this times the term's weight."""
    return F.expr(
        f"({SCORE_SCALE}L * max_tf) DIV ({TF_SCALE}L * max_tf + {LENGTH_SCALE * LEAST_M}L)"
    )


def _plan(postings: DataFrame, spread: DataFrame, n_docs: int) -> DataFrame:
    """(item, stage, terms, weights, most) for the stages an item has terms in; most
    is the largest score that the stage's terms can add."""
    per_term = postings.groupBy("term").agg(
        F.sum("n_docs").alias("df"), F.max("max_tf").alias("max_tf")
    )
    stage = reduce(
        lambda rest, s: F.when(F.col("df") <= STAGE_SHARES[s] * n_docs, s).otherwise(rest),
        reversed(range(len(STAGE_SHARES) - 1)),
        F.lit(len(STAGE_SHARES) - 1),
    )
    owned = per_term.select(
        "term",
        stage.alias("stage"),
        _weight(F.col("df"), n_docs).alias("weight"),
        _most(F.col("max_tf")).alias("most"),
    )
    return (
        spread.join(owned, "term")
        .groupBy("item", "stage")
        .agg(
            F.collect_list("term").alias("terms"),
            F.collect_list("weight").alias("weights"),
            F.sum(F.col("weight") * F.col("most")).alias("most"),
        )
    )


def _lists(table: pa.Table, n_docs: int, n_terms: int) -> tuple:
    """The slice's document ids, and of each term the documents (by their number in
    the slice) and what each gets for one unit of the term's weight."""
    table = table.sort_by("block")
    first: dict[int, tuple[int, np.ndarray]] = {}
    sizes, ids, at = [np.zeros(0, np.int64)], [], 0
    heads = table.filter(pc.is_null(table.column("term")))
    for i in range(heads.num_rows):
        one = heads.column("lengths")[i].values.to_numpy().astype(np.int64)
        ids.append(heads.column("doc_ids")[i].values)
        limits = np.concatenate(([0], np.cumsum(one)))
        first[heads.column("block")[i].as_py()] = (at, limits)
        sizes.append(one)
        at += len(one)
    size = np.concatenate(sizes)
    m = LEAST_M + (50 * size * n_docs) // max(n_terms, 1)
    found: dict[str, list] = {}
    rows = table.filter(pc.is_valid(table.column("term")))
    for block, term, packed in zip(
        rows.column("block").to_pylist(),
        rows.column("term").to_pylist(),
        rows.column("places").to_pylist(),
        strict=True,
    ):
        base, limits = first[block]
        row = np.searchsorted(limits, places_of(packed), "right") - 1
        begin = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        tf = np.diff(np.append(begin, len(row)))
        docs = row[begin] + base
        gain = (SCORE_SCALE * tf) // (TF_SCALE * tf + LENGTH_SCALE * m[docs])
        found.setdefault(term, []).append((docs, gain))
    whole = {
        term: tuple(map(np.concatenate, zip(*parts, strict=True)))
        for term, parts in found.items()
    }
    return ids, at, whole


def _visit(stage: int, n_docs: int, n_terms: int, k: int, kind: pa.DataType):
    """The work of one bundle at one stage in one slice."""
    last = stage == len(STAGE_SHARES) - 1

    def run(owned: pa.Table, carried: pa.Table) -> pa.Table:
        ids, n, lists = _lists(owned, n_docs, n_terms)
        rank = None
        out: list[tuple] = []
        for state in carried.to_pylist():
            score = np.zeros(n, np.int64)
            score[np.frombuffer(state["docs"], "<i4")] = np.frombuffer(state["scores"], "<i8")
            for term, weight in zip(state["terms"] or (), state["weights"] or (), strict=True):
                if term in lists:
                    docs, gain = lists[term]
                    score[docs] += weight * gain
            docs = np.flatnonzero(score)
            some = score[docs]
            kth = int(np.partition(some, -k)[-k]) if len(some) >= k else 0
            floor = max(kth, state["floor"])
            stay = some + state["later"] >= floor
            docs, some = docs[stay], some[stay]
            if last:
                if rank is None:
                    every = pa.chunked_array(ids, kind).combine_chunks()
                    order = pc.sort_indices(every, null_placement="at_end").to_numpy()
                    rank = np.empty(n, np.int64)
                    rank[order] = np.arange(n)
                best = np.lexsort((rank[docs], -some))[:k]
                docs, some = docs[best], some[best]
            out.append((state, kth, docs, some))
        if last:
            docs = np.concatenate([np.zeros(0, np.int64), *(x[2] for x in out)])
            every = pa.chunked_array(ids, kind).combine_chunks()
            return pa.table(
                {
                    "item": pa.array(
                        [x[0]["item"] for x in out for _ in range(len(x[2]))], pa.string()
                    ),
                    "doc_id": every.take(pa.array(docs)),
                    "score": np.concatenate([np.zeros(0, np.int64), *(x[3] for x in out)]),
                }
            )
        return pa.table(
            {
                "slice": pa.array([x[0]["slice"] for x in out], pa.int64()),
                "bundle": pa.array([x[0]["bundle"] for x in out], pa.int64()),
                "item": pa.array([x[0]["item"] for x in out], pa.string()),
                "kth": pa.array([x[1] for x in out], pa.int64()),
                "docs": pa.array([x[2].astype("<i4").tobytes() for x in out], pa.binary()),
                "scores": pa.array([x[3].astype("<i8").tobytes() for x in out], pa.binary()),
            }
        )

    return run


CARRIED = "slice long, bundle long, item string, kth long, docs binary, scores binary"


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score.

    Terms are runs of digits, letters and characters beyond ASCII, A-Z in lower case;
    a null or empty text has none. The score is the integer sum that README and tests
    state, over the item's distinct terms. Only documents with a score above 0 are
    listed, equal scores by rising doc_id, null ids last. Rows of documents that
    repeat are documents of their own. Items of one id and the same terms are one
    item; those of one id and other terms are ranked each by itself. Of ``docs`` only
    ``doc_id`` and ``text`` are read, of ``items`` only ``item_id`` and ``text``; empty
    tables give an empty result.
    """
    asked = stored(query_items(items), "items")
    n_bundles = max(1, -(-asked.count() // BUNDLE_ITEMS))
    bundle = F.pmod(F.xxhash64("item"), F.lit(n_bundles))
    spread = asked.select("item", bundle.alias("bundle"), F.explode("terms").alias("term"))

    known = spread.select("term").distinct().withColumn("known", F.lit(True))
    index = (
        positional_index(docs)
        .join(known, "term", "left")
        .filter("known OR term IS NULL")
        .drop("known")
        .withColumn("slice", F.shiftright("block", SLICE_BLOCKS_LOG))
    )
    index = stored(index, "postings", compression="zstd")
    heads = index.filter("term IS NULL")
    postings = index.filter("term IS NOT NULL")
    some = F.count_if(F.col("size") > 0).alias("n_docs")
    total = heads.select(F.explode("lengths").alias("size")).agg(some, F.sum("size")).first()
    n_docs, n_terms = total[0], total[1] or 0

    plan = stored(_plan(postings, spread, n_docs), "plan")
    routes = spread.select("term", "bundle").distinct()
    visits = stored(
        postings.select("slice", "term").distinct().join(routes, "term")
        .select("slice", "bundle").distinct(),
        "visits",
    )
    heads = heads.join(visits, "slice")
    none = F.lit("").cast("binary")
    carried = visits.join(asked.select("item", bundle.alias("bundle")), "bundle").select(
        "slice", "bundle", "item", F.lit(0).cast("long").alias("kth"),
        none.alias("docs"), none.alias("scores"),
    )
    kind = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    for stage in range(len(STAGE_SHARES)):
        own = plan.filter(F.col("stage") == stage).drop("stage", "most")
        later = (
            plan.filter(F.col("stage") > stage)
            .groupBy("item")
            .agg(F.sum("most").alias("later"))
        )
        floors = carried.groupBy("item").agg(F.max("kth").alias("floor"))
        bundles = (
            carried.join(floors, "item")
            .join(own, "item", "left")
            .join(later, "item", "left")
            .withColumn("later", F.coalesce("later", F.lit(0)))
        )
        owners = own.select(F.explode("terms").alias("term")).distinct()
        owned = postings.join(owners, "term").join(routes, "term")
        columns = ["slice", "bundle", "block", "term", "places", "doc_ids", "lengths"]
        met = owned.select(columns).union(heads.select(columns))
        last = stage == len(STAGE_SHARES) - 1
        schema = CARRIED
        if last:
            schema = f"item string, doc_id {kind.simpleString()}, score long"
        work = _visit(stage, n_docs, n_terms, k, to_arrow_type(kind))
        carried = (
            in_workers(met)
            .groupBy("slice", "bundle")
            .cogroup(bundles.groupBy("slice", "bundle"))
            .applyInArrow(work, schema)
        )
        carried = stored(carried, f"stage_{stage}")
    order = Window.partitionBy("item").orderBy(
        F.desc("score"), F.asc_nulls_last("doc_id")
    )
    return (
        carried.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .join(asked.select("item", "item_id"), "item")
        .select("item_id", "rank", "doc_id", "score")
    )
