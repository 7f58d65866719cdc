"""Toxicity by a counterfactually regularised classifier.

A sparse logistic regression on the distinct words of a text. For every labelled
text that names a group, the group terms are swapped for others of the same kind and
the change of the score is penalised, so that terms for people carry little weight of
their own and neutral mentions are not taken for attacks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.learning import Ftrl, one_row_each, sampled, temperature
from wardlake.llm.shared import holdout, in_workers, text_of, unit
from wardlake.llm.text import blocks, lowered, word_hashes

PARTS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Labelled rows the weights are fitted on, at most (the bound of the sample).
MAX_TRAINING_ROWS = 16_000
#: A word must occur in this many sampled texts to get a weight.
LEAST_TEXTS = 3
EPOCHS, ALPHA, L1, L2 = 8, 2.0, 4.0, 0.01
#: Weight of a squared change of the score when group terms are swapped.
SWAP_PENALTY = 1.0
#: Terms that name groups of people, by kind; swaps stay inside a kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "trans", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("gay", "lesbian", "straight", "bisexual", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "american"),
    ("mexican", "chinese", "indian", "arab", "german", "french", "spanish"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("blind", "deaf", "disabled", "autistic"),
    ("old", "young", "elderly", "teenage"),
)


def _is_letter() -> np.ndarray:
    out = np.zeros(256, bool)
    out[97:123] = True
    out[128:] = True
    return out


LETTER = _is_letter()


def distinct_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct words of each text (runs of letters, without
    case), and the offset of each text's first."""
    data = lowered(data)
    inside = LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
    after = np.concatenate((inside[1:], [False])) & ~edge[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    row = np.searchsorted(offs, starts, "right") - 1
    hashes = word_hashes(data, starts, ends)
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    row, hashes = row[new], hashes[new]
    return hashes, np.searchsorted(row, np.arange(len(offs)))


def term_hash(term: str) -> int:
    data = np.frombuffer(term.encode(), np.uint8)
    return int(word_hashes(data, np.array([0]), np.array([len(data)]))[0])


def swaps(groups=IDENTITY_TERMS) -> dict[int, list[int]]:
    """Each term's hash to those of the other terms of its kind."""
    kinds = [[term_hash(term) for term in kind] for kind in groups]
    return {one: [x for x in kind if x != one] for kind in kinds for one in kind}


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for _, _, data, offs in blocks(batch.column("text")):
            hashes, first = distinct_words(data, offs)
            hashes = hashes.view(np.int64)
            found += [hashes[first[i] : first[i + 1]] for i in range(len(first) - 1)]
        yield pa.record_batch(
            [
                batch.column("label"),
                batch.column("aside"),
                pa.array(found, pa.list_(pa.int64())),
            ],
            names=["label", "aside", "words"],
        )


def fit(
    texts: list[np.ndarray],
    labels: np.ndarray,
    aside: np.ndarray,
    rates: dict | None = None,
    groups=IDENTITY_TERMS,
    penalty: float = SWAP_PENALTY,
) -> dict:
    """Weights of words (sorted by hash), bias and temperature from sampled texts,
    each the hashes of its distinct words. ``rates``: share of each label's rows that
    the sample holds, for the bias."""
    every = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
    vocabulary, count = np.unique(every, return_counts=True)
    other = swaps(groups)
    terms = np.array(sorted(other), np.uint64)
    vocabulary = np.unique(np.concatenate([vocabulary[count >= LEAST_TEXTS], terms]))
    size = len(vocabulary)

    def place(key: int) -> int:
        return int(np.searchsorted(vocabulary, np.uint64(key)))

    swapped = {place(a): [place(b) for b in kind] for a, kind in other.items()}
    rows, changes = [], []
    for words in texts:
        at = np.minimum(np.searchsorted(vocabulary, words), size - 1)
        at = at[vocabulary[at] == words]
        rows.append(np.append(at, size))  # the last coordinate is the bias
        here = [i for i in at.tolist() if i in swapped]
        # What swapping each term for the others of its kind changes on average.
        change: dict[int, float] = {}
        for i in here:
            change[i] = change.get(i, 0) + 1
            for k in swapped[i]:
                change[k] = change.get(k, 0) - 1 / len(swapped[i])
        changes.append({i: n for i, n in change.items() if n})
    model = Ftrl(size + 1, 1, ALPHA, L1, L2)
    learn = np.flatnonzero(~aside) if (~aside).any() else np.arange(len(labels))
    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in rng.permutation(learn):
            at = rows[i]
            w = model.weights(at)
            error = 1 / (1 + np.exp(-np.clip(w.sum(), -60, 60))) - labels[i]
            model.step(at, w, np.full((len(at), 1), error))
            if changes[i] and penalty:
                at = np.array(sorted(changes[i]))
                step = np.array([changes[i][k] for k in at])[:, None]
                w = model.weights(at)
                model.step(at, w, 2 * penalty * (w * step).sum() * step)
    w = model.weights()[:, 0]
    shift = 0.0
    if rates and {0, 1} <= set(rates):
        shift = float(np.log(rates[0] / rates[1]))
    kept = np.flatnonzero(aside)
    margin = np.array([w[rows[i]].sum() for i in kept])
    both = np.stack([np.zeros(len(kept)), margin], axis=1)
    some = np.flatnonzero(w[:-1])
    return {
        "words": vocabulary[some],
        "weights": w[:-1][some],
        "bias": float(w[-1]),
        # What undoes the sample's rates: the temperature is fitted without it, on
        # rows of the sample, so it comes behind the temperature.
        "shift": shift,
        "temperature": temperature(both, labels[kept].astype(np.int64)),
    }


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """A model from the labelled rows that are not held out."""
    known = (
        labels.filter("toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
    )
    rows = text_of(docs).filter(~holdout(F.col("doc_id"), PARTS, HELD_OUT))
    ids, rates = sampled(known.filter(~holdout(F.col("doc_id"), PARTS, HELD_OUT)),
                         "label", MAX_TRAINING_ROWS)
    chosen = one_row_each(rows, ids).select(
        "text", "label", (unit(F.lit("aside"), "doc_id") < 0.2).alias("aside")
    )
    found = in_workers(chosen).mapInArrow(
        _word_batches, "label int, aside boolean, words array<long>"
    ).toArrow()
    texts = [x.values.to_numpy().view(np.uint64) for x in found.column("words")]
    return fit(
        texts,
        found.column("label").to_numpy().astype(float),
        found.column("aside").to_numpy(),
        rates,
    )


def chances(data: np.ndarray, offs: np.ndarray, model: dict) -> np.ndarray:
    """Score of each text of a block."""
    hashes, first = distinct_words(data, offs)
    weight = np.zeros(len(hashes) + 1)
    keys = model["words"]
    if len(keys) and len(hashes):
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        weight[1:] = np.cumsum(np.where(keys[at] == hashes, model["weights"][at], 0.0))
    margin = weight[first[1:]] - weight[first[:-1]] + model["bias"]
    margin = margin / model["temperature"] + model["shift"]
    return 1 / (1 + np.exp(-np.clip(margin, -60, 60)))


def _score_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [
                chances(data, offs, model)
                for _, _, data, offs in blocks(batch.column("text"))
            ]
            score = np.concatenate(found) if found else np.zeros(0)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(score),
                    pa.array((score >= THRESHOLD).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def toxicity(docs: DataFrame, labels: DataFrame, model: dict | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    A null or empty text has the score of a text without any known word. Of repeated
    labels of an id the larger counts; labels of unknown ids and null labels are
    passed over. Without labels of both kinds the score is that of what there is.
    Rows without an id are held out. Whole texts are read; an empty table gives an
    empty result.
    """
    model = train(docs, labels) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = text_of(docs).withColumn(
        "held_out", holdout(F.col("doc_id"), PARTS, HELD_OUT)
    )
    return in_workers(rows).mapInArrow(
        _score_batches(shared),
        f"doc_id {kind}, held_out boolean, score double, predicted int",
    )
