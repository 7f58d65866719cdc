"""Quality classifier: random-indexing vectors and a two-layer network.

Tokens are runs of lower-case letters, capitals, digits or other signs, hashed to a
fixed vocabulary. Every token has a sparse random index vector; its context vector is
the sum of the index vectors around it over the whole corpus, added up by Spark. A
document is the mean and spread of its tokens' vectors. A network of two layers in
numpy is fitted on a bounded sample of labelled rows, and a temperature fitted on
rows set aside calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.learning import one_row_each, sampled, temperature
from wardlake.llm.shared import holdout, in_workers, text_of, unit
from wardlake.llm.text import IS_WHITE, blocks, mixed, word_hashes

VOCABULARY = 1 << 14
DIMENSIONS = 32
#: Signed places of an index vector that are not zero.
PLACES = 4
#: Tokens on either side that count as context.
WINDOW = 2
PARTS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Labelled rows the network is fitted on, at most (the bound of the sample).
MAX_TRAINING_ROWS = 16_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 128, 0.003, 1e-4
FEATURES = 3 * DIMENSIONS + 3


def _byte_kinds() -> np.ndarray:
    out = np.full(256, 4, np.uint8)
    out[IS_WHITE] = 0
    out[97:123], out[128:] = 1, 1
    out[65:91] = 2
    out[48:58] = 3
    return out


KIND = _byte_kinds()


def index_vectors() -> np.ndarray:
    """Sparse random vectors of -1, 0 and 1, the same in every process."""
    rng = np.random.default_rng(7)
    out = np.zeros((VOCABULARY, DIMENSIONS), np.float32)
    place = rng.random((VOCABULARY, DIMENSIONS)).argsort(axis=1)[:, :PLACES]
    sign = rng.choice(np.array([-1, 1], np.float32), (VOCABULARY, PLACES))
    np.put_along_axis(out, place, sign, axis=1)
    return out


INDEX = index_vectors()


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary numbers of the tokens and the offset of each text's first."""
    kind = KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    change = np.ones(len(data) + 1, bool)
    if len(data):
        change[1:-1] = kind[1:] != kind[:-1]
    change |= edge
    at = np.flatnonzero(change)
    starts, ends = at[:-1], at[1:]
    inside = kind[starts] != 0
    starts, ends = starts[inside], ends[inside]
    first = np.searchsorted(starts, offs)
    hashes = word_hashes(data, starts, ends)
    return (hashes % np.uint64(VOCABULARY)).astype(np.int64), first


def _context_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(VOCABULARY * DIMENSIONS, np.int64)
    seen = np.zeros(VOCABULARY, np.int64)
    place = np.argsort(-np.abs(INDEX), axis=1, kind="stable")[:, :PLACES]
    sign = np.take_along_axis(INDEX, place, axis=1).astype(np.int64)
    for batch in batches:
        for _, _, data, offs in blocks(batch.column("text")):
            token, first = tokens(data, offs)
            row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
            seen += np.bincount(token, minlength=VOCABULARY)
            for step in range(1, WINDOW + 1):
                same = row[step:] == row[:-step]
                left, right = token[:-step][same], token[step:][same]
                for here, there in ((left, right), (right, left)):
                    base = here * DIMENSIONS
                    for k in range(PLACES):
                        np.add.at(total, base + place[there, k], sign[there, k])
    some = np.flatnonzero(seen)
    grid = total.reshape(VOCABULARY, DIMENSIONS)[some]
    columns = [pa.array(some)] + [
        pa.array(np.ascontiguousarray(grid[:, d])) for d in range(DIMENSIONS)
    ]
    names = ["token"] + [f"d{d}" for d in range(DIMENSIONS)]
    yield pa.record_batch(columns, names=names)


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of the vocabulary over all whole texts."""
    names = [f"d{d}" for d in range(DIMENSIONS)]
    schema = ", ".join(["token long", *(f"{n} long" for n in names)])
    parts = in_workers(docs.select("text")).mapInArrow(_context_batches, schema)
    found = parts.groupBy("token").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    out = np.zeros((VOCABULARY, DIMENSIONS))
    at = found.column("token").to_numpy()
    for d, name in enumerate(names):
        out[at, d] = found.column(name).to_numpy()
    # What all tokens have in common says nothing about any of them.
    if len(at):
        norm = np.linalg.norm(out[at], axis=1, keepdims=True)
        unit_rows = out[at] / np.maximum(norm, 1e-9)
        centred = unit_rows - unit_rows.mean(axis=0)
        norm = np.linalg.norm(centred, axis=1, keepdims=True)
        out[at] = centred / np.maximum(norm, 1e-9)
    return out.astype(np.float32)


def pooled(data: np.ndarray, offs: np.ndarray, context: np.ndarray) -> np.ndarray:
    """One row of features per text: mean context vector, mean index vector, spread
    of the context vectors, the lengths of both means and the number of tokens."""
    token, first = tokens(data, offs)
    n = len(offs) - 1
    out = np.zeros((n, FEATURES), np.float32)
    count = np.diff(first)
    some = np.flatnonzero(count)
    if len(some):
        size = count[some, None].astype(np.float32)
        vectors = context[token]
        mean = np.add.reduceat(vectors, first[some], axis=0) / size
        square = np.add.reduceat(vectors * vectors, first[some], axis=0) / size
        own = np.add.reduceat(INDEX[token], first[some], axis=0) / size
        spread = np.sqrt(np.maximum(square - mean * mean, 0))
        out[some, :DIMENSIONS] = mean
        out[some, DIMENSIONS : 2 * DIMENSIONS] = own
        out[some, 2 * DIMENSIONS : 3 * DIMENSIONS] = spread
        out[some, -3] = np.linalg.norm(mean, axis=1)
        out[some, -2] = np.linalg.norm(own, axis=1)
    out[:, -1] = np.log1p(count)
    return out


def _sample_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [
                pooled(data, offs, shared.value)
                for _, _, data, offs in blocks(batch.column("text"))
            ]
            rows = np.concatenate(parts) if parts else np.zeros((0, FEATURES))
            yield pa.record_batch(
                [
                    batch.column("label"),
                    batch.column("aside"),
                    pa.array(list(rows.astype(np.float32)), pa.list_(pa.float32())),
                ],
                names=["label", "aside", "features"],
            )

    return run


class Network:
    """Inputs, one hidden layer, one margin; fitted by Adam."""

    def __init__(self, inputs: np.ndarray):
        self.mean = inputs.mean(axis=0) if len(inputs) else np.zeros(FEATURES)
        spread = inputs.std(axis=0) if len(inputs) else np.ones(FEATURES)
        self.scale = 1 / np.maximum(spread, 1e-4)
        rng = np.random.default_rng(3)
        self.layers = [
            rng.normal(0, np.sqrt(2 / FEATURES), (FEATURES, HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, np.sqrt(2 / HIDDEN), HIDDEN),
            np.zeros(1),
        ]

    def hidden(self, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.clip((inputs - self.mean) * self.scale, -8, 8)
        return x, np.maximum(x @ self.layers[0] + self.layers[1], 0)

    def margins(self, inputs: np.ndarray) -> np.ndarray:
        return self.hidden(inputs)[1] @ self.layers[2] + self.layers[3][0]

    def fit(self, inputs: np.ndarray, labels: np.ndarray) -> None:
        rng = np.random.default_rng(5)
        first = [np.zeros_like(p) for p in self.layers]
        second = [np.zeros_like(p) for p in self.layers]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(labels))
            for low in range(0, len(order), BATCH):
                some = order[low : low + BATCH]
                x, h = self.hidden(inputs[some])
                margin = h @ self.layers[2] + self.layers[3][0]
                error = (1 / (1 + np.exp(-margin)) - labels[some]) / len(some)
                back = np.outer(error, self.layers[2]) * (h > 0)
                slopes = [
                    x.T @ back + DECAY * self.layers[0],
                    back.sum(axis=0),
                    h.T @ error + DECAY * self.layers[2],
                    np.array([error.sum()]),
                ]
                step += 1
                for k, slope in enumerate(slopes):
                    first[k] = 0.9 * first[k] + 0.1 * slope
                    second[k] = 0.999 * second[k] + 0.001 * slope**2
                    move = (first[k] / (1 - 0.9**step)) / (
                        np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                    )
                    self.layers[k] = self.layers[k] - RATE * move


def fit(inputs: np.ndarray, labels: np.ndarray, aside: np.ndarray, rates: dict) -> dict:
    """A network, the shift that undoes the sample's rates, and a temperature."""
    learn = ~aside if (~aside).any() else np.ones(len(labels), bool)
    network = Network(inputs[learn])
    network.fit(inputs[learn], labels[learn])
    shift = 0.0
    if {0, 1} <= set(rates):
        shift = float(np.log(rates[0] / rates[1]))
    # Fitted on rows of the sample, so the shift comes behind the temperature.
    margin = network.margins(inputs[aside])
    both = np.stack([np.zeros(len(margin)), margin], axis=1)
    return {
        "network": network,
        "shift": shift,
        "temperature": temperature(both, labels[aside].astype(np.int64)),
    }


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """Context vectors of all texts, and a network from the labelled rows that are
    not held out."""
    context = context_vectors(text_of(docs))
    shared = docs.sparkSession.sparkContext.broadcast(context)
    known = (
        labels.filter("quality is not null")
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("label"))
        .filter(~holdout(F.col("doc_id"), PARTS, HELD_OUT))
    )
    ids, rates = sampled(known, "label", MAX_TRAINING_ROWS)
    chosen = one_row_each(text_of(docs), ids).select(
        "text", "label", (unit(F.lit("aside"), "doc_id") < 0.2).alias("aside")
    )
    found = in_workers(chosen).mapInArrow(
        _sample_batches(shared), "label int, aside boolean, features array<float>"
    ).toArrow()
    inputs = np.array(found.column("features").to_pylist(), float)
    model = fit(
        inputs.reshape(-1, FEATURES),
        found.column("label").to_numpy().astype(float),
        found.column("aside").to_numpy(),
        rates,
    )
    return {**model, "context": context}


def _score_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = []
            for _, _, data, offs in blocks(batch.column("text")):
                rows = pooled(data, offs, model["context"])
                margin = model["network"].margins(rows) / model["temperature"]
                margin = np.clip(margin + model["shift"], -60, 60)
                found.append(1 / (1 + np.exp(-margin)))
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


def quality(docs: DataFrame, labels: DataFrame, model: dict | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    A null or empty text has no tokens; it is scored from features of zeros. Of
    repeated labels of an id the larger counts; labels of unknown ids and null labels
    are passed over. Rows without an id are held out. Whole texts are read; an empty
    table gives an empty result.
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
