"""Language identification: multinomial logistic regression on character n-grams.

Characters are lower-cased code points with white space as one kind; n-grams of one
to three of them are hashed to a fixed number of features and weighted by TF-IDF.
The document frequencies are counted by Spark over all training documents. The
weights are learned by follow-the-regularised-leader with elastic-net penalties on
a bounded sample of labelled rows, most of them are zero, and a temperature fitted
on rows set aside makes the probabilities honest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.learning import Ftrl, sampled, softmax, temperature
from wardlake.llm.shared import holdout, in_workers, text_of, unit
from wardlake.llm.text import blocks, mixed

GRAMS = (1, 2, 3)
FEATURES = 1 << 15
#: Labelled rows the weights are fitted on, at most (the bound of the sample).
MAX_TRAINING_ROWS = 4000
PARTS, HELD_OUT = 3, 1
EPOCHS, ALPHA, L1, L2 = 4, 1.0, 0.002, 0.01
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def characters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: what it counts as, and whether it is a letter."""
    count = 0x110000
    letter = np.zeros(count, bool)
    folded = np.arange(count, dtype=np.uint32)
    for code in range(count):
        char = chr(code)
        if char.isalpha():
            letter[code] = True
            low = char.lower()
            if len(low) == 1:
                folded[code] = ord(low)
        elif char.isspace():
            folded[code] = 32
    return folded, letter


def features(data: np.ndarray, offs: np.ndarray) -> Iterator[tuple]:
    """Per text of a block: (features, their counts, whether it has a letter)."""
    folded, letter = characters()
    text = data.tobytes().decode("utf-8", "replace").encode("utf-32-le")
    codes = np.frombuffer(text, np.uint32)
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    at = lead[offs]
    letters = np.concatenate(([0], np.cumsum(letter[codes])))
    kinds = folded[codes].astype(np.uint64)
    hashed = []
    for n in GRAMS:
        key = np.full(max(0, len(kinds) - n + 1), n, np.uint64)
        for k in range(n):
            key = (key << np.uint64(20)) ^ kinds[k : len(kinds) - n + 1 + k]
        hashed.append((mixed(key) % np.uint64(FEATURES)).astype(np.int64))
    for row in range(len(at) - 1):
        a, b = int(at[row]), int(at[row + 1])
        parts = [h[a : max(a, b - n + 1)] for n, h in zip(GRAMS, hashed, strict=True)]
        count = np.bincount(np.concatenate(parts), minlength=FEATURES)
        some = np.flatnonzero(count)
        yield some, count[some], letters[b] > letters[a]


def _frequency_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(FEATURES + 1, np.int64), 0
    for batch in batches:
        rows += batch.num_rows
        for _, _, data, offs in blocks(batch.column("text")):
            for some, _, _ in features(data, offs):
                total[some] += 1
    total[FEATURES] = rows  # the number of texts
    seen = np.flatnonzero(total)
    yield pa.record_batch([pa.array(seen), pa.array(total[seen])], ["feature", "n"])


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of every feature."""
    parts = in_workers(texts.select("text")).mapInArrow(_frequency_batches, "feature long, n long")
    found = parts.groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(FEATURES + 1)
    total[found.column("feature").to_numpy()] = found.column("n").to_numpy()
    return np.log((1 + total[FEATURES]) / (1 + total[:FEATURES])) + 1


def weighted(some: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(count)) * idf[some]
    return values / max(np.sqrt((values**2).sum()), 1e-12)


def _sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        some, counts = [], []
        for _, _, data, offs in blocks(batch.column("text")):
            for index, count, _ in features(data, offs):
                some.append(index.astype(np.int32))
                counts.append(count.astype(np.float32))
        yield pa.record_batch(
            [
                batch.column("lang"),
                batch.column("aside"),
                pa.array(some, pa.list_(pa.int32())),
                pa.array(counts, pa.list_(pa.float32())),
            ],
            names=["lang", "aside", "some", "counts"],
        )


def fit(idf: np.ndarray, rows: pa.Table) -> dict:
    """Weights, languages and temperature from the sample."""
    names = sorted(set(rows.column("lang").to_pylist()))
    number = {name: i for i, name in enumerate(names)}
    labels = np.array([number[x] for x in rows.column("lang").to_pylist()], np.int64)
    aside = rows.column("aside").to_numpy()
    some = [x.values.to_numpy() for x in rows.column("some")]
    values = [
        weighted(s, c.values.to_numpy(), idf)
        for s, c in zip(some, rows.column("counts"), strict=True)
    ]
    model = Ftrl(FEATURES, max(1, len(names)), ALPHA, L1, L2)
    learn = np.flatnonzero(~aside) if (~aside).any() else np.arange(len(labels))
    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in rng.permutation(learn):
            w = model.weights(some[i])
            error = softmax(values[i] @ w)
            error[labels[i]] -= 1
            model.step(some[i], w, values[i][:, None] * error)
    w = model.weights()
    kept = np.flatnonzero(aside)
    scores = np.array([values[i] @ w[some[i]] for i in kept]).reshape(-1, w.shape[1])
    return {
        "names": names,
        "weights": w.astype(np.float32),
        "temperature": temperature(scores, labels[kept]),
        "idf": idf,
    }


def train(docs: DataFrame) -> dict:
    """A model from the rows of ``docs`` with a language that are not held out."""
    rows = text_of(docs, "lang").filter(
        F.col("lang").isNotNull() & ~holdout(F.col("doc_id"), PARTS, HELD_OUT)
    )
    idf = inverse_frequencies(rows)
    chosen, _ = sampled(rows, "lang", MAX_TRAINING_ROWS)
    chosen = chosen.select(
        "text", "lang", (unit(F.lit("aside"), "doc_id") < 0.2).alias("aside")
    )
    schema = "lang string, aside boolean, some array<int>, counts array<float>"
    return fit(idf, in_workers(chosen).mapInArrow(_sample_batches, schema).toArrow())


def _predict_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found, scores = [], []
            for _, _, data, offs in blocks(batch.column("text")):
                for some, count, has_letter in features(data, offs):
                    if not has_letter or not model["names"]:
                        found.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    x = weighted(some, count, model["idf"])
                    chance = softmax(x @ model["weights"][some] / model["temperature"])
                    best = int(chance.argmax())
                    found.append(model["names"][best])
                    scores.append(float(chance[best]))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(found, pa.string()),
                    pa.array(scores, pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    ``lang_pred`` is a learned language and ``score`` its probability; a null text,
    or one without a letter, is ``und`` with score 0, and so is every text where
    nothing could be learned. Equal probabilities go to the first language by name.
    Whole texts are read. Rows without an id are held out. Rows that repeat are
    scored alike; an empty table gives an empty result.
    """
    model = train(docs) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = text_of(docs).withColumn(
        "held_out", holdout(F.col("doc_id"), PARTS, HELD_OUT)
    )
    return in_workers(rows).mapInArrow(
        _predict_batches(shared),
        f"doc_id {kind}, held_out boolean, lang_pred string, score double",
    )
