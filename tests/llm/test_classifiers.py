import zlib

import numpy as np

from wardlake.llm import langid, quality_net, toxicity
from wardlake.llm.learning import Ftrl, softmax, temperature


def held_out(i, parts, part):
    return i is None or zlib.crc32(str(i).encode()) % parts == part


def test_language_of_held_out_texts(docs, corpus):
    rows = langid.identify(docs).collect()
    assert len(rows) == len(corpus)
    lang = {r[0]: r[2] for r in corpus}
    text = {r[0]: r[1] for r in corpus}
    right = seen = 0
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == held_out(r["doc_id"], 3, 1)
        letters = any(c.isalpha() for c in text[r["doc_id"]] or "")
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (not letters)
        if r["held_out"] and lang[r["doc_id"]] and letters:
            seen += 1
            right += r["lang_pred"] == lang[r["doc_id"]]
    assert right / seen > 0.95


def test_features_are_the_characters_of_each_text(docs):
    data = np.frombuffer("Ab éÉ\n".encode() * 2, np.uint8)
    half = len(data) // 2
    a, b = langid.features(data, np.array([0, half, len(data)]))
    assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()
    assert a[1].sum() == 6 + 5 + 4 and a[2]


def test_weights_are_sparse(docs):
    model = langid.train(docs)
    assert 0 < np.count_nonzero(model["weights"]) < model["weights"].size / 4


def test_ftrl_learns_and_zeroes_noise():
    rng = np.random.default_rng(0)
    model = Ftrl(50, 2, 0.5, 2.0, 0.01)
    for _ in range(2000):
        label = int(rng.integers(2))
        at = np.unique(np.append(rng.integers(2, 50, 5), label))
        w = model.weights(at)
        error = softmax(w.sum(axis=0))
        error[label] -= 1
        model.step(at, w, np.tile(error, (len(at), 1)))
    w = model.weights()
    assert w[0, 0] > 1 and w[1, 1] > 1 and np.abs(w[2:]).max() < 0.5
    assert (w[2:] == 0).any()


def test_temperature_undoes_a_factor():
    rng = np.random.default_rng(0)
    scores = rng.normal(0, 2, (4000, 3))
    labels = np.array([rng.choice(3, p=p) for p in softmax(scores)])
    assert 2.5 < temperature(scores * 3, labels) < 3.6
    assert temperature(scores[:0], labels[:0]) == 1.0


def texts_and_labels(n=1500):
    """Attacks hold a slur; group terms go with attacks more often than without."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        words = [f"w{k}" for k in rng.integers(0, 300, 30)]
        if toxic and rng.random() < 0.9:
            words.append("grubby")
        if rng.random() < (0.8 if toxic else 0.1):
            words.append(str(rng.choice(["muslim", "jewish"])))
        rows.append((i, " ".join(words).replace("w", "wa"), int(toxic)))
    return rows


def chance(model, text):
    data = np.frombuffer(text.encode(), np.uint8)
    return toxicity.chances(data, np.array([0, len(data)]), model)[0]


def test_swapping_groups_changes_scores_less_with_the_penalty():
    rows = texts_and_labels()
    # One term of the pair goes with attacks only, the other is neutral.
    rows = [(i, t.replace("jewish", "muslim") if y else t.replace("muslim", "jewish"), y)
            for i, t, y in rows]
    joined = "\n".join(t for _, t, _ in rows).encode()
    offs = np.cumsum([0] + [len(t.encode()) + 1 for _, t, _ in rows])
    offs[-1] = len(joined)
    hashes, first = toxicity.distinct_words(np.frombuffer(joined, np.uint8), offs)
    texts = [hashes[first[i] : first[i + 1]] for i in range(len(rows))]
    labels = np.array([y for _, _, y in rows], float)
    aside = np.arange(len(rows)) % 5 == 0
    gap = {}
    for penalty in (0.0, 1.0):
        model = toxicity.fit(texts, labels, aside, penalty=penalty)
        assert chance(model, "you grubby one") > 0.5
        gap[penalty] = abs(chance(model, "a muslim house") - chance(model, "a jewish house"))
    assert gap[1.0] < gap[0.0] / 2


def test_toxicity_of_held_out_texts(spark):
    rows = texts_and_labels()
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = toxicity.toxicity(docs.drop("toxic"), docs.select("doc_id", "toxic")).collect()
    label = {i: (y, "grubby" in t) for i, t, y in rows}
    for r in found:
        assert r["held_out"] == held_out(r["doc_id"], 4, 2)
        assert r["predicted"] == int(r["score"] >= 0.3)
    plain = [r for r in found if r["held_out"] and not label[r["doc_id"]][0]]
    slurs = [r for r in found if r["held_out"] and label[r["doc_id"]][1]]
    assert sum(r["predicted"] for r in slurs) > 0.9 * len(slurs)
    assert sum(r["predicted"] for r in plain) < 0.1 * len(plain)


def test_quality_of_held_out_texts(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1200):
        good = i % 4 > 0
        words = [f"{'abc'[k % 3]}{'de'[k % 2]}{k}" for k in rng.integers(0, 400, 60)]
        if not good:
            words = [w + "$$$" if k % 2 else w.upper() for k, w in enumerate(words)]
        rows.append((i, " ".join(words), int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    found = quality_net.quality(docs.drop("quality"), docs.select("doc_id", "quality"))
    right = seen = 0
    for r in found.collect():
        assert r["predicted"] == int(r["score"] >= 0.7)
        if r["held_out"]:
            seen += 1
            right += r["predicted"] == int(r["doc_id"] % 4 > 0)
    assert right / seen > 0.97


def test_context_vectors_are_sums_over_neighbours(docs, corpus):
    data = np.frombuffer(b"one two three two one", np.uint8)
    token, first = quality_net.tokens(data, np.array([0, 13, len(data)]))
    assert first.tolist() == [0, 3, 5]
    vectors = quality_net.context_vectors(docs)
    norms = np.linalg.norm(vectors, axis=1)
    assert set(np.round(norms, 3).tolist()) <= {0.0, 1.0}


def test_odd_rows_and_empty_tables(docs, no_docs, labels, corpus):
    for operator in (toxicity.toxicity, quality_net.quality):
        found = operator(docs, labels).collect()
        assert len(found) == len(corpus)
        assert all(0 <= r["score"] <= 1 for r in found)
        assert operator(docs, labels.limit(0)).count() == len(corpus)
        assert operator(no_docs, labels).count() == 0
    assert langid.identify(no_docs).count() == 0


def test_an_id_that_repeats_gives_one_row(spark):
    from pyspark.sql import functions as F

    from wardlake.llm.learning import one_row_each

    hot = spark.range(0, 50_000, 1, 4).select(
        F.lit(7).cast("long").alias("doc_id"),
        F.concat(F.lit("text "), (F.col("id") % 5).cast("string")).alias("text"),
    )
    rows = hot.union(spark.createDataFrame([(8, "other"), (9, "no label")], hot.schema))
    ids = spark.createDataFrame([(7, 1), (8, 0), (10, 1)], "doc_id long, label int")
    found = sorted(tuple(r) for r in one_row_each(rows, ids).collect())
    assert [(r[0], r[2]) for r in found] == [(7, 1), (8, 0)]
    assert found == sorted(tuple(r) for r in one_row_each(rows.repartition(3), ids).collect())


def test_rates_are_undone_behind_the_temperature():
    import numpy as np

    from wardlake.llm import toxicity as module

    rng = np.random.default_rng(5)
    labels = np.array([i % 2 for i in range(600)], float)
    texts = [np.array([2 + int(y) if rng.random() < 0.8 else 3 - int(y)], np.uint64) for y in labels]
    aside = rng.random(600) < 0.3
    plain = module.fit(texts, labels, aside, {0: 1.0, 1: 1.0})
    rare = module.fit(texts, labels, aside, {0: 0.01, 1: 1.0})
    assert plain["temperature"] == rare["temperature"]
    assert abs(rare["shift"] - np.log(0.01)) < 1e-9 and plain["shift"] == 0
