import hashlib
import random
from collections import Counter

import numpy as np

from wardlake.llm import substrings
from wardlake.llm.suffix_array import suffix_order, window_runs

WINDOW = substrings.WINDOW


def brute(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(
        b[k : k + WINDOW] for _, b in texts for k in range(len(b) - WINDOW + 1)
    )
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - WINDOW + 1):
            if count[b[k : k + WINDOW]] > 1:
                gone[k : k + WINDOW] = b"\1" * WINDOW
        kept = bytes(x for x, f in zip(b, gone, strict=True) if not f)
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages():
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows = []
    for i in range(40):
        head = "".join(rng.choice("ijklé") for _ in range(rng.randint(0, 500)))
        tail = "".join(rng.choice("mnop") for _ in range(rng.randint(0, 300)))
        middle = shared[rng.randint(0, 200) : rng.randint(600, 900)]
        rows.append((1000 + i, head + middle + tail))
    return rows + [(2000, "a" * 3000), (2001, "ab" * 900), (2002, "x" * 399)] * 2


def test_suffixes_are_sorted():
    rng = random.Random(3)
    for _ in range(150):
        letters = b"ab\x00\xff"[: rng.randint(1, 4)]
        data = bytes(rng.choice(letters) for _ in range(rng.randint(1, 80)))
        array = np.frombuffer(data, np.uint8)
        found = suffix_order(array, np.ones(len(array), bool), 1000).tolist()
        assert found == sorted(range(len(data)), key=lambda i: data[i:])


def test_equal_windows_share_a_run():
    rng = random.Random(4)
    for _ in range(100):
        starts = [rng.randint(1, 8) for _ in range(rng.randint(1, 6))]
        parts = [
            bytes(rng.choice(b"ab") for _ in range(n + 4 + rng.randint(0, 2)))
            for n in starts
        ]
        order, run = window_runs(parts, starts, 5)
        whole = b"".join(parts)
        windows = [whole[i : i + 5] for i in order]
        assert windows == sorted(windows) and len(order) == sum(starts)
        assert len(set(zip(windows, run.tolist(), strict=True))) == len(set(windows))


def test_against_brute_force(spark, corpus, docs):
    rows = [(row[0], row[1]) for row in corpus if len(row[1] or "") < 6000]
    rows += passages()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = [tuple(r) for r in substrings.without_repeats(frame).collect()]
    assert sorted(found, key=str) == brute(rows)
    assert substrings.without_repeats(docs).count() == len(corpus)


def test_crowded_anchors_are_compared_across_portions(spark, monkeypatch):
    whole = substrings.repeated_spans
    monkeypatch.setattr(substrings, "repeated_spans", lambda t: whole(t, portion=4))
    rows = passages()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = [tuple(r) for r in substrings.without_repeats(frame).collect()]
    assert sorted(found, key=str) == brute(rows)


def test_long_texts_are_cut_without_losing_windows(spark, monkeypatch):
    monkeypatch.setattr(substrings, "STRETCH", 700)
    found = []
    text = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    for at, part in substrings.stretches(text):
        _, first, count, _ = substrings.anchors(part, np.array([0, len(part)]))
        found += [at + f + k for f, n in zip(first, count, strict=True) for k in range(n)]
    assert found == list(range(5000 - WINDOW + 1))


def test_texts_and_spans_on_request(spark):
    rows = [(1, "q" * 10 + "z" * 500), (2, "z" * 450 + "r")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in substrings.without_repeats(frame, True).collect()}
    assert bytes(found[1]["kept"]) == b"q" * 10
    assert [tuple(s) for s in found[2]["removed_spans"]] == [(0, 450)]


def test_empty_table(no_docs):
    assert substrings.without_repeats(no_docs).count() == 0
