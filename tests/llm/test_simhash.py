import re

import numpy as np
import pyarrow as pa
import xxhash

from wardlake.llm import simhash
from wardlake.llm.components import component_roots
from wardlake.llm.simhash import near_duplicates, without_near_duplicates
from wardlake.llm.text import blocks


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)]
    shingles = shingles or ([" ".join(words)] if words else [])
    found = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_fingerprints_of_many_texts_at_once(corpus):
    texts = [row[1] for row in corpus]
    found = [
        simhash.fingerprints_of(data, offs)
        for _, _, data, offs in blocks(pa.array(texts), 3000)
    ]
    assert [int(x) for x in np.concatenate(found)] == [fingerprint(t) for t in texts]


def expected_components(rows):
    prints = [fingerprint(row[1]) for row in rows]
    distinct = sorted(set(prints))
    edges = [
        (a, b)
        for i, a in enumerate(distinct)
        for b in distinct[i + 1 :]
        if (a ^ b).bit_count() <= 4
    ]
    root = roots(distinct, edges)
    least = {}
    for row, fp in zip(rows, prints, strict=True):
        if row[0] is not None:
            least[root[fp]] = min(row[0], least.get(root[fp], row[0]))
    return [
        (row[0], f"{fp:016x}", least.get(root[fp]))
        for row, fp in zip(rows, prints, strict=True)
    ]


def test_components_against_all_pairs(docs, corpus):
    found = [tuple(r) for r in near_duplicates(docs).collect()]
    assert sorted(found, key=str) == sorted(expected_components(corpus), key=str)


def test_one_row_of_each_component_stays(docs, corpus):
    found = without_near_duplicates(docs)
    assert found.columns == docs.columns
    ids = sorted(r["doc_id"] for r in found.collect() if r["doc_id"] is not None)
    classes = {c for i, _, c in expected_components(corpus) if i is not None}
    assert ids == sorted(classes)


def test_rows_of_repeated_and_null_ids_stay(spark):
    rng = np.random.default_rng(3)
    one, two, three, four, five = (
        " ".join(f"w{k}" for k in rng.integers(0, 10_000, 80)) for _ in range(5)
    )
    rows = [(7, one), (7, two), (3, three), (7, three), (None, four), (None, five)]
    rows += [(None, four + "\n"), (None, two), (None, one + " "), (7, one)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r[0], r[1].strip()) for r in without_near_duplicates(frame).collect()]
    expected = [(7, one), (7, two), (3, three), (None, four), (None, five)]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_crowded_anchors_are_tiled(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 3, np.uint64)
    values = set()
    for one in base:
        for _ in range(150):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            values.add(int(one ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))))
    values = sorted(values)
    frame = spark.createDataFrame(
        [(int(np.uint64(v).view(np.int64)),) for v in values], "fp long"
    )
    edges = [
        (a, b)
        for i, a in enumerate(values)
        for b in values[i + 1 :]
        if (a ^ b).bit_count() <= 4
    ]
    expected = roots(values, edges)
    for tile in (4096, 16):
        links = simhash.fingerprint_links(frame, tile).collect()
        found = roots(values, [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links])
        assert found == expected


def test_component_roots_of_chains_and_stars(spark):
    rng = np.random.default_rng(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)]
    edges += [tuple(map(int, e)) for e in rng.integers(200, 260, (40, 2))]
    frame = spark.createDataFrame(edges + edges[:5] + [(7, 7)], "a long, b long")
    found = {r["node"]: r["root"] for r in component_roots(frame).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert found == {n: r for n, r in roots(nodes, edges_of(edges)).items()}


def edges_of(edges):
    return [(a, b) for a, b in edges if a != b]


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).count() == 0
    assert without_near_duplicates(no_docs).count() == 0
