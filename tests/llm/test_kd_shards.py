import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from wardlake.llm.kd_shards import kd_shards, sharded_documents


def test_rows_keep_their_sizes_and_slots_have_no_gap(docs, corpus):
    rows = kd_shards(docs).collect()
    expected = [
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()))
        for r in corpus
    ]
    found = [(r["doc_id"], r["size"], r["text_crc32"]) for r in rows]
    assert sorted(found, key=str) == sorted(expected, key=str)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_have_near_equal_bytes(spark):
    rows = [
        (i, "x" * (i * 7919 % 400), "en" if i % 3 else "de", f"s{i % 5}")
        for i in range(8000)
    ]
    rows += [(8000 + i, "same text " * 9, "en", "s0") for i in range(4000)]
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string"
    )
    for shards in (1, 3, 16):
        load = defaultdict(int)
        for r in kd_shards(frame, shards).collect():
            load[r["shard"]] += r["size"]
        assert sorted(load) == list(range(shards))
        mean = sum(load.values()) / shards
        assert max(load.values()) < 1.02 * mean and min(load.values()) > 0.98 * mean


def test_splits_follow_the_widest_dimension(spark):
    rows = [(i, "t" * 50, "en", "s") for i in range(200)]
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string"
    )
    shard = {r["doc_id"]: r["shard"] for r in kd_shards(frame, 4).collect()}
    assert [shard[i] for i in range(200)] == sorted(shard.values())


def test_documents_are_written_by_target_bytes(docs):
    found = sharded_documents(docs, 20_000)
    assert set(found.columns) == {*docs.columns, "shard"}
    assert found.select("shard").distinct().count() > 1


def test_all_rows_are_carried_over(spark):
    rows = [(i if i % 3 else None, f"text {i // 2} " * 9, "en", "s") for i in range(300)]
    rows += [(None, None, "en", "s"), (None, None, "de", "s"), (5, rows[5][1], "de", "t")]
    rows += rows[:4]
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string"
    )
    found = sharded_documents(frame, 4000).drop("shard").collect()
    assert sorted(map(tuple, found), key=str) == sorted(rows, key=str)


def test_repeated_rows_without_an_id_are_spread(spark):
    rows = [(i, "x" * (i * 31 % 300), "en", f"s{i % 5}") for i in range(2000)]
    rows += [(None, "one text for all of these rows " * 3, "en", "s0")] * 1000
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string"
    ).repartition(5)
    found = kd_shards(frame).collect()
    load, slots = defaultdict(int), defaultdict(list)
    for r in found:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(load.values()) / 16
    assert sorted(load) == list(range(16)) and len(found) == 3000
    assert max(load.values()) < 1.02 * mean and min(load.values()) > 0.98 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    spread = sharded_documents(frame, sum(load.values()) // 16)
    sizes = [r["n"] for r in spread.groupBy("shard").agg(
        F.sum(F.octet_length("text") + 1).alias("n")).collect()]
    assert max(sizes) < 1.3 * sum(sizes) / len(sizes) and spread.count() == 3000


def test_empty_table(no_docs):
    assert kd_shards(no_docs).count() == 0
