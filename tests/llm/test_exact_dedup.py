import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from wardlake.llm import exact_dedup
from wardlake.llm.exact_dedup import directory, exact_duplicates, without_duplicates
from wardlake.llm.shared import stored


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_groups_follow_normalised_texts(docs, corpus):
    groups = defaultdict(list)
    for row in corpus:
        groups[plain(row[1])].append(row[0])
    expected = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        stays = True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            kept = i == keep and stays
            stays = stays and not kept
            expected.append((i, keep, len(ids), kept, digest))
    found = [tuple(r) for r in exact_duplicates(docs).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_one_row_of_each_group_stays_with_all_columns(docs, corpus):
    found = without_duplicates(docs)
    assert found.columns == docs.columns
    texts = [plain(r["text"]) for r in found.collect()]
    assert sorted(texts) == sorted({plain(row[1]) for row in corpus})


def test_empty_table(no_docs):
    assert exact_duplicates(no_docs).count() == 0
    assert without_duplicates(no_docs).count() == 0


def test_directory_splits_overfull_buckets(spark):
    entries = stored(spark.sql("SELECT xxhash64(id) AS key FROM range(3000)"), "keys")
    slots = directory(entries, bucket_keys=100).collect()
    load = defaultdict(int)
    at = {r["slot"]: (r["depth"], r["bucket"]) for r in slots}
    for row in entries.collect():
        load[at[(row["key"] % (1 << 64)) >> 48]] += 1
    assert sum(load.values()) == 3000
    assert max(load.values()) <= 100
    assert len({depth for depth, _ in load}) > 1


def test_chains_of_equal_keys_are_told_apart(docs, monkeypatch):
    """With keys of 3 bits nearly all texts share a key, and the rows stay the same."""
    built = []
    build = exact_dedup.build_index
    monkeypatch.setattr(
        exact_dedup, "build_index", lambda *a: built.append(build(*a)) or built[-1]
    )
    short = [tuple(r) for r in exact_duplicates(docs, key_bits=3).collect()]
    assert sorted(short, key=str) == sorted(map(tuple, exact_duplicates(docs).collect()), key=str)
    chains = built[0].groupBy("key").agg(
        F.max("chained").alias("last"), F.count(F.lit(1)).alias("n")
    )
    rows = chains.collect()
    assert len(rows) <= 8 and max(r["last"] for r in rows) > 8
    assert all(r["last"] == r["n"] - 1 for r in rows)


def test_documents_are_looked_up_in_the_bucket_of_their_key(docs, monkeypatch):
    """Half of the directory finds the documents of half of the keys."""
    whole = exact_dedup.directory
    monkeypatch.setattr(
        exact_dedup, "directory", lambda entries: whole(entries).filter("slot >= 1 << 15")
    )
    expected = {r[0] for r in docs.select(exact_dedup.normalised().alias("plain")).filter(
        F.xxhash64("plain") < 0
    ).select(F.sha2("plain", 256)).collect()}
    found = {r["text_sha256"] for r in exact_duplicates(docs).collect()}
    assert found == expected and found


def test_many_rows_of_one_text_without_an_id(spark):
    rows = spark.sql(
        "SELECT if(id % 3 = 0, NULL, id) AS doc_id, "
        "if(id % 3 = 0, 'the same', concat('text ', id)) AS text, 1 AS digest, 2 AS row, "
        "3 AS keep_id FROM range(6000)"
    )
    found = exact_duplicates(rows)
    assert found.count() == 6000
    assert found.filter("kept").count() == 4001
    kept = without_duplicates(rows)
    assert kept.columns == rows.columns and kept.count() == 4001
