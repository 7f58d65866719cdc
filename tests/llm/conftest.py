import random

import pytest
from pyspark.sql import types as T

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, as further columns of the input.
CLASHES = (
    "key plain digest twin u size block row fp piece tid low keys run bits kept "
    "perplexity shard slot target shards score label held_out"
).split()
EN = "the and of to in is that for it was on are with as by be this have from".split()
DE = "der die und in den von zu das mit sich des auf ist im dem nicht ein eine".split()


def prose(rng, words, n):
    found = [rng.choice(words) + rng.choice(("", "", "ing", "er")) for _ in range(n)]
    return " ".join(found).replace(" that ", ".\n")


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source, n_chars) with copies, near copies and odd rows."""
    rng = random.Random(11)
    rows = []
    for i in range(160):
        lang, words = (("en", EN), ("de", DE))[i % 3 == 0]
        text = prose(rng, words, rng.randint(1, 300))
        rows.append((i, text, lang, f"src{i % 4}" if i % 7 else "src0", len(text)))
    for i in range(160, 200):
        _, text, lang, _, _ = rows[rng.choice((3, 4, 5, rng.randrange(160)))]
        if i % 2:
            text = text.replace(" ", "  ", 1) + "\n"
        rows.append((i, text, lang, "src1", len(text)))
    odd = [None, "", "   \n\t", "x" * 5000, "a b " * 4000, "1234 !!", "é" * 700]
    for i, text in enumerate(odd):
        rows.append((200 + i, text, None, None, None))
    rows.append((None, "a text without an id", "en", None, None))
    rows.append((None, None, None, None, None))
    rows += [rows[7], rows[7], rows[1]]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus in six partitions, with columns of clashing names."""
    schema = T._parse_datatype_string(COLUMNS)
    for name in CLASHES:
        schema.add(name, "string")
    more = tuple("z" for _ in CLASHES)
    frame = spark.createDataFrame([row + more for row in corpus], schema)
    return frame.repartition(6).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 5 > 0, i % 9 == 0) for i in range(0, 190)]
    rows += [(3, 1, 0), (4, None, None), (9999, 1, 1), (None, 1, 1)]
    return spark.createDataFrame(
        [(a, b if b is None else int(b), c if c is None else int(c)) for a, b, c in rows],
        "doc_id long, quality int, toxic int",
    )
