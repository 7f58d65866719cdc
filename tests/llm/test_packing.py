import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from wardlake.llm import packing
from wardlake.llm.text import blocks

PATH = packing.tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_ids_are_the_tokenizers(tokenizer, corpus):
    odd = ["İstanbul ΣΑΣ, don't I'll x\x1cy\x85z é <|endoftext|>a\n\n\tb", "a　b\x0bc 日本語"]
    texts = [row[1] for row in corpus] + odd
    known = packing.WordIds(PATH)
    found = []
    for _ in range(2):  # the second time all words are known
        for low, high, data, offs in blocks(pa.array(texts), 3000):
            ids, first = known.encode(data, offs)
            found += [ids[first[i] : first[i + 1]].tolist() for i in range(high - low)]
    expected = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert found == expected * 2


def test_ids_survive_forgetting_and_merging(tokenizer, monkeypatch, corpus):
    monkeypatch.setattr(packing, "KEPT_WORDS", 40)
    monkeypatch.setattr(packing, "LATE_WORDS", 10)
    known = packing.WordIds(PATH)
    texts = [row[1] for row in corpus[:80]]
    found = []
    for low, high, data, offs in blocks(pa.array(texts), 900):
        ids, first = known.encode(data, offs)
        found += [ids[first[i] : first[i + 1]].tolist() for i in range(high - low)]
    assert found == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def parity_words(n):
    """Two words of n letters whose polynomials modulo 2**64 agree for any odd base."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_of_one_key_get_their_own_ids(tokenizer, monkeypatch):
    texts = [*parity_words(1024), *parity_words(2048), "one two three one", "two"]
    for same_key in (False, True):
        if same_key:
            monkeypatch.setattr(
                packing, "span_keys", lambda d, s, e: np.zeros(len(s), np.uint64)
            )
        known = packing.WordIds(PATH)
        for _ in range(2):
            found = []
            for low, high, data, offs in blocks(pa.array(texts)):
                ids, first = known.encode(data, offs)
                found += [ids[first[i] : first[i + 1]].tolist() for i in range(high - low)]
            expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
            assert found == expected


def check(rows, texts, tokenizer, capacity):
    """Pieces hold every id once and sequences have no gap and no overflow."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    total = 0
    for i, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        total += len(ids)
        found = {r["start"]: r for r in pieces[i, len(ids)]}
        at = 0
        while at < len(ids):
            r = found[at]
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    assert total == sum(r["length"] for r in rows)
    return len(sequences), total


def test_every_id_lies_in_one_piece(docs, corpus, tokenizer):
    for capacity in (4096, 64):
        rows = packing.packed(docs, PATH, capacity).collect()
        texts = [(row[0], row[1]) for row in corpus]
        number, total = check(rows, texts, tokenizer, capacity)
        assert number <= 1.05 * total / capacity + 1


def test_ids_on_request(docs):
    for r in packing.packed(docs, PATH, 512, with_ids=True).collect():
        part = np.array(r["ids"], "<u4").tobytes()
        assert len(r["ids"]) == r["length"] and zlib.crc32(part) == r["ids_crc32"]


def test_differencing_gives_near_equal_windows():
    rng = random.Random(2)
    lengths = [rng.randint(1, 1000) for _ in range(300)]
    parts = packing.difference(lengths, 40)
    assert sorted(i for part in parts for i in part) == list(range(300))
    sums = [sum(lengths[i] for i in part) for part in parts]
    assert max(sums) - min(sums) < 0.1 * sum(lengths) / 40
    two = [sum([8, 7, 6, 5, 4][i] for i in part)
           for part in packing.difference([8, 7, 6, 5, 4], 2)]
    assert sorted(two) == [14, 16]  # the known result of the method


def test_window_count_rises_when_capacity_is_exceeded():
    parts = packing.windows_of([60] * 5, 100)
    assert len(parts) == 5
    assert packing.windows_of([1], 100) == [[0]]


def test_empty_table(no_docs):
    assert packing.packed(no_docs, PATH).count() == 0
