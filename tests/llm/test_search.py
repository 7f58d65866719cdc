"""Decontamination, ranked search and alignment against definitions."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from wardlake.llm import alignment as al
from wardlake.llm import ranked_search
from wardlake.llm.decontamination import contamination, phrase_matches, phrases_of
from wardlake.llm.postings import positional_index
from wardlake.llm.ranked_search import ranked
from wardlake.llm.search_queries import ORACLES
from wardlake.llm.shared import stored
from wardlake.llm.text import distinct_spans

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    text = text or ""
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


@pytest.fixture(scope="module")
def rows(corpus):
    """(item_id, text): passages of the corpus, short, null, repeated and odd items."""
    found = [(i, " ".join(terms(corpus[i][1])[5:40])) for i in range(0, 60, 6)]
    found += [(50, "The OF, and to!"), (51, "zzz qqq"), (52, None), (53, ""), (54, "?!")]
    found += [found[0], (None, " ".join(terms(corpus[6][1])[:12])), (70, found[1][1])]
    return found + [(71, "é" * 700), (72, "a b " * 30), (6, "the of in another text")]


@pytest.fixture(scope="module")
def items(spark, rows):
    more = tuple("z" for _ in range(4))
    return spark.createDataFrame(
        [(i, text, *more) for i, text in rows],
        "item_id long, text string, item string, terms string, phrase string, block string",
    )


@pytest.fixture(scope="module")
def no_items(items):
    return items.limit(0)


def contaminated(corpus, rows, words=10):
    phrases = defaultdict(set)
    for item, text in rows:
        found = terms(text)
        for at in range(max(1, len(found) - words + 1)) if found else ():
            phrases[tuple(found[at : at + words])].add(item)
    out = []
    for doc_id, text, *_ in corpus:
        found, hit, ids = terms(text), set(), set()
        for n in {len(p) for p in phrases}:
            for at in range(len(found) - n + 1):
                if (phrase := tuple(found[at : at + n])) in phrases:
                    hit.update(range(at, at + n))
                    ids |= phrases[phrase]
        names = sorted(str(i) for i in ids if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc_id, len(found), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def test_hit_words_and_items_follow_the_definition(docs, corpus, items, rows):
    for words in (10, 3):
        found = [tuple(r) for r in contamination(docs, items, words).collect()]
        assert sorted(found, key=str) == contaminated(corpus, rows, words)


def test_empty_sides(docs, no_docs, items, no_items):
    assert contamination(no_docs, items).count() == 0
    clean = contamination(docs, no_items).collect()
    assert len(clean) == docs.count() and not any(r["contaminated"] for r in clean)
    assert ranked(no_docs, items).count() == 0
    assert ranked(docs, no_items).count() == 0
    assert al.alignment(no_docs).count() == 0


def test_proximity_allows_words_a_few_places_off(spark):
    texts = ["a b c d", "a x b c d", "a x x b c d", "b a c d", "a b c", "d c b a", "c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = stored(positional_index(docs.coalesce(1)), "index")
    phrases = phrases_of(spark.createDataFrame([(1, "a b c d")], "item_id long, text string"))
    near = {}
    for slop in (0, 1, 2):
        found = phrase_matches(index, phrases.select("phrase"), slop).collect()
        near[slop] = {r["row"]: r["away"] for r in found}
    # Distances count from the rarest word: a leads, being first of three in six texts.
    assert near[0] == {0: 0}
    assert near[1] == {0: 0, 1: 1}
    assert near[2] == {0: 0, 1: 1, 2: 2, 3: 2}


def test_blocks_do_not_change_matches(docs, items):
    phrases = phrases_of(items).select("phrase")
    found = []
    for limit in (1 << 20, 2000):
        index = stored(positional_index(docs, limit), "index")
        matches = phrase_matches(index, phrases)
        found.append(Counter((r["phrase"], r["start"]) for r in matches.collect()))
    assert found[0] == found[1] and len(found[0]) > 100


def rankings(corpus, rows, k):
    lists = [(doc_id, terms(text)) for doc_id, text, *_ in corpus]
    n_docs = sum(1 for _, found in lists if found)
    total = sum(len(found) for _, found in lists)
    df = Counter(t for _, found in lists for t in set(found))
    out = []
    asked = {(item, tuple(sorted(set(terms(text))))) for item, text in rows}
    for item, query in asked:
        best = []
        for doc_id, found in lists:
            tf, m = Counter(found), 50 + 50 * len(found) * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
                for t in query
                if tf[t]
            )
            if score > 0:
                best.append((-score, doc_id is None, doc_id))
        best.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, x[2], -x[0]) for r, x in enumerate(best[:k])]
    return sorted(out, key=str)


def test_rankings_follow_the_definition(docs, corpus, items, rows, monkeypatch):
    for k, bundle, log in ((50, 256, 5), (3, 2, 0)):
        monkeypatch.setattr(ranked_search, "BUNDLE_ITEMS", bundle)
        monkeypatch.setattr(ranked_search, "SLICE_BLOCKS_LOG", log)
        found = [tuple(r) for r in ranked(docs, items, k).collect()]
        assert sorted(found, key=str) == rankings(corpus, rows, k)


def test_few_documents_are_carried_past_the_rare_terms(docs, items):
    """The floor lets documents go that cannot reach the best any more."""
    import wardlake.llm.ranked_search as module

    sizes = {}
    keep = module.stored

    def watched(df, name, **options):
        table = keep(df, name, **options)
        if name.startswith("stage_") and "docs" in table.columns:
            sizes[name] = table.selectExpr("sum(length(docs)) / 4").first()[0] or 0
        return table

    module.stored = watched
    try:
        best = ranked(docs, items, 2).count()
    finally:
        module.stored = keep
    every = docs.count() * ranked_search.query_items(items).count()
    assert best > 20 and sizes["stage_2"] < every / 2


@pytest.fixture(scope="module")
def pairs_expected(corpus):
    from tokenizers import Tokenizer
    import sentencepiece

    path_a, path_b = al.tokenizer_paths()
    whole = Tokenizer.from_file(path_a)
    whole.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
    alphabet = al._byte_alphabet()

    def walked(text):
        if not text:
            return None
        a, b = whole.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        left = [bytes(alphabet[c] for c in whole.id_to_token(i)) for i in a]
        right = [
            bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p)
            else p.replace("▁", " ").encode()
            for p in map(pieces.id_to_piece, b)
        ]
        plain = (" " + text).encode()
        if b"".join(left) != plain or b"".join(right) != plain:
            return None
        links, groups, one, two = [], [], [], []
        i = j = 0
        end_a, end_b = len(left[0]), len(right[0])
        while i < len(a):
            links.append((a[i], b[j]))
            if end_a <= end_b:
                one.append(str(a[i]))
            if end_b <= end_a:
                two.append(str(b[j]))
            if end_a == end_b:
                groups.append(",".join(one) + "|" + ",".join(two))
                one, two = [], []
            step_a, step_b = end_a <= end_b, end_b <= end_a
            if step_a:
                i += 1
                end_a += len(left[i]) if i < len(a) else 0
            if step_b:
                j += 1
                end_b += len(right[j]) if j < len(b) else 0
        return len(a), len(b), groups, links

    def figures(texts):
        found = [walked(text) for text in texts]
        count = Counter(link for one in found if one for link in set(one[3]))
        best = defaultdict(int)
        for (a, _), n in count.items():
            best[a] = max(best[a], n)
        out = []
        for one in found:
            if one is None:
                out.append((0, 0, 0, 0, "", 0, 0))
                continue
            n_a, n_b, groups, links = one
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            out.append(
                (n_a, n_b, len(groups), len(links), digest,
                 sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links))
            )
        return out

    return figures


ODD = [
    "İstanbul ΣΑΣ, don't I'll  x\x1cy\x85z é <|endoftext|>a\n\n\t b </s> <s>", "a　b 日本語 ▁x",
    "🙂🙂 naïve – ‘q’\r\n  12345", "x" * 3000, "‍́", "a\x00b", " ", "\n",
]


def test_alignment_follows_the_definition(spark, docs, corpus, pairs_expected):
    odd = spark.createDataFrame(
        [(1000 + i, text) for i, text in enumerate(ODD)], "doc_id long, text string"
    )
    both = docs.select("doc_id", "text").union(odd).repartition(5)
    texts = [(row[0], row[1]) for row in corpus] + [(1000 + i, t) for i, t in enumerate(ODD)]
    expected = [(i, *x) for (i, _), x in zip(texts, pairs_expected([t for _, t in texts]), strict=True)]
    columns = "doc_id n_a n_b n_groups n_links groups_sha256 n_best count_sum".split()
    found = [tuple(r) for r in al.alignment(both).select(columns).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_small_blocks_give_the_same_counts(docs, monkeypatch):
    whole = sorted(al.alignment(docs).collect(), key=str)
    make = al.aligned_blocks
    monkeypatch.setattr(al, "aligned_blocks", lambda d, p: make(d, p, 300, 900))
    assert sorted(al.alignment(docs).collect(), key=str) == whole


def test_pointers_reach_the_last_token_of_a_component():
    rng = np.random.default_rng(3)
    for _ in range(50):
        cuts = [np.unique(np.append(rng.integers(1, 60, 25), 60)) for _ in range(2)]
        places = []
        for ends in cuts:
            places += [np.concatenate(([0], ends[:-1])), ends]
        left, right = al.terminal_labels(*places)
        both = np.intersect1d(*cuts)
        for ends, label in ((cuts[0], left), (cuts[1], right)):
            assert (cuts[0][label] == both[np.searchsorted(both, ends)]).all()


def test_spans_of_one_key_and_other_bytes_are_told_apart():
    data = np.frombuffer(b"ab" * 3 + b"cd" + b"x" * 70 + b"y" * 70 + b"x" * 70, np.uint8)
    starts = np.array([0, 2, 4, 6, 8, 78, 148, 0])
    ends = np.array([2, 4, 6, 8, 78, 148, 218, 0])
    for keys in (None, np.zeros(8, np.uint64)):
        which, sample = distinct_spans(data, starts, ends, keys)
        texts = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        assert len(sample) == len(set(texts))
        assert [texts[sample[k]] for k in which] == texts


def test_queries_equal_their_sql(spark, docs, items):
    from wardlake.llm import search_queries

    source = {"documents": docs.toPandas(), "benchmark": items.toPandas()}
    for table in source.values():
        for name in ("doc_id", "item_id"):
            if name in table:
                table[name] = table[name].astype("Int64")
    found = {
        "op11_decontamination": contamination(docs, items),
        "op12_ranked_search": ranked(docs, items),
    }
    assert set(found) == set(ORACLES) <= set(search_queries.QUERIES)
    with duckdb.connect() as db:
        for name, table in source.items():
            db.register(name, table)
        for name, frame in found.items():
            expected = db.sql(ORACLES[name])
            order = [expected.columns.index(c) for c in frame.columns]
            rows = [tuple(r[i] for i in order) for r in expected.fetchall()]
            assert sorted(map(tuple, frame.collect()), key=str) == sorted(rows, key=str)
