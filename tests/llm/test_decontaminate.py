import random

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.llm import decontaminate as dc
from tideline.llm.words import Words


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


@given(st.lists(st.integers(0, 4), max_size=30), st.lists(st.integers(0, 4), min_size=1, max_size=30))
def test_common_length(a, b):
    import numpy as np

    assert dc.common_length(np.array(a, np.uint64), np.array(b, np.uint64)) == common(a, b)


@given(st.lists(st.text("abÉé0 .,\n", max_size=30), min_size=1, max_size=6))
def test_words(texts):
    import re

    words = Words(pa.array(texts))
    expected = [re.findall(r"[a-z0-9é]+", t.lower()) for t in texts]
    got = [bytes(words.bytes[a:b]).decode() for a, b in zip(words.start, words.end)]
    assert got == [w for own in expected for w in own]
    assert len(set(words.hashes().tolist())) == len(set(got))
    assert list(words.offsets) == [sum(map(len, expected[:k])) for k in range(len(texts) + 1)]


@pytest.fixture(scope="module")
def corpus(spark, make_docs):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(4000)]

    def prose(n):
        return " ".join(rng.choice(vocabulary[:40] if rng.random() < 0.5 else vocabulary) for _ in range(n))

    items = [(i, f"{prose(rng.randint(12, 40)).capitalize()}. {prose(8).capitalize()}.") for i in range(30)] + [(90, None), (None, "x y z"), (91, "")]
    rows, leaks = [], set()
    for d in range(240):
        text = prose(rng.randint(30, 300))
        if d % 8 == 0:
            item, body = items[d // 8]
            words = body.upper().split()
            if d % 16 == 0:
                # A paraphrase: every seventh word is another one.
                words = [rng.choice(vocabulary) if k % 7 == 3 else w for k, w in enumerate(words)]
            text = f"{prose(35)} {' '.join(words)} {prose(50)}"
            leaks.add((d, item))
        rows.append((d, text))
    rows += [(1000, None), (1001, ""), (1002, items[0][1]), (1002, items[0][1])]
    leaks.add((1002, 0))
    return make_docs(rows), spark.createDataFrame(items, "item_id long, text string"), leaks


def test_leaks_are_found_and_clean_documents_left(corpus):
    docs, benchmark, leaks = corpus
    index = dc.build_index(docs, benchmark)
    found = {(r["doc_id"], r["item_id"]) for r in dc.search(docs, index).collect()}
    assert len(leaks & found) >= 0.9 * len(leaks) and {(d, i) for d, i in leaks if d % 16} <= found
    assert not found - leaks
    kept = dc.remove(docs, index)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - {d for d, _ in found}


def test_empty_tables(corpus):
    docs, benchmark, _ = corpus
    nothing = dc.build_index(docs, benchmark.limit(0))
    assert dc.search(docs, nothing).count() == 0 and dc.remove(docs, nothing).count() == docs.count()
    assert dc.search(docs.limit(0), dc.build_index(docs.limit(0), benchmark)).count() == 0


def made_up(rng, n_words):
    """A vocabulary, and prose of which half the words are common ones."""
    vocabulary = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(n_words)]
    return vocabulary, lambda n: " ".join(rng.choice(vocabulary[:40] if rng.random() < 0.5 else vocabulary) for _ in range(n))


@pytest.mark.parametrize("whole", [False, True])
def test_passage_in_a_third_of_all_rows_is_found(spark, make_docs, whole):
    rng = random.Random(11)
    _, prose = made_up(rng, 4000)
    items = [(i, f"{prose(24)}. {prose(8)}.") for i in range(10)]
    host = prose(60)
    rows, leaks = [], set()
    for d in range(240):
        text = prose(rng.randint(60, 200))
        if d % 3 == 0:
            text = f"{host if whole else prose(30)} {items[4][1]} {host if whole else prose(30)}"
            leaks.add((d, 4))
        elif d % 40 == 1:
            text = f"{text} {items[7][1]}"
            leaks.add((d, 7))
        rows.append((d, text))
    docs = make_docs(rows)
    index = dc.build_index(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in dc.search(docs, index).collect()} == leaks
    assert {r["doc_id"] for r in dc.remove(docs, index).collect()} == set(range(240)) - {d for d, _ in leaks}


def test_recall_does_not_fall_with_the_benchmark(spark, make_docs):
    rng = random.Random(13)
    vocabulary, prose = made_up(rng, 20_000)
    items = [(i, f"{prose(rng.randint(15, 50))}. {prose(8)}.") for i in range(5_000)]
    rows, leaks = [], set()
    for d in range(200):
        words = items[d * 25][1].split()
        if d % 2:
            # A paraphrase: every seventh word is another one.
            words = [rng.choice(vocabulary) if k % 7 == 3 else w for k, w in enumerate(words)]
        rows.append((d, f"{prose(rng.randint(40, 150))} {' '.join(words)} {prose(60)}"))
        leaks.add((d, d * 25))
    docs = make_docs(rows + [(d, prose(200)) for d in range(1000, 1050)])
    index = dc.build_index(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in dc.search(docs, index).collect()} == leaks


def test_the_latent_space_covers_all_documents(spark, make_docs):
    """The words of documents that come last by the hash of their ids are in it, too"""
    rng = random.Random(17)
    ids = [r["id"] for r in spark.range(1300).orderBy(F.xxhash64("id")).collect()]

    def topic(sign, n):
        words = [f"{sign}{k}" for k in range(n)]
        return words, lambda: " ".join(rng.choice(words) for _ in range(64))

    (first, early), (last, late) = topic("a", 2400), topic("z", 600)
    docs = make_docs([(d, early() if k < 1000 else late()) for k, d in enumerate(ids)])
    index = dc.build_index(docs, spark.createDataFrame([(1, "one item here. its answer")], "item_id long, text string"))
    assert (index.row_of[dc.bucket(Words(pa.array([" ".join(first)])).hashes())] >= 0).mean() > 0.5
    assert (index.row_of[dc.bucket(Words(pa.array([" ".join(last)])).hashes())] >= 0).mean() > 0.5


def test_basis_equals_a_singular_value_decomposition(spark):
    """Over several tasks and rounds: the products of passages of up to `size` words, weighed and of unit length."""
    import numpy as np

    rng = random.Random(19)
    texts = [" ".join(f"{'xyz'[d % 3]}{min(rng.randrange(12), rng.randrange(12))}" for _ in range(rng.randint(0, 150))) for d in range(60)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    shares, n = dc.document_shares(docs)
    assert n == 62 and shares.sum() == sum(len(set((t or "").split())) for t in texts)
    idf = dc.positive_weights(shares, n)
    places, items = dc.vocabulary(["x0 y1 new"], shares, idf), ["x0 y1 new", ""]
    basis = dc.latent_basis(docs, items, idf, places, 0.5, rank=3, rounds=6)
    rows = []
    for weight, own in [(0.5**0.5, texts), (dc.ITEM_WEIGHT, items)]:
        for words in [(t or "").split() for t in own]:
            for at in range(0, len(words), dc.FIT_WORDS):
                row = np.zeros(int(places.max()) + 1)
                for term in dc.bucket(Words(pa.array([" ".join(words[at : at + dc.FIT_WORDS])])).hashes()):
                    row[places[term]] += idf[term]
                norm = np.sqrt(sum(idf[t] ** 2 for t in dc.bucket(Words(pa.array([" ".join(words[at : at + dc.FIT_WORDS])])).hashes())))
                rows.append(weight * row / norm)
    expected = np.linalg.svd(np.array(rows))[2][:3].T
    assert np.abs(np.abs((basis * expected).sum(axis=0)) - 1).max() < 1e-3


@given(st.lists(st.lists(st.integers(0, 30), max_size=60), min_size=1, max_size=4), st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=12), min_size=1, max_size=5), st.integers(1, 40))
def test_exact_windows_hold_every_passage(texts, items, pairs):
    import numpy as np

    words = Words(pa.array([" ".join(f"w{k}" for k in t) for t in texts]))
    bodies = [Words(pa.array([" ".join(f"w{k}" for k in i)])).hashes() for i in items]
    weight = np.linspace(1, 9, dc.BUCKETS).astype(np.float32)
    index = dc.Index(weight, weight, np.empty((0, 1)), np.empty(0), list(range(len(items))), bodies, bodies, np.empty((0, 1)), [])
    before, dc.PAIRS = dc.PAIRS, pairs
    try:
        got = list(dc.exact_candidates(words, dc.Keys.build(index, 0.6)))
    finally:
        dc.PAIRS = before
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            for a in range(len(text)):
                if common(text[a : a + 2 * len(item)], item) >= 0.6 * len(item):
                    lo = int(words.offsets[t]) + a
                    hi = min(lo + 2 * len(item), int(words.offsets[t + 1]))
                    held = [(x, y) for u, j, x, y in got if (u, j) == (t, i)]
                    # The passage itself, from its first to its last common word, lies in one window.
                    assert any(common([k for k in words.hashes()[max(lo, x) : min(hi, y)]], list(bodies[i])) >= 0.6 * len(item) for x, y in held)
