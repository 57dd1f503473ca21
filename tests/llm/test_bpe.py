import copy
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import bpe, queries
from tideline.llm.transducer import Transducer, compile_words

PATH = public_tokenizers.path("word_bpe_49k.json")
REFERENCE = Tokenizer.from_file(PATH)
MERGED = bpe.Encoder(PATH)
ODD = st.text("aeéßÀ'sT0 9.,\n\t\0İΣς<|endoftext>Ǻ  한漢🙂!%")


def expected(text):
    return REFERENCE.encode(text or "", add_special_tokens=False).ids


def clean(text):
    return text if text is None else text.encode("utf-8", "ignore").decode()


def encoded(encoder, texts):
    ids, offsets = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def lexicon_of(words):
    ids, counts = MERGED.words(pa.array(words, pa.string()))
    ends = np.cumsum(counts)
    return compile_words([(w.encode(), tuple(ids[b - n : b].tolist())) for w, b, n in zip(words, ends, counts)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(), ODD), max_size=5), st.sets(ODD.filter(lambda t: t and " " not in t and "\n" not in t), max_size=5))
def test_ids_are_those_of_the_tokenizer(texts, words):
    texts = [clean(t) for t in texts]
    whole = [expected(t) for t in texts]
    assert encoded(MERGED, texts) == whole
    with_lexicon = copy.copy(MERGED)
    with_lexicon.lexicon = Transducer(lexicon_of(sorted(words)))
    assert encoded(with_lexicon, texts + sorted(words)) == whole + [expected(w) for w in sorted(words)]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 3), max_size=4), max_size=30), st.lists(st.binary(max_size=7), max_size=10))
def test_transducer_knows_its_words_and_no_others(entries, others):
    machine = Transducer(compile_words([(w, tuple(ids)) for w, ids in entries.items()]))
    words = [*entries, *others]
    ends = np.cumsum([len(w) for w in words])
    known, ids, counts = machine.lookup(np.frombuffer(b"".join(words) + b"\0", np.uint8), ends - [len(w) for w in words], ends)
    assert known.tolist() == [w in entries for w in words]
    at = np.concatenate([[0], np.cumsum(counts)])
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [list(entries.get(w, [])) for w in words]


def test_states_are_shared_and_minimal():
    words = [p + s for p in (b"work", b"play", b"jump", b"walk") for s in (b"", b"s", b"ed", b"ing")]
    flat = compile_words([(w, (k,)) for k, w in enumerate(sorted(words))])
    # Endings with ids that differ by stem still share, as ids move to the arcs on which words part.
    plain = compile_words([(w, ()) for w in words])
    residuals = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in (w[:k] for k in range(len(w) + 1))}
    assert plain[0] == len(residuals)
    assert plain[0] <= flat[0] < sum(map(len, words))


def test_long_pieces_and_every_width():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("theandion"), n)) for n in (1, 2, 4, 5, 8, 9, 24, 25, 48, 49, 50, 300, 5000)]
    texts += ["!" * 4999, "é" * 700, "x1" * 400, "한" * 200]
    assert encoded(MERGED, texts) == [expected(t) for t in texts]


def test_counts_keep_what_is_frequent(make_docs):
    text = " ".join(["often"] * 50 + ["seen"] * 30 + [f"w{i}" for i in range(400)] + ["x" * 90] * 99)
    found = bpe.frequent_words(make_docs([(1, text), (2, None), (3, ""), (4, "often\nseen")]).repartition(3), words=8)
    assert found[:2] == ["often", "seen"] and len(found) <= 8
    assert bpe.frequent_words(make_docs([])) == []


@pytest.mark.parametrize("words", [0, 4, bpe.WORDS])
def test_whole_tables_round_trip(spark, odd_docs, words):
    docs = odd_docs.withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1))
    name = bpe.build_lexicon(docs, PATH, words=words) if words else None
    out = bpe.decode(bpe.encode(docs, PATH, name), PATH).collect()
    want = sorted((r["doc_id"] or 0, expected(r["text"]), REFERENCE.decode(expected(r["text"]), skip_special_tokens=False)) for r in odd_docs.collect())
    assert sorted((r["doc_id"] or 0, r["ids"], r["decoded"]) for r in out) == want


def test_empty_table(make_docs):
    name = bpe.build_lexicon(make_docs([]), PATH)
    assert bpe.decode(bpe.encode(make_docs([]), PATH, name), PATH).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.integers(-2, 49_500), max_size=6)), max_size=4))
def test_decoding_any_ids(spark, lists):
    frame = spark.createDataFrame([(k, ids) for k, ids in enumerate(lists)], "k int, ids array<int>")
    known = [None if ids is None else REFERENCE.decode([i for i in ids if i >= 0], skip_special_tokens=False) for ids in lists]
    assert [r["decoded"] for r in sorted(bpe.decode(frame, PATH).collect())] == known


def test_query_against_the_tokenizer(spark):
    folder = "/root/testdata/sf0.001"
    docs = queries.table(spark, folder, "documents").collect()
    out = {r["doc_id"]: r for r in queries.op12_bpe(spark, folder).collect()}
    assert len(out) == len(docs)
    for doc in docs:
        ids = expected(doc["text"])
        row = out[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(REFERENCE.decode(ids, skip_special_tokens=False).encode()).hexdigest()
