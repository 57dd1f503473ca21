import base64
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import alignment, queries
from tideline.llm.packing import byte_alphabet

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(BYTE)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECE)
BOTH = alignment.Tokenizers(BYTE, PIECE)
LETTERS = byte_alphabet()
ODD = st.text("ab é\n\t'sT0 9.,\0▁<|endoftext>한漢🙂!%s/  　\x1c\x85﻿")


def tokens(text):
    """Ids and bytes of both sides, from the libraries on the whole text; nothing where they do not spell it."""
    if not text:
        return [], []
    a = [(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def brute(text):
    """(n_a, n_b, groups text, links) with every pair of byte ranges compared."""
    a, b = tokens(text)
    spans = []
    for side in (a, b):
        ends = np.cumsum([len(x) for _, x in side]).tolist()
        spans.append([(i, e - len(x), e) for (i, x), e in zip(side, ends)])
    links = [(i, j) for i, s, e in spans[0] for j, x, y in spans[1] if s < y and x < e]
    cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
    groups = []
    for lo, hi in zip([0, *cuts], cuts):
        groups.append("|".join(",".join(str(i) for i, s, e in side if lo <= s and e <= hi) for side in spans))
    return len(a), len(b), ";".join(groups), len(groups), links


def clean(text):
    return text if text is None else text.encode("utf-8", "ignore").decode()


def found(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    out = [None] * len(texts)
    for rows, part in alignment.aligned_slices(BOTH, batch, 0):
        groups = part.groups()
        for k, row in enumerate(rows.tolist()):
            links = part.link_code[part.link_text == k].tolist()
            out[row] = (int(part.n_a[k]), int(part.n_b[k]), str(groups[k], "ascii"), int(part.n_groups[k]), sorted(divmod(c, len(BOTH.b_bytes)) for c in links))
            assert part.n_links[k] == len(links)
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(), ODD), max_size=5))
def test_links_and_groups_match_all_pairs_of_tokens(texts):
    texts = [clean(t) for t in texts]
    want = [brute(t) for t in texts]
    assert found(texts) == [(*w[:4], sorted(w[4])) for w in want]


def test_every_letter_is_encoded_as_the_libraries_do():
    for low in range(0, 0x30000, 512):
        letters = [chr(c) for c in range(low, low + 512) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}1{c} {c}.{c}\n{c} {c}b" for c in letters)
        if text:
            assert BOTH.a.encode_ordinary(" " + text) == A.encode(" " + text, add_special_tokens=False).ids


def test_vocabularies_are_the_public_ones():
    ranks = dict(map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")))
    assert [base64.b64decode(t) for t in sorted(ranks, key=lambda t: int(ranks[t]))] == [t for t in BOTH.a_bytes.to_pylist()[: len(ranks)]]
    assert alignment.PATTERN == public_tokenizers.PATTERN and BOTH.separable


def test_long_documents_run_in_lanes(monkeypatch):
    rng = np.random.default_rng(2)
    words = ["straße", "the", "ing", "été", "x" * 30, "12345", "한국", "…", "under_score", "naïveté"]
    texts = [" ".join(rng.choice(words, n)) for n in (3000, 1, 700, 0, 2500)] + ["y" * 4000]
    want = []
    for t in texts:
        a, b = tokens(t)
        end_a, end_b = np.cumsum([len(x) for _, x in a]).astype(int), np.cumsum([len(x) for _, x in b]).astype(int)
        cuts = sorted(set(end_a.tolist()) & set(end_b.tolist()))
        groups, at_a, at_b = [], 0, 0
        for c in cuts:
            x, y = int(np.searchsorted(end_a, c)) + 1, int(np.searchsorted(end_b, c)) + 1
            groups.append(",".join(str(i) for i, _ in a[at_a:x]) + "|" + ",".join(str(i) for i, _ in b[at_b:y]))
            at_a, at_b = x, y
        want.append((len(a), len(b), ";".join(groups), len(cuts)))
    whole = found(texts)
    assert [w[:4] for w in whole] == want
    # Every overlap is one link: there are as many as token ends, less the common ones.
    assert [len(w[4]) for w in whole] == [w[0] + w[1] - w[3] for w in want]
    monkeypatch.setattr(alignment, "LANE", 7)
    assert found(texts) == whole


def test_a_text_longer_than_a_slice_comes_in_parts(spark, make_docs, monkeypatch):
    text = " ".join(f"w{i % 97} été x{i}" for i in range(3000))
    docs = make_docs([(1, text), (2, text + " ▁"), (3, "short one"), (4, text.replace(" ", "\u00a0"))])
    small = alignment.align(docs, BYTE, PIECE).orderBy("doc_id").collect()
    both, parts = BOTH, []
    monkeypatch.setattr(alignment, "SLICE_BYTES", 1 << 10)
    batch = pa.RecordBatch.from_arrays([pa.array([text, text + " ▁"], pa.string())], ["text"])
    for k in range(2):
        got = list(alignment.aligned_slices(both, batch.slice(k, 1), 0))
        parts.append((len(got), ";".join(str(p.groups()[0], "ascii") for _, p in got)))
    assert parts[0][0] > 5 and parts[0][1] == small[0]["groups"] and parts[1] == (0, "")
    assert small[1]["n_a"] == 0 and small[1]["groups"] == "" and small[2]["n_a"] > 0
    assert small[3]["n_a"] == len(tokens(text.replace(" ", "\u00a0"))[0]) > 0


def scored(docs, heavy=alignment.HEAVY):
    counts = alignment.pair_counts(docs, BYTE, PIECE)
    return alignment.score(docs, counts, BYTE, PIECE, heavy=heavy)


def expected_rows(rows):
    per_doc = [(i, *brute(t)) for i, t in rows]
    counts = Counter(p for d in per_doc for p in d[5])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return sorted(
        (i or 0, a, b, g, len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else "")
        for i, a, b, text, g, links in per_doc
    )


@pytest.mark.parametrize("heavy", [0, 3, alignment.HEAVY])
def test_scores_match_brute_force_on_odd_rows(spark, make_docs, heavy):
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "no id here"), (4, "same row"), (4, "same row"), (5, "naïve ▁ text"), (6, "a  b\n\n  c d'll <|endoftext|> <s> 123456"), (7, "naïve text " * 60)]
    docs = make_docs(rows).withColumn("row", F.lit(1)).withColumn("pair", F.lit("x"))
    got = sorted((r[0] or 0, *r[1:]) for r in scored(docs, heavy).collect())
    assert got == expected_rows(rows)


def test_empty_table(make_docs):
    assert scored(make_docs([])).count() == 0


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, folder, "documents").collect()]
    out = queries.op13_alignment(spark, folder)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    ranges = {}
    for i, t in rows:
        a, b = tokens(t)
        ends = [np.cumsum([len(x) for _, x in side]).astype(int) if side else np.empty(0, int) for side in (a, b)]
        cuts = np.intersect1d(*ends)
        groups, links, at = [], [], [0, 0]
        for c in cuts:
            to = [int(np.searchsorted(e, c)) + 1 for e in ends]
            groups.append("|".join(",".join(str(k) for k, _ in side[x:y]) for side, x, y in zip((a, b), at, to)))
            for x in range(at[0], to[0]):
                for y in range(at[1], to[1]):
                    if ends[0][x] - len(a[x][1]) < ends[1][y] and ends[1][y] - len(b[y][1]) < ends[0][x]:
                        links.append((a[x][0], b[y][0]))
            at = to
        ranges[i] = (len(a), len(b), len(cuts), ";".join(groups), links)
    counts = Counter(p for r in ranges.values() for p in r[4])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    for i, (n_a, n_b, n_groups, text, links) in ranges.items():
        row = got[i]
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"]) == (n_a, n_b, n_groups, len(links))
        assert row["n_best"] == sum(counts[p] == top[p[1]] for p in links) and row["count_sum"] == sum(counts[p] for p in links)
        assert row["groups_sha256"] == (hashlib.sha256(text.encode()).hexdigest() if n_a else "")
