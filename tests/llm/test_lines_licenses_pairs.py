import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.compare import database, differences
from tideline.llm import license_texts, licenses, line_dedup, preference
from tideline.llm.queries import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_their_sql(spark, name):
    ours, theirs, apart, kinds = differences(spark, database(SF), name, SF)
    assert ours == theirs > 0 and not apart, (apart, kinds)


def brute_dedup(rows):
    """Per row (kept text, offsets, removed words, longest run): every line and paragraph looked up among all earlier ones."""
    units, docs = [], []
    for d, (_, text) in enumerate(rows):
        parts = (text or "").split("\n")
        norms = [" ".join("".join(c if c.isalnum() else " " for c in p.lower()).split()) for p in parts]
        held = [k for k, n in enumerate(norms) if n]
        spans = [(k, k) for k in held]
        start = None
        for k, n in enumerate([*norms, ""]):
            if n and start is None:
                start = k
            elif not n and start is not None:
                if k - start > 1:
                    spans.append((start, k - 1))
                start = None
        units += [(" ".join(norms[a : b + 1]), d, a, b) for a, b in spans]
        docs.append((parts, norms, held))
    gone = [set() for _ in rows]
    for text, d, a, b in units:
        if any(t == text and (x, y) < (d, a) for t, x, y, _ in units):
            gone[d].update(range(a, b + 1))
    out = []
    for (parts, norms, held), lost in zip(docs, gone):
        at, spans, run, longest = 0, [], 0, 0
        for k, part in enumerate(parts):
            if k in lost:
                spans.append((at, at + len(part)))
            at += len(part) + 1
        for k in held:
            run = run + len(norms[k].split()) if k in lost else 0
            longest = max(longest, run)
        out.append(("\n".join(p for k, p in enumerate(parts) if k not in lost), spans, sum(len(norms[k].split()) for k in lost), longest))
    return out


def check_dedup(make_docs, rows):
    docs = make_docs(rows).withColumn("row", F.lit(1)).withColumn("parts", F.lit(1)).withColumn("first", F.lit("x"))
    out = {r["doc_id"]: r for r in line_dedup.dedup(docs).collect()}
    for (doc_id, text), (kept, gone, words, longest) in zip(rows, brute_dedup(rows)):
        assert (out[doc_id]["text"] or "") == kept and [(r["start"], r["end"]) for r in out[doc_id]["removed"]] == gone
        assert (out[doc_id]["n_removed"], out[doc_id]["n_removed_words"], out[doc_id]["longest_run"]) == (len(gone), words, longest)
    return out


def test_repeated_lines_and_paragraphs_go_with_their_offsets(make_docs):
    line = "The quick brown fox, again."
    rows = [
        (1, "\n".join([line, "short", "é a unit of its own"])),
        (2, "\n".join(["short", line.upper(), "new words come here now", line])),
        (3, None),
        (4, ""),
        (5, line),
        (6, "one two\nthree four\n\nlast words"),
        (7, "\n--\none two three\nfour\n * \nlast words\n\nshort\nfresh"),
        (8, "one two three four"),
    ]
    out = check_dedup(make_docs, rows)
    assert out[3]["text"] is None and out[7]["longest_run"] == 7 and out[7]["text"] == "\n--\n * \n\nfresh" and out[8]["n_removed"] == 1


@settings(max_examples=15)
@given(st.lists(st.lists(st.sampled_from(["a", "A b", "b", "b c", "", "-", "c", "a b c"]), max_size=6), min_size=1, max_size=5))
def test_any_lines(make_docs, texts):
    check_dedup(make_docs, [(i, "\n".join(t)) for i, t in enumerate(texts)])


def test_repeated_rows_keep_one_text(odd_docs, make_docs):
    rows = line_dedup.dedup(make_docs([(7, "one two three four"), (7, "one two three four"), (None, "one two three four")])).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in rows) == [(0, 1), (7, 0), (7, 1)]
    assert line_dedup.dedup(odd_docs).count() == 7 and line_dedup.dedup(make_docs([])).count() == 0
    few = line_dedup.dedup(make_docs([(1, "one two"), (2, "one two"), (3, "a b c"), (4, "a b c")]), least_words=3).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in few) == [(1, 0), (2, 0), (3, 0), (4, 1)]


def test_licenses_in_other_spelling_and_layout(spark, make_docs):
    mit = license_texts.KNOWN[0][1]
    changed = "Copyright (c) 2031 Somebody\n\n" + mit.replace("sublicense", "sublicence").replace(" ", "\n   ").upper() + "\n(c) all of them\n"
    rows = [(1, mit), (2, changed), (3, mit + " and more"), (4, None), (5, ""), (6, "licence licence labour labour"), (7, "License license labor  labor!")]
    out = {r["doc_id"]: r for r in licenses.scan(make_docs(rows).withColumn("license_id", F.lit("x")), licenses.known_digests(spark)).collect()}
    assert [out[i]["license_id"] for i in range(1, 6)] == ["MIT", "MIT", None, None, None]
    assert out[4]["digest"] == out[5]["digest"] and out[6]["digest"] == out[7]["digest"]
    assert licenses.scan(make_docs([]), licenses.known_digests(spark)).count() == 0


def turns(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, turn long, role string, text string")


def test_common_prefix_is_the_prompt(spark):
    start = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "q2")]
    chosen = turns(spark, start + [(1, 3, "assistant", "good"), (2, 0, "user", None), (3, 0, None, "x"), (None, 0, "user", "x")])
    rejected = turns(spark, start + start[:1] + [(1, 3, "assistant", "bad"), (1, 4, "user", "q2"), (2, 0, "user", None), (None, 0, "user", "x")])
    rows = preference.format_pairs(chosen.withColumn("part", F.lit(1)), rejected).collect()
    parts = {}
    for r in rows:
        parts.setdefault((r["pair_id"], r["part"]), []).append((r["turn"], r["rendered"][r["loss_start"] : r["loss_end"]]))
    assert {k: sorted(v) for k, v in parts.items()} == {
        (1, "prompt"): [(0, ""), (1, ""), (2, "")],
        (1, "chosen"): [(3, "good<|end|>\n")],
        (1, "rejected"): [(3, "bad<|end|>\n"), (4, "")],
        (2, "prompt"): [(0, "")],
        (3, "chosen"): [(0, "")],
    }
    whole = {r["pair_id"]: r for r in preference.assemble(preference.format_pairs(chosen, rejected)).collect()}
    assert whole[1]["prompt"] == "<|user|>\nq<|end|>\n<|assistant|>\na<|end|>\n<|user|>\nq2<|end|>\n"
    assert whole[1]["chosen"] == "<|assistant|>\ngood<|end|>\n" and whole[3]["rejected"] == ""
    assert preference.format_pairs(chosen.limit(0), rejected.limit(0)).count() == 0


def test_assembled_completions_keep_their_masks(spark):
    """Every size, against joining by hand: pieces joined are the parts, spans hold what the segments train on."""
    rng = random.Random(5)
    start = [(p, t, rng.choice(["user", "assistant", None]), rng.choice(["", None, "wörd " * rng.randrange(9)])) for p in range(6) for t in range(3)]
    ends = [[(p, 3 + t, rng.choice(["user", "assistant"]), f"{side} {t}") for p in range(5) for t in range(rng.randrange(9))] for side in "cr"]
    far = [(9, t, "assistant", f"far {t}") for t in (None, -5, 4095, 4096, 90_000)]
    segments = preference.format_pairs(turns(spark, start + ends[0] + far), turns(spark, start + ends[1]))
    texts, trained = {}, {}
    nulls_first = lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["rendered"])
    for r in sorted(segments.collect(), key=nulls_first):
        key = (r["pair_id"], r["part"])
        texts[key] = texts.get(key, "") + r["rendered"]
        if r["loss_start"] < r["loss_end"]:
            trained.setdefault(key, []).append(r["rendered"][r["loss_start"] : r["loss_end"]])
    for size in (1, 40, 1_000_000):
        rows = sorted(preference.assemble(segments, size).collect(), key=lambda r: (r["pair_id"], r["piece"]))
        got, spans = {}, {}
        for r in rows:
            for part in ("prompt", "chosen", "rejected"):
                if r[part]:
                    got[r["pair_id"], part] = got.get((r["pair_id"], part), "") + r[part]
            for part in ("chosen", "rejected"):
                for span in r[f"{part}_loss"]:
                    spans.setdefault((r["pair_id"], part), []).append(r[part][span["start"] : span["end"]])
        assert got == texts and spans == trained
        assert size > 1 or len(rows) > len({r["pair_id"] for r in rows})
    assert {r["piece"] for r in rows} == {0} and len(rows) == 7
    assert preference.assemble(segments.limit(0)).count() == 0
