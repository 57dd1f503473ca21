import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tideline.llm import simhash
from tideline.llm.components import components


def brute_fingerprint(text, shingle=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    runs = [words[i : i + shingle] for i in range(len(words) - shingle + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > len(hashes))


def brute_classes(values, radius):
    root = list(range(len(values)))

    def up(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= radius:
            root[up(i)] = up(j)
    return [up(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "a b c", "a b c d a b c d", "É é  x y z w"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) & (1 << 64) - 1 == brute_fingerprint(text)


@pytest.mark.parametrize(("blocks", "tile"), [(2, 4096), (4, 8), (8, 4096)])
def test_links_connect_what_all_pairs_connect(spark, blocks, tile):
    rng = random.Random(blocks)
    values = {0, (1 << 64) - 1, 1, 3, 7}
    for _ in range(60):
        v = rng.getrandbits(64)
        for _ in range(rng.randrange(4)):
            values.add(v)
            v ^= 1 << rng.randrange(64)
            v ^= 1 << rng.randrange(64) if rng.random() < 0.5 else 0
        values.add(v)
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    found = components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2, blocks, tile)).collect()
    roots = {r["node"]: r["root"] for r in found}
    ours, theirs = {}, {}
    for v, s, c in zip(values, signed, brute_classes(values, 2)):
        ours.setdefault(roots.get(s, s), set()).add(v)
        theirs.setdefault(c, set()).add(v)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_near_duplicates_and_odd_rows(odd_docs, make_docs):
    docs = odd_docs.withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(1))
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == 7
    by_id = {r["doc_id"]: r for r in rows}
    assert {by_id[i]["component_id"] for i in (1, 2, 3)} == {1} and by_id[1]["fingerprint"] == "0" * 16
    assert by_id[4]["component_id"] == 4 and len(by_id[5]["fingerprint"]) == 16
    assert simhash.near_duplicates(make_docs([])).count() == 0


def test_keep_one_row_of_each_group(odd_docs, make_docs):
    docs = odd_docs.withColumn("fp", F.lit("x"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 5]
    assert simhash.keep_one(make_docs([])).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r["node"], r["root"]) for r in rows} == {(i, 1) for i in range(1, 61)} | {(k, 100) for k in range(100, 160)}
