import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, covered, seen, twice = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 8))
    for line in text.split("\n"):
        if WORD.search(line):
            twice += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), twice, len(covered)


def counted(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    judged = quality.judge(rows.withColumn("s", F.lit(1)).withColumn("bad", F.lit(2)), quality.DecisionList())
    found = {r["doc_id"]: r for r in judged.collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return [tuple(found[i][n] for n in names) for i in range(len(texts))], [found[i] for i in range(len(texts))]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "é#", "*|", "\n", "\t", " ", "a b c d e f g h", " ", "\x85"]), max_size=40).map(" ".join), min_size=1, max_size=20))
def test_statistics(spark, texts):
    assert counted(spark, texts)[0] == [brute(t) for t in texts]


def test_odd_texts(spark, odd_docs):
    texts = [None, "", " \n ", "x " * 50, " ".join(map(str, range(20_000))) * 2]
    numbers, rows = counted(spark, texts)
    assert numbers == [brute(t) for t in texts]
    assert [r["base_failed"] for r in rows] == [True, True, True, True, True]
    assert quality.judge(odd_docs.limit(0), quality.DecisionList()).count() == 0
    assert quality.keep_good(odd_docs, quality.DecisionList()).columns == odd_docs.columns


def test_learned_list_rejects_what_the_labels_reject(spark):
    def text(i):
        words = [f"w{i * 31 + k}" for k in range(40)]
        return " ".join(w + "***" if i % 4 == 0 else w for w in words)

    rows = [(i, text(i)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(0, 400, 2)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rules = quality.learn_from(docs, labels)
    assert rules.rules
    kept = {r["doc_id"] for r in quality.judge(docs, rules).filter("kept").collect()}
    assert kept == {i for i in range(400) if i % 4}
    assert {r["doc_id"] for r in quality.keep_good(docs, rules).collect()} == kept
    none = quality.learn_from(docs, labels.limit(0))
    assert none == quality.DecisionList()
