"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme-value statistics."""

from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.shared import slices, written
from tideline.llm.words import Table, Words

# Labelled documents from which the log-odds are learned, at most, and terms the model holds, at most.
LABELLED_ROWS, MAX_TERMS = 20_000, 50_000
# A term is a word or its first bytes, so that a stem is learned from all its forms.
STEMS = (4, 5, 6, 7, 8)
# Z-score and log-odds a term needs, weight of the prior per token of a side, what every token costs, and the most it scores.
LEAST_Z, LEAST_ODDS, PRIOR, COST, TOP = 3.0, 1.0, 0.05, 0.15, 4.0
LEAST_LINES = 3
# Segments below this score are not reported.
LEAST_SEGMENT = 1.0
HISTOGRAM = 400


def terms(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all terms: whole words first, then stems of words that are longer than the stem. With each, the words."""
    size = words.end - words.start
    out = [(words.hashes(), np.arange(len(words)))]
    for n in STEMS:
        longer = np.flatnonzero(size > n)
        start = words.start[longer]
        # A stem is not a word: its hash is marked.
        out.append((words.hashes(start, start + n) ^ np.uint64(0xA5A5A5A5A5A5A5A5), longer))
    return out


@dataclass
class Lexicon:
    """Terms by ascending hash, and the log-odds score of each."""

    hashes: np.ndarray
    scores: np.ndarray

    def token_scores(self, words: Words, table: Table) -> tuple[np.ndarray, np.ndarray]:
        """The words with a score, ascending, and the score: that of their term with the largest one in size."""
        best = np.zeros(len(words))
        for hashes, of in terms(words):
            at, rank = table.find(hashes)
            at, score = of[at], self.scores[rank]
            best[at] = np.where(np.abs(score) > np.abs(best[at]), score, best[at])
        at = np.flatnonzero(best)
        return at, best[at]


def segments(at: list[int], score: list[float], cost: float = COST) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first word, last word) of one text, in one pass.

    Words without a score cost `cost` each, as do the others. The list holds candidate segments with the
    sums before and after each; a new one is merged with those it extends to a higher sum.
    """
    found: list[list] = []  # [sum before, sum after, first, last, nearest earlier candidate that begins lower]
    total, last = 0.0, -1
    for i, s in zip(at, score):
        total -= cost * (i - last - 1)
        last = i
        s -= cost
        before, total = total, total + s
        if s <= 0:
            continue
        new = [before, total, i, i, -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= new[0]:
                j = found[j][4]
            if j < 0 or found[j][1] >= new[1]:
                break
            new = [found[j][0], new[1], found[j][2], new[3], -1]
            del found[j:]
        new[4] = j
        found.append(new)
    return [(right - left, a, b) for left, right, a, b, _ in found]


def labelled_sample(labels: DataFrame, doc_id: str = "doc_id", rows: int = LABELLED_ROWS) -> DataFrame:
    """At most `rows` labelled ids outside the held-out fold, by the order of a hash of the id; one row per id."""
    own = labels.select(F.col(doc_id).alias("doc_id"), F.col("toxic")).dropna().filter(~held_out(F.col("doc_id")))
    return own.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def held_out(doc_id: Column) -> Column:
    """True where the checksum of the id as text leaves no remainder by five; rows without an id are not held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def _log_odds(toxic: np.ndarray, other: np.ndarray, n_toxic: float, n_other: float, share: np.ndarray):
    """Log-odds ratio with a Dirichlet prior, and its z-score.

    Either side gets prior counts in proportion to its size, so without evidence the ratio is one."""
    a, b = toxic + PRIOR * n_toxic * share, other + PRIOR * n_other * share
    delta = np.log(a / ((1 + PRIOR) * n_toxic - a)) - np.log(b / ((1 + PRIOR) * n_other - b))
    return delta, delta / np.sqrt(1 / a + 1 / b)


def _count(batches: Iterator[pa.RecordBatch], table: Table | None) -> Iterator[pa.RecordBatch]:
    """Partial counts per term and slice of texts; term 0 has the number of all words.

    With a table: occurrences of its terms. Without: lines (column 0) that have the term, in all and by the
    label in column 1, so that a word repeated within a line counts once."""
    names = ["term", "tokens", "toxic", "other"]
    for batch in batches:
        for part in slices(batch, 0):
            words = Words(part.column(0))
            label = np.zeros(len(part)) if table is not None else part.column(1).to_numpy().astype(float)
            of_word = words.text_of_word()
            total, hit = float(len(words)), float(label[of_word].sum())
            columns = [[np.zeros(1, np.uint64)], [np.array([total])], [np.array([hit])], [np.array([total - hit])]]
            for hashes, of in terms(words):
                if table is not None:
                    at, _ = table.find(hashes)
                    hashes, of = hashes[at], of[at]
                own, place = np.unique(hashes, return_inverse=True)
                if table is None:
                    pairs = np.unique(place * np.int64(len(part)) + of_word[of])
                    place, in_toxic = pairs // len(part), label[pairs % len(part)]
                    toxic = np.bincount(place, in_toxic, len(own))
                else:
                    toxic = np.zeros(len(own))
                tokens = np.bincount(place, minlength=len(own)).astype(float)
                for column, values in zip(columns, (own, tokens, toxic, tokens - toxic)):
                    column.append(values)
            arrays = [np.concatenate(c) for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(arrays[0].view(np.int64)), *map(pa.array, arrays[1:])], names)


COUNTS = "term long, tokens double, toxic double, other double"


def learn_terms(docs: DataFrame, sample: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Lexicon:
    """Log-odds of the terms of the labelled documents, under a prior from the counts of all documents.

    Candidates are the terms of the sample that occur in LEAST_LINES different lines of toxic documents and lean to them; their
    counts over the whole corpus, in proportion, are the prior. Terms with a z-score of LEAST_Z and log-odds of LEAST_ODDS stay, the
    MAX_TERMS strongest. A sample without both labels gives no terms.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id")
    # Copies and repeated passages would make any of their words look toxic: each line counts once per label.
    lines = own.select("toxic", F.explode(F.split("text", "\n", -1)).alias("text")).distinct()
    partial = lines.select("text", "toxic").mapInArrow(lambda batches: _count(batches, None), COUNTS)
    sums = [F.sum(c).alias(c) for c in ("tokens", "toxic", "other")]
    counted = written(partial.groupBy("term").agg(*sums), "terms")
    total = counted.filter("term = 0").first()
    if total is None or not total["toxic"] or not total["other"]:
        return Lexicon(np.empty(0, np.uint64), np.empty(0))
    leaning = F.col("toxic") * total["other"] / (F.col("other") + 0.5) / total["toxic"]
    some = counted.filter((F.col("term") != 0) & (F.col("toxic") >= LEAST_LINES) & (leaning > 1.5))
    some = some.orderBy(F.desc(F.col("toxic") * F.log(leaning)), "term").limit(4 * MAX_TERMS).toPandas().sort_values("term")
    hashes = some["term"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes, some = hashes[order], some.iloc[order]
    table = Table(hashes)
    everywhere = docs.select(text).mapInArrow(lambda batches: _count(batches, table), COUNTS)
    corpus = everywhere.groupBy("term").agg(F.sum("tokens").alias("tokens")).toPandas()
    at = corpus["term"].to_numpy().astype(np.int64).view(np.uint64)
    all_tokens = float(corpus["tokens"][at == 0].sum())
    counts = dict(zip(at.tolist(), corpus["tokens"]))
    share = np.array([counts.get(h, 1.0) for h in hashes.tolist()]) / max(all_tokens, 1.0)
    delta, z = _log_odds(some["toxic"].to_numpy(), some["other"].to_numpy(), total["toxic"], total["other"], share)
    strong = np.flatnonzero((z >= LEAST_Z) & (delta >= LEAST_ODDS))
    strong = np.sort(strong[np.argsort(-z[strong], kind="stable")[:MAX_TERMS]])
    return Lexicon(hashes[strong], np.minimum(delta[strong], TOP))


@dataclass(frozen=True)
class Calibration:
    """Gumbel law of the best segment in documents that are not toxic: location at one word, its growth with the
    logarithm of the number of words, and scale; and the logistic that turns the evidence into a score."""

    location: float = 0.0
    growth: float = 0.0
    scale: float = 1.0
    slope: float = 1.0
    bias: float = -3.0

    def evidence(self, best: Column, n_words: Column) -> Column:
        """Minus the logarithm of the probability that a document of this length without toxic passages has a
        segment so good. Documents without a segment have no evidence."""
        tail = F.exp(-(best - self.location - self.growth * _log(n_words)) / self.scale)
        # 1 - exp(-tail) is tail itself where it is small.
        p = F.when(tail < 1e-6, tail).otherwise(-F.expm1(-tail))
        return F.when(best > 0, -F.log(F.greatest(p, F.lit(1e-300)))).otherwise(0.0)

    def score(self, best: Column, n_words: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.slope) * self.evidence(best, n_words) + F.lit(self.bias))))


def _log(n_words: Column) -> Column:
    return F.log(F.greatest(n_words, F.lit(1)).cast("double"))


def calibrate(scored: DataFrame) -> Calibration:
    """Fit the calibration to rows (best, n_words, toxic).

    From the rows that are not toxic come the growth, by least squares on scores cut at their 99th
    percentile, and location and scale, from two upper percentiles of what is left, so that a few odd
    documents do not stretch the law. The logistic is fitted to a histogram of the evidence, by Newton steps.
    """
    clean = scored.filter("toxic = 0").select("best", _log(F.col("n_words")).alias("log_n"))
    top = clean.agg(F.percentile("best", 0.99)).first()[0]
    if top is None:
        return Calibration()
    low = F.least("best", F.lit(top))
    row = clean.agg(F.covar_pop(low, "log_n").alias("c"), F.var_pop("log_n").alias("v")).first()
    growth = max(0.0, row["c"] / row["v"]) if row["v"] else 0.0
    q90, q99 = clean.agg(F.percentile(F.col("best") - growth * F.col("log_n"), [0.9, 0.99])).first()[0]
    scale = max((q99 - q90) / (log(-log(0.9)) - log(-log(0.99))), 0.25)
    law = Calibration(q99 + scale * log(-log(0.99)), growth, scale)
    x = law.evidence(F.col("best"), F.col("n_words"))
    at = F.least(F.floor(x * 8), F.lit(HISTOGRAM - 1)).alias("at")
    bins = scored.groupBy(at).agg(F.sum(F.col("toxic").cast("double")).alias("toxic"), F.count("*").alias("n")).collect()
    value = np.array([(b["at"] + 0.5) / 8 for b in bins])
    toxic, n = np.array([b["toxic"] for b in bins]), np.array([float(b["n"]) for b in bins])
    if not len(value) or toxic.sum() in (0, n.sum()):
        return law
    # Half a row of each label at either end keeps the fit finite where the classes do not overlap.
    value = np.concatenate([value, [0.0, value.max()]])
    toxic, n = np.concatenate([toxic, [0.0, 0.5]]), np.concatenate([n, [0.5, 0.5]])
    w = np.zeros(2)
    m = np.stack([value, np.ones(len(value))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        hessian = (m * (n * p * (1 - p))[:, None]).T @ m + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, m.T @ (toxic - n * p) - 1e-3 * w)
        w += step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
    return replace(law, slope=float(w[0]), bias=float(w[1]))


SCANNED = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("best", T.DoubleType()), T.StructField("passages", T.StringType())]
)


def scan(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_words, best (score of the best segment, 0 without one) and passages.

    Passages are all segments of LEAST_SEGMENT and more, `first word:last word:score`, joined by commas."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *SCANNED.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(lexicon.hashes)
        for batch in batches:
            for part in slices(batch, 1):
                words = Words(part.column(1))
                at, score = lexicon.token_scores(words, table)
                cut = np.searchsorted(at, words.offsets)
                best, passages = np.zeros(len(part)), [""] * len(part)
                for d in np.flatnonzero(np.diff(cut)):
                    a, b = cut[d], cut[d + 1]
                    found = segments((at[a:b] - words.offsets[d]).tolist(), score[a:b].tolist())
                    best[d] = max((s for s, _, _ in found), default=0.0)
                    passages[d] = ",".join(f"{x}:{y}:{s:.3f}" for s, x, y in found if s >= LEAST_SEGMENT)
                counts = pa.array(np.diff(words.offsets).astype(np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), counts, pa.array(best), pa.array(passages)], schema.names)

    return docs.select(doc_id, text).mapInArrow(run, schema)


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted, passages.

    Log-odds and calibration are learned from labelled rows outside the held-out fold only; a score depends on
    the text alone. Null and empty texts have no words and the score of a document without evidence. Repeated
    rows get equal scores; columns besides id and text are not read. Without usable labels scores stay low.
    """
    sample = written(labelled_sample(labels, doc_id), "toxicity-labels")
    lexicon = learn_terms(docs, sample, doc_id, text)
    scanned = written(scan(docs, lexicon, doc_id, text), "scanned")
    fold = held_out(F.col("doc_id"))
    fit = calibrate(scanned.filter(~fold).join(F.broadcast(sample), "doc_id"))
    value = F.round(fit.score(F.col("best"), F.col("n_words")), 9)
    out = scanned.select("doc_id", fold.alias("held_out"), value.alias("score"), "passages")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
