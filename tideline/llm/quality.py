"""Quality rules: text statistics and learned decision lists, in DataFrame functions only."""

from collections.abc import Sequence
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import let, written

SPACE = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 8
# Labelled rows from which a list is learned, at most.
LABELLED_ROWS = 20_000
# Learning: cuts per feature, conditions per rule, rules per list.
CUTS, MAX_CONDITIONS, MAX_RULES = 32, 4, 12
# A rule must be right this often and cover so many rejected rows, on rows it was not grown on.
MIN_PRECISION, MIN_COVER = 0.95, 3
FEATURES = ("word_length", "symbol_share", "upper_share", "line_share", "repeat_share", "unique_share", "words", "mark_share")


def _squeezed(text: Column, others: str) -> Column:
    """Number of characters that the class `others` does not match."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def _repeated(hashes: Column, n: Column) -> Column:
    """Words in windows of WINDOW words found twice or more, from the hashes of the words."""

    def covered(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(pairs: Column) -> Column:
            def twice(pair: Column, k: Column) -> Column:
                # Indexes outside the array give null, which equals nothing.
                return F.coalesce(F.get(pairs, k - 1)["h"] == pair["h"], F.lit(False)) | F.coalesce(
                    F.get(pairs, k + 1)["h"] == pair["h"], F.lit(False)
                )

            return F.sort_array(F.transform(F.filter(pairs, twice), lambda p: p["i"]))

        def length(at: Column) -> Column:
            gaps = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

        return let(let(ordered, starts), length)

    windows = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))
    some = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(F.lit(0).cast("long")))
    return F.when(n > WINDOW, some).otherwise(F.lit(0).cast("long"))


def statistics(text: Column) -> Column:
    """One struct of counts over a whole text; null is empty.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words as in the query's contract, and
    n_unique (distinct words), n_lines (lines with a word), n_upper (A-Z), n_marks (of `!?.,;:`).
    """

    def of_words(words: Column, whole: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.struct(
                _repeated(h, F.size(h)).alias("n_repeat_words"), F.size(F.array_distinct(h)).cast("long").alias("n_unique")
            )).alias("hashed"),
            let(
                F.filter(F.split(whole, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)) != ""),
                lambda lines: F.struct(
                    F.size(lines).cast("long").alias("n_lines"),
                    (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                ),
            ).alias("lines"),
        )

    def of_text(whole: Column) -> Column:
        trimmed = F.btrim(whole, F.lit(SPACE))
        words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES, -1))
        return let(let(words, lambda w: of_words(w, whole)), lambda s: F.struct(
            s["n_words"].alias("n_words"),
            s["word_chars"].alias("word_chars"),
            _squeezed(whole, "[^#*$%&|<>]+").alias("n_symbols"),
            s["lines"]["n_dup_lines"].alias("n_dup_lines"),
            s["hashed"]["n_repeat_words"].alias("n_repeat_words"),
            s["hashed"]["n_unique"].alias("n_unique"),
            s["lines"]["n_lines"].alias("n_lines"),
            _squeezed(whole, "[^A-Z]+").alias("n_upper"),
            _squeezed(whole, "[^!?.,;:]+").alias("n_marks"),
        ))

    return let(F.coalesce(text, F.lit("")), of_text)


def features(s: Column) -> dict[str, Column]:
    """Scale-free features of a statistics struct; texts without words have zeros."""
    words, chars = F.greatest(s["n_words"], F.lit(1)), F.greatest(s["word_chars"], F.lit(1))
    columns = (
        s["word_chars"] / words,
        s["n_symbols"] / chars,
        s["n_upper"] / chars,
        s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
        s["n_repeat_words"] / words,
        s["n_unique"] / words,
        s["n_words"].cast("double"),
        s["n_marks"] / chars,
    )
    return dict(zip(FEATURES, columns))


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


@dataclass(frozen=True)
class Condition:
    """`feature > cut`, or `feature <= cut`."""

    feature: str
    above: bool
    cut: float

    def holds(self, values: dict[str, Column]) -> Column:
        return values[self.feature] > self.cut if self.above else values[self.feature] <= self.cut


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; a row that meets all conditions of a rule is rejected, other rows are kept."""

    rules: tuple[tuple[Condition, ...], ...] = ()

    def rejects(self, values: dict[str, Column]) -> Column:
        chain = None
        for rule in self.rules:
            test = _all(rule, values)
            chain = F.when(test, F.lit(True)) if chain is None else chain.when(test, F.lit(True))
        return F.lit(False) if chain is None else chain.otherwise(F.lit(False))


def _all(rule: Sequence[Condition], values: dict[str, Column]) -> Column:
    test = F.lit(True)
    for condition in rule:
        test = test & condition.holds(values)
    return test


def _gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    """Information a condition adds, over the bad rows it keeps."""
    return bad * (log2(bad / (bad + good)) - log2(all_bad / (all_bad + all_good))) if bad else 0.0


def _centred(rows: DataFrame, rule: list[Condition], values: dict[str, Column]) -> list[Condition]:
    """The rule with each cut half way between the nearest values on its two sides, among the rows that the
    other conditions cover."""
    ends = []
    for k, c in enumerate(rule):
        others, v = _all(rule[:k] + rule[k + 1 :], values), values[c.feature]
        ends += [F.max(F.when(others & (v <= c.cut), v)).alias(f"low{k}"), F.min(F.when(others & (v > c.cut), v)).alias(f"high{k}")]
    row = rows.agg(*ends).first()
    middles = [(c.cut if row[f"low{k}"] is None else row[f"low{k}"], row[f"high{k}"]) for k, c in enumerate(rule)]
    return [c if high is None else Condition(c.feature, c.above, (low + high) / 2) for c, (low, high) in zip(rule, middles)]


def learn(labelled: DataFrame) -> DecisionList:
    """A decision list from rows with the columns of FEATURES, `bad` (boolean) and `grow` (boolean).

    Sequential covering: a rule grows by the threshold condition of highest gain until it covers no
    good row of the growing part, loses its last conditions while that does not lower its precision
    on the pruning part, and is kept if it is right there in MIN_PRECISION of its rows. The rows it
    covers go, and the next rule grows on the rest. Every count is one aggregate over all labelled
    rows: per feature and bin when growing, per prefix of the rule when pruning.
    """
    values = {f: F.col(f) for f in FEATURES}
    at = [i / CUTS for i in range(1, CUTS)]
    found = labelled.filter("grow").agg(*[F.percentile_approx(f, at, 10_000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted({float(x) for x in found[f] or []}) for f in FEATURES}
    pairs = []
    for i, f in enumerate(FEATURES):
        above = [F.when(values[f] > c, 1).otherwise(0) for c in cuts[f]]
        bin_of = F.lit(0)
        for one in above:
            bin_of = bin_of + one
        pairs.append(F.struct(F.lit(i).alias("f"), bin_of.alias("bin")))
    rest, rules = labelled, []
    while len(rules) < MAX_RULES:
        rule: list[Condition] = []
        while len(rule) < MAX_CONDITIONS:
            own = rest.filter(F.col("grow") & _all(rule, values)).select("bad", F.explode(F.array(*pairs)).alias("x"))
            counts = own.groupBy("x.f", "x.bin").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
            best, table = (0.0, None), {}
            for row in counts.collect():
                table.setdefault(row["f"], {})[row["bin"]] = (row["bad"], row["good"])
            one = next(iter(table.values()), {})
            bad, good = (sum(x[k] for x in one.values()) for k in (0, 1))
            if not bad or not good:
                break
            for i, f in enumerate(FEATURES):
                low = [0, 0]
                for b, cut in enumerate(cuts[f]):
                    low = [low[k] + table[i].get(b, (0, 0))[k] for k in (0, 1)]
                    for above, (x, y) in ((False, low), (True, (bad - low[0], good - low[1]))):
                        best = max(best, (_gain(x, y, bad, good), Condition(f, above, cut)), key=lambda g: g[0])
            if best[1] is None:
                break
            rule.append(best[1])
        if not rule:
            break
        rule = _centred(rest.filter("grow"), rule, values)
        prefixes = [_all(rule[: k + 1], values) for k in range(len(rule))]
        sums = [F.count_if(p & F.col("bad")).alias(f"bad{k}") for k, p in enumerate(prefixes)]
        sums += [F.count_if(p & ~F.col("bad")).alias(f"good{k}") for k, p in enumerate(prefixes)]
        held = rest.filter(~F.col("grow")).agg(*sums).first()
        score = [(held[f"bad{k}"] + 0.5) / (held[f"bad{k}"] + held[f"good{k}"] + 1) for k in range(len(rule))]
        keep = max(range(len(rule)), key=lambda k: (score[k], -k))
        covered, wrong = held[f"bad{keep}"], held[f"good{keep}"]
        if covered < MIN_COVER or covered < MIN_PRECISION * (covered + wrong):
            break
        rules.append(tuple(rule[: keep + 1]))
        rest = rest.filter(~_all(rules[-1], values))
    return DecisionList(tuple(rules))


def labelled_sample(labels: DataFrame, doc_id: str, rows: int) -> DataFrame:
    """At most `rows` labelled ids, by the order of a hash of the id, one row per id.

    `bad` is true where the label is 0; rows without an id or label are left out, and an id with both
    labels counts as bad.
    """
    own = labels.select(F.col(doc_id).alias("doc_id"), (F.col("quality") == 0).alias("bad")).dropna()
    ids = own.groupBy("doc_id").agg(F.max("bad").alias("bad"))
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def learn_from(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = LABELLED_ROWS) -> DecisionList:
    """Learn a decision list from the statistics of the labelled documents, at most `rows` of them.

    Only rows that pass the base rules are used, as the list decides on no others. Two thirds of them,
    by a hash of the id, grow the rules and one third prunes them.
    """
    sample = F.broadcast(labelled_sample(labels, doc_id, rows))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(sample, "doc_id")
    counted = own.select("doc_id", "bad", statistics(F.col("text")).alias("s"))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) > 0
    columns = [v.alias(f) for f, v in features(F.col("s")).items()]
    table = written(counted.select("bad", part.alias("grow"), base_failed(F.col("s")).alias("failed"), *columns), "labelled")
    return learn(table.filter("not failed").coalesce(4))


def judge(docs: DataFrame, rules: DecisionList, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs` its id, statistics, base_failed and kept. Null and empty texts have no words and fail."""
    s = F.col("s")
    counted = docs.select(F.col(doc_id).alias("doc_id"), statistics(F.col(text)).alias("s"))
    failed = base_failed(s)
    kept = ~failed & ~rules.rejects(features(s))
    return counted.select("doc_id", s, failed.alias("base_failed"), kept.alias("kept")).select("doc_id", "s.*", "base_failed", "kept")


def keep_good(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """The rows of `docs` that the rules keep, columns unchanged. Works row by row, so repeated rows share a verdict."""
    verdict = let(statistics(F.col(text)), lambda s: ~base_failed(s) & ~rules.rejects(features(s)))
    return docs.filter(verdict)
