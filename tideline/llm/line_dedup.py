"""Duplicate lines and paragraphs across documents, removed by digest with their original offsets kept."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import let, written

# A digest with more than this share of all units is joined by a broadcast of such digests; there are at most as
# many of them as the share goes into one.
HOT_SHARE = 1 / (1 << 14)


def normalised(unit: Column) -> Column:
    """Lower case; runs of characters other than letters and digits are one space, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " "))


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def units(rows: DataFrame, least_words: int = 1) -> DataFrame:
    """One row per line and per paragraph of (doc_id, row, text): first and last line, place, words and 128-bit digest.

    Lines without letters and digits are no units. A paragraph is a run of other lines; one of a single line is that
    line. `place` counts lines that are units. Equal text gives equal digests, however it is cut into lines.
    """
    numbered = F.transform(lines(F.col("text")), lambda p, i: F.struct(i.alias("number"), normalised(p).alias("norm")))

    def own(held: Column) -> Column:
        places = F.transform(
            held, lambda u, k: F.struct(u["number"].alias("first"), u["number"].alias("last"), k.alias("place"), u["norm"].alias("norm"))
        )
        begins = F.filter(places, lambda u: (u["place"] == 0) | (F.get(held, u["place"] - 1)["number"] < u["first"] - 1))

        def paragraph(begin: Column, k: Column) -> Column:
            after = F.coalesce(F.get(begins, k + 1)["place"], F.size(held))
            some = F.slice(held, begin["place"] + 1, after - begin["place"])
            whole = F.when(F.size(some) > 1, F.array_join(F.transform(some, lambda u: u["norm"]), " "))
            return F.struct(begin["first"].alias("first"), (begin["first"] + F.size(some) - 1).alias("last"), begin["place"].alias("place"), whole.alias("norm"))

        return F.concat(places, F.filter(F.transform(begins, paragraph), lambda u: u["norm"].isNotNull()))

    exploded = rows.select("doc_id", "row", F.explode(let(F.filter(numbered, lambda u: u["norm"] != ""), own)).alias("unit"))
    words = F.length("unit.norm") - F.length(F.replace("unit.norm", F.lit(" "))) + 1
    named = exploded.select("doc_id", "row", "unit.first", "unit.last", "unit.place", words.alias("words"), F.unhex(F.md5("unit.norm")).alias("digest"))
    return named.filter(F.col("words") >= least_words).drop("words")


def duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = 1) -> DataFrame:
    """(row, number, place) of every line that repeats an earlier unit, or lies in a paragraph that does.

    `docs` has the column `row`, a key of its rows. The earliest unit, by document id (null last), row and place,
    stays. Digests are grouped with a minimum, formed before the shuffle. Those with a large share of all units,
    few by their very share, are joined by broadcast; no other one is large enough to burden a task.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), "row", F.col(text).alias("text"))
    found = written(units(own, least_words), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "first")
    counts = found.groupBy("digest").agg(F.min(rank).alias("rank"), F.count("*").alias("n")).filter("n > 1")
    firsts = written(counts.select("digest", F.col("rank.row").alias("first_row"), F.col("rank.first").alias("first_line"), "n"), "repeated")
    total = firsts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_hot = F.col("n") > total * HOT_SHARE
    hot, cold = F.broadcast(firsts.filter(is_hot)), firsts.filter(~is_hot)
    rest = found.join(hot.select("digest"), "digest", "left_anti").join(cold, "digest")
    later = found.join(hot, "digest").unionByName(rest).filter("row <> first_row or first <> first_line")
    every = F.transform(F.sequence("first", "last"), lambda n: F.struct(n.alias("number"), (F.col("place") + n - F.col("first")).alias("place")))
    return later.select("row", F.explode(every).alias("line")).select("row", "line.number", "line.place")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = 1) -> DataFrame:
    """Per row of `docs`: doc_id, text (without the repeated lines), n_units, n_removed, n_removed_words, longest_run, removed.

    Units are lines and paragraphs, removed are lines. `removed` holds their original offsets, an array of (start,
    end) in code points, end exclusive, in order; what is kept keeps its separators. Removed lines with nothing but
    blank lines between them are a run; `longest_run` is the number of words of the longest one, which tells a
    passage taken over from lines that merely recur. Units of fewer than `least_words` words stay.

    Null and empty texts are one empty line, which stays. Of repeated rows the first keeps its text. Very long texts
    are many units; nothing is collected but the removed numbers of one row. Columns besides id and text are not read.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("row", F.monotonically_increasing_id())
    own = written(own, "rows")
    numbers = F.sort_array(F.collect_set(F.struct("number", "place")))
    gone = duplicates(own, "doc_id", "text", least_words).groupBy("row").agg(numbers.alias("gone"))
    joined = own.join(gone, "row", "left").withColumn("parts", lines(F.col("text")))
    joined = joined.withColumn("gone", F.coalesce("gone", F.array().cast(gone.schema["gone"].dataType)))
    words = F.transform("gone", lambda g: F.size(F.split(normalised(F.get("parts", g["number"])), " ")))
    # Offsets and runs go through the removed lines once: each adds the length of the kept lines before it.
    steps = """
        aggregate(
            arrays_zip(gone, words),
            named_struct('at', 0L, 'next', 0, 'place', -9, 'run', 0, 'longest', 0, 'out', array_repeat(named_struct('start', 0L, 'end', 0L), 0)),
            (s, g) -> named_struct(
                'at', s.at + {gap} + length(parts[g.gone.number]) + 1,
                'next', g.gone.number + 1,
                'place', g.gone.place,
                'run', if(g.gone.place = s.place + 1, s.run, 0) + g.words,
                'longest', greatest(s.longest, if(g.gone.place = s.place + 1, s.run, 0) + g.words),
                'out', concat(s.out, array(named_struct('start', s.at + {gap}, 'end', s.at + {gap} + length(parts[g.gone.number])))))
        )
    """
    gap = "cast(length(array_join(slice(parts, s.next + 1, g.gone.number - s.next), '')) + g.gone.number - s.next as bigint)"
    kept = "case when size(gone) = 0 then text else array_join(staying, '\n') end"
    stay = F.filter("parts", lambda p, i: ~F.array_contains(F.transform("gone", lambda g: g["number"]), i))
    found = joined.withColumn("words", words).withColumn("staying", stay).withColumn("steps", F.expr(steps.format(gap=gap)))
    return found.select(
        "doc_id",
        F.expr(kept).alias("text"),
        F.size("parts").cast("long").alias("n_units"),
        F.size("gone").cast("long").alias("n_removed"),
        F.aggregate("words", F.lit(0), lambda a, w: a + w).cast("long").alias("n_removed_words"),
        F.col("steps.longest").cast("long").alias("longest_run"),
        F.col("steps.out").alias("removed"),
    )
