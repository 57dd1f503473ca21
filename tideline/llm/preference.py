"""Preference pairs: the common turn prefix once as prompt, and the two completions with loss masks."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A turn is written as head, text and tail; the loss covers text and tail of the trained role.
HEAD, TAIL, TRAINED = "<|%s|>\n", "<|end|>\n", "assistant"

# Turn numbers whose characters are summed in one task.
SLICE = 4096


def _turns(conversations: DataFrame, side: str) -> DataFrame:
    """One row per different turn; repeated rows of a turn count once, rows without a pair id go."""
    own = conversations.select("pair_id", "turn", "role", "text").filter("pair_id is not null").distinct()
    return own.withColumn("chosen", F.lit(side == "chosen")).withColumn("rejected", F.lit(side == "rejected"))


def format_pairs(chosen: DataFrame, rejected: DataFrame, head: str = HEAD, tail: str = TAIL, trained: str = TRAINED) -> DataFrame:
    """Segments of preference pairs from two tables (pair_id, turn, role, text).

    Result: pair_id, part (prompt, chosen or rejected), turn, role, rendered, loss_start and loss_end. The
    prompt is the longest common prefix of turns and appears once; what follows it is the completion of either
    side. Of each rendered turn the characters from loss_start to loss_end (exclusive, code points) are
    trained on: none in the prompt and in turns of other roles.

    Turns are compared in the order of their numbers: the prefix ends before the least number at which the
    sides differ in any row. So rows with one number belong to one turn and must agree together, in any order.
    Null roles and texts equal each other and are written empty; a null turn number comes before all others.
    A pair with one side only has no prompt. Rows with a null pair id belong to no pair and are left out.
    No conversation is gathered: turns are grouped by their content, the ends of the prefixes by minimum, and
    one row per pair joins back, so that a pair with a large part of all rows splits over many tasks.
    """
    both = _turns(chosen, "chosen").unionByName(_turns(rejected, "rejected"))
    turns = both.groupBy("pair_id", "turn", "role", "text").agg(F.max("chosen").alias("chosen"), F.max("rejected").alias("rejected"))
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    apart = turns.filter("not (chosen and rejected)").groupBy("pair_id").agg(F.min(place).alias("first"))
    joined = turns.withColumn("place", place).join(apart, "pair_id", "left")
    common = F.col("first").isNull() | (F.col("place") < F.col("first"))
    parts = F.when(common, F.array(F.lit("prompt"))).otherwise(
        F.filter(F.array(F.when(F.col("chosen"), "chosen"), F.when(F.col("rejected"), "rejected")), lambda p: p.isNotNull())
    )
    rows = joined.select("pair_id", F.explode(parts).alias("part"), "turn", "role", "text")
    before, _, after = head.partition("%s")
    begin = F.concat(F.lit(before), F.coalesce("role", F.lit("")), F.lit(after))
    rendered = F.concat(begin, F.coalesce("text", F.lit("")), F.lit(tail))
    trains = (F.col("part") != "prompt") & F.col("role").eqNullSafe(trained)
    start = F.when(trains, F.length(begin)).otherwise(F.length(rendered)).cast("long")
    return rows.select(
        "pair_id", "part", "turn", "role", rendered.alias("rendered"), start.alias("loss_start"), F.length(rendered).cast("long").alias("loss_end")
    )


def _placed(segments: DataFrame) -> DataFrame:
    """Segments with `begin`, the characters of their part before them in the order of turns.

    Sums run over slices of SLICE turn numbers first and within a slice then, so a long conversation is spread over tasks.
    """
    sliced = segments.withColumn("_slice", F.floor(F.col("turn") / SLICE)).withColumn("_size", F.length("rendered").cast("long"))
    part, before = ["pair_id", "part"], (Window.unboundedPreceding, -1)
    sizes = sliced.groupBy(*part, "_slice").agg(F.sum("_size").alias("_sum"))
    sums = sizes.withColumn("_low", F.sum("_sum").over(Window.partitionBy(*part).orderBy("_slice").rowsBetween(*before)))
    sums = sums.select(*[F.col(c).alias(f"_{c}") for c in part], F.col("_slice").alias("_of"), F.coalesce("_low", F.lit(0)).alias("_low"))
    same = F.col("pair_id").eqNullSafe(F.col("_pair_id")) & (F.col("part") == F.col("_part")) & F.col("_slice").eqNullSafe(F.col("_of"))
    inside = Window.partitionBy(*part, "_slice").orderBy("turn", "role", "rendered").rowsBetween(*before)
    begin = F.col("_low") + F.coalesce(F.sum("_size").over(inside), F.lit(0))
    return sliced.join(sums, same).withColumn("begin", begin).select(*segments.columns, "begin")


def assemble(segments: DataFrame, size: int = 1_000_000) -> DataFrame:
    """(pair_id, piece, prompt, chosen, rejected, chosen_loss, rejected_loss): whole strings and their masks.

    The turns of each part follow each other in order. Loss spans are arrays of (start, end), end exclusive, in code points
    of the string beside them, ascending; a part without trained turns has none. A part of more than `size` characters goes
    on in the next piece, at the end of a turn: turns are never cut, so a piece is at most `size` characters and a turn long.
    Pairs within the size are one row with piece 0, and the pieces of a part joined in order are the part. A part that a
    pair does not have is an empty string without spans.
    """
    placed = _placed(segments).withColumn("piece", F.floor(F.col("begin") / size))
    first = F.min("begin").over(Window.partitionBy("pair_id", "part", "piece"))
    rows = placed.withColumn("at", F.col("begin") - first)
    order = F.struct("begin", "turn", "role", "rendered")

    def joined(part: str) -> Column:
        turns = F.collect_list(F.when(F.col("part") == part, order))
        return F.array_join(F.transform(F.array_sort(turns), lambda r: r["rendered"]), "").alias(part)

    def losses(part: str) -> Column:
        span = F.struct((F.col("at") + F.col("loss_start")).alias("start"), (F.col("at") + F.col("loss_end")).alias("end"))
        wanted = (F.col("part") == part) & (F.col("loss_start") < F.col("loss_end"))
        return F.array_sort(F.collect_list(F.when(wanted, span))).alias(f"{part}_loss")

    both = [losses("chosen"), losses("rejected")]
    return rows.groupBy("pair_id", "piece").agg(joined("prompt"), joined("chosen"), joined("rejected"), *both)


def with_repeated_reply(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected tables from (conv_id, turn, role, text): the conversation as it is, and the same with
    its last reply replaced by its first one, an answer that ignores what was asked since.

    Replies are turns of the trained role. Conversations with fewer than two have an empty last reply instead,
    or, without any, equal sides. First and last are minimum and maximum by turn, role and text, so a
    conversation of any length is one group row.
    """
    own = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    reply = F.when(F.col("role") == TRAINED, F.struct("turn", "text"))
    ends = own.groupBy("pair_id").agg(F.min(reply).alias("first"), F.max(reply).alias("last"))
    last = F.col("role").eqNullSafe(TRAINED) & F.struct("turn", "text").eqNullSafe(F.col("last"))
    other = F.when(F.col("first").eqNullSafe(F.col("last")), F.lit("")).otherwise(F.col("first.text"))
    rejected = own.join(ends, "pair_id").select("pair_id", "turn", "role", F.when(last, other).otherwise(F.col("text")).alias("text"))
    return own, rejected
