"""Preference formatting: a shared prompt and two masked completions per pair of conversations.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns (same role and same
text) is rendered once as the prompt; what follows in each is its completion. Only what the assistant says
in a completion is to be learned, so each completion comes with the spans of it that a mask leaves open,
end-of-turn marker included, counted in characters of the completion, end exclusive.

Defined cases: a NULL role counts as user and a NULL text as empty; turns are ordered by number (NULL
first), then role, then text, so repeated turns all stay; where one side is missing, its completion is empty
and nothing is common; a pair without turns does not exist; rows with a NULL pair form a pair of their own.
An empty table gives an empty result. Other columns are neither read nor returned. A conversation becomes one
string, so it has to fit into one row; pairs are what is spread over tasks.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatgrid.llm.shared import running_totals, stored

START, MIDDLE, END = "<|", "|>\n", "<|end|>\n"
ASSISTANT = "assistant"


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(END))


def completion(turns: Column, common: Column) -> Column:
    return F.slice(turns, common + 1, F.greatest(F.size(turns) - common, F.lit(0)))


def open_spans(turns: Column) -> Column:
    """start:end of what the assistant says, comma-joined. One pass that carries the length so far."""
    begin = F.struct(F.lit(0).alias("length"), F.lit("").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        start = state["length"] + F.length(turn["role"]) + len(START) + len(MIDDLE)
        end = start + F.length(turn["text"]) + len(END)
        span = F.concat(start.cast("string"), F.lit(":"), end.cast("string"))
        spans = (
            F.when(turn["role"] != ASSISTANT, state["spans"])
            .when(state["spans"] == "", span)
            .otherwise(F.concat(state["spans"], F.lit(","), span))
        )
        return F.struct(end.alias("length"), spans.alias("spans"))

    return F.aggregate(turns, begin, step)["spans"]


def preference_examples(turns: DataFrame) -> DataFrame:
    """(pair_id, n_common, prompt, chosen, rejected, chosen_spans, rejected_spans) per pair.

    ``turns`` is (pair_id, side, turn, role, text), one row per turn; side is 'chosen' or 'rejected'.
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )

    def side(name: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("side") == name, turn))).alias(name)

    pairs = turns.groupBy("pair_id").agg(side("chosen"), side("rejected"))
    same = F.zip_with(
        "chosen",
        "rejected",
        lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)),
    )
    first_other = F.array_position(same, F.lit(False)).cast("int")
    common = F.when(first_other > 0, first_other - 1).otherwise(F.size(same))
    split = pairs.withColumn("n_common", common).select(
        "pair_id",
        "n_common",
        F.slice("chosen", 1, F.col("n_common")).alias("prompt"),
        completion(F.col("chosen"), F.col("n_common")).alias("chosen"),
        completion(F.col("rejected"), F.col("n_common")).alias("rejected"),
    )

    def text(name: str) -> Column:
        return F.array_join(F.transform(name, rendered), "").alias(name)

    return split.select(
        "pair_id",
        "n_common",
        text("prompt"),
        text("chosen"),
        text("rejected"),
        open_spans(F.col("chosen")).alias("chosen_spans"),
        open_spans(F.col("rejected")).alias("rejected_spans"),
    )


def branched(conversations: DataFrame) -> DataFrame:
    """Pairs out of single conversations: rejected goes on as the next conversation does, from an answer on.

    The next one is that with the next conv_id there is, whatever gaps ids have. Conversations of even rank
    part at their last answer, so that one answer is weighed against another; those of odd rank part at their
    first, so that completions have several turns. What follows in the rejected side is the next
    conversation from its own last or first answer on, with turns numbered on. A conversation without an
    answer, or whose next one has none or does not exist, is its own rejected side and has nothing to prefer.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    ids = turns.where("conv_id IS NOT NULL").select("conv_id", F.lit(1).cast("long").alias("one")).distinct()
    ranks = stored(running_totals(ids, [], ["conv_id"], "one", "conversations").drop("one"), "ranks")
    answers = turns.where(F.col("role") == ASSISTANT).groupBy(F.col("conv_id").alias("of")).agg(
        F.min("turn").alias("first"), F.max("turn").alias("last")
    )
    told = ranks.join(answers, F.col("conv_id") == F.col("of")).select("conv_id", F.col("before").alias("rank"), "first", "last")
    following = told.select(
        (F.col("rank") - 1).alias("rank"),
        F.col("conv_id").alias("other"),
        F.col("first").alias("other_first"),
        F.col("last").alias("other_last"),
    )
    even = F.col("rank") % 2 == 0
    pairs = stored(
        told.join(following, "rank").select(
            F.col("conv_id").alias("own"),
            "other",
            F.when(even, F.col("last")).otherwise(F.col("first")).alias("cut"),
            F.when(even, F.col("other_last")).otherwise(F.col("other_first")).alias("other_cut"),
        ),
        "forks",
    )
    chosen = turns.select(F.col("conv_id").alias("pair_id"), F.lit("chosen").alias("side"), "turn", "role", "text")
    parted = turns.join(pairs.select("own", "cut"), F.col("conv_id") == F.col("own"), "left")
    kept = parted.where(F.col("cut").isNull() | F.coalesce(F.col("turn") < F.col("cut"), F.lit(True)))
    kept = kept.select(F.col("conv_id").alias("pair_id"), F.lit("rejected").alias("side"), "turn", "role", "text")
    after = turns.join(pairs, F.col("conv_id") == F.col("other")).where(F.col("turn") >= F.col("other_cut"))
    number = (F.col("turn") - F.col("other_cut") + F.col("cut")).cast(turns.schema["turn"].dataType).alias("turn")
    after = after.select(F.col("own").alias("pair_id"), F.lit("rejected").alias("side"), number, "role", "text")
    return chosen.unionByName(kept).unionByName(after)
