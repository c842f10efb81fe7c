"""Mixing sources to target weights by temperature. Columns and aggregates only.

The weight of a source is its share of tokens to the power of an exponent between 0 (all alike) and 1 (as
they are), normalised. The exponent is bisected until the weights have a given part of the largest entropy,
or no source is repeated more often than allowed; where both are given, the limit on repeats prevails.
The weights are then dealt out: every source is a stream of whole permutations of its documents, one after
the other, and gives the first tokens of the stream up to its part of the budget. Streams are cut into as
many blocks as the budget has, so that every block has the target weights, and each block is permuted.

A document costs its words plus one, for the end of the document; it is dealt if it starts within its
source's part, so a source may exceed that by less than one document.

Defined cases: a NULL source is a source named ''; a NULL text has no words; a NULL doc_id is dealt like
others; repeated rows are dealt each; an empty table gives an empty result. Columns other than doc_id,
text and the source are neither read nor returned.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatgrid.llm.shared import running_totals, stored, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = 30  # of the bisection: exponents are multiples of 2 ** -LEVELS
AT_ONCE = 5  # levels per job
BLOCK_TOKENS = 1 << 16


def costs(docs: DataFrame, source: str) -> DataFrame:
    """(doc_id, source, fingerprint, cost) of every row."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.md5(text_or_empty()).alias("fingerprint"),
        (F.regexp_count(text_or_empty(), F.lit(WORD)) + 1).cast("long").alias("cost"),
    )


def bisected(sources: DataFrame, holds, keep_high: bool) -> float:
    """The exponent between 0 and 1 where ``holds`` changes, by ``LEVELS`` halvings.

    ``holds(exponent)`` is an aggregate over the sources. Each job evaluates all midpoints that the next few
    halvings can meet, so the driver sees a fixed number of flags per job, however many sources there are.
    ``keep_high``: it holds for large exponents, and the smallest is wanted; else the largest.
    """
    low, high = 0, 1 << LEVELS
    while high - low > 1:
        step = max(1, (high - low) >> AT_ONCE)
        points = range(low + step, high, step)
        flags = sources.agg(*(holds(point / 2**LEVELS).alias(f"at_{i}") for i, point in enumerate(points))).first()
        known = dict(zip(points, flags, strict=True))
        while high - low > step:
            middle = (low + high) // 2
            if bool(known[middle]) == keep_high:
                high = middle
            else:
                low = middle
    return (high if keep_high else low) / 2**LEVELS


def exponent(
    sources: DataFrame, budget: int, total: int, count: int, entropy_part: float | None, max_repeats: float | None
) -> float:
    """The exponent for the sources (source, tokens) that meets the targets."""
    share = F.col("tokens") / F.lit(float(total))

    def spread_enough(a: float) -> Column:
        power = F.pow(share, F.lit(a))
        whole = F.sum(power)
        return F.log(whole) - F.sum(power * F.log(share)) * a / whole >= entropy_part * math.log(count)

    def seldom_enough(a: float) -> Column:
        power = F.pow(share, F.lit(a))
        return F.max(power / F.col("tokens")) * float(budget) / F.sum(power) <= max_repeats

    found = 1.0
    if entropy_part is not None and not sources.agg(spread_enough(1.0)).first()[0]:
        found = bisected(sources, spread_enough, keep_high=False)
    if max_repeats is not None:
        if max_repeats < budget / total:
            raise ValueError("the budget repeats the sources more often than allowed whatever the weights")
        if not sources.agg(seldom_enough(found)).first()[0]:
            found = bisected(sources, seldom_enough, keep_high=True)
    return found


def mix(
    docs: DataFrame,
    budget: int | None = None,
    entropy_part: float | None = 0.95,
    max_repeats: float | None = 4.0,
    source: str = "source",
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 0,
) -> DataFrame:
    """(doc_id, source, fingerprint, epoch, n_tokens, block, slot) of every document dealt.

    ``budget`` is in tokens, as many as there are by default. ``epoch`` tells how many times the source had
    been gone through before, ``slot`` the place within the block.
    """
    rows = stored(costs(docs, source), "costs")
    sources = stored(rows.groupBy("source").agg(F.sum("cost").alias("tokens")), "sources")
    total, count = sources.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count("*")).first()
    budget = total if budget is None else budget
    a = exponent(sources, budget, total, count, entropy_part, max_repeats) if count else 1.0
    power = F.pow(F.col("tokens") / F.lit(float(max(1, total))), F.lit(a))
    whole = sources.agg(F.sum(power)).first()[0] or 1.0
    plan = sources.withColumn("quota", F.floor(power / F.lit(whole) * F.lit(float(budget)))).where("quota > 0")
    blocks = max(1, budget // block_tokens)
    epochs = F.ceil(F.col("quota") / F.col("tokens"))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), "epoch", "doc_id", "fingerprint"))
    dealt = (
        rows.join(plan, "source")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), (epochs - 1).cast("int"))))
        .withColumn("key", key)
    )
    dealt = running_totals(dealt, ["source"], ["epoch", "key"], "cost", "dealt").where("before < quota")
    block = F.floor(F.col("before").cast("double") * F.lit(float(blocks)) / F.col("quota").cast("double"))
    # A block has about block_tokens tokens, so at most as many documents.
    slot = F.row_number().over(Window.partitionBy("block").orderBy("key", "source", "doc_id")) - 1
    return dealt.withColumn("block", block.cast("long")).select(
        "doc_id", "source", "fingerprint", "epoch", F.col("cost").alias("n_tokens"), "block", slot.cast("long").alias("slot")
    )
