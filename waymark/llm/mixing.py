"""Temperature mixing of sources to target weights, realised as budgeted block permutations, in DataFrame operations.

A source's weight is its token share raised to an exponent between 0 (all sources alike) and 1 (as they are), normalised. The exponent is
found by bisection: the largest whose mix reaches ``target_entropy`` (nats), or else the smallest that repeats no source
more than ``max_repeats`` times. Four halvings are evaluated in one aggregate over the sources, which stay a table.

The budget in tokens is dealt by weight; without a given budget it is the least that uses every document once. A source's stream is one
permutation of its documents after another, cut where its budget ends; a document whose start lies before the cut is whole.
The budget is also cut into blocks: a document falls into the block of its place in its source's stream, so every block holds
the sources at their weights, and documents are permuted within a block.

Running sums are taken in ``SLICES`` slices of each permutation, then inside the slices, so a source with a third of all rows is no
single task. Tokens are words and one end mark, so an empty or null text counts 1. A null source is a source. Repeated rows
are documents of their own, ordered by a hash of the row; equal rows are interchangeable. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import materialise

MAX_REPEATS = 1.5
BLOCK_TOKENS = 1 << 20
SLICES = 1 << 10
HALVINGS = 4  # per pass
PASSES = 6


def tokens() -> Column:
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return (F.size(words) + 1).cast("long")


def source_key() -> Column:
    """The source as a key that is never null."""
    return F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))


def exponent(totals: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None) -> float:
    """The exponent that meets the target; 1 if even the sources as they are do, 0 if no exponent can."""
    if target_entropy is None and max_repeats is None:
        return 1.0
    low, high = 0.0, 1.0  # for entropy: low meets it, high may not; for repeats: high meets it, low may not
    share = F.col("n") / F.lit(totals.agg(F.sum("n")).first()[0] or 1)

    def met(values: list[float]) -> list[bool]:
        if target_entropy is not None:
            z = [F.sum(F.pow(share, F.lit(a))) for a in values]
            m = [F.sum(F.pow(share, F.lit(a)) * F.log(share) * F.lit(a)) for a in values]
            got = totals.agg(*(F.log(x) - y / x for x, y in zip(z, m, strict=True))).first()
            return [h is None or h >= target_entropy for h in got]
        got = totals.agg(*(F.max(F.pow(share, F.lit(a - 1))) / F.min(F.pow(share, F.lit(a - 1))) for a in values)).first()
        return [r is None or r <= max_repeats for r in got]

    entropy = target_entropy is not None
    ends = met([low, high])
    if ends[1 if entropy else 0]:
        return high if entropy else low
    if not ends[0 if entropy else 1]:
        return low if entropy else high
    for _ in range(PASSES):
        cuts = 1 << HALVINGS
        grid = [low + (high - low) * k / cuts for k in range(cuts + 1)]
        inside = met(grid[1:-1])
        # Both conditions are monotone, so this is where HALVINGS steps of bisection would end.
        k = inside.index(not entropy) if (not entropy) in inside else len(inside)
        low, high = grid[k], grid[k + 1]
    return low if entropy else high


def budgets(totals: DataFrame, alpha: float, budget: int | None = None) -> DataFrame:
    """_key, n, weight, budget: what each source contributes, in tokens."""
    sums = totals.agg(F.sum(F.pow("n", F.lit(alpha))).alias("z"), F.max(F.pow("n", F.lit(1 - alpha))).alias("m")).first()
    if not sums.z:
        return totals.select("_key", "n", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("budget"))
    weight = F.pow("n", F.lit(alpha)) / F.lit(sums.z)
    due = F.round(weight * F.lit(float(budget if budget is not None else sums.m * sums.z))).cast("long")
    return totals.select("_key", "n", weight.alias("weight"), (F.greatest(due, "n") if budget is None else due).alias("budget"))


def drawn(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None, budget: int | None = None, seed: int = 1, counted: bool = False) -> DataFrame:
    """``docs`` once for each time it is drawn, with tokens, epoch (int) and block (long). ``counted``: column tokens is there."""
    names = [c for c in docs.columns if c not in ("tokens", "epoch", "block")]
    rows = docs.withColumns({"tokens": F.col("tokens") if counted else tokens(), "_key": source_key()})
    rows = rows.select(*(f"`{c}`" for c in names), "tokens", "_key")
    totals = materialise(rows.groupBy("_key").agg(F.sum("tokens").alias("n")))
    plan = budgets(totals, exponent(totals, max_repeats, target_entropy), budget)
    size = plan.agg(F.sum("budget")).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_TOKENS))
    whole = F.xxhash64(*(F.col(f"`{c}`") for c in names if "map<" not in dict(docs.dtypes)[c]))
    turns = rows.withColumn("_row", whole).join(plan.filter("budget > 0"), "_key")
    turns = turns.withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("budget") / F.col("n")) - 1).cast("int"))))
    turns = turns.withColumn("_h", F.xxhash64(F.lit(seed), "epoch", "_row")).withColumn("_slice", F.pmod(F.shiftrightunsigned("_h", 40), F.lit(SLICES)))
    keys = ["_key", "epoch", "_slice"]
    before = Window.partitionBy("_key", "epoch").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = turns.groupBy(*keys).agg(F.sum("tokens").alias("t")).withColumn("_before", F.coalesce(F.sum("t").over(before), F.lit(0))).drop("t")
    inside = Window.partitionBy(*keys).orderBy("_h", "_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("_in", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(sums, keys)
    placed = placed.withColumn("_at", F.col("epoch") * F.col("n") + F.col("_before") + F.col("_in")).filter("_at < budget")
    block = F.least(F.floor(F.col("_at") / F.col("budget") * blocks), F.lit(blocks - 1)).cast("long")
    return placed.select(*(f"`{c}`" for c in names), "tokens", "epoch", block.alias("block"), "_h")


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` once for each time it is drawn, with tokens, epoch, block and place (long, from 0 in each block)."""
    rows = drawn(docs, **options)
    order = Window.partitionBy("block").orderBy(F.xxhash64("_h", F.lit("place")), "_h")
    return rows.withColumn("place", F.row_number().over(order).cast("long") - 1).drop("_h")
