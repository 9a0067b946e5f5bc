"""Cross-entropy and perplexity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.arrays import cross_entropy
from corpusloom.functions.text import bind


def position_losses(df: DataFrame, logits: str, label: str, name: str = "loss") -> DataFrame:
    """Loss of every row with a label that counts; each row is one position."""
    return df.filter(F.col(label) != fv.IGNORE_LABEL).withColumn(
        name, cross_entropy(F.col(logits), F.col(label))
    )


def chunk_losses(
    chunks: DataFrame, position: Sequence[str], start: str, logits: str, label: str, name: str = "loss"
) -> DataFrame:
    """Loss of every position whose scores lie in several rows, each a chunk of the vocabulary.

    A row holds the scores from ``start`` on and the label of its position.
    Each chunk gives its greatest score and the sum of exponents scaled by it;
    these are put together per position, of which only as many pairs meet as
    it has chunks.  A score of minus infinity counts nothing, a position with
    nothing else is undefined like one with a NaN, and a label without a score
    has no loss.
    """
    def of(x: Column) -> Column:
        top = F.array_max(x)
        base = F.when(top == float("-inf"), 0.0).otherwise(top)
        total = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.exp(v - base))
        return F.struct(top.alias("top"), base.alias("base"), total.alias("total"))
    scores = F.col(logits).cast("array<double>")
    at = F.col(label) - F.col(start)
    own = F.when((at >= 0) & (at < F.size(scores)), F.get(scores, at.cast("int")))
    kept = chunks.filter((F.col(label) != fv.IGNORE_LABEL) & (F.size(scores) > 0))
    parts = kept.select(*position, label, bind(scores, of).alias("_part"), own.alias("_own"))
    whole = parts.groupBy(*position, label).agg(F.collect_list("_part").alias("_parts"), F.max("_own").alias("_own"))
    top = F.array_max(F.transform("_parts", lambda p: p["top"]))
    total = F.aggregate("_parts", F.lit(0.0), lambda acc, p: acc + F.when(p["top"] == float("-inf"), 0.0).otherwise(
        p["total"] * F.exp(p["base"] - F.col("_top"))))
    loss = F.ln("_total") + F.col("_top") - F.col("_own")
    return whole.withColumn("_top", top).withColumn("_total", total).withColumn(
        name, F.when(F.isnan("_top") | (F.col("_top") == float("-inf")), float("nan")).otherwise(loss)).drop(
        "_parts", "_own", "_top", "_total")


def shifted_positions(df: DataFrame, logits: str, labels: str) -> DataFrame:
    """One row per position of each sequence, its logits beside the next label.

    ``logits`` is a list of score lists and ``labels`` a list of ids, both as
    long as the sequence.  The last scores and the first label have no
    partner.
    """
    steps = F.size(labels) - 1
    before = F.slice(logits, F.lit(1), F.greatest(steps, F.lit(0)))
    after = F.slice(labels, F.lit(2), F.greatest(steps, F.lit(0)))
    others = [c for c in df.columns if c not in (logits, labels)]
    pairs = F.arrays_zip(before.alias("logits"), after.alias("label"))
    return df.select(*others, F.inline(pairs))


def perplexity_with_total(losses: DataFrame, by: str, total: str, loss: str = "loss") -> DataFrame:
    """Perplexity per value of ``by`` and over all, from one pass over the losses."""
    sums = losses.groupBy(by).agg(F.count("*").alias("n_positions"), F.sum(loss).alias("_sum"))
    both = sums.withColumn(by, F.explode(F.array(F.col(by), F.lit(total))))
    means = both.groupBy(by).agg(
        F.sum("n_positions").alias("n_positions"), (F.sum("_sum") / F.sum("n_positions")).alias("eval_loss"))
    return means.withColumn("perplexity", F.exp("eval_loss"))


def perplexity(losses: DataFrame, by: Sequence[str | Column] = (), loss: str = "loss") -> DataFrame:
    """Mean loss and its exponent, which is infinite when it overflows."""
    means = losses.groupBy(*by).agg(F.count("*").alias("n_positions"), F.avg(loss).alias("eval_loss"))
    return means.withColumn("perplexity", F.exp("eval_loss"))
