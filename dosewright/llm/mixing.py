"""Mixing sources to target weights, with DataFrame functions only.

A source with share p of the tokens gets the weight p^a / sum p^a. Exponent 1
keeps the natural shares, 0 makes all sources equal. The exponent is bisected on
a grid of ten-thousandths: the largest whose weights reach the target entropy,
raised if need be until no source repeats more often than allowed. Five levels
of the bisection are evaluated in one aggregate, so three small jobs over the
table of sources decide it; only their sums reach the driver.

Weights are realised as block permutations. A source with n tokens and a budget
of b has b div n whole blocks (each document once) and one block that is the
beginning of a permutation of its documents, cut where b mod n tokens are used
up. The permutation is the order of a hash of seed and document. Running totals
are taken over about sqrt(documents) hash ranges of a source first, and then
inside the single range where the cut falls, so that a source with a third of
all rows is never sorted in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dosewright.llm.common import WORD
from dosewright.session import stored

GRID = 10_000
LEVELS = 5
ENTROPY_SHARE = 0.95
MAX_EPOCHS = 4.0
SEED = 17


def token_count(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def permutation_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def _sums(logs: DataFrame, steps: list[int]) -> dict[int, tuple[float, float]]:
    """For each exponent k / GRID: the sum of p^a, and of p^a * ln p."""
    power = {k: F.exp(F.col("l") * (k / GRID)) for k in steps}
    row = logs.agg(
        *(F.sum(p).alias(f"z{k}") for k, p in power.items()),
        *(F.sum(p * F.col("l")).alias(f"m{k}") for k, p in power.items()),
    ).first()
    return {k: (row[f"z{k}"], row[f"m{k}"]) for k in steps}


def _bisect(logs: DataFrame, holds) -> int:
    """Largest k in 0..GRID for which ``holds(k, z, m)``, which turns from true to false once; 0 if none."""
    low, high = 0, GRID + 1  # holds at low (or nowhere), not at high
    while high - low > 1:
        ends, probes = [(low, high)], set()
        for _ in range(LEVELS):
            halves = []
            for a, b in ends:
                if b - a > 1:
                    middle = (a + b) // 2
                    probes.add(middle)
                    halves += [(a, middle), (middle, b)]
            ends = halves
        sums = _sums(logs, sorted(probes))
        while high - low > 1 and (middle := (low + high) // 2) in sums:
            if holds(middle, *sums[middle]):
                low = middle
            else:
                high = middle
    return low


def exponent(
    totals: DataFrame, entropy_share: float = ENTROPY_SHARE, max_epochs: float = MAX_EPOCHS, budget: int | None = None
) -> tuple[float, float]:
    """(exponent, tokens of the whole mix) for sources with ``tokens``; sources without tokens do not count.

    Without a budget, the mix is as long as it takes to use every source once.
    If a budget asks for more passes over all tokens than allowed, natural
    shares repeat least and are used.
    """
    logs = totals.where("tokens > 0").select(F.col("tokens").cast("double").alias("t"))
    n, total, least, most = logs.agg(F.count("*"), F.sum("t"), F.min("t"), F.max("t")).first()
    if not n:
        return 1.0, 0.0
    logs = logs.select(F.ln(F.col("t") / F.lit(total)).alias("l"))
    low, high = math.log(least / total), math.log(most / total)
    target = entropy_share * math.log(n)

    def entropic(k, z, m):
        return math.log(z) - k / GRID * m / z >= target - 1e-9

    def too_often(k, z, m):
        a = k / GRID
        if budget is None:
            return (1 - a) * (high - low) > math.log(max_epochs) + 1e-9
        return math.log(budget / total) + (a - 1) * low - math.log(z) > math.log(max_epochs) + 1e-9

    for_entropy = _bisect(logs, entropic)
    for_limit = _bisect(logs, too_often)
    if for_limit or too_often(0, *_sums(logs, [0])[0]):
        for_limit += 1  # the first exponent within the limit
    a = min(max(for_entropy, for_limit), GRID) / GRID
    if budget is None:
        z = _sums(logs, [round(a * GRID)])[round(a * GRID)][0]
        budget = total * z * math.exp((1 - a) * high)
    return a, float(budget)


def mixture(docs: DataFrame, seed: int = SEED, **target) -> tuple[DataFrame, DataFrame]:
    """(documents, sources): what :func:`copies` needs.

    ``documents`` are (doc_id, source, tokens, key), stored; ``sources`` are one
    row a source with its weight, whole blocks and cut.
    """
    thin = docs.select(
        "doc_id",
        "source",
        token_count(F.col("text")).alias("tokens"),
        permutation_key(F.col("doc_id"), seed).alias("key"),
    )
    thin = stored(thin, "mix-documents")
    totals = stored(thin.groupBy("source").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")), "mix-sources")
    a, budget = exponent(totals, **target)
    z = totals.where("tokens > 0").agg(F.sum(F.pow(F.col("tokens"), F.lit(a)))).first()[0] or 1.0
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens"), F.lit(a)) / F.lit(z)).otherwise(0.0)
    planned = totals.select(
        F.col("source").alias("of"),
        F.col("tokens").alias("source_tokens"),
        F.ceil(F.sqrt("n")).alias("ranges"),
        F.lit(a).alias("exponent"),
        weight.alias("weight"),
        F.round(weight * F.lit(budget)).cast("long").alias("source_budget"),
    ).select(
        "*",
        # without tokens there is no budget to keep to: each document once
        F.when(F.col("source_tokens") > 0, F.expr("source_budget div source_tokens")).otherwise(1).alias("blocks"),
        F.when(F.col("source_tokens") > 0, F.expr("source_budget % source_tokens")).otherwise(0).alias("rest"),
    )
    placed = thin.join(planned.select("of", "ranges", "rest"), F.col("source").eqNullSafe(F.col("of"))).select(
        "of", "tokens", "key", "rest", _range_of(F.col("key"), F.col("ranges")).alias("range")
    )
    by_range = placed.groupBy("of", "range").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    running = F.sum("tokens").over(Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
    cut_range = (
        by_range.withColumn("after", running)
        .where("after > rest")
        .groupBy("of")
        .agg(F.min(F.struct("range", (F.col("after") - F.col("tokens")).alias("before"))).alias("at"))
        .select(F.col("of").alias("cut_of"), F.col("at.range").alias("cut_range"), F.col("at.before").alias("before"))
    )
    inside = placed.join(
        cut_range, F.col("of").eqNullSafe(F.col("cut_of")) & (F.col("range") == F.col("cut_range"))
    ).withColumn("after", F.col("before") + F.sum("tokens").over(Window.partitionBy("of").orderBy("key")))
    cut_key = inside.where("after <= rest").groupBy(F.col("of").alias("key_of")).agg(F.max("key").alias("cut_key"))
    sources = (
        planned.join(cut_range.drop("before"), F.col("of").eqNullSafe(F.col("cut_of")), "left")
        .join(cut_key, F.col("of").eqNullSafe(F.col("key_of")), "left")
        .drop("cut_of", "key_of")
    )
    return thin, stored(sources, "mix-plan")


def _range_of(key: Column, ranges: Column) -> Column:
    """Hash range of a key: its first eight digits, scaled."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) * ranges)


def copies(docs: DataFrame, sources: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` once for each block that holds them, with ``epoch`` (from 1) and ``weight``.

    ``docs`` has ``doc_id`` and ``source``. A null source is a source of its own.
    """
    key = permutation_key(F.col("doc_id"), seed)
    in_range = _range_of(key, F.col("ranges"))
    partial = (
        F.when(F.col("rest") == 0, 0)
        .when(F.col("cut_range").isNull(), 0)
        .when(in_range < F.col("cut_range"), 1)
        .when((in_range == F.col("cut_range")) & (key <= F.col("cut_key")), 1)
        .otherwise(0)
    )
    joined = docs.join(sources, F.col("source").eqNullSafe(F.col("of")))
    times = (F.col("blocks") + partial).cast("int")
    return (
        joined.withColumn("times", times)
        .where("times > 0")
        .select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("times"))).alias("epoch"), "weight")
    )


def mix(docs: DataFrame, seed: int = SEED, **target) -> DataFrame:
    """Schedule of the mix: ``doc_id``, ``source``, ``tokens``, ``epoch``, ``block_key``, ``weight``.

    A block is (source, epoch); ``block_key`` orders a block as a permutation of
    its own. Null and empty texts have no tokens and cost no budget; a source
    without tokens is passed over once. Repeated rows of a document stand
    together. An empty table gives an empty schedule. Other columns are ignored.
    """
    thin, sources = mixture(docs, seed, **target)
    order = F.md5(
        F.concat(F.lit(f"{seed}:"), F.col("epoch").cast("string"), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")
    )
    return copies(thin.select("doc_id", "source", "tokens"), sources, seed).select(
        "doc_id", "source", "tokens", "epoch", order.alias("block_key"), F.round("weight", 6).alias("weight")
    )


def mixed_documents(docs: DataFrame, seed: int = SEED, **target) -> DataFrame:
    """``docs`` themselves, each as often as the mix holds it; columns as they are."""
    _, sources = mixture(docs, seed, **target)
    # the plan's column names must not meet those of the documents
    names = {c: f"__{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "source")}
    held = copies(docs.withColumnsRenamed(names), sources, seed).drop("epoch", "weight")
    return held.withColumnsRenamed({new: old for old, new in names.items()}).select(*docs.columns)
