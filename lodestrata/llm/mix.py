"""Problem 9: records of several sources mixed to target shares of the total size."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.tokens import VOCABULARY, token_count
from lodestrata.session import settle

#: Tokens of a block of the permutation: the last block of a budget is looked into by one task.
BLOCK_TOKENS = 1 << 22
#: Targets are planned on the driver and sent to all executors.
MOST_TARGETS = 100_000


@dataclass
class Source:
    name: str
    target: float
    repeats: int
    tokens: int


def tempered(shares: np.ndarray, exponent: float) -> np.ndarray:
    """Shares raised to a power and made to sum to 1; shares of 0 stay 0."""
    raised = np.where(shares > 0, np.exp(exponent * np.log(np.maximum(shares, 1e-300))), 0.0)
    return raised / raised.sum() if raised.sum() else raised


def entropy(shares: np.ndarray) -> float:
    positive = shares[shares > 0]
    return float(-(positive * np.log(positive)).sum())


def bisect(good, low: float, high: float, rounds: int = 80) -> float:
    """The edge between ``low``, where ``good`` is false, and ``high``, where it is true; the true side of it."""
    for _ in range(rounds):
        middle = (low + high) / 2
        low, high = (low, middle) if good(middle) else (middle, high)
    return high


def exponent_for_entropy(shares: np.ndarray, wanted: float) -> float:
    """The exponent in 0..64 at which the tempered token shares have the entropy wanted, or the nearest it can be."""
    if entropy(tempered(shares, 0.0)) <= wanted:
        return 0.0
    return bisect(lambda x: entropy(tempered(shares, x)) <= wanted, 0.0, 64.0)


#: Of the default total: the part of the targets whose sources may be too scarce to meet them.
SCARCE = 0.1


def default_total(target: np.ndarray, limit: np.ndarray, scarce: float = SCARCE) -> float:
    """The largest total at which all sources meet their targets, relative to each other, but the scarcest, which make up at most
    ``scarce`` of the targets and give all they may."""
    reach = np.where(target > 0, limit / np.maximum(target, 1e-300), np.inf)
    missed = given = 0.0
    for i in np.argsort(reach, kind="stable"):
        if missed + target[i] > scarce + 1e-12:
            return float(given + (1 - missed) * reach[i])
        missed, given = missed + target[i], given + (limit[i] if target[i] > 0 else 0.0)
    return float(limit[target > 0].sum())


def budgets(sources: list[Source], total: float | None, scarce: float = SCARCE) -> tuple[np.ndarray, float]:
    """The tokens to take of each source, and the exponent used.

    The temperature acts on what a source holds, counted with its repeats, beside what its target asks of the total: the weight is
    target * (held / asked) ** exponent where that is below 1, else the target. The exponent is bisected to the least at which none of these sources
    passes its limit. As their weights fall, the others' shares rise; sources that this pushes over their limit join them and the bisection is
    repeated, from the weights reached. At exponent 0, if nothing is scarce, the targets are met as they are. Without a ``total``, default_total is
    taken.
    """
    limit = np.array([max(0, s.repeats) * s.tokens for s in sources], float)
    target = np.array([max(0.0, s.target) for s in sources])
    usable = (limit > 0) & (target > 0)
    if not usable.any():
        return np.zeros(len(sources)), 0.0
    limit, target = np.where(usable, limit, 0.0), np.where(usable, target, 0.0)
    target = target / target.sum()
    total = min(default_total(target, limit, scarce) if total is None else max(0.0, float(total)), float(limit.sum()))
    if not total:
        return np.zeros(len(sources)), 0.0
    weights, used = target, 0.0
    for _ in range(10_000):
        short = usable & (weights * total > limit * (1 + 1e-9))
        if not short.any():
            break
        ratio = np.where(short, limit / np.maximum(weights * total, 1e-300), 1.0)

        def mixed(exponent: float, base=weights, ratio=ratio) -> np.ndarray:
            raised = base * ratio**exponent
            return raised / raised.sum()

        within = lambda x, short=short: bool((mixed(x)[short] * total <= limit[short] * (1 + 1e-9)).all())
        if short[usable].all() or not within(64.0):
            return limit * (total / limit.sum()), 1.0  # every source at its limit, or so near that what is held decides alone
        exponent = bisect(within, 0.0, 64.0)
        weights, used = mixed(exponent), max(used, exponent)
    return np.minimum(weights * total, limit), used


def sized(rows: DataFrame, key: str, text: str, source: str, vocabulary: str) -> DataFrame:
    name = F.lower(F.trim(F.col(source)))
    return settle(rows.select(F.col(key).alias("key"), name.alias("source"), token_count(vocabulary)(F.col(text)).alias("tokens")).filter("source is not null and tokens > 0"))


def wanted_sources(items: DataFrame, targets: DataFrame) -> tuple[DataFrame, list[Source]]:
    """The items of the target sources, and those sources with what they hold. Targets are a short list by their nature."""
    goals = targets.groupBy(F.lower(F.trim("source")).alias("source")).agg(F.sum(F.coalesce("target_share", F.lit(0.0))).alias("target_share"), F.min(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats")).filter("source is not null")
    rows = goals.limit(MOST_TARGETS + 1).collect()
    if len(rows) > MOST_TARGETS:
        raise ValueError(f"more than {MOST_TARGETS} targets")
    goals = goals.sparkSession.createDataFrame(rows, goals.schema)
    mine = items.join(F.broadcast(goals.select("source")), "source")
    held = {r["source"]: r["tokens"] for r in mine.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}
    return mine, [Source(r["source"], r["target_share"], r["max_repeats"], held.get(r["source"], 0)) for r in goals.orderBy("source").collect()]


def realise(mine: DataFrame, sources: list[Source], wanted: np.ndarray, seed: int = 42, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``key, source, tokens, times`` of the records used.

    A budget is as many whole passes over its source as it holds, and a part of one more. For that part the records stand in a
    permutation by hash, cut into blocks: the totals of the blocks say which are in whole and which one the budget ends in; only that
    block is looked into, up to the record that ends nearest to the budget. So no source, however large, is one task: its blocks are
    the least power of two that leaves ``block_tokens`` or fewer to each, in mean.
    """
    bits = [max(4, int(np.ceil(np.log2(max(1, s.tokens) / block_tokens)))) for s in sources]
    plan = [(s.name, int(w // s.tokens) if s.tokens else 0, float(w - (w // s.tokens) * s.tokens) if s.tokens else 0.0, s.repeats, 64 - b) for s, w, b in zip(sources, wanted, bits)]
    budget = F.broadcast(mine.sparkSession.createDataFrame(plan, "source string, passes int, part double, max_repeats int, shift int"))  # a row for each target
    placed = mine.withColumn("order", F.xxhash64(F.lit(seed), F.col("key"))).join(budget.select("source", "shift"), "source")
    placed = placed.withColumn("block", F.expr("shiftrightunsigned(order, shift)")).drop("shift")
    totals = placed.groupBy("source", "block").agg(F.sum("tokens").alias("tokens"))
    ahead = F.coalesce(F.sum("tokens").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = totals.withColumn("ahead", ahead).join(budget, "source")
    state = F.when(F.col("ahead") + F.col("tokens") <= F.col("part"), F.lit("in")).when(F.col("ahead") < F.col("part"), F.lit("edge")).otherwise(F.lit("out"))
    spans = spans.select("source", "block", "ahead", "passes", "part", "max_repeats", state.alias("state"))
    joined = placed.join(spans, ["source", "block"])  # sent around by the planner where its size allows
    sure = joined.filter("state != 'edge'").select("key", "source", "tokens", (F.col("passes") + (F.col("state") == "in").cast("int")).alias("times"))
    edge = joined.filter("state = 'edge'")
    so_far = F.sum("tokens").over(Window.partitionBy("source").orderBy("order", "key", "tokens").rowsBetween(Window.unboundedPreceding, 0)) + F.col("ahead")
    edge = edge.withColumn("end", so_far)
    taken = (F.col("end") - F.col("part") <= F.col("part") - (F.col("end") - F.col("tokens"))) & (F.col("passes") < F.col("max_repeats"))
    near = edge.select("key", "source", "tokens", (F.col("passes") + taken.cast("int")).alias("times"))
    return sure.unionByName(near).filter("times > 0")


def mix(rows: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", total: float | None = None, scarce: float = SCARCE, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """The selection ``<key>, source, tokens, times`` and the report ``source, target_share, max_repeats, tokens_available, tokens_wanted, tokens_used,
    tokens_unused, share, exponent``.

    Sources are compared trimmed and in lower case. Without ``total`` the selection is the largest that meets the targets but for the
    scarcest sources, those of at most ``scarce`` of the targets; they give what the exponent leaves them, which is next to all they may. ``scarce`` 0
    meets every target, however little that leaves. tokens_unused are those of records that are not used at all. A target of 0 or less, a
    source without records and repeats below 1 give nothing; records without source or tokens are never used. Targets
    that do not sum to 1 are scaled.
    """
    items = sized(rows, key, text, source, vocabulary)
    mine, sources = wanted_sources(items, targets)
    wanted, exponent = budgets(sources, total, scarce)
    chosen = settle(realise(mine, sources, wanted))
    return chosen.withColumnRenamed("key", key), report(chosen, sources, wanted, exponent)


def report(chosen: DataFrame, sources: list[Source], wanted: np.ndarray, exponent: float) -> DataFrame:
    used = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("times")).alias("tokens_used"), F.sum("tokens").alias("touched"))
    goals = [(s.name, float(s.target), s.repeats, s.tokens, float(w), float(exponent)) for s, w in zip(sources, wanted)]
    goal = chosen.sparkSession.createDataFrame(goals, "source string, target_share double, max_repeats int, tokens_available bigint, tokens_wanted double, exponent double")
    both = goal.join(used, "source", "left").withColumn("tokens_used", F.coalesce("tokens_used", F.lit(0)))
    share = F.col("tokens_used") / F.nullif(F.sum("tokens_used").over(Window.partitionBy()), F.lit(0))  # one row for each target
    return both.select("source", "target_share", "max_repeats", "tokens_available", "tokens_wanted", "tokens_used", (F.col("tokens_available") - F.coalesce("touched", F.lit(0))).alias("tokens_unused"), F.coalesce(share, F.lit(0.0)).alias("share"), "exponent")


def temperature_mix(rows: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", vocabulary: str = VOCABULARY) -> DataFrame:
    """The report of a mix by temperature alone: token shares of the target sources raised to the exponent at which their entropy
    is that of the targets, at the largest total that no source's repeats forbid."""
    items = sized(rows, key, text, source, vocabulary)
    mine, sources = wanted_sources(items, targets)
    shares = np.array([s.tokens if s.target > 0 and s.repeats > 0 else 0 for s in sources], float)
    if not shares.sum():
        return report(mine.select("source", "tokens", F.lit(0).alias("times")).limit(0), sources, np.zeros(len(sources)), 0.0)
    shares /= shares.sum()
    goals = np.array([max(0.0, s.target) for s in sources])
    exponent = exponent_for_entropy(shares, entropy(goals / goals.sum()))
    weights = tempered(shares, exponent)
    limit = np.array([s.repeats * s.tokens for s in sources], float)
    total = float(np.min(limit[weights > 0] / weights[weights > 0]))
    chosen = settle(realise(mine, sources, weights * total))
    return report(chosen, sources, weights * total, exponent)
