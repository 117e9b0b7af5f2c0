"""Problem 2: items that appear together more often than chance, under a bipartite configuration null."""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.frequency import normal_term
from lodestrata.operators.graph import count_pairs
from lodestrata.session import settle

#: Degrees up to EXACT are classes of their own; above, classes widen by STEP, so there are at most a few thousand.
EXACT, STEP = 128, 0.01


def incidence(rows: DataFrame, item: str = "entity", records: str = "chunks") -> DataFrame:
    """Distinct ``item, record``; null items and null records are none."""
    pairs = rows.select(normal_term(F.col(item)).alias("item"), F.explode(F.array_distinct(F.col(records))).alias("record"))
    return pairs.dropna().distinct()


def degree_class(degree):
    """The class of a degree, from which its size is known to within STEP."""
    above = F.lit(EXACT) + F.floor(F.log(degree / F.lit(float(EXACT))) / F.log1p(F.lit(STEP))) + F.lit(1)
    return F.when(degree <= EXACT, degree).otherwise(above).cast("int")


def fit_null(items: pd.DataFrame, records: pd.DataFrame, rounds: int = 20_000, tolerance: float = 1e-7, slack: float = 1e-3) -> dict:
    """The maximum-entropy bipartite null: P(item in record) = xy / (1 + xy), with every item's expected number of
    records and every record's expected number of items as observed. items, records: ``cls, degree, count``.

    An item that is in every record, or a record that has every item, is certain and taken out first, as its parameter is infinite. The fit ends when no
    expected degree is off by more than ``tolerance`` of it; if it has not after all rounds and one is off by more than ``slack``, it fails.
    """
    n, k = items["degree"].to_numpy(float), items["count"].to_numpy(float)
    m, c = records["degree"].to_numpy(float), records["count"].to_numpy(float)
    sure_items, sure_records = np.zeros(len(n), bool), np.zeros(len(m), bool)
    for _ in range(len(n) + len(m)):
        full_items = ~sure_items & (n - c[sure_records].sum() >= c[~sure_records].sum() - 1e-9) & (n > 0)
        full_records = ~sure_records & (m - k[sure_items].sum() >= k[~sure_items].sum() - 1e-9) & (m > 0)
        if not full_items.any() and not full_records.any():
            break
        sure_items |= full_items
        if not full_items.any():
            sure_records |= full_records
    left_n, left_m = n - c[sure_records].sum(), m - k[sure_items].sum()
    rows, columns = np.flatnonzero(~sure_items & (left_n > 1e-9)), np.flatnonzero(~sure_records & (left_m > 1e-9))
    x, y = np.full(len(n), 1e-6), np.full(len(m), 1e-6)
    x[sure_items], y[sure_records] = 1e12, 1e12
    if len(rows) and len(columns):
        a, b, many, each = left_n[rows], left_m[columns], k[rows], c[columns]
        links = max((a * many).sum(), 1.0)
        u, v = a / np.sqrt(links), b / np.sqrt(links)
        for _ in range(rounds):
            u = a / np.maximum((each * v / (1 + np.outer(u, v))).sum(axis=1), 1e-300)
            v = b / np.maximum((many[:, None] * u[:, None] / (1 + np.outer(u, v))).sum(axis=0), 1e-300)
            u, v = np.minimum(u, 1e9), np.minimum(v, 1e9)
            off = np.max(np.abs(u * (each * v / (1 + np.outer(u, v))).sum(axis=1) - a) / a)  # the records' degrees are exact here
            if off < tolerance:
                break
        else:
            if off > slack:
                raise ArithmeticError(f"the null has not converged: a degree is off by {off:.2g} of it")
        x[rows], y[columns] = u, v
    return {"x": dict(zip(items["cls"].tolist(), x.tolist())), "y": y, "count": c}


def tail(q: np.ndarray, count: np.ndarray, n: int) -> tuple[float, float]:
    """Mean of the Poisson-binomial X of ``count`` trials each of chance ``q``, and log10 P(X >= n).

    The distribution is tilted so that its mean is n, transformed exactly over a window of 12 deviations, and
    tilted back; so tails far below the precision of a double keep theirs.
    """
    q = np.clip(q, 0.0, 1 - 1e-12)
    mean, most = float((count * q).sum()), float(count.sum())
    if n <= 0:
        return mean, 0.0
    if n > most:
        return mean, -np.inf
    odds, theta = q / (1 - q), 0.0
    if n > mean:
        low, high = 0.0, 1.0
        while (count * odds * np.exp(high) / (1 + odds * np.exp(high))).sum() < n - 1e-9 and high < 600:
            low, high = high, high * 2
        for _ in range(60):
            theta = (low + high) / 2
            low, high = (theta, high) if (count * odds * np.exp(theta) / (1 + odds * np.exp(theta))).sum() < n else (low, theta)
    tilted = odds * np.exp(theta) / (1 + odds * np.exp(theta))
    spread = float(np.sqrt((count * tilted * (1 - tilted)).sum()))
    centre = float((count * tilted).sum())
    first = max(0, int(centre - 12 * spread) - 20)
    width = int(24 * spread) + 60
    turn = 2j * np.pi * np.arange(width) / width
    log_g = (count[:, None] * np.log(1 + tilted[:, None] * (np.exp(turn)[None, :] - 1) + 0j)).sum(axis=0)
    mass = np.maximum(np.real(np.fft.fft(np.exp(log_g - turn * first))) / width, 0.0)  # of X = first, first + 1, ...
    at = np.arange(first, first + width)
    keep = at >= n
    above = float((mass[keep] * np.exp(-theta * (at[keep] - n))).sum())
    if not above:
        return mean, -np.inf if n > mean else 0.0
    log_p = (count * np.log1p(odds * np.expm1(theta) / (1 + odds))).sum() - theta * n + np.log(above) if theta else np.log(above)
    return mean, min(0.0, float(log_p / np.log(10)))


def _tails(batches, null: dict):
    for batch in batches:
        expected, log_p = [], []
        for a, b, n in zip(batch["class_a"], batch["class_b"], batch["n_ab"]):
            p = [null["x"][k] * null["y"] / (1 + null["x"][k] * null["y"]) for k in (a, b)]
            mean, value = tail(p[0] * p[1], null["count"], int(n))
            expected.append(mean)
            log_p.append(max(value, -1e6))
        yield batch[["class_a", "class_b", "n_ab", "pairs"]].assign(expected=expected, log10_p=log_p)


#: How likely a pair may be by chance and yet count as found together more often than that.
LEVEL = 0.05


def together(rows: DataFrame, item: str = "entity", records: str = "chunks", min_together: int = 1, block: int = 256) -> DataFrame:
    """``a, b, n_a, n_b, n_ab, n_records, lift, expected, surprise, q_value`` of every pair found together in ``min_together`` records or more.

    expected, surprise (-log10 of the Poisson-binomial tail) and the false-discovery rate q_value (Benjamini-Hochberg over all
    possible pairs, each pair that is together at all taking its rank) come from a null that honours item frequency and record size. ``min_together`` only
    leaves rows out at the end, so it changes no value of the others.

    Null items and ids are none; repeated ids and rows count once; an empty table gives no rows.
    """
    links = settle(incidence(rows, item, records))
    items = settle(links.groupBy("item").agg(F.count("record").alias("n")))
    sizes = links.groupBy("record").agg(F.count("item").alias("m"))
    classes = lambda df, c: df.groupBy(degree_class(F.col(c)).alias("cls")).agg(F.avg(c).alias("degree"), F.count(F.lit(1)).alias("count")).toPandas()
    of_items, of_records = classes(items, "n"), classes(sizes, "m")  # bounded: see EXACT and STEP
    null, n_records, n_items = fit_null(of_items, of_records), int(of_records["count"].sum()), int(of_items["count"].sum())
    pairs = count_pairs(links, "item", "record", block).withColumnRenamed("n", "n_ab")
    one, two = (items.select(F.col("item").alias(s), F.col("n").alias(f"n_{s}"), degree_class(F.col("n")).alias(f"class_{s}")) for s in "ab")
    pairs = pairs.join(one, "a").join(two, "b").withColumn("n_records", F.lit(n_records).cast("bigint"))
    pairs = pairs.withColumn("lift", F.col("n_ab") * F.lit(n_records) / (F.col("n_a") * F.col("n_b")))
    pairs = settle(pairs.withColumns({"low": F.least("class_a", "class_b"), "high": F.greatest("class_a", "class_b")}).drop("class_a", "class_b"))
    combos = pairs.groupBy(F.col("low").alias("class_a"), F.col("high").alias("class_b"), "n_ab").agg(F.count(F.lit(1)).alias("pairs"))
    combos = combos.repartition(rows.sparkSession.sparkContext.defaultParallelism)  # few rows with much to do for each
    judged = settle(combos.mapInPandas(partial(_tails, null=null), "class_a int, class_b int, n_ab bigint, pairs bigint, expected double, log10_p double"))
    # Benjamini-Hochberg over steps of a hundredth of log10 p, down to 1e-320: at most 32,001 rows
    step = F.least(F.floor(-F.col("log10_p") * 100), F.lit(32_000))
    levels = judged.groupBy(step.alias("step")).agg(F.sum("pairs").alias("pairs"))
    rank = F.sum("pairs").over(Window.orderBy(F.col("step").desc()))
    possible = n_items * (n_items - 1) / 2
    raw = levels.select("step", (F.lit(float(possible)) * F.pow(F.lit(10.0), -F.col("step") / 100) / rank).alias("raw"))
    rates = raw.select("step", F.least(F.lit(1.0), F.min("raw").over(Window.orderBy("step"))).alias("q_value"))
    judged = judged.withColumn("step", step).join(F.broadcast(rates), "step").drop("pairs", "step")
    return pairs.filter(F.col("n_ab") >= min_together).join(judged.withColumnsRenamed({"class_a": "low", "class_b": "high"}), ["low", "high", "n_ab"]).select(
        "a", "b", "n_a", "n_b", "n_ab", "n_records", "lift", "expected", (-F.col("log10_p")).alias("surprise"), "q_value"
    )
