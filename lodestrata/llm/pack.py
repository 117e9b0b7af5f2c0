"""Problem 8: items packed into containers of fixed capacity by minimum bin slack."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.tokens import VOCABULARY, token_count
from lodestrata.session import settle

#: Items that one task numbers, and capacities that are planned on the driver, at most.
SALTED, MOST_CAPACITIES = 100_000, 1000


def fill(sizes: list[int], counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of remaining sizes that comes closest to ``capacity``: size -> how many.

    Subset sums as a bitset: bit s says that s can be reached. Sizes are added from large to small, each as often as it
    is left (in powers of two), until the capacity itself is reached; the counts are found by going back over the bitsets.
    """
    mask, reach, steps = (1 << capacity + 1) - 1, 1, []
    for size in sizes:
        left, chunk = min(counts[size], capacity // size), 1
        while left > 0:
            take = min(chunk, left)
            steps.append((size, take, reach))
            reach |= reach << size * take & mask
            left -= take
            chunk *= 2
        if reach >> capacity & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for size, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[size] = chosen.get(size, 0) + take
            at -= size * take
    return chosen


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """``(times, contents)`` of the containers for sizes in 1..capacity: each container starts with the largest size left
    and is filled to the least slack; the same filling is repeated while its items last. Every entry uses
    up some size, so there are at most as many entries as sizes, however many items."""
    left = {s: n for s, n in histogram.items() if n > 0 and 0 < s <= capacity}
    sizes, out = sorted(left, reverse=True), []
    while sizes:
        seed = sizes[0]
        left[seed] -= 1
        rest = capacity - seed
        chosen = fill([s for s in sizes if s <= rest and left[s]], left, rest) if rest else {}
        left[seed] += 1
        contents = dict(chosen)
        contents[seed] = contents.get(seed, 0) + 1
        times = min(left[s] // k for s, k in contents.items())
        for s, k in contents.items():
            left[s] -= k * times
        out.append((times, contents))
        sizes = [s for s in sizes if left[s]]
    return out


def slots(patterns: list[tuple[int, dict[int, int]]]) -> tuple[dict[int, np.ndarray], int]:
    """By size, rows ``first rank, how many a container, first container, place before`` in order of rank; the number of containers."""
    rows: dict[int, list] = {}
    given: dict[int, int] = {}
    base = 0
    for times, contents in patterns:
        offset = 0
        for size, k in sorted(contents.items(), reverse=True):
            rows.setdefault(size, []).append((given.get(size, 0), k, base, offset))
            given[size] = given.get(size, 0) + k * times
            offset += k * size
        base += times
    return {s: np.array(r, np.int64) for s, r in rows.items()}, base


def pack(rows: DataFrame, sizes: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``pack_name, capacity_tokens, container, place, <key>, piece, first_token, tokens``: every item in a container, for each capacity.

    An item larger than the capacity fills containers of its own with all but its last piece, which is packed as an
    item; no other is split. Only the histogram of sizes, of at most one row a token of the capacity, comes to the
    driver; items find their slot by their rank within their size, numbered over salts, so many items of one size are no single
    task. Texts of no tokens, null ones too, take no room and go to container 0. Capacities below 1 or null are left out; rows are items, repeated or not.
    """
    plans = {}
    items = settle(rows.select(F.col(key).alias("key"), token_count(vocabulary)(F.col(text)).alias("size")))
    names = sizes.select("pack_name", F.col("capacity_tokens").cast("int").alias("capacity_tokens")).filter("capacity_tokens > 0").distinct()
    wanted = [(str(r[0]), r[0]) for r in names.select("capacity_tokens").distinct().limit(MOST_CAPACITIES + 1).collect()]
    if len(wanted) > MOST_CAPACITIES:
        raise ValueError(f"more than {MOST_CAPACITIES} capacities")
    salts = 1 << max(0, -(-items.count() // SALTED) - 1).bit_length()  # so that the items of one size are never more than a task can number
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("pack_name"), F.lit(c).cast("int").alias("capacity_tokens")) for n, c in wanted or [("none", 1)]]))
    per = (items if wanted else items.limit(0)).select("*", each.alias("w")).select("key", "size", "w.*")
    rest = F.when(F.col("size") > 0, F.pmod(F.col("size") - 1, F.col("capacity_tokens")) + 1).otherwise(0)
    per = per.withColumn("rest", rest.cast("int")).withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int"))
    cells = per.groupBy("pack_name", "capacity_tokens", "rest", "salt").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size") - F.col("rest")).alias("over"))
    cells = settle(cells)
    offsets = cells.withColumn("before", F.sum("n").over(Window.partitionBy("pack_name", "rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = offsets.select("pack_name", "rest", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    by_size = cells.groupBy("pack_name", "capacity_tokens", "rest").agg(F.sum("n").alias("n"), F.sum("over").alias("over"))
    whole = {}
    for name, capacity in wanted:
        histogram = {r["rest"]: r["n"] for r in by_size.filter(F.col("capacity_tokens") == capacity).collect()}
        plans[name], whole[name] = slots(plan(histogram, capacity))
    shared = items.sparkSession.sparkContext.broadcast((plans, whole))
    rank = F.row_number().over(Window.partitionBy("pack_name", "rest", "salt").orderBy("key")) - 1
    ranked = per.withColumn("own", rank).join(offsets, ["pack_name", "rest", "salt"]).withColumn("rank", F.col("own") + F.col("before"))
    # full pieces of large items take the containers after the packed ones, numbered over salts likewise
    ahead = cells.groupBy("pack_name", "capacity_tokens", "salt").agg((F.sum("over") / F.col("capacity_tokens")).cast("bigint").alias("full"))
    ahead = ahead.withColumn("ahead", F.coalesce(F.sum("full").over(Window.partitionBy("pack_name").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    kind = dict(items.dtypes)["key"]

    def place(batches):
        known, _ = shared.value
        for batch in batches:
            container, at = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for (name, size), group in batch.reset_index(drop=True).groupby(["pack_name", "rest"], dropna=False):
                if size == 0:
                    continue
                table = known[name][int(size)]
                ranks = group["rank"].to_numpy(np.int64)
                row = table[np.searchsorted(table[:, 0], ranks, "right") - 1]
                container[group.index] = row[:, 2] + (ranks - row[:, 0]) // row[:, 1]
                at[group.index] = row[:, 3] + (ranks - row[:, 0]) % row[:, 1] * int(size)
            yield batch[["pack_name", "capacity_tokens"]].reset_index(drop=True).assign(container=container, place=at, key=batch["key"].to_numpy(), piece=((batch["size"] - batch["rest"]) // batch["capacity_tokens"]).to_numpy(), first_token=(batch["size"] - batch["rest"]).to_numpy(), tokens=batch["rest"].to_numpy())

    shape = f"pack_name string, capacity_tokens int, container bigint, place bigint, key {kind}, piece bigint, first_token bigint, tokens bigint"
    last = ranked.select("pack_name", "capacity_tokens", "key", "size", "rest", "rank").mapInPandas(place, shape)
    large = per.filter(F.col("size") > F.col("capacity_tokens")).withColumn("full", ((F.col("size") - F.col("rest")) / F.col("capacity_tokens")).cast("bigint"))
    within = F.coalesce(F.sum("full").over(Window.partitionBy("pack_name", "salt").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    large = large.withColumn("within", within).join(ahead.select("pack_name", "salt", "ahead"), ["pack_name", "salt"])
    packed = F.create_map(*[x for name, _ in wanted for x in (F.lit(name), F.lit(whole[name]))])[F.col("pack_name")] if wanted else F.lit(0)
    pieces = large.select("pack_name", "capacity_tokens", "key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full") - 1)).alias("piece"), (packed + F.col("ahead") + F.col("within")).alias("from"))
    full = pieces.select(
        "pack_name", "capacity_tokens", (F.col("from") + F.col("piece")).cast("bigint").alias("container"), F.lit(0).cast("bigint").alias("place"), "key", "piece",
        (F.col("piece") * F.col("capacity_tokens")).alias("first_token"), F.col("capacity_tokens").cast("bigint").alias("tokens"),
    )
    placed = last.unionByName(full).drop("pack_name").withColumnRenamed("key", key)
    return placed.join(F.broadcast(names), "capacity_tokens").select("pack_name", "capacity_tokens", "container", "place", key, "piece", "first_token", "tokens")


def filling(packed: DataFrame) -> DataFrame:
    """``pack_name, capacity_tokens, containers, tokens, least_containers, fill``: how well each capacity is used."""
    used = packed.filter("tokens > 0").groupBy("pack_name", "capacity_tokens", "container").agg(F.sum("tokens").alias("used"))
    total = used.groupBy("pack_name", "capacity_tokens").agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
    return total.select("pack_name", "capacity_tokens", "containers", "tokens", F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least_containers"), "fullest", (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("fill"))
