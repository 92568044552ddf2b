"""Filling containers of a fixed capacity by a grouping genetic algorithm (problem 8).

A text longer than a container is cut into parts: full containers and a rest; no
other text is split. Parts are dealt at random to blocks of about ``BLOCK`` parts,
so that each block has the size mix of the whole. A block is packed by ``ISLANDS``
populations, each one task group. Populations start from best fit in random order. A
child takes whole well-filled bins of one parent, drops its duplicates from the
other, loses a few bins at random, and best-fits the displaced parts, largest first.
After an epoch each island sends its best solution to the next one; after the last the
best island of a block wins. An island rests once it has as few bins as the sum of
the sizes allows.

A block leaves a badly filled container or two. These (under ``LOOSE`` full) are
dissolved, their parts are dealt to blocks of their own and packed the same way, so
what is lost is one container in about ``BLOCK`` loose parts and not one a block.

Defined results: NULL and empty texts have no tokens and are placed as parts of
size 0; rows with a NULL id are placed like others; repeated ids are separate
parts, told apart by ``copy_no`` (of a NULL id the number of the row); an empty table
gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wirelake.llm import tokenizer
from wirelake.session import materialize

BLOCK = 3000
ISLANDS = 3
EPOCHS = 4
POPULATION = 8
CHILDREN = 60
WELL_FILLED, LOOSE = 0.995, 0.97
MUTATION = 0.05


def best_fit(sizes: np.ndarray, items: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Best-fit decreasing of ``items`` into the bins with ``room``; writes to ``bins``."""
    free = sorted((r, b) for b, r in enumerate(room) if r > 0)
    for i in items[np.argsort(-sizes[items], kind="stable")].tolist():
        s = int(sizes[i])
        k = bisect_left(free, (s, -1))
        if k < len(free):
            r, b = free.pop(k)
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        bins[i], room[b] = b, r - s
        if r - s > 0:
            insort(free, (r - s, b))


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> float:
    """Mean square of the fill: for one number of parts, higher with fewer and fuller bins."""
    fill = np.bincount(bins, weights=sizes) / capacity if len(bins) else np.zeros(1)
    fill = fill[np.bincount(bins, minlength=len(fill)) > 0] if len(bins) else fill
    return float((fill**2).mean()) if len(fill) else 0.0


def compact(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int64)


def decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Best-fit decreasing: the measure the search is compared with, no part of it."""
    bins = np.full(len(sizes), -1, dtype=np.int64)
    best_fit(sizes, np.arange(len(sizes)), bins, [], capacity)
    return compact(bins)


def seed_solution(sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Best fit of the parts in random order."""
    bins, room, free = np.full(len(sizes), -1, dtype=np.int64), 0, []
    for i in rng.permutation(len(sizes)).tolist():
        s = int(sizes[i])
        k = bisect_left(free, (s, -1))
        if k < len(free):
            r, b = free.pop(k)
        else:
            r, b, room = capacity, room, room + 1
        bins[i] = b
        if r - s > 0:
            insort(free, (r - s, b))
    return compact(bins)


def crossover(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """``a`` with whole well-filled bins of ``b`` injected."""
    fill_b = np.bincount(b, weights=sizes) / capacity
    pick = (fill_b >= np.quantile(fill_b, 0.3)) & (rng.random(len(fill_b)) < rng.choice([0.1, 0.3, 0.5]))
    injected = pick[b]
    # bins of a that hold an injected part dissolve, as do most poorly filled ones and a few others
    fill_a = np.bincount(a, weights=sizes) / capacity
    broken = (fill_a < WELL_FILLED) & (rng.random(len(fill_a)) < 0.7) | (rng.random(len(fill_a)) < MUTATION)
    broken[a[injected]] = True
    child = np.full(len(a), -1, dtype=np.int64)
    child[injected] = b[injected]
    kept = ~injected & ~broken[a]
    child[kept] = a[kept] + len(fill_b)
    placed = child >= 0
    child[placed] = compact(child[placed])
    n = int(child.max()) + 1 if placed.any() else 0
    room = (capacity - np.bincount(child[placed], weights=sizes[placed], minlength=n)).astype(np.int64).tolist()
    best_fit(sizes, np.flatnonzero(~placed), child, room, capacity)
    return compact(child)


def evolve(sizes: np.ndarray, capacity: int, seeds: list[np.ndarray], rng: np.random.Generator, children: int = CHILDREN) -> np.ndarray:
    """One epoch on one island: the best solution found."""
    if not len(sizes):
        return np.zeros(0, dtype=np.int64)
    bound = -(-int(sizes.sum()) // capacity)
    done = [s for s in seeds if int(s.max()) + 1 <= bound]
    if done:
        return max(done, key=lambda s: fitness(sizes, s, capacity))
    pop = list(seeds)
    while len(pop) < POPULATION:
        pop.append(seed_solution(sizes, capacity, rng))
    score = [fitness(sizes, p, capacity) for p in pop]
    for _ in range(children):
        if int(pop[int(np.argmax(score))].max()) + 1 <= bound:
            break
        i = int(np.argmax(rng.random(len(pop)) * score))
        j = int(rng.integers(len(pop) - 1))
        child = crossover(pop[i], pop[j + (j >= i)], sizes, capacity, rng)
        worst, f = int(np.argmin(score)), fitness(sizes, child, capacity)
        if f > score[worst]:
            pop[worst], score[worst] = child, f
    return pop[int(np.argmax(score))]


_STATE = "block int, island int, row_key bigint, part_no int, size bigint, bin bigint, score double"


def _epoch(capacity: int, number: int):
    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        block, island = int(key[0]), int(key[1])
        rng = np.random.default_rng([block, island, number])
        froms = np.sort(g["from_island"].unique())
        g = g.sort_values(["from_island", "row_key", "part_no"], kind="stable")
        first = g[g["from_island"] == froms[0]]
        sizes = first["size"].to_numpy(dtype=np.int64)
        seeds = [] if number == 0 else [compact(g.loc[g["from_island"] == f, "bin"].to_numpy()) for f in froms]
        best = evolve(sizes, capacity, seeds, rng)
        return pd.DataFrame(
            {"block": block, "island": island, "row_key": first["row_key"].to_numpy(), "part_no": first["part_no"].to_numpy(), "size": sizes, "bin": best, "score": fitness(sizes, best, capacity)}
        )

    return run


def _search(parts: DataFrame, capacity: int, blocks: int, tag: str) -> DataFrame:
    """``parts(row_key, part_no, size)`` to ``row_key, part_no, size, block, bin``."""
    dealt = parts.select("row_key", "part_no", "size", F.pmod(F.xxhash64("row_key", "part_no"), F.lit(blocks)).cast("int").alias("block"))
    islands = F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)]))
    state = dealt.select("*", islands.alias("island"), F.lit(0).cast("bigint").alias("bin")).withColumn("from_island", F.col("island"))
    for number in range(EPOCHS):
        best = state.groupBy("block", "island").applyInPandas(_epoch(capacity, number), _STATE)
        moves = F.array(F.col("island"), (F.col("island") + 1) % ISLANDS)
        state = best.withColumn("from_island", F.col("island")).withColumn("island", F.explode(F.array_distinct(moves)))
    best = materialize(best, tag)
    win = best.groupBy("block").agg(F.max_by("island", F.struct("score", -F.col("island"))).alias("island"))
    return best.join(win, ["block", "island"], "left_semi").select("row_key", "part_no", "size", "block", "bin")


def pack(parts: DataFrame, capacity: int, block_size: int = BLOCK) -> DataFrame:
    """``parts(row_key, part_no, size)``, sizes up to the capacity, to ``row_key, part_no, container``."""
    blocks = max(1, round(parts.count() / block_size))
    first = _search(parts, capacity, blocks, "p8-first")
    name = F.concat_ws("-", "block", "bin")
    if blocks == 1:
        return first.select("row_key", "part_no", name.alias("container"))
    loose = first.groupBy("block", "bin").agg(F.sum("size").alias("n")).filter(F.col("n") < LOOSE * capacity).select("block", "bin")
    again = materialize(first.join(loose, ["block", "bin"], "left_semi").select("row_key", "part_no", "size"), "p8-loose")
    second = _search(again, capacity, max(1, round(again.count() / block_size)), "p8-second")
    kept = first.join(loose, ["block", "bin"], "left_anti").select("row_key", "part_no", name.alias("container"))
    return kept.unionByName(second.select("row_key", "part_no", F.concat(F.lit("loose-"), name).alias("container")))


def p8_pack(docs: DataFrame, limits: DataFrame, task: str, folder: str = tokenizer.TOKENIZER_DIR) -> DataFrame:
    """All documents in containers of the task's capacity.

    One row per part: ``doc_id, copy_no, part_no, first_token, n_tokens, container_id``.
    """
    lim = limits.filter(F.col("task") == task).first()
    capacity = int(lim["max_tokens"])
    sized = tokenizer.counts(docs, lim["tokenizer"], folder=folder)
    sized = materialize(sized.withColumn("row_key", F.monotonically_increasing_id()), "p8-sizes")
    cut = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / capacity)).cast("int")
    parts = sized.select("doc_id", "row_key", "n_tokens", F.explode(F.sequence(F.lit(0), cut - 1)).alias("part_no")).select(
        "doc_id",
        "row_key",
        "part_no",
        (F.col("part_no") * capacity).cast("bigint").alias("first_token"),
        F.least(F.lit(capacity), F.col("n_tokens") - F.col("part_no") * capacity).cast("bigint").alias("size"),
    )
    packed = pack(parts.filter(F.col("size") < capacity).select("row_key", "part_no", "size"), capacity)
    # rows with a NULL id are no copies of each other, and so are no one group
    copies = Window.partitionBy("doc_id", "part_no", F.when(F.col("doc_id").isNull(), F.col("row_key"))).orderBy("row_key")
    copy_no = F.when(F.col("doc_id").isNull(), F.col("row_key")).otherwise(F.row_number().over(copies) - 1)
    return parts.join(packed, ["row_key", "part_no"], "left").select(
        "doc_id",
        copy_no.alias("copy_no"),
        "part_no",
        "first_token",
        F.col("size").alias("n_tokens"),
        F.coalesce("container", F.concat_ws("-", F.lit("full"), "row_key", "part_no")).alias("container_id"),
    )


def p8_fill(placed: DataFrame, capacity: int) -> DataFrame:
    """Report: ``containers, tokens, capacity, fill``."""
    per = placed.groupBy("container_id").agg(F.sum("n_tokens").alias("n"))
    return per.agg(F.count(F.lit(1)).alias("containers"), F.sum("n").alias("tokens"), F.max("n").alias("fullest")).withColumn("capacity", F.lit(capacity)).withColumn("fill", F.col("tokens") / (F.col("containers") * F.col("capacity")))
