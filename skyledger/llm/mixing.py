"""Mixing sources to target weights by the cube method.

Every document has an expected number of copies, its source's target over its source's
size. The whole part is taken as it is. The fractional part is an inclusion probability,
and the cube method turns it into 0 or 1: three documents at a time, the probabilities
move along the one direction that keeps both the number of documents and the sum of their
sizes, until one of them is settled. A block of documents leaves at most two unsettled,
besides its ten smallest, which wait. What is open in the blocks is joined and the flight
goes on; at the end of a source its last dozen land on the combination closest to its target.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import SAFE, WORD, own_ids, staged, table, whole_ids

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BLOCK = 20_000
LANDING = 10
FEW = 10_000  # sources whose targets are sent to every task

SHAPE = "doc_id long, source string, size long, source_size long, target double, copies int, chance double, block int"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; excess is shared again."""
    goal, open_ = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    left = total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit >= most * sizes[i]]
        if not full:
            for i in open_:
                goal[i] = weights[i] * unit
            break
        for i in full:
            goal[i] = most * sizes[i]
            left -= goal[i]
        open_ = [i for i in open_ if i not in full]
    return goal


def flight(chance: np.ndarray, size: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Moves the chances to 0 or 1, keeping their sum and the size-weighted sum; at most two stay open."""
    p, s = chance.tolist(), size.tolist()
    waiting = [i for i, x in enumerate(p) if 0.0 < x < 1.0][::-1]
    held: list[int] = []
    draw = iter(draws.tolist())
    while True:
        while len(held) < 3 and waiting:
            held.append(waiting.pop())
        pair = len(held) == 2 and s[held[0]] == s[held[1]]
        if len(held) < 3 and not pair:
            break
        if pair:
            i, j = held
            way = ((i, 1.0), (j, -1.0))
        else:
            i, j, k = held
            way = ((i, float(s[j] - s[k])), (j, float(s[k] - s[i])), (k, float(s[i] - s[j])))
            if s[i] == s[j]:
                way = ((i, 1.0), (j, -1.0))
        way = tuple(x for x in way if x[1])
        up = min((1.0 - p[n]) / d if d > 0 else p[n] / -d for n, d in way)
        down = min(p[n] / d if d > 0 else (1.0 - p[n]) / -d for n, d in way)
        step = up if next(draw) * (up + down) < down else -down
        for n, d in way:
            x = p[n] + step * d
            p[n] = 0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x
        held = [n for n in held if 0.0 < p[n] < 1.0]
    return np.array(p)


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The 0/1 choice for the last open documents whose size comes closest to what they stand for."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    ways = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    off = np.abs(ways @ size[open_] - (p[open_] * size[open_]).sum())
    count_off = np.abs(ways.sum(axis=1) - p[open_].sum())
    p = p.copy()
    p[open_] = ways[np.lexsort((count_off, off.round(6)))[0]]
    return p


def _fly(last: bool):
    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "size", "chance"], kind="stable", ignore_index=True)
        seed = [len(rows), int(rows["size"].sum()), int(last)]
        rng = np.random.Generator(np.random.PCG64(seed))
        order = rng.permutation(len(rows))
        rows = rows.iloc[order].reset_index(drop=True)
        size = rows["size"].to_numpy(np.int64)
        p = rows["chance"].to_numpy(float).copy()
        # The smallest documents stay out of the flight: they land the source finely.
        flying = np.sort(np.argsort(size, kind="stable")[LANDING:])
        p[flying] = flight(p[flying], size[flying], rng.random(2 * len(rows) + 8))
        rows["chance"] = landing(p, size) if last else p
        return rows

    return one


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block: int = BLOCK,
) -> DataFrame:
    """How many words of each document a weighted mix of the sources takes.

    ``weights`` repeat over the sources in code point order, the null source last. The mix
    has ``share`` times all words; a source gets at most ``most`` times its own. Null and
    empty texts have size 0 and are never taken. Rows with one doc_id are separate
    documents. No rows give no rows; other columns are left out of the result.

    Only one row per source reaches the driver. Documents are settled in blocks of about
    ``block`` rows spread by hash, so a source with a third of all rows is many tasks.
    """
    spark = docs.sparkSession
    sized = staged(docs.select(whole_ids(), F.col("source").cast("string"), word_count(F.col("text")).alias("size")))
    known = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    known.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in known]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(known))], share * sum(sizes), most)
    per_source = spark.createDataFrame(
        [(r["source"], r["size"], g, g / r["size"] if r["size"] else 0.0, -(-r["n"] // block)) for r, g in zip(known, goal)],
        f"{SAFE}source string, source_size long, target double, {SAFE}rate double, {SAFE}blocks int",
    )
    # One row per source, counted; beyond FEW sources Spark decides how to join it.
    per_source = F.broadcast(per_source) if len(known) <= FEW else per_source
    rows = sized.join(per_source, sized["source"].eqNullSafe(per_source[f"{SAFE}source"]))
    whole = F.floor(f"{SAFE}rate").cast("int")
    rows = rows.select(
        "doc_id", "source", "size", "source_size", "target",
        whole.alias("copies"),
        F.when(F.col("size") > 0, F.col(f"{SAFE}rate") - whole).otherwise(0.0).alias("chance"),
        F.pmod(F.xxhash64("doc_id", "size"), F.col(f"{SAFE}blocks").cast("long")).cast("int").alias("block"),
    )
    done = [rows.where("chance <= 0")]
    rest = rows.where("chance > 0")
    most_blocks = max([1, *(-(-r["n"] // block) for r in known)])
    while most_blocks > 1:
        flown = staged(rest.groupBy("source", "block").applyInPandas(_fly(False), SHAPE))
        done.append(flown.where("chance <= 0 or chance >= 1"))
        most_blocks = -(-(LANDING + 2) * most_blocks // block)
        rest = flown.where("chance > 0 and chance < 1").withColumn("block", F.pmod("block", F.lit(most_blocks)))
    done.append(rest.groupBy("source").applyInPandas(_fly(True), SHAPE))
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    taken = (F.col("size") * (F.col("copies") + F.col("chance").cast("int"))).cast("long")
    return own_ids(result.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken")))


def resample(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` as the mix takes them: a document taken k times is k rows, all columns kept.

    Documents without words are never taken. Repeated rows share their copies evenly.
    """
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    ids = docs.select(key.alias("doc_id"), "source", "text")
    taken = mix(ids, **settings).where("taken > 0")
    # A key's rows share one source and size: their copies add up.
    taken = taken.groupBy(F.col("doc_id").alias("_llm_key"), F.col("source").alias("_llm_source")).agg(F.sum(F.col("taken") / F.col("size")).cast("int").alias("_llm_all"))
    keyed = docs.withColumn("_llm_own", key)
    joined = keyed.join(taken, (keyed["_llm_own"] == taken["_llm_key"]) & keyed["source"].cast("string").eqNullSafe(taken["_llm_source"]))
    group = Window.partitionBy("_llm_own", "_llm_source")
    rows = joined.withColumn("_llm_n", F.count(F.lit(1)).over(group)).withColumn("_llm_r", F.row_number().over(group.orderBy("_llm_key")))
    copies = F.expr("_llm_all div _llm_n + if(_llm_r <= _llm_all % _llm_n, 1, 0)").cast("int")
    return rows.select(*docs.columns, F.explode(F.array_repeat(F.lit(1), copies)).alias("_llm_copy")).select(*docs.columns)


def op10_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The mix over all documents: one row per document."""
    return mix(table(spark, folder, "documents")).drop("source")
