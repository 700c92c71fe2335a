"""Packing documents into token sequences with a grouping genetic algorithm.

The genes are whole bins. Crossover takes the well-filled bins of one parent into the
other, drops the bins that would then hold a document twice, and best-fits the documents
this displaces, largest first. Every shard of documents is worked on by several islands;
after an epoch each island's best packing moves on to the next island. What the shards
pack badly is pooled and packed again over all shards.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import gapless, own_ids, staged, table, tidy, whole_ids
from skyledger.llm.tokens import VOCABULARY, Encoder, remembering

CAPACITY = 2048
SHARD = 8_000  # pieces a shard holds, about
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 3
POPULATION = 3
WELL_FILLED = 0.98

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, text_key long"
Bins = list[list[int]]


def cut_lengths(total: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of a document's pieces: only a longer one is cut, its first piece takes the rest."""
    if total <= capacity:
        return [total]
    first = total % capacity
    return [first] * (first > 0) + [capacity] * (total // capacity)


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """The token pieces of every document; each ends with id 0."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with remembering(vocabulary) as code:
            yield from coded(batches, code)

    def coded(batches: Iterator[pd.DataFrame], code: Encoder) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, key in zip(batch["doc_id"], batch["text"], batch["text_key"]):
                ids = code.ids(text or "") + b"\0\0\0\0"
                at = 0
                for k, n in enumerate(cut_lengths(len(ids) // 4, capacity)):
                    out.append((doc_id, k, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]), key))
                    at += n
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])

    text = F.col("text").cast("string").alias("text")
    return own_ids(docs.select(whole_ids(), text, F.xxhash64("doc_id", "text").alias("text_key")).mapInPandas(tidy(cut), PIECES))


# ---- one island ---------------------------------------------------------------


def best_fit(items: list[int], size: list[int], bins: Bins, capacity: int) -> Bins:
    """Puts ``items``, largest first, each where it leaves the least room."""
    free = sorted((capacity - sum(size[i] for i in b), n) for n, b in enumerate(bins))
    free = [f for f in free if f[0] > 0]
    for i in sorted(items, key=lambda i: (-size[i], i)):
        need = size[i]
        at = bisect_left(free, (need, -1))
        if at == len(free):
            bins.append([i])
            room, n = capacity - need, len(bins) - 1
        else:
            room, n = free.pop(at)
            bins[n].append(i)
            room -= need
        if room > 0:
            insort(free, (room, n))
    return bins


def crossover(a: Bins, b: Bins, size: list[int], capacity: int, rng: np.random.Generator) -> Bins:
    """``a`` with a random share of the well-filled bins of ``b`` put in whole."""
    good = [x for x in b if sum(size[i] for i in x) >= WELL_FILLED * capacity]
    if good:
        good = [good[k] for k in np.flatnonzero(rng.random(len(good)) < rng.uniform(0.2, 0.7))]
    taken = {i for x in good for i in x}
    kept, displaced = [], []
    for x in a:
        if taken.isdisjoint(x):
            kept.append(x)
        else:
            displaced += [i for i in x if i not in taken]
    # The worst bins give their documents up too, so that these can meet others.
    kept.sort(key=lambda x: -sum(size[i] for i in x))
    spare = max(1, len(kept) // 20)
    displaced += [i for x in kept[len(kept) - spare :] for i in x]
    kept = kept[: len(kept) - spare]
    return best_fit(displaced, size, [list(x) for x in good] + [list(x) for x in kept], capacity)


def fitness(bins: Bins, size: list[int], capacity: int) -> float:
    """Fewer bins first; then fuller bins beside emptier ones."""
    return len(bins) - sum((sum(size[i] for i in x) / capacity) ** 2 for x in bins) / (len(bins) + 1)


def evolve(size: list[int], start: list[Bins], seed: int, capacity: int, generations: int, population: int) -> Bins:
    rng = np.random.Generator(np.random.PCG64(seed))
    least = -(-sum(size) // capacity)
    people = list(start)
    if not people:
        people.append(best_fit(list(range(len(size))), size, [], capacity))
    if len(people[0]) <= least:
        return people[0]
    while len(people) < population:
        # Another start: a random tenth of the documents goes in first.
        first = np.flatnonzero(rng.random(len(size)) < 0.1).tolist()
        rng.shuffle(first)
        bins: Bins = []
        chosen = set(first)
        for k in range(0, len(first), 2):
            pair = first[k : k + 2]
            bins += [pair] if sum(size[i] for i in pair) <= capacity else [[i] for i in pair]
        people.append(best_fit([i for i in range(len(size)) if i not in chosen], size, bins, capacity))
    people.sort(key=lambda x: fitness(x, size, capacity))
    for _ in range(generations):
        if len(people[0]) <= least:
            break
        children = []
        for _ in range(population):
            a, b = rng.choice(len(people), 2, replace=False)
            children.append(crossover(people[int(a)], people[int(b)], size, capacity, rng))
        people = sorted(people + children, key=lambda x: fitness(x, size, capacity))[:population]
    return people[0]


def _encode(bins: Bins, n: int) -> bytes:
    of = np.zeros(n, "<i4")
    for k, x in enumerate(bins):
        of[x] = k
    return of.tobytes()


def _decode(blob: bytes) -> Bins:
    of = np.frombuffer(blob, "<i4")
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order])) + 1
    return [x.tolist() for x in np.split(order, cuts)] if len(of) else []


ISLE = "shard int, island int, sizes binary, best binary"


def _settle(capacity: int, generations: int, population: int, epoch: int):
    """One epoch on every island: a row holds its shard's sizes and the packing that came to it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                size = np.frombuffer(row.sizes, "<i4").tolist()
                start = [_decode(x) for x in (row.best, row.elite) if x is not None]
                best = evolve(size, start, row.shard * 1009 + row.island * 31 + epoch, capacity, generations, population)
                yield pd.DataFrame([(row.shard, row.island, row.sizes, _encode(best, len(size)))], columns=["shard", "island", "sizes", "best"])

    return run


def _pack(items: DataFrame, shards: int, capacity: int, islands: int, epochs: int, generations: int, population: int) -> DataFrame:
    """``items`` (key, shard, length) with the bin of each: columns key, shard, length, bin."""
    ordered = staged(
        items.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct((-F.col("length")).alias("neg"), "key"))).alias("list"))
    )  # a shard holds SHARD pieces or so, by hash
    raw = ordered.select("shard", F.transform("list", lambda x: -x["neg"]).alias("lengths"))

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            blobs = [np.asarray(x, "<i4").tobytes() for x in batch["lengths"]]
            yield pd.DataFrame({"shard": batch["shard"], "sizes": blobs})

    isles = raw.mapInPandas(sizes, "shard int, sizes binary").select(
        "shard", F.explode(F.array(*[F.lit(k) for k in range(islands)])).alias("island"), "sizes"
    )
    state = isles.withColumn("best", F.lit(None).cast("binary")).withColumn("elite", F.lit(None).cast("binary"))
    for epoch in range(epochs):
        spread = state.repartition(max(1, min(shards * islands, 2000)), "shard", "island")
        best = staged(spread.mapInPandas(_settle(capacity, generations, population, epoch), ISLE))
        # The elite of each island goes to the next island of its shard.
        elite = best.select("shard", ((F.col("island") + 1) % islands).alias("island"), F.col("best").alias("elite"))
        state = best.join(elite, ["shard", "island"])

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, lengths, rows in zip(batch["shard"], batch["sizes"], batch["packings"]):
                size = np.frombuffer(lengths, "<i4").tolist()
                best = min((bytes(x) for x in rows), key=lambda x: (fitness(_decode(x), size, capacity), x))
                yield pd.DataFrame({"shard": [shard], "bins": [np.frombuffer(best, "<i4").tolist()]})

    chosen = state.groupBy("shard").agg(F.any_value("sizes").alias("sizes"), F.collect_list("best").alias("packings"))
    bins = chosen.mapInPandas(choose, "shard int, bins array<int>")
    both = ordered.join(bins, "shard").select("shard", F.explode(F.arrays_zip("list", "bins")).alias("x"))
    return both.select(F.col("x.list.key").alias("key"), "shard", (-F.col("x.list.neg")).alias("length"), F.col("x.bins").alias("bin"))


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    shard: int = SHARD,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    generations: int = GENERATIONS,
    population: int = POPULATION,
) -> DataFrame:
    """Packs every document into sequences of at most ``capacity`` tokens: one row per piece.

    A null or empty text is one piece with the single id 0. Rows with one doc_id are
    separate documents. An empty table gives no rows. Other columns are left out of the
    result. Full pieces are sequences of their own; the others are dealt to shards by hash
    of (document, piece, number), so no shard grows with a hot key.
    """
    cut = staged(pieces(docs, capacity, vocabulary))
    total = cut.where(F.col("length") < capacity).count()
    shards = max(1, -(-total // shard))
    buckets = max(256, -(-total // 20_000))
    # A row number makes repeated rows distinct; a key stands for its row from here on.
    keyed = staged(gapless(cut, [], ["text_key", "piece"], "key", buckets))
    loose = keyed.where(F.col("length") < capacity).select("key", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), F.col("length").cast("int").alias("length"))
    settings = dict(capacity=capacity, islands=islands, epochs=epochs, generations=generations, population=population)
    first = staged(_pack(loose, shards, **settings))
    if shards > 1:
        # Bins that are not well filled, over all shards, are opened and packed again.
        fill = first.groupBy("shard", "bin").agg(F.sum("length").alias("fill"))
        marked = first.join(fill, ["shard", "bin"])
        again = marked.where(F.col("fill") < WELL_FILLED * capacity)
        left = again.count()
        pools = max(1, -(-left // shard))
        pooled = again.select("key", F.pmod(F.xxhash64("key", F.lit(7)), F.lit(pools)).cast("int").alias("shard"), F.col("length").cast("int").alias("length"))
        second = staged(_pack(pooled, pools, **settings)) if left else None
        before = first.agg(F.count_distinct("shard", "bin")).first()[0]
        if second is not None:
            opened = again.agg(F.count_distinct("shard", "bin")).first()[0]
            closed = second.agg(F.count_distinct("shard", "bin")).first()[0]
            if closed < opened <= before:
                kept = marked.where(F.col("fill") >= WELL_FILLED * capacity)
                first = kept.select("key", "shard", "length", "bin").unionByName(second.withColumn("shard", -1 - F.col("shard")))
    place = offsets(first)
    # Sequence ids: loose bins interleave (shard, bin); full pieces continue with their own keys.
    placed = keyed.join(place, "key", "left")
    loose_id = F.col("shard").cast("long") * F.lit(1 << 32) + F.col("bin").cast("long")
    full_id = F.lit(1 << 62) + F.col("key")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.when(F.col("bin").isNull(), full_id).otherwise(loose_id).alias("sequence_id"),
        F.coalesce("offset", F.lit(0)).cast("long").alias("offset"),
    )


def offsets(binned: DataFrame) -> DataFrame:
    """Each key's place in its bin: the lengths before it. A bin holds ``capacity`` tokens at most."""
    before = Window.partitionBy("shard", "bin").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    return binned.select("key", "shard", "bin", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))


def op9_pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return pack(table(spark, folder, "documents"))

