"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine c are at squared distance 2 - 2c. The vectors are turned by a fixed
rotation and split into BLOCKS blocks of coordinates; if two are within a squared distance,
in one block at least they are within its share of it. So each block is range-joined on a
grid over its first coordinates, two blocks' candidates are one pair, and every candidate is
verified with the exact cosine of the original vectors.

A pair is charged to the first block in which it is within the share, which a task can tell
from the two vectors. So tasks add up numbers of links instead of writing links down, and
write at most one link per vector to connect the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import components, staged, table
from skyledger.llm.simhash import _union

SIMILARITY = 0.93
BLOCKS = 8
GRID = 2  # coordinates of a block that make its grid
CELL = 2.0  # width of a cell in radii
CHUNK = 4096  # vectors of a cell that meet in one task at a time
SLACK = 1e-9
ROWS = 1024


def usable(vector):
    """Vectors that can be compared: not null, not zero, all components finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(size: int) -> np.ndarray:
    """A fixed rotation: the orthogonal part of a seeded random matrix."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(7)).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, of the original vectors."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _blocks(size: int, blocks: int) -> list[slice]:
    edges = np.linspace(0, size, min(blocks, size) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


def _places(radius: float, blocks: int, cell: float, chunk: int):
    """Rows for every cell that a vector lies in (home) or reaches into from a smaller cell (guest)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            vectors = np.array(part["vector"].tolist(), float).reshape(len(part), -1)
            turned = unit(vectors) @ rotation(vectors.shape[1])
            width = cell * radius
            for b, block in enumerate(_blocks(vectors.shape[1], blocks)):
                lead = turned[:, block][:, :GRID]
                home = np.floor(lead / width).astype(np.int64)
                low = np.floor((lead - radius - SLACK) / width).astype(np.int64)
                high = np.floor((lead + radius + SLACK) / width).astype(np.int64)
                for step in product((-1, 0, 1), repeat=lead.shape[1]):
                    at = home + np.array(step)
                    own = not any(step)
                    # A pair in two cells meets in the larger of them.
                    if not own and next(s for s in step if s) < 0:
                        continue
                    keep = ((at >= low) & (at <= high)).all(axis=1) if not own else np.ones(len(at), bool)
                    if keep.any():
                        yield pd.DataFrame(
                            {
                                "label": part["label"][keep],
                                "block": b,
                                "cell": [x.tobytes() for x in at[keep].astype("<i8")],
                                "home": own,
                                "vid": part["vid"][keep],
                                "weight": part["weight"][keep],
                                "vector": part["vector"][keep],
                            }
                        )

    return run


def _compare(similarity: float, radius: float, blocks: int, size: int):
    limit = radius * radius + SLACK

    def shares(a: np.ndarray, b: np.ndarray, block: slice) -> np.ndarray:
        gap = np.ascontiguousarray(a[:, block] - b[:, block])
        return (gap * gap).sum(axis=1)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # Homes on the left, those of this cell that they are to meet on the right.
        left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
        same = bool(rows["same"].iloc[0])
        if not len(left) or not len(right) and not same:
            return pd.DataFrame({"vid": [], "links": [], "mate": []}).astype("int64")
        block_at = int(rows["block"].iloc[0])
        turn = rotation(size)
        splits = _blocks(size, blocks)

        def load(part: pd.DataFrame):
            v = np.array(part["vector"].tolist(), float).reshape(len(part), -1)
            return v, unit(v) @ turn, part["vid"].to_numpy(np.int64), part["weight"].to_numpy(np.int64)

        sides = [load(left)]
        if len(right):
            sides.append(load(right))
        ids = np.concatenate([s[2] for s in sides])
        links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        meetings = ([(0, 0)] if same else []) + ([(0, 1)] if len(right) else [])
        for x, y in meetings:
            (va, ta, _, wa), (vb, tb, _, wb) = sides[x], sides[y]
            off_b = len(va) if y else 0
            for i in range(0, len(va), ROWS):
                for j in range(i if x == y else 0, len(vb), ROWS):
                    a, b = ta[i : i + ROWS][:, splits[block_at]], tb[j : j + ROWS][:, splits[block_at]]
                    near = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T <= limit + SLACK
                    p, q = np.nonzero(near)
                    p, q = p + i, q + j
                    if x == y:
                        p, q = p[p < q], q[p < q]
                    keep = shares(ta[p], tb[q], splits[block_at]) <= limit
                    p, q = p[keep], q[keep]
                    for earlier in splits[:block_at]:
                        keep = shares(ta[p], tb[q], earlier) > limit
                        p, q = p[keep], q[keep]
                    keep = cosine(va[p], vb[q]) >= similarity
                    p, q = p[keep], q[keep]
                    if len(p):
                        np.add.at(links, p, wb[q])
                        np.add.at(links, q + off_b, wa[p])
                        label = _union(label, p, q + off_b)
        some = np.flatnonzero(links)
        return pd.DataFrame({"vid": ids[some], "links": links[some], "mate": ids[label[some]]})

    return run


def meetings(placed: DataFrame, chunk: int) -> DataFrame:
    """Rows of ``placed`` for every meeting (``meet``) of their cell: two chunks of homes, or a
    chunk of homes and one of guests, so no meeting grows with the cell.

    Homes are left in the meeting of their chunk with each other chunk from it on, and right in
    those from it back. Guests are right: those of chunk 0 in all meetings on the diagonal, the
    others in a meeting (homes' chunk, -chunk) with each chunk of homes. Left is side 0.
    """
    keys = ["label", "block", "cell"]
    parts = [F.greatest(F.lit(1), F.ceil(F.count_if(of) / chunk)).cast("int").alias(name) for of, name in ((F.col("home"), "chunks"), (~F.col("home"), "visits"))]
    # One chunk of each for most, more where a cell is full.
    full = placed.groupBy(*keys).agg(*parts).where("chunks > 1 or visits > 1")
    marked = placed.join(full, keys, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("visits", F.coalesce("visits", F.lit(1)))
    marked = marked.withColumn("own", F.pmod(F.xxhash64("vid", F.lit(3)), F.when(F.col("home"), F.col("chunks")).otherwise(F.col("visits"))).cast("int"))

    def at(rows: DataFrame, meets: str, side: int) -> DataFrame:
        return rows.withColumn("meet", F.explode(F.expr(meets))).withColumn("side", F.lit(side))

    homes, guests = marked.where("home"), marked.where("not home")
    lefts = at(homes, "transform(sequence(own, chunks - 1), x -> struct(own AS l, x AS r))", 0)
    rights = at(homes.where("own > 0"), "transform(sequence(0, own - 1), x -> struct(x AS l, own AS r))", 1)
    hosts = at(homes.where("visits > 1"), "transform(sequence(1, visits - 1), x -> struct(own AS l, -x AS r))", 0)
    first = at(guests.where("own = 0"), "transform(sequence(0, chunks - 1), x -> struct(x AS l, x AS r))", 1)
    others = at(guests.where("own > 0"), "transform(sequence(0, chunks - 1), x -> struct(x AS l, -own AS r))", 1)
    all_ = lefts.unionByName(rights).unionByName(hosts).unionByName(first).unionByName(others)
    return all_.withColumn("same", F.col("meet.l") == F.col("meet.r"))


def near_vectors(
    rows: DataFrame,
    similarity: float = SIMILARITY,
    blocks: int = BLOCKS,
    cell: float = CELL,
    chunk: int = CHUNK,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``rows``.

    Rows (vec_id, embedding, label) link when their labels are equal and not null and the
    cosine is at least ``similarity``. Vectors that are null, empty, zero, or hold a null or
    non-finite component link with nothing, nor do vectors of different length. Repeated rows
    link with each other. A row without vec_id keeps its row; it gives a class no name. An
    empty table gives no rows; other columns are left out of the result.

    Equal vectors of a label are one, with a weight, from the start. A cell with more homes or
    guests than ``chunk`` is compared chunk against chunk in separate tasks.
    """
    spark = rows.sparkSession
    vector = F.col("embedding").cast("array<double>")
    plain = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.when(usable(vector) & F.col("label").isNotNull(), vector).alias("vector"),
    )
    plain = staged(plain.withColumn("vid", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector"))))
    distinct = staged(
        plain.where("vid is not null")
        .groupBy("vid")
        .agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first"), F.any_value("label").alias("label"), F.any_value("vector").alias("vector"))
    )
    sizes = [r[0] for r in distinct.select(F.size("vector")).distinct().collect()]
    found = None
    budget = max(0.0, 2 - 2 * similarity)
    for size in sizes:
        radius = float(np.sqrt(budget / min(blocks, size)))
        place = _places(radius, blocks, cell, chunk)
        shape = "label string, block int, cell binary, home boolean, vid long, weight long, vector array<double>"
        placed = staged(distinct.where(F.size("vector") == size).select("label", "vid", "weight", "vector").mapInPandas(place, shape))
        all_ = meetings(placed, chunk)
        out = all_.groupBy("label", "block", "cell", "meet").applyInPandas(_compare(similarity, radius, blocks, size), "vid long, links long, mate long")
        found = out if found is None else found.unionByName(out)
    if found is None:
        found = spark.createDataFrame([], "vid long, links long, mate long")
    found = staged(found)
    counts = found.groupBy("vid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("vid").alias("a"), F.col("mate").alias("b")))
    named = distinct.select("vid", "first", "weight").join(roots, distinct["vid"] == roots["node"], "left").drop("node")
    named = named.withColumn("root", F.coalesce("root", "vid"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(lowest, "root").join(counts, "vid", "left").select(
        F.col("vid").alias("same"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    result = plain.select("vec_id", "vid").join(classes, F.col("vid") == F.col("same"), "left")
    component = F.when(F.col("vid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def op7_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of near-equal vectors within each label, over all embeddings."""
    return near_vectors(table(spark, folder, "embeddings"))
