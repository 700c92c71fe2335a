"""What each quality filter removes in every order the filters can stand in.

A document's failures are bits of a mask, and everything an order does to it follows from the
mask. So documents are only counted by (part, mask, label), and the orders are worked out on
those counts.

The bit of the repeated text needs the smallest id of every text. Each task counts the hashes
of its texts in a counting Bloom sketch; the tasks' sketches are added up piece by piece. A
text that has a slot counted once is unique for certain; only the others, the possible
repeats, are shuffled by the digest of their whole text to find the smallest id.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import WORD, staged, table, tidy

LETTERS = "ABCDE"
REPEAT = "E"

# The sketch: slots a document, hashes a document, slots of a piece, lanes that pieces are
# added up in first. Beyond MOST_SLOTS (a broadcast of 32 MB) the sketch clears fewer texts;
# results stay the same, as every text that is not cleared is compared.
SLOTS_A_ROW, HASHES, PIECE, LANES = 16, 4, 20, 16
MOST_SLOTS, LEAST_SLOTS = 1 << 28, 1 << PIECE
AT_ONCE = 1 << 20  # hashes a task holds before it writes pieces

PIECES = "piece int, lane int, once binary, more binary"


def failures(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that look at one text alone; ``words`` is a column."""
    total, different = F.size("words"), F.size(F.array_distinct("words"))
    return {
        "A": total < 100,
        "B": 100 * different.cast("long") < 80 * total.cast("long"),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 10 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


# ---- the sketch -----------------------------------------------------------------


def slot_count(rows: int) -> int:
    wanted = 1 << max(0, rows * SLOTS_A_ROW - 1).bit_length()
    return min(MOST_SLOTS, max(LEAST_SLOTS, wanted))


def _slots(keys: np.ndarray, slots: int) -> np.ndarray:
    """Slots of each key, one row per key; a key's slots all differ."""
    key = keys.astype(np.int64).view(np.uint64)
    step = (key >> np.uint64(32)) | np.uint64(1)
    turns = np.arange(HASHES, dtype=np.uint64)
    return (key[:, None] + turns[None, :] * step[:, None]) & np.uint64(slots - 1)


def _pieces(keys: list[np.ndarray], slots: int, lane: int) -> pa.RecordBatch:
    """One row per touched piece: its slots counted once, and those counted more often."""
    used, counts = np.unique(_slots(np.concatenate(keys), slots), return_counts=True)
    piece, place = (used >> np.uint64(PIECE)).astype(np.int32), (used & np.uint64((1 << PIECE) - 1)).astype("<u4")
    starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    once, more, ends = [], [], np.r_[starts[1:], len(piece)]
    for a, b in zip(starts, ends):
        single = counts[a:b] == 1
        once.append(place[a:b][single].tobytes())
        more.append(place[a:b][~single].tobytes())
    lanes = np.full(len(starts), lane, np.int32)
    columns = [pa.array(piece[starts], pa.int32()), pa.array(lanes), pa.array(once, pa.binary()), pa.array(more, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["piece", "lane", "once", "more"])


def _sketch_of(slots: int):
    """The sketch of one task's keys."""

    def over(batches):
        lane, held, size = TaskContext.get().partitionId() % LANES, [], 0
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            if not len(keys):
                continue
            held.append(keys)
            size += len(keys)
            if size >= AT_ONCE:
                yield _pieces(held, slots, lane)
                held, size = [], 0
        if held:
            yield _pieces(held, slots, lane)

    return tidy(over)


def _added(pieces: pa.Table) -> np.ndarray:
    """Counters of one piece from several sketches, at most 2."""
    counts = np.zeros(1 << PIECE, np.uint8)
    for name, step in (("once", 1), ("more", 2)):
        for part in pieces.column(name):
            at = np.frombuffer(part.as_py(), "<u4")
            counts[at] = np.minimum(counts[at] + step, 2)
    return counts


def _merge(pieces: pa.Table) -> pa.Table:
    counts = _added(pieces)
    once, more = (np.flatnonzero(counts == n).astype("<u4").tobytes() for n in (1, 2))
    piece = pieces.column("piece")[0].as_py()
    return pa.table([pa.array([piece], pa.int32()), pa.array([0], pa.int32()), pa.array([once], pa.binary()), pa.array([more], pa.binary())], ["piece", "lane", "once", "more"])


def _plane(pieces: pa.Table) -> pa.Table:
    """The bits of the slots counted more than once."""
    bits = np.packbits(_added(pieces) == 2, bitorder="little").tobytes()
    return pa.table([pa.array([pieces.column("piece")[0].as_py()], pa.int32()), pa.array([bits], pa.binary())], ["piece", "bits"])


def repeat_filter(keys: DataFrame, rows: int):
    """A test on a hash column: false when no other row of ``keys`` has the same hash.

    ``keys`` has one column of hashes without nulls. The sketch has ``slot_count(rows)``
    slots, so what the driver receives and sends on is at most 32 MB.
    """
    slots = slot_count(rows)
    parts = keys.mapInArrow(_sketch_of(slots), PIECES)
    lanes = parts.groupBy("piece", "lane").applyInArrow(tidy(_merge), PIECES)
    found = lanes.groupBy("piece").applyInArrow(tidy(_plane), "piece int, bits binary").collect()
    plane, width = np.zeros(slots >> 3, np.uint8), 1 << (PIECE - 3)
    for row in found:
        plane[row["piece"] * width : (row["piece"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    shared = keys.sparkSession.sparkContext.broadcast(plane)

    @F.pandas_udf("boolean")
    def possible(column):
        at = _slots(column.to_numpy(), slots)
        crowded = shared.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1
        return pd.Series(crowded.all(axis=1))

    return possible


# ---- masks, counts, orders ------------------------------------------------------


def masks(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, mask)`` of every row, bit i for the i-th filter.

    Rows without a ``doc_id`` are never a repeat and make none. A null text is the empty one.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    key = F.xxhash64("text")
    possible = repeat_filter(rows.select(key.alias("key")), rows.count())
    spelled = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).withColumn("key", key)
    bits = sum(
        (F.when(failed, F.lit(1 << LETTERS.index(letter))).otherwise(F.lit(0)) for letter, failed in failures(F.col("text")).items()),
        F.lit(0),
    )
    digest = F.when(possible("key"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    base = staged(spelled.select("doc_id", "part", bits.alias("mask"), digest.alias("digest")))
    unsure = base.where("digest is not null and doc_id is not null")
    first = unsure.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = staged(first.select("digest", "first"))
    repeat = F.when(F.col("doc_id") > F.col("first"), F.lit(1 << LETTERS.index(REPEAT))).otherwise(F.lit(0))
    marked = unsure.join(first, "digest", "left").select("doc_id", "part", (F.col("mask") + repeat).alias("mask"))
    return base.where("digest is null or doc_id is null").select("doc_id", "part", "mask").unionByName(marked)


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, good, toxic, n)``: documents by what they fail and how they are labelled.

    A document with several labels is good, or toxic, when one of them says so. Rows of one
    id are counted before they meet their label.
    """
    per_id = masks(docs).groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id is not null")
    known = known.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    flags = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    joined = per_id.join(known, "doc_id", "left").select("part", "mask", *flags, "n")
    return joined.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def _bits(letters: Column) -> Column:
    """The mask of a string of filter letters."""
    bit = lambda c: F.when(letters.contains(c), F.lit(1 << LETTERS.index(c))).otherwise(F.lit(0))
    return sum((bit(c) for c in LETTERS), F.lit(0))


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the mask counts.

    Every part has all orders and steps, zeros included. 120 orders of five steps meet at
    most 128 counts a part.
    """
    orders = ["".join(p) for p in itertools.permutations(LETTERS)]
    steps = F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step")
    rows = staged(counts).select("*", F.explode(F.lit(orders)).alias("filter_order")).select("*", steps)
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    rows = rows.withColumn("letter", letter).withColumn("own", _bits(letter))
    rows = rows.withColumn("earlier", _bits(F.substring("filter_order", F.lit(1), F.col("step") - 1)))
    mask, own, earlier = F.col("mask"), F.col("own"), F.col("earlier")
    fails, gone = mask.bitwiseAND(own) != 0, mask.bitwiseAND(earlier) != 0
    removed = fails & ~gone

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0))).cast("long")

    table_ = rows.groupBy("part", "filter_order", "step", "letter").agg(
        total(~fails & ~gone).alias("kept"),
        total(removed).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == own).alias("unique_fails"),
        total(removed & (F.col("good") == 1)).alias("good_lost"),
        total(removed & (F.col("toxic") == 1)).alias("toxic_lost"),
    )
    # 600 rows a part.
    return table_.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))).drop("letter")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What the five filters do to the documents in every order, per part.

    Null texts are empty, a null ``lang`` is the part ''. Repeated rows count each; of rows
    with one text and one id none is a repeat of the other. Rows without an id count, are no
    repeats and have no label. Texts are taken whole. No documents give no rows; documents
    without labels lose none that is good or toxic. Other columns are left out.
    """
    return interactions(mask_counts(docs, labels))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """All documents and labels."""
    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))
