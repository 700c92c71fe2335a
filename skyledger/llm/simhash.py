"""SimHash near-duplicates found through tables of distances to reference fingerprints.

A reference fingerprint with few bits set measures a fingerprint locally: its distance and
the distance to zero together tell how many of those bits are set. With references on
disjoint bits, two fingerprints that differ in at most d bits have equal distances to all
references of at least ``BANDS - d`` of ``BANDS`` groups of references. So fingerprints meet
when their distances agree on some choice of ``BANDS - d`` groups. Those that meet are
discarded when the distances to any of a second set of references differ by more than d, and
the rest are verified bit by bit.

Said plainly: candidates meet by equal blocks of bits, which is what those local distances
amount to. Only the second set of references discards by distances that are measured.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import components, discard, let_go, own_ids, staged, table, tidy, whole_ids

SHINGLE = 4
BITS = 4
BANDS = 7
BLOCK = 1024
SMALL = 64
AT_ONCE = 50_000  # rows compared together
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, width: int) -> list[bytes]:
    words = (text or "").encode().translate(LOWER).split()
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return [b" ".join(w) for w in zip(*[words[k:] for k in range(width)])]


def hashes(text: str | None, width: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, 42) for s in shingles(text, width)], np.uint64)


def fingerprint(values: np.ndarray) -> int:
    """Bits set in over half of the 64-bit values."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(values), 16_384):
        part = values[at : at + 16_384].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in range(64) if 2 * counts[k] > len(values))


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(hashes(t, width)) for t in batch["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": fps.view(np.int64)})

    ids = docs.select(whole_ids(), F.col("text").cast("string").alias("text"))
    return own_ids(ids.mapInPandas(tidy(run), "doc_id long, fp long"))


# ---- reference fingerprints ------------------------------------------------------


def agreeing(bits: int = BITS, bands: int = BANDS) -> list[int]:
    """Sets of single-bit references, one of which sees no difference between two
    fingerprints that differ in at most ``bits`` bits.

    The distance to the reference with only bit k set, less the distance to zero, is -1 or
    +1 by bit k: a fingerprint is its own table of these distances, and a set is a mask.
    """
    groups = [sum(1 << b for b in range(64) if b % bands == g) for g in range(bands)]
    return [sum(choice) for choice in combinations(groups, bands - bits)]


def dense_references(count: int = 24) -> list[int]:
    """References for discarding, from a fixed multiplicative sequence."""
    found, x = [], 0x9E3779B97F4A7C15
    for _ in range(count):
        x = (x * 6364136223846793005 + 1442695040888963407) & (2**64 - 1)
        found.append(x ^ (x >> 31))
    return found


def _distance(fp: np.ndarray, reference: int) -> np.ndarray:
    return np.bitwise_count(fp ^ np.uint64(reference)).astype(np.int16)


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the links a-b: each entry is the smallest of its set."""
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _survivors(fp: np.ndarray, pivots: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs left by the largest difference of their pivot distances, then verified."""
    for d in pivots:
        keep = np.abs(d[a] - d[b]) <= bits
        a, b = a[keep], b[keep]
        if not len(a):
            return a, b
    near = np.bitwise_count(fp[a] ^ fp[b]) <= bits
    return a[near], b[near]


def linked(key: np.ndarray, fp: np.ndarray, dense: list[int], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions a, b) that connect the rows of each key as all its links would.

    ``key`` is sorted. Small keys are compared at every distance of their rows, large ones
    block by block; either way at most one link per row leaves.
    """
    pivots = np.stack([_distance(fp, r) for r in dense])
    label = np.arange(len(fp))
    starts = np.append(0, np.flatnonzero(np.diff(key)) + 1)
    sizes = np.diff(np.append(starts, len(key)))
    small = np.repeat(sizes <= SMALL, sizes)
    for shift in range(1, SMALL):
        a = np.flatnonzero((key[:-shift] == key[shift:]) & small[:-shift])
        if not len(a):
            break
        a, b = _survivors(fp, pivots, a, a + shift, bits)
        if len(a):
            label = _union(label, a, b)
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        for i in range(start, start + size, BLOCK):
            for j in range(i, start + size, BLOCK):
                left, right = label[i : min(i + BLOCK, start + size)], label[j : min(j + BLOCK, start + size)]
                a, b = np.nonzero(left[:, None] != right[None, :])
                a, b = _survivors(fp, pivots, a + i, b + j, bits)
                if len(a):
                    label = _union(label, a, b)
    away = np.flatnonzero(label != np.arange(len(fp)))
    return away, label[away]


def _meet(fps: DataFrame, bits: int, masks: list[int], compare_keys) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column fp) that ``compare_keys`` finds among the
    rows of each key; there is a key for every mask and what its references see."""
    dense = dense_references()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for t, mask in enumerate(masks):
                key = ((fp & np.uint64(mask)) + np.uint64(t + 1)) * np.uint64(0x9E3779B97F4A7C15)
                key = ((key ^ (key >> np.uint64(30))) + np.uint64(t)) * np.uint64(0xBF58476D1CE4E5B9)
                key = (key ^ (key >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0)], names=["key", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_key, rest_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def settle(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a, b = compare_keys(key, fp.view(np.uint64), dense, bits)
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

        held, waiting = 0, []
        for batch in batches:
            waiting.append(batch)
            held += len(batch)
            if held < AT_ONCE:
                continue
            key = np.concatenate((rest_key, *[b.column(0).to_numpy() for b in waiting]))
            fp = np.concatenate((rest_fp, *[b.column(1).to_numpy() for b in waiting]))
            held, waiting = 0, []
            last = int(np.searchsorted(key, key[-1], side="left"))
            if last:
                yield settle(key[:last], fp[:last])
            rest_key, rest_fp = key[last:], fp[last:]
        rest_key = np.concatenate((rest_key, *[b.column(0).to_numpy() for b in waiting]))
        rest_fp = np.concatenate((rest_fp, *[b.column(1).to_numpy() for b in waiting]))
        if len(rest_key):
            yield settle(rest_key, rest_fp)

    met = fps.select("fp").distinct().mapInArrow(meet, "key long, fp long").repartition("key")
    return met.sortWithinPartitions("key", "fp").mapInArrow(compare, "a long, b long")


def links(fps: DataFrame, bits: int = BITS, masks: list[int] | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp), enough to connect what is linked.

    Fingerprints meet when the references of one of ``masks`` see no difference; without
    masks no pair within ``bits`` is missed. A meeting place is compared inside one task in
    blocks; what leaves it is at most one link per fingerprint, never all pairs.
    """
    return _meet(fps, bits, masks or agreeing(bits), linked)


def near_duplicates(docs: DataFrame, width: int = SHINGLE, bits: int = BITS, masks: list[int] | None = None) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` of every document.

    Documents link when their fingerprints differ in at most ``bits`` bits; component_id is
    the smallest doc_id reachable. Null, empty and blank texts have fingerprint zero and link
    like any other. Repeated rows stay separate rows of one component; a null doc_id keeps
    its row and names no component. An empty table gives no rows; other columns are left out.
    """
    marked = staged(fingerprints(docs, width))
    # One row per distinct fingerprint: exact copies, however many, are one from here on.
    distinct = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct, bits, masks))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(lowest, "root").select(F.col("fp").alias("same"), "component_id")
    return marked.join(classes, marked["fp"] == classes["same"]).drop("same")


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# ---- duplicates by verified similarity -----------------------------------------------

STAGE_SHINGLE = 5
STAGE_SIMILARITY = 0.8
FULL = np.iinfo(np.int64).max
SLOT_BITS = 20  # of a shingle's hash: the table of counts has a fixed size
MEETING = 4096  # texts of a shingle that meet in one task at a time
STARS = 8  # rounds in which large meetings are thinned by a leader, after the fingerprints
WORTH = 0.9  # of the pairs that met: a round that leaves more of them is the last one
AROUND = 4  # shingles of their own by which leaders of later rounds may be further off
ROUNDING = 1e-6


def jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) or len(y) else 1.0


def shingle_ranks(sets: DataFrame) -> np.ndarray:
    """A rank for every slot of shingle hashes, rare ones first."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(1 << SLOT_BITS, np.int64)
        for part in parts:
            for blob in part["shingles"]:
                np.add.at(held, (np.frombuffer(blob, "<u8") >> np.uint64(64 - SLOT_BITS)).astype(np.int64), 1)
        pieces = np.split(held, 64)
        some = [k for k, x in enumerate(pieces) if x.any()]
        yield pd.DataFrame({"piece": some, "counts": [pieces[k].astype("<i8").tobytes() for k in some]}, columns=["piece", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, "<i8") for x in rows["counts"])
        return pd.DataFrame({"piece": rows["piece"][:1], "counts": [total.astype("<i8").tobytes()]})

    shape = "piece int, counts binary"
    counts = np.zeros((64, (1 << SLOT_BITS) // 64), np.int64)
    for row in sets.select("shingles").mapInPandas(tidy(count), shape).groupBy("piece").applyInPandas(tidy(add), shape).collect():
        counts[row["piece"]] = np.frombuffer(row["counts"], "<i8")
    ranks = np.empty(1 << SLOT_BITS, np.uint32)
    ranks[np.argsort(counts.reshape(-1), kind="stable")] = np.arange(len(ranks))
    return ranks


def first_shingles(sets: DataFrame, ranks: np.ndarray, similarity: float) -> DataFrame:
    """``token``, ``key``, ``at`` (its place among the text's shingles by rank), ``n``: the
    rarest shingles of every text, one of which any two texts of ``similarity`` share."""
    below = np.uint64((1 << (64 - SLOT_BITS)) - 1)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            tokens, sizes, taken = [], [], []
            for blob in part["shingles"]:
                values = np.frombuffer(blob, "<u8")
                n = len(values)
                # The rank of its slot in place of the slot: another number for every shingle.
                order = (ranks[values >> np.uint64(64 - SLOT_BITS)].astype(np.uint64) << np.uint64(64 - SLOT_BITS)) | (values & below)
                order.sort()
                few = n - int(np.ceil(similarity * n - ROUNDING)) + 1
                # Texts without shingles are alike: they share a token of their own.
                own = order[:few].view(np.int64) if n else np.array([-1])
                tokens.append(own)
                sizes.append(n)
                taken.append(len(own))
            if tokens:
                at = np.concatenate([np.arange(k) for k in taken])
                yield pd.DataFrame({"token": np.concatenate(tokens), "key": np.repeat(part["key"].to_numpy(), taken), "at": at, "n": np.repeat(sizes, taken)})

    return sets.select("key", "shingles").mapInPandas(tidy(run), "token long, key long, at int, n int")


def _meetings(met: DataFrame, chunk: int) -> DataFrame:
    """Rows (place, side, key, label, n, at) of ``met``: the texts of a token in one place, or,
    when there are more than ``chunk``, a place for every two of its chunks. Sides 0 and 1
    meet each other, rows of side 2 meet among themselves."""
    chunks = met.withColumn("chunks", F.ceil(F.col("rows") / chunk).cast("int"))
    own = chunks.withColumn("own", F.pmod(F.xxhash64("key", F.lit(3)), F.col("chunks")).cast("int"))
    spread = own.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    place = F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return spread.select(place.alias("place"), side.cast("long").alias("side"), "key", "label", F.col("n").cast("long").alias("n"), F.col("at").cast("long").alias("at"))


def _candidates(similarity: float):
    """Pairs (a, b) of a place that are not linked yet and of which the token can be the first
    that both have: what follows it in both is enough for ``similarity``."""
    share = similarity / (1 + similarity)

    def pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        place, side, key, label, n, at = rows
        left = n - at

        def out(a, b):
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(key[a], key[b])), pa.array(np.maximum(key[a], key[b]))], names=["a", "b"])

        def fit(a, b):
            enough = np.minimum(left[a], left[b]) >= share * (n[a] + n[b]) - ROUNDING
            return enough & (label[a] != label[b]) & ((side[a] == 2) | (side[a] != side[b]))

        starts = np.append(0, np.flatnonzero(np.diff(place)) + 1)
        sizes = np.diff(np.append(starts, len(place)))
        small = np.repeat(sizes <= SMALL, sizes)
        for shift in range(1, SMALL):
            a = np.flatnonzero((place[:-shift] == place[shift:]) & small[:-shift])
            if not len(a):
                break
            a = a[fit(a, a + shift)]
            yield out(a, a + shift)
        for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
            spot = np.arange(start, start + size)
            for i in range(0, size, BLOCK):
                for j in range(i, size, BLOCK):
                    a, b = spot[i : i + BLOCK, None], spot[None, j : j + BLOCK]
                    a, b = np.nonzero(fit(a, b) & (a < b))
                    yield out(a + start + i, b + start + j)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, waiting, held = np.zeros((6, 0), np.int64), [], 0
        for batch in batches:
            waiting.append(np.stack([c.to_numpy() for c in batch.columns]))
            held += len(batch)
            if held < AT_ONCE:
                continue
            rows = np.concatenate((rest, *waiting), axis=1)
            waiting, held = [], 0
            last = int(np.searchsorted(rows[0], rows[0, -1], side="left"))
            if last:
                yield from pairs(rows[:, :last])
            rest = rows[:, last:]
        rows = np.concatenate((rest, *waiting), axis=1)
        if rows.shape[1]:
            yield from pairs(rows)

    return run


def fingerprint_pairs(texts: DataFrame, bits: int = BITS) -> DataFrame:
    """Pairs (a, b) of texts (key, fp) whose fingerprints are linked within ``bits`` bits.

    A fingerprint's texts are paired with the first one of them, and the first ones of linked
    fingerprints with each other, so a text is in about two pairs, however many are alike.
    """
    firsts = staged(texts.groupBy("fp").agg(F.min("key").alias("first")))
    same = texts.join(firsts, "fp").where("key <> first").select(F.col("first").alias("a"), F.col("key").alias("b"))
    left = firsts.select(F.col("fp").alias("a"), F.col("first").alias("x"))
    right = firsts.select(F.col("fp").alias("b"), F.col("first").alias("y"))
    near = links(firsts, bits).join(left, "a").join(right, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return same.unionByName(near).distinct()


def similar(sets: DataFrame, similarity: float, chunk: int = MEETING) -> DataFrame:
    """``node``, ``root``: the classes of the texts (key, fp, shingles) that are linked to another.

    Texts with linked fingerprints are candidates first; those of ``similarity`` are links. An
    exact search follows for pairs that fingerprints miss. Any two texts of ``similarity`` share one of their first shingles, in one order of all
    shingles, and the first one they share leaves enough after it in both. So every pair of
    that similarity is a candidate, and every candidate is verified on the whole sets. Pairs
    within a class already found are not compared again: in places with many texts a leader's
    verified links go first, and the rest are compared until only classes are left.
    """

    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([jaccard(x, y) for x, y in zip(a, b)], dtype=float)

    held = []  # tables that nothing reads once the classes are known

    def hold(rows: DataFrame) -> DataFrame:
        held.append(staged(rows))
        let_go(sets.sparkSession)
        return held[-1]

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = hold(pairs)
        # Only the shingles of texts in a pair are moved.
        ends = hold(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
        some = sets.join(ends, "key", "left_semi")
        first, second = some.select(F.col("key").alias("a"), F.col("shingles").alias("sa")), some.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
        return pairs.join(first, "a").join(second, "b").where(alike("sa", "sb") >= similarity).select("a", "b")

    found = hold(verified(fingerprint_pairs(sets.select("key", "fp"))))
    met = first_shingles(sets, shingle_ranks(sets), similarity)
    of_token = Window.partitionBy("token")
    met = hold(met.withColumn("rows", F.count(F.lit(1)).over(of_token)).where("rows > 1"))

    def labels(rows: DataFrame) -> DataFrame:
        roots = components(found)
        return hold(rows.join(roots, rows["key"] == roots["node"], "left").withColumn("label", F.coalesce("root", "key")).drop("node", "root"))

    large = hold(met.where(F.col("rows") > SMALL))
    before = None
    for seed in range(0 if large.isEmpty() else STARS):
        many = labels(large)
        # Pairs of different classes that meet, while they are more than the rows and get fewer.
        of_class = many.groupBy("token", "label").agg(F.count(F.lit(1)).alias("own"))
        of_place = of_class.groupBy("token").agg(F.sum("own").alias("all"), F.sum(F.col("own") * F.col("own")).alias("alike"))
        rows, apart = of_place.agg(F.sum("all"), F.sum((F.col("all") * F.col("all") - F.col("alike")) / 2)).first()
        if apart <= rows or (before is not None and apart > WORTH * before):
            break
        before = apart
        # Texts with few shingles of their own come first: they are the nearest to the others.
        far = F.col("at") + F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 + seed * AROUND))
        row = F.struct(far.alias("far"), F.xxhash64("key", F.lit(seed)).alias("by"), "key", "label", "at", "n")
        led = many.join(many.groupBy("token").agg(F.min(row).alias("lead")), "token")
        led = led.where(F.col("label") != F.col("lead.label"))
        enough = F.least(F.col("n") - F.col("at"), F.col("lead.n") - F.col("lead.at")) >= similarity / (1 + similarity) * (F.col("n") + F.col("lead.n")) - ROUNDING
        pairs = led.where(enough).select(F.least("key", "lead.key").alias("a"), F.greatest("key", "lead.key").alias("b")).distinct()
        found = hold(found.unionByName(verified(hold(pairs))))
    labelled = labels(met)
    several = F.min("label").over(of_token) != F.max("label").over(of_token)
    labelled = labelled.withColumn("several", several).where("several").drop("several")
    meetings = _meetings(labelled, chunk).repartition("place").sortWithinPartitions("place")
    pairs = meetings.mapInArrow(tidy(_candidates(similarity)), "a long, b long").distinct()
    roots = components(found.unionByName(verified(pairs)))
    for done in held:
        discard(done)
    return roots


def one_of_each(docs: DataFrame, width: int = STAGE_SHINGLE, similarity: float = STAGE_SIMILARITY, chunk: int = MEETING) -> DataFrame:
    """``docs`` with one document of every near-duplicate class, all columns kept.

    Texts are linked when the Jaccard similarity of their distinct shingles is at least
    ``similarity``; SimHash fingerprints find most pairs, and no such pair is missed. Texts are
    told apart by 128 bits of their SHA-256, shingles by their whole 64-bit hashes. Of a class the smallest
    doc_id stays (a null one only where there is no other), of repeated rows one. Null, empty and blank texts are one
    class. An empty table gives no rows.
    """
    # Equal texts have one digest. A short key stands for it on the way, one for every digest.
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(FULL))
    marked_docs = docs.withColumn("_llm_digest", F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps, sets = [], []
            for text in batch["text"]:
                values = hashes(text, width)
                fps.append(fingerprint(values))
                sets.append(np.unique(values).astype("<u8").tobytes())
            yield pd.DataFrame({"digest": batch["digest"], "fp": np.array(fps, np.uint64).view(np.int64), "shingles": sets})

    # Equal texts are one before they are marked: their text is less to move than its hashes.
    ids = marked_docs.select(F.col("_llm_digest").alias("digest"), text.alias("text")).dropDuplicates(["digest"])
    each = ids.mapInPandas(tidy(mark), "digest binary, fp long, shingles binary")
    sets = staged(each.withColumn("key", F.monotonically_increasing_id()))
    let_go(docs.sparkSession)
    # Of texts with one smallest doc_id that of the smallest hash is the first.
    turn = F.xxhash64(text).alias("turn")
    firsts = marked_docs.select(F.col("_llm_digest").alias("digest"), own.alias("doc_id"), turn).groupBy("digest", "turn").agg(F.min("doc_id").alias("first"))
    texts = staged(firsts.join(sets.select("digest", "key"), "digest"))
    roots = similar(sets.drop("digest"), similarity, chunk)
    discard(sets)
    named = texts.join(roots, texts["key"] == roots["node"], "left").withColumn("root", F.coalesce("root", "key"))
    best = named.groupBy("root").agg(F.min(F.struct("first", "turn", "digest")).alias("stay"))
    stay = best.select(F.col("stay.first").alias("_llm_first"), F.col("stay.digest").alias("_llm_stay"))
    kept = marked_docs.join(stay, (F.col("_llm_digest") == F.col("_llm_stay")) & (own == F.col("_llm_first")))
    place = F.row_number().over(Window.partitionBy("_llm_stay", "_llm_first").orderBy("_llm_first"))
    return kept.withColumn("_llm_place", place).where("_llm_place = 1").select(*[kept[c] for c in docs.columns])
