"""A Merkle manifest of the documents, and proofs by octopus multiproofs.

Leaves of a source stand in the order of their ids; runs of three become their parent until
one node, the subroot, is left. Subroots in the order of their sources make the roof, whose
last node is the root. Trees grow a block of 3^7 leaves at a time, so a task never holds more,
and all nodes are stored as rows (tree, level, pos, digest).

A proof does not ask for its siblings one by one. The leaves of a block are proved together:
the block works out the smallest set of node coordinates that its leaves cannot derive, all
are fetched in one join, the shared interiors are derived once, and every leaf's own
siblings are then read off locally.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import staged, table, tidy

FAN = 3
DEPTH = 7  # levels a task grows at once
BLOCK = FAN**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ROOF = ""  # the tree above the sources' trees, whose names are never empty

NODES = "tree string, level int, pos long, digest binary, total long"
ASKS = "tree string, block long, in_tree string, level int, pos long"
PROOFS = "doc_id long, leaf string, subroot string, root string, siblings array<string>, folded_root string"


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each as its byte count, ':' and text, or '-' when null."""
    spelled = []
    for field in fields:
        text = field.cast("string")
        spelled.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*spelled).cast("binary"), 256))


def tree_name(source: Column) -> Column:
    """A name that is never null and sorts as the sources do, null first."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("-"))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``pos``, the gapless place from 0 within ``tree``, and ``total``, the tree's rows.

    Rows are range-partitioned by tree and order and written once. A place is the row's number
    in its partition plus what the tree has in the partitions before: one small row per
    partition and tree, so a tree of a third of all rows is never sorted in one task.
    """
    keys = ["tree", *order]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "_tie")
    ordered = ranged.sortWithinPartitions(*keys).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    ordered = staged(ordered).withColumn("_part", F.shiftright("_at", 33))
    spans = ordered.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "tree", "_part", "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
        F.sum("_n").over(Window.partitionBy("tree")).alias("total"),
    )
    pos = F.col("_base") + F.col("_at") - F.col("_first")
    return ordered.join(spans, ["tree", "_part"]).withColumn("pos", pos).drop("_at", "_part", "_first", "_base")


def node_digest(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def _run(pos: int, total: int) -> range:
    """The places of the run that holds ``pos``."""
    start = pos - pos % FAN
    return range(start, min(start + FAN, total))


def _parents(total: int) -> int:
    return -(-total // FAN)


def _grow(base: int):
    """The levels above one block of nodes of level ``base``."""

    def over(block: pa.Table) -> pa.Table:
        tree, total = block.column("tree")[0].as_py(), block.column("total")[0].as_py()
        nodes = sorted(zip(block.column("pos").to_pylist(), block.column("digest").to_pylist()))
        first, level_nodes, out = nodes[0][0], [d for _, d in nodes], []
        for level in range(base + 1, base + DEPTH + 1):
            if total == 1:
                break
            level_nodes = [node_digest(level_nodes[i : i + FAN]) for i in range(0, len(level_nodes), FAN)]
            first, total = first // FAN, _parents(total)
            out.extend((level, first + i, digest, total) for i, digest in enumerate(level_nodes))
        columns = list(zip(*out)) or [(), (), (), ()]
        return pa.table(
            [pa.array([tree] * len(out), pa.string()), pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.int64())],
            ["tree", "level", "pos", "digest", "total"],
        )

    return tidy(over)


def grown(leaves: DataFrame) -> DataFrame:
    """All nodes, leaves included, of trees given as ``(tree, pos, digest, total)``."""
    nodes = leaves.select("tree", F.lit(0).alias("level"), "pos", "digest", "total")
    all_nodes, base = nodes, 0
    while True:
        block = F.floor(F.col("pos") / BLOCK).alias("block")
        above = staged(nodes.where("total > 1").groupBy("tree", block).applyInArrow(_grow(base), NODES))
        all_nodes, base = all_nodes.unionByName(above), base + DEPTH
        nodes = above.where(f"level = {base} and total > 1")
        if nodes.isEmpty():
            return all_nodes


@dataclass
class Manifest:
    """``leaves``: one row per document with its place; ``nodes``: of all trees and the roof."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def manifest(docs: DataFrame) -> Manifest:
    """The trees over ``docs``, a frame ``(doc_id, source, digest)``.

    Rows with one id stand in the order of their digests; rows without an id come first.
    A column ``now`` of ``docs``, if there is one, is kept beside each leaf: the digest that
    the document has today. An empty table has no root.
    """
    kept = ["tree", "doc_id", "digest", *(["now"] if "now" in docs.columns else [])]
    leaves = docs.withColumn("tree", tree_name(F.col("source"))).select(*kept)
    leaves = staged(placed(leaves, "doc_id", "digest"))
    trees = grown(leaves)
    subroots = trees.where("total = 1").select(F.lit(ROOF).alias("tree"), F.col("tree").alias("source_tree"), "digest")
    roof_leaves = staged(placed(subroots, "source_tree"))
    roof = grown(roof_leaves)
    tops = roof_leaves.select(
        F.col("source_tree").alias("tree"), F.col("pos").alias("roof_pos"), F.col("total").alias("roof_total")
    )
    top = roof.where("total = 1").select(F.hex("digest").alias("h")).first()
    return Manifest(leaves.join(tops, "tree"), trees.unionByName(roof), top["h"].lower() if top else None)


def missing(wanted: set[int], total: int) -> tuple[list[tuple[int, int]], list[int]]:
    """The (level, pos) a set of leaves cannot derive on the way up, and the totals by level."""
    out, totals, known, level = [], [total], wanted, 0
    while total > 1:
        runs = {p - p % FAN for p in known}
        out.extend((level, p) for start in sorted(runs) for p in _run(start, total) if p not in known)
        known, total, level = {p // FAN for p in known}, _parents(total), level + 1
        totals.append(total)
    return out, totals


def _ask(block: pa.Table) -> pa.Table:
    """The coordinates one block of leaves has to fetch, in its tree and in the roof."""
    tree = block.column("tree")[0].as_py()
    one = {c: block.column(c)[0].as_py() for c in ("total", "roof_pos", "roof_total", "block")}
    own, _ = missing(set(block.column("pos").to_pylist()), one["total"])
    roof, _ = missing({one["roof_pos"]}, one["roof_total"])
    asked = [(tree, level, pos) for level, pos in own] + [(ROOF, level, pos) for level, pos in roof]
    columns = list(zip(*asked)) or [(), (), ()]
    return pa.table(
        [pa.array([tree] * len(asked), pa.string()), pa.array([one["block"]] * len(asked), pa.int64()),
         pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64())],
        ["tree", "block", "in_tree", "level", "pos"],
    )


def _derive(known: list[dict[int, bytes]], totals: list[int]) -> None:
    """Fills in every node that the known ones below it give."""
    for level, total in enumerate(totals[:-1]):
        for start in {p - p % FAN for p in known[level]}:
            run = [known[level].get(p) for p in _run(start, total)]
            if None not in run:
                known[level + 1].setdefault(start // FAN, node_digest(run))


def _path(known: list[dict[int, bytes]], totals: list[int], pos: int) -> list[tuple[list[bytes], int]]:
    """Level by level the siblings of a node and its own place among them."""
    steps = []
    for level, total in enumerate(totals[:-1]):
        run = _run(pos, total)
        steps.append(([known[level][p] for p in run if p != pos], pos - run.start))
        pos //= FAN
    return steps


def fold(digest: bytes, steps: list[tuple[list[bytes], int]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for siblings, at in steps:
        digest = node_digest([*siblings[:at], digest, *siblings[at:]])
    return digest


def _expand(block: pa.Table, fetched: pa.Table) -> pa.Table:
    """The proofs of one block of leaves from what it has and what it fetched."""
    if not block.num_rows:
        return pa.table([pa.array([], t) for t in _PROOF_TYPES], _PROOF_NAMES)
    tree = block.column("tree")[0].as_py()
    places, digests = block.column("pos").to_pylist(), block.column("digest").to_pylist()
    roof_pos, roof_total = block.column("roof_pos")[0].as_py(), block.column("roof_total")[0].as_py()
    _, totals = missing(set(places), block.column("total")[0].as_py())
    _, roof_totals = missing({roof_pos}, roof_total)
    own, roof = [{} for _ in totals], [{} for _ in roof_totals]
    for in_tree, level, pos, digest in zip(*[fetched.column(c).to_pylist() for c in ("in_tree", "level", "pos", "digest")]):
        (own if in_tree == tree else roof)[level][pos] = digest
    own[0].update(zip(places, digests))
    _derive(own, totals)
    subroot = own[-1][0]
    roof[0][roof_pos] = subroot
    _derive(roof, roof_totals)
    root, above = roof[-1][0].hex(), _path(roof, roof_totals, roof_pos)
    present = block.column("now").to_pylist() if "now" in block.column_names else digests
    siblings, folded = [], []
    for pos, now in zip(places, present):
        steps = _path(own, totals, pos) + above
        siblings.append([s.hex() for step, _ in steps for s in step])
        folded.append(fold(now, steps).hex())
    n = len(places)
    values = [[d.hex() for d in digests], [subroot.hex()] * n, [root] * n, siblings, folded]
    columns = [block.column("doc_id").combine_chunks().cast(pa.int64()), *[pa.array(v, t) for v, t in zip(values, _PROOF_TYPES[1:])]]
    return pa.table(columns, _PROOF_NAMES)


_PROOF_NAMES = ["doc_id", "leaf", "subroot", "root", "siblings", "folded_root"]
_PROOF_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]


def proofs(made: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """``(doc_id, leaf, subroot, root, siblings, folded_root)`` of the wanted leaves, or of all.

    ``wanted`` is any part of ``made.leaves``. ``folded_root`` is what the document's present
    digest (``now``, else its leaf) and the siblings give.
    """
    block = F.floor(F.col("pos") / BLOCK).cast("long").alias("block")
    leaves = (made.leaves if wanted is None else wanted).select("*", block)
    asks = leaves.groupBy("tree", "block").applyInArrow(tidy(_ask), ASKS)
    nodes = made.nodes.select(F.col("tree").alias("in_tree"), "level", "pos", "digest")
    fetched = asks.join(nodes, ["in_tree", "level", "pos"]).select("tree", "block", "in_tree", "level", "pos", "digest")
    grouped = leaves.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block"))
    return grouped.applyInArrow(tidy(_expand), PROOFS)


def check(docs: DataFrame, tampered: Column, text: Column) -> DataFrame:
    """Proofs of all documents, and whether they still hold where ``tampered`` documents have
    ``text`` instead of their own.

    Null fields are '-', an empty text is '0:'. Repeated rows are leaves of their own, texts
    are hashed whole. Rows without an id keep null and are proved as all others. An empty
    table gives no rows. Columns beyond the hashed ones are left out.
    """
    fields = docs.select(*[F.col(c) for c in FIELDS], F.coalesce(tampered, F.lit(False)).alias("_changed"), text.alias("_text"))
    leaf = leaf_digest(*[F.col(c) for c in FIELDS])
    now = F.when(F.col("_changed"), leaf_digest(*[F.col(c) for c in FIELDS[:-1]], F.col("_text"))).otherwise(leaf)
    # Written once, so that the texts are read once: ranging the leaves looks at them twice.
    leaves = staged(fields.select(F.col("doc_id").cast("long").alias("doc_id"), "source", leaf.alias("digest"), now.alias("now")))
    made = manifest(leaves)
    found = proofs(made)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.concat_ws("", "siblings").cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.lit(made.root)).alias("verified"),
    )


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents, those with an even checksum of the id without line breaks."""
    docs = table(spark, folder, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return check(docs, even, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
