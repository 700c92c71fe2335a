"""Sharding by balanced label propagation, with DataFrame operations only.

Documents with equal texts are linked. Each linked document starts in a shard of its own
rank; then, round by round, the links pull it to the shard where most of its neighbours
are, as far as the quotas allow: as many as want to go the other way, and what room there
is. Documents without links fill the shards up, so the counts end at most one apart.

A group is a clique, so its documents are counted per (group, shard) instead of writing
down its links: a round is one join of those counts, however large the group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import SAFE, gapless, staged, table

SHARDS = 40
ROUNDS = 4
ROWS_PER_BUCKET = 20_000


def _capacity(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _loads(state: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _start(groups: DataFrame, rows: int, shards: int, buckets: int) -> DataFrame:
    """(grp, shard, n): the documents of each group dealt round the shards by rank."""
    # A group's documents take consecutive ranks from its offset; rank mod shards is the shard.
    bucket = F.pmod(F.xxhash64("grp", F.lit(1)), F.lit(buckets))
    groups = groups.withColumn("bucket", bucket)
    sums = groups.groupBy("bucket").agg(F.sum("n").alias("t"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    sums = sums.select("bucket", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("bucket").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.withColumn("off", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(sums, "bucket")
    first = F.pmod(F.col("base") + F.col("off"), F.lit(shards)).cast("int")
    spread = placed.select("grp", "n", first.alias("first"), F.explode(F.sequence(F.lit(0), F.least(F.col("n"), F.lit(shards)).cast("int") - 1)).alias("k"))
    count = F.floor((F.col("n") - F.col("k") - 1) / shards) + 1
    return spread.select("grp", F.pmod(F.col("first") + F.col("k"), F.lit(shards)).alias("shard"), count.cast("long").alias("n"))


def _quotas(wishes: dict[tuple[int, int], int], room: list[int]) -> list[tuple[int, int, int]]:
    """How many documents may go from shard to shard: as many as come the other way, and
    then what room there is."""
    quota = {(s, t): min(n, wishes.get((t, s), 0)) for (s, t), n in wishes.items()}
    room = list(room)
    for (s, t), n in sorted(wishes.items(), key=lambda x: (-x[1], x[0])):
        more = min(n - quota[s, t], room[t])
        quota[s, t] += more
        room[t] -= more
    return [(s, t, n) for (s, t), n in quota.items() if n]


def _round(state: DataFrame, capacity: list[int], shards: int, buckets: int) -> DataFrame:
    """Moves documents to the shard that most of their neighbours are in, within the quotas.

    A group that no shard can hold is drawn to as few of its shards as can.
    """
    loads = _loads(state, shards)
    room = [max(0, c - n) for c, n in zip(capacity, loads)]
    places = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.xxhash64("grp", "shard").alias("h"), "shard", "n")))
    groups = state.groupBy("grp").agg(places.alias("places"), F.sum("n").alias("all"))  # an entry a shard at most
    enough = F.least(F.ceil(F.col("all") / max(1, min(capacity))), F.size("places"))
    spread = groups.select("grp", "all", "places", enough.cast("int").alias("k"), F.posexplode("places").alias("pos", "here"))
    to = F.element_at("places", (F.col("pos") % F.col("k") + 1).cast("int"))["shard"]
    wish = spread.where("pos >= k").select("grp", "all", F.col("here.shard").alias("shard"), F.col("here.n").alias("n"), to.alias("to"))
    wish = staged(wish)
    flows = {(r["shard"], r["to"]): r["t"] for r in wish.groupBy("shard", "to").agg(F.sum("n").alias("t")).collect()}
    spark = state.sparkSession
    quotas = spark.createDataFrame(_quotas(flows, room), "shard int, to int, quota long")
    # Admit the wishes from shard to shard in order of group size until the quota is used up.
    # Sums run in two levels: by bucket of (size class, hash), then within the bucket.
    level = (F.lit(64) - F.ceil(F.log2(F.col("all"))).cast("int")) * buckets + F.pmod(F.xxhash64("grp"), F.lit(buckets)).cast("int")
    wish = wish.join(quotas, ["shard", "to"]).withColumn("level", level)
    sums = wish.groupBy("shard", "to", "level").agg(F.sum("n").alias("t"))
    before = Window.partitionBy("shard", "to").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("shard", "to", "level", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("shard", "to", "level").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    wish = wish.withColumn("off", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(sums, ["shard", "to", "level"])
    moved = F.greatest(F.lit(0), F.least(F.col("n"), F.col("quota") - F.col("base") - F.col("off"))).cast("long")
    wish = wish.select("grp", "shard", "to", moved.alias("moved")).where("moved > 0")
    change = wish.select("grp", "shard", (-F.col("moved")).alias("n")).unionByName(
        wish.select("grp", F.col("to").alias("shard"), F.col("moved").alias("n"))
    )
    return state.unionByName(change).groupBy("grp", "shard").agg(F.sum("n").alias("n")).where("n > 0")


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Every row of ``docs`` in one of ``shards`` shards; law ``rows``: counts at most one apart.

    Texts are linked when equal; null and empty texts link as well (a null counts as the
    empty text: size 16, crc32 0). Rows with one doc_id are separate documents. An empty
    table gives no rows. Other columns are left out of the result.

    The driver holds one number per pair of shards at most. Ranks and room are prefix sums in two levels,
    so no group, shard or key is ordered in a single task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("grp"),
        )
    )
    total = rows.count()
    buckets = max(256, -(-total // ROWS_PER_BUCKET))
    capacity = _capacity(total, shards)
    groups = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    state = staged(_start(groups, total, shards, buckets))
    for _ in range(rounds):
        state = staged(_round(state, capacity, shards, buckets))
    loads = _loads(state, shards)

    # Where the ranks of each group's documents end, shard by shard: at most one entry a shard.
    upto = Window.partitionBy("grp").orderBy(F.desc("n"), "shard").rowsBetween(Window.unboundedPreceding, 0)
    ends = state.withColumn("upto", F.sum("n").over(upto)).groupBy("grp").agg(
        F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("ends")
    )
    # Each (group, bucket) carries its group's ends, so a hot group's documents stay spread.
    marked = rows.join(ends, "grp", "left")
    linked = gapless(marked.where("ends is not null"), ["grp"], ["doc_id", "size"], "rank", buckets)
    linked = linked.withColumn("shard", F.filter("ends", lambda e: e["upto"] > F.col("rank"))[0]["shard"])
    alone = gapless(marked.where("ends is null").withColumn("one", F.lit(1)), ["one"], ["doc_id", "grp"], "rank", buckets)
    free, edges, at = [c - n for c, n in zip(capacity, loads)], [], 0
    for f in free:
        at += f
        edges.append(at)
    fill = F.filter(F.array(*[F.struct(F.lit(e).alias("upto"), F.lit(s).alias("shard")) for s, e in enumerate(edges)]), lambda e: e["upto"] > F.col("rank"))[0]["shard"]
    alone = alone.withColumn("shard", fill)
    keep = ["doc_id", "size", "text_crc32", "grp", "shard"]
    dealt = linked.select(keep).unionByName(alone.select(keep))
    dealt = gapless(dealt, ["shard"], ["doc_id", "grp"], "slot", buckets)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_shard_documents(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards with counts at most one apart."""
    return shard(table(spark, folder, "documents"))
