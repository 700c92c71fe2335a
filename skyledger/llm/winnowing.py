"""Benchmark decontamination by winnowing, with DataFrame operations only.

Of every ten consecutive words the smallest of their seven 4-gram hashes is kept. Equal tens
keep equal hashes, so a document that shares ten words with an item shares a kept hash: none
is missed. Where a document has such a hash is a hit; it is extended to the tens of words
around it, and those are compared with the items' tens as text, so nothing false remains.

Items of fewer than ten words are one window; they are met by the hash of the whole window,
of which a document keeps every one (winnowing with windows of one gram).

Documents meet items by hash first, as rows of a few bytes. Only documents with a hit are
read again for their words, one of each group of equal texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import staged, table

SPAN = 10  # words of a window: the length from which every shared run is found
GRAM = 4  # words of a hashed gram
GRAMS = SPAN - GRAM + 1  # grams of a window, of which the smallest is kept

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Every ASCII character that is no digit or letter ends a word.
BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case. Splitting at one plain character is ten times
    as fast as matching words by a regular expression."""
    spaced = F.translate(text, UPPER + BETWEEN, LOWER + " " * len(BETWEEN))
    return F.array_remove(F.split(spaced, " ", -1), "")


def with_grams(spelled: DataFrame) -> DataFrame:
    """Adds ``grams``: the hash of the four words from each place of ``words`` on.

    Two words are hashed to one number, and two of those numbers to the gram's. Each step is
    a column of its own, so that it is worked out once.
    """
    n = F.size("words")
    df = spelled.withColumn("pairs", F.zip_with("words", F.slice("words", 2, n), lambda a, b: F.xxhash64(a, b)))
    quads = F.zip_with("pairs", F.slice("pairs", 3, n), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("quads", quads)
    return df.withColumn("grams", F.slice("quads", 1, F.greatest(F.lit(0), F.size("quads") - (GRAM - 1)))).drop("pairs", "quads")


def with_kept(df: DataFrame) -> DataFrame:
    """Adds ``kept``: the different hashes of ``grams`` that are the smallest of seven in a row."""

    def least(values: str, ahead: int) -> Column:
        return F.zip_with(values, F.slice(values, ahead + 1, F.size(values)), lambda a, b: F.least(a, b))

    df = df.withColumn("of2", least("grams", 1)).withColumn("of4", least("of2", 2)).withColumn("of7", least("of4", 3))
    count = F.greatest(F.lit(0), F.size("of7") - (GRAMS - 1))
    return df.withColumn("kept", F.array_distinct(F.slice("of7", 1, count))).drop("of2", "of4", "of7")


def _short_grams(n: int) -> Column:
    """The hash of every ``n`` consecutive words of the column ``words``."""
    places = F.sequence(F.lit(1), F.size("words") - (n - 1))
    hashes = F.transform(places, lambda i: F.xxhash64(F.slice("words", i, n)))
    return F.when(F.size("words") >= n, hashes).otherwise(F.array().cast("array<bigint>"))


def with_prints(spelled: DataFrame, short: list[int]) -> DataFrame:
    """``spelled`` with ``prints``: arrays of ``(n, print)``, the kept hashes of the column ``words``.

    ``n`` is the window length; windows of the ``short`` lengths keep every gram.
    """

    def rows(n: int, hashes: Column) -> Column:
        return F.transform(hashes, lambda h: F.struct(F.lit(n).alias("n"), h.alias("print")))

    parts = [rows(SPAN, F.col("kept"))] + [rows(n, F.array_distinct(_short_grams(n))) for n in short]
    return with_kept(with_grams(spelled)).withColumn("prints", F.concat(*parts))


def item_windows(items: DataFrame) -> tuple[DataFrame, DataFrame, list[int]]:
    """``(n, window, item_id)`` of all windows of the items, their kept hashes ``(n, print)``,
    and the window lengths under ten that occur."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spelled = items.select(F.col("item_id").cast("string").alias("item_id"), words(text).alias("words"))
    spelled = staged(spelled.where(F.size("words") > 0))
    length = F.least(F.size("words"), F.lit(SPAN))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    windows = F.transform(starts, lambda i: F.array_join(F.slice("words", i, length), " "))
    rows = spelled.select(length.alias("n"), F.explode(windows).alias("window"), "item_id").distinct()
    # Nine numbers at most.
    short = sorted(r["n"] for r in spelled.select(length.alias("n")).where(F.col("n") < SPAN).distinct().collect())
    long = with_prints(spelled, []).select(F.inline("prints"))
    shorter = spelled.where(F.size("words") < SPAN).select(F.size("words").alias("n"), F.xxhash64("words").alias("print"))
    return staged(rows), staged(long.union(shorter).distinct()), short


def meetings(docs: DataFrame, hashes: DataFrame, short: list[int]) -> DataFrame:
    """``(doc_id, key, n_words, n)``: a row with ``n`` 0 for every document, and others for
    the documents that keep a hash that an item keeps. One pass over the texts."""
    spelled = docs.select("doc_id", F.unhex(F.md5("text")).alias("key"), words(F.col("text")).alias("words"))
    counted = with_prints(spelled, short).withColumn("n_words", F.size("words").cast("long"))
    # The row of the document itself has a hash too, so that these rows spread in a join.
    own = F.array(F.struct(F.lit(0).alias("n"), F.xxhash64("doc_id", "key").alias("print")))
    rows = counted.select("doc_id", "key", "n_words", F.inline(F.concat(own, "prints")))
    met = rows.join(hashes.withColumn("met", F.lit(True)), ["n", "print"], "left").where("n = 0 or met")
    return met.select("doc_id", "key", "n_words", "n")


def occurrences(docs: DataFrame, met: DataFrame, windows: DataFrame, hashes: DataFrame, short: list[int]) -> DataFrame:
    """``(key, start, n, window)``: the item windows that occur in each different text."""
    # Of equal texts one is read again. Rows are told by key and id, so a hot key is no hot spot.
    low = F.coalesce("doc_id", F.lit(-(2**63)))
    one = staged(met.where("n > 0").groupBy("key").agg(F.min(low).alias("row")))
    again = docs.select(F.unhex(F.md5("text")).alias("key"), low.alias("row"), "text").join(one, ["key", "row"], "left_semi")
    again = staged(again.dropDuplicates(["key"]).select("key", words(F.col("text")).alias("words")))

    # Every place that has a hash of an item, kept or not, is a hit.
    long = with_grams(again.where(F.size("words") >= SPAN))
    places = long.select("key", F.posexplode("grams").alias("at", "print")).withColumn("n", F.lit(SPAN))
    for n in short:
        more = again.select("key", F.posexplode(_short_grams(n)).alias("at", "print")).withColumn("n", F.lit(n))
        places = places.unionByName(more)
    spots = places.join(hashes, ["n", "print"], "left_semi").groupBy("key").agg(F.collect_list(F.struct("n", "at")).alias("spots"))
    hit = again.join(spots, "key")

    def window(n: Column, start: Column) -> Column:
        text = F.array_join(F.slice("words", start, n), " ")
        return F.struct(n.cast("int").alias("n"), start.cast("int").alias("start"), text.alias("window"))

    def around(spot: Column) -> Column:
        at = spot["at"] + 1
        return F.sequence(F.greatest(F.lit(1), at - (GRAMS - 1)), F.least(at, F.size("words") - (SPAN - 1)))

    starts = F.array_distinct(F.flatten(F.transform(F.filter("spots", lambda s: s["n"] == SPAN), around)))
    candidates = [F.transform(starts, lambda start: window(F.lit(SPAN), start))]
    if short:
        rest = F.filter("spots", lambda s: s["n"] < SPAN)
        candidates.append(F.transform(rest, lambda s: window(s["n"], s["at"] + 1)))
    near = hit.select("key", F.inline(F.concat(*candidates)))
    return near.join(windows.select("n", "window").distinct(), ["n", "window"], "left_semi")


def _item_sets(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(n, window, items)`` and ``(items, item_id)``: windows held by the same items share the
    name ``items`` of that set, so documents meet a set once however many windows it has.

    A set is named by its size and 128 bits of hashes, which add up without gathering a set.
    """
    named = windows.where("item_id is not null")
    name = F.struct(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("item_id")).alias("a"),
        F.bit_xor(F.xxhash64("item_id", F.lit(1))).alias("b"),
    )
    sets = staged(named.groupBy("n", "window").agg(name.alias("items")))
    one = sets.groupBy("items").agg(F.min(F.struct("n", "window")).alias("w")).select("items", "w.*")
    return sets, one.join(named, ["n", "window"]).select("items", "item_id")


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Every row of ``docs`` with the words that stand inside an occurring item window.

    Texts are taken whole, however long; null has no words. Rows are kept as they are,
    repeated ones too, and equal texts get equal results. Items are told by ``item_id``: rows
    that share one are one item, rows without one mark words but are neither counted nor
    listed; items without words are none. No items, or an empty table of documents, give no
    hits, or no rows. Other columns of both tables are left out.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    windows, hashes, short = item_windows(items)
    met = staged(meetings(docs, hashes, short))
    found = staged(occurrences(docs, met, windows, hashes, short))
    # Words covered by overlapping windows count once: each adds what reaches beyond all before it.
    before = Window.partitionBy("key").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    reach = found.withColumn("reach", F.coalesce(F.max(end).over(before), F.lit(0)))
    added = F.greatest(F.lit(0), end - F.greatest("start", "reach"))
    hit = reach.groupBy("key").agg(F.sum(added).alias("n_hit"))
    sets, members = _item_sets(windows)
    named = found.join(sets, ["n", "window"]).select("key", "items").distinct().join(members, "items")
    listed = named.groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    per_text = staged(hit.join(listed, "key", "left"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    hits = F.coalesce("n_hit", F.lit(0)).cast("long")
    return met.where("n = 0").join(per_text, "key", "left").select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def op12_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """All documents against all benchmark items."""
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
