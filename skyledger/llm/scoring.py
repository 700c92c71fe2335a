"""Scoring texts with prediction by partial matching (PPM) over bytes.

The model is a trie of byte contexts up to ORDER bytes, kept as one table per order of
(context, next byte, count). A byte is looked for after its longest known context; if it
never followed there, an escape is paid and the next shorter context is tried, in which the
bytes already ruled out no longer count (symbol exclusion). Where q different bytes were
seen n times in all, an escape has the chance q / 2n, and a byte seen c times (2c - 1) / 2n.
Below the empty context stands an even chance for every byte value never seen.

Exclusion depends only on a context and its parent, so it is one join per order, and the
code length of a byte after a context is a number per distinct (context, byte). Documents
are written once as compressed batches. A batch sends its distinct (context, byte) keys and
words to places by key and gets their code lengths and counts back, so a task holds what
its own batch needs and never the whole model.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import NO_ID, discard, staged, table, tidy
from skyledger.llm.repeats import batches, runs, squeeze, thaw, widen
from skyledger.llm.simhash import LOWER

ORDER = 5
BATCH = 3 << 20
PLACE = 16 << 20  # bytes of text whose keys one place gets
FOLDS, HELD_OUT = 5, 1
START, END = 0xFE, 0xFF  # two byte values that no UTF-8 text holds
TABLE = 1 << 24
PIECE = 1 << 20  # places scored together


def is_training(doc_id: int) -> bool:
    return zlib.crc32(b"" if doc_id == NO_ID else str(doc_id).encode()) % FOLDS != HELD_OUT


def layout(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """All texts with start and end marks one after another, and each one's first place."""
    head, tail = bytes([START]) * order, bytes([END])
    data = np.frombuffer(b"".join([head + t + tail for t in texts]), np.uint8)
    sizes = np.array([len(t) + order + 1 for t in texts], np.int64)
    return data, np.cumsum(sizes) - sizes


def number_grams(data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For every place the number of the ``width`` bytes that end there (from place width - 1
    on), and the bytes of each number as one integer, in increasing order."""
    used = np.flatnonzero(np.bincount(data, minlength=256))
    to = np.zeros(256, np.int32)
    to[used] = np.arange(len(used))
    code = to[data]
    ids, grams = code, used.astype(np.uint64)
    for k in range(1, width):
        size = len(grams) * len(used)
        key = ids[:-1].astype(np.int32 if size <= TABLE else np.int64) * len(used) + code[k:]
        if size <= TABLE:
            seen = np.zeros(size, bool)
            seen[key] = True
            distinct = np.flatnonzero(seen)
            number = np.zeros(size, np.int32)
            number[distinct] = np.arange(len(distinct), dtype=np.int32)
            ids = number[key]
        else:
            distinct, ids = np.unique(key, return_inverse=True)
            ids = ids.astype(np.int32)
        grams = (grams[distinct // len(used)] << np.uint64(8)) | used[distinct % len(used)].astype(np.uint64)
    return ids, grams


def _place(keys: np.ndarray, places: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) * np.uint64(places) >> np.uint64(32)).astype(np.int64)


def _pack(values: np.ndarray) -> bytes:
    """Packed numbers, the bytes of one weight together: those of a weight are alike."""
    return squeeze(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def _open(blob: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(widen(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)).astype("<u8"))


def _open_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(_open(blob, "<u8"), dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    return _pack(counts.astype("<i8"))


def _open_counts(blob: bytes) -> np.ndarray:
    return _open(blob, "<i8")


def _pack_lengths(bits: np.ndarray) -> bytes:
    """Code lengths in single precision."""
    return _pack(bits.astype("<f4"))


def _open_lengths(blob: bytes) -> np.ndarray:
    return _open(blob, "<f4").astype(float)


class Batch:
    """The distinct grams and words of a batch, in an order that is the same on every call."""

    def __init__(self, blob: bytes, places: int, order: int):
        ids, _, texts = thaw(blob)
        self.ids = ids
        self.training = np.array([is_training(int(i)) for i in ids], bool)
        self.texts = [t.translate(LOWER) for t in texts]
        self.data, self.starts = layout(self.texts, order)
        self.gram_of, grams = number_grams(self.data, order + 1)
        self.last = self.data[order:] != START  # places with a byte to predict
        real = np.flatnonzero((grams & np.uint64(0xFF)) != START)
        self.grams = grams[real]
        turn = np.lexsort((self.grams, _place(self.grams, places)))
        self.grams = self.grams[turn]
        self.at = np.zeros(len(grams), np.int64)  # gram number -> its place in self.grams
        self.at[real[turn]] = np.arange(len(real))
        self.order = order

    def gram_counts(self) -> np.ndarray:
        owner = np.repeat(self.training, np.diff(np.append(self.starts, len(self.data))))[self.order :]
        return np.bincount(self.at[self.gram_of[self.last & owner]], minlength=len(self.grams))

    def words(self, places: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Distinct words with their keys and training counts, by place and key."""
        counts: Counter = Counter()
        for text, training in zip(self.texts, self.training):
            words = text.split()
            if training:
                counts.update(words)
            else:
                for word in words:
                    if word not in counts:
                        counts[word] = 0
        names = list(counts)
        digest = xxhash.xxh64_intdigest
        keys = np.array([digest(w) for w in names], np.uint64)
        turn = np.lexsort((keys, _place(keys, places)))
        return [names[i] for i in turn.tolist()], keys[turn], np.array([counts[names[i]] for i in turn.tolist()], np.int64)


GRAM, WORD = 0, 1
SENT = "kind int, place long, batch long, keys binary, counts binary"


def send(packed: DataFrame, places: int, order: int) -> DataFrame:
    def rows(kind: int, number: int, keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        place = _place(keys, places)
        starts, ends = runs(place, np.zeros(0, np.int64))
        return pd.DataFrame(
            {
                "kind": kind,
                "place": place[starts],
                "batch": number,
                "keys": [_pack_keys(keys[s:e]) for s, e in zip(starts, ends)],
                "counts": [_pack_counts(counts[s:e]) for s, e in zip(starts, ends)],
            }
        )

    def one(number: int, blob: bytes) -> list[pd.DataFrame]:  # what a batch needs is freed with this call
        batch = Batch(blob, places, order)
        _, word_keys, word_counts = batch.words(places)
        both = ((GRAM, batch.grams, batch.gram_counts()), (WORD, word_keys, word_counts))
        return [rows(kind, number, keys, counts) for kind, keys, counts in both if len(keys)]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for number, blob in zip(part["batch"], part["blob"]):
                yield from one(number, blob)

    return packed.mapInPandas(tidy(run), SENT)


def _gather(rows: pd.DataFrame) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the rows, all distinct keys, each sent key's number, and summed counts."""
    keys = [_open_keys(k) for k in rows["keys"]]
    counts = np.concatenate([_open_counts(c) for c in rows["counts"]])
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return [len(k) for k in keys], distinct, inverse, np.bincount(inverse, weights=counts).astype(np.int64)


def gram_totals(sent: DataFrame) -> DataFrame:
    """(gram, n): training counts of every (context, byte) that any document holds."""

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        _, distinct, _, n = _gather(rows)
        return pd.DataFrame({"gram": distinct.view(np.int64), "n": n})

    return sent.where(F.col("kind") == GRAM).groupBy("place").applyInPandas(tidy(total), "gram long, n long")


def word_answers(sent: DataFrame) -> DataFrame:
    """Training counts back to each batch, and per place the counts' sum and number (batch -1)."""

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        sizes, _, inverse, n = _gather(rows)
        back = np.split(n[inverse], np.cumsum(sizes)[:-1])
        out = pd.DataFrame({"batch": rows["batch"], "place": rows["place"], "values": [_pack_counts(x) for x in back]})
        stats = pd.DataFrame({"batch": [-1], "place": [rows["place"].iloc[0]], "values": [b""]})
        out["tokens"], out["different"] = 0, 0
        stats["tokens"], stats["different"] = int(n.sum()), int((n > 0).sum())
        return pd.concat([out, stats], ignore_index=True)

    return sent.where(F.col("kind") == WORD).groupBy("place").applyInPandas(tidy(answer), "batch long, place long, values binary, tokens long, different long")


# ---- the model ----------------------------------------------------------------------


def _low(column, width: int):
    """The last ``width`` bytes of a packed gram."""
    return column.bitwiseAND(F.lit((1 << (8 * width)) - 1)) if width else F.lit(0).cast("long")


def _small(df: DataFrame, order: int) -> DataFrame:
    """Orders 0 and 1 hold at most 256 x 256 rows: those tables are sent to every task."""
    return F.broadcast(df) if order <= 1 else df


def code_lengths(totals: DataFrame, order: int = ORDER, held: list[DataFrame] | None = None) -> DataFrame:
    """(gram, bits): log10 of the chance of each gram's last byte after the bytes before it.

    The tables of the orders that the result reads are added to ``held``.
    """
    follow = {order: totals.where("n > 0").select("gram", "n")}
    for j in range(order - 1, -1, -1):
        follow[j] = staged(follow[j + 1].groupBy(_low(F.col("gram"), j + 1).alias("gram")).agg(F.sum("n").alias("n")))
    contexts = {}
    for j in range(order + 1):
        here = follow[j].withColumn("ctx", F.shiftright("gram", 8))
        if j == 0:
            contexts[0] = staged(here.groupBy("ctx").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("q")))
            continue
        above = _small(follow[j - 1].select(F.col("gram").alias("g"), F.col("n").alias("up")), j - 1)
        own = here.join(above, _low(F.col("gram"), j) == F.col("g"))
        own = own.groupBy("ctx").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("q"), F.sum("up").alias("ruled_out"))
        parent = _small(contexts[j - 1].select(F.col("ctx").alias("p"), F.col("n").alias("pn"), F.col("q").alias("pq")), j - 1)
        own = own.join(parent, _low(F.col("ctx"), j - 1) == F.col("p"))
        # Left of the parent once the bytes seen here are ruled out: its escape share and its total.
        contexts[j] = staged(
            own.select("ctx", "n", "q", (F.col("pq") - F.col("q")).alias("e"), (2 * (F.col("pn") - F.col("ruled_out"))).alias("t"))
        )

    if held is not None:
        held += [*contexts.values(), *[follow[j] for j in range(order)]]

    # A gram that was seen needs its own context only.
    top = contexts[order].select(F.col("ctx").alias("c"), F.col("n").alias("all"))
    seen_ = totals.where("n > 0").join(top, F.shiftright("gram", 8) == F.col("c"))
    seen_ = seen_.select("gram", F.log10((2 * F.col("n") - 1) / (2 * F.col("all"))).alias("bits"))

    # The few others, of held-out documents, go down the orders.
    table_ = totals.where("n = 0")
    for j in range(order, -1, -1):
        ctx = _small(contexts[j].select(F.col("ctx").alias(f"c{j}"), F.col("n").alias(f"n{j}"), F.col("q").alias(f"q{j}"), *([F.col("e").alias(f"e{j}"), F.col("t").alias(f"t{j}")] if j else [])), j)
        key = _low(F.shiftright("gram", 8), j)
        table_ = table_.join(ctx, key == F.col(f"c{j}"), "left")
        if j == order:
            table_ = table_.withColumn(f"f{j}", F.col("n"))
        else:
            seen = _small(follow[j].select(F.col("gram").alias(f"g{j}"), F.col("n").alias(f"f{j}")), j)
            table_ = table_.join(seen, _low(F.col("gram"), j + 1) == F.col(f"g{j}"), "left")
    chance, found = F.lit(0.0), F.lit(False)
    for j in range(order, -1, -1):
        known = F.col(f"n{j}").isNotNull()
        # Entered from the longer context if there is one, else this is the longest known.
        from_above = F.col(f"n{j + 1}").isNotNull() if j < order else F.lit(False)
        total = F.when(from_above, F.col(f"t{j + 1}") if j < order else F.lit(0)).otherwise(2 * F.col(f"n{j}"))
        escape = F.when(from_above, F.col(f"e{j + 1}") if j < order else F.lit(0)).otherwise(F.col(f"q{j}"))
        here = known & ~found & (F.coalesce(F.col(f"f{j}"), F.lit(0)) > 0)
        pay = known & ~found & (total > 0)
        step = F.when(here, F.log10((2 * F.col(f"f{j}") - 1) / total)).when(pay & (escape > 0), F.log10(escape / total)).otherwise(0.0)
        table_ = table_.withColumn(f"s{j}", step).withColumn(f"h{j}", here | found)
        chance, found = chance + F.col(f"s{j}"), F.col(f"h{j}")
    unseen = F.lit(256) - F.coalesce(F.col("q0"), F.lit(0))
    last = F.when(found, 0.0).otherwise(-F.log10(F.greatest(unseen, F.lit(1)).cast("double")))
    return seen_.unionByName(table_.select("gram", (chance + last).alias("bits")))


def gram_answers(sent: DataFrame, lengths: DataFrame, places: int) -> DataFrame:
    """Code lengths back to each batch, aligned with the keys it sent."""

    @F.pandas_udf("long")
    def place_of(gram: pd.Series) -> pd.Series:
        return pd.Series(_place(gram.to_numpy(np.int64).view(np.uint64), places))

    def answer(rows: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"batch": [], "place": [], "values": []}).astype({"batch": "int64", "place": "int64"})
        model = model.sort_values("gram")
        grams, bits = model["gram"].to_numpy(np.int64), model["bits"].to_numpy(float)
        values = [bits[np.searchsorted(grams, _open_keys(k).view(np.int64))] for k in rows["keys"]]
        return pd.DataFrame({"batch": rows["batch"], "place": rows["place"], "values": [_pack_lengths(v) for v in values]})

    left = sent.where(F.col("kind") == GRAM).select("place", "batch", "keys").groupBy("place")
    right = lengths.withColumn("place", place_of("gram")).groupBy("place")
    return left.cogroup(right).applyInPandas(tidy(answer), "batch long, place long, values binary")


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Every text's log10 probability under a PPM model and under a word model.

    Both learn from the documents of four folds of five by crc32 of doc_id. Texts are
    lower-cased (A-Z). A null or empty text is its end mark alone; a null doc_id counts as
    the empty text in crc32 and comes back null. Rows with one doc_id are separate documents.
    Without a training document every byte costs an even chance. An empty table gives no
    rows; other columns are left out of the result. Words meet by a 64-bit hash.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("own"), F.lit(0).cast("long").alias("text_key"), F.col("text").cast("string").alias("text"))
    keyed = plain.select(F.coalesce("own", F.lit(NO_ID)).alias("doc_id"), "text_key", "text")
    packed = staged(batches(keyed, BATCH))
    volume = packed.agg(F.sum("n_bytes")).first()[0] or 0
    places = max(1, -(-volume // PLACE))
    sent = staged(send(packed, places, order))
    words = staged(word_answers(sent))
    totals = staged(gram_totals(sent))
    held = [totals]
    lengths = staged(code_lengths(totals, order, held))
    for done in held:
        discard(done)
    tokens, different = words.where("batch = -1").agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("different"), F.lit(0))).first()
    fold = F.crc32(F.coalesce(plain["own"].cast("string"), F.lit("")).cast("binary")) % FOLDS
    ends = plain.where(fold != HELD_OUT).count()
    total, distinct = tokens + ends, different + (ends > 0)
    floor = total + 0.5 * (distinct + 1)

    # Written before they go to their batches: what came to the places is not needed any more.
    answers = staged(gram_answers(sent, lengths, places))
    discard(sent)
    discard(lengths)
    grams = answers.groupBy("batch").agg(F.collect_list(F.struct("place", "values")).alias("grams"))
    counts = words.where("batch >= 0").groupBy("batch").agg(F.collect_list(F.struct("place", "values")).alias("words"))
    joined = packed.join(grams, "batch", "left").join(counts, "batch", "left")

    def line_up(found, read: Callable) -> np.ndarray:
        rows = sorted(found if found is not None else [], key=lambda r: r["place"])
        return np.concatenate([read(r["values"]) for r in rows]) if rows else np.zeros(0)

    end_base, end_known = math.log10((ends + 0.5) / floor), int(ends > 0)

    def one(blob: bytes, found, said) -> pd.DataFrame:  # what a batch needs is freed with this call
        batch = Batch(blob, places, order)
        bits = line_up(found, _open_lengths)[batch.at] if len(batch.grams) else np.zeros(0)
        cost = np.zeros(len(batch.data))
        for at in range(0, len(batch.gram_of), PIECE):
            here = slice(at, at + PIECE)
            cost[order:][here] = np.where(batch.last[here], bits[batch.gram_of[here]], 0.0)
        scores = np.add.reduceat(cost, batch.starts)
        names, *_ = batch.words(places)
        n = line_up(said, _open_counts)
        base = dict(zip(names, np.log10((n + 0.5) / floor).tolist()))
        unknown = {w for w, c in zip(names, (n > 0).tolist()) if not c}
        out = []
        for i, text in enumerate(batch.texts):
            own = text.split()
            known = len(own) - sum(map(unknown.__contains__, own))
            word_score = math.fsum(map(base.__getitem__, own)) + end_base
            out.append((int(batch.ids[i]), not batch.training[i], len(own) + 1, known + end_known, total, word_score, float(scores[i])))
        return pd.DataFrame(out, columns=[c.split()[0] for c in SCORES.split(", ")])

    def finish(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for blob, found, said in zip(part["blob"], part["grams"], part["words"]):
                yield one(blob, found, said)

    result = joined.mapInPandas(tidy(finish), SCORES)
    return result.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored with a model of four of five folds."""
    return score(table(spark, folder, "documents"))

