"""Language ID with bit-sliced Bloom filters over letter n-grams.

One array of slots serves all languages: slot s holds one bit per language, so looking an
n-gram up in every language's filter is K reads and an AND, which gives the set of languages
that contain it. A document's hits per language are the popcounts of those sets down the
bit slices. A filter of which a share f of the slots is set answers yes by mistake with
chance f^K; the hits are corrected for that before they are compared.

A language contains an n-gram when its rate there is at least RATIO of its highest rate in
any language and at least RARE: texts filed under a wrong language then leave no trace.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import per_process, staged, table

ORDER = 3
SLOTS = 1 << 20
PROBES = 4
RATIO = 0.35
RARE = 2e-6
FOLDS = 5
HELD_OUT = 0
UNKNOWN = "und"
WORD_BITS = 62  # languages per slot word


def _letters() -> np.ndarray:
    """Per code point: its lower-case letter, or 0 for everything that is no letter."""
    found = np.zeros(sys.maxunicode + 1, np.uint32)
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        if char.isalpha():
            found[point] = ord(char.lower()[0])
    return found


def _points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 0, then the letters of all texts one after another, words and texts parted by 0; and the
    place in this list from which on an n-gram belongs to the next text."""
    joined = "\n".join(t or "" for t in texts)
    letters = per_process("letters", _letters)[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    sizes = np.array([len(t or "") + 1 for t in texts], np.int64)
    gap = np.zeros(1, np.uint32)
    return np.concatenate((gap, letters, gap)), np.cumsum(sizes)


def ngrams(letters: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the n-grams and their places; the gap before and after a word counts
    as a letter, and n-grams of gaps only or reaching over a word are left out."""
    n = len(letters) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    code = np.zeros(n, np.uint64)
    inner = np.ones(n, bool)
    for k in range(order):
        part = letters[k : n + k]
        code = (code << np.uint64(21)) | part
        if 0 < k < order - 1:
            inner &= part > 0
    places = np.flatnonzero(inner & ((letters[:n] > 0) | (letters[order - 1 :] > 0)))
    return code[places], places


def _mix(code: np.ndarray) -> np.ndarray:
    code = (code ^ (code >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    code = (code ^ (code >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return code ^ (code >> np.uint64(32))


def probes(code: np.ndarray, slots: int = SLOTS, count: int = PROBES) -> list[np.ndarray]:
    mixed = _mix(code)
    step = (mixed >> np.uint64(33)) | np.uint64(1)
    return [((mixed + np.uint64(k) * step) % np.uint64(slots)).astype(np.int64) for k in range(count)]


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def ngram_counts(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) over all rows of ``labelled`` (text, lang)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang", sort=False):
                texts = part["text"].tolist()
                for at in range(0, len(texts), 400):
                    code, _ = ngrams(_points(texts[at : at + 400])[0], order)
                    gram, n = np.unique(code, return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": gram.view(np.int64), "n": n})

    partial = labelled.mapInPandas(count, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, order: int = ORDER, slots: int = SLOTS, count: int = PROBES) -> dict:
    """The filters of all languages named in ``docs`` (text, lang), learnt from all its rows.

    What reaches the driver is the slot array: at most ``slots`` words per 62 languages,
    however large the corpus.
    """
    counts = staged(ngram_counts(docs.where("text is not null and lang is not null").select("text", "lang"), order))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    langs = [r["lang"] for r in totals.orderBy("lang").select("lang").collect()]
    if not langs:
        return {"langs": [], "slots": np.zeros((1, slots), np.uint64), "false": np.zeros(0), "order": order, "probes": count}
    spark = docs.sparkSession
    numbers = spark.createDataFrame([(lang, i // WORD_BITS, 1 << (i % WORD_BITS)) for i, lang in enumerate(langs)], "lang string, word int, bit long")
    rate = counts.join(totals, "lang").withColumn("rate", F.col("n") / F.col("all"))
    highest = rate.groupBy("gram").agg(F.max("rate").alias("top"))
    own = rate.join(highest, "gram").where((F.col("rate") >= RATIO * F.col("top")) & (F.col("rate") >= RARE))
    masks = own.join(numbers, "lang").groupBy("gram", "word").agg(F.bit_or("bit").alias("mask"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for slot in probes(batch["gram"].to_numpy().view(np.uint64), slots, count):
                yield pd.DataFrame({"slot": slot, "word": batch["word"], "mask": batch["mask"]})

    placed = masks.mapInPandas(place, "slot long, word int, mask long").groupBy("word", "slot").agg(F.bit_or("mask").alias("mask")).toPandas()
    array = np.zeros((-(-len(langs) // WORD_BITS), slots), np.uint64)
    array[placed["word"].to_numpy(int), placed["slot"].to_numpy(int)] = placed["mask"].to_numpy(np.int64).view(np.uint64)
    filled = np.array([((array[i // WORD_BITS] >> np.uint64(i % WORD_BITS)) & np.uint64(1)).mean() for i in range(len(langs))])
    return {"langs": langs, "slots": array, "false": filled**count, "order": order, "probes": count}


def decide(texts: list[str | None], model: dict) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: the highest corrected share of its n-grams."""
    letters, ends = _points(texts)
    spoken = np.diff(np.append(0, np.cumsum(letters > 0)[ends])) > 0
    langs, false = model["langs"], model["false"]
    hits = np.zeros((max(1, len(langs)), len(texts)))
    code, places = ngrams(letters, model["order"])
    owner = np.searchsorted(ends, places, side="right")
    size = model["slots"].shape[1]
    total = np.bincount(owner, minlength=len(texts)).astype(float)
    for word, slots in enumerate(model["slots"]):
        found = None
        for slot in probes(code, size, model["probes"]):
            found = slots[slot] if found is None else found & slots[slot]
        for i in range(word * WORD_BITS, min(len(langs), (word + 1) * WORD_BITS)):
            bits = ((found >> np.uint64(i % WORD_BITS)) & np.uint64(1)).astype(float)
            hits[i] = np.bincount(owner, weights=bits, minlength=len(texts))
    if langs:
        share = np.clip((hits / np.maximum(total, 1) - false[:, None]) / (1 - false[:, None] + 1e-12), 0, 1)
    else:
        share = np.zeros((1, len(texts)))
    best = share.argmax(axis=0)
    score = share[best, np.arange(len(texts))]
    known = spoken & (len(langs) > 0)
    return [langs[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, score, 0.0)


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; all its columns stay.

    A null text, or one without a letter, is ``und`` with score 0; letters outside every
    filter give score 0 and the first language, and so do ties. Texts are read whole. Repeated
    rows get equal answers, rows without an id are told as all others; without languages to
    know everything is ``und``. An empty table gives no rows. Columns of the two names are
    replaced.
    """
    spark = docs.sparkSession
    # The slot array has a fixed size, whatever the corpus.
    shared = spark.sparkContext.broadcast(model)
    schema = "lang_pred string, score double"

    @F.pandas_udf(schema)
    def predict(texts: pd.Series) -> pd.DataFrame:
        out, scores, values = [], [], texts.tolist()
        for at in range(0, len(values), 200):
            langs, score = decide(values[at : at + 200], shared.value)
            out += langs
            scores.append(score)
        return pd.DataFrame({"lang_pred": pd.Series(out, dtype=object), "score": np.concatenate(scores) if scores else np.zeros(0)})

    found = docs.drop("lang_pred", "score").withColumn("_llm_found", predict(F.col("text").cast("string")))
    return found.select(*[c for c in found.columns if c != "_llm_found"], "_llm_found.*")


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learnt from four of five folds."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", fold(F.col("doc_id")) == HELD_OUT)
    model = fit(docs.where("not held_out"))
    return identify(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score")

