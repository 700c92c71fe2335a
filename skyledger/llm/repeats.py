"""Suffix-array dedup: finds every string of ``length`` bytes that an earlier document has too.

Equal strings are brought together by content. Every window of ``length`` bytes is named by
its smallest k-gram hash; equal windows have equal names, and a run of windows with one name
is a short segment of text. Four steps:

1. Documents are written once as compressed batches of a few megabytes.
2. Each batch sends its names, four bytes each, to a place per range of names and learns
   which of them occur anywhere else. Windows with a name of their own are settled.
3. The rest, cut into segments, meets by name; equal segments are one from here on. Each
   meeting place builds a suffix array and a Burrows-Wheeler transform of the different
   segments that share a name and expands intervals up to ``length`` (``suffixes``), which
   gives the smallest doc_id for every window.
4. The answers go back to their batches, which mark the bytes covered by windows of a
   smaller doc_id.

A string that a third of all documents hold is one name per batch in step 2 and one segment
per batch in step 3, so no place grows with the number of documents that repeat it.

What a row of batches has for a place travels as one message. In large inputs a row holds
several batches, worked on one after another, and places are larger, so there are not as
many messages as batches times places.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import discard, lighter, staged, table, tidy
from skyledger.llm.suffixes import smallest_owner

LENGTH = 50
BATCH = 1 << 20  # bytes of text in a batch
NAMES = 1_000_000  # names a place of step 2 gets, about
PLACE = 1 << 20  # bytes of segments a place of step 3 gets, about
PLACES_A_TASK = 3
ROWS = 128  # rows of batches, about, from which on a row holds several of them
TOGETHER = 16  # batches in a row at most
SPOTS = 1024  # places of step 3, about, from which on they get more than ``PLACE``
WIDEST = 4  # times ``PLACE`` that a place of step 3 gets at most, about
PART = 1 << 20  # bytes of different segments that are sorted at once

FIRST_GRAM, SECOND_GRAM = 20, 16


def squeeze(x: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(x)


def widen(x: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(x)


def freeze(x) -> bytes:
    return squeeze(pickle.dumps(x, protocol=5))


def thaw(x: bytes):
    return pickle.loads(widen(bytes(x)))


# ---- names of windows ------------------------------------------------------------

_ODD = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams of bytes, by doubling."""
    bits = [b for b in range(k.bit_length()) if k >> b & 1]
    level = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    level ^= level >> np.uint64(32)
    power, size, out, done = _ODD, 1, None, 0
    for b in range(k.bit_length()):
        if b in bits:
            if out is None:
                out, done = level, size
            else:  # the part so far comes after the larger one
                n = max(0, len(data) - done - size + 1)
                out = level[:n] * np.uint64(pow(_ODD, done, 1 << 64)) + out[size : size + n]
                done += size
        n = max(0, len(data) - 2 * size + 1)
        level = level[:n] * np.uint64(power) + level[size : size + n]
        power, size = pow(power, 2, 1 << 64), 2 * size
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def window_names(data: np.ndarray, length: int, k: int) -> np.ndarray:
    """The smallest k-gram hash in every window of ``length`` bytes."""
    width = length - k + 1
    low, size = gram_hashes(data, k), 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = width - size
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def runs(values: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of one value, also cut before the places ``cuts``."""
    change = np.append(True, values[1:] != values[:-1])
    change[cuts] = True
    starts = np.flatnonzero(change)
    return starts, np.append(starts[1:], len(values))


class Batch:
    """Some documents one after another."""

    def __init__(self, ids: np.ndarray, texts: list[bytes]):
        self.ids, self.texts = ids, texts
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(texts), np.uint8)

    def spans(self, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(name, first window, end window) of all runs of windows inside one document."""
        if len(self.data) < length:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        gram = min(gram, length)
        names = window_names(self.data, length, gram)
        inside = np.zeros(len(self.data) + 1, np.int64)
        enough = self.sizes >= length
        np.add.at(inside, self.starts[enough], 1)
        np.add.at(inside, self.starts[enough] + self.sizes[enough] - length + 1, -1)
        valid = np.cumsum(inside)[: len(names)] > 0
        edge = np.flatnonzero(np.append(False, valid[1:] != valid[:-1]))
        starts = self.starts[self.starts < len(names)]
        first, end = runs(names, np.concatenate((edge, starts)))
        keep = valid[first]
        first, end = first[keep], end[keep]
        return names[first], first, end


def _place(names: np.ndarray, places: int) -> np.ndarray:
    return ((names >> np.uint64(32)) * np.uint64(places) >> np.uint64(32)).astype(np.int64)


# ---- step 1: batches ---------------------------------------------------------------


def batches(docs: DataFrame, size: int = BATCH, together: int | None = None) -> DataFrame:
    """Packed rows (batch, n_bytes, blob) of ``docs`` (doc_id, text_key, text); with ``together``
    rows (batch, n_bytes, blobs) of up to that many batches."""

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        ids, keys, texts, held = [], [], [], 0
        blobs, volume, rows = [], 0, 0

        def close():
            blobs.append(freeze((np.array(ids, np.int64), np.array(keys, np.int64), texts)))

        def row():
            return pd.DataFrame({"batch": [number], "n_bytes": [volume], column: [blobs] if together else blobs})

        for part in parts:
            for doc_id, key, text in zip(part["doc_id"], part["text_key"], part["text"]):
                data = (text or "").encode()
                ids.append(doc_id)
                keys.append(key)
                texts.append(data)
                held += len(data)
                if held >= size or len(ids) >= 100_000:
                    close()
                    volume, rows = volume + held, rows + len(ids)
                    ids, keys, texts, held = [], [], [], 0
                    if len(blobs) >= (together or 1) or rows >= 100_000:
                        yield row()
                        number, blobs, volume, rows = number + 1, [], 0, 0
        if ids:
            close()
            volume += held
        if blobs:
            yield row()

    column = "blobs" if together else "blob"
    return docs.mapInPandas(tidy(pack), f"batch long, n_bytes long, {column} {'array<binary>' if together else 'binary'}")


# ---- step 2: which names occur twice ----------------------------------------------


def _sorted_names(opened: list[Batch], length: int):
    """The different names of some batches, how often they occur, and (number among them, first
    window, end window) of the runs of each batch."""
    spans = [batch.spans(length, FIRST_GRAM) for batch in opened]
    distinct, inverse, count = np.unique(np.concatenate([x[0] for x in spans]), return_inverse=True, return_counts=True)
    cuts = np.cumsum([len(x[0]) for x in spans])[:-1]
    return distinct, count, [(which, first, end) for which, (_, first, end) in zip(np.split(inverse, cuts), spans)]


def send_names(packed: DataFrame, length: int, places: int) -> DataFrame:
    def send(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for number, blobs in zip(part["batch"], part["blobs"]):
                distinct, count, _ = _sorted_names([Batch(ids, texts) for ids, _, texts in map(thaw, blobs)], length)
                if not len(distinct):
                    continue
                place = _place(distinct, places)
                starts, ends = runs(place, np.zeros(0, np.int64))
                short = (distinct & np.uint64(0xFFFFFFFF)).astype("<u4")
                twice = count > 1
                yield pd.DataFrame(
                    {
                        "place": place[starts],
                        "batch": number,
                        "names": [short[s:e].tobytes() for s, e in zip(starts, ends)],
                        "twice": [np.packbits(twice[s:e]).tobytes() for s, e in zip(starts, ends)],
                    }
                )

    return packed.mapInPandas(tidy(send), "place long, batch long, names binary, twice binary")


def _answer_names(rows: pd.DataFrame) -> pd.DataFrame:
    names = [np.frombuffer(x, "<u4") for x in rows["names"]]
    all_names = np.concatenate(names)
    twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=len(n)) for t, n in zip(rows["twice"], names)])
    _, inverse, count = np.unique(all_names, return_inverse=True, return_counts=True)
    weight = np.bincount(inverse, weights=twice)
    shared = ((count > 1) | (weight > 0))[inverse]
    cuts = np.cumsum([len(n) for n in names])[:-1]
    bits = [np.packbits(x).tobytes() for x in np.split(shared, cuts)]
    return pd.DataFrame({"batch": rows["batch"], "place": rows["place"], "bits": bits})


def open_documents(packed: DataFrame, answers: DataFrame, length: int, places: int) -> DataFrame:
    """Per row of batches: the settled documents as they are, the others, batch by batch, with
    their open windows."""
    per_batch = answers.groupBy("batch").agg(F.collect_list(F.struct("place", "bits")).alias("answers"))
    joined = packed.join(per_batch, "batch", "left")

    def one(ids, keys, texts, batch: Batch, flagged: np.ndarray, first: np.ndarray, end: np.ndarray):
        first, end = first[flagged], end[flagged]
        owner = np.searchsorted(batch.starts, first, side="right") - 1
        # Empty texts share their start with the next document, which is the last there.
        first, end = first - batch.starts[owner], end - batch.starts[owner]
        # Joined runs of windows, document by document.
        fresh = np.append(True, (owner[1:] != owner[:-1]) | (first[1:] != end[:-1])) if len(first) else np.zeros(0, bool)
        heads = np.flatnonzero(fresh)
        tails = np.append(heads[1:], len(first)) - 1
        spans = np.stack((owner[heads], first[heads], end[tails])) if len(heads) else np.zeros((3, 0), np.int64)
        opened = np.unique(spans[0])
        shut = np.setdiff1d(np.arange(len(ids)), opened)
        again = np.searchsorted(opened, spans[0])
        settled = [(int(ids[i]), int(keys[i]), len(texts[i]), hashlib.sha256(texts[i]).hexdigest()) for i in shut]
        packed_open = [freeze((ids[opened], keys[opened], [texts[i] for i in opened], again, spans[1], spans[2]))] if len(opened) else []
        return settled, packed_open, int((spans[2] - spans[1]).sum())

    def row(number: int, blobs, found) -> pd.DataFrame:  # what a row needs is freed with this call
        held = [(ids, keys, texts, Batch(ids, texts)) for ids, keys, texts in map(thaw, blobs)]
        distinct, _, spans = _sorted_names([batch for *_, batch in held], length)
        shared = np.zeros(len(distinct), bool)
        if len(distinct):
            place = _place(distinct, places)
            for answer in found if found is not None else []:
                low, high = np.searchsorted(place, [answer["place"], answer["place"] + 1])
                shared[low:high] = np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=high - low)
        settled, opened, windows = [], [], 0
        for batch, (which, first, end) in zip(held, spans):
            here, blob, n = one(*batch, shared[which], first, end)
            settled, opened, windows = settled + here, opened + blob, windows + n
        return pd.DataFrame({"batch": [number], "settled": [settled], "windows": [windows], "opened": [opened or None]})

    def mark(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for number, blobs, found in zip(part["batch"], part["blobs"], part["answers"]):
                yield row(number, blobs, found)

    shape = "batch long, settled array<struct<doc_id long, text_key long, n_bytes long, kept_sha256 string>>, windows long, opened array<binary>"
    return joined.mapInPandas(tidy(mark), shape)


# ---- step 3: segments meet -----------------------------------------------------------


def segments(opened: bytes, length: int, places: int):
    """The open documents of a batch, and their segments ordered by place.

    Returns (ids, keys, texts, owner, start, place, number of the distinct content,
    contents, smallest doc_id of each content); the order is the same on every call.
    """
    ids, keys, texts, owner, first, end = thaw(opened)
    pieces = [texts[o][f : e + length - 1] for o, f, e in zip(owner.tolist(), first.tolist(), end.tolist())]
    batch = Batch(np.zeros(len(pieces)), pieces)
    names, start, stop = batch.spans(length, SECOND_GRAM)
    piece = np.searchsorted(batch.starts, start, side="right") - 1
    inner = start - batch.starts[piece]
    reach = stop - start + length - 1
    place = _place(names, places)
    contents = [pieces[p][s : s + r] for p, s, r in zip(piece.tolist(), inner.tolist(), reach.tolist())]
    number: dict[bytes, int] = {}
    which = np.array([number.setdefault(c, len(number)) for c in contents], np.int64)
    smallest = np.full(len(number), np.iinfo(np.int64).max)
    doc = owner[piece]
    np.minimum.at(smallest, which, ids[doc])
    at = np.zeros(len(number), np.int64)
    at[which] = place
    return ids, keys, texts, doc, first[piece] + inner, which, list(number), smallest, at


def send_segments(opened: DataFrame, length: int, places: int) -> DataFrame:
    """A row of batches sends one message to a place: its batches' segments there, in turn."""

    def row(blobs) -> Iterator[tuple]:
        held: dict[int, tuple[list, list, list]] = {}
        for blob in blobs:
            *_, contents, smallest, at = segments(bytes(blob), length, places)
            order = np.argsort(at, kind="stable")
            starts, ends = runs(at[order], np.zeros(0, np.int64))
            sizes = np.array([len(c) for c in contents], "<u4")
            for s, e in zip(starts.tolist(), ends.tolist()):
                own = order[s:e]
                of_sizes, of_owners, of_bodies = held.setdefault(int(at[own[0]]), ([], [], []))
                of_sizes.append(sizes[own])
                of_owners.append(smallest[own])
                of_bodies.append(b"".join([contents[i] for i in own.tolist()]))
        for place in sorted(held):
            of_sizes, of_owners, of_bodies = held.pop(place)
            body = b"".join(of_bodies)
            yield place, squeeze(np.concatenate(of_sizes).tobytes()), squeeze(np.concatenate(of_owners).tobytes()), squeeze(body), len(body)

    def send(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for number, blobs in zip(part["batch"], part["opened"]):
                rows = []
                for place, *message in row(blobs):
                    rows.append((place, number, *message))
                    if len(rows) >= 500:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    columns = ["place", "batch", "sizes", "owners", "body", "n_bytes"]
    return opened.mapInPandas(tidy(send), "place long, batch long, sizes binary, owners binary, body binary, n_bytes long")


def _parts(contents: list[bytes], length: int, size: int | None = None) -> tuple[list[int], list[list[int]]]:
    """The contents that are alone under their window name, which share no string with any
    other, and the rest in parts to sort together; no name is in two parts."""
    size = PART if size is None else size
    gram = min(SECOND_GRAM, length)
    names = np.empty(len(contents), np.uint64)
    for s in range(0, len(contents), 5_000):
        some = contents[s : s + 5_000]
        starts = np.cumsum([0, *map(len, some)])[:-1]
        names[s : s + len(some)] = window_names(np.frombuffer(b"".join(some), np.uint8), length, gram)[starts]
    _, inverse, count = np.unique(names, return_inverse=True, return_counts=True)
    alone = count[inverse] == 1
    parts, part, held, last = [], [], 0, None
    order = np.argsort(names, kind="stable")
    for i in order[~alone[order]].tolist():
        if held > size and names[i] != last:
            parts.append(part)
            part, held = [], 0
        part.append(i)
        held += len(contents[i])
        last = names[i]
    return np.flatnonzero(alone).tolist(), [*parts, part] if part else parts


def _answer_segments(length: int, part_size: int):
    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        number: dict[bytes, int] = {}
        which, owners = [], []
        for sizes, own, body in zip(rows["sizes"], rows["owners"], rows["body"]):
            cuts = np.cumsum(np.frombuffer(widen(sizes), "<u4").astype(np.int64)).tolist()
            data, at, here = widen(body), 0, []
            for cut in cuts:
                here.append(number.setdefault(data[at:cut], len(number)))
                at = cut
            which.append(np.array(here, np.int64))
            owners.append(np.frombuffer(widen(own), np.int64))
        contents = list(number)
        smallest = np.full(len(contents), np.iinfo(np.int64).max)
        np.minimum.at(smallest, np.concatenate(which), np.concatenate(owners))
        answers: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(contents)
        alone, parts = _parts(contents, length, part_size)
        for i in alone:
            answers[i] = (np.array([len(contents[i]) - length + 1], "<u4"), smallest[i : i + 1])
        for part in parts:
            some = [contents[i] for i in part]
            found, starts = smallest_owner(some, smallest[part], length)
            sizes = np.array([len(c) for c in some], np.int64) - length + 1  # windows
            valid = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            values = found[valid]
            heads = np.cumsum(sizes) - sizes
            first, end = runs(values, heads)
            groups = np.searchsorted(first, heads)
            for i, a, b in zip(part, groups.tolist(), np.append(groups[1:], len(first)).tolist()):
                answers[i] = ((end[a:b] - first[a:b]).astype("<u4"), values[first[a:b]])
        out = []
        for own in which:
            picked = [answers[i] for i in own.tolist()]
            out.append(
                freeze((np.array([len(p[0]) for p in picked], "<u4"), np.concatenate([p[0] for p in picked]), np.concatenate([p[1] for p in picked])))
            )
        return pd.DataFrame({"batch": rows["batch"], "place": rows["place"], "answer": out})

    return answer


# ---- step 4: bytes to remove ------------------------------------------------------------

RESULT = "doc_id long, text_key long, n_bytes long, n_removed long, n_spans long, starts array<int>, ends array<int>, kept_sha256 string"


def _finish(length: int, places: int):
    def finish(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for blobs, found in zip(part["opened"], part["answers"]):
                answers = {}  # of a place: what is left of the answer, which has the batches in turn
                for row in found if found is not None else []:
                    count, sizes, values = thaw(row["answer"])
                    answers[row["place"]] = [0, np.append(0, np.cumsum(count.astype(np.int64))), sizes, values]
                for blob in blobs:
                    yield one(blob, answers)

    def one(blob, answers: dict[int, list]) -> pd.DataFrame:
        ids, keys, texts, doc, first, which, contents, _, at = segments(bytes(blob), length, places)
        order = np.argsort(at, kind="stable")
        runs_of = [None] * len(contents)
        starts, ends = runs(at[order], np.zeros(0, np.int64))
        for low, high in zip(starts.tolist(), ends.tolist()):
            answer = answers[int(at[order[low]])]
            begin, stops, sizes, values = answer
            cuts = stops[begin : begin + high - low + 1].tolist()
            answer[0] += high - low
            for i, s, e in zip(order[low:high].tolist(), cuts, cuts[1:]):
                runs_of[i] = (sizes[s:e], values[s:e])
        picked = [runs_of[i] for i in which.tolist()]
        count = np.array([len(p[0]) for p in picked], np.int64)
        sizes = np.concatenate([p[0] for p in picked]).astype(np.int64) if picked else np.zeros(0, np.int64)
        values = np.concatenate([p[1] for p in picked]) if picked else np.zeros(0, np.int64)
        before = np.cumsum(sizes) - sizes
        segment = np.repeat(np.arange(len(picked)), count)
        shift = before - before[np.cumsum(count) - count][segment] if len(sizes) else before
        start = first[segment] + shift
        owner = doc[segment]
        gone = ids[owner] > values
        start, stop, owner = start[gone], (start + sizes)[gone] + length - 1, owner[gone]
        turn = np.lexsort((start, owner))
        start, stop, owner = start[turn], stop[turn], owner[turn]
        cuts = np.searchsorted(owner, np.arange(len(ids) + 1))
        out = []
        for d, text in enumerate(texts):
            s, e = start[cuts[d] : cuts[d + 1]], stop[cuts[d] : cuts[d + 1]]
            if len(s):
                reach = np.maximum.accumulate(e)
                fresh = np.append(True, s[1:] > reach[:-1])
                heads = np.flatnonzero(fresh)
                s, e = s[heads], reach[np.append(heads[1:], len(fresh)) - 1]
            kept, last = hashlib.sha256(), 0
            for a, b in zip(s.tolist(), e.tolist()):
                kept.update(text[last:a])
                last = b
            kept.update(text[last:])
            out.append((int(ids[d]), int(keys[d]), len(text), int((e - s).sum()), len(s), s.tolist(), e.tolist(), kept.hexdigest()))
        return pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])

    return finish


def repeated(docs: DataFrame, length: int = LENGTH, place: int = PLACE, batch: int = BATCH, part: int = PART) -> DataFrame:
    """What of every text repeats a string of ``length`` bytes of a document with a smaller doc_id.

    One row per row of ``docs``: doc_id, text_key (xxhash64 of doc_id and text), n_bytes,
    n_removed, n_spans, the spans' starts and ends in bytes, and the SHA-256 of what is kept.
    Strings are judged on the input. A null text counts as empty. Rows with one doc_id never
    remove each other's strings. A row without doc_id is smaller than none: nothing is
    removed for it or because of it. An empty table gives no rows; other columns are left out.
    """
    lighter(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("text_key"), text)
    named = plain.where("doc_id is not null")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packed = staged(batches(named, batch, max(1, min(TOGETHER, size // (batch * ROWS)))))
    volume = packed.agg(F.sum("n_bytes")).first()[0] or 0
    places = max(1, -(-volume // (8 * NAMES)))
    sent = send_names(packed, length, places)
    # Tasks by number of places: their work is not told by the compressed bytes.
    answers = sent.repartition(min(places, 4000), "place").groupBy("place").applyInPandas(tidy(_answer_names), "batch long, place long, bits binary")
    marked = staged(open_documents(packed, answers, length, places))
    discard(packed)  # all that is still needed of it is in ``marked``
    settled = marked.select(F.explode("settled").alias("x")).select("x.*")
    opened = marked.where("opened is not null").select("batch", "windows", "opened")
    windows = opened.agg(F.sum("windows")).first()[0] or 0
    # A segment has about half as many windows as a name's window has k-grams, and length - 1 bytes more.
    swell = 1 + 2 * (length - 1) / max(1, length - SECOND_GRAM + 2)
    sent_bytes = int(windows * swell)
    spots = max(1, sent_bytes // max(place, min(WIDEST * place, sent_bytes // SPOTS)) + 1)
    # A few places a task: each is settled on its own, and starting a task costs more than most.
    met = send_segments(opened, length, spots).repartition(min(-(-spots // PLACES_A_TASK), 4000), "place").groupBy("place").applyInPandas(tidy(_answer_segments(length, part)), "batch long, place long, answer binary")
    per_batch = met.groupBy("batch").agg(F.collect_list(F.struct("place", "answer")).alias("answers"))
    cut = opened.join(per_batch, "batch", "left").mapInPandas(tidy(_finish(length, spots)), RESULT)
    none = F.array().cast("array<int>")
    zero = F.lit(0).cast("long")
    whole = settled.select("doc_id", "text_key", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), none.alias("starts"), none.alias("ends"), "kept_sha256")
    nameless = plain.where("doc_id is null").select(
        "doc_id", "text_key", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
        none.alias("starts"), none.alias("ends"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )
    return whole.unionByName(cut).unionByName(nameless)


STAGE_LENGTH = 101  # bytes; no passage of more than fifty words is shorter
STAGE_PLACE = STAGE_BATCH = 1 << 19  # halves: workers of earlier stages live on beside this one
STAGE_PART = 1 << 18  # sorting takes about 90 bytes of memory a byte


def without_repeats(docs: DataFrame, length: int = STAGE_LENGTH) -> DataFrame:
    """``docs`` with repeated passages cut from ``text`` (and ``n_chars`` set anew), all columns kept.

    A span is cut at whole characters. A document of which nothing but white space is left
    goes; texts without a repeat, null and empty ones among them, stay as they are.
    """
    spans = repeated(docs, length, STAGE_PLACE, STAGE_BATCH, STAGE_PART).where("n_removed > 0").select(F.col("doc_id").alias("_llm_id"), F.col("text_key").alias("_llm_key"), "starts", "ends")
    # Repeated rows have equal spans.
    spans = spans.dropDuplicates(["_llm_id", "_llm_key"]).withColumnsRenamed({"starts": "_llm_starts", "ends": "_llm_ends"})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.xxhash64(F.col("doc_id"), text)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        out = []
        for whole, s, e in zip(texts, starts, ends):
            if s is None:
                out.append(whole)
                continue
            data, kept, last = whole.encode(), [], 0
            for a, b in zip(s, e):
                while a < len(data) and data[a] & 0xC0 == 0x80:
                    a += 1
                while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
                    b -= 1
                kept.append(data[last:a])
                last = max(last, b)
            out.append(b"".join([*kept, data[last:]]).decode())
        return pd.Series(out, dtype=object)

    keyed = docs.withColumn("_llm_own", key)
    joined = keyed.join(spans, (keyed["doc_id"] == spans["_llm_id"]) & (keyed["_llm_own"] == spans["_llm_key"]), "left")
    touched = F.col("_llm_starts").isNotNull()
    done = joined.withColumn("_llm_text", cut(F.col("text").cast("string"), "_llm_starts", "_llm_ends"))
    done = done.where(~touched | F.col("_llm_text").rlike(r"[^\s]"))
    new = {"text": F.col("_llm_text"), "n_chars": F.when(touched, F.length("_llm_text").cast("long")).otherwise(F.col("n_chars") if "n_chars" in docs.columns else F.lit(None))}
    return done.select(*[(new[c] if c in new else F.col(c)).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What of all documents repeats 50 bytes of an earlier one."""
    return repeated(table(spark, folder, "documents")).drop("text_key", "starts", "ends")
