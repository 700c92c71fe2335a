"""Token ids of whole documents, and tokens per section by offset-mapped attribution.

A document is encoded once. The vocabulary is a byte-level BPE, so each id stands for a
fixed number of bytes and the running sum of those numbers is every token's span. Sections
are spans of the same bytes; a token is joined to the section that holds its first byte,
and a token that runs past the end of that section is counted as crossing.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import own_ids, per_process, table, tidy, whole_ids

VOCABULARY = "byte_bpe_50k"
CACHE = 600_000

# A text may be cut before a single space between two characters that are not white space:
# no token of this vocabulary's splitting rule reaches over such a place.
CUT = re.compile(r"(?<=\S) (?=\S)")


def pieces(text: str) -> list[str]:
    """The text cut at the single spaces between two characters that are not white space."""
    if "\n " in text or " \n" in text:
        return CUT.split(text)
    plain = text.split(" ")
    lines = text.replace("\n", ".")
    same = plain if lines is text else lines.split(" ")
    return plain if lines.split() == same else CUT.split(text)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes; remembers the pieces it has seen."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.end = len(ranks)  # the id of the end-of-text string, which is no rank
        self.special = "<|endoftext|>"
        self.encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={self.special: self.end}
        )
        self.plain = self.encoding._core_bpe.encode_ordinary
        self.single = self.encoding._core_bpe.encode_single_piece
        self.widths = np.zeros(len(ranks) + 1, np.int64)
        for token, rank in ranks.items():
            self.widths[rank] = len(token)
        self.widths[self.end] = len(self.special)
        self.spaced: dict[str, bytes] = {}  # piece -> ids of a space and the piece

    def _fresh(self, piece: str) -> bytes:
        if "<|" in piece:
            ids = self.encoding.encode(piece, allowed_special="all")
        elif piece.isascii() and piece[1:].isalpha() and piece[0] == " ":  # one word: nothing to split
            ids = self.single(piece.encode())
        else:
            ids = self.plain(piece)
        return array("I", ids).tobytes()

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        known = self.spaced
        if len(known) > CACHE:
            known.clear()
        first, *rest = pieces(text)
        found = list(map(known.get, rest))
        if None in found:
            for at, ids in enumerate(found):
                if ids is None:
                    piece = rest[at]
                    found[at] = known[piece] = self._fresh(" " + piece)
        return (self._fresh(first) if first else b"") + b"".join(found)


    def forget(self) -> None:
        """Drops the remembered pieces: workers live on, and the next stage needs the room."""
        self.spaced.clear()


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    return per_process(f"encoder {vocabulary}", lambda: Encoder(vocabulary))


@contextmanager
def remembering(vocabulary: str = VOCABULARY) -> Iterator[Encoder]:
    """The process's encoder, for one task: what it remembers goes with the task."""
    code = encoder(vocabulary)
    try:
        yield code
    finally:
        code.forget()


def line_sections(text: bytes) -> np.ndarray:
    """Start bytes of the sections of a text: its lines, each with its line end."""
    data = np.frombuffer(text, np.uint8)
    starts = np.flatnonzero(data == 10) + 1
    starts = starts[starts < len(data)]
    return np.concatenate(([0], starts)) if len(data) else np.zeros(0, np.int64)


def attribute(widths: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that begin in each section, and those of them that reach past its end."""
    ends = np.cumsum(widths)
    begins = ends - widths
    section = np.searchsorted(starts, begins, side="right") - 1
    limits = np.append(starts[1:], size)
    count = np.bincount(section, minlength=len(starts))
    crossing = np.bincount(section[ends > limits[section]], minlength=len(starts))
    return count, crossing


SECTION_SHAPE = "doc_id long, section int, start long, n_bytes long, n_tokens long, n_crossing long"


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, sections=line_sections) -> DataFrame:
    """Tokens of every section (line) of every document: one row per document and section.

    A token belongs to the section with its first byte; ``n_crossing`` of a section's tokens
    end in a later one. Over a document the counts add up to its tokens. Null and empty
    texts give one row with section 0 and no tokens. Rows with one doc_id are separate
    documents, and so are rows without one. An empty table gives no rows. Other columns are
    left out of the result.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with remembering(vocabulary) as code:
            yield from counted(batches, code)

    def counted(batches: Iterator[pd.DataFrame], code: Encoder) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[np.ndarray] = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                data = text.encode() if text else b""
                starts = sections(data)
                if not len(starts):
                    out.append(np.array([[doc_id, 0, 0, 0, 0, 0]], object))
                    continue
                widths = code.widths[np.frombuffer(code.ids(text), "<u4")]
                tokens, crossing = attribute(widths, starts, len(data))
                sizes = np.diff(np.append(starts, len(data)))
                rows = np.empty((len(starts), 6), object)
                rows[:, 0] = doc_id
                for at, column in enumerate((np.arange(len(starts)), starts, sizes, tokens, crossing), 1):
                    rows[:, at] = column
                out.append(rows)
                if sum(map(len, out)) > 50_000:
                    yield pd.DataFrame(np.concatenate(out), columns=names)
                    out = []
            if out:
                yield pd.DataFrame(np.concatenate(out), columns=names)

    names = [part.split()[0] for part in SECTION_SHAPE.split(", ")]
    return own_ids(docs.select(whole_ids(), F.col("text").cast("string").alias("text")).mapInPandas(tidy(count), SECTION_SHAPE))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every line of all documents."""
    return token_counts(table(spark, folder, "documents"))

