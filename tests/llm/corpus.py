"""Small tables with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for columns of their own.
CLASHING = "size long, key string, shard string, score string, starts string, batch string, fp string"


def rows(spark, count: int = 60) -> list[tuple]:
    """Given documents, then nulls, blanks, copies, ties, repeated rows and very long texts."""
    found = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(count).collect()]
    first, second = found[0][1], found[1][1]
    near = first.split(" ")
    near[len(near) // 2] = "changed"
    extra = [
        (1000, None, "en", "src0", None),
        (1001, "", None, None, 0),
        (1002, " \n\t ", "en", "", 4),
        (1003, "word and other " * 8000, "en", "src0", 120000),
        (1004, "x" * 40_000, None, "src1", 40000),
        (1005, first, "en", "src0", len(first)),
        (1005, first, "en", "src0", len(first)),
        (1006, "# 12 !! 7", "en", "src2", 9),
        (1007, " ".join(near), "en", "src0", len(first)),
        (1008, "é" * 70 + " <|endoftext|> naïve \U0001f600 " + second[:400], "fr", "src3", 500),
        (None, second, "en", None, len(second)),
        (3, "another text under a used number", "en", "src0", 32),
    ]
    return found + extra


def documents(spark, count: int = 60, clash: bool = True):
    data = rows(spark, count)
    if clash:
        return spark.createDataFrame([(*r, 1, "a", "b", "c", "d", "e", "f") for r in data], f"{DOCS}, {CLASHING}").repartition(3)
    return spark.createDataFrame(data, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text) -> list[str]:
    return (text or "").translate(LOWER).encode().decode().replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if text else []


def tokens(text) -> list[bytes]:
    return (text or "").translate(LOWER).encode().split()


def shingles(text, width: int) -> list[bytes]:
    w = tokens(text)
    return [b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) > width else [b" ".join(w)] if w else []


def removed(data: list[tuple], length: int) -> list[bytearray]:
    """A mark for every byte that an earlier document's string covers."""
    first: dict[bytes, int] = {}
    for doc_id, text in data:
        if doc_id is not None:
            b = (text or "").encode()
            for i in range(len(b) - length + 1):
                s = b[i : i + length]
                first[s] = min(first.get(s, doc_id), doc_id)
    out = []
    for doc_id, text in data:
        b = (text or "").encode()
        mark = bytearray(len(b))
        if doc_id is not None:
            for i in range(len(b) - length + 1):
                if first[b[i : i + length]] < doc_id:
                    mark[i : i + length] = b"\1" * length
        out.append(mark)
    return out


def fingerprint(text, width: int = 4) -> int:
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles(text, width)]
    return sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in values) > len(values))


def classes(count: int, linked) -> list[int]:
    """Per item the smallest index reachable; ``linked(i, j)`` tells a link."""
    parent = list(range(count))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(count):
        for j in range(i + 1, count):
            if root(i) != root(j) and linked(i, j):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(count)]


def ppm_scores(data: list[tuple], order: int) -> list[tuple]:
    """(held_out, n_tokens, n_known, N, base, score) straight from the definitions."""
    crc = [zlib.crc32(b"" if d is None else str(d).encode()) % 5 for d, _ in data]
    counts, trie = Counter(), defaultdict(Counter)

    def marked(text):
        return b"\xfe" * order + (text or "").translate(LOWER).encode() + b"\xff"

    for (_, text), c in zip(data, crc):
        if c != 1:
            counts.update(tokens(text))
            counts["end"] += 1
            b = marked(text)
            for i in range(order, len(b)):
                for j in range(order + 1):
                    trie[b[i - j : i]][b[i]] += 1
    total, different = sum(counts.values()), len(counts)
    out = []
    for (_, text), c in zip(data, crc):
        own = [*tokens(text), "end"]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (different + 1))) for w in own)
        b, score = marked(text), 0.0
        for i in range(order, len(b)):
            ruled_out, found = set(), False
            for j in range(order, -1, -1):
                seen = trie.get(b[i - j : i])
                n = sum(v for k, v in seen.items() if k not in ruled_out) if seen else 0
                if not n:
                    continue
                if b[i] in seen:
                    score += math.log10((2 * seen[b[i]] - 1) / (2 * n))
                    found = True
                    break
                score += math.log10(sum(k not in ruled_out for k in seen) / (2 * n))
                ruled_out |= set(seen)
            if not found:
                score -= math.log10(256 - len(trie.get(b"", ())))
        out.append((c == 1, len(own), sum(counts[w] > 0 for w in own), total, base, score))
    return out


def vectors() -> list[tuple]:
    """(vec_id, embedding, label) with ties, copies, scaled copies, near ones and unusable ones."""
    rng = np.random.default_rng(5)
    plain = rng.normal(size=(120, 16)).astype(np.float32)
    out = [(i, v.tolist(), i % 3) for i, v in enumerate(plain)]
    out += [(200 + i, (plain[i] + rng.normal(size=16) * 0.15).astype(np.float32).tolist(), i % 3) for i in range(60)]
    out += [(300 + i, plain[0].tolist(), 0) for i in range(30)]
    out += [(350, (plain[1] * 4).tolist(), 1), (351, plain[1].tolist(), 2), (352, plain[1].tolist(), None)]
    out += [(400, None, 0), (401, [0.0] * 16, 0), (402, [float("nan")] + [1.0] * 15, 0), (403, [None] + [1.0] * 15, 0), (404, [], 0)]
    out += [(405, [float("inf")] + [1.0] * 15, 0), (406, [1.0, 2.0], 0), (407, [2.0, 4.0], 0)]
    out += [(300, plain[0].tolist(), 0), (None, plain[2].tolist(), 2), (450, plain[3].tolist(), 0)]
    return out


VECTORS = "vec_id long, embedding array<float>, label int"


def fine(v) -> bool:
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cos(a, b) -> float:
    a, b = np.array(a, float), np.array(b, float)
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))
