"""Operators on texts against brute force, on every awkward case."""

import hashlib
import zlib

import corpus
import numpy as np
import pytest
from tokenizers import Tokenizer

from skyledger.llm import langid, mixing, packing, repeats, scoring, sharding, simhash, tokens
from skyledger.llm.suffixes import smallest_owner


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.documents(spark).cache()


@pytest.fixture(scope="module")
def data(spark):
    return corpus.rows(spark)


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def same(left, right):
    assert sorted(map(repr, left)) == sorted(map(repr, right))


@pytest.mark.parametrize("length", [1, 3, 8])
def test_suffix_groups(length):
    rng = np.random.default_rng(length)
    for _ in range(40):
        segments = [bytes(rng.choice(list(b"ab\0c"), rng.integers(1, 30)).astype(np.uint8)) for _ in range(rng.integers(1, 12))]
        owners = rng.integers(0, 20, len(segments))
        found, starts = smallest_owner(segments, owners, length)
        best = {}
        for s, o in zip(segments, owners):
            for i in range(len(s) - length + 1):
                best[s[i : i + length]] = min(best.get(s[i : i + length], 99), o)
        for s, at in zip(segments, starts):
            assert all(found[at + i] == best[s[i : i + length]] for i in range(len(s) - length + 1))


def test_window_names_are_local():
    data = np.random.default_rng(1).integers(0, 4, 500).astype(np.uint8)
    whole = repeats.window_names(data, 50, 20)
    assert len(whole) == 451
    assert all(repeats.window_names(data[i : i + 50].copy(), 50, 20)[0] == whole[i] for i in range(0, 451, 7))


def test_suffix_dedup(docs, data):
    expected = []
    for (doc_id, text, *_), mark in zip(data, corpus.removed([r[:2] for r in data], 50)):
        b = (text or "").encode()
        spans = sum(1 for i, m in enumerate(mark) if m and (i == 0 or not mark[i - 1]))
        kept = hashlib.sha256(bytes(x for x, m in zip(b, mark) if not m)).hexdigest()
        expected.append((doc_id, len(b), sum(mark), spans, kept))
    found = repeats.repeated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    same(map(tuple, found), expected)


def test_large_meeting_places_are_split(monkeypatch, spark, data):
    contents = [(t or "").encode()[i : i + 70] for _, t, *_ in data[:20] for i in range(0, len(t or "") - 70, 20)]
    monkeypatch.setattr(repeats, "PART", 2000)
    contents += [c[k:] for c in contents for k in (1, 2)]
    alone, parts = repeats._parts(contents, 50)
    assert len(parts) > 5 and sorted([*alone, *(i for p in parts for i in p)]) == list(range(len(contents)))


def test_repeats_of_a_long_period(spark):
    """A run of windows with one name as long as the text, in two documents."""
    line = "-- one line of a period, again and again\n"[:35]
    long = (line * 3000)[:100_000]
    rows = spark.createDataFrame([(1, "first " + long), (2, "other: " + long), (3, "alone")], "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in repeats.repeated(rows).collect()}
    assert found == {1: (0, 0), 2: (100_001, 1), 3: (0, 0)}


def test_batches_of_a_row_send_one_message_to_a_place(spark, docs, monkeypatch):
    """Rows of several batches, and larger places: far fewer messages, the same spans."""
    sent = []

    def counted(rows, length, places):
        out = real(rows, length, places)
        sent.append((out.count(), places))
        return out

    real = repeats.send_segments
    monkeypatch.setattr(repeats, "send_segments", counted)
    few = docs.coalesce(1)
    single = sorted(map(str, repeats.repeated(few, batch=3000, place=1000).collect()))
    monkeypatch.setattr(repeats, "ROWS", 2)
    monkeypatch.setattr(repeats, "SPOTS", 2)
    assert sorted(map(str, repeats.repeated(few, batch=3000, place=1000).collect())) == single
    assert 5 * sent[1][0] < sent[0][0] and 3 * sent[1][1] < sent[0][1]
    assert repeats.TOGETHER > 2 < repeats.WIDEST


@pytest.mark.parametrize("shards", [7, 40])
def test_sharding(docs, data, shards):
    found = sharding.shard(docs, shards).collect()
    assert len(found) == len(data)
    counts = np.bincount([r["shard"] for r in found], minlength=shards)
    assert counts.max() - counts.min() <= 1 and len(counts) == shards
    for s in range(shards):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(counts[s]))
    expected = [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in data]
    same([(r["doc_id"], r["size"], r["text_crc32"]) for r in found], expected)
    where = {}
    for r in found:
        where.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    room = len(data) // shards
    many = {k: v for k, v in where.items() if sum((r["text_crc32"], r["size"]) == k for r in found) <= room}
    assert all(len(v) == 1 for v in many.values())


def test_sharding_cuts_only_what_does_not_fit(spark):
    text = lambda i: "same" if i < 70 else f"pair {i // 2}" if i < 130 else f"alone {i}"
    rows = [(i, text(i), "en", "s", 1) for i in range(300)]
    found = sharding.shard(spark.createDataFrame(rows, corpus.DOCS), 6).collect()
    assert np.bincount([r["shard"] for r in found]).tolist() == [50] * 6
    assert len({r["shard"] for r in found if r["doc_id"] < 70}) == 2
    of = {r["doc_id"]: r["shard"] for r in found}
    assert sum(of[i] != of[i + 1] for i in range(70, 130, 2)) <= 2


def test_sharding_when_every_document_is_linked(spark):
    rows = [(i, f"text {i // 3}", "en", "s", 1) for i in range(120)]
    found = sharding.shard(spark.createDataFrame(rows, corpus.DOCS), 4, rounds=6).collect()
    assert np.bincount([r["shard"] for r in found]).tolist() == [30] * 4
    of = {r["doc_id"]: r["shard"] for r in found}
    assert sum(len({of[3 * g + k] for k in range(3)}) - 1 for g in range(40)) <= 30  # of 80 when dealt out


def test_fingerprints_and_components(docs, data):
    prints = [corpus.fingerprint(t) for _, t, *_ in data]
    roots = corpus.classes(len(data), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    lowest = {}
    for (d, *_), r in zip(data, roots):
        if d is not None:
            lowest[r] = min(lowest.get(r, d), d)
    found = simhash.near_duplicates(docs).collect()
    expected = [(d, p, lowest.get(r)) for (d, *_), p, r in zip(data, prints, roots)]
    same([(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in found], expected)


def test_links_of_planted_fingerprints(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 7), replace=False)) for b in base for _ in range(3)]
    fps = np.array([*map(int, base), *near], np.uint64)
    roots = corpus.classes(len(fps), lambda i, j: int(fps[i] ^ fps[j]).bit_count() <= 4)
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    links = [tuple(r) for r in simhash.links(frame).collect()]
    place = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    pairs = {(min(place[a], place[b]), max(place[a], place[b])) for a, b in links}
    assert corpus.classes(len(fps), lambda i, j: (i, j) in pairs) == roots
    big = np.repeat(fps[:1], 300) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    a, b = simhash.linked(np.zeros(300, np.int64), big, simhash.dense_references(), 4)
    assert len(set(np.delete(np.arange(300), a))) == 1 and len(a) == len(b) == 299


def test_token_counts(docs, data, library):
    found = {}
    for r in tokens.token_counts(docs).collect():
        found.setdefault((r["doc_id"], r["section"]), []).append((r["start"], r["n_bytes"], r["n_tokens"], r["n_crossing"]))
    expected = {}
    for doc_id, text, *_ in data:
        text = text or ""
        lines = text.encode().split(b"\n")
        starts = np.cumsum([0, *[len(x) + 1 for x in lines[:-1]]])
        starts = [int(s) for s in starts if s < len(text.encode())] or [0]
        size = len(text.encode())
        ends = [*starts[1:], size]
        count, crossing = [0] * len(starts), [0] * len(starts)
        spans = [len(text[:a].encode()) for a, _ in library.encode(text, add_special_tokens=False).offsets] if text.isascii() else None
        if spans is None:
            continue
        stops = [*spans[1:], size]
        for a, b in zip(spans, stops):
            s = int(np.searchsorted(starts, a, side="right")) - 1
            count[s] += 1
            crossing[s] += b > ends[s]
        for s, (a, b) in enumerate(zip(starts, ends)):
            expected.setdefault((doc_id, s), []).append((a, b - a, count[s], crossing[s]))
    assert expected
    for key, value in expected.items():
        assert all(v in found[key] for v in value), key
    total = sum(x[2] for v in found.values() for x in v)
    assert total == sum(len(library.encode(t or "", add_special_tokens=False).ids) for _, t, *_ in data)


def test_encoder_equals_library(data, library):
    odd = ["  a  b\n\n c \n", " x", "x ", "", "a <|endoftext|> b", "it's  <|endoftext|>x\n\n\ny", "\x1c x\x1d y", "a b  c", "\n ", " \n"]
    for text in [*odd, *[t for _, t, *_ in data if t]]:
        ids = np.frombuffer(tokens.encoder().ids(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_lm_scores(docs, data):
    found = scoring.score(docs, order=3).collect()
    expected = corpus.ppm_scores([r[:2] for r in data], 3)
    left = sorted([(str(r["doc_id"]), r["n_tokens"], r["held_out"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found])
    right = sorted([(str(d), e[1], e[0], e[2], e[3], e[4], e[5]) for (d, *_), e in zip(data, expected)])
    assert [x[:5] for x in left] == [x[:5] for x in right]
    assert np.allclose([x[5] for x in left], [x[5] for x in right], rtol=1e-9)
    assert np.allclose([x[6] for x in left], [x[6] for x in right], rtol=1e-6)  # lengths travel in single precision


def test_lm_chances_add_up(spark):
    """After any context the chances of all byte values sum to one."""
    rng = np.random.default_rng(2)
    totals = {}
    for _ in range(400):
        gram = int.from_bytes(bytes(rng.choice(list(b"abc"), 4).astype(np.uint8)), "big")
        totals[gram] = totals.get(gram, 0) + 1
    contexts = [int.from_bytes(c, "big") << 8 for c in (b"abc", b"zab", b"zzc", b"zzz", b"cab")]
    asked = {c | s for c in contexts for s in range(256)}
    frame = spark.createDataFrame([(g, totals.get(g, 0)) for g in asked | set(totals)], "gram long, n long")
    chance = {r["gram"]: 10 ** r["bits"] for r in scoring.code_lengths(frame, 3).collect()}
    for c in contexts:
        assert abs(sum(chance[c | s] for s in range(256)) - 1) < 1e-9


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    parts = docs.withColumn("out", langid.fold(docs["doc_id"]) == 0)
    found = langid.identify(parts.where("out"), langid.fit(parts.where("not out"))).collect()
    assert len(found) > 150 and np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.98


def test_language_cases(docs, data):
    found = langid.identify(docs, langid.fit(docs)).collect()
    assert len(found) == len(data)
    assert all(0 <= r["score"] <= 1 for r in found)
    for r in found:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")), r["doc_id"]


def test_bloom_false_hits_are_corrected(spark):
    """In a filter filled to the brim, an unknown language's score is still near zero."""
    rng = np.random.default_rng(4)
    text = lambda low, n: " ".join("".join(chr(low + int(k)) for k in rng.integers(0, 24, 6)) for _ in range(n))
    rows = [(text(97, 400), "aa")] * 2 + [(text(0x430, 400), "bb")] * 2
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"), slots=1 << 12)
    assert (model["false"] > 0.05).all()
    langs, score = langid.decide([text(97, 50), text(0x430, 50), text(0x3b1, 200)], model)
    assert langs[:2] == ["aa", "bb"] and score[2] < 0.15


def test_packing(docs, data, library):
    capacity = 300
    found = packing.pack(docs, capacity, shard=40).collect()
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append(r)
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    expected = []
    for doc_id, text, *_ in data:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity if len(ids) > capacity else len(ids)
        cuts = [0, *range(first or capacity, len(ids), capacity), len(ids)] if len(ids) > capacity else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    same([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found], expected)
    least = -(-sum(r["length"] for r in found) // capacity)
    assert len(bins) <= least * 1.1 + 2


def test_genetic_packing_keeps_every_item():
    rng = np.random.default_rng(6)
    size = rng.integers(1, 900, 300).tolist()
    parents = [packing.best_fit(list(rng.permutation(300)), size, [], 1000) for _ in range(2)]
    child = packing.crossover(*parents, size, 1000, rng)
    best = packing.evolve(size, [], 1, 1000, 3, 3)
    for bins in (child, best, packing._decode(packing._encode(best, 300))):
        assert sorted(i for b in bins for i in b) == list(range(300))
        assert max(sum(size[i] for i in b) for b in bins) <= 1000
    assert len(best) <= len(parents[0])


def test_mixing(docs, data):
    found = mixing.mix(docs).collect()
    again = mixing.mix(docs).collect()
    same(map(tuple, found), map(tuple, again))
    size = [len(corpus.tokens(t)) for _, t, *_ in data]
    same([(r["doc_id"], r["size"]) for r in found], [(d, s) for (d, *_), s in zip(data, size)])
    sources = sorted({r[3] for r in data}, key=lambda s: (s is None, s or ""))
    own = [sum(s for s, r in zip(size, data) if r[3] == source) for source in sources]
    goal = mixing.targets(own, [(3, 1, 2)[i % 3] for i in range(len(sources))], 1.5 * sum(own), 2)
    assert abs(sum(goal) - 1.5 * sum(own)) < 1e-6
    for source, n, g in zip(sources, own, goal):
        rows = [r for r in found if r["source"] == source]
        assert all(abs(r["target"] - g) < 1e-6 and r["source_size"] == n and r["taken"] <= 2 * r["size"] for r in rows)
        assert all(r["taken"] % r["size"] == 0 for r in rows if r["size"])
        largest = max((r["size"] for r in rows), default=0)
        assert abs(sum(r["taken"] for r in rows) - g) <= largest / 2 + 1


def test_cube_keeps_totals():
    rng = np.random.default_rng(8)
    chance, size = rng.random(500), rng.integers(1, 400, 500)
    for blocks in (1, 4):
        p = mixing.flight(chance.copy(), size, rng.random(2000))
        open_ = (p > 0) & (p < 1)
        assert open_.sum() <= 2
        assert abs(p.sum() - chance.sum()) < 1e-6 and abs((p * size).sum() - (chance * size).sum()) < 1e-4, blocks
    mean = sum(mixing.flight(np.full(9, 1 / 3), np.arange(1, 10), rng.random(40)) for _ in range(900)) / 900
    assert (abs(mean - 1 / 3) < 0.07).all()


def test_mixing_in_small_blocks(spark):
    rows = [(i, "w " * (1 + i % 50), "en", f"s{i % 2}", 1) for i in range(2000)]
    found = mixing.mix(spark.createDataFrame(rows, corpus.DOCS), block=60).collect()
    for s in ("s0", "s1"):
        own = [r for r in found if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 25


EMPTY = {
    "repeats": repeats.repeated,
    "sharding": sharding.shard,
    "simhash": simhash.near_duplicates,
    "tokens": tokens.token_counts,
    "scoring": scoring.score,
    "langid": lambda d: langid.identify(d, langid.fit(d)),
    "packing": packing.pack,
    "mixing": mixing.mix,
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty_table(spark, name):
    assert EMPTY[name](corpus.empty(spark)).count() == 0
