"""Every stage against brute force on its own input, and the registered queries."""

import compare
import corpus
import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from skyledger.llm import mixing, queries, repeats, simhash
from skyledger.llm.common import staged


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.documents(spark).cache()


def plain(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=repr)


def test_language_rejects_what_has_no_letters(spark, docs):
    found = corpus_pipeline.language(spark, docs, corpus.SF)
    assert found.columns == docs.columns
    left = [r for r in plain(docs) if any(c.isalpha() for c in r[1] or "")]
    # The text of one letter repeated is no language's.
    assert [r for r in left if r[0] != 1004] == [r for r in plain(found) if r[0] != 1004]


def test_one_of_each_class_stays(spark, docs):
    data = plain(docs)
    sets = [set(corpus.shingles(r[1], 5)) for r in data]

    def alike(i, j):
        a, b = sets[i], sets[j]
        return (not a and not b) or len(a & b) >= 0.8 * len(a | b)

    roots = corpus.classes(len(data), alike)
    best = {}
    for r, root in zip(data, roots):
        rank = (r[0] is None, r[0])
        if root not in best or rank < best[root][0]:
            best[root] = (rank, r)
    found = corpus_pipeline.near_duplicates(spark, docs, corpus.SF)
    assert found.columns == docs.columns
    assert plain(found) == sorted((r for _, r in best.values()), key=repr)


def test_repeated_passages_go(spark, docs):
    data = plain(docs)
    expected = []
    for (doc_id, text, *rest), mark in zip(data, corpus.removed([r[:2] for r in data], 101)):
        if not any(mark):
            expected.append((doc_id, text, *rest))
            continue
        b, out, at = text.encode(), b"", 0
        edges = np.flatnonzero(np.diff(np.concatenate(([0], np.frombuffer(mark, np.uint8), [0])).astype(int)))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            while s < len(b) and b[s] & 0xC0 == 0x80:
                s += 1
            while e < len(b) and e > s and b[e] & 0xC0 == 0x80:
                e -= 1
            out, at = out + b[at:s], e
        left = (out + b[at:]).decode()
        if left.strip():
            expected.append((doc_id, left, *rest[:2], len(left)))
    found = corpus_pipeline.repeated_passages(spark, docs, corpus.SF)
    assert found.columns == docs.columns
    assert plain(found) == sorted(expected, key=repr)
    assert len(expected) < len(data)


def test_passages_of_fifty_one_short_words_go(spark):
    passage = " ".join("abcdefghij"[i % 10] for i in range(51))
    rows = [(i, f"start of text {i} {passage} end of text {i}", "en", "a", 1) for i in range(4)]
    found = corpus_pipeline.repeated_passages(spark, spark.createDataFrame(rows, corpus.DOCS), corpus.SF).collect()
    assert [passage in r.text for r in sorted(found)] == [True, False, False, False]


def test_mix_takes_effect(spark, docs):
    found = corpus_pipeline.mixed(spark, docs, corpus.SF)
    assert found.columns == docs.columns
    got = plain(found)
    expected = {}
    for r in mixing.mix(docs).collect():
        if r["size"]:
            expected[r["source"]] = r["target"]
    for source, target in expected.items():
        own = [r for r in got if r[3] == source]
        largest = max(len(corpus.tokens(r[1])) for r in plain(docs) if r[3] == source)
        assert abs(sum(len(corpus.tokens(r[1])) for r in own) - target) <= largest
    assert set(got) <= set(plain(docs))
    assert max(got.count(r) for r in got) <= 4  # twice each of two equal rows


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_input(spark, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, corpus.empty(spark), corpus.SF).count() == 0


def test_registered():
    known = __spark_entry__.queries()
    assert all(any(k.startswith(f"op{n}_") for k in known) for n in range(1, 11)) and "pipeline" in known
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    df = queries.queries()[name](spark, corpus.SF)
    assert compare.differences(df, compare.connection(corpus.SF), queries.oracle_sql()[name]) == ""


def test_run_packs_everything_kept(spark):
    rows = corpus_pipeline.run(spark, corpus.SF).collect()
    totals = {}
    for r in rows:
        totals[r["sequence_id"]] = totals.get(r["sequence_id"], 0) + r["length"]
    assert rows and max(totals.values()) <= 2048
    assert len(totals) <= -(-sum(totals.values()) // 2048) * 1.05 + 2


def _kept(spark, texts, **how):
    rows = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], corpus.DOCS).repartition(3)
    return {r["doc_id"] for r in simhash.one_of_each(rows, **how).collect()}


@pytest.mark.parametrize("chunk", [4096, 500])
def test_pairs_inside_a_family_of_templates(spark, chunk):
    """Documents that share most of a template, at a similarity of about 0.73, and near copies of some."""
    template, texts = [f"t{k}" for k in range(170)], []
    for i in range(2000):
        texts.append(" ".join([*template, *[f"own{i}x{k}" for k in range(30)]]))
    for i in range(0, 2000, 20):
        words = texts[i].split()
        words[1] = f"other{i}"
        texts.append(" ".join(words))
    sets = [set(corpus.shingles(t, 5)) for t in texts]
    assert 0.6 < len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.75
    assert len(sets[0] & sets[2000]) / len(sets[0] | sets[2000]) > 0.9
    assert _kept(spark, texts, chunk=chunk) == set(range(2000))


def test_a_group_of_near_copies_meets_by_its_centre(spark, monkeypatch):
    """Near copies that fingerprints leave apart are not paired with one another, and none is lost."""
    rng, texts = np.random.default_rng(5), []
    for i in range(700):
        words = [f"t{k}" for k in range(150)]
        for k in rng.choice(150, 1 + i % 4, replace=False).tolist():
            words[k] = f"own{i}x{k}"
        texts.append(" ".join(words))
    made = []

    def counted(df):
        out = staged(df)
        if out.columns == ["a", "b"]:
            made.append(out.count())
        return out

    sets = [set(corpus.shingles(t, 5)) for t in texts]
    roots = corpus.classes(len(sets), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    monkeypatch.setattr(simhash, "staged", counted)
    monkeypatch.setattr(simhash, "fingerprint_pairs", lambda rows: spark.createDataFrame([], "a long, b long"))
    assert _kept(spark, texts) == {min(i for i, r in enumerate(roots) if r == root) for root in set(roots)}
    assert max(made) < 20 * len(texts)


def test_pairs_at_the_boundary(spark):
    """One word of 49 changed leaves 40 of 50 shingles, a similarity of just 0.8; one of 48 leaves less."""
    texts, gone = [], set()
    for i in range(400):
        words = [f"w{i}x{k}" for k in range(49 if i % 2 == 0 else 48)]
        again = [*words[:24], "changed", *words[25:]]
        if i % 4 == 0:  # the same distinct shingles, some of them very often
            again += words[:24] * 9 if i % 8 else []
        texts += [" ".join(words), " ".join(again)]
    sets = [set(corpus.shingles(t, 5)) for t in texts]
    for i in range(0, len(texts), 2):
        if len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1]):
            gone.add(i + 1)
    assert 100 <= len(gone) < 400
    assert _kept(spark, texts) == set(range(len(texts))) - gone


def test_fingerprints_find_near_copies_first(spark, monkeypatch):
    """The links of fingerprints alone, without the exact search after them, drop near copies,
    but not texts that only share a fingerprint."""
    texts = [" ".join(f"w{i}x{k}" for k in range(400)) for i in range(60)]
    texts += [t.replace("x399", "x400") for t in texts[:40]]
    nothing = lambda sets, ranks, similarity: spark.createDataFrame([], "token long, key long, at int, n int")
    monkeypatch.setattr(simhash, "first_shingles", nothing)
    assert _kept(spark, texts) == set(range(60))
    monkeypatch.setattr(simhash, "fingerprint", lambda values: 7)
    assert _kept(spark, texts) >= set(range(60))


def _same_hash():
    """Two different texts of one xxhash64: what their first eight bytes change, bytes 32 to 40 undo."""
    p1, p2, full = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, (1 << 64) - 1

    def lane(word):
        x = (42 + p1 + p2 + int.from_bytes(word, "little") * p2) & full
        return ((x << 31 | x >> 33) & full) * p1 & full

    rest, undo = b" words that are the same", b"seventhx"
    for i in range(100_000):
        other = f"{i:08d}".encode()
        y = (int.from_bytes(undo, "little") + (lane(b"aaaaaaaa") - lane(other)) * pow(p2, -1, 1 << 64)) & full
        word = y.to_bytes(8, "little")
        if all(33 <= b < 127 for b in word):
            return [(head + rest + tail + rest).decode() for head, tail in ((b"aaaaaaaa", undo), (other, word))]


def test_texts_of_one_hash_are_two_texts(spark):
    a, b = _same_hash()
    assert a != b
    hashed = spark.createDataFrame([(a,), (b,)], "t string").selectExpr("xxhash64(t) h").distinct().count()
    assert hashed == 1 and _kept(spark, [a, b, a]) == {0, 1}


def test_shingles_that_share_half_a_hash_differ(spark):
    seen, texts = {}, []
    for i in range(200_000):
        text = f"short{i} text"
        other = seen.setdefault(int(simhash.hashes(text, 5)[0]) >> 32, text)
        texts += [other, text] if other != text else []
    assert len(texts) >= 2 and _kept(spark, texts) == set(range(len(texts)))


def test_passages_are_sorted_in_small_parts(spark, docs, monkeypatch):
    """The pipeline's stage sorts a quarter at once of what op1 does, with the same spans."""
    sizes = []
    plain = repeats.repeated
    monkeypatch.setattr(repeats, "repeated", lambda *args: sizes.append(args[-1]) or plain(*args))
    whole = sorted(map(str, plain(docs, 101).collect()))
    repeats.without_repeats(docs)
    assert sizes == [repeats.PART // 4]
    assert sorted(map(str, plain(docs, 101, part=300).collect())) == whole
