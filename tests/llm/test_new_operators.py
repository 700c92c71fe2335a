"""Manifest, decontamination and filter audit against brute force, on every awkward case."""

import hashlib
import itertools
import os
import re
import zlib
from collections import Counter
from urllib.parse import unquote

import corpus
import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import audit, langid, merkle, mixing, neighbours, packing, repeats, scoring, sharding, simhash, tokens, winnowing
from skyledger.llm.common import staged


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.documents(spark).cache()


@pytest.fixture(scope="module")
def data(spark):
    return corpus.rows(spark)


def same(left, right):
    assert sorted(map(repr, left)) == sorted(map(repr, right))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---- manifest -------------------------------------------------------------------


def leaf(row, text) -> str:
    doc_id, _, lang, source, n_chars = row
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(fields))


def tree(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def climb(levels, pos, digest):
    siblings = []
    for level in levels[:-1]:
        start = pos - pos % 3
        run = level[start : start + 3]
        siblings += [h for i, h in enumerate(run) if start + i != pos]
        digest = sha("".join(digest if start + i == pos else h for i, h in enumerate(run)))
        pos //= 3
    return siblings, digest


def expected_proofs(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[3], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name, members in sources.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[name] = tree([leaf(r, r[1]) for r in members])
    roof = tree([trees[n][-1][0] for n in names])
    root, out = roof[-1][0], []
    for name in names:
        for pos, row in enumerate(sources[name]):
            text = row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            low, folded = climb(trees[name], pos, leaf(row, text))
            high, folded = climb(roof, names.index(name), folded)
            out.append((row[0], leaf(row, row[1]), trees[name][-1][0], root, sha("".join(low + high)), folded, folded == root))
    return out


def checked(docs):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.check(docs, even, F.replace(F.col("text"), F.lit("\n"), F.lit("")))


LARGE = [(2**53 + i, f"line {i}\n{i}", "en", "hot", i) for i in range(5)]


@pytest.mark.parametrize("depth", [7, 2])
def test_manifest(spark, data, depth, monkeypatch):
    """The same proofs whether a tree is one block or many."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "BLOCK", 3**depth)
    rows = [r[:5] for r in data] + LARGE + [(5000 + i, "same\n", "en", "hot", 5) for i in range(60)]
    clash = spark.createDataFrame([(*r, "x", 1, 2, "d") for r in rows], f"{corpus.DOCS}, tree string, pos long, total long, digest string")
    got = [tuple(r) for r in checked(clash.repartition(5)).collect()]
    expected = expected_proofs(rows)
    same(got, expected)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_few_rows(spark):
    one = spark.createDataFrame([(None, None, None, None, None)], corpus.DOCS)
    (row,) = checked(one).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == sha("") and row.verified
    assert checked(corpus.empty(spark)).collect() == []


def test_one_proof_asks_for_the_least(spark):
    """A set of leaves asks only for nodes that none of them can derive."""
    asked, totals = merkle.missing({0, 1, 2, 3}, 20)
    assert totals == [20, 7, 3, 1]
    assert asked == [(0, 4), (0, 5), (1, 2), (2, 1), (2, 2)]
    docs = spark.createDataFrame([(i, str(i), "en", "a", 1) for i in range(40)], corpus.DOCS)
    leaves = docs.select("doc_id", "source", merkle.leaf_digest(*[F.col(c) for c in merkle.FIELDS]).alias("digest"))
    made = merkle.manifest(leaves)
    some = merkle.proofs(made, made.leaves.where("doc_id % 7 = 0")).collect()
    assert sorted(r.doc_id for r in some) == list(range(0, 40, 7))
    assert {r.root for r in some} == {r.folded_root for r in some} == {made.root}


# ---- decontamination ------------------------------------------------------------


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(corpus.LOWER))


def expected_hits(docs, items):
    out = []
    for doc_id, text in docs:
        w, marks, ids = item_words(text), set(), set()
        for item_id, item in items:
            v = item_words(item)
            n = min(10, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in windows:
                    marks |= set(range(i, i + n))
                    ids |= {str(item_id)} if item_id is not None else set()
        out.append((doc_id, len(w), len(marks), len(ids), sha(",".join(sorted(ids))), bool(marks)))
    return out


def test_decontamination(spark, docs, data):
    first, second = data[0][1].split(), data[1][1].split()
    items = [
        (9, " ".join(first[5:25])), (10, " ".join(first[10:20])), (11, " ".join(second[3:12])), (12, " ".join(second[:400])),
        (100, "Word AND, other word! and other word and other word"), (13, "other word"), (14, None), (15, " .. "),
        (None, " ".join(first[40:60])), (9, " ".join(second[20:32])), (16, " ".join(first[5:25])), (17, "naïve"), (18, "x y z " * 9),
    ]
    bench = spark.createDataFrame([(i, t, "a", 1) for i, t in items], "item_id long, text string, window string, n int")
    same([tuple(r) for r in winnowing.contaminated(docs, bench).collect()], expected_hits([r[:2] for r in data], items))


def test_decontamination_of_random_words(spark):
    """Few different words, so that grams repeat, overlap and tie."""
    rng = np.random.default_rng(3)
    text = lambda n: " ".join(rng.choice(["a", "b", "c"], n))
    docs = [(2**53 + 1 + i, text(int(rng.integers(0, 60)))) for i in range(60)] + [(None, "a b c " * 10)]
    items = [(i, text(int(rng.integers(5, 16)))) for i in range(60)]
    got = winnowing.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    same([tuple(r) for r in got.collect()], expected_hits(docs, items))


def test_decontamination_of_empty_tables(spark, docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert not winnowing.contaminated(docs, nothing).where("contaminated or n_hit > 0 or n_items > 0").count()
    assert winnowing.contaminated(docs, nothing).count() == docs.count()
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert winnowing.contaminated(corpus.empty(spark), some).collect() == []


def test_a_hot_gram_makes_no_pairs(spark):
    """A phrase in every document and every item, each time in another context, makes rows in
    proportion to the documents, and none of them is a hit."""
    phrase = "one two three four five"
    docs = spark.range(3000).selectExpr("id AS doc_id", f"concat('a', id, ' b', id, ' {phrase} c', id, ' d', id, ' e', id, ' f', id) AS text")
    items = spark.range(300).selectExpr("id AS item_id", f"concat('k', id, ' {phrase} l', id, ' m', id, ' n', id, ' o', id) AS text")
    windows, hashes, short = winnowing.item_windows(items)
    met = winnowing.meetings(docs, hashes, short)
    assert met.where("n > 0").count() <= 2 * 3000
    assert winnowing.occurrences(docs, met, windows, hashes, short).count() == 0
    assert winnowing.contaminated(docs, items).where("contaminated").count() == 0


def test_winnowing_stays_in_the_jvm(spark, docs):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = winnowing.contaminated(docs, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- filter audit ---------------------------------------------------------------


def expected_audit(docs, labels):
    first, masks = {}, Counter()
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    for doc_id, text, lang in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > first[text],
        }
        fails = "".join(k for k, v in failed.items() if v)
        masks[lang or "", fails, doc_id in good, doc_id in toxic] += 1
    out, shapley = {}, Counter()
    for part, order in itertools.product({m[0] for m in masks}, map("".join, itertools.permutations("ABCDE"))):
        for step, letter in enumerate(order, 1):
            row = [0] * 6
            for (p, fails, is_good, is_toxic), n in masks.items():
                if p == part:
                    gone, fail = bool(set(fails) & set(order[: step - 1])), letter in fails
                    for i, yes in enumerate((not gone and not fail, fail and not gone, fail and gone, fails == letter, fail and not gone and is_good, fail and not gone and is_toxic)):
                        row[i] += n * yes
            out[part, order, step] = row
            shapley[part, letter] += row[1]
    return [(*k, *row, shapley[k[0], k[1][k[2] - 1]]) for k, row in out.items()]


LABELS = "doc_id long, quality int, toxic int, part string, mask int"


def test_filter_audit(spark, docs, data):
    ids = [r[0] for r in data]
    labels = [(i, n % 2, n % 3 % 2) for n, i in enumerate(ids[::2])] + [(ids[0], 1, 1), (ids[0], 0, None), (None, 1, 1), (99999, 1, 1)]
    frame = spark.createDataFrame([(*row, "a", 1) for row in labels], LABELS)
    rows = [(d, t, lang) for d, t, lang, *_ in data]
    same([tuple(r) for r in audit.audit(docs, frame).collect()], expected_audit(rows, [x for x in labels if x[0] is not None]))


def test_filter_audit_of_large_ids_and_empty_tables(spark):
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(2**53 + 1, "same", "en"), (2**53 + 2, "same", "en"), (None, "same", None), (2**53 + 1, "same", "en"), (7, "SHOUT #", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    same([tuple(r) for r in audit.audit(docs, no_labels).collect()], expected_audit(rows, []))
    assert audit.audit(corpus.empty(spark), no_labels).collect() == []


@pytest.mark.parametrize("slots", [1 << 20, 1 << 22])
def test_sketch_clears_no_repeat(spark, slots, monkeypatch):
    """Every repeated hash is possible, whatever the partitions; most unique ones are cleared."""
    monkeypatch.setattr(audit, "slot_count", lambda rows: slots)
    keys = spark.range(60_000).select(F.xxhash64(F.when(F.col("id") < 300, F.col("id") % 100).otherwise(F.col("id"))).alias("key"))
    possible = audit.repeat_filter(keys.repartition(7), 60_000)
    found = keys.groupBy("key").count().select("count", possible("key").alias("possible")).groupBy((F.col("count") > 1).alias("repeat"), "possible").count().collect()
    counts = {(r.repeat, r.possible): r["count"] for r in found}
    assert counts[True, True] == 100 and (True, False) not in counts
    assert counts.get((False, True), 0) < 1200


def test_hot_copies_are_possible_repeats(spark):
    keys = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.xxhash64("id")).alias("key"))
    possible = audit.repeat_filter(keys, 20_000)
    assert keys.where(possible("key")).where("key = 5").count() == 6667


# ---- ids that doubles cannot hold, beside a row without one ----------------------

IDS = [2**53 + 1, None, 2**53 + 3]
BY_ID = {
    "merkle": checked,
    "winnowing": lambda d: winnowing.contaminated(d, d.select(F.lit(1).alias("item_id"), "text")),
    "sharding": sharding.shard,
    "simhash": simhash.near_duplicates,
    "tokens": tokens.token_counts,
    "scoring": scoring.score,
    "packing": packing.pack,
    "mixing": mixing.mix,
    "repeats": repeats.repeated,
}


@pytest.mark.parametrize("name", sorted(BY_ID))
def test_ids_stay_exact(spark, name):
    rows = [(i, f"some words of text number {n} that are long enough " * 3, "en", "a", 1) for n, i in enumerate(IDS)]
    docs = spark.createDataFrame(rows, corpus.DOCS).coalesce(1)
    found = {r["doc_id"] for r in BY_ID[name](docs).select("doc_id").collect()}
    assert found == set(IDS)


def test_components_name_exact_ids(spark):
    docs = spark.createDataFrame([(i, "the same text", "en", "a", 1) for i in IDS], corpus.DOCS).coalesce(1)
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {2**53 + 1}


def test_equal_scores_go_to_the_smaller_ids(spark):
    """Thirty different vectors of one direction: all have the same score."""
    base = np.random.default_rng(2).normal(size=8).astype(np.float32)
    rows = [(i, (base * 2.0 ** (i * 7 % 30)).tolist(), 0) for i in range(1, 31)] + [(50, base.tolist(), 0)]
    rows += [(100 + i, np.random.default_rng(i).normal(size=8).astype(np.float32).tolist(), 0) for i in range(200)]
    frame = spark.createDataFrame(rows, corpus.VECTORS)
    for shard in (4096, 40):
        got = neighbours.nearest(frame, frame.where("vec_id = 50"), shard=shard).orderBy("rank").collect()
        assert [r.vec_id for r in got] == [1, 2, 3, 4, 5]


# ---- language ID against plain sets ----------------------------------------------


def trigrams(text):
    letters = [c.lower()[0] if c.isalpha() else "" for c in f" {text or ''} "]
    return [tuple(letters[i : i + 3]) for i in range(len(letters) - 2) if letters[i + 1] and (letters[i] or letters[i + 2])]


def plain_sets(rows):
    """Per language the trigrams that it contains, straight from the definition."""
    counts = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(trigrams(text))
    rates = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    top = Counter()
    for rate in rates.values():
        for g, r in rate.items():
            top[g] = max(top[g], r)
    return {lang: {g for g, r in rate.items() if r >= langid.RATIO * top[g] and r >= langid.RARE} for lang, rate in rates.items()}


def test_language_filters_answer_as_plain_sets_do(spark, docs, data):
    sets = plain_sets([(text, lang) for _, text, lang, *_ in data])
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs)).collect()
    for row in found:
        grams = trigrams(row.text)
        if not any(c.isalpha() for c in row.text or ""):
            assert (row.lang_pred, row.score) == (langid.UNKNOWN, 0.0)
            continue
        share = {lang: sum(g in known for g in grams) / len(grams) for lang, known in sets.items()}
        best = max(share.values())
        assert abs(row.score - best) < 0.001 and share[row.lang_pred] > best - 0.001


def test_language_does_not_depend_on_neighbours(data):
    model = {"langs": ["x"], "slots": np.zeros((1, 1 << 16), np.uint64), "false": np.zeros(1), "order": 3, "probes": 2}
    code, _ = langid.ngrams(langid._points(["ab cd"])[0])
    for slot in langid.probes(code, 1 << 16, 2):
        model["slots"][0, slot] = 1
    texts = ["ab cd", "zz", "", None, "ab cd", "ab", "xx ab cd"]
    alone = [(langs[0], score[0]) for langs, score in (langid.decide([t], model) for t in texts)]
    langs, score = langid.decide(texts, model)
    assert alone == list(zip(langs, score)) and score[0] == score[4] > 0.999999 and score[1] == 0.0


def test_language_of_repeated_rows_and_no_rows(spark, docs):
    model = langid.fit(docs)
    found = langid.identify(docs.select("doc_id", "text"), model)
    assert found.count() == docs.count()
    assert len({(r.lang_pred, r.score) for r in found.where("doc_id = 1005").collect()}) == 1
    assert langid.identify(corpus.empty(spark), model).collect() == []
    nothing = langid.identify(docs.select("doc_id", "text"), langid.fit(corpus.empty(spark)))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {(langid.UNKNOWN, 0.0)}


# ---- what evolution gains in packing ---------------------------------------------


def triplets(seed: int, count: int = 120, capacity: int = 2048) -> list[int]:
    """Full bins cut in three: best fit puts the largest together and wastes the rest."""
    rng, size = np.random.default_rng(seed), []
    for _ in range(count):
        a = int(rng.integers(520, 900))
        b = int(rng.integers(520, min(1000, capacity - a - 500)))
        size += [a, b, capacity - a - b]
    return sorted(size, reverse=True)


@pytest.mark.parametrize("seed", range(3))
def test_crossover_gains_bins_over_best_fit(seed):
    size = triplets(seed)
    plain = len(packing.best_fit(list(range(len(size))), size, [], 2048))
    few = packing.evolve(size, [], seed, 2048, packing.GENERATIONS, packing.POPULATION)
    more = packing.evolve(size, [], seed, 2048, 20, 6)
    assert plain > len(few) > len(more) >= 120
    for bins in (few, more):
        assert sorted(i for b in bins for i in b) == list(range(len(size)))
        assert max(sum(size[i] for i in b) for b in bins) <= 2048


def test_islands_and_migration_gain_bins(spark):
    """Two shards, two islands each, two epochs: fewer bins than best fit on the same shards,
    and than one island alone in one epoch."""
    items = [(k, k % 2, n) for k, n in enumerate(triplets(7, 160))]
    frame = spark.createDataFrame(items, "key long, shard int, length int")
    count = lambda **s: packing._pack(frame, 2, 2048, generations=3, population=3, **s).select("shard", "bin").distinct().count()
    plain = 0
    for shard in (0, 1):
        size = [n for _, s, n in items if s == shard]
        plain += len(packing.best_fit(list(range(len(size))), size, [], 2048))
    alone, together = count(islands=1, epochs=1), count(islands=2, epochs=2)
    assert plain > alone >= together >= 160
    assert together < alone or together <= plain - 4


def test_packed_numbers_come_back_and_are_small():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 50_000, np.uint64))
    counts = np.random.default_rng(2).geometric(0.4, 50_000) * 3
    assert np.array_equal(scoring._open_keys(scoring._pack_keys(keys)), keys)
    assert np.array_equal(scoring._open_counts(scoring._pack_counts(counts)), counts)
    assert len(scoring._open_keys(scoring._pack_keys(keys[:0]))) == 0
    plain = repeats.squeeze(np.diff(keys, prepend=np.uint64(0)).astype("<u8").tobytes())
    assert len(scoring._pack_keys(keys)) < 0.9 * len(plain)


def test_keys_and_code_lengths_go_before_the_scores(spark, docs, monkeypatch):
    made = []

    def kept(df):
        made.append(staged(df))
        return made[-1]

    monkeypatch.setattr(scoring, "staged", kept)
    found = scoring.score(docs, order=3)
    there = {tuple(t.columns) for t in made if any(os.path.exists(unquote(f).removeprefix("file://")) for f in t.inputFiles())}
    assert {("batch", "n_bytes", "blob"), ("batch", "place", "values")} <= there
    assert not {c for c in there if "keys" in c or "bits" in c}
    assert found.count() == docs.count()
