"""Exact, near and passage duplicates."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from podium.llm.common import ROW, numbered
from podium.llm.components import components
from podium.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from podium.llm.fm_index import FmIndex, WaveletTree
from podium.llm.simhash import (
    _anchors,
    _near,
    _steps,
    drop_near_duplicates,
    fingerprint,
    links,
    near_duplicates,
)
from podium.llm.substring_dedup import repeated_passages, without_repeats

from .samples import documents, many_partitions, rows_of, words

# --- exact duplicates


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("keep, best", [("smallest", min), ("largest", max)])
@pytest.mark.parametrize("most", [0, 1000])
def test_exact_groups(spark, keep, best, most):
    rows = [(1, "a"), (2, "a"), (3, "a "), (4, None), (5, ""), (6, "b"), (7, "x" * 200_000), (8, "x" * 200_000), (6, "b")]
    got = exact_duplicates(many_partitions(documents(spark, rows)), keep=keep, most_broadcast=most)
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    expected = [
        (i, best(groups[t or ""]), len(groups[t or ""]), i == best(groups[t or ""]), sha(t)) for i, t in rows
    ]
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(expected, key=str)


def test_hash_collisions_are_told_apart_by_bytes(spark):
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, "b"), (5, "c")]
    got = exact_duplicates(documents(spark, rows), hash128=lambda text: F.lit(b"same"))
    assert rows_of(got, "doc_id", "keep_id", "group_size") == [(1, 1, 2), (2, 2, 2), (3, 1, 2), (4, 2, 2), (5, 5, 1)]


def test_exact_rows_without_an_id_and_no_rows(spark):
    rows = [(None, "a"), (2, "a"), (None, "z")]
    got = exact_duplicates(documents(spark, rows))
    assert rows_of(got, "doc_id", "keep_id", "kept") == [(2, 2, True), (None, 2, False), (None, None, True)]
    assert exact_duplicates(documents(spark, [])).count() == 0


def test_dropping_exact_duplicates_keeps_all_columns(spark):
    docs = documents(spark, [(1, "a"), (2, "a"), (3, "b"), (None, "q")])
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert rows_of(left, "doc_id", "text") == [(1, "a"), (3, "b"), (None, "q")]


def test_normalised_texts(spark):
    got = exact_duplicates(documents(spark, [(1, "A b"), (2, "a B")]), normalise=F.lower)
    assert rows_of(got, "keep_id", "text_sha256") == [(1, sha("a b"))] * 2


# --- near duplicates


def plain_fingerprint(text, size):
    own = (text or "").encode().lower().split()
    pieces = [b" ".join(own[i : i + size]) for i in range(max(1, len(own) - size + 1))] if own else []
    hashes = [xxhash.xxh64_intdigest(piece, 42) for piece in pieces]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_the_definition():
    chance = random.Random(1)
    texts = [None, "", " \n", "One", "ÀÉ Zz", "a b c", " ".join(chance.choices("abcdef", k=3000)), "a b c d e f"]
    for text in texts:
        for size in (1, 4, 5):
            assert fingerprint(text, size) == plain_fingerprint(text, size)


def test_every_word_has_one_anchor_within_three_bits():
    values = np.random.default_rng(2).integers(0, 1 << 23, 500)
    which, code, excess = _near(values, _steps(2))
    assert np.bincount(which[excess == 0]).tolist() == [1] * 500
    assert len(set(zip(which.tolist(), code.tolist()))) == len(which)


@pytest.mark.parametrize("pairs, threshold", [(False, 0), (False, 4), (True, 4), (False, 8)])
def test_close_fingerprints_share_an_anchor(pairs, threshold):
    chance = np.random.default_rng(3)
    a = chance.integers(0, 1 << 63, 120).astype(np.uint64)
    b = a.copy()
    for k in range(len(b)):
        for bit in chance.choice(64, threshold, replace=False):
            b[k] ^= np.uint64(1) << np.uint64(bit)
    extra = threshold * 2 // 3 if pairs else threshold // 3
    found = [_anchors(x, extra, _steps(extra), pairs) for x in (a, b)]
    nearest = [(i, k) for i, k, home in zip(*(x.tolist() for x in found[0])) if home]
    every = set(zip(found[1][0].tolist(), found[1][1].tolist()))
    assert {i for i, k in nearest if (i, k) in every} == set(range(len(a)))


def brute_components(fps, threshold):
    parent = {i: i for i in fps}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= threshold:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in fps}


@pytest.mark.parametrize("block", [7, 16384])
@pytest.mark.parametrize("pairs", [False, True])
def test_links_connect_what_is_close(spark, block, pairs):
    chance = random.Random(4)
    centre, fps = chance.getrandbits(64), {}
    for i in range(150):  # chains and a dense ball around one fingerprint
        base = centre if i % 2 else fps.get(i - 3, chance.getrandbits(64))
        for bit in chance.sample(range(64), chance.randrange(4)):
            base ^= 1 << bit
        fps[i] = base
    nodes = spark.createDataFrame(
        [(i, fp - (1 << 64) if fp >> 63 else fp, 0, 0) for i, fp in fps.items()], "node long, fp long, c1 long, c2 long"
    )
    found = {row.u: row.root for row in components(links(nodes, threshold=4, block=block, pairs=pairs)).collect()}
    assert {i: found.get(i, i) for i in fps} == brute_components(fps, 4)


def test_near_duplicate_rows(spark):
    one = words(0, 300)
    other = [*one[:150], "changed", *one[151:]]
    rows = [(5, " ".join(one)), (3, " ".join(other)), (9, " ".join(one)), (1, None), (2, ""), (4, " ".join(words(900, 200))), (9, " ".join(one)), (None, "q r s t")]
    got = near_duplicates(many_partitions(documents(spark, rows)), threshold=8)
    fps = {i: fingerprint(t, 4) for i, t in rows if i}
    expected = brute_components(fps, 8)
    assert sorted((r.doc_id, r.component_id) for r in got.collect() if r.doc_id) == sorted((i, expected[i]) for i, _ in rows if i)
    assert expected[9] == expected[5] and expected[1] == expected[2] == 1
    assert near_duplicates(documents(spark, [])).count() == 0


def test_near_duplicates_are_dropped(spark):
    one = words(0, 400)
    docs = documents(spark, [(1, " ".join(one)), (2, " ".join([*one[:399], "z"])), (3, " ".join(words(5000, 300))), (4, None), (5, None)])
    left = drop_near_duplicates(docs, threshold=4)
    assert left.columns == docs.columns
    assert rows_of(left, "doc_id") == [(1,), (3,), (4,)]


def awkward_rows():
    """Ids that are null or repeated, with equal, near and different texts."""
    texts = [" ".join(words(1000 * k, 60)) for k in range(9)]
    near_text = texts[0].replace("w5 ", "w5 w5 ")
    rows = [(3, texts[0]), (5, texts[0]), (5, texts[1]), (7, texts[2]), (7, texts[2]), (None, texts[3]), (None, texts[3])]
    rows += [(None, texts[4]), (None, texts[5]), (8, texts[5]), (8, texts[6]), (8, texts[7]), (9, near_text), (9, texts[8])]
    return rows + [(10, None), (10, ""), (None, None), (11, "tiny"), (11, "tiny")]


@pytest.mark.parametrize("from_files", [False, True])
def test_dropping_keeps_one_row_of_every_text(spark, tmp_path, from_files):
    rows = awkward_rows()
    docs = many_partitions(documents(spark, rows))
    if from_files:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    best = {}
    for i, text in rows:
        best[text or ""] = min(best.get(text or "", (True, None)), (i is None, i), key=lambda x: (x[0], x[1] or 0))
    assert sorted(((r.doc_id, r.text or "") for r in left.collect()), key=str) == sorted(((i, t) for t, (_, i) in best.items()), key=str)

    near = drop_near_duplicates(docs)
    classes = brute_components({k: fingerprint(t, 4) for k, (_, t) in enumerate(rows)}, 4)
    members = {}
    for k, c in classes.items():
        members.setdefault(c, []).append(k)
    got = sorted(((r.doc_id, r.text or "") for r in near.collect()), key=str)
    assert len(got) == len(members)
    for own in members.values():
        ids = [rows[k][0] for k in own if rows[k][0] is not None]
        allowed = {(rows[k][0], rows[k][1] or "") for k in own if rows[k][0] == min(ids, default=None)}
        assert len(allowed & set(got)) == 1


def test_rows_of_files_are_numbered_where_they_lie(spark, tmp_path):
    docs = many_partitions(documents(spark, [(i, f"t{i % 7}") for i in range(50)]))
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs")).where("doc_id > 3").select("doc_id", "text")
    left = drop_exact_duplicates(docs)
    assert rows_of(left, "doc_id", "text") == sorted([(i, f"t{i % 7}") for i in range(4, 11)], key=str)
    twice = numbered(docs.join(docs.select("doc_id").limit(20).unionByName(docs.select("doc_id").limit(20)), "doc_id"))
    assert twice.select(*ROW).distinct().count() == twice.count()
    assert "_metadata" in numbered(docs)._jdf.queryExecution().analyzed().toString()
    assert numbered(docs).select(*ROW).distinct().count() == 46


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(200, 200), (300, 299), (299, 300)]
    found = {r.u: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 1 for i in range(2, 41)}, **{k: 100 for k in range(101, 160)}, 300: 299}


# --- repeated passages


def test_wavelet_tree_counts():
    chance = np.random.default_rng(5)
    values = chance.integers(0, 37, 1000)
    tree = WaveletTree(values, 37)
    of, before = chance.integers(0, 37, 300), chance.integers(0, 1001, 300)
    assert tree.rank(of, before).tolist() == [(values[:b] == v).sum() for v, b in zip(of, before)]


def test_matching_statistics():
    chance, depth = np.random.default_rng(6), 5
    indexed = [chance.integers(0, 3, chance.integers(1, 30)).astype(np.uint64) for _ in range(30)]
    numbers = [100 * k + np.arange(len(x)) for k, x in enumerate(indexed)]
    asked = [chance.integers(0, 4, 25).astype(np.uint64) for _ in range(20)]
    matched, least = FmIndex(indexed, numbers, depth).statistics(asked)
    top = np.iinfo(np.int64).max
    for text, got, first in zip(asked, matched, least):
        for i in range(len(text)):
            best, earliest = 0, top
            for k, other in enumerate(indexed):
                for j in range(len(other)):
                    n = 0
                    while n < depth and i + n < len(text) and j + n < len(other) and text[i + n] == other[j + n]:
                        n += 1
                    best = max(best, n)
                    earliest = min(earliest, numbers[k][j]) if n == depth else earliest
            assert (got[i], first[i]) == (best, earliest)


def brute_passages(rows, window):
    seen, out = {}, {}
    for i, text in sorted(rows, key=lambda x: x[0]):
        own = (text or "").split()
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            key = tuple(own[k : k + window])
            if seen.setdefault(key, (i, k)) != (i, k):
                gone[k : k + window] = [True] * window
        out[i] = (len(own), sum(gone), " ".join(w for w, g in zip(own, gone) if not g))
    return out


@pytest.mark.parametrize("shard_words", [40, 1 << 17])
def test_passages_equal_brute_force(spark, shard_words):
    chance = random.Random(7)
    passage, line = words(0, 60), chance.choices("abc", k=45)
    rows = [(0, None), (1, ""), (2, "too short"), (3, " ".join(words(100, 20)))]
    for i in range(4, 40):
        text = words(1000 * i, chance.randrange(40))
        for _ in range(chance.randrange(4)):
            a = chance.randrange(40)
            text += chance.choice([passage[a : a + chance.randrange(60)], line, ["x"] * chance.randrange(50), words(100, 20)])
            text += words(1000 * i + 500, chance.randrange(30))
        rows.append((i, " ".join(text)))
    rows += [(40 + k, rows[-1][1]) for k in range(8)]
    got = without_repeats(many_partitions(documents(spark, rows)), shard_words=shard_words)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got.collect()}
    assert found == brute_passages(rows, 20)
    row = got.where("doc_id = 3").first()
    assert row.kept_sha256 == hashlib.sha256(row.kept.encode()).hexdigest()


def test_passages_of_a_long_text_repeated_rows_and_no_rows(spark):
    chance = random.Random(8)
    long = chance.choices(words(0, 50), k=30_000)
    rows = [(1, " ".join(long)), (2, " ".join([*words(90_000, 5), *long[500:20_000]]))]
    got = without_repeats(documents(spark, rows))
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got.collect()} == brute_passages(rows, 20)
    twice = documents(spark, [(1, " ".join(words(0, 30)))] * 2 + [(None, " ".join(words(0, 30)))])
    assert rows_of(without_repeats(twice), "doc_id", "n_removed") == [(1, 0), (1, 0), (None, 0)]
    assert without_repeats(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        repeated_passages(twice, window=5, anchor=5)


def test_a_phrase_common_in_different_surroundings(spark):
    chance = random.Random(9)
    phrase, rows = words(0, 9), []
    for i in range(300):
        text = words(100 * (i + 1), 12) + phrase + words(100 * (i + 1) + 50, 12)
        if i % 10 == 3:  # the surroundings of another text, from some word on
            text[chance.randrange(10) :] = rows[chance.randrange(len(rows))][1].split()
        rows.append((i, " ".join(text)))
    for shard_words in (100, 2_000):
        got = without_repeats(many_partitions(documents(spark, rows)), shard_words=shard_words)
        found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got.collect()}
        assert found == brute_passages(rows, 20)
        assert sum(x[1] for x in found.values()) > 500
