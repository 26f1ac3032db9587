"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from podium.llm.lexical_search import BallTree, search, terms

from .samples import documents, many_partitions

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=20):
    own = [(i, Counter(split(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    count, every = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for i, c in own:
            m = 100 - 25 + (25 * sum(c.values()) * count) // every
            score = 0
            for t in split(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, k + 1, i, -minus) for k, (minus, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def texts(chance, count):
    vocabulary = [f"t{k}" for k in range(300)] + ["É", "ß3", "x"]
    return [" ".join(chance.choices(vocabulary, weights=[1 / (k + 1) for k in range(303)], k=chance.randrange(1, 60))) for _ in range(count)]


def test_terms():
    assert terms("Ab_c-ÉÀ 12x\x7f\tß") == [x.encode() for x in ("ab", "c", "ÉÀ", "12x", "ß")]
    for text in (None, "", "--", "İSTANBUL K ÀÉ a1B2 c\xa0d"):
        assert [x.decode() for x in terms(text)] == split(text)


@pytest.mark.parametrize("tree_docs, leaf_docs", [(50, 3), (8192, 32)])
def test_ranks_equal_brute_force(spark, tree_docs, leaf_docs):
    chance = random.Random(1)
    rows = list(enumerate(texts(chance, 400)))
    rows += [(1000 + k, rows[5][1]) for k in range(60)]  # copies: more ties than places
    rows += [(7, "t1 t2 another"), (None, "t1 t1 t1"), (2000, None), (2001, ""), (2002, "--"), (2003, "t9 " * 30_000)]
    items = list(enumerate(texts(chance, 25))) + [(3, "t1 t1 T1 x"), (None, "t5"), (90, None), (91, "nowhere"), (92, "")]
    items += [(0, rows[5][1]), (0, rows[5][1])]
    frame = spark.createDataFrame([(i, t, 5, "z") for i, t in items], "item_id long, text string, doc_id int, score string")
    got = search(many_partitions(documents(spark, rows)), frame, tree_docs=tree_docs, leaf_docs=leaf_docs)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, items)


def test_items_in_blocks(spark):
    chance = random.Random(2)
    rows, items = list(enumerate(texts(chance, 80))), list(enumerate(texts(chance, 12)))
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = search(documents(spark, rows), frame, block_bytes=700)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, items)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search(documents(spark, []), items).count() == 0
    assert search(documents(spark, [(1, None)]), items).count() == 0
    assert search(documents(spark, [(1, "a")]), items.limit(0)).count() == 0


def test_balls_hold_their_rows_and_prune():
    """Every row is within its balls, each in one leaf, and rows far from the query are not scored."""
    chance = np.random.default_rng(3)
    rows = []
    for k in range(600):  # ten groups that share no column
        columns = np.sort(chance.choice(20, 6, replace=False)) + 20 * (k % 10)
        rows.append((columns, chance.integers(400_000, 500_000, 6)))
    starts = np.concatenate([[0], np.cumsum([len(c) for c, _ in rows])])
    columns, values = (np.concatenate([r[j] for r in rows]) for j in (0, 1))
    tree = BallTree(starts, columns, values, 200, leaf=8)
    dense = np.zeros((600, 200))
    for k, (c, v) in enumerate(rows):
        dense[k, c] = v
    leaves = [x for x in tree.leaves if x is not None]
    assert sorted(np.concatenate(leaves).tolist()) == list(range(600))

    def below(node):
        return tree.leaves[node] if tree.leaves[node] is not None else np.concatenate([below(c) for c in tree.children[node]])

    for node in range(len(tree.radii)):
        away = np.linalg.norm(dense[below(node)] - tree.centres[node], axis=1)
        assert (away <= tree.radii[node]).all()
    own, weights = np.arange(40, 60), np.full(20, 7000)
    query = np.zeros(200, dtype=np.int64)
    query[own] = weights
    best = []
    scored = tree.search(own, weights, query, np.arange(600), best, 5)
    products = dense.astype(np.int64) @ query
    order = sorted(range(600), key=lambda k: (-products[k], k))[:5]
    assert sorted(best, reverse=True) == [(int(products[k]), -k) for k in order]
    assert scored < 300
