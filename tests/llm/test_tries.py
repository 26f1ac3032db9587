"""The prefix trie of conversations against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from podium.llm.prefix_trie import decompose, prefix_trie
from podium.llm.queries import SQL

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * (len(WORDS.findall(node[-1][1])) if node else 0)
        below = [totals[c] for c in children[node]]
        totals[node] = (sum(x for x, _ in below) if below else 1, saved + sum(x for _, x in below))
    out = []
    for node, convs in members.items():
        ids = ",".join(map(str, sorted(ends[node])))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
            *totals[node], hashlib.sha256(ids.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def frame(spark, rows):
    full = [(c, t, r, x, 5, "d", 9) for c, t, r, x in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, depth int, digest string, n int")


def found(got):
    return sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str)


def some(chance, convs, most):
    rows = []
    for c in convs:
        for k in range(chance.randrange(1, most)):
            rows.append((c, k, chance.choice(["user", "assistant"]), chance.choice(["a b", "c", "d  e f", "gg"])))
    return rows


AWKWARD = [
    (40, None, None, None), (40, None, "user", "x y"), (40, 0, None, "z"), (41, 1, "user", None), (41, 1, "user", ""),
    (42, 5, "a", "same"), (42, 5, "a", "same"), (42, 5, "b", "same"), (None, 1, "user", "lost"), (63, 1, "ab", "c"),
    (64, 1, "a", "bc"), (65, 1, "user", "late"), (85, 0, "u", "no first one"), (1_000_000_007, 3, "u", "x " * 30_000),
]


@pytest.mark.parametrize("local_weight, task_nodes, segment", [(3, 5, 2), (40, 30, 7), (1 << 16, 100_000, 1 << 16)])
def test_nodes_equal_brute_force(spark, local_weight, task_nodes, segment):
    chance = random.Random(1)
    rows = some(chance, range(0, 130, 2), 9) + AWKWARD
    rows += [(500, k, "user", f"turn {k % 3}") for k in range(70)]  # one long conversation
    rows += [(600 + c, k, "user", f"turn {k % 3}") for c in range(40) for k in range(5)]  # copies
    chance.shuffle(rows)
    got = prefix_trie(frame(spark, rows).repartition(3), local_weight=local_weight, task_nodes=task_nodes, segment=segment)
    assert dict(got.dtypes) == {name: "string" if name == "ends_sha256" else "bigint" for name in COLUMNS}
    assert found(got) == brute(rows)


def test_empty_table_and_one_turn(spark):
    assert prefix_trie(frame(spark, [])).count() == 0
    assert prefix_trie(frame(spark, [(None, 1, "a", "b")])).count() == 0
    rows = [(3, 1, "a", "b")]
    assert found(prefix_trie(frame(spark, rows))) == brute(rows)


def test_sql_of_awkward_rows(spark):
    rows = some(random.Random(2), range(0, 60, 3), 6) + AWKWARD
    connection = duckdb.connect()
    connection.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    connection.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = connection.sql(SQL["op11_prefix_trie"]).select(*COLUMNS).fetchall()
    assert sorted(got, key=str) == brute(rows)


@pytest.mark.parametrize("shape", ["path", "star", "random", "forest"])
def test_decomposition_gives_subtree_totals(shape):
    chance = np.random.default_rng(4)
    n = 300
    parent = {
        "path": np.arange(n) - 1,
        "star": np.minimum(np.arange(n) - 1, 0),
        "random": np.array([-1, *(chance.integers(0, k) for k in range(1, n))]),
        "forest": np.array([-1 if k % 50 == 0 else chance.integers(k - k % 50, k) for k in range(n)]),
    }[shape]
    own = chance.integers(1, 5, n)
    depth, weight = np.zeros(n, dtype=np.int64), own.copy()
    values = chance.integers(0, 100, (n, 2))
    expected = values.copy()
    for k in range(n):
        depth[k] = 0 if parent[k] < 0 else depth[parent[k]] + 1
    for k in reversed(range(n)):
        if parent[k] >= 0:
            weight[parent[k]] += weight[k]
            expected[parent[k]] += expected[k]
    mixed = chance.permutation(n)  # the order of nodes is any
    back = np.argsort(mixed)
    moved = np.where(parent[mixed] < 0, -1, back[parent[mixed]])
    got = decompose(moved, depth[mixed], weight[mixed], values[mixed])
    assert (got == expected[mixed]).all()
