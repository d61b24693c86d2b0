"""The trie of conversations against a plain version that holds it whole, and against SQL."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from compare import connect, spark_rows, sql_rows

from tidemark.llm import prefixes
from tidemark.llm.prefixes import TRIE_SQL, Walk, common, prefix_trie, skeleton_of

SCHEMA = "conv_id long, turn long, role string, text string, path string, n long, low long, shard int, key string, node string"
ORDER = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, 7, 7, "x", "x") for r in rows], SCHEMA)


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        path = (*own.get(base, [])[:h], *turns[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    below = {p: [q for q in members if q[: len(p)] == p] for p in members}
    words = {p: len(re.findall("[^ \t-\r]+", p[-1][1])) if p else 0 for p in members}
    children = {p: [q for q in below[p] if len(q) == len(p) + 1] for p in members}
    return sorted(
        (
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]),
            sum(not children[q] for q in below[p]), sum((len(members[q]) - 1) * words[q] for q in below[p]),
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p in members
    )


def found(df):
    return sorted((tuple(r) for r in df.select(*ORDER).collect()), key=lambda r: [x if x is not None else -1 for x in r])


def expected(rows):
    return sorted(plain(rows), key=lambda r: [x if x is not None else -1 for x in r])


def conversations(seed, count, texts=4, low=0):
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(low, low + 3 * count), count):
        for turn in range(rng.randint(1, 6)):
            out.append((c, turn, ["user", "bot", ""][min(turn % 2 + (rng.random() < 0.02), 2)], rng.choice(["a b", "", "a", "b c\td", "é " * 5][: texts + 1])))
    rng.shuffle(out)
    return out


ODD = [
    (1, None, "user", "first"), (1, 0, None, "x y"), (1, 0, None, None), (1, 0, "a", "x"), (1, 0, "a", "x"), (2, 5, "user", None), (None, 1, "user", "gone"),
    (-5, 0, "u", "minus"), (-25, 0, "u", "a"), (0, 0, "u", "zero"), (20, 1, "u", "one two"), (40, 0, "ab", "c"), (60, 0, "a", "bc"), (80, 0, "u", "long " * 20000),
    *((c, 0, "u", "only turn") for c in range(100, 160)),
]


@pytest.mark.parametrize("rows", [ODD, conversations(1, 120), conversations(2, 200, 2, -150), [], [(3, 0, "u", "a")], [(c, 0, "u", "same") for c in range(300)]], ids=str)
def test_equals_the_plain_version(spark, rows):
    assert found(prefix_trie(table(spark, rows))) == expected(rows)


@pytest.mark.parametrize("parts", ["1", "23"])
def test_equal_whatever_the_shards(spark, parts):
    rows = conversations(4, 250)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert found(prefix_trie(table(spark, rows))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pieces_of_ends(spark, monkeypatch):
    """A path that a third of all conversations end with, in pieces over several partitions."""
    monkeypatch.setattr(prefixes, "PIECE", 20)
    rows = [(c, t, "u", "same" if c % 3 else f"own {c}") for c in range(0, 400) for t in range(5)]
    assert found(prefix_trie(table(spark, rows))) == expected(rows)


def test_the_skeleton_has_the_nodes_of_several_shards(spark):
    a, b, c = (bytes([i]) * 16 for i in (1, 2, 3))
    shards = [(a, 0), (a + b, 0), (a + b + c, 1), (a + c, 1), (b, 2)]
    paths = spark.createDataFrame([(bytearray(p), s) for p, s in shards], "path binary, shard int")
    assert skeleton_of(paths) == [b"", a + b]
    assert common(a + b, a + b + c) == 2 and common(a, b) == 0 and common(b"", a) == 0 and common(a + c + b, a + c + c) == 2
    walk = Walk([b"", a + b])
    for p, _ in shards:
        walk.add(p, [1] * (len(p) // 16), 1, 5, "e")
    walk.close(0)
    assert sorted(x[1] for x in walk.finished()) == [1, 2, 3]
    assert {len(p) // 16 for p in walk.parts} == {0, 1, 2}


def test_very_long_conversation(spark):
    rows = [(5, t, "u", f"turn {t}") for t in range(3000)]
    got = found(prefix_trie(table(spark, rows)))
    assert len(got) == 3001 - zlib.crc32(b"5") % 4 and got[-1][1] == len(got) - 1 and {r[5] for r in got} == {1}


def test_sql_gives_the_same(spark, sf_dir):
    from tidemark.llm.queries import op13_trie

    assert spark_rows(op13_trie(spark, sf_dir)) == sql_rows(connect(sf_dir), TRIE_SQL)
