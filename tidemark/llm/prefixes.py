"""The prefix trie of conversations, built in range-partitioned shards under a skeleton of their splitters.

A turn becomes a key (128 bits of a SHA-256 of role and text) and a number of words; texts travel no further. Equal
rebuilt conversations are one path with a count before anything is sorted. Paths are range-partitioned and
sorted, so that the nodes of the trie are runs of neighbours. A node lies in several shards only if it is a
prefix of what the last path of one shard and the first of the next have in common: these prefixes are the
skeleton, and their paths, one for each boundary, are broadcast. Each shard walks over its paths once, with
a stack of open nodes, and finishes all nodes that are not in the skeleton. Of skeleton nodes it gives partial
aggregates, which Spark reduces by node; the few that result (shards times depth at most) are added up
along the skeleton on the driver.

The ids of the conversations that end at a node are hashed in numeric order: sorted by (path, id) across
partitions, written out in pieces where they lie, and only the pieces of a path that goes on in another
partition meet in one task, which streams them.

Rows without a conversation id are left out; a null role or text is empty. Turns with no number come
first; turns of a conversation with the same number are put in order by role and text, and repeated rows
are turns of their own. An empty table has no nodes. A conversation's keys (some 30 bytes a turn)
are held together in a task, its texts never are.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import staged

KEY = 16
PIECE = 1 << 18
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def shards(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_of(*parts) -> F.Column:
    """32 hexadecimal digits of a hash of the parts."""
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 2 * KEY)


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns (turn, place, key, words) of each conversation in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")).where("conv_id is not null")
    tied = rows.groupBy("conv_id", "turn").count().where("count > 1")
    if tied.isEmpty():
        rows = rows.withColumn("place", F.lit(0).cast("long"))
    else:
        order = ["conv_id", "turn", "role", "text"]
        sorted_rows = rows.repartitionByRange(shards(rows.sparkSession), *order).sortWithinPartitions(*order)
        rows = staged(sorted_rows.withColumn("place", F.monotonically_increasing_id()), "ordered-turns")
    key = key_of(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("int")
    each = rows.select("conv_id", F.struct("turn", "place", key.alias("key"), words.alias("words")).alias("turn"))
    return each.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt(conversations: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """(conv_id, path, words): conversations that begin as the first of their family does.

    Conversation c has the first h turns of c - c % family, h being the CRC-32 of c's digits modulo ``most``,
    then its own after its first h. ``path`` holds the keys of its turns one after the other.
    """
    own = staged(turns_of(conversations), "turns")
    keep = ["key", "words"]
    first = F.transform(F.slice("turns", 1, most - 1), lambda t: F.struct(*[t[k].alias(k) for k in keep]))
    heads = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), first.alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    rows = own.select("conv_id", F.transform("turns", lambda t: F.struct(*[t[k].alias(k) for k in keep])).alias("turns"), taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    joined = rows.join(heads, "base", "left")
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    path = F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns")))
    return joined.select("conv_id", path.alias("path")).select(
        "conv_id", F.unhex(F.array_join("path.key", "")).alias("path"), F.col("path.words").alias("words")
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """(path_id, ends_sha256) of rows (path_id, conv_id): the hash of each path's ids, in numeric order."""
    parts = shards(ends.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, first, texts, size, begun, edge = None, 0, [], 0, False, True
        rows: list[tuple] = []

        def piece(whole: bool) -> tuple:
            text = ",".join(texts)
            return (current, first, None, hashlib.sha256(text.encode()).hexdigest()) if whole else (current, first, text, None)

        for b in batches:
            for path, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if path != current:
                    if current is not None:
                        rows.append(piece(not begun and not edge))
                        edge = False
                    current, first, texts, size, begun = path, conv, [], 0, False
                elif size > PIECE:
                    rows.append(piece(False))
                    first, texts, size, begun = conv, [], 0, True
                texts.append(str(conv))
                size += len(texts[-1]) + 1
            if rows:
                yield batch(rows)
                rows = []
        if current is not None:
            yield batch([piece(False)])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["path_id", "first", "piece", "ends_sha256"])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, hashlib.sha256()
        for b in batches:
            rows = []
            for path, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if path == current:
                    digest.update(b",")
                else:
                    if current is not None:
                        rows.append((current, digest.hexdigest()))
                    current, digest = path, hashlib.sha256()
                digest.update(piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["path_id", "ends_sha256"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([digest.hexdigest()])], ["path_id", "ends_sha256"])

    in_order = ends.repartitionByRange(parts, "path_id", "conv_id").sortWithinPartitions("path_id", "conv_id")
    found = staged(in_order.mapInArrow(pieces, "path_id binary, first long, piece string, ends_sha256 string"), "ends")
    going_on = found.where("piece is not null").repartition(parts, "path_id").sortWithinPartitions("path_id", "first").select("path_id", "piece")
    return found.where("piece is null").select("path_id", "ends_sha256").unionByName(going_on.mapInArrow(chained, "path_id binary, ends_sha256 string"))


def paths_of(conversations: DataFrame) -> DataFrame:
    """(path, words, n, low, ends_sha256, shard): the distinct rebuilt conversations, range-partitioned."""
    path_id = F.unhex(F.substring(F.sha2("path", 256), 1, 2 * KEY)).alias("path_id")
    rows = staged(rebuilt(conversations).select(path_id, "path", "words", "conv_id"), "rebuilt")
    paths = rows.groupBy("path_id").agg(F.any_value("path").alias("path"), F.any_value("words").alias("words"), F.count("*").alias("n"), F.min("conv_id").alias("low"))
    known = paths.join(end_digests(rows.select("path_id", "conv_id")), "path_id").drop("path_id")
    return staged(known.repartitionByRange(shards(rows.sparkSession), "path").withColumn("shard", F.spark_partition_id()), "paths")


def common(a: bytes, b: bytes) -> int:
    """How many keys two paths have in common at their beginnings."""
    n = min(len(a), len(b)) // KEY
    if a[: n * KEY] == b[: n * KEY]:
        return n
    low, high = 0, n  # the first low keys are equal, the first high are not
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[: middle * KEY] == b[: middle * KEY] else (low, middle)
    return low


def skeleton_of(paths: DataFrame) -> list[bytes]:
    """What the last path of a shard and the first of the next have in common, for each boundary, sorted."""
    bounds = paths.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last")).orderBy("shard").collect()  # one row a shard
    kept = {bytes(a.last[: KEY * common(a.last, b.first)]) for a, b in zip(bounds, bounds[1:], strict=False)}
    return sorted(kept | {b""})


class Node:
    """An open node of the walk: a local one, or a shard's part of a skeleton node."""

    __slots__ = ("below", "children", "depth", "ends", "key", "leaves", "low", "n", "saved", "words")

    def __init__(self, depth: int, key: bytes, words: int):
        self.depth, self.key, self.words = depth, key, words
        self.n = self.children = self.leaves = self.saved = 0
        self.low: int | None = None
        self.ends: str | None = None
        #: rows of the children, which wait for this node's smallest member
        self.below: list[tuple] = []

    def add(self, n: int, low: int, leaves: int, saved: int) -> None:
        self.n += n
        self.low = low if self.low is None else min(self.low, low)
        self.leaves += leaves
        self.saved += saved


class Walk:
    """One pass over a shard's sorted paths."""

    def __init__(self, skeleton: list[bytes]):
        self.skeleton = skeleton
        self.stack: list[Node] = []
        #: the skeleton nodes of the shard by their prefix
        self.parts: dict[bytes, Node] = {}
        self.last = b""
        self.under = 0
        self.rows: list[tuple] = []

    def covered(self, path: bytes) -> int:
        """How many of the path's first keys lead through skeleton nodes."""
        at = bisect_left(self.skeleton, path)
        return max(common(path, s) for s in self.skeleton[max(at - 1, 0) : at + 1])

    def part(self, path: bytes, depth: int, words: list[int]) -> Node:
        prefix = path[: KEY * depth]
        if prefix not in self.parts:
            self.parts[prefix] = Node(depth, prefix, words[depth - 1] if depth else 0)
            if depth:
                self.part(path, depth - 1, words)
        return self.parts[prefix]

    def add(self, path: bytes, words: list[int], n: int, low: int, ends: str) -> None:
        depth = len(path) // KEY
        under = self.covered(path)
        self.close(max(common(self.last, path), under) - self.under if under == self.under else 0)
        self.last, self.under = path, under
        node = self.part(path, under, words)
        for d in range(under + len(self.stack), depth):
            self.stack.append(Node(d + 1, path[KEY * d : KEY * (d + 1)], words[d]))
        node = self.stack[-1] if self.stack else node
        node.add(n, low, 0, 0)
        node.ends = ends

    def close(self, keep: int) -> None:
        """Finishes the open nodes but the first ``keep``."""
        while len(self.stack) > max(keep, 0):
            node = self.stack.pop()
            saved = node.saved + (node.n - 1) * node.words
            leaves = node.leaves if node.children else 1
            self.rows += [(*row[:2], node.low, *row[3:], None) for row in node.below]
            row = (node.low, node.depth, None, node.n, node.children, leaves, saved, node.ends or NOTHING)
            above = self.stack[-1] if self.stack else self.parts[self.last[: KEY * self.under]]
            above.add(node.n, node.low, leaves, saved)
            above.children += 1
            if self.stack:
                above.below.append(row)
            else:
                self.rows.append((*row, named(above.key)))

    def finished(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows

    def partials(self) -> list[tuple]:
        """(node, above, depth, words, n, low, children, leaves, saved, ends) of the skeleton nodes, each without
        what its skeleton children have."""
        return [(named(p), named(p[:-KEY]) if p else None, x.depth, x.words, x.n, x.low, x.children, x.leaves, x.saved, x.ends) for p, x in self.parts.items()]


def named(prefix: bytes) -> bytes:
    return hashlib.sha256(prefix).digest()[:KEY]


LOCAL = NODE + ", above binary"
PARTIAL = "node binary, over binary, level long, words long, n long, low long, children long, leaves long, saved long, ends string"
LOCAL_KINDS = (*[pa.int64()] * 7, pa.string(), pa.binary())
PARTIAL_KINDS = (pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string())


def walked(paths: DataFrame, skeleton: list[bytes]) -> DataFrame:
    """The nodes that shards finish, and the partial aggregates of the skeleton, in columns of their own."""
    shared = paths.sparkSession.sparkContext.broadcast(skeleton)
    schema = f"{LOCAL}, {PARTIAL}"
    names = [c.split()[0] for c in schema.split(", ")]

    def columns(rows: list[tuple], kinds: tuple) -> list[pa.Array]:
        return [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]

    def nulls(n: int, kinds: tuple) -> list[pa.Array]:
        return [pa.nulls(n, k) for k in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(shared.value)
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                walk.add(*row)
            if rows := walk.finished():
                yield pa.RecordBatch.from_arrays(columns(rows, LOCAL_KINDS) + nulls(len(rows), PARTIAL_KINDS), names)
        walk.close(0)
        if rows := walk.finished():
            yield pa.RecordBatch.from_arrays(columns(rows, LOCAL_KINDS) + nulls(len(rows), PARTIAL_KINDS), names)
        if parts := walk.partials():
            yield pa.RecordBatch.from_arrays(nulls(len(parts), LOCAL_KINDS) + columns(parts, PARTIAL_KINDS), names)

    rows = paths.repartitionByRange(shards(paths.sparkSession), "shard").sortWithinPartitions("path").select("path", "words", "n", "low", "ends_sha256")
    return rows.mapInArrow(run, schema)


def skeleton_nodes(partials: DataFrame) -> list[tuple]:
    """(node, row) of the skeleton: partial aggregates reduced by node, then added up from the deepest."""
    total = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    same = [F.any_value(c).alias(c) for c in ("over", "level", "words")]
    reduced = partials.groupBy("node").agg(F.min("low").alias("low"), F.max("ends").alias("ends"), *total, *same)
    nodes = {bytes(r.node): r.asDict() for r in reduced.collect()}  # shards times depth at most
    for node in sorted(nodes.values(), key=lambda x: -x["level"]):
        node["saved"] += (node["n"] - 1) * node["words"]
        if not node["children"]:
            node["leaves"] = 1
        if node["over"] is not None:
            above = nodes[bytes(node["over"])]
            for c in ("n", "leaves", "saved"):
                above[c] += node[c]
            above["children"] += 1
            above["low"] = min(x for x in (above["low"], node["low"]) if x is not None)
    return [
        (key, (x["low"], x["level"], nodes[bytes(x["over"])]["low"] if x["over"] is not None else None, x["n"], x["children"], x["leaves"], x["saved"], x["ends"] or NOTHING))
        for key, x in nodes.items()
    ]


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations, from the textless root on."""
    spark = conversations.sparkSession
    paths = paths_of(conversations)
    found = staged(walked(paths, skeleton_of(paths)), "trie")
    nodes = skeleton_nodes(found.where("node is not null"))
    top = spark.createDataFrame([row for _, row in nodes], NODE)
    known = spark.createDataFrame([(bytearray(key), row[0]) for key, row in nodes], "above binary, top long")
    local = found.where("depth is not null").select(*[c.split()[0] for c in LOCAL.split(", ")])
    under = local.where("above is not null").join(known, "above").withColumn("parent_conv_id", F.col("top"))
    columns = top.columns
    return top.unionByName(local.where("above is null").select(columns)).unionByName(under.select(columns))


TRIE_SQL = r"""
WITH ordered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), digits AS (
  SELECT DISTINCT conv_id, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS bytes FROM ordered
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(bytes, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) % 4 AS h
  FROM digits
), taken AS (
  SELECT c.conv_id, o.place, o.role, o.text FROM convs c JOIN ordered o ON o.conv_id = c.base AND o.place <= c.h
  UNION ALL
  SELECT c.conv_id, o.place, o.role, o.text FROM convs c JOIN ordered o ON o.conv_id = c.conv_id AND o.place > c.h
), turns AS (
  SELECT conv_id, sha256(length(role) || ':' || role || text) AS key, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth
  FROM taken
), members AS (
  SELECT conv_id, 0 AS depth, '' AS node, 0 AS words FROM convs
  UNION ALL
  SELECT conv_id, depth, string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY depth), words FROM turns
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved
  FROM members GROUP BY node, depth
), children AS (
  SELECT left(node, 64 * (depth - 1)) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), subtrees AS (
  SELECT left(node, 64 * above) AS node, sum(saved) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM (SELECT n.node, saved, n_children, unnest(range(0, depth + 1)) AS above FROM nodes n LEFT JOIN children c ON n.node = c.node)
  GROUP BY ALL
), ends AS (
  SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, max_by(node, depth) AS node FROM members GROUP BY conv_id) GROUP BY node
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = left(n.node, 64 * (n.depth - 1))
LEFT JOIN children c ON c.node = n.node JOIN subtrees s ON s.node = n.node LEFT JOIN ends e ON e.node = n.node
"""
