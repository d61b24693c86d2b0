"""Near-duplicates by SimHash: fingerprints, links of few differing bits, components.

Links are found by the generalised pigeonhole principle. The 64 bits are grouped by correlation
into m parts with thresholds that sum to radius - m + 1; two fingerprints within the radius then
differ on some part i by at most its threshold. Part sizes and thresholds come from a dynamic
program over candidate counts that a bounded sample of fingerprints predicts; the sample decides
speed only, as any such allocation finds every link.

Null and empty texts have fingerprint zero and are linked like others. Rows repeat freely: a
fingerprint is looked at once however many documents have it. Documents with a null id keep their
row and count towards no component's smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, cut, mixed, text_bytes, whole_partition

SEED = 42
SAMPLE = 20_000
HOT = 8
ALL = (1 << 64) - 1


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Majority bits of the XXH64 values of the word shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    values = [digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[shingle - 1 :], strict=False)]
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 1 << 16):
        some = np.array(values[at : at + (1 << 16)], dtype="<u8")
        total += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (total * 2 > len(values)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the signed 64-bit fingerprint of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in text_bytes(b.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, fp long")


def grouped_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of about equal size, each grown around its most correlated bits."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
    bits -= bits.mean(axis=0)
    spread = np.sqrt((bits**2).sum(axis=0))
    related = np.abs(bits.T @ bits) / np.maximum(np.outer(spread, spread), 1e-9)
    left, groups = list(range(64)), []
    for i in range(parts):
        size = len(left) // (parts - i)
        group = [max(left, key=lambda b: related[b, left].sum())]
        while len(group) < size:
            group.append(max((b for b in left if b not in group), key=lambda b: related[b, group].sum()))
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def as_mask(bits) -> int:
    return sum(1 << b for b in bits)


def allocated(sample: np.ndarray, total: int, radius: int) -> list[int]:
    """The masks to probe: equal bits under one of them are what every pair within the radius has."""
    some = sample[:2000]
    apart = some[:, None] ^ some[None, :]
    pairs = total * max(total - 1, 1) / 2 / max(len(some) * (len(some) - 1), 1)
    best: tuple[float, list[int]] | None = None
    for parts in range(1, radius + 2):
        groups = grouped_bits(sample, parts)
        costs, masks = [], []
        for group in groups:
            near = np.bitwise_count(apart & np.uint64(as_mask(group)))
            costs.append({-1: 0.0})
            masks.append({-1: []})
            for t in range(radius + 1):
                masks[-1][t] = [as_mask(set(group) - set(out)) for out in combinations(group, t)]
                found = max(float((near <= t).sum() - len(some)), 0.0) * pairs
                costs[-1][t] = found + 20.0 * total * len(masks[-1][t])
        # best[s]: the cheapest thresholds of the parts so far that sum to s
        cheapest: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            longer: dict[int, tuple[float, list[int]]] = {}
            for spent, (sum_so_far, chosen) in cheapest.items():
                for t, c in cost.items():
                    if spent + t not in longer or sum_so_far + c < longer[spent + t][0]:
                        longer[spent + t] = (sum_so_far + c, [*chosen, t])
            cheapest = longer
        cost, chosen = cheapest[radius - parts + 1]
        if best is None or cost < best[0]:
            best = (cost, [m for i, t in enumerate(chosen) for m in masks[i][t]])
    return best[1]


def probe_tree(sample: np.ndarray, masks: list[int], radius: int, hot: int, depth: int = 3) -> list[tuple]:
    """(mask, values that a sample holds often, subtree): such values are split by more bits.

    Two fingerprints that agree under a mask and are within the radius also agree on one of
    radius + 1 parts of the remaining bits, so going on with those parts loses nothing.
    """
    tree = []
    for mask in masks:
        values, counts = np.unique(sample & np.uint64(mask), return_counts=True)
        often = values[counts >= hot]
        rest = [b for b in range(64) if not mask >> b & 1]
        if len(often) and depth and len(rest) > radius:
            within = sample[np.isin(sample & np.uint64(mask), often)]
            lower = [mask | as_mask(rest[i :: radius + 1]) for i in range(radius + 1)]
            tree.append((mask, often, probe_tree(within, lower, radius, hot, depth - 1)))
        else:
            tree.append((mask, often[:0], []))
    return tree


def probes(fps: np.ndarray, tree: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, fingerprints) of all probes."""
    for mask, often, lower in tree:
        value = fps & np.uint64(mask)
        deeper = np.isin(value, often)
        yield mixed(value[~deeper] ^ mixed(np.array([mask], dtype=np.uint64))[0]), fps[~deeper]
        if deeper.any():
            yield from probes(fps[deeper], lower)


def forest(keys: np.ndarray, fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Verified links among fingerprints with equal keys, as many as join what links at all."""
    order = np.lexsort((fps, keys))
    keys, fps = keys[order], fps[order]
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = x = root.get(up, up)
        return x

    links, at, step = [], np.arange(len(keys) - 1), 1
    while len(at):
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        near = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= radius]
        for a, b in zip(fps[near].tolist(), fps[near + step].tolist(), strict=True):
            x, y = top(a), top(b)
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((a, b))
        step += 1
    return links


def links(distinct: DataFrame, radius: int = 2, sample_rows: int = SAMPLE) -> DataFrame:
    """(u, v): links that join every two fingerprints a chain of links within the radius joins.

    ``sample_rows``, by a hash, bounds the fingerprints that are looked at to choose masks and to find
    values that many fingerprints share; neither changes which links are found.
    """
    total = distinct.count()
    some = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(max(total, 1))) < sample_rows)  # about sample_rows at most
    sample = np.sort(np.array([r.fp for r in some.select("fp").collect()], dtype=np.int64).view(np.uint64))
    sample = sample[np.argsort(mixed(sample), kind="stable")]
    tree = probe_tree(sample, allocated(sample, total, radius), radius, HOT) if total > 1 else []

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy().view(np.uint64)
            for keys, some in probes(fps, tree):
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(some.view(np.int64))], ["key", "fp"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = whole_partition(batches)
        if columns:
            found = forest(columns[0].view(np.uint64), columns[1].view(np.uint64), radius)
            pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    keyed = distinct.select("fp").mapInArrow(emit, "key long, fp long")
    return keyed.repartition("key").mapInArrow(verify, "u long, v long")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest id that links reach."""
    each = cut(fingerprints(docs, id_col, text_col, shingle))
    distinct = cut(each.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(links(distinct, radius))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "component_id")
    return each.join(classes, "fp").select("doc_id", "fp", "component_id")


def simhash_query(docs: DataFrame) -> DataFrame:
    found = simhash_groups(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id; its columns as they are.

    Rows that repeat the kept id with the same text stay with it; rows with a null id stay, as they
    cannot be told apart.
    """
    found = simhash_groups(docs, id_col, text_col)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["__gone"], "left_anti").select(docs.columns)
