"""Removal of repeated byte strings by sorting sampled suffixes.

A byte goes when a string of ``length`` bytes that covers it also starts earlier: in a document with a
smaller id, or earlier in the same one. Sorting the suffix at every byte would move the corpus a hundred
times, so a suffix array is built of sampled suffixes: each string of ``length`` bytes has one anchor,
the position whose leading token (its first ``gram`` bytes) has the smallest fingerprint, and equal strings
have equal anchors. Strings that follow each other and share an anchor are one run, and travel as one
row: leading token, fingerprint of the run's bytes, document, start, number of strings.

The rows are range-partitioned by leading token and fingerprint with splitters that Spark samples, and
each bucket sorts them by multikey quicksort. Of equal runs all but the first are repeats. Runs that share
the leading token but differ may still share strings; so may those at a bucket's edges, whose token can
go on in the next bucket. These runs are cut into pieces of up to ``WIDTH`` strings that begin equally far
before their anchor. All strings of such a piece have ``length`` less ``WIDTH`` less one bytes around the anchor in common, and
these are its token when pieces are dealt and sorted the same way: a phrase that is shorter than that brings
nobody together, however many documents have it. Only pieces that are still open are spelled out, and a
bucket compares their strings one by one. The strings of tokens at its edges are compared across boundaries, and only
the first of each that a bucket has, so one that very many documents have comes once from each bucket.

Fingerprints have 128 bits; strings count as equal when both halves are.

Null texts are empty. Documents with equal or null ids are put in order by text (nulls first) and
otherwise treated as different documents. Each row of the input gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, staged, text_bytes, whole_partition

LENGTH = 100
GRAM = 32
PIECE = 1 << 18
WIDTH = 10
REPEAT, OPEN = 1, 2


class Hashes:
    """Fingerprints of substrings from running sums: sum of table[byte] * base^i, modulo 2^64."""

    def __init__(self, size: int):
        rng = np.random.default_rng(20260101)
        self.tables = rng.integers(0, 1 << 64, (2, 256), dtype=np.uint64)
        base = 0x9E3779B97F4A7C15
        self.power, self.inverse = self.powers(base, size), self.powers(pow(base, -1, 1 << 64), size)

    @staticmethod
    def powers(base: int, size: int) -> np.ndarray:
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        return factors.cumprod(dtype=np.uint64)

    def sums(self, data: np.ndarray, which: int) -> np.ndarray:
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.tables[which][data] * self.power[: len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (sums[stop] - sums[start]) * self.inverse[start]


_hashes: dict[int, Hashes] = {}


def hashes(size: int) -> Hashes:
    if size not in _hashes:
        _hashes[size] = Hashes(size)
    return _hashes[size]


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, in two passes over blocks."""
    n = len(x) - width + 1
    padded = np.concatenate([x, np.full(-len(x) % width, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Blocks of (document, offset, bytes): long texts in parts that overlap by a string less a byte."""
    block, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), PIECE):
            part = text[at : at + PIECE + length - 1]
            if size + len(part) > PIECE + length and block:
                yield block
                block, size = [], 0
            block.append((i, at, part))
            size += len(part)
    if block:
        yield block


def runs(block: list[tuple[int, int, bytes]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, start, count, token, fingerprint, anchor's distance) of the runs of strings in a block."""
    sizes = np.array([len(p) for _, _, p in block])
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(p for _, _, p in block), dtype=np.uint8)
    h = hashes(2 * (PIECE + length))
    first, second = h.sums(data, 0), h.sums(data, 1)
    starts = np.arange(len(data) - gram + 1)
    tokens = mixed(h.between(first, starts, starts + gram))
    high = np.uint64(0xFFFFFFFF00000000)
    least = sliding_minimum((tokens & high) | starts.astype(np.uint64), length - gram + 1)
    at = np.arange(len(least))
    fits = at + length <= np.repeat(begins + sizes, sizes)[: len(least)]
    at, anchor = at[fits], (least[fits] & ~high).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]))
    count = np.diff(np.concatenate([new, [len(at)]]))
    low, anchor = at[new], anchor[new]
    whole = whole_of(h, second, low, count, anchor - low, length)
    piece = np.searchsorted(begins, low, side="right") - 1
    document = np.array([i for i, _, _ in block])[piece]
    offset = np.array([o for _, o, _ in block])[piece] - begins[piece]
    return document, low + offset, count, tokens[anchor], whole, anchor - low


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """The order by several keys: by the first, then each run of equal rows by the next."""
    order = np.argsort(columns[0], kind="quicksort")
    equal = columns[0][order][1:] == columns[0][order][:-1]
    for column in columns[1:]:
        if not equal.any():
            break
        tied = np.flatnonzero(np.concatenate([equal, [False]]) | np.concatenate([[False], equal]))
        run = np.cumsum(~np.concatenate([[False], equal]))[tied]
        rows = order[tied]
        by_key = np.argsort(column[rows], kind="quicksort")
        order[tied] = rows[by_key[np.argsort(run[by_key], kind="stable")]]
        equal &= column[order][1:] == column[order][:-1]
    return order


def coded(start, count, distance, kind):
    """A run in a number: where it starts, how many strings, how far its anchor is, what it is."""
    return (start << 29) | (count << 9) | (distance << 2) | kind


def decoded(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return code >> 29, (code >> 9) & 0xFFFFF, (code >> 2) & 0x7F


def joined(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc, code) of repeats, those that follow each other as one (up to the ends of pieces)."""
    order = np.lexsort((start, doc))
    doc, start, count = doc[order], start[order], count[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + count[:-1]) | (start[1:] % PIECE == 0)
    first = np.flatnonzero(new)
    total = np.add.reduceat(count, first) if len(first) else count
    return doc[first], coded(start[first], total, 0, REPEAT)


def rows_of(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns.values()], list(columns))


def anchored(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """The runs of every text. Repeats that a batch sees by itself need no comparison, only passage: they
    are joined to long runs and go to any bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            found = [runs(block, length, gram) for block in pieces(text_bytes(b.column(1)), length)]
            if not found:
                continue
            document, start, count, token, whole, distance = (np.concatenate([f[i] for f in found]) for i in range(6))
            doc = ids[document]
            order = multikey_order([token, whole, doc, start])
            known = np.zeros(len(order), dtype=bool)
            known[order[1:]] = (token[order][1:] == token[order][:-1]) & (whole[order][1:] == whole[order][:-1])
            fresh = ~known
            yield rows_of(token=token[fresh], whole=whole[fresh], doc=doc[fresh], code=coded(start[fresh], count[fresh], distance[fresh], OPEN))
            if known.any():
                doc, code = joined(doc[known], start[known], count[known])
                yield rows_of(token=mixed(doc.astype(np.uint64) ^ mixed(code.astype(np.uint64))), whole=np.zeros(len(doc), np.uint64), doc=doc, code=code)

    return docs.select("doc", "text").mapInArrow(run, "token long, whole long, doc long, code long")


def bucketed(rows: DataFrame, parts: int) -> DataFrame:
    """(doc, code) of the runs that are repeats, and of those whose strings are still open."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = whole_partition(batches)
        if not columns or not len(columns[0]):
            return
        known = (columns[3] & 3) == REPEAT
        token, whole, doc, code = (c[~known] for c in columns)
        order = multikey_order([token, whole, doc, code])
        token, whole = token[order], whole[order]
        new_token = np.ones(len(order), dtype=bool)
        new_token[1:] = token[1:] != token[:-1]
        new_run = new_token.copy()
        new_run[1:] |= whole[1:] != whole[:-1]
        group = np.cumsum(new_token) - 1
        different = np.bincount(group, weights=new_run) > 1
        if len(different):
            different[[0, -1]] = True  # the token may go on in the bucket before or after
        start, count, _ = decoded(code[order][~new_run])
        doc_of_repeats, repeats = joined(doc[order][~new_run], start, count)
        still = new_run & different[group]
        yield rows_of(
            doc=np.concatenate([columns[2][known], doc_of_repeats, doc[order][still]]), code=np.concatenate([columns[3][known], repeats, code[order][still]])
        )

    return rows.repartitionByRange(parts, "token", "whole").mapInArrow(compare, "doc long, code long")


def located(texts: DataFrame, length: int, emit, schema: str) -> DataFrame:
    """What ``emit`` makes of the open runs of rows (doc, packed text, codes), a part of a text at a time.

    It gets the document, the part's bytes, their fingerprints' sums, and start, count and anchor within the part, and where it begins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = hashes(2 * (PIECE + length))
        for b in batches:
            for doc, text, codes in zip(b.column(0).to_pylist(), unpacked(b.column(1)), b.column(2).to_pylist(), strict=True):
                start, count, distance = decoded(np.sort(np.array(codes, dtype=np.int64)))
                for at in range(0, len(text), PIECE):
                    some = (start >= at) & (start < at + PIECE)
                    if some.any():
                        data = text[at : at + PIECE + 2 * length]
                        raw = np.frombuffer(data, dtype=np.uint8)
                        yield emit(doc, data, h, (h.sums(raw, 0), h.sums(raw, 1)), start[some] - at, count[some], distance[some], at)

    return texts.mapInArrow(run, schema)


def width_of(length: int) -> int:
    """Strings of a piece: few enough that they have most of their bytes in common."""
    return max(1, min(WIDTH, length // 4))


def shared_part(h: Hashes, sums: np.ndarray, anchor: np.ndarray, distance: np.ndarray, length: int) -> np.ndarray:
    """The token of pieces: the bytes that strings have in common which begin so far before the anchor."""
    width = width_of(length)
    place = distance // width
    stop = anchor + length - (place * width + width - 1)
    return mixed(h.between(sums, anchor - place * width, stop) ^ mixed(place.astype(np.uint64) + np.uint64(1)))


def whole_of(h: Hashes, sums: np.ndarray, start: np.ndarray, count: np.ndarray, distance: np.ndarray, length: int) -> np.ndarray:
    """The fingerprint of a run's bytes and shape."""
    shape = (distance * length + count).astype(np.uint64)
    return mixed(h.between(sums, start, start + count + length - 1) ^ mixed(shape + np.uint64(1)))


def cut_in_pieces(texts: DataFrame, length: int) -> DataFrame:
    """(token, whole, doc, code) of the pieces of open runs."""

    width = width_of(length)

    def emit(doc, _, h, sums, start, count, distance, at) -> pa.RecordBatch:
        # strings begin distance - count + 1 to distance before the anchor
        first, last = (distance - count + 1) // width, distance // width
        of = np.repeat(np.arange(len(start)), last - first + 1)
        place = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1)
        far = np.minimum(distance[of], place * width + width - 1)
        near = np.maximum(distance[of] - count[of] + 1, place * width)
        anchor = start[of] + distance[of]
        low, many = anchor - far, far - near + 1
        return rows_of(
            token=shared_part(h, sums[0], anchor, far, length), whole=whole_of(h, sums[1], low, many, far, length),
            doc=np.full(len(of), doc), code=coded(low + at, many, far, OPEN),
        )

    return located(texts, length, emit, "token long, whole long, doc long, code long")


def spelled(texts: DataFrame, length: int) -> DataFrame:
    """(token, whole, doc, code, bytes) of the open pieces of rows (doc, packed text, codes)."""

    def emit(doc, data, h, sums, start, count, distance, at) -> pa.RecordBatch:
        token = shared_part(h, sums[0], start + distance, distance, length)
        whole = whole_of(h, sums[1], start, count, distance, length)
        stop = start + count + length - 1
        spans = [data[i:j] for i, j in zip(start.tolist(), stop.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(token.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(np.full(len(start), doc)), pa.array(coded(start + at, count, distance, OPEN)), pa.array(spans, pa.binary())],
            ["token", "whole", "doc", "code", "bytes"],
        )

    return located(texts, length, emit, "token long, whole long, doc long, code long, bytes binary")


def compared(rows: DataFrame, parts: int, length: int) -> DataFrame:
    """(doc, code, high, low): strings that repeat, joined; and, with their fingerprint, the first of each
    string whose token is at an edge of its bucket."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        token, doc, code = (np.concatenate([b.column(i).to_numpy() for b in table]) for i in (0, 2, 3))
        spans = [x for b in table for x in b.column(4).to_pylist()]
        edge = np.isin(token, [token.min(), token.max()])
        # a few tokens at a time, so that the strings of a bucket are never all in memory
        order = multikey_order([token, doc, code])
        size = np.cumsum([len(spans[i]) for i in order])
        cuts = np.flatnonzero(np.concatenate([[True], token[order][1:] != token[order][:-1]]))
        ends = np.append(cuts[1:], len(order))
        at = 0
        while at < len(cuts):
            base = size[cuts[at] - 1] if cuts[at] else 0
            to = max(int(np.searchsorted(size[ends - 1], base + PIECE, side="right")), at + 1)
            yield from settled([order[i] for i in range(cuts[at], ends[to - 1])], spans, doc, code, edge)
            at = to

    def settled(rows, spans, doc, code, edge) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(spans[i]) for i in rows])
        data = np.frombuffer(b"".join(spans[i] for i in rows), dtype=np.uint8)
        h = hashes(1 << max(20, int(len(data) + 1).bit_length()))
        count = sizes - length + 1
        begin = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(count) - count), count) + np.arange(count.sum())
        high, low = (h.between(h.sums(data, i), begin, begin + length) for i in (0, 1))
        own = np.repeat(np.array(rows), count)
        place = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        of, start = doc[own], (code[own] >> 29) + place
        order = multikey_order([high, low, of, start])
        again = np.zeros(len(order), dtype=bool)
        again[order[1:]] = (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
        docs, codes = joined(of[again], start[again], np.ones(again.sum(), dtype=np.int64))
        none = pa.nulls(len(docs), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(codes), none, none], ["doc", "code", "high", "low"])
        asked = edge[own] & ~again
        yield rows_of(doc=of[asked], code=coded(start[asked], 1, 0, REPEAT), high=high[asked], low=low[asked])

    return rows.repartitionByRange(parts, "token", "whole").mapInArrow(compare, "doc long, code long, high long, low long")


def covered(size: int, codes: list[int], length: int) -> np.ndarray:
    """Which bytes a repeated string covers."""
    start, count, _ = decoded(np.array(codes, dtype=np.int64))
    edges = np.bincount(start, minlength=size + 1)[: size + 1] - np.bincount(start + count + length - 1, minlength=size + 1)[: size + 1]
    return np.cumsum(edges)[:size] > 0


def packed(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, text) with texts as compressed bytes, for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([press.compress(t) for t in text_bytes(b.column(2))], pa.binary())], ["doc", "doc_id", "text"])

    return docs.mapInArrow(run, "doc long, doc_id long, text binary")


def unpacked(column: pa.Array) -> list[bytes]:
    open_ = zstandard.ZstdDecompressor()
    return [open_.decompress(t) for t in column.to_pylist()]


def ordered_documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, doc_id, text): doc is a number of its own for each row, in the order of the ids."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    unclear = rows.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if unclear.isEmpty():
        return rows.select(F.col("doc_id").alias("doc"), "doc_id", "text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "doc_id", "text").sortWithinPartitions("doc_id", "text")
    return staged(rows.select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text"), "ordered-documents")


def with_repeats(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int) -> DataFrame:
    """(doc_id, packed text, codes): every row with the runs that say what to remove."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = ordered_documents(docs, id_col, text_col)
    found = staged(bucketed(anchored(rows, length, gram), parts), "repeated-runs")
    texts, kind = packed(rows), F.col("code").bitwiseAND(3)

    def still_open(runs: DataFrame) -> DataFrame:
        codes = runs.where(kind == OPEN).groupBy("doc").agg(F.collect_list("code").alias("codes"))
        return texts.join(codes, "doc").select("doc", "text", "codes")

    pieces = staged(cut_in_pieces(still_open(found), length), "pieces")
    finer = staged(bucketed(pieces, parts), "repeated-pieces")
    each = staged(compared(spelled(still_open(finer), length), parts, length), "repeated-strings")
    # across boundaries: a string comes at most once from each bucket
    place = F.row_number().over(Window.partitionBy("high", "low").orderBy("doc", "code"))
    across = each.where("high is not null").withColumn("place", place).where("place > 1").select("doc", "code")
    told = found.unionByName(finer).where(kind == REPEAT).unionByName(each.where("high is null").select("doc", "code")).unionByName(across)
    told = told.groupBy("doc").agg(F.collect_list("code").alias("codes"))
    return texts.join(told, "doc", "left").select("doc_id", "text", "codes")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): the bytes that are left of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[], [], [], []]
            for text, codes in zip(unpacked(b.column(1)), b.column(2).to_pylist(), strict=True):
                gone = covered(len(text), codes or [], length)
                edges = np.diff(np.concatenate([[0], gone.view(np.int8)]))
                kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                for column, value in zip(rows, (len(text), int(gone.sum()), int((edges == 1).sum()), kept), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(rows, kinds, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    return with_repeats(docs, id_col, text_col, length, gram).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def suffix_query(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
