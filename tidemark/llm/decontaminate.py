"""Benchmark passages in documents: latent semantic retrieval, then subsequence and answer checks.

Passages are TF-IDF vectors over the terms of the benchmark; document frequencies come from all documents. A
randomised SVD, for which Spark sums the products of terms over the passages of all documents and the
benchmark itself and multiplies them by the basis, gives a latent space. Windows of about an item's length, four words
apart or, if long, eight, are projected into it and compared by cosine with the items of that length; windows that have not as many of the benchmark's words as
an item needs are left out before. A window and an item that are near are a candidate, and the latent
cosine alone says so. Candidates around which too few of the item's words stand, in whatever order, can not pass and
are dropped together. Another counts when the longest common subsequence of their words has
``least_common`` of the item's, and that of the item's last quarter, where the answer stands, likewise.

The space holds nearly all of the items (tests measure what it finds by itself). What it can not find, items that
it holds too little of and those whose words very many documents have, an index of the items' rarest words finds: of any ``n - need + k``
words of an item at least k are in a stretch that has ``need`` of its n words in common, whatever their
weights. Where k are, the stretch is checked. So every stretch of about three times an item's words that
passes both checks is found.

Items are searched in blocks of ``block`` items, and ``GROUP`` blocks in each pass over the documents. Items
of more than 100 words are looked up by their parts and checked whole. Null and empty texts hold nothing;
null or empty items are found nowhere. Rows and items that repeat are found each for itself, ids once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, staged
from tidemark.llm.suffixes import Hashes

#: words of a window, and from one to the next
SIZES, STEP = (8, 12, 16, 20, 24, 32, 40, 48, 56, 64, 80, 96), 4
#: windows of this size on are two steps apart
SPARSE = 40
#: sizes that say how far around a run of words a stretch may reach
REACH, REACHED = (8, 12, 16, 24, 32, 48, 64), (4, 4, 4, 4, 8, 8, 16)
PART = 100
PASSAGE = 32
BYTES = 1 << 18
RANK, EXTRA, POWERS = 160, 8, 2
#: weight of the benchmark's passages, all together, for each that the documents have
OWN = 4
#: tasks that multiply passages at least, and bytes of a slice of their matrices
TASKS, SLICE = 24, 1 << 20
#: blocks of items that one pass over the documents looks for, and words of a block
GROUP, BLOCK_WORDS = 8, 1 << 14
#: words of stretches that are counted at once
STRETCHES = 1 << 16
#: an item of which the latent space holds less than this part is left to the index
HELD = 0.35
#: an item is looked at where one in so many of its words, of the rarest, are
HIT = 5
_word = np.zeros(256, dtype=np.uint8)
_word[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_hashes: dict[int, Hashes] = {}


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, start) of each word of letters, digits and bytes beyond ASCII."""
    if not data:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = 1 << max(18, (len(data) + 1).bit_length())
    if size not in _hashes:
        _hashes[size] = Hashes(size)
    h = _hashes[size]
    raw = np.frombuffer(data, dtype=np.uint8)
    edges = np.diff(_word[raw].astype(np.int8), prepend=0, append=0)
    start, stop = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return mixed(h.between(h.sums(raw, 0), start, stop)), start


def folded(column: pa.Array) -> list[bytes]:
    """The texts without difference of case, null as empty."""
    return [(x or "").casefold().encode() for x in column.to_pylist()]


def places_of(words: list[int], most: int) -> list[int]:
    """For each word from 0 to the most a bit for each place at which it stands."""
    masks = [0] * (most + 1)
    for i, x in enumerate(words):
        masks[x] |= 1 << i
    return masks


def common_subsequence(masks: list[int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence of words and a text of that size, of which the places are given."""
    full = state = (1 << size) - 1
    for y in words:
        u = state & masks[y]
        state = ((state + u) | (state - u)) & full
    return size - state.bit_count()


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """As many numbers from each first one on as its size says, one range after the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Terms:
    """Distinct fingerprints, by which words are numbered."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        bits = min(20, len(terms).bit_length() + 4)
        self.shift = np.uint64(64 - bits)
        #: the first term with each value of the leading bits or a higher one, and how many share a value at most
        self.first = np.searchsorted(terms, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.most = int(np.diff(self.first, append=len(terms)).max())

    def term_of(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word's term, -1 for words that are none."""
        ended = np.append(self.terms, np.uint64(2**64 - 1))
        at = self.first[(hashes >> self.shift).view(np.int64)].astype(np.int64)
        for _ in range(self.most - 1):
            at += ended[at] < hashes
        return np.where((ended[at] == hashes) & (at < len(self.terms)), at, -1)


class Items(Terms):
    """A block of benchmark items: their words, terms and the parts that are looked up."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids, self.words = [], []
        for item_id, text in rows:
            words = word_hashes((text or "").casefold().encode())[0]
            if len(words):
                self.ids.append(item_id)
                self.words.append(words)
        super().__init__(np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, np.uint64))
        #: (item, words of the part, place in SIZES of the window nearest to its length)
        self.parts: list[tuple[int, np.ndarray, int]] = []
        for i, words in enumerate(self.words):
            for part in np.array_split(words, math.ceil(len(words) / PART)):
                self.parts.append((i, part, min(range(len(SIZES)), key=lambda n: abs(SIZES[n] - len(part)))))


def blocks_of(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbouring texts of about a bound together, with the number of the first."""
    block, size, first = [], 0, 0
    for i, text in enumerate(texts):
        if block and size + len(text) > BYTES:
            yield first, block
            block, size, first = [], 0, i
        block.append(text)
        size += len(text)
    if block:
        yield first, block


def counted_passages(docs: DataFrame, items: Terms) -> DataFrame:
    """(term, n, words), staged: how many documents have each term (-1: all), and the known words of each passage.

    One reading of all documents gives both; a row has either.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(len(items.terms), dtype=np.int64), 0
        for b in batches:
            for _, texts in blocks_of(folded(b.column(0))):
                words, start = word_hashes(b"\n".join(texts))
                bounds = np.searchsorted(start, np.cumsum([0] + [len(t) + 1 for t in texts]))
                doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
                term = items.term_of(words)
                known = np.flatnonzero(term >= 0)
                owner = doc[known]
                pairs = owner * len(items.terms) + term[known]
                if len(texts) * len(items.terms) <= 1 << 23:
                    there = np.zeros((len(texts), len(items.terms)), dtype=bool)
                    there.reshape(-1)[pairs] = True
                    seen += there.sum(axis=0)
                else:
                    seen += np.bincount(np.unique(pairs) % len(items.terms), minlength=len(items.terms))
                n += len(texts)
                if len(known):
                    passage = (known - bounds[owner]) // PASSAGE
                    edges = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(passage, prepend=-1) != 0))
                    lists = pa.ListArray.from_arrays(pa.array(np.append(edges, len(known)).astype(np.int32)), pa.array(words[known].view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(lists), pa.int64()), pa.nulls(len(lists), pa.int64()), lists], ["term", "n", "words"])
        kept = np.flatnonzero(seen)
        counts = [pa.array(np.concatenate([[-1], kept])), pa.array(np.concatenate([[n], seen[kept]]))]
        yield pa.RecordBatch.from_arrays([*counts, pa.nulls(len(kept) + 1, pa.list_(pa.int64()))], ["term", "n", "words"])

    return staged(docs.select("text").mapInArrow(run, "term long, n long, words array<long>"), "passages")


def document_frequency(counted: DataFrame, items: Terms) -> tuple[int, np.ndarray]:
    """The number of documents, and of those that have each term."""
    rows = counted.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n")).collect()  # one row a term
    found = np.zeros(len(items.terms), dtype=np.int64)
    total = 0
    for r in rows:
        if r.term < 0:
            total = r.n
        else:
            found[r.term] = r.n
    return total, found


def sampled_passages(docs: DataFrame, sample_docs: int) -> DataFrame:
    """(words): the words' fingerprints of the passages of ``sample_docs`` documents, for callers that ask for so few."""
    chosen = docs.select("id").orderBy(F.xxhash64("id"), "id").limit(sample_docs).distinct()

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in folded(b.column(0)):
                words = word_hashes(text)[0].view(np.int64)
                rows += [words[at : at + PASSAGE].tolist() for at in range(0, len(words), PASSAGE)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64()))], ["words"])

    some = docs.join(F.broadcast(chosen), "id", "left_semi").select("text")  # at most sample_docs ids
    return staged(some.mapInArrow(passages, "words array<long>"), "passages")


def add_products(out: np.ndarray, flat: np.ndarray, sizes: np.ndarray, idf: np.ndarray) -> None:
    """Adds the upper half of AᵀA, with half of the diagonal, for passages whose terms stand one after the other.

    A passage is a row of A, its weights of length 1. Those of equal size are multiplied together, term by term.
    """
    terms, cells = len(idf), out.reshape(-1)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]).tolist():
        first = starts[sizes == size]
        for low in range(0, len(first), 8192):
            some = np.sort(flat[first[low : low + 8192] + np.arange(size)[:, None]], axis=0)
            w = idf[some]
            squares = (w * w).sum(axis=0)
            for d in range(1, size):  # terms that the passage repeats
                same = some[d:] == some[:-d]
                if not same.any():
                    break
                squares += 2 * (w[d:] * w[:-d] * same).sum(axis=0)
            w = (w / np.sqrt(squares)).astype(out.dtype)
            for i in range(size):
                product = w[i] * w[i:]
                product[0] /= 2
                np.add.at(cells, (some[i] * terms + some[i:]).ravel(), product.ravel())


class Products:
    """AᵀA of a block of items, a square of its terms, in slices of rows that stay with Spark."""

    def __init__(self, slices: DataFrame, terms: int):
        self.slices, self.terms, self.height = slices, terms, slice_height(terms)

    def times(self, basis: np.ndarray, own: tuple[np.ndarray, np.ndarray, np.ndarray, np.float32] | None = None) -> np.ndarray:
        """The matrix times a basis (terms by rank): each slice is multiplied where it is, and a row as short as the basis for each term comes back.

        own: further passages that count as well, for ``add_products`` (terms, sizes, idf), and the weight of each.
        """
        shared, height = self.slices.sparkSession.sparkContext.broadcast((basis, own)), self.height

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            basis, own = shared.value
            half = None
            for b in batches:
                for i, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    rows = np.frombuffer(data, dtype=np.float32).reshape(-1, len(basis))
                    if own is not None:
                        if half is None:
                            half = np.zeros((len(basis), len(basis)), dtype=np.float32)
                            add_products(half, *own[:3])
                        some = slice(i * height, i * height + len(rows))
                        rows = rows + own[3] * (half[some] + half[:, some].T)
                    turned = rows.astype(np.float64) @ basis
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([turned.tobytes()], pa.binary())], ["slice", "sums"])

        out = np.zeros((self.terms, basis.shape[1]))
        for r in self.slices.select("slice", "sums").mapInArrow(multiply, "slice int, sums binary").collect():  # terms by rank
            rows = np.frombuffer(r.sums).reshape(-1, basis.shape[1])
            out[r.slice * height : r.slice * height + len(rows)] = rows
        shared.destroy()
        return out

    def copy(self) -> np.ndarray:
        """Half of the matrix, to which its transpose adds the other half: the whole of it in the driver, for looking at small blocks."""
        out = np.zeros((self.terms, self.terms), dtype=np.float32)
        for r in self.slices.select("slice", "sums").toLocalIterator():
            rows = np.frombuffer(r.sums, dtype=np.float32).reshape(-1, self.terms)
            out[r.slice * self.height : r.slice * self.height + len(rows)] = rows / 2
        return out


def slice_height(terms: int) -> int:
    return max(1, SLICE // (4 * terms))


def made_whole(half: np.ndarray, size: int = 512) -> None:
    """Adds the transpose to a square matrix, in place."""
    for low in range(0, len(half), size):
        for left in range(low, len(half), size):
            upper, lower = half[low : low + size, left : left + size], half[left : left + size, low : low + size]
            both = upper + lower.T
            upper[:], lower[:] = both, both.T


def products(passages: DataFrame, items: Items, idf: np.ndarray) -> tuple[Products, int]:
    """AᵀA over all passages, whose rows are A, and the number of those that have a term of the items.

    Few tasks read many passages each and keep a matrix of terms by terms, the size of which the block of items
    bounds; slices of these matrices are added up by Spark and written, and none of them comes to the driver.
    """
    spark, terms = passages.sparkSession, len(items.terms)
    shared = spark.sparkContext.broadcast((Terms(items.terms), idf))
    height = slice_height(terms)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, idf = shared.value
        out, n = np.zeros((len(idf), len(idf)), dtype=np.float32), 0
        for b in batches:
            words = b.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            owner = pc.list_parent_indices(b.column(0)).to_numpy()
            at = known.term_of(words)
            there = at >= 0
            sizes = np.bincount(owner[there], minlength=len(b))
            add_products(out, at[there], sizes, idf)
            n += int((sizes > 0).sum())
        made_whole(out)
        for low in range(0, len(idf) if n else 0, height):
            part = [pa.array([low // height], pa.int32()), pa.array([n if low == 0 else 0], pa.int64()), pa.array([out[low : low + height].tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(part, ["slice", "n", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        count: dict[int, int] = {}
        for b in batches:
            for i, n, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = np.frombuffer(data, dtype=np.float32) if data else np.zeros(min(height, terms - i * height) * terms)
                sums[i] = sums[i] + own if i in sums else own.astype(np.float64)
                count[i] = count.get(i, 0) + n
        for i in sums:
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([count[i]], pa.int64()), pa.array([sums[i].astype(np.float32).tobytes()], pa.binary())], ["slice", "n", "sums"])

    schema = "slice int, n long, sums binary"
    none = spark.range(-(-terms // height)).select(F.col("id").cast("int").alias("slice"), F.lit(0).cast("long").alias("n"), F.lit(b"").alias("sums"))  # slices that no passage fills are there too
    each = passages.select("words").coalesce(max(TASKS, spark.sparkContext.defaultParallelism)).mapInArrow(multiply, schema)
    slices = staged(each.unionByName(none).repartition(-(-terms // height), "slice").mapInArrow(add, schema), "products")
    return Products(slices, terms), slices.agg(F.sum("n")).first()[0] or 0


def latent_space(passages: DataFrame, items: Items, idf: np.ndarray, rank: int) -> np.ndarray:
    """An orthonormal basis (terms by rank) of the passages' main directions, by randomised SVD.

    Passages of documents and of the items stand in the rows of A; the items' weigh ``OWN`` times as much together, so
    that the space holds them. Spark multiplies AᵀA by the basis that the driver turns.
    """
    gram, n = products(passages, items, idf)
    parts = [items.term_of(p) for _, p, _ in items.parts]
    own = np.concatenate(parts), np.array([len(t) for t in parts]), idf, np.float32(OWN * max(1, n) / max(1, len(parts)))
    width = min(rank + EXTRA, len(items.terms))

    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((len(items.terms), width)))[0]
    for _ in range(POWERS):
        basis = np.linalg.qr(gram.times(basis, own))[0]
    values, turn = np.linalg.eigh(basis.T @ gram.times(basis, own))
    return basis @ turn[:, np.argsort(-values)[:rank]]


class Finder:
    """Finds the items of a block in texts."""

    def __init__(self, items: Items, idf: np.ndarray, basis: np.ndarray, near: float, least_common: float):
        self.items, self.near, self.least = items, near, least_common
        #: the projection of one occurrence of each term, its squared weight last; words that no item has, and
        #: no word, which are the last two rows, have no weight
        known = np.hstack([basis * idf[:, None], idf[:, None] ** 2])
        self.project = np.vstack([known, np.zeros((2, known.shape[1]))]).astype(np.float32)
        #: for each size of window: items, vectors, and how many words that some item has a window needs
        self.queries = []
        for size in range(len(SIZES)):
            parts = [(i, items.term_of(p)) for i, p, s in items.parts if s == size]
            vectors = np.array([self.project[t, :-1].sum(axis=0) for _, t in parts]).reshape(len(parts), basis.shape[1])
            whole = np.sqrt(np.array([self.project[t, -1].sum() for _, t in parts]))
            own = np.sqrt((vectors**2).sum(axis=1))
            # what the item itself would get is 1, whatever share of it the latent space holds
            held = own >= HELD * whole
            scale = np.where(held, whole / np.maximum(own**2, 1e-9), 0.0)
            need = min((math.ceil(least_common * len(t) - 1e-9) - max(0, len(t) - SIZES[size]) for (_, t), h in zip(parts, held, strict=True) if h), default=0)
            some = np.flatnonzero(held)
            self.queries.append((np.array([i for i, _ in parts], dtype=np.int64)[some], (vectors * scale[:, None]).astype(np.float32)[some], max(1, need)))
        #: of each item: the number of a term within it (0: not there), how often it has each, bits of the places of
        #: each in it and in its answer, and the length of both
        self.local = np.zeros((len(items.words), len(items.terms) + 2), dtype=np.int32)
        self.counts, self.masks, self.lengths = [], [], []
        for i, w in enumerate(items.words):
            distinct, own = np.unique(items.term_of(w), return_inverse=True)
            self.local[i, distinct] = np.arange(1, len(distinct) + 1)
            self.counts.append(np.concatenate([[0], np.bincount(own)]))
            answer = max(1, len(w) // 4)
            self.masks.append([places_of(x, len(distinct)) for x in ((own + 1).tolist(), (own[-answer:] + 1).tolist())])
            self.lengths.append((len(w), answer))
        #: the counts of all items one after the other, where each item's begin, and how many they are
        self.limits = np.concatenate(self.counts) if self.counts else np.zeros(0, np.int64)
        self.widths = np.array([len(c) for c in self.counts], dtype=np.int64)
        self.begins = np.cumsum(self.widths) - self.widths
        #: of each item: words that must be common, words of the stretch in which they must be, hits that this takes
        self.need = np.array([max(1, math.ceil(least_common * len(w) - 1e-9)) for w in items.words], dtype=np.int64)
        self.room = np.array([2 * len(w) for w in items.words], dtype=np.int64)
        for i, part, _ in items.parts:
            reach = max((n for n, step in zip(REACH, REACHED, strict=True) if n + step - 1 <= len(part)), default=REACH[0])
            self.room[i] = max(self.room[i], 2 * len(items.words[i]) + reach)
        self.hits = np.array([min(n, max(1, len(w) // HIT)) for n, w in zip(self.need, items.words, strict=True)], dtype=np.int64)
        rare = []
        for w, need, hits in zip(items.words, self.need, self.hits, strict=True):
            t = items.term_of(w)
            rare.append(np.unique(t[np.argsort(-idf[t], kind="stable")[: len(w) - need + hits]]))
        terms = np.concatenate(rare) if rare else np.zeros(0, dtype=np.int64)
        order = np.argsort(terms, kind="stable")
        #: the items that have a term among their rarest are postings[starts[term]:starts[term + 1]]
        self.postings = np.repeat(np.arange(len(rare)), [len(t) for t in rare])[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(items.terms) + 1))

    def candidates(self, term: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """(first word, item, cosine, size) of windows near an item; term has whole steps.

        A window is looked at if it, or one that begins less than a step away, has as many words of
        the benchmark as an item of its size needs; most windows have not.
        """
        n = len(term)
        padded = np.concatenate([np.full(STEP, -1), term, np.full(SIZES[-1] + STEP, -1)])
        known = np.concatenate([[0], np.cumsum((padded >= 0) & (padded < len(self.items.terms)))])
        wanted = []
        for size, (item, _, need) in zip(SIZES, self.queries, strict=True):
            if not len(item):
                wanted.append(np.zeros(0, dtype=np.int64))
                continue
            have = known[size : size + n + STEP] - known[: n + STEP]  # of windows from STEP before the first word on
            nearby = np.maximum.reduceat(have, np.arange(0, n + STEP, STEP))
            nearby = np.maximum(nearby[:-1], nearby[1:])
            if size >= SPARSE:  # every other one, for its neighbours as well
                nearby[:-1] = np.maximum(nearby[:-1], nearby[1:])
                nearby[1::2] = 0
            wanted.append(np.flatnonzero(nearby >= need))
        if not any(len(w) for w in wanted):
            return
        # sums of 4, 8, 16, ... words from each step on, of which windows are made; only of steps that are in a window
        inside = np.zeros(len(padded) // STEP, dtype=np.int64)
        for size, at in zip(SIZES, wanted, strict=True):
            inside[at] += 1
            inside[at + size // STEP] -= 1
        inside = np.cumsum(inside) > 0
        place = np.cumsum(inside) - 1
        blocks = padded[STEP:].reshape(-1, STEP)[np.flatnonzero(inside[:-1])]
        sums = {STEP: self.project[blocks[:, 0]]}
        for k in range(1, STEP):
            sums[STEP] += self.project[blocks[:, k]]
        for width in (2 * STEP, 4 * STEP):
            half = sums[width // 2]
            sums[width] = half[: -(width // 2 // STEP)] + half[width // 2 // STEP :]
        for size, at, (item, vectors, _) in zip(SIZES, wanted, self.queries, strict=True):
            for low in range(0, len(at), 2048):
                some = at[low : low + 2048]
                first = place[some]
                window, done = None, 0
                for width in sorted(sums, reverse=True):
                    while size - done >= width:
                        part = sums[width][first + done // STEP]
                        window = part if window is None else np.add(window, part, out=window)
                        done += width
                norm = np.sqrt(np.maximum(window[:, -1], 1e-9))
                cosine = window[:, :-1] @ vectors.T
                w, q = np.divmod(np.flatnonzero(cosine >= (self.near * norm)[:, None]), len(item))
                yield some[w] * STEP, item[q], cosine[w, q] / norm[w], size

    def in_block(self, block: list[bytes], words: np.ndarray, start: np.ndarray, index: bool) -> list[list[tuple[int, float, float]]]:
        """(item id, cosine, share of the item that is common) for each text of a block."""
        out: list[list] = [[] for _ in block]
        if len(self.items.terms):
            bounds = np.searchsorted(start, np.cumsum([0] + [len(t) + 1 for t in block]))
            counts = np.diff(bounds)
            room = -(-counts // STEP) * STEP
            places = np.cumsum(room) - room
            term = np.full(room.sum(), len(self.items.terms))
            doc = np.repeat(np.arange(len(block)), counts)
            term[places[doc] + np.arange(len(words)) - bounds[doc]] = self.items.term_of(words)  # -1: other words
            flat = term[places[doc] + np.arange(len(words)) - bounds[doc]]
            done = set()
            found = [(w, i, c, s) for w, i, c, s in self.candidates(term) if len(w)]
            if found:
                at, item, cosine = (np.concatenate([f[n] for f in found]) for n in range(3))
                size = np.concatenate([np.full(len(f[0]), f[3]) for f in found])
                owner = np.searchsorted(places, at, side="right") - 1
                low = self.around(at - places[owner], size, item) + bounds[owner]
                some = self.enough(flat, low, np.minimum(low + self.room[item], bounds[owner + 1]), item)
                at, item, cosine, size, owner = (x[some] for x in (at, item, cosine, size, owner))
                for n in np.lexsort((-cosine, item, owner)):
                    key = (int(owner[n]), int(item[n]))
                    if key in done:
                        continue
                    part = slice(bounds[owner[n]], bounds[owner[n] + 1])
                    share = self.checked(flat[part], int(at[n] - places[owner[n]]), int(size[n]), int(item[n]))
                    if share:
                        out[owner[n]].append((self.items.ids[item[n]], min(float(cosine[n]), 1.0), share))
                        done.add(key)
            for n, i, at in self.hit(flat, doc) if index else ():
                if (n, i) not in done:
                    part = slice(bounds[n], bounds[n + 1])
                    if result := self.searched(flat[part], i, at - bounds[n]):
                        out[n].append((self.items.ids[i], *result))
        return out

    def hit(self, term: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, item, places of the words (first, last) of each run of as many hits as the item takes)."""
        count = np.where(term >= 0, self.starts[term + 1] - self.starts[term], 0)
        at = np.repeat(np.arange(len(term)), count)
        if not len(at):
            return
        nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        item = self.postings[self.starts[term[at]] + nth]
        order = np.argsort(item, kind="stable")  # by item, then by place
        at, item = at[order], item[order]
        last = np.arange(len(at)) + self.hits[item] - 1
        run = np.flatnonzero(last < len(at))
        last = last[run]
        run, last = (x[(item[run] == item[last]) & (doc[at[run]] == doc[at[last]]) & (at[last] - at[run] < self.room[item[run]])] for x in (run, last))
        if not len(run):
            return
        item, places = item[run], np.stack([at[run], at[last]], axis=1)
        owner = doc[places[:, 0]]
        edges = np.flatnonzero((np.diff(item, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
        for a, b in zip(edges, [*edges[1:], len(item)], strict=True):
            yield int(owner[a]), int(item[a]), places[a:b]

    def searched(self, term: np.ndarray, item: int, runs: np.ndarray) -> tuple[float, float] | None:
        """(cosine, common share) of a stretch that has one of the runs in it and passes, if there is one."""
        weight = np.zeros(len(self.items.terms) + 2)
        np.add.at(weight, self.items.term_of(self.items.words[item]), 1.0)
        room, need = int(self.room[item]), self.need[item]
        known = np.concatenate([[0], np.cumsum(weight[term] > 0)])
        lows, highs = np.maximum(0, runs[:, 1] - room + 1), np.minimum(len(term), runs[:, 0] + room)
        some = np.flatnonzero(known[highs] - known[lows] >= need)
        for n in some[self.enough(term, lows[some], highs[some], np.full(len(some), item))]:
            low, high, start = int(lows[n]), int(highs[n]), int(runs[n, 0])
            # all stretches that begin the run together first, then each, from the middle one outwards
            share = self.common(term[low:high], item)
            if share and high - low > room:
                middle = (low + start) // 2
                tries = (s for s in sorted(range(low, start + 1), key=lambda s: abs(s - middle)) if known[min(s + room, len(term))] - known[s] >= need)
                low, share = next(((s, c) for s in tries if (c := self.common(term[s : s + room], item))), (low, 0.0))
            if share:
                squares = self.project[:, -1].astype(np.float64)
                dot, norm = (np.concatenate([[0.0], np.cumsum(x[term[low : low + room]])]) for x in (weight * squares, squares))
                size = min(len(self.items.words[item]), len(dot) - 1)
                dot, norm = (x[size:] - x[: len(x) - size] for x in (dot, norm))
                whole = (weight * squares).sum()
                return min(float((dot / np.sqrt(np.maximum(norm * whole, 1e-9))).max()), 1.0), share
        return None

    def checked(self, term: np.ndarray, at: int, size: int, item: int) -> float:
        """The common share of the item around a window, or 0 when that or the answer's is too small."""
        low = int(self.around(at, size, item))
        return self.common(term[low : low + int(self.room[item])], item)

    def around(self, at: np.ndarray, size: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Where the stretch around a window begins."""
        return np.maximum(0, at - (self.room[item] - size) // 2)

    def enough(self, term: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Whether stretches have as many words of an item as must be common, each no more often than the item has it."""
        have = np.zeros(len(item), dtype=np.int64)
        size, width = high - low, self.widths[item]
        cost = np.cumsum(size + width)
        for part in np.split(np.arange(len(item)), np.flatnonzero(np.diff(cost // STRETCHES)) + 1) if len(item) else ():
            own, reach, cells = item[part], size[part], width[part]
            word = self.local.ravel()[np.repeat(own * self.local.shape[1], reach) + term[ranges(low[part], reach)]]  # before each row stands a 0, for -1
            first = np.cumsum(cells) - cells
            count = np.bincount(np.repeat(first, reach) + word, minlength=cells.sum())
            limit = self.limits[ranges(self.begins[own], cells)]  # 0 of words that the item has not
            have[part] = np.add.reduceat(np.minimum(count, limit), first)
        return have >= self.need[item]

    def common(self, around: np.ndarray, item: int) -> float:
        """The common share of the item and a stretch, or 0 when that or the answer's is too small."""
        words = self.local[item, around]
        words = words[words > 0]  # others are in no common subsequence
        need = self.need[item]
        if len(words) < need or np.minimum(np.bincount(words, minlength=len(self.counts[item])), self.counts[item]).sum() < need:
            return 0.0
        words = words.tolist()
        (whole, answer), (size, last) = self.masks[item], self.lengths[item]
        share = common_subsequence(whole, size, words) / size
        return share if share >= self.least and common_subsequence(answer, last, words) >= self.least * last else 0.0


def found_in(finders: list[Finder], texts: list[bytes], index: bool = True) -> list[list[tuple[int, float, float]]]:
    """(item id, cosine, share of the item that is common) for each text, by item.

    Without the index of rare words, what the latent space alone finds.
    """
    out: list[list] = [[] for _ in texts]
    for first, block in blocks_of(texts):
        words, start = word_hashes(b"\n".join(block))
        if len(words):
            for finder in finders:
                for n, found in enumerate(finder.in_block(block, words, start, index)):
                    out[first + n] += found
    return [sorted(f) for f in out]


def finders(
    docs: DataFrame, benchmark: DataFrame, block: int, sample_docs: int | None, rank: int, near: float, least_common: float
) -> Iterator[list[Finder]]:
    """Finders for ``GROUP`` blocks of items at a time; docs are rows (id, text).

    A block has about ``block`` items, fewer of long ones.
    """
    known = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text <> ''").distinct()
    size = known.agg(F.count("*").alias("items"), F.sum(F.length("text")).alias("letters")).first()
    blocks = max(1, math.ceil(size["items"] / block), math.ceil((size["letters"] or 0) / (4 * BLOCK_WORDS)))
    passages = None
    for low in range(0, blocks, GROUP):
        place = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
        rows = known.where(place.between(low, low + GROUP - 1)).select("item_id", "text", place.alias("place")).orderBy("item_id", "text").collect()  # about GROUP blocks
        group = [Items([(r.item_id, r.text) for r in rows if r.place == n]) for n in range(low, low + GROUP)]
        group = [items for items in group if items.ids]
        if not group:
            continue
        every = Terms(np.unique(np.concatenate([items.terms for items in group])))
        counted = counted_passages(docs, every)
        total, df = document_frequency(counted, every)
        passages = counted.where("words IS NOT NULL") if sample_docs is None else passages or sampled_passages(docs, sample_docs)
        idf = np.log((1 + total) / (1 + df)) + 0.1
        found = []
        for items in group:
            own = idf[every.term_of(items.terms)]
            found.append(Finder(items, own, latent_space(passages, items, own, rank), near, least_common))
        yield found


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = 256,
    sample_docs: int | None = None,
    rank: int = RANK,
    near: float = 0.6,
    least_common: float = 0.7,
    index: bool = True,
) -> DataFrame:
    """(doc_id, item_id, cosine, common): the items found in each document.

    ``near`` is the least cosine of a candidate: an item that has ``least_common`` of its words, the others being
    as heavy, has that cosine, less what a window that is half a step off loses. The space is fitted to the passages of
    all documents, or of ``sample_docs`` of them if that is given.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = []
    for group in finders(rows, benchmark, block, sample_docs, rank, near, least_common):
        shared = docs.sparkSession.sparkContext.broadcast(group)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                each = zip(b.column(0).to_pylist(), found_in(shared.value, folded(b.column(1)), index), strict=True)
                rows = [(doc, *f) for doc, items in each for f in items]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["doc_id", "item_id", "cosine", "common"])

        found.append(rows.mapInArrow(run, "doc_id long, item_id long, cosine double, common double"))
    if not found:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, cosine double, common double")
    return reduce(DataFrame.unionByName, found)


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = 256, sample_docs: int | None = None,
    rank: int = RANK, near: float = 0.6, least_common: float = 0.7,
) -> DataFrame:
    """The rows that hold no item, with their columns as they are."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    at = docs.columns.index(text_col)
    for group in finders(rows, benchmark, block, sample_docs, rank, near, least_common):
        shared = docs.sparkSession.sparkContext.broadcast(group)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array([not f for f in found_in(shared.value, folded(b.column(at)))], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
