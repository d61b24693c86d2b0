"""SentencePiece BPE encoding and decoding with vectorised merge rounds.

The words of a batch (a text cut before each run of spaces, where no piece goes across) stand one after
the other in one flat numpy array of symbols. A round finds the pair of lowest rank of every word at once
(a segmented minimum), merges all its occurrences from the left, and compacts the array; words without a
mergeable pair leave it, until none is left. A merge may make a pair that ranks before the one just
merged; the occurrences to its right then wait for a later round, so ids are the library's in every case.

Words of more than ``LONG`` symbols are first cut between letters that no piece has side by side; what is
still longer is merged with a heap, as rounds would look at all its symbols for each merge. Words and
their results are kept between batches, at most two times ``KEPT`` of them.

The model file is a parameter: BPE with byte fallback, no character map, no user-defined pieces; others
are refused. Null and empty texts have no ids and decode to the empty text. Repeated rows give a row each.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
KEPT = 250_000
LONG = 512
BLOCK = 1 << 20
#: symbols are piece ids, or the number of pieces plus a code point; two fit a key
BITS = 21
NONE = np.iinfo(np.int64).max
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(number, value) of the fields of a serialised message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield number, data[at : at + size]
        at += size


class Model:
    """A model file: its pieces, the rank of each pair of symbols, and what each piece stands for."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.digest = hashlib.sha256(data).hexdigest()
        read = list(fields(data))
        self.pieces: list[str] = []
        scores, kinds = [], []
        for number, value in read:
            if number == 1:
                piece = dict(fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
        trainer, normal = (dict(fields(b"".join(v for n, v in read if n == part))) for part in (2, 3))
        plain = not normal.get(2) and normal.get(3, 1) and not normal.get(4, 1) and normal.get(5, 1)
        if trainer.get(3, 1) != 2 or not trainer.get(35) or trainer.get(24) or not plain or not {*kinds} <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models with byte fallback, a space put first and otherwise unchanged texts")
        self.size = len(self.pieces)
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)) if k == NORMAL}
        #: equal scores have equal ranks; the leftmost of them goes first
        by_score = {s: r for r, s in enumerate(sorted({-scores[i] for i in self.ids.values()}))}
        pairs = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.symbol(piece[:cut]), self.symbol(piece[cut:])
                if a is not None and b is not None:
                    pairs[a << BITS | b] = by_score[-scores[i]] << BITS | i
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        beside = {ord(a) << BITS | ord(b) for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        self.beside = np.array(sorted(beside), dtype=np.int64)
        self.letters = np.arange(0x110000, dtype=np.int64) + self.size
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.letters[ord(piece)] = i
        #: whether a text may be cut before each run of spaces
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.bytes = np.zeros(256, dtype=np.int64)
        self.surfaces: list[str | int] = []
        for i, (piece, kind) in enumerate(zip(self.pieces, kinds, strict=True)):
            if kind == BYTE:
                self.bytes[int(piece[3:5], 16)] = i
                self.surfaces.append(int(piece[3:5], 16))
            elif kind == UNKNOWN:
                self.surfaces.append(trainer.get(44, " ⁇ ".encode()).decode())
            else:
                self.surfaces.append("" if kind == CONTROL else piece.replace(SPACE, " "))
        self.begins_with_space = [k == NORMAL and p.startswith(SPACE) for p, k in zip(self.pieces, kinds, strict=True)]
        if (self.bytes == 0).sum() > 1:
            raise ValueError("the model lacks pieces for bytes")

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "table"}

    @cached_property
    def table(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.values.tolist(), strict=True))

    def symbol(self, piece: str) -> int | None:
        return self.ids.get(piece, self.size + ord(piece) if len(piece) == 1 else None)

    def words(self, text: str) -> list[str]:
        """The words of a text, each without the mark of a space that it begins with."""
        if not text:
            return []
        if not self.cuts:
            return [text.replace(" ", SPACE)]
        if "  " not in text and SPACE not in text and text[0] != " ":
            return text.split(" ")
        return [w[1:] for w in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))]

    def looked_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and id (the upper and lower bits) of the piece that two symbols make; NONE if there is none."""
        keys = left << BITS | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], NONE)

    def encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """The ids of each word (given as ``words`` gives them)."""
        ids, cuts = self.encode_flat(words)
        flat, cuts = ids.tolist(), cuts.tolist()
        return [tuple(flat[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode_flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and where each word's begin, and the last one's end."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        sizes = np.array([len(w) + 1 for w in words])
        codes = np.frombuffer((SPACE + SPACE.join(words)).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        segment, long = self.segments(codes, word, sizes)
        symbols, segment = self.merged(self.letters[codes], segment, long)
        owner = np.zeros(int(segment[-1]) + 1, dtype=np.int64)
        owner[long[1]] = long[2]
        ids, of = self.as_bytes(symbols, owner[segment])
        return ids, np.searchsorted(of, np.arange(len(words) + 1))

    def segments(self, codes: np.ndarray, word: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """The segment of each letter, and (size, number, word) of each: words, long ones cut where none can merge."""
        new = np.ones(len(codes), dtype=bool)
        new[1:] = word[1:] != word[:-1]
        if (sizes > LONG).any():
            inner = np.flatnonzero((sizes > LONG)[word] & ~new)
            keys = codes[inner - 1] << BITS | codes[inner]
            at = np.minimum(np.searchsorted(self.beside, keys), len(self.beside) - 1)
            new[inner[self.beside[at] != keys]] = True
        segment = np.cumsum(new) - 1
        return segment, (np.bincount(segment), np.arange(segment[-1] + 1), word[new])

    def merged(self, symbols: np.ndarray, segment: np.ndarray, long: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all segments when no pair is left, with their segments, in order."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        sizes = long[0]
        if (sizes > LONG).any():
            starts = np.cumsum(sizes) - sizes
            for s in np.flatnonzero(sizes > LONG).tolist():
                ids = self.merged_long(symbols[starts[s] : starts[s] + sizes[s]])
                out.append((ids, np.full(len(ids), s)))
            short = (sizes <= LONG)[segment]
            symbols, segment = symbols[short], segment[short]
        pair = self.pairs(symbols, segment)
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            lengths = np.diff(np.append(starts, len(segment)))
            # words that have no pair any more leave the array
            least = np.minimum.reduceat(pair, starts)
            open_ = np.repeat(least != NONE, lengths)
            if not open_.all():
                out.append((symbols[~open_], segment[~open_]))
                symbols, segment, pair = symbols[open_], segment[open_], pair[open_]
                least, lengths = least[least != NONE], lengths[least != NONE]
                if not len(symbols):
                    break
            least = np.repeat(least >> BITS, lengths)
            chosen = self.leftmost((pair >> BITS == least) & (pair != NONE))
            at = self.undisturbed(chosen, symbols, segment, pair)
            symbols[at] = pair[at] & ((1 << BITS) - 1)
            kept = np.ones(len(symbols), dtype=bool)
            kept[at + 1] = False
            fresh = np.zeros(len(symbols), dtype=bool)
            fresh[at] = True
            symbols, segment, pair, fresh = symbols[kept], segment[kept], pair[kept], fresh[kept]
            fresh[:-1] |= fresh[1:]
            where = np.flatnonzero(fresh)
            pair[where] = self.pairs(symbols, segment, where)
        symbols, segment = (np.concatenate([o[i] for o in out]) for i in range(2))
        order = np.argsort(segment, kind="stable")
        return symbols[order], segment[order]

    def pairs(self, symbols: np.ndarray, segment: np.ndarray, where: np.ndarray | None = None) -> np.ndarray:
        """What each symbol (or those at ``where``) and the next one of its segment make."""
        if where is None:
            where = np.arange(len(symbols))
        found = np.full(len(where), NONE)
        inner = np.flatnonzero(where + 1 < len(symbols))
        inner = inner[segment[where[inner]] == segment[where[inner] + 1]]
        at = where[inner]
        found[inner] = self.looked_up(symbols[at], symbols[at + 1])
        return found

    @staticmethod
    def leftmost(candidate: np.ndarray) -> np.ndarray:
        """Of candidates that follow each other, and so overlap, every other one from the left."""
        at = np.flatnonzero(candidate)
        first = np.ones(len(at), dtype=bool)
        first[1:] = at[1:] != at[:-1] + 1
        run = np.flatnonzero(first)
        place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        return at[place % 2 == 0]

    def undisturbed(self, at: np.ndarray, symbols: np.ndarray, segment: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """The merges of a round, less those to the right of one that makes a pair that goes first."""
        made = pair[at] & ((1 << BITS) - 1)
        rank, of = pair[at] >> BITS, segment[at]
        before, after = np.maximum(at - 1, 0), np.minimum(at + 2, len(symbols) - 1)
        left, right = symbols[before], symbols[after]
        follows = np.zeros(len(at), dtype=bool)
        follows[1:] = (at[1:] == at[:-1] + 2) & (of[1:] == of[:-1])
        left[follows] = made[:-1][follows[1:]]
        stops = np.zeros(len(at), dtype=bool)
        for there, a, b in (((at > 0) & (segment[before] == of), left, made), ((at + 2 < len(symbols)) & (segment[after] == of), made, right)):
            n = np.flatnonzero(there)
            made_next = self.looked_up(a[n], b[n])
            stops[n] |= (made_next != NONE) & (made_next >> BITS <= rank[n])
        if not stops.any():
            return at
        passed = np.cumsum(stops) - stops
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        base = np.repeat(passed[first], np.diff(np.append(first, len(of))))
        return at[passed == base]

    def merged_long(self, symbols: np.ndarray) -> np.ndarray:
        """The same for one long segment, with a heap of its pairs."""
        ids, n = symbols.tolist(), len(symbols)
        pair = self.looked_up(symbols[:-1], symbols[1:])
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(v >> BITS, i, v) for i, v in enumerate(pair.tolist()) if v != NONE]
        heapq.heapify(heap)
        table = self.table
        while heap:
            _, i, value = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or table.get(ids[i] << BITS | ids[j]) != value:
                continue
            ids[i], ids[j], after[i] = value & ((1 << BITS) - 1), -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (v := table.get(ids[a] << BITS | ids[b])) is not None:
                    heapq.heappush(heap, (v >> BITS, a, v))
        return np.array([i for i in ids if i >= 0], dtype=np.int64)

    def as_bytes(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their words: letters that are no piece become their bytes."""
        other = symbols >= self.size
        if not other.any():
            return symbols, owner
        spelled = [self.bytes[list(chr(s - self.size).encode())] for s in symbols[other].tolist()]
        count = np.ones(len(symbols), dtype=np.int64)
        count[other] = [len(s) for s in spelled]
        ids = np.repeat(symbols, count)
        ids[np.repeat(other, count)] = np.concatenate(spelled)
        return ids, np.repeat(owner, count)

    def surface(self, ids) -> str:
        """What ids stand for, the space at the front included; bytes that are not UTF-8 give a mark each."""
        out: list[str] = []
        raw = bytearray()
        surfaces = self.surfaces
        for i in ids:
            s = surfaces[i]
            if type(s) is int:
                raw.append(s)
                continue
            if raw:
                out.append(utf8(bytes(raw)))
                raw.clear()
            out.append(s)
        if raw:
            out.append(utf8(bytes(raw)))
        return "".join(out)

    def decode(self, ids) -> str:
        """The text of ids: their surfaces, less the space that encoding put first."""
        for n, i in enumerate(ids):
            if self.begins_with_space[i]:
                # control pieces before it are empty
                return self.surface(ids[n:])[1:] if all(self.surfaces[x] == "" for x in ids[:n]) else self.surface(ids)
            if self.surfaces[i] != "":
                break
        return self.surface(ids)


def utf8(raw: bytes) -> str:
    """Decoded, with one mark for each byte that is not part of a valid sequence."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("utf-8", "surrogateescape").translate(dict.fromkeys(range(0xDC80, 0xDD00), "�"))


class Encoder:
    """Encodes texts; keeps ``of(ids)`` for each word, the newest and as many before them."""

    def __init__(self, model: Model, of: Callable[[tuple[int, ...]], object] = lambda ids: ids):
        self.model, self.of = model, of
        self.kept: dict = {}
        self.older: dict = {}

    def learn(self, needed: set[str]) -> None:
        """After this ``kept`` has all the words; those that it had may have gone to ``older``."""
        words = needed - self.kept.keys()
        if len(self.kept) + len(words) > KEPT:
            self.kept, self.older, words = {}, self.kept, needed
        kept, older, of = self.kept, self.older, self.of
        new = []
        for w in words:
            if w in older:
                kept[w] = older[w]
            else:
                new.append(w)
        for w, ids in zip(new, self.model.encode_words(new), strict=True):
            kept[w] = of(ids)

    def each(self, texts: list[str]) -> Iterator[list]:
        """For each text what is kept for its words, in blocks of about a megabyte."""
        at = 0
        while at < len(texts):
            block, size = [], 0
            while at < len(texts) and size < BLOCK:
                block.append(self.model.words(texts[at]))
                size += len(texts[at])
                at += 1
            self.learn(set(chain.from_iterable(block)))
            kept = self.kept
            for words in block:
                yield [kept[w] for w in words]


_encoders: dict[str, Encoder] = {}


def encoder_for(name: str, model: Model, of: Callable[[tuple[int, ...]], object] = lambda ids: ids) -> Encoder:
    """The encoder that a Python worker keeps for a purpose and a model."""
    key = f"{name}-{model.digest}"
    if key not in _encoders:
        _encoders[key] = Encoder(model, of)
    return _encoders[key]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(Model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for("ids", shared.value)
        for b in batches:
            ids = [list(chain.from_iterable(words)) for words in encoder.each([x or "" for x in b.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids decode to the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(Model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [shared.value.decode(ids or []) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of what encode and then decode give.

    No piece and no run of bytes goes across a word's start, so a word's ids are written out and decoded
    once for all its occurrences.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        encoder = encoder_for("digests", model, lambda ids: (len(ids), ",".join(map(str, ids)), model.surface(ids)))
        for b in batches:
            counts, first, second = [], [], []
            for words in encoder.each([x or "" for x in b.column(1).to_pylist()]):
                counts.append(sum([w[0] for w in words]))
                first.append(hashlib.sha256(",".join([w[1] for w in words]).encode()).hexdigest())
                # the first piece begins with the space that encoding put there
                second.append(hashlib.sha256("".join([w[2] for w in words])[1:].encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
