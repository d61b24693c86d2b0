"""BPE encoding and decoding with a minimal acyclic transducer of frequent words.

Words that the corpus repeats are compiled, with the ids they encode to, into an automaton that
shares prefixes and suffixes: a path's arcs carry how many words sort before it, so walking a word
gives its number and that its ids. The automaton is a file of flat arrays; Spark ships it to every
executor, whose tasks memory-map it. Words that it lacks are merged by rank, exactly; it changes
speed, never ids. The tokenizer file (BPE over bytes with word ends, NFC and lower case before,
white space dropped, no decoder) is a parameter.

Python's Unicode tables and those of the tokenizers library differ in characters that one of them does not know
yet. Texts with characters that Python calls unassigned, or with marks that the library does not take for marks, are put
in normal form and split by the library itself; a test over all code points shows that on others both agree. Their words are looked up and merged as any other.

Null and empty texts have no ids and decode to the empty text. Rows repeat freely.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import tempfile
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

from tidemark.llm.common import staged

WORDS = 32_768
SEEN = 8
KEPT = 250_000
LONG = 64
BITS, MASK, NONE = 20, (1 << 20) - 1, 1 << 62
ODD_SPACE = re.compile("[\x1c-\x1f]")


@cache
def odd_characters(rules: str) -> np.ndarray:
    """Which code points Python's Unicode tables do not know, and which marks the library's do not.

    A mark that is known lets a later mark of another class pass to the letter before it.
    """
    normal = Library.from_str(rules).normalizer.normalize_str

    def passes(mark: str) -> bool:
        return all(normal(x) == unicodedata.normalize("NFC", x).lower() for x in (f"e{mark}\u0301", f"e{mark}\u0327"))

    def known(c: str) -> bool:
        return unicodedata.category(c) != "Cn" and (not unicodedata.combining(c) or passes(c))

    return np.fromiter((not known(chr(i)) for i in range(0x110000)), dtype=bool, count=0x110000)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Tokenizer:
    """A tokenizer file: its split into words, its merges by rank, its ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
        split = found["pre_tokenizer"]["pretokenizers"][0]
        self.pattern = split["pattern"]["Regex"]
        self.ids: dict[str, int] = found["model"]["vocab"]
        self.end: str = found["model"]["end_of_word_suffix"]
        #: for a pair of ids (one in the upper, one in the lower bits) its rank and the id of the two together
        self.pairs = {
            self.ids[a] << BITS | self.ids[b]: i << BITS | self.ids[a + b] for i, (a, b) in enumerate(found["model"]["merges"])
        }
        self.special = {t["content"]: t["id"] for t in found["added_tokens"]}
        rules = {"version": found["version"], "added_tokens": [], "normalizer": found["normalizer"], "pre_tokenizer": found["pre_tokenizer"]}
        self.rules = json.dumps(rules | {"truncation": None, "padding": None, "post_processor": None, "decoder": None, "model": {"type": "BPE", "vocab": {}, "merges": []}})
        letters = byte_letters()
        self.inner = [self.ids[c] for c in letters]
        self.last = [self.ids[c + self.end] for c in letters]
        self.ready()

    def ready(self) -> None:
        self.words = regex.compile(self.pattern)
        self.parts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.odd = odd_characters(self.rules)
        self.beyond = re.compile(f"[{chr(int(self.odd.argmax()))}-{chr(0x10FFFF)}]")
        self.library = Library.from_str(self.rules)
        self.tokens = {i: t for t, i in chain(self.ids.items(), self.special.items())}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("words", "parts", "tokens", "odd", "beyond", "library")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.ready()

    def normal(self, text: str) -> str:
        """NFC, then lower case letter by letter (a whole text would turn its last sigmas)."""
        text = unicodedata.normalize("NFC", text)
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def is_odd(self, text: str) -> bool:
        """Whether a text has a character on which the tables differ; most texts have none as high as the first."""
        if text.isascii() or not self.beyond.search(text):
            return False
        return bool(self.odd[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)].any())

    def split_by_library(self, text: str) -> list[tuple[str]]:
        """The words of a text, each alone in a tuple, so that they are not split again."""
        normal = self.library.normalizer.normalize_str(text)
        return [(normal[a:b],) for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def merged(self, word: str) -> list[int]:
        """Ids of one word: the pair of lowest rank, leftmost first, is merged until none has a rank."""
        raw = word.encode()
        if not raw:
            return []
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        if len(ids) > LONG:
            return self.merged_long(ids)
        get = self.pairs.get
        ranks = [get(a << BITS | b, NONE) for a, b in pairwise(ids)]
        while ranks and (least := min(ranks)) != NONE:
            i = ranks.index(least)
            ids[i] = least & MASK
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(ids[i] << BITS | ids[i + 1], NONE)
            if i:
                ranks[i - 1] = get(ids[i - 1] << BITS | ids[i], NONE)
        return ids

    def merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap, for words where looking at all pairs each time would take too long."""
        n, get = len(ids), self.pairs.get
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i) for i, (a, b) in enumerate(pairwise(ids)) if (r := get(a << BITS | b, NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or get(ids[i] << BITS | ids[j]) != rank:
                continue
            ids[i], ids[j], after[i] = rank & MASK, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := get(ids[a] << BITS | ids[b], NONE)) != NONE:
                    heapq.heappush(heap, (r, a))
        return [i for i in ids if i >= 0]

    def decode(self, ids) -> str:
        """The tokens as they stand, with a space between: the file names no decoder."""
        return " ".join(self.tokens[i] for i in ids)


def compiled(words: dict[str, list[int]]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of the words, with their ids by word number.

    Words come in byte order; a state is closed when no later word can extend it, and a closed state
    with the same arcs as an earlier one is that state. The arcs of a state are rows of ``keys``
    (state * 256 + byte, ascending), with the state they lead to and the words that come before.
    """
    order = sorted((w.encode(), w) for w in words)
    known: dict[tuple, int] = {}
    closed: list[tuple[bool, tuple]] = []
    counts: list[int] = []
    path: list[list] = [[False, []]]
    last = b""

    def close(upto: int) -> None:
        while len(path) > upto + 1:
            final, arcs = path.pop()
            state = (final, tuple(arcs))
            if state not in known:
                known[state] = len(closed)
                closed.append(state)
                counts.append(final + sum(counts[to] for _, to in arcs))
            path[-1][1].append((last[len(path) - 1], known[state]))

    for word, _ in order:
        same = len(os.path.commonprefix([word, last]))
        close(same)
        path.extend([False, []] for _ in word[same:])
        path[-1][0], last = True, word
    close(0)
    closed.append((path[0][0], tuple(path[0][1])))
    keys, to, skip = [], [], []
    for state, (final, arcs) in enumerate(closed):
        passed = int(final)
        for byte, target in arcs:
            keys.append(state * 256 + byte)
            to.append(target)
            skip.append(passed)
            passed += counts[target]
    ids = [words[w] for _, w in order]
    return {
        "keys": np.array(keys, dtype=np.int64),
        "to": np.array(to, dtype=np.int64),
        "skip": np.array(skip, dtype=np.int64),
        "final": np.array([f for f, _ in closed], dtype=np.int64),
        "starts": np.cumsum([0, *map(len, ids)], dtype=np.int64),
        "ids": np.array([i for x in ids for i in x], dtype=np.int64),
    }


def write_arrays(arrays: dict[str, np.ndarray], path: str) -> None:
    """One file: a line of JSON with the sizes, then the arrays, 64-bit, one after the other."""
    with open(path, "wb") as f:
        f.write(json.dumps({k: len(v) for k, v in arrays.items()}).encode().ljust(4095) + b"\n")
        for v in arrays.values():
            f.write(np.ascontiguousarray(v, dtype="<i8").tobytes())


class Lexicon:
    """The automaton, mapped from its file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            sizes = json.loads(f.read(4096))
        self.read: dict[int, tuple[int, ...]] = {}
        at = 4096
        for name, size in sizes.items():
            array = np.memmap(path, dtype="<i8", mode="r", offset=at, shape=(size,)) if size else np.zeros(0, np.int64)
            setattr(self, name, array.view(np.ndarray))
            at += 8 * size

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for one that is not there; all words walk a byte at a time."""
        found = np.full(len(words), -1, dtype=np.int64)
        if not len(self.keys) or not words:
            return found
        sizes = np.array([len(w) for w in words])
        starts = np.cumsum(sizes) - sizes
        letters = np.frombuffer(b"".join(words) or b"\0", dtype=np.uint8)
        alive = np.arange(len(words))
        state = np.full(len(words), len(self.final) - 1, dtype=np.int64)
        number = np.zeros(len(words), dtype=np.int64)
        depth = 0
        while len(alive):
            done = sizes[alive] == depth
            ends = alive[done]
            found[ends] = np.where(self.final[state[ends]] == 1, number[ends], -1)
            alive = alive[~done]
            key = state[alive] * 256 + letters[starts[alive] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[at] == key
            alive, at = alive[there], at[there]
            number[alive] += self.skip[at]
            state[alive] = self.to[at]
            depth += 1
        return found

    def entry(self, number: int) -> tuple[int, ...]:
        if number not in self.read:
            self.read[number] = tuple(self.ids[self.starts[number] : self.starts[number + 1]].tolist())
        return self.read[number]


class Encoder:
    """Encodes texts; keeps what chunks between white space gave, the newest and as many before them."""

    def __init__(self, tokenizer: Tokenizer, lexicon: Lexicon):
        self.tokenizer, self.lexicon = tokenizer, lexicon
        self.kept: dict[str | tuple[str], tuple[int, ...]] = {}
        self.older: dict[str | tuple[str], tuple[int, ...]] = {}

    def learn(self, chunks: set[str | tuple[str]]) -> None:
        """Encodes chunks: words in the automaton together, the others by merging."""
        kept, older, find = self.kept, self.older, self.tokenizer.words.findall
        single, several = [], []
        for c in chunks:
            if c in older:
                kept[c] = older[c]
            elif type(c) is tuple:
                several.append(c)
            elif c.isalpha():
                single.append(c)
            else:
                several.append(c)
        split = [c if type(c) is tuple else find(c) for c in several]
        words = list({*single, *chain.from_iterable(split)})
        numbers = self.lexicon.numbers([w.encode() for w in words]).tolist()
        entry, merged = self.lexicon.entry, self.tokenizer.merged
        known = {w: entry(n) if n >= 0 else tuple(merged(w)) for w, n in zip(words, numbers, strict=True)}
        for c in single:
            kept[c] = known[c]
        for c, ws in zip(several, split, strict=True):
            kept[c] = tuple(chain.from_iterable([known[w] for w in ws]))

    def encode_batch(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text, in blocks of about a megabyte."""
        at = 0
        while at < len(texts):
            block, size = [], 0
            while at < len(texts) and size < 1 << 20:
                block.append(self.segments(texts[at]))
                size += len(texts[at])
                at += 1
            chunks = {c for text in block for _, cs in text for c in cs}
            if len(self.kept) + len(chunks) > KEPT:
                self.kept, self.older = {}, self.kept
            self.learn(chunks - self.kept.keys())
            kept = self.kept
            for text in block:
                ids: list[int] = []
                for special, cs in text:
                    if special is not None:
                        ids.append(special)
                    ids.extend(chain.from_iterable([kept[c] for c in cs]))
                yield ids

    def segments(self, text: str) -> list[tuple[int | None, list[str | tuple[str]]]]:
        """(special token before or None, chunks) for each part between special tokens."""
        t = self.tokenizer
        parts = t.parts.split(text) if "<|" in text else [text]
        out = []
        for i in range(0, len(parts), 2):
            if t.is_odd(parts[i]):
                chunks = t.split_by_library(parts[i])
            else:
                normal = t.normal(parts[i])
                chunks = t.words.findall(normal) if ODD_SPACE.search(normal) else normal.split()
            out.append((t.special[parts[i - 1]] if i else None, chunks))
        return out


_encoders: dict[str, Encoder] = {}


def frequent_words(docs: DataFrame, text_col: str, tokenizer, words: int) -> list[str]:
    """The most frequent words of all texts: as many whole classes of frequency as ``words`` has room for.

    A class is a quarter of a doubling, so that no more than ``words`` rows ever come to the driver. Each batch counts all its words and sends those it has seen ``SEEN`` times: a rarer word is worth
    no place in the automaton, and costs only its merging.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer.value
        for b in batches:
            chunks: Counter = Counter()
            for x in b.column(0).to_pylist():
                chunks.update((x or "").lower().split())
            found: Counter = Counter()
            for c, n in chunks.items():
                if n >= SEEN and len(c) <= LONG:
                    for w in t.words.findall(c):
                        found[w] += n
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

    counted = docs.select(text_col).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = staged(counted.withColumn("class", F.floor(F.log2("n") * 4)), "word-counts")
    room, least = words, None
    for r in sorted(counted.groupBy("class").count().collect(), key=lambda r: -r["class"]):
        room -= r["count"]
        if room < 0:
            break
        least = r["class"]
    if least is None:
        return []
    found = counted.where(F.col("class") >= least).collect()
    return [r.word for r in sorted(found, key=lambda r: (-r.n, r.word))]


def mapped_encoder(docs: DataFrame, text_col: str, path: str, words: int):
    """A function that gives, within a task, the encoder over the shipped automaton."""
    context = docs.sparkSession.sparkContext
    tokenizer = context.broadcast(Tokenizer(path))
    frequent = frequent_words(docs, text_col, tokenizer, words) if words else []
    name = f"lexicon-{uuid.uuid4().hex}"
    local = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    write_arrays(compiled({w: tokenizer.value.merged(w) for w in frequent}), local)
    context.addFile(local)

    def get() -> Encoder:
        if name not in _encoders:
            _encoders.clear()
            _encoders[name] = Encoder(tokenizer.value, Lexicon(SparkFiles.get(name)))
        return _encoders[name]

    return get


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS
) -> DataFrame:
    """(doc_id, ids) of every whole text; ``words`` bounds the automaton."""
    get = mapped_encoder(docs, text_col, path, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = get()
        for b in batches:
            texts = [x or "" for x in b.column(1).to_pylist()]
            ids = pa.array(list(encoder.encode_batch(texts)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids decode to the empty text."""
    tokenizer = encoded.sparkSession.sparkContext.broadcast(Tokenizer(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer.value
        for b in batches:
            texts = [t.decode(ids or []) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of what encode and then decode give."""
    get = mapped_encoder(docs, text_col, path, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = get()
        t = encoder.tokenizer
        written = {i: str(i) for i in t.tokens}
        for b in batches:
            counts, first, second = [], [], []
            for ids in encoder.encode_batch([x or "" for x in b.column(1).to_pylist()]):
                counts.append(len(ids))
                first.append(hashlib.sha256(" ".join([written[i] for i in ids]).encode()).hexdigest())
                second.append(hashlib.sha256(t.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
