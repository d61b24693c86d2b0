"""Which tokens of two tokenizers stand for the same bytes, with corpus-wide counts of linked ids.

Arrow does the work of a batch in whole columns. Texts are cut where neither tokenizer joins (before a
space that follows a letter or sign); distinct cuts are encoded once, a worker keeping those it
used last, and taken back by their numbers as lists, whose flattened tokens know their document by parent index.
Cumulative sums of token sizes give each token's end; marks at the ends of one side, looked up by the
other, find the ends they share, which number the groups; a hash join on the group gives the links, and
``Table.group_by`` makes them one row for each document and id pair, then partial counts for each pair.

Spark adds the partial counts up over all chunks (about ``CHUNK`` bytes of text each), joins the
totals to the pairs that a chunk holds, and gives each chunk its own back, which are few against its tokens.
Nothing of the corpus's pairs goes to the driver or is broadcast by force.

Texts that are null, empty, or not given back byte by byte by both tokenizers have no tokens. Rows with
equal or null ids are counted as documents of their own and give a row each. A long document is worked off
in parts of ``PART`` letters; only its distinct pairs are held together.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.bpe import byte_letters
from tidemark.llm.common import staged
from tidemark.llm.pieces import SPACE, Model

CHUNK = 2 << 20
#: letters that are joined at once, and that go to the library at once
PART = 1 << 20
BLOCK = 1 << 16
SPACE_BEFORE = re.compile(r"\s ")
#: links of a group are made of distinct ids with their numbers beyond so many
WIDE = 256
#: bytes of the distinct cuts that a worker keeps encoded, with their ids; and letters of the longest
KEPT, KEPT_LETTERS = 16 << 20, 64


def byte_level_entries(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as f:
        vocabulary: dict[str, int] = json.load(f)["model"]["vocab"]
    byte = {c: b for b, c in enumerate(byte_letters())}
    entries = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        entries[i] = bytes([byte[c] for c in entry]) if all(c in byte for c in entry) else b""
    return entries


def piece_entries(model: Model) -> list[bytes]:
    """The bytes of each piece: a space for its mark, a byte for a byte piece."""
    return [bytes([s]) if isinstance(s, int) else p.replace(SPACE, " ").encode() for p, s in zip(model.pieces, model.surfaces, strict=True)]


class Cuts(NamedTuple):
    """Distinct cuts, the ids of each on both sides, whether both give its bytes back, and when it was last used."""

    words: pa.Array
    a: pa.ListArray
    b: pa.ListArray
    same: np.ndarray
    used: np.ndarray

    def and_more(self, more: Cuts) -> Cuts:
        return Cuts(
            *(pa.concat_arrays([x, y]) for x, y in zip(self[:3], more[:3], strict=True)),
            *(np.concatenate([x, y]) for x, y in zip(self[3:], more[3:], strict=True)),
        )

    def kept(self) -> Cuts:
        """The short cuts; should they have more than ``KEPT`` bytes, those of them used last, in half of that."""
        stay = pc.less_equal(pc.utf8_length(self.words), KEPT_LETTERS).to_numpy(zero_copy_only=False)
        sizes = 16 + pc.binary_length(self.words).to_numpy() + 4 * sum(np.diff(x.offsets.to_numpy()) for x in (self.a, self.b))
        if sizes[stay].sum() > KEPT:
            short = np.flatnonzero(stay)
            newest = short[np.argsort(-self.used[short], kind="stable")]
            stay[newest[np.cumsum(sizes[newest]) > KEPT // 2]] = False
        if stay.all():
            return self
        at = np.flatnonzero(stay)
        return Cuts(*(x.take(pa.array(at)) for x in self[:3]), self.same[at], self.used[at])


class Pair:
    """Both tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as f:
            self.file_a = f.read()
        self.model = Model(path_b)
        self.digest = hashlib.sha256((self.file_a + self.model.digest).encode()).hexdigest()
        entries = byte_level_entries(path_a), piece_entries(self.model)
        self.entries = [pa.array(e, pa.binary()) for e in entries]
        self.sizes = [np.array([len(x) for x in e], dtype=np.int64) for e in entries]
        self.written = [pa.array([str(i) for i in range(len(e))], pa.string()) for e in entries]
        self.ready()

    def ready(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        self.library = Tokenizer.from_str(self.file_a)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        ids = pa.array([], pa.list_(pa.int32()))
        self.known = Cuts(pa.array([], pa.string()), ids, ids, np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64))
        self.parts = 0

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("library", "known", "parts")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.ready()

    @staticmethod
    def cuts(text: str) -> list[str]:
        """A space and the text, cut before each space that follows something else than white space."""
        parts = text.split(" ")
        if text[0] != " " and not SPACE_BEFORE.search(text):
            return [" " + p for p in parts]
        out: list[str] = []
        glue = False
        for p in parts:
            if glue:
                out[-1] += " " + p
            else:
                out.append(" " + p)
            glue = not p or p[-1].isspace()
        return out

    def looked_up(self, words: pa.Array) -> tuple[Cuts, np.ndarray]:
        """Encoded cuts, and the place among them of each of these, which are distinct; only new ones are encoded."""
        self.parts += 1
        found = pc.index_in(words, value_set=self.known.words)
        new = words.filter(found.is_null())
        place = found.fill_null(-1).to_numpy().astype(np.int64)
        place[place < 0] = len(self.known.words) + np.arange(len(new))
        cuts = self.known
        if len(new):
            (a, b), same = self.encoded(new)
            cuts = cuts.and_more(Cuts(new, a, b, same, np.zeros(len(new), dtype=np.int64)))
        cuts.used[place] = self.parts
        self.known = cuts.kept()
        return cuts, place

    def encoded(self, words: pa.Array) -> tuple[list[pa.ListArray], np.ndarray]:
        """The ids of distinct cuts on both sides, and whether both give the cut's bytes back."""
        own = words.to_pylist()
        ids, cuts = self.model.encode_flat([w[1:].replace(" ", SPACE) for w in own])
        second = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int32)))
        sides = [self.first_side(own, pc.binary_length(words).to_numpy()), second]
        whole, same = words.cast(pa.binary()), np.ones(len(words), dtype=bool)
        for lists, entries in zip(sides, self.entries, strict=True):
            joined = pc.binary_join(pa.ListArray.from_arrays(lists.offsets, entries.take(lists.values)), b"")
            same &= pc.equal(joined, whole).to_numpy(zero_copy_only=False)
        return sides, same

    def first_side(self, words: list[str], sizes: np.ndarray) -> pa.ListArray:
        """The first tokenizer's ids of words.

        Words go to it many at a time as one text, as it joins no two of them; those that end in white space, which
        it might, by themselves. The sizes of tokens say where words end; should they not add up, a
        tokenizer does not keep all bytes, and words go one by one.
        """
        apart = [w[-1].isspace() for w in words]
        order = np.argsort(np.array([not x for x in apart], dtype=bool), kind="stable")
        odd = sum(apart)
        texts, held, size = [words[n] for n in order[:odd].tolist()], [], 0
        for n in order[odd:].tolist():
            held.append(words[n])
            size += len(words[n])
            if size > BLOCK:
                texts.append("".join(held))
                held, size = [], 0
        texts.append("".join(held))
        ids = np.array([i for e in self.library.encode_batch_fast(texts, add_special_tokens=False) for i in e.ids], dtype=np.int32)
        ends = np.concatenate([[0], np.cumsum(self.sizes[0][ids])])
        stops = np.concatenate([[0], np.cumsum(sizes[order])])
        cuts = np.minimum(np.searchsorted(ends, stops), len(ids))
        if ends[-1] != stops[-1] or (ends[cuts] != stops).any():
            each = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
            return pa.array(each, pa.list_(pa.int32()))
        lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids))
        if not odd:
            return lists
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        return lists.take(pa.array(place))

    def comes_back(self, text: str) -> bool:
        """Whether both tokenizers give the text's bytes back."""
        return all(self.encoded(pa.array(words, pa.string()))[1].all() for words, _ in sliced(self.cuts(text), len(text)))


_pairs: dict[str, Pair] = {}


def worker_pair(pair: Pair) -> Pair:
    """The pair that a Python worker keeps between tasks."""
    return _pairs.setdefault(pair.digest, pair)


def sliced(cuts: list[str], size: int) -> Iterator[tuple[list[str], int]]:
    """(cuts, letters) of a document of so many letters in parts of about ``PART`` letters."""
    if size <= PART:
        yield cuts, size
        return
    first = size = 0
    for n, cut in enumerate(cuts):
        size += len(cut)
        if size >= PART:
            yield cuts[first : n + 1], size
            first, size = n + 1, 0
    if first < len(cuts):
        yield cuts[first:], size


def parts_of(pair: Pair, texts: list[str | None]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(cuts, document of each) of texts in their order, in parts of about ``PART`` letters."""
    words: list[str] = []
    docs: list[int] = []
    counts: list[int] = []
    held = 0
    for n, text in enumerate(texts):
        if not text:
            continue
        for some, size in sliced(pair.cuts(text), len(text)):
            if words and held + size > PART:
                yield pa.array(words, pa.string()), np.repeat(np.array(docs), counts)
                words, docs, counts, held = [], [], [], 0
            words += some
            docs.append(n)
            counts.append(len(some))
            held += size
    if words:
        yield pa.array(words, pa.string()), np.repeat(np.array(docs), counts)


class Side:
    """The tokens of one tokenizer: ids, document of each, and its end, after all documents before."""

    def __init__(self, lists: pa.ListArray, take: np.ndarray, docs: np.ndarray, sizes: np.ndarray):
        lists = lists.take(pa.array(take))
        self.ids = lists.flatten()
        self.doc = docs[pc.list_parent_indices(lists).to_numpy()]
        #: documents have the same bytes on both sides; their numbers keep a token without bytes off the document before
        self.end = np.cumsum(sizes[self.ids.to_numpy()]) + self.doc

    def marks(self) -> np.ndarray:
        """Whether a token ends at each place."""
        marks = np.zeros(self.end[-1] + 1 if len(self.end) else 0, dtype=bool)
        marks[self.end] = True
        return marks

    def grouped(self, other: np.ndarray) -> None:
        """Numbers the groups: one ends with each token whose end the other side has as well."""
        last = other[self.end].astype(np.int64)
        self.group = np.cumsum(last) - last
        self.stops = np.flatnonzero(last) + 1


def linked(a: Side, b: Side, groups: int) -> pa.Table:
    """(group, a, b, n): the id pairs linked within each group, with how often."""
    counts = [np.bincount(s.group, minlength=groups) for s in (a, b)]
    wide = counts[0] * counts[1] > WIDE
    found = []
    for some in (~wide, wide):
        if not some.any():
            continue
        tables = []
        for side, name in ((a, "a"), (b, "b")):
            chosen = some[side.group]
            rows = pa.table({"group": side.group[chosen], name: side.ids.to_numpy()[chosen]})
            if some is wide:
                rows = rows.group_by(["group", name], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", name, f"n_{name}"])
            tables.append(rows)
        both = tables[0].join(tables[1], "group", join_type="inner", use_threads=False)
        n = pc.multiply(both["n_a"], both["n_b"]) if some is wide else pa.array(np.ones(len(both), dtype=np.int64))
        found.append(both.select(["group", "a", "b"]).append_column("n", n))
    return pa.concat_tables(found) if found else pa.table({"group": pa.array([], pa.int64()), "a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})


class Part:
    """The alignment of a part: both sides' tokens, their groups, and the document of each group."""

    def __init__(self, pair: Pair, words: pa.Array, docs: np.ndarray):
        self.pair = pair
        numbered = words.dictionary_encode()
        cuts, place = pair.looked_up(numbered.dictionary)
        codes = place[numbered.indices.to_numpy()]
        #: documents that do not come back byte by byte
        self.lost = np.unique(docs[~cuts.same[codes]])
        if len(self.lost):
            fits = ~np.isin(docs, self.lost)
            codes, docs = codes[fits], docs[fits]
        self.a, self.b = (Side(lists, codes, docs, sizes) for lists, sizes in zip((cuts.a, cuts.b), pair.sizes, strict=True))
        marks = self.a.marks(), self.b.marks()
        self.a.grouped(marks[1])
        self.b.grouped(marks[0])
        self.group_doc = self.a.doc[self.a.stops - 1]

    def links(self) -> pa.Table:
        """(doc, a, b, n) of all links."""
        found = linked(self.a, self.b, len(self.group_doc))
        doc = pa.array(self.group_doc[found["group"].to_numpy()])
        return found.select(["a", "b", "n"]).append_column("doc", doc).group_by(["doc", "a", "b"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["doc", "a", "b", "n"])

    def groups_text(self) -> Iterator[tuple[int, str, int]]:
        """(document, its groups written out, their number)."""
        sides = []
        for side, written in zip((self.a, self.b), self.pair.written, strict=True):
            offsets = pa.array(np.concatenate([[0], side.stops]).astype(np.int32))
            sides.append(pc.binary_join(pa.ListArray.from_arrays(offsets, written.take(side.ids)), ","))
        each = pc.binary_join_element_wise(*sides, "|")
        first = np.flatnonzero(np.concatenate([[True], self.group_doc[1:] != self.group_doc[:-1]])) if len(self.group_doc) else np.zeros(0, np.int64)
        stops = np.append(first[1:], len(self.group_doc)) if len(first) else first
        offsets = pa.array(np.concatenate([[0], stops]).astype(np.int32))
        texts = pc.binary_join(pa.ListArray.from_arrays(offsets, each), ";")
        for doc, text, n in zip(self.group_doc[first].tolist(), texts, (stops - first).tolist(), strict=True):
            yield doc, text.as_py(), n


def no_links() -> pa.Table:
    return pa.table({"doc": pa.array([], pa.int64()), "a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})


def chunk_rows(pair: Pair, texts: list[str | None]) -> tuple[dict[str, np.ndarray | list], pa.Table]:
    """The columns of each document of a chunk, and (doc, a, b, n) of its links."""
    size = len(texts)
    sums = {k: np.zeros(size, dtype=np.int64) for k in ("n_a", "n_b", "n_groups")}
    digests: list = [None] * size
    lost: set[int] = set()
    several: set[int] = set()
    tables = []
    for words, docs in parts_of(pair, texts):
        part = Part(pair, words, docs)
        lost.update(part.lost.tolist())
        sums["n_a"] += np.bincount(part.a.doc, minlength=size)
        sums["n_b"] += np.bincount(part.b.doc, minlength=size)
        for doc, text, n in part.groups_text():
            if digests[doc] is None:
                digests[doc] = hashlib.sha256()
            else:
                several.add(doc)
                digests[doc].update(b";")
            digests[doc].update(text.encode())
            sums["n_groups"][doc] += n
        tables.append(part.links())
    links = pa.concat_tables(tables) if tables else no_links()
    if several:  # documents of several parts
        split = pa.array(np.isin(links["doc"].to_numpy(), sorted(several)))
        again = links.filter(split).group_by(["doc", "a", "b"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["doc", "a", "b", "n"])
        links = pa.concat_tables([links.filter(pc.invert(split)), again])
    if lost:  # a later part of a long document may be the one that does not come back
        gone = np.array(sorted(lost))
        for column in sums.values():
            column[gone] = 0
        links = links.filter(pa.array(~np.isin(links["doc"].to_numpy(), gone)))
    sha = [d.hexdigest() if d is not None and n not in lost else "" for n, d in enumerate(digests)]
    return sums | {"groups_sha256": sha}, links


def chunks_of(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """(first, end) of neighbouring texts of about ``CHUNK`` letters together."""
    first = size = 0
    for n, text in enumerate(texts):
        if size and size + len(text or "") > CHUNK:
            yield first, n
            first, size = n, 0
        size += len(text or "")
    if len(texts) > first:
        yield first, len(texts)


COUNTED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
CHUNKED = f"chunk long, doc_id {{id}}, {COUNTED}, pair array<int>, times array<long>, a array<int>, b array<int>, docs array<long>"
LISTS = (pa.list_(pa.int32()), pa.list_(pa.int64()))


def chunked(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """A row for each document, its links as places in the chunk's pairs; and a row for each chunk's pairs
    (a, b, docs: the partial counts), on which the document's columns are null."""
    shared = docs.sparkSession.sparkContext.broadcast(Pair(path_a, path_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = worker_pair(shared.value)
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, end in chunks_of(texts):
                columns, links = chunk_rows(pair, texts[first:end])
                size = end - first
                links = links.sort_by("doc")
                key = (links["a"].to_numpy().astype(np.int64) << 32) | links["b"].to_numpy()
                numbered = pa.array(key).dictionary_encode()
                partial = pa.table({"pair": numbered.indices}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
                known = numbered.dictionary.to_numpy()
                bounds = np.searchsorted(links["doc"].to_numpy(), np.arange(size + 1))
                totals = np.concatenate([[0], np.cumsum(links["n"].to_numpy())])[bounds]
                offsets = pa.array(bounds.astype(np.int32))
                own = [
                    pa.array(np.full(size, chunk)),
                    batch.column(0).slice(first, size),
                    *(pa.array(columns[k]) for k in ("n_a", "n_b", "n_groups")),
                    pa.array(np.diff(totals)),
                    pa.array(columns["groups_sha256"], pa.string()),
                    pa.ListArray.from_arrays(offsets, numbered.indices),
                    pa.ListArray.from_arrays(offsets, pa.array(links["n"].to_numpy())),
                ]
                yield pa.RecordBatch.from_arrays([*own, *(pa.nulls(size, k) for k in (LISTS[0], LISTS[0], LISTS[1]))], names)
                if len(known):
                    pairs = ((known >> 32).astype(np.int32), (known & 0xFFFFFFFF).astype(np.int32), partial["count_all"].to_numpy())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk]), *(pa.nulls(1, x.type) for x in own[1:]), *(pa.array([x], k) for x, k in zip(pairs, (LISTS[0], LISTS[0], LISTS[1]), strict=True))],
                        names,
                    )
                chunk += 1

    schema = CHUNKED.format(id=docs.schema[id_col].dataType.simpleString())
    names = [part.split()[0] for part in schema.split(", ")]
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def chunk_pairs(chunks: DataFrame) -> DataFrame:
    """(chunk, place, a, b, docs): the pairs that each chunk holds, with its partial counts."""
    each = chunks.where("a is not null").select("chunk", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("place", "pair"))
    return each.select("chunk", "place", "pair.a", "pair.b", "pair.docs")


def totals(pairs: DataFrame) -> DataFrame:
    """(a, b, n, best): in how many documents each pair is linked, and whether that is the most for its a."""
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def pair_counts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, n, best): the linked ids of the corpus and the number of documents that hold each pair linked."""
    return totals(chunk_pairs(staged(chunked(docs, path_a, path_b, id_col, text_col), "aligned-chunks")))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, part, a, b, a_group, b_group): the ids of each document and the group of each, numbered
    within the part; a document of more than ``PART`` letters has several parts, one without tokens none."""
    shared = docs.sparkSession.sparkContext.broadcast(Pair(path_a, path_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = worker_pair(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lost = {n for n, text in enumerate(texts) if text and not pair.comes_back(text)}
            number: dict[int, int] = {}
            for words, docs in parts_of(pair, [None if n in lost else t for n, t in enumerate(texts)]):
                part = Part(pair, words, docs)
                present = np.unique(part.group_doc)
                groups = np.searchsorted(part.group_doc, present)
                columns = [batch.column(0).take(pa.array(present)), pa.array([number.get(n, 0) for n in present.tolist()], pa.int32())]
                for ids in (True, False):
                    for side in (part.a, part.b):
                        bounds = pa.array(np.append(np.searchsorted(side.doc, present), len(side.doc)).astype(np.int32))
                        own = side.ids if ids else pa.array((side.group - groups[np.searchsorted(present, side.doc)]).astype(np.int32))
                        columns.append(pa.ListArray.from_arrays(bounds, own))
                number |= {n: number.get(n, 0) + 1 for n in present.tolist()}
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "a", "b", "a_group", "b_group"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        run, f"doc_id {kind}, part int, a array<int>, b array<int>, a_group array<int>, b_group array<int>"
    )


def alignment_digests(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    chunks = staged(chunked(docs, path_a, path_b, id_col, text_col), "aligned-chunks")
    pairs = chunk_pairs(chunks)
    counts = staged(totals(pairs), "pair-counts")
    known = pairs.join(counts, ["a", "b"]).select(F.col("chunk").alias("of"), "place", "n", "best")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    rows = chunks.where("n_a is not null").select("chunk", *columns, "pair", "times")

    def summed(own: pa.Table, known: pa.Table) -> pa.Table:
        n, best = np.zeros(len(known), dtype=np.int64), np.zeros(len(known), dtype=np.int64)
        place = known["place"].to_numpy()
        n[place], best[place] = known["n"].to_numpy(), known["best"].to_numpy()
        pair, times = own["pair"].combine_chunks(), own["times"].combine_chunks()
        at, often = pair.flatten().to_numpy(), times.flatten().to_numpy()
        stops = np.concatenate([[0], np.cumsum(pc.list_value_length(pair).to_numpy())])
        out = own.select(columns)
        for name, values in (("n_best", best), ("count_sum", n)):
            running = np.concatenate([[0], np.cumsum(often * values[at])])
            out = out.append_column(name, pa.array(running[stops[1:]] - running[stops[:-1]]))
        return out

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return rows.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(summed, schema)
