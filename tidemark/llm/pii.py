"""Personal data: fixed forms as seeds, and identifiers that the seeds' contexts lead to.

Every text is searched for emails, IP addresses, card and phone numbers. These seeds, and other
tokens that look like identifiers (a digit among 6 to 64 characters), are mentions; the words before
a mention are its lexical pattern. Patterns and instances form a bipartite graph that Spark scores in
rounds: an instance is as sure as its patterns make it (seeds are sure), a pattern as the mean of its
instances, drawn to zero where there are few. Patterns that end sure and have seeds enough report
their other mentions as the kind of most of their seeds.

Null and empty texts have no spans. Each row of the input gives one row, also when ids repeat or are
null. Positions count code points, the end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, staged

KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"(?<!\S)[^\s0-9]*[0-9]\S*")
DIGITS = re.compile(r"[0-9]")
CONTEXT = 2


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of a local part and a domain, in time linear in the text."""
    end = 0
    for m in DOMAIN.finditer(text):
        before = text[end : m.start()]
        local = len(before) - len(before.rstrip(LOCAL))
        if local:
            yield m.start() - local, m.end()
            end = m.end()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def seeds(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed forms, by kind, then start; matches that fail are dropped."""
    found = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    if not DIGITS.search(text):
        return found
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(DIGITS.findall(m.group())) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def context(text: str, start: int) -> str:
    """The words before a mention, lower case, digits alike: its lexical pattern."""
    words = text[max(0, start - 80) : start].lower().split()[-CONTEXT:]
    return DIGITS.sub("9", " ".join(words))


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, str]]:
    """(kind or -1, start, end, instance, pattern) of seeds and of tokens that look like identifiers."""
    out = [(k, s, e, text[s:e].lower(), context(text, s)) for k, s, e in base]
    spans = sorted((s, e) for _, s, e in base)
    i, reach = 0, 0
    for m in TOKEN.finditer(text):
        token = m.group()
        s = m.start() + len(token) - len(token.lstrip("\"'`([{<=:;,.!?*#%&$|-"))
        e = m.end() - (len(token) - len(token.rstrip("\"'`)]}>=:;,.!?*#%&$|-")))
        while i < len(spans) and spans[i][0] < e:
            reach, i = max(reach, spans[i][1]), i + 1
        if 6 <= e - s <= 64 and reach <= s:
            out.append((-1, s, e, text[s:e].lower(), context(text, s)))
    return out


MENTION = pa.struct(
    [("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("instance", pa.string()), ("pattern", pa.string())]
)


def scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, mentions): one row per input row, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(2).to_pylist():
                found = mentions(text, seeds(text)) if text else []
                rows.append([dict(zip(("kind", "start", "stop", "instance", "pattern"), m, strict=True)) for m in found])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.list_(MENTION))], ["row", "doc_id", "mentions"])

    kind = docs.schema[id_col].dataType.simpleString()
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), F.col(text_col))
    schema = f"row long, doc_id {kind}, mentions array<struct<kind:int,start:long,stop:long,instance:string,pattern:string>>"
    return staged(numbered.mapInArrow(run, schema), "mentions")


def scored_patterns(edges: DataFrame, rounds: int, weight: float) -> DataFrame:
    """(pattern, kind, sure, seeds) after rounds over the graph of edges (pattern, instance, kind).

    The graph has one edge for each pattern and instance, however often they meet; ``weight`` is the
    number of unsure instances that each pattern counts beside its own.
    """
    graph = cut(edges.groupBy("pattern", "instance").agg(F.max("kind").alias("kind")))
    seeded = graph.select("pattern", "instance", (F.col("kind") >= 0).cast("double").alias("sure"))
    patterns = None
    for _ in range(rounds):
        patterns = cut(seeded.groupBy("pattern").agg((F.sum("sure") / (F.count("*") + weight)).alias("sure")))
        doubt = F.sum(F.log1p(-F.least(F.col("sure"), F.lit(0.999999))))
        instances = graph.join(patterns, "pattern").groupBy("instance").agg(
            F.max("kind").alias("best"), (1 - F.exp(doubt)).alias("drawn")
        )
        belief = instances.select("instance", F.when(F.col("best") >= 0, 1.0).otherwise(F.col("drawn")).alias("sure"))
        seeded = graph.select("pattern", "instance").join(belief, "instance")
    seeds_by_kind = graph.where("kind >= 0").groupBy("pattern", "kind").agg(F.count("*").alias("n"))
    led = seeds_by_kind.groupBy("pattern").agg(
        F.sum("n").alias("seeds"), F.max_by("kind", F.struct("n", -F.col("kind"))).alias("kind")
    )
    return patterns.join(led, "pattern")


def personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 3,
    weight: float = 1.0,
    sure: float = 0.7,
    least_seeds: int = 3,
) -> DataFrame:
    """(doc_id, base, found): arrays of (kind, start, stop), those of fixed form and those that patterns add."""
    rows = scanned(docs, id_col, text_col)
    edges = rows.select("row", F.inline("mentions"))
    patterns = scored_patterns(edges.select("pattern", "instance", "kind").where("pattern <> ''"), rounds, weight)
    good = patterns.where((F.col("sure") >= sure) & (F.col("seeds") >= least_seeds)).select("pattern", F.col("kind").alias("led"))
    added = edges.where("kind < 0").select("row", "pattern", "start", "stop").join(good, "pattern")
    by_row = added.groupBy("row").agg(F.collect_list(F.struct(F.col("led").alias("kind"), "start", "stop")).alias("found"))
    base = F.transform(
        F.filter("mentions", lambda m: m["kind"] >= 0),
        lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["stop"].alias("stop")),
    )
    none = F.array().cast("array<struct<kind:int,start:long,stop:long>>")
    return rows.join(by_row, "row", "left").select(
        "doc_id", F.array_sort(base).alias("base"), F.array_sort(F.coalesce("found", none)).alias("found")
    )


def written(spans, names=KINDS):
    """kind:start:end, comma-joined."""
    name = F.array(*map(F.lit, names))
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")))
    )


def personal_data_query(docs: DataFrame) -> DataFrame:
    found = personal_data(docs)

    def count(kind: int, name: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{name}")

    counts = [count(k, name) for k, name in enumerate(KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", "found"))).alias("spans"),
        F.size("found").cast("long").alias("n_found"),
    )
