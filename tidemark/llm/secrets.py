"""Secrets and the weak parts of credentials, with DataFrame functions only.

Strong kinds (assign, access, hex) stand by themselves. Parts of a credential that are weak alone (a
short or unmarked secret, a user name, an endpoint) are reported when their complements are within
the same scope: an interval join of parts, dealt by row and by position in steps of the scope, so that
a task sees a stretch of a text, not a whole document, and only whether a complement is there is kept.

Null and empty texts have no spans. Each row of the input gives one row, also when ids repeat or are
null. Positions count code points, the end exclusive; letters are ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

#: Patterns of the strong kinds, and of the parts that need a complement.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
USER = r"""(?i:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{2,}"""
ENDPOINT = r"""(?i:https?|ftp|s3|jdbc|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9_.:/-]+"""
LOOSE = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "weak", "user", "endpoint")
SCOPE = 200


def shorter_than(match: Column, least: int) -> Column:
    return F.length(F.regexp_extract(match, ASSIGN, 1)) < least


def mixed_case(match: Column) -> Column:
    return match.rlike("[a-z]") & match.rlike("[A-Z]") & match.rlike("[0-9]")


def kind_of(found: str, match: Column) -> Column:
    """The number of the kind in KINDS, null for a match that is nothing."""
    if found == "assign":
        return F.when(shorter_than(match, 3), None).when(shorter_than(match, 6), 3).otherwise(0)
    if found == "loose":
        return F.when(mixed_case(match), 3)
    return F.lit(KINDS.index(found))


PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "user": USER, "endpoint": ENDPOINT, "loose": LOOSE}


def located(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """All rows (row, doc_id, text_key), and the matches in them (row, kind, start, stop).

    The text between matches gives their places: a match starts where all matches and gaps before it
    end. The scan is written once; what follows reads matches only.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), text.alias("text"))
    # cheap tests of what any match must contain spare most texts the searches
    lower = F.lower("text")
    possible = {
        "assign": F.lit(True), "access": F.contains("text", F.lit("AKIA")), "hex": F.lit(True),
        "user": F.contains(lower, F.lit("user")) | F.contains(lower, F.lit("login")) | F.contains(lower, F.lit("account")) | F.contains(lower, F.lit("client")),
        "endpoint": F.contains("text", F.lit("://")), "loose": F.lit(True),
    }
    matched = rows.select(
        "row", "doc_id", "text",
        *[F.when(possible[n], F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias(n) for n, p in PATTERNS.items()],
    )

    def pieces(name: str, pattern: str) -> Column:
        gaps = F.split("text", pattern, -1)
        kept = F.zip_with(
            F.slice(gaps, 1, F.size(name)), F.col(name),
            lambda gap, match: F.struct(F.length(gap).cast("long").alias("gap"), F.length(match).cast("long").alias("size"), kind_of(name, match).alias("kind")),
        )
        return F.when(F.size(name) > 0, kept).alias(name)

    scan = matched.select("row", "doc_id", F.xxhash64("text").alias("text_key"), *[pieces(n, p) for n, p in PATTERNS.items()])
    scan = staged(scan, "secrets")
    each = None
    for name in PATTERNS:
        some = scan.where(F.col(name).isNotNull()).select("row", F.lit(name).alias("pattern"), F.posexplode(name).alias("i", "piece"))
        each = some if each is None else each.unionByName(some)
    before = Window.partitionBy("row", "pattern").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("piece.gap") + F.col("piece.size")).over(before)
    found = each.select("row", F.col("piece.kind").alias("kind"), (stop - F.col("piece.size")).alias("start"), stop.alias("stop"))
    return scan.select("row", "doc_id", "text_key"), staged(found.where("kind is not null"), "secret-parts")


def covered(parts: DataFrame, before: int, after: int) -> DataFrame:
    """A row for each step of the scope that a part, widened on both sides, reaches."""
    steps = F.sequence(F.floor((F.col("start") - before) / SCOPE), F.floor((F.col("stop") + after) / SCOPE))
    return parts.withColumn("step", F.explode(steps))


def with_complement(parts: DataFrame, others: DataFrame, scope: int) -> DataFrame:
    """The parts from which another is at most ``scope`` away."""
    near = covered(others.select("row", F.col("start").alias("o_start"), F.col("stop").alias("o_stop"), "start", "stop"), scope, scope)
    near = near.select(F.col("row").alias("o_row"), F.col("step").alias("o_step"), "o_start", "o_stop")
    here = covered(parts, 0, 0)
    met = here.join(
        near,
        (here["row"] == near["o_row"]) & (here["step"] == near["o_step"])
        & (here["start"] - near["o_stop"] <= scope) & (near["o_start"] - here["stop"] <= scope),
        "left_semi",
    )
    return met.select(parts.columns).distinct()


def credentials(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> tuple[DataFrame, DataFrame]:
    """All rows (row, doc_id, text_key), and the spans reported in them (row, kind, start, stop).

    A weak secret needs an access identifier (access or user) in its scope; a user name needs a secret
    and an endpoint; an endpoint needs a secret and an access identifier. A weak secret that overlaps
    a strong span says nothing new and is dropped.
    """
    rows, parts = located(docs, id_col, text_col)
    strong = parts.where("kind <= 2")
    weak = parts.where("kind = 3").distinct()
    inner = weak.select("row", "kind", (F.col("start") + 1).alias("start"), (F.col("stop") - 1).alias("stop"))
    overlapping = with_complement(inner, strong, 0).select("row", (F.col("start") - 1).alias("start"), (F.col("stop") + 1).alias("stop"))
    weak = weak.join(overlapping, ["row", "start", "stop"], "left_anti").select("row", "kind", "start", "stop")
    users, endpoints = parts.where("kind = 4"), parts.where("kind = 5")
    identifiers = parts.where("kind in (1, 4)")
    secrets = parts.where("kind in (0, 2)").unionByName(weak)
    reported = strong.unionByName(with_complement(weak, identifiers, scope))
    reported = reported.unionByName(with_complement(with_complement(users, secrets, scope), endpoints, scope))
    reported = reported.unionByName(with_complement(with_complement(endpoints, secrets, scope), identifiers, scope))
    return rows, staged(reported, "secret-spans")


def secrets_query(docs: DataFrame) -> DataFrame:
    rows, spans = credentials(docs)
    by_row = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "stop"))).alias("all"))
    names = F.array(*map(F.lit, KINDS))

    def written(of: Column) -> Column:
        return F.concat_ws(",", F.transform(of, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))))

    def count(kind: int) -> Column:
        return F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    none = F.array().cast("array<struct<start:bigint,kind:int,stop:bigint>>")
    found = rows.join(by_row, "row", "left").select("doc_id", F.coalesce("all", none).alias("all"))
    return found.select(
        "doc_id",
        *[count(k) for k in range(3)],
        F.sha2(written(F.filter("all", lambda s: s["kind"] <= 2)), 256).alias("base_sha256"),
        written(F.col("all")).alias("spans"),
        F.size(F.filter("all", lambda s: s["kind"] > 2)).cast("long").alias("n_linked"),
    )


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The rows with every reported span of the text replaced, endpoints too, as they may hold a user and
    password; the other columns as they are. What an endpoint's span does not reach, such as the rest of
    a password with other characters, stays.
    """
    rows, spans = credentials(docs, id_col, text_col)
    order = Window.partitionBy("row").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.select("row", "start", "stop", F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1)).alias("opens"))
    merged = opened.select("row", "start", "stop", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    merged = merged.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    by_row = merged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("__spans"))
    # rows with equal id and text have equal spans: one of them speaks for all
    by_text = by_row.join(rows, "row").groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.first("__spans").alias("__spans"))
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    joined = docs.withColumn("__text_key", key).join(by_text, (F.col(id_col).eqNullSafe(F.col("__id"))) & (F.col("__text_key") == F.col("__key")), "left")
    text = F.col(text_col)
    pieces = F.transform(
        "__spans",
        lambda s, i: F.concat(
            F.substr(text, F.when(i > 0, F.get("__spans", i - 1)["stop"]).otherwise(0).cast("int") + 1, (s["start"] - F.when(i > 0, F.get("__spans", i - 1)["stop"]).otherwise(0)).cast("int")),
            F.lit(mask),
        ),
    )
    rest = F.substr(text, F.element_at("__spans", -1)["stop"].cast("int") + 1)
    masked = F.when(F.col("__spans").isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return joined.select([masked.alias(c) if c == text_col else F.col(c) for c in docs.columns])
