"""Secrets in texts, told from widely copied examples by who holds them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadpipe.llm import words as W
from leadpipe.operators.relational import same_key
from leadpipe.session import scratch_path

# Kinds in the order of ties: pattern, group that holds the secret, its least length.
KINDS = {
    "assign": (
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        12,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]{14,}"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]{16,}"), 0, 16),
    "jwt": (re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"), 0, 1),
    "github": (re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), 0, 1),
    "key": (re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"), 0, 1),
}
BASE = ("assign", "access", "hex")
# A secret that so many owners hold is a copied example, not a live credential.
EXAMPLE_OWNERS = 3
REDACTED = "[REDACTED]"

FOUND = "array<struct<kind:string,start:int,end:int,from:int,to:int,secret:string>>"
SPANS = pa.list_(
    pa.struct(
        [("kind", pa.string())]
        + [(name, pa.int32()) for name in ("start", "end", "from", "to")]
        + [("secret", pa.string())]
    )
)


def find(text: str) -> list[dict]:
    """Spans in code points, by start and then kind.

    Each kind is matched from left to right without overlaps and then loses
    its short matches.  `start` to `end` is the match, `from` to `to` the
    secret in it, `secret` the SHA-256 of that: secrets travel as hashes only.
    """
    spans = []
    for kind, (pattern, group, least) in KINDS.items():
        for match in pattern.finditer(text):
            held = match.group(group)
            if len(held) >= least:
                digest = hashlib.sha256(held.encode()).hexdigest()
                spans.append((match.start(), match.end(), match.start(group), match.end(group), kind, digest))
    spans.sort(key=lambda s: s[0])  # stable, so kinds stay in order
    return [dict(kind=k, start=a, end=b, to=d, secret=h) | {"from": c} for a, b, c, d, k, h in spans]


def scan(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), into: str = "found") -> DataFrame:
    """The kept columns and the secrets of each whole text; none where it is null."""
    run = lambda texts: [pa.array([find(t) for t in texts.to_pylist()], SPANS)]
    return W.map_texts(docs, run, f"{into} {FOUND}", list(keep), text)


def ownership(found: DataFrame, secret: str, repository: str, owner: str) -> DataFrame:
    """Per secret hash the number of distinct repositories and owners that hold it.

    Counted in three steps of partial aggregation, so that a secret in a third
    of all rows is spread by owner and repository first.  Rows without an owner
    count as one owner of their own, likewise for repositories.
    """
    held = found.select(
        F.col(secret).alias("secret"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
    ).distinct()
    by_owner = held.groupBy("secret", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("secret").agg(
        F.sum("repositories").alias("repositories"), F.count("*").alias("owners")
    )


def is_example(owners: str | Column = "owners", least: int = EXAMPLE_OWNERS) -> Column:
    return (F.col(owners) if isinstance(owners, str) else owners) >= least


def classify(
    docs: DataFrame,
    repository: str = "doc_id",
    owner: str = "source",
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    examples_from: int = EXAMPLE_OWNERS,
    found: str = "found",
    examples: str = "examples",
) -> DataFrame:
    """The kept columns with `found`, the secrets, and `examples`, the hashes of those that
    at least `examples_from` owners hold (a distinct array); all others look live.

    What the scan finds is written once, so texts are read once.  Rows without
    secrets skip the joins; the join by secret moves hashes only, and splits
    hot ones.  Null texts have no secrets, repeated rows stay repeated, an empty
    table gives an empty one, and other columns are left out.
    """
    taken = [*keep, found, examples]
    row, who, where, holder, copies = (
        W.fresh(n, taken) for n in ("_row", "_owner", "_repository", "_holder", "_copies")
    )
    path = scratch_path(docs.sparkSession, "secrets")
    named = docs.withColumns({who: F.col(owner), where: F.col(repository)})
    scanned = scan(named, text, [*keep, who, where], found)
    scanned.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
    scanned = docs.sparkSession.read.parquet(path)
    some = scanned.where(F.size(found) > 0)
    hashes = F.array_distinct(F.col(f"{found}.secret"))
    each = some.select(row, who, where, F.explode(hashes).alias("held"))
    copied = ownership(each, "held", where, who).where(is_example(least=examples_from))
    shared = (
        each.select(F.col(row).alias(holder), "held")
        .join(copied.select("secret"), same_key(F.col("held"), F.col("secret")))
        .groupBy(holder)
        .agg(F.collect_set("secret").alias(copies))
    )
    none = F.array().cast("array<string>")
    with_some = some.join(shared, F.col(row) == F.col(holder), "left").select(
        *keep, found, F.coalesce(copies, none).alias(examples)
    )
    without = scanned.where(F.size(found) == 0).select(*keep, found, none.alias(examples))
    return with_some.unionByName(without)


def live(found: str = "found", examples: str = "examples") -> Column:
    """The spans that are not copied examples."""
    return F.filter(found, lambda s: ~F.array_contains(F.col(examples), s["secret"]))


def redact(
    docs: DataFrame,
    repository: str = "doc_id",
    owner: str = "source",
    text: str = "text",
    examples_from: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """The documents with each live-looking secret replaced; copied examples stay.

    All rows and columns stay, only the text changes.  Overlapping secrets are
    replaced as one.
    """
    found, examples = (W.fresh(n, docs.columns) for n in ("_found", "_examples"))
    known = classify(docs, repository, owner, text, docs.columns, examples_from, found, examples)
    body = F.col(text)
    places = F.transform(live(found, examples), lambda s: F.struct(s["from"].alias("a"), s["to"].alias("b")))
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def replace(state: Column, place: Column) -> Column:
        gap = F.substring(body, state["at"] + 1, F.greatest(place["a"] - state["at"], F.lit(0)))
        mark = F.when(place["a"] >= state["at"], REDACTED).otherwise("")
        return F.struct(
            F.concat(state["done"], gap, mark).alias("done"),
            F.greatest(state["at"], place["b"]).alias("at"),
        )

    def finish(state: Column) -> Column:
        return F.concat(state["done"], F.substring(body, state["at"] + 1, F.length(body)))

    clean = F.aggregate(F.array_sort(places), start, replace, finish)
    cleaned = F.when(F.exists(places, lambda p: F.lit(True)), clean).otherwise(body)
    return known.withColumn(text, cleaned).select(*docs.columns)


def digest(classified: DataFrame) -> DataFrame:
    """Counts and spans per document, base kinds apart."""
    joined = lambda kinds: F.array_join(
        F.transform(
            F.filter("found", lambda s: s["kind"].isin(*kinds)),
            lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]),
        ),
        ",",
    )
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return classified.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(joined(BASE), 256).alias("base_sha256"),
        joined(tuple(KINDS)).alias("spans"),
        F.size(live()).cast("long").alias("n_live"),
    )
