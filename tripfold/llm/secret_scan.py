"""Secrets in texts, told apart by who holds them.

Fixed patterns give the base spans.  Every candidate value, those of the base spans and
other random-looking tokens, is then counted over the whole corpus by distinct
repositories and owners: a value that several owners hold, or that stands in many different
texts of one, is a copied example; a random-looking one that one owner holds in few texts is
a live credential, however often these texts are copied."""

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm import frames

KINDS = ("assign", "access", "hex", "live")
ASSIGN, ACCESS, HEX, LIVE = range(4)

#: The patterns of the base spans.
ASSIGNED = re.compile(r"(?ai:passw|secret|token|api_?key)")
ASSIGNMENT = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS_KEY = re.compile(r"AKIA[A-Z0-9]+")
HEX_RUN = re.compile(r"[0-9a-f]{24,}")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+")

MIN_ENTROPY = 3.6  # bits a character
MIN_HEX_ENTROPY = 2.8  # of at most four
HEX_DIGITS = frozenset("0123456789abcdef")
MAX_OWNERS = 1
MAX_REPOSITORIES = 20

FOUND = "array<struct<start:int,kind:int,end:int,value:string,live:boolean>>"


def entropy(value: str) -> float:
    counts, size = Counter(value).values(), len(value)
    return -sum(n / size * math.log2(n / size) for n in counts)


def looks_live(value: str) -> bool:
    """Random enough, of mixed classes, and no word sequence."""
    digits = sum(map(str.isdigit, value))
    letters = sum(map(str.isalpha, value))
    least = MIN_HEX_ENTROPY if HEX_DIGITS.issuperset(value) else MIN_ENTROPY
    return digits >= 3 and letters >= 3 and len(value) >= 12 and entropy(value) >= least


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the fixed patterns, in code points, by start and kind."""
    spans = []
    if ASSIGNED.search(text):
        for match in ASSIGNMENT.finditer(text):
            if len(match[1]) >= 6:
                spans.append((match.start(), ASSIGN, match.end(), match[1]))
    if "AKIA" in text:
        for match in ACCESS_KEY.finditer(text):
            if match.end() - match.start() >= 20:
                spans.append((match.start(), ACCESS, match.end(), match[0]))
    for match in HEX_RUN.finditer(text):
        spans.append((match.start(), HEX, match.end(), match[0]))
    return sorted(spans)


def candidates(text: str) -> list[dict]:
    """Base spans, and random-looking tokens that overlap none of them."""
    base = base_spans(text)
    found = [
        {"start": s, "kind": kind, "end": e, "value": value, "live": looks_live(value)}
        for s, kind, e, value in base
    ]
    taken = [(s, e) for s, _, e, _ in base]
    at, reach = 0, 0
    for match in RANDOM.finditer(text):
        while at < len(taken) and taken[at][0] < match.end():
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= match.start() and looks_live(match[0]):
            start, end, value = match.start(), match.end(), match[0]
            found.append({"start": start, "kind": LIVE, "end": end, "value": value, "live": True})
    for one in found:
        one["value"] = hashlib.sha256(one["value"].encode()).hexdigest()
    return found


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str | None = None,
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row per input row: doc_id and spans.

    ``spans`` is an array of (start, end, kind, value hash, owners, repositories, verdict)
    by start and kind; offsets are code points, the end is exclusive.  The kinds assign,
    access and hex are always kept; a span of kind live is kept only for a value that one
    owner holds, or at most ``max_owners`` owners and ``max_repositories`` repositories.  The
    verdict of any span is "live" for such a value that looks random, "example" for one that
    more hold, else "plain".  No value leaves the scan, only its hash.

    A null text counts as empty and has no span.  A null owner or repository counts as one
    owner or repository of its own.  Null identifiers and repeated rows are kept as they
    are, an empty table gives an empty result, and extra columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct(
            [
                ("start", pa.int32()),
                ("kind", pa.int32()),
                ("end", pa.int32()),
                ("value", pa.string()),
                ("live", pa.bool_()),
            ]
        )
        for batch in frames.slices(batches):
            found = [candidates(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.list_(kind))],
                [*batch.schema.names[:-1], "found"],
            )

    given = {"repository": repository_col} if repository_col else {}
    rows = frames.texts(docs, id_col, text_col, owner=owner_col, **given)
    repository = F.col("repository") if repository_col else F.xxhash64("text")
    rows = rows.select(
        "doc_id",
        F.col("owner").cast("string").alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        "text",
    ).withColumn("owner", F.coalesce("owner", F.concat(F.lit("\0"), "repository")))
    rows = rows.select("doc_id", "owner", "repository", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    scanned = rows.mapInArrow(
        run, f"doc_id {kind}, owner string, repository string, found {FOUND}"
    ).withColumn("row", F.monotonically_increasing_id())
    scanned = frames.staged(scanned, "secrets")

    each = scanned.select("row", "owner", "repository", F.explode("found").alias("one")).select(
        "row", "owner", "repository", "one.*"
    )
    held = (
        each.groupBy("value", "owner", "repository")
        .agg(F.lit(1).alias("here"))
        .groupBy("value", "owner")
        .agg(F.count("*").alias("repositories"))
        .groupBy("value")
        .agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )
    rare = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    verdict = F.when(~rare, "example").when(F.col("live"), "live").otherwise("plain")
    spans = (
        each.join(held, "value")
        .where((F.col("kind") < LIVE) | rare)
        .withColumn("verdict", verdict)
        .groupBy("row")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("start", "kind", "end", "value", "owners", "repositories", "verdict")
                )
            ).alias("spans")
        )
    )
    names = F.array(*[F.lit(name) for name in KINDS])
    empty = F.array().cast(spans.schema["spans"].dataType)
    return (
        scanned.select("row", "doc_id")
        .join(spans, "row", "left")
        .select("doc_id", F.coalesce("spans", empty).alias("spans"))
        .withColumn(
            "spans",
            F.transform(
                "spans",
                lambda s: F.struct(
                    s["start"].alias("start"),
                    s["end"].alias("end"),
                    F.element_at(names, s["kind"] + 1).alias("kind"),
                    s["value"].alias("value"),
                    s["owners"].alias("owners"),
                    s["repositories"].alias("repositories"),
                    s["verdict"].alias("verdict"),
                ),
            ),
        )
    )
