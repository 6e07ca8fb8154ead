"""Personal data in texts: fixed patterns, and identifiers found by the contexts they share.

The spans of the fixed patterns are seeds.  Each gives several patterns: the words around
it, fewer of them, and its shape, alone or beside a word or another seed.  The patterns also
fit other identifier-shaped values.  On the graph of patterns and values Spark then scores
both sides in turn: a pattern by its trusted values against those that are no identifiers, a
value by the best pattern it fits.  Values that reach the threshold give further spans."""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripfold.llm import frames, words

KINDS = ("email", "ip", "card", "phone", "found")
EMAIL, IP, CARD, PHONE, FOUND, PLAIN = range(6)  # PLAIN: a number too short to be any

#: The patterns of the base spans.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE_NUMBER = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Identifier-shaped, with two digits and six characters at least: a token of groups joined by
#: hyphens, slashes or dots between digits; a run of such groups joined by spaces or brackets too.
START = r"(?<!\w)(?<!\w[-/])(?<![0-9]\.)"
TOKEN = re.compile(
    START
    + r"(?=(?:[A-Za-z_]|[-/](?=[A-Za-z0-9]))*+[0-9])"
    + r"[A-Za-z0-9](?:[A-Za-z0-9_]|[-/](?=[A-Za-z0-9])|(?<=[0-9])\.(?=[0-9]))*+(?!\w)"
)
GROUP = r"(?:\([0-9]++\)|[A-Z]{0,4}[0-9][A-Z0-9]*+(?!\w)"
RUN = re.compile(
    START
    + rf"\+?{GROUP})"
    + rf"(?:(?:[\x20./-]|(?<=\))|(?=\()){GROUP}|[A-Z]{{1,4}}(?=[\x20./-][0-9])))++(?!\w)"
)
#: The part of a run before or between groups of more digits than a phone's have.
SHORT_RUN = re.compile(
    RUN.pattern.replace("[0-9]++", "[0-9]{1,12}+").replace("[A-Z0-9]*+", "[A-Z0-9]{0,11}+")
)
GROUP_OF_DIGITS = re.compile("[0-9]+")
WORD = re.compile(r"[^\W\d_]+")
FILLER = re.compile(r"[^\W\d_]+|\0+")
REACH = 60  # characters looked at on either side of a token
NEAR = 3  # characters at most between neighbours

#: Shaped like identifiers, but seldom any: dates, amounts, addresses out of range.
DOUBTFUL = re.compile(r"[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]+\.[0-9]+|[0-9]+(?:\.[0-9]+){3}")
UNKNOWN = 0.1  # what an unknown value counts against a pattern of three words

MIN_SEEDS = 5
MIN_CONFIDENCE = 0.9


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """The leftmost local part that ends at each @ not yet used, and the host behind it.

    Looking back from every @ visits a long run of local characters once, where a search
    from every character would visit it once for each of its characters."""
    spans, bound = [], 0
    at = text.find("@")
    while at >= 0:
        start = bound + len(text[bound:at].rstrip(LOCAL))
        host = HOST.match(text, at + 1) if start < at else None
        bound = at + 1
        if host:
            spans.append((start, host.end()))
            bound = host.end()
        at = text.find("@", bound)
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, in code points, by kind and start."""
    spans = [(EMAIL, start, end) for start, end in emails(text)]
    for match in ADDRESS.finditer(text) if "." in text else ():
        if all(
            len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255
            for part in match[0].split(".")
        ):
            spans.append((IP, match.start(), match.end()))
    for match in DIGITS.finditer(text):
        if match.end() - match.start() >= 16:
            digits = match[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append((CARD, match.start(), match.end()))
    for match in PHONE_NUMBER.finditer(text) if "+" in text else ():
        if 8 <= sum(character.isdigit() for character in match[0]) <= 15:
            spans.append((PHONE, match.start(), match.end()))
    return spans


def card_digits(value: str) -> int:
    """The number of digits of a value as long as a card's, else 0."""
    digits = value.replace(" ", "").replace("-", "")
    return len(digits) if 16 <= len(digits) <= 19 and digits.isdecimal() else 0


def shape(value: str) -> str:
    """Digits and letters by class, with their number; cards by their length and check."""
    size = card_digits(value)
    if size and luhn(value.replace(" ", "").replace("-", "")):
        return f"card{size}"
    told = re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", value)))
    told = re.sub(r"(.)\1+", lambda run: f"{run[1]}{len(run[0])}", told)
    return told if len(told) <= REACH else hashlib.sha256(told.encode()).hexdigest()


def masked(text: str, spans: list[tuple[int, int]]) -> str:
    parts, at = [], 0
    for start, end in sorted(spans):
        if end > at:
            parts += [text[at:start], "\0" * (end - max(at, start))]
            at = end
    return "".join([*parts, text[at:]])


def cards_in_row(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Cards of whole groups inside digits that are too many for one."""
    groups = [match.span() for match in GROUP_OF_DIGITS.finditer(text, start, end)]
    for k, (first, _) in enumerate(groups):
        digits = ""
        for left, last in groups[k : k + 19]:
            digits += text[left:last]
            if len(digits) > 19:
                break
            if len(digits) >= 16 and luhn(digits):
                yield first, last


def candidates(
    text: str, base: list[tuple[int, int, int]]
) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Identifier-shaped stretches between the base spans, runs and the tokens inside them;
    then the tokens with digits outside of them."""
    rest = masked(text, [(start, end) for _, start, end in base])
    tokens = [match.span() for match in TOKEN.finditer(rest)]
    found = set(tokens)
    for run in RUN.finditer(rest):
        found.add(run.span())
        found |= {part.span() for part in SHORT_RUN.finditer(rest, *run.span())}
    for run in DIGITS.finditer(rest):
        if run.end() - run.start() > 19:
            found |= set(cards_in_row(rest, *run.span()))
    found = sorted(
        (start, end)
        for start, end in found
        if end - start >= 6 and sum(map(str.isdigit, text[start:end])) >= 2
    )
    plain, at, reach = [], 0, 0
    for start, end in tokens:
        while at < len(found) and found[at][0] < end:
            reach = max(reach, found[at][1])
            at += 1
        if reach <= start:
            plain.append((start, end))
    return found, plain


def word_patterns(text: str, start: int, end: int) -> list[str]:
    """Two words before and one behind, then two before, then one on either side."""
    left = WORD.findall(text[max(0, start - REACH) : start].lower())[-2:]
    right = WORD.findall(text[end : end + REACH].lower())[:1]
    found = []
    if len(left) == 2:
        found = [" ".join([*left, "_", *right]), " ".join([*left, "_", "*"])]
    return [*found, " ".join(["*", left[-1], "_", *right])] if left and right else found


def shape_patterns(
    text: str, start: int, end: int, starts: dict[int, int], ends: dict[int, int]
) -> list[str]:
    """The shape beside the word on either side and beside a neighbouring seed; alone only
    that of a card or a phone, which has a check or a sign of its own."""
    own = shape(text[start:end])
    found = [f"={own}"] if own.startswith(("card", "+")) else []
    found += [f"{w} ={own}" for w in WORD.findall(text[max(0, start - REACH) : start].lower())[-1:]]
    found += [f"={own} {w}" for w in WORD.findall(text[end : end + REACH].lower())[:1]]
    for gap in range(NEAR + 1):
        if start - gap in ends:
            found.append(f"{KINDS[ends[start - gap]]}: ={own}")
        if end + gap in starts:
            found.append(f"={own} :{KINDS[starts[end + gap]]}")
    return found


def fillers(text: str, spans: list[tuple[int, int]]) -> dict[str, int]:
    """For each pattern of three words, the distinct words that stand in its gap in the text."""
    wanted = {pattern for one in spans for pattern in word_patterns(text, *one)[:1]}
    words = FILLER.findall(masked(text, spans).lower())
    found = {}
    for before, left, word, right in zip(
        words, words[1:], words[2:], words[3:], strict=False
    ):
        pattern = f"{before} {left} _ {right}"
        if pattern in wanted and not word.startswith("\0"):
            found.setdefault(pattern, set()).add(word)
    return {pattern: len(own) for pattern, own in found.items()}


def instances(text: str) -> list[dict]:
    """Base spans, identifier-shaped stretches that overlap none, and plain numbers, with
    their patterns: what an unknown value weighs against each, and the words seen there."""
    base = base_spans(text)
    likely, plain = candidates(text, base)
    found = [*base, *((FOUND, *span) for span in likely), *((PLAIN, *span) for span in plain)]
    seen = fillers(text, [(start, end) for _, start, end in found]) if base or likely else {}
    starts = {start: kind for kind, start, _ in base}
    ends = {end: kind for kind, _, end in base}
    out = []
    for kind, start, end in found:
        value = text[start:end]
        words = word_patterns(text, start, end)
        shaped = kind in (CARD, PHONE, FOUND)
        shapes = shape_patterns(text, start, end, starts, ends) if shaped else []
        doubtful = kind != FOUND or card_digits(value) or DOUBTFUL.fullmatch(value)
        whole = words[:1] if len(words) > 1 and not doubtful else []
        patterns = [
            {
                "pattern": pattern,
                "weight": UNKNOWN if pattern in whole else 1.0,
                "against": seen.get(pattern, 0),
            }
            for pattern in dict.fromkeys([*words, *shapes])
        ]
        value = hashlib.sha256(value.encode()).hexdigest()
        out.append({"kind": kind, "start": start, "end": end, "value": value, "patterns": patterns})
    return out


def trusted_values(
    edges: DataFrame, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """Values that high-confidence patterns fit, from distinct edges (pattern, value, seed,
    plain, weight, against).

    Each round scores a pattern, if at least ``min_seeds`` of its distinct values are
    trusted, by their trust over the trusted values, the weights of the others and the words
    seen in their place; then a value by the best of its patterns.  Trust is 1 for a seed
    and else the best score so far that reached ``min_confidence``; plain values never
    gain any.  Trust is never lost, and rounds go on until one brings no new value, so there
    are at most as many as values.  Both steps aggregate before they shuffle; the trusted
    values are staged each round, which keeps the plan short."""
    seeds = edges.where("seed").select("value", F.lit(1.0).alias("trust")).distinct()
    fresh = edges.where(~F.col("seed") & ~F.col("plain")).select("pattern", "value")
    trusted, known = frames.staged(seeds, "trust"), -1
    while (number := trusted.count()) > known:
        known = number
        patterns = (
            edges.join(trusted, "value", "left")
            .groupBy("pattern")
            .agg(
                (
                    F.sum("trust")
                    / F.sum(
                        F.when(F.col("trust").isNull(), F.col("weight")).otherwise(1.0)
                        + F.col("against")
                    )
                ).alias("confidence"),
                F.count("trust").alias("seeds"),
            )
            .where((F.col("seeds") >= min_seeds) & (F.col("confidence") >= min_confidence))
            .select("pattern", "confidence")
        )
        won = fresh.join(patterns, "pattern").groupBy("value").agg(F.max("confidence").alias("trust"))
        every = trusted.unionByName(won).groupBy("value").agg(F.max("trust").alias("trust"))
        before, trusted = trusted, frames.staged(every, "trust")
        frames.drop_staged(before)
    return trusted.join(fresh.select("value").distinct(), "value", "left_semi")


def find(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_seeds: int = MIN_SEEDS,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """One row per input row: row (a number of its own), doc_id, text and spans.

    ``spans`` is an array of (kind, start, end), kinds by number as in KINDS, in that
    order; offsets are code points, the end is exclusive.  A null text counts as empty and
    has no span.  Null identifiers and repeated rows are kept as they are, an empty table
    gives an empty result, and extra columns are ignored."""
    rows = frames.texts(docs, id_col, text_col)
    scanned = frames.staged(
        _scan(rows).withColumn("row", F.monotonically_increasing_id()), "identifiers"
    )
    return _spans(scanned, min_seeds, min_confidence).select("doc_id", "spans")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each span of its text replaced by its kind in brackets.

    Overlapping spans become one, named after the first kind.  A null text stays null, and
    every other column stays as it is; so does its order."""
    columns = docs.columns
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in columns if c != text_col]).alias("rest"),
        F.col(text_col).isNull().alias("absent"),
    )
    scanned = frames.staged(
        _scan(rows, keep=True).withColumn("row", F.monotonically_increasing_id()), "identifiers"
    )
    marked = _spans(scanned, MIN_SEEDS, MIN_CONFIDENCE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames.slices(batches):
            texts = [
                None if absent else replaced(text, spans)
                for text, spans, absent in zip(
                    batch.column("text").to_pylist(),
                    batch.column("spans").to_pylist(),
                    batch.column("absent").to_pylist(),
                    strict=True,
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), batch.column("rest")], ["text", "rest"]
            )

    rest = marked.schema["rest"].dataType.simpleString()
    done = marked.select("text", "spans", "absent", "rest").mapInArrow(
        run, f"text string, rest {rest}"
    )
    return done.select(
        *[
            F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c)
            for c in columns
        ]
    )


def replaced(text: str, spans: list[dict]) -> str:
    out, at = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], s["kind"])):
        if span["start"] >= at:
            out += [text[at : span["start"]], f"[{KINDS[span['kind']].upper()}]"]
        at = max(at, span["end"])
    return "".join([*out, text[at:]])


def _scan(rows: DataFrame, keep: bool = False) -> DataFrame:
    """Instances of each text; the texts themselves only where they are needed again."""
    kept = [c for c in rows.columns if keep or c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = pa.struct(
            [("pattern", pa.string()), ("weight", pa.float64()), ("against", pa.int32())]
        )
        kind = pa.struct(
            [
                ("kind", pa.int32()),
                ("start", pa.int32()),
                ("end", pa.int32()),
                ("value", pa.string()),
                ("patterns", pa.list_(edge)),
            ]
        )
        words.working("personal_data")
        for batch in frames.slices(batches):
            found = [instances(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(found, pa.list_(kind))],
                [*kept, "instances"],
            )

    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    edge = "struct<pattern:string,weight:double,against:int>"
    one = f"struct<kind:int,start:int,end:int,value:string,patterns:array<{edge}>>"
    return rows.mapInArrow(run, f"{schema}, instances array<{one}>")


def _spans(
    scanned: DataFrame, min_seeds: int, min_confidence: float
) -> DataFrame:
    """The scanned rows with ``spans``: base spans, and those of trusted values."""
    each = scanned.select("row", F.explode("instances").alias("one")).select("row", "one.*")
    edges = frames.staged(
        each.select("kind", "value", F.explode("patterns").alias("edge"))
        .select("kind", "value", "edge.*")
        .groupBy("pattern", "value")
        .agg(
            F.max(F.col("kind") < FOUND).alias("seed"),
            F.min(F.col("kind") == PLAIN).alias("plain"),
            F.max("weight").alias("weight"),
            F.sum("against").alias("against"),
        ),
        "patterns",
    )
    trusted = trusted_values(edges, min_seeds, min_confidence)
    # Of a run and the tokens inside it only the widest trusted one stays.
    before = (
        Window.partitionBy("row")
        .orderBy("start", F.desc("end"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    more = (
        each.where(F.col("kind") == FOUND)
        .join(trusted, "value", "left_semi")
        .withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0)))
        .where(F.col("end") > F.col("reach"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("more"))
    )
    base = F.transform(
        F.filter("instances", lambda s: s["kind"] < FOUND),
        lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")
        ),
    )
    nothing = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return scanned.join(more, "row", "left").withColumn(
        "spans", F.concat(F.sort_array(base), F.coalesce("more", nothing))
    )
