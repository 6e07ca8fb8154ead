"""How the wording of each source departs from its language's other sources.

Every language keeps the terms of at least ``min_docs`` of its documents.  Minimal acyclic
transducers hold them and number them in byte order; whole texts run through these once more
for the counts of each source, so the recount moves numbers and no words, and ties are told
by number.  All arithmetic is on whole numbers."""

import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripfold.llm import frames, transducer

MIN_DOCS = 10
TOP = 10
PIECE_TERMS = 250_000  # of one transducer at most
HELD_BYTES = 64 << 20  # of the transducers that a task holds during one scan
FLUSH_BYTES = 16 << 20  # of text whose counts a task holds before it hands them on
WINDOW = 1 << 20
COUNTED = 4096  # neighbouring terms whose counts go together
CHUNK = 4096  # terms of one tile
BLOCK = 128  # sources along one side of a tile

#: Every byte that no term holds becomes a blank, A-Z becomes a-z.
BLANKED = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def windows(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text, as UTF-8, a window at a time; a window ends at a byte that
    no term holds, however far that is."""
    data, start = data.translate(BLANKED), 0
    while start < len(data):
        end = data.find(b" ", start + WINDOW)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def _rows(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    rows = frames.narrow(docs, text=text_col, lang=lang_col, source=source_col)
    empty = F.lit("")
    return rows.select(
        F.coalesce(F.col("lang").cast("string"), empty).alias("lang"),
        F.coalesce(F.col("source").cast("string"), empty).alias("source"),
        F.coalesce(F.col("text"), empty).cast("binary").alias("text"),
    )


def _sums(counts: dict[str, Counter], key: str) -> pa.RecordBatch:
    langs = [lang for lang, own in counts.items() for _ in range(len(own))]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(langs, pa.string()),
            pa.array([term for own in counts.values() for term in own], pa.binary()),
            pa.array([n for own in counts.values() for n in own.values()], pa.int64()),
        ],
        ["lang", key, "n"],
    )


def kept_terms(rows: DataFrame, min_docs: int) -> DataFrame:
    """lang and term (UTF-8) of the terms that enough documents of the language hold.

    Tasks count documents for themselves first, so what is shuffled is distinct terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        read = 0
        for batch in frames.slices(batches):
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                data, terms = text.as_py(), set()
                for some in windows(data):
                    terms.update(some)
                counts[lang.as_py()].update(terms)
                read += len(data)
                if read >= FLUSH_BYTES:
                    yield _sums(counts, "term")
                    counts.clear()
                    read = 0
        yield _sums(counts, "term")

    counted = rows.select("lang", "text").mapInArrow(run, "lang string, term binary, n bigint")
    frequent = counted.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return frequent.where(F.col("n") >= min_docs).select("lang", "term")


def transducers(terms: DataFrame, piece_terms: int = PIECE_TERMS) -> DataFrame:
    """piece, lang, first (its least term), number (of terms), data: transducers over
    neighbouring terms of one language.

    Terms are sorted by ranges, so each task builds from its own stretch of the order."""
    pieces = max(1, -(-terms.count() // piece_terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, held, lang = TaskContext.get().partitionId() << 32, [], None

        def done() -> pa.RecordBatch:
            built = transducer.build(held)
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "piece": piece,
                        "lang": lang,
                        "first": held[0],
                        "number": built.number,
                        "data": pickle.dumps(built),
                    }
                ],
                pa.schema(
                    [
                        ("piece", pa.int64()),
                        ("lang", pa.string()),
                        ("first", pa.binary()),
                        ("number", pa.int64()),
                        ("data", pa.binary()),
                    ]
                ),
            )

        for batch in batches:
            for own, term in zip(
                batch.column("lang").to_pylist(), batch.column("term").to_pylist(), strict=True
            ):
                if held and (own != lang or len(held) >= piece_terms):
                    yield done()
                    piece, held = piece + 1, []
                lang = own
                held.append(term)
        if held:
            yield done()

    ordered = terms.repartitionByRange(pieces, "lang", "term").sortWithinPartitions("lang", "term")
    return ordered.mapInArrow(
        run, "piece bigint, lang string, first binary, number bigint, data binary"
    )


class Vocabulary:
    """Some transducers, by language, with the ordinal their first terms have there."""

    def __init__(self, held: list[tuple[str, bytes, int, bytes]]):
        self.pieces: dict[str, list] = defaultdict(list)
        for lang, first, base, data in sorted(held, key=lambda piece: piece[:2]):
            self.pieces[lang].append((first, base, pickle.loads(data)))

    def ordinals(self, lang: str, terms: list[bytes]) -> np.ndarray:
        found = np.full(len(terms), -1, dtype=np.int64)
        for _, base, piece in self.pieces.get(lang, []):
            own = piece.ordinals(terms)
            found = np.where(own >= 0, own + base, found)
        return found


def recounted(rows: DataFrame, pieces: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """lang, source, ordinal and n: how often each kept term occurs in each group.

    The driver sees one short row a transducer.  Tasks hold at most ``held_bytes`` of them,
    or one; a vocabulary beyond that takes several scans, each over the languages it needs."""
    session = rows.sparkSession
    totals: dict[str, int] = defaultdict(int)
    loads: list[list] = [[]]
    room = held_bytes
    directory = pieces.select("piece", "lang", "first", "number", F.length("data").alias("size"))
    for row in sorted(directory.collect(), key=lambda r: (r.lang, bytes(r.first))):
        if loads[-1] and row.size > room:
            loads.append([])
            room = held_bytes
        loads[-1].append((row.piece, row.lang, totals[row.lang]))
        totals[row.lang] += row.number
        room -= row.size
    counted = []
    for load in loads:
        numbers = {piece: (lang, base) for piece, lang, base in load}
        data = pieces.where(F.col("piece").isin(list(numbers))).select("piece", "first", "data")
        vocabulary = Vocabulary(
            [(numbers[r.piece][0], bytes(r.first), numbers[r.piece][1], bytes(r.data))
             for r in data.toLocalIterator()]
        )
        own = rows.where(F.col("lang").isin(sorted({lang for _, lang, _ in load})))
        counted.append(_streamed(own, session.sparkContext.broadcast(vocabulary)))
    every = counted[0]
    for more in counted[1:]:
        every = every.unionAll(more)
    return _merged(every)


def _repeated(value: str, number: int) -> pa.Array:
    return pa.repeat(pa.scalar(value, pa.string()), number)


def _streamed(rows: DataFrame, held) -> DataFrame:
    """What each task counts: lang, source, chunk (of neighbouring ordinals), and as arrays the
    places in the chunk and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        read = 0

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), own in counts.items():
                ordinals = held.value.ordinals(lang, list(own))
                order = np.argsort(ordinals, kind="stable")
                order = order[np.searchsorted(ordinals[order], 0) :]
                ordinals = ordinals[order]
                numbers = np.fromiter(own.values(), "<u4", len(own))[order]
                chunks, starts = np.unique(ordinals // COUNTED, return_index=True)
                cuts = [*starts.tolist(), len(ordinals)]
                places = (ordinals % COUNTED).astype("<u2")
                parts = list(zip(cuts, cuts[1:], strict=False))
                yield pa.RecordBatch.from_arrays(
                    [
                        _repeated(lang, len(parts)),
                        _repeated(source, len(parts)),
                        pa.array(chunks),
                        pa.array([places[a:b].tobytes() for a, b in parts], pa.binary()),
                        pa.array([numbers[a:b].tobytes() for a, b in parts], pa.binary()),
                    ],
                    ["lang", "source", "chunk", "places", "numbers"],
                )
            counts.clear()

        for batch in frames.slices(batches):
            for lang, source, text in zip(
                batch.column("lang").to_pylist(),
                batch.column("source").to_pylist(),
                batch.column("text"),
                strict=True,
            ):
                data = text.as_py()
                for terms in windows(data):
                    counts[lang, source].update(terms)
                read += len(data)
                if read >= FLUSH_BYTES:
                    yield from handed_on()
                    read = 0
        yield from handed_on()

    return rows.mapInArrow(
        run, "lang string, source string, chunk bigint, places binary, numbers binary"
    )


def _merged(counted: DataFrame) -> DataFrame:
    """lang, source, ordinal and n, from what all tasks counted.

    The parts of a chunk come one after the other and are added into one array, so a group
    that a third of all documents share costs no more memory than another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums = None, np.zeros(COUNTED, dtype=np.int64)

        def done() -> pa.RecordBatch:
            places = np.flatnonzero(sums)
            lang, source, chunk = key
            return pa.RecordBatch.from_arrays(
                [
                    _repeated(lang, len(places)),
                    _repeated(source, len(places)),
                    pa.array(places + chunk * COUNTED),
                    pa.array(sums[places]),
                ],
                ["lang", "source", "ordinal", "n"],
            )

        for batch in frames.slices(batches):
            for row in batch.to_pylist():
                own = row["lang"], row["source"], row["chunk"]
                if own != key:
                    if key is not None:
                        yield done()
                    key = own
                    sums[:] = 0
                sums[np.frombuffer(row["places"], "<u2")] += np.frombuffer(row["numbers"], "<u4")
        if key is not None:
            yield done()

    keys = ("lang", "source", "chunk")
    return (
        counted.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(run, "lang string, source string, ordinal bigint, n bigint")
    )


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), exact beyond 64 bits."""
    above = F.lit(1_000_000_000).cast("decimal(10,0)") * (count + 2)
    below = (total + 2 * terms).cast("decimal(20,0)")
    return (F.call_function("div", above, below) + 1).cast("bigint")


def _gap(one: Column, other: Column) -> Column:
    return F.call_function("div", (one - other) * (one - other), one + other)


def _tile_sums(chunk_terms: int, block_sources: int):
    """What a tile gives: sums over one chunk of terms for all pairs of sources of two blocks."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lang, chunk, one, two = (part.as_py() for part in key)
        place = table.column("place").to_numpy()
        ordinal = table.column("ordinal").to_numpy(zero_copy_only=False).astype(np.float64)
        share = table.column("share").to_numpy()
        empty = np.isnan(ordinal)
        order = np.argsort(place[empty], kind="stable")
        places = place[empty][order]
        width = max(0, min(chunk_terms, table.column("terms")[0].as_py() - chunk * chunk_terms))
        matrix = np.repeat(share[empty][order][:, None], width, axis=1)
        rows = np.searchsorted(places, place[~empty])
        columns = ordinal[~empty].astype(np.int64) - chunk * chunk_terms
        matrix[rows, columns] = share[~empty]
        none = np.empty(0, dtype=np.int64)
        firsts, seconds, values = [none], [none], [none]
        for k in np.flatnonzero(places // block_sources == one).tolist():
            after = k + 1 if one == two else int(np.searchsorted(places, two * block_sources))
            rest = matrix[after:]
            gap, total = rest - matrix[k], rest + matrix[k]
            firsts.append(np.full(len(rest), places[k]))
            seconds.append(places[after:])
            values.append((gap * gap // total).sum(axis=1))
        first = np.concatenate(firsts)
        return pa.table(
            {
                "lang": pa.array([lang] * len(first), pa.string()),
                "one": pa.array(first),
                "other": pa.array(np.concatenate(seconds)),
                "value": pa.array(np.concatenate(values)),
            }
        )

    return run


def _pairs(groups: DataFrame, counts: DataFrame, chunk: int, block: int) -> DataFrame:
    """lang, one, other (places of two sources, the lesser first) and value.

    Tiles of terms and source blocks are dense, but bounded; an absent count is a share of
    its own, so every tile gets the groups' empty shares beside what was counted."""
    zero = F.lit(0).cast("bigint")
    other = F.explode(F.sequence(zero, F.floor((F.col("sources") - 1) / block))).alias("__other")
    own = F.floor(F.col("place") / block).alias("__block")

    def dealt(frame: DataFrame) -> DataFrame:
        return frame.select("*", own, other).select(
            "lang",
            "chunk",
            F.least("__block", "__other").alias("block"),
            F.greatest("__block", "__other").alias("block_two"),
            "place",
            "ordinal",
            "share",
            "terms",
        )

    last = F.greatest(F.floor((F.col("terms") - 1) / chunk), zero)
    empty = groups.select(
        "lang", "place", "sources", "terms",
        F.col("empty_share").alias("share"),
        F.lit(None).cast("bigint").alias("ordinal"),
        F.explode(F.sequence(zero, last)).alias("chunk"),
    )
    counted = counts.select(
        "lang", "place", "sources", "terms", "share", "ordinal",
        F.floor(F.col("ordinal") / chunk).alias("chunk"),
    )
    tiles = dealt(empty.unionByName(counted)).groupBy("lang", "chunk", "block", "block_two")
    sums = tiles.applyInArrow(
        _tile_sums(chunk, block), "lang string, one bigint, other bigint, value bigint"
    )
    return sums.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    piece_terms: int = PIECE_TERMS,
    held_bytes: int = HELD_BYTES,
    chunk: int = CHUNK,
    block: int = BLOCK,
) -> DataFrame:
    """lang, source, part, item, value and rank.

    Part ``pair``: every other source of the language, by distance over all kept terms, all
    ranks.  Part ``term``: the kept terms a source holds more of than its language, the
    ``top`` that differ most.  Larger values rank first, then items in byte order.

    A null text, language or source is an empty one, and a group without terms still has
    its pairs.  Repeated rows count as often as they occur.  A language without kept terms
    has pairs of value 0, one with a single source has none; an empty table gives no row.
    Extra columns are ignored."""
    rows = _rows(docs, text_col, lang_col, source_col)
    pieces = frames.staged(
        transducers(frames.staged(kept_terms(rows, min_docs), "kept-terms"), piece_terms),
        "transducers",
    )
    counts = frames.staged(recounted(rows, pieces, held_bytes), "term-counts")

    sizes = pieces.groupBy("lang").agg(F.sum("number").alias("terms"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_source = Window.partitionBy("lang").orderBy("source")
    none = F.lit(0).cast("bigint")
    total, terms = F.coalesce("total", none), F.coalesce("terms", none)
    groups = (
        rows.select("lang", "source")
        .distinct()
        .select(
            "*",
            (F.row_number().over(by_source) - 1).cast("bigint").alias("place"),
            F.count("*").over(Window.partitionBy("lang")).alias("sources"),
        )
        .join(sums, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .withColumns({"total": total, "terms": terms})
    )
    share_of_none = F.when(F.col("terms") > 0, _share(none, F.col("total"), F.col("terms")))
    groups = frames.staged(
        groups.withColumn("empty_share", F.coalesce(share_of_none, none)), "groups"
    )
    shared = counts.join(groups, ["lang", "source"]).withColumn(
        "share", _share(F.col("n"), F.col("total"), F.col("terms"))
    )

    halves = _pairs(groups, shared, chunk, block)
    both = halves.unionAll(halves.select("lang", F.col("other"), F.col("one"), "value"))
    named = groups.select("lang", F.col("place").alias("one"), "source")
    items = groups.select("lang", F.col("place").alias("other"), F.col("source").alias("item"))
    pairs = both.join(named, ["lang", "one"]).join(items, ["lang", "other"])
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value",
        F.row_number().over(by_value).alias("rank"),
    )

    of_lang = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("__n"))
    lang_total = groups.groupBy("lang").agg(F.sum("total").alias("__total"))
    wider = of_lang.join(lang_total, "lang").join(sizes, "lang")
    wider = wider.select(
        "lang", "ordinal",
        _share(F.col("__n"), F.col("__total"), F.col("terms")).alias("__share"),
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    leading = (
        shared.select("lang", "source", "ordinal", "share")
        .join(wider, ["lang", "ordinal"])
        .where(F.col("share") > F.col("__share"))
        .select("lang", "source", "ordinal", _gap(F.col("share"), F.col("__share")).alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= top)
    )
    terms = leading.join(_listed(pieces, sizes), ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"),
        F.col("term").cast("string").alias("item"), "value", "rank",
    )
    return pairs.unionByName(terms)


def _listed(pieces: DataFrame, sizes: DataFrame) -> DataFrame:
    """lang, ordinal and term, read back from the transducers."""
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = pieces.select("piece", "lang", "first", "number").select(
        "piece", F.coalesce(F.sum("number").over(before), F.lit(0)).alias("base")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames.slices(batches, 1):
            lang, base, data = (batch.column(c)[0].as_py() for c in ("lang", "base", "data"))
            terms = list(pickle.loads(data).terms())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array(np.arange(base, base + len(terms))),
                    pa.array(terms, pa.binary()),
                ],
                ["lang", "ordinal", "term"],
            )

    listed = pieces.select("piece", "lang", "data").join(bases, "piece")
    return listed.select("lang", "base", "data").mapInArrow(
        run, "lang string, ordinal bigint, term binary"
    )
