"""Near-duplicate documents by an inverted index over MinHash coordinates.

A document's signature is one value for each of many hash functions; the pair of
coordinate and value is a token, and documents are posted under their tokens.  Similar
documents share at least MATCHES tokens.  So a token that only one document has is of no
use, a document with fewer useful tokens than that has no partner, and of the others it is
enough to post the rarest ones: any two documents that share MATCHES tokens meet under
one of their prefixes.  Where they meet, collisions of the whole signatures are counted, and
pairs that have enough are confirmed on the full sets.

Only connections are asked for, so each list is first met with its least document.  Of the
lists that then still hold several components, short ones give their pairs across
components, at most a few for each posting.  The documents of long ones are put in tiles
beside those they meet, and tiles that meet in a list are compared as wholes: the task
holds signatures and sets, tests only what is not yet connected, and returns a forest."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm import frames, shingles, words
from tripfold.llm.components import components

COORDINATES = 64
#: At a similarity of 0.75, 48 of 64 values agree on average; fewer than 30 with a chance
#: of 3.8 in ten million.
MATCHES = 30
PERCENT = 75
SHORT_LIST = 8
TILE_ROWS = 256
TILE_BYTES = 2 << 20
BROADCAST_BYTES = 32 << 20


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, digest of the set, signature and the bits
    below it, see ``shingles.halves``.

    A document without words has no shingle and null for the other three."""
    rows = frames.texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.working("near_duplicates")
        signer = shingles.Signer(COORDINATES)
        for batch in frames.slices(batches):
            sizes, digests, signed = [], [], []
            none = (None, None)
            for text in batch.column("text").to_pylist():
                found = shingles.shingle_set(text)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signed.append(shingles.halves(signer.sign(found)) if len(found) else none)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    *[pa.array([own[k] for own in signed], pa.binary()) for k in (0, 1)],
                ],
                ["doc_id", "n_shingles", "digest", "signature", "below"],
            )

    return rows.mapInArrow(
        run, f"doc_id {kind}, n_shingles bigint, digest binary, signature binary, below binary"
    )


def _prefixes(reps: DataFrame) -> DataFrame:
    """rep and its prefix: the rarest useful tokens, one more than may be missed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upper, lower = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), kind).reshape(-1, COORDINATES)
                for c, kind in (("signature", "<u4"), ("below", "<u2"))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column("rep").to_numpy(), COORDINATES)),
                    pa.array(shingles.tokens(upper, lower).ravel()),
                ],
                ["rep", "token"],
            )

    signed = reps.select("rep", "signature", "below")
    tokens = signed.mapInArrow(run, "rep bigint, token bigint")
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where(F.col("df") > 1)
    return (
        tokens.join(shared, "token")
        .groupBy("rep")
        .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("useful"))
        .where(F.size("useful") >= MATCHES)
        .select(
            "rep",
            F.slice("useful", 1, F.size("useful") - (MATCHES - 1))["token"].alias("prefix"),
        )
    )


def _collisions(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose signatures agree often enough and whose sizes allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u4").reshape(
                    -1, COORDINATES
                )
                for c in ("signature_a", "signature_b")
            )
            enough = (one == other).sum(axis=1) >= MATCHES
            yield batch.select(["a", "b"]).filter(pa.array(enough))

    def side(name):
        return reps.select(
            F.col("rep").alias(name),
            F.col("signature").alias(f"signature_{name}"),
            F.col("n_shingles").alias(f"n_{name}"),
        )

    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(_sizes_allow("n_a", "n_b"))
        .select("a", "b", "signature_a", "signature_b")
        .mapInArrow(run, "a bigint, b bigint")
    )


def _sizes_allow(one: str, other: str):
    return F.least(one, other) * 100 >= F.greatest(one, other) * PERCENT


def _sets(wanted: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """doc_id and hashes of the wanted documents, from the texts themselves.

    Sets are made again for these documents only, which costs a second scan instead of
    storing the sets of all documents."""
    wanted = frames.staged(wanted, f"{name}-wanted")
    small = wanted.count() * 16 <= BROADCAST_BYTES
    rows = docs.join(F.broadcast(wanted) if small else wanted, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.working("near_duplicates")
        for batch in frames.slices(batches):
            data = [
                shingles.shingle_set(text).astype("<u8").tobytes()
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "hashes"]
            )

    return frames.staged(rows.mapInArrow(run, "doc_id bigint, hashes binary"), name)


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough.

    Of rows that repeat an identifier any set that is similar makes the link."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    found = _sets(wanted, docs, "sets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames.slices(batches):
            similar = []
            for one, other in zip(
                batch.column("hashes_a").to_pylist(),
                batch.column("hashes_b").to_pylist(),
                strict=True,
            ):
                one, other = np.frombuffer(one, "<u8"), np.frombuffer(other, "<u8")
                both = shingles.common(one, other)
                similar.append(100 * both >= PERCENT * (len(one) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))

    def side(name):
        return found.select(F.col("doc_id").alias(name), F.col("hashes").alias(f"hashes_{name}"))

    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .select("a", "b", "hashes_a", "hashes_b")
        .mapInArrow(compare, "a bigint, b bigint")
    )


def _open_lists(postings: DataFrame, reached: DataFrame) -> DataFrame:
    """token, rep, n and component of lists that hold several components."""
    named = postings.join(reached, F.col("rep") == F.col("node"), "left").select(
        "token", "rep", "n", F.coalesce("component", "rep").alias("component")
    )
    mixed = (
        named.groupBy("token")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"))
        .where("least <> most")
        .select("token")
    )
    return named.join(mixed, "token", "left_semi")


def _across(short: DataFrame) -> DataFrame:
    """Pairs of different components in short lists, at most SHORT_LIST - 1 a posting."""
    one = short.select("token", F.col("rep").alias("a"), F.col("component").alias("of_a"))
    other = short.select("token", F.col("rep").alias("b"), F.col("component").alias("of_b"))
    return one.join(other, "token").where("a < b AND of_a <> of_b").select("a", "b").distinct()


def _tiles(long: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """The documents of long lists in tiles: tile, ids, components, signatures, ends, hashes.

    Documents that meet in some list stand together, those of one component side by side,
    so that most pairs of tiles lie within a component or never meet."""
    leaders = long.groupBy("token").agg(F.min("rep").alias("leader"))
    meet = components(long.join(leaders, "token").where("rep <> leader"), "rep", "leader")
    rows = long.select("rep", "component").distinct()
    sets = _sets(rows.select(F.col("rep").alias("doc_id")).distinct(), docs, "tile-sets")
    rows = (
        rows.join(meet.withColumnsRenamed({"node": "rep", "component": "label"}), "rep")
        .join(reps.select("rep", "signature"), "rep")
        .join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    )

    blocks = ["ids", "components", "signatures", "ends", "hashes"]
    meets = pa.struct([(name, pa.int64()) for name in ("label", "least", "most")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, size = TaskContext.get().partitionId() << 32, [], 0

        def done() -> pa.RecordBatch:
            ends = np.cumsum([len(row["hashes"]) // 8 for row in held])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([tile], pa.int64()),
                    *[
                        pa.array([np.array([r[c] for r in held], "<i8").tobytes()], pa.binary())
                        for c in ("rep", "component")
                    ],
                    pa.array([b"".join(row["signature"] for row in held)], pa.binary()),
                    pa.array([ends.astype("<i8").tobytes()], pa.binary()),
                    pa.array([b"".join(row["hashes"] for row in held)], pa.binary()),
                    pa.array([_meets(held)], pa.list_(meets)),
                ],
                ["tile", *blocks, "meets"],
            )

        for batch in frames.slices(batches):
            for row in batch.to_pylist():
                if held and (len(held) >= TILE_ROWS or size + len(row["hashes"]) > TILE_BYTES):
                    yield done()
                    tile, held, size = tile + 1, [], 0
                held.append(row)
                size += len(row["hashes"])
        if held:
            yield done()

    order = ["label", "component", "rep"]
    # Whole tiles, however many partitions the session asks for.
    parts = max(1, sets.count() // (4 * TILE_ROWS))
    dealt = rows.repartitionByRange(parts, *order).coalesce(parts).sortWithinPartitions(*order)
    schema = "tile bigint, " + ", ".join(f"{c} binary" for c in blocks)
    schema += ", meets array<struct<label:bigint,least:bigint,most:bigint>>"
    columns = ["rep", "component", "label", "signature", "hashes"]
    return frames.staged(dealt.select(*columns).mapInArrow(pack, schema), "text-tiles")


def _meets(rows: list[dict]) -> list[dict]:
    """For each group of documents that lists connect the range of its components."""
    found: dict[int, list[int]] = {}
    for row in rows:
        found.setdefault(row["label"], []).append(row["component"])
    return [
        {"label": label, "least": min(own), "most": max(own)} for label, own in found.items()
    ]


def _tile_links(tiles: DataFrame) -> DataFrame:
    """Confirmed links between components, a forest for each pair of tiles that meet.

    Tiles meet if they hold documents that lists connect; a pair that lies within one
    component has nothing to connect."""
    meeting = tiles.select("tile", F.explode("meets").alias("m")).select("tile", "m.*")
    pairs = (
        meeting.select("label", F.col("tile").alias("x"), "least", "most")
        .join(
            meeting.select(
                "label",
                F.col("tile").alias("y"),
                F.col("least").alias("least_y"),
                F.col("most").alias("most_y"),
            ),
            "label",
        )
        .where("x <= y AND NOT (least = most AND least_y = most_y AND least = least_y)")
        .select("x", "y")
        .distinct()
    )
    pairs = frames.staged(pairs, "text-tile-pairs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames.slices(batches, 1):
            row = batch.to_pylist()[0]
            one = _Tile(row, "x")
            found = _forest(one, one if row["x"] == row["y"] else _Tile(row, "y"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([pair[k] for pair in found], pa.int64()) for k in range(2)], ["a", "b"]
            )

    def side(name):
        return tiles.select(
            F.col("tile").alias(name),
            *[F.col(c).alias(f"{c}_{name}") for c in tiles.columns if c not in ("tile", "meets")],
        )

    blocks = pairs.join(side("x"), "x").join(side("y"), "y")
    return blocks.mapInArrow(run, "a bigint, b bigint")


class _Tile:
    def __init__(self, row: dict, side: str):
        self.ids = np.frombuffer(row[f"ids_{side}"], "<i8")
        self.components = np.frombuffer(row[f"components_{side}"], "<i8")
        self.signatures = np.frombuffer(row[f"signatures_{side}"], "<u4").reshape(-1, COORDINATES)
        ends = np.frombuffer(row[f"ends_{side}"], "<i8")
        self.hashes = np.frombuffer(row[f"hashes_{side}"], "<u8")
        self.starts, self.sizes = ends - np.diff(ends, prepend=0), np.diff(ends, prepend=0)

    def set_of(self, k: int) -> np.ndarray:
        return self.hashes[self.starts[k] : self.starts[k] + self.sizes[k]]


def _forest(one: _Tile, other: _Tile) -> list[tuple[int, int]]:
    """Links between the tiles that connect all components linked between them."""
    collisions = np.zeros((len(one.ids), len(other.ids)), dtype=np.uint8)
    for k in range(COORDINATES):
        collisions += one.signatures[:, k, None] == other.signatures[None, :, k]
    small = np.minimum(one.sizes[:, None], other.sizes[None, :])
    large = np.maximum(one.sizes[:, None], other.sizes[None, :])
    possible = (collisions >= MATCHES) & (small * 100 >= large * PERCENT)
    labels = {c: c for c in {*one.components.tolist(), *other.components.tolist()}}
    now = other.components.copy()  # the label of each row of the other tile, kept current
    found = []
    for row in range(len(one.ids)):
        own = labels[int(one.components[row])]
        columns = np.flatnonzero(possible[row] & (now != own))
        if not len(columns):
            continue
        own_set = one.set_of(row)
        # The best candidate alone first: it often connects the row to most of the others.
        best = columns[np.argmax(collisions[row, columns])]
        for some in (np.array([best]), columns):
            some = some[now[some] != own]
            if not len(some):
                continue
            counts = _common_with(own_set, other, some)
            union = len(own_set) + other.sizes[some] - counts
            for column in some[100 * counts >= PERCENT * union].tolist():
                gone = int(now[column])
                if gone != own:
                    found.append((int(one.ids[row]), int(other.ids[column])))
                    now[now == gone] = own
                    for name, label in labels.items():
                        if label == gone:
                            labels[name] = own
    return found


def _common_with(own: np.ndarray, tile: _Tile, rows: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of a sorted set with sets of a tile."""
    sizes = tile.sizes[rows]
    starts = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) - np.repeat(starts - tile.starts[rows], sizes)
    values = tile.hashes[at]
    place = np.minimum(np.searchsorted(own, values), len(own) - 1)
    return np.add.reduceat((own[place] == values).astype(np.int64), starts)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of five-word shingles have a similarity of 0.75 or
    more; equal sets are collapsed first.  Null, empty and wordless texts have no shingle
    and are a component of their own.  Rows that share an identifier count as one document.
    A row without an identifier is linked with nothing, has no component and is kept.  An
    empty table gives an empty result, extra columns are ignored."""
    docs = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    signed = frames.staged(signatures(docs), "signatures")
    sets = (
        signed.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "n_shingles", "signature", "below")).alias("one"))
        .select(
            "digest",
            F.col("one.doc_id").alias("rep"),
            "one.n_shingles",
            "one.signature",
            "one.below",
        )
    )
    reps = frames.staged(sets, "distinct-sets")

    posted = _prefixes(reps).select("rep", F.explode("prefix").alias("token"))
    posted = frames.staged(posted, "postings")
    lists = (
        posted.groupBy("token")
        .agg(F.min("rep").alias("leader"), F.count("*").alias("n"))
        .where("n > 1")
    )
    postings = frames.staged(posted.join(lists, "token"), "lists")
    first = frames.staged(
        _collisions(
            postings.where("rep <> leader")
            .select(F.col("leader").alias("a"), F.col("rep").alias("b"))
            .distinct(),
            reps,
        ),
        "leader-pairs",
    )
    copies = signed.join(reps.select("digest", "rep"), "digest").select(
        F.col("rep").alias("a"), F.col("doc_id").alias("b")
    ).where("a <> b")
    links = frames.staged(_confirmed(first, docs), "links")
    reached = components(links, "a", "b")

    # Lists of two have been compared; longer ones may hold further components.
    mixed = frames.staged(_open_lists(postings.where("n > 2"), reached), "open-lists")
    more = _across(mixed.where(F.col("n") <= SHORT_LIST)).join(first, ["a", "b"], "left_anti")
    more = frames.staged(_collisions(more, reps), "more-pairs")
    everything = copies.unionByName(links).unionByName(_confirmed(more, docs))
    for used in (posted, postings):
        frames.drop_staged(used)
    long = mixed.where(F.col("n") > SHORT_LIST)
    if not long.isEmpty():
        everything = everything.unionByName(_tile_links(_tiles(long, docs, reps)))
    final = components(everything, "a", "b")
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce(F.col("component"), F.col("doc_id"))
    )
    return (
        signed.select("doc_id", "n_shingles")
        .join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )
