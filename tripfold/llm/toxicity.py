"""Toxicity scores: boosted trees over a few dense features of a text's manner.

How dense the words of some lexicons stand, how near they stand to a second person, and how
often capitals, marks and disguised words occur; isotonic calibration makes a score the
likelihood of label 1.  Beside fixed lexicons stands one of word beginnings, learned from the
labelled rows, since no list holds the hostile words of every language.  A labelled row is
described by a lexicon that was learned without it."""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm import boosting, frames, sampling

MAX_ROWS = 8_000  # learned from, over both labels
FOLDS = 3
WINDOW = 1 << 16
REACH = 50  # words; nothing farther away counts as near
BEGINNINGS = (4, 5, 6)  # letters of a word that the learned lexicon may go by
LEXICON_SIZE = 256
CANDIDATES = 4096
LEAST_ROWS = 5  # of label 1 that hold a beginning
LEAST_RATIO = 3.0  # how much commoner it is there
LEAST_EVIDENCE = 20.0  # as a log-likelihood ratio

#: Words by the kind of hostility, without accents or disguise.
LEXICONS = {
    "insult": (
        "idiot idiots moron morons loser losers scum clown clowns fool fools imbecile cretin "
        "jerk dumbass dimwit halfwit twit simpleton buffoon coward liar freak creep pig "
        "parasite vermin imbecil estupido estupida tonto tonta cabron payaso connard connasse "
        "cretin abruti salaud ordure trottel dummkopf vollidiot depp arschloch schwachkopf "
        "drecksack abschaum"
    ),
    "contempt": (
        "stupid pathetic worthless disgusting trash garbage useless filthy dumb ugly ridiculous "
        "repulsive vile brainless hopeless contemptible nasty hateful lousy rotten inutil "
        "patetico asqueroso basura nul minable degoutant pathetique dumm wertlos widerlich "
        "erbarmlich nutzlos"
    ),
    "threat": (
        "kill kills murder hurt destroy beat punch strangle shoot stab burn smash choke "
        "matar morir tuer crever umbringen sterben verrecken"
    ),
    "profanity": (
        "damn crap shit shitty bullshit fuck fucking fucker bitch bastard ass asshole "
        "piss puta mierda joder merde putain scheisse verdammt"
    ),
}
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur tu te ti tus usted ustedes vosotros toi ton tes vous "
    "votre vos du dich dir dein deine deinen euch euer eure ihr".split()
)
#: What disguised letters stand for.
DISGUISES = str.maketrans("@4310!$57+8", "aaeioissttb")

WORD = re.compile(r"[^\W\d_]+")
DISGUISED = re.compile(r"(?<![^\W\d_])[^\W\d_]*+(?:[@$!*0134578+#]++[^\W\d_]++)+")
SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .*_-]){3,}[^\W\d_](?![^\W_])")
DRAWN_OUT = re.compile(r"([^\W\d_])\1\1+")
SHOUTED = re.compile(r"\b[A-ZÀ-Þ]{3,}\b")
KINDS = tuple(LEXICONS)


def _plain(word: str) -> str:
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))


KIND_OF = {word: k for k, kind in enumerate(KINDS) for word in LEXICONS[kind].split()}
FEATURES = (
    *[f"{kind}_rate" for kind in KINDS],
    *[f"{kind}_count" for kind in KINDS],
    "learned_rate",
    "learned_count",
    "learned_weight",
    "distinct_hits",
    "second_person_rate",
    "nearness",
    "nearest",
    "capitals",
    "shouted",
    "exclamations",
    "questions",
    "mark_runs",
    "marks",
    "disguised",
    "disguised_hits",
    "spaced",
    "drawn_out",
    "length",
)


def kind_of(word: str) -> int | None:
    """The lexicon a word stands in, with accents taken away."""
    found = KIND_OF.get(word)
    return found if found is not None or word.isascii() else KIND_OF.get(_plain(word))


def windows(text: str) -> Iterator[str]:
    """A whole text in parts that end at a blank, or after twice the size without one."""
    start = 0
    while start < len(text):
        end = start + WINDOW
        if end < len(text):
            blank = text.find(" ", end, end + WINDOW)
            end = blank if blank >= 0 else end + WINDOW
        yield text[start:end]
        start = end


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _runs(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    edges = np.flatnonzero(np.diff(same, prepend=False, append=False))
    return edges[::2], edges[1::2]


def _drawn_out(low: str, points: np.ndarray) -> tuple[int, int]:
    """Letters that stand three times or more in a row, and lexicon words that they hide."""
    starts, ends = _runs((points[1:] == points[:-1]) if len(points) > 2 else np.zeros(0, bool))
    drawn = hits = 0
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        if end - start < 2 or not low[start].isalpha():
            continue
        drawn += 1
        end += 1
        while start and end - start <= 64 and low[start - 1].isalpha():
            start -= 1
        while end < len(low) and end - start <= 64 and low[end].isalpha():
            end += 1
        hits += kind_of(DRAWN_OUT.sub(r"\1", low[start:end])) is not None
    return drawn, hits


def _shouted(part: str, upper: np.ndarray) -> int:
    """Words of three letters or more that are all capitals."""
    starts, ends = _runs(upper)
    long = ends - starts >= 3
    return sum(
        not (start and (part[start - 1].isalnum() or part[start - 1] == "_"))
        and not (end < len(part) and (part[end].isalnum() or part[end] == "_"))
        for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True)
    )


class Words(dict):
    """Kind and learned weight of words: None for most, kind -1 for a second person.

    Words once looked up are kept, up to a number."""

    LIMIT = 200_000

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> tuple[int | None, float] | None:
        if len(self) >= self.LIMIT:
            self.clear()
        small, middle, large = BEGINNINGS
        lexicon = self.lexicon
        own = lexicon.get(word[:large]) or lexicon.get(word[:middle]) or lexicon.get(word[:small])
        kind = kind_of(word)
        about = None
        if word in SECOND_PERSON:
            about = (-1, 0.0)
        elif own or kind is not None:
            about = (kind, own or 0.0)
        self[word] = about
        return about


def features(text: str, known: "Words | dict[str, float]") -> np.ndarray:
    """One number for each of ``FEATURES``, over the whole text; ``known`` tells words, or is
    the lexicon of learned beginnings and their weights."""
    if not isinstance(known, Words):
        known = Words(known)
    counts = np.zeros(len(KINDS))
    learned, weight = 0, 0.0
    distinct: set[str] = set()
    hits_at: list[int] = []
    persons_at: list[int] = []
    words = letters = capitals = shouted = 0
    disguised = hidden = spaced = drawn = 0
    for part in windows(text):
        low = part.lower()
        found = WORD.findall(low)
        telling = {word: about for word in set(found) if (about := known[word])}
        if telling:
            for k, word in enumerate(found):
                if word not in telling:
                    continue
                kind, own = telling[word]
                if kind == -1:
                    persons_at.append(words + k)
                    continue
                if kind is not None:
                    counts[kind] += 1
                if own:
                    learned += 1
                    weight += own
                distinct.add(word)
                hits_at.append(words + k)
        words += len(found)
        letters += sum(map(len, found))
        points = _points(low)
        if len(low) == len(part):
            upper = _points(part) != points
            capitals += int(np.count_nonzero(upper))
            shouted += _shouted(part, upper)
        else:  # some letter has a longer small form
            capitals += sum(map(str.isupper, part))
            shouted += len(SHOUTED.findall(part))
        for match in DISGUISED.finditer(low):
            disguised += 1
            hidden += kind_of(match.group().translate(DISGUISES)) is not None
        for match in SPACED.finditer(low):
            spaced += 1
            hidden += kind_of(re.sub(r"[ .*_-]", "", match.group())) is not None
        more = _drawn_out(low, points)
        drawn += more[0]
        hidden += more[1]
    reach = np.full(len(hits_at), float(REACH))
    if hits_at and persons_at:
        hits, persons = np.array(hits_at), np.array([-REACH, *persons_at, words + REACH])
        after = np.searchsorted(persons, hits)
        reach = np.minimum(hits - persons[after - 1], persons[after] - hits).clip(max=REACH)
    of_words, of_size = 1 / max(1, words), 1 / max(1, len(text))
    runs = text.count("!!") + text.count("??") + text.count("!?") + text.count("?!")
    marks = len(text) - letters - sum(text.count(blank) for blank in " \n\t\r")
    return np.array(
        [
            *(counts * of_words),
            *np.log1p(counts),
            learned * of_words,
            np.log1p(learned),
            weight * of_words,
            np.log1p(len(distinct)),
            len(persons_at) * of_words,
            float((1 / (1 + reach)).sum()) if len(reach) else 0.0,
            float(reach.min()) if len(reach) else 2.0 * REACH,
            capitals / max(1, letters),
            shouted * of_words,
            text.count("!") * of_size,
            text.count("?") * of_size,
            runs * of_size,
            marks * of_size,
            disguised * of_words,
            np.log1p(hidden),
            spaced * of_words,
            drawn * of_words,
            np.log1p(words),
        ]
    )


def matrix(texts: list[str], known: Words) -> np.ndarray:
    rows = [features(text, known) for text in texts]
    return np.array(rows).reshape(len(texts), len(FEATURES))


# -- the learned lexicon -------------------------------------------------------------


def beginnings(text: str) -> set[str]:
    """The beginnings of all words of a whole text; a shorter word has none."""
    found: set[str] = set()
    for part in windows(text):
        words = set(WORD.findall(part.lower()))
        for size in BEGINNINGS:
            found.update(word[:size] for word in words if len(word) >= size)
    return found


def candidates(sample: DataFrame) -> list[tuple[str, np.ndarray]]:
    """Beginnings and how many sampled rows hold them, by label and fold.

    Only those that are commoner among rows of label 1 reach the driver, the ones with most
    rows first, ``CANDIDATES`` at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames.slices(batches):
            counts: Counter[tuple[str, int]] = Counter()
            place = [
                label * FOLDS + fold
                for label, fold in zip(
                    batch.column("label").to_pylist(), batch.column("fold").to_pylist(), strict=True
                )
            ]
            for own, text in zip(place, batch.column("text").to_pylist(), strict=True):
                counts.update((beginning, own) for beginning in beginnings(text))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([beginning for beginning, _ in counts], pa.string()),
                    pa.array([own for _, own in counts], pa.int32()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["beginning", "place", "n"],
            )

    rows = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(rows) < 2:
        return []
    counted = sample.select("text", "label", "fold").mapInArrow(
        run, "beginning string, place int, n bigint"
    )
    sums = [
        F.coalesce(F.sum(F.when(F.col("place") == k, F.col("n"))), F.lit(0)).alias(f"n{k}")
        for k in range(2 * FOLDS)
    ]
    without, within = (
        sum((F.col(f"n{label * FOLDS + fold}") for fold in range(FOLDS)), F.lit(0))
        for label in (0, 1)
    )
    chosen = (
        counted.groupBy("beginning")
        .agg(*sums)
        .where(within >= LEAST_ROWS)
        .where((within + 0.5) * rows[0] >= LEAST_RATIO * (without + 0.5) * rows[1])
        .orderBy(F.desc(within - without * rows[1] / rows[0]), "beginning")
        .limit(CANDIDATES)
    )
    return [
        (r.beginning, np.array([r[f"n{k}"] for k in range(2 * FOLDS)]).reshape(2, FOLDS))
        for r in chosen.collect()
    ]


def lexicon_of(
    found: list[tuple[str, np.ndarray]], rows: np.ndarray, without: int | None = None
) -> dict[str, float]:
    """Weights of the beginnings with most evidence, counted over all folds or all but one.

    ``rows`` counts the sampled rows by label and fold.  A longer beginning stays beside a
    shorter one only if it has more evidence; of two that are as good the longer one stays.
    A word weighs what its longest beginning weighs."""
    folds = [fold for fold in range(FOLDS) if fold != without]
    no, yes = rows[:, folds].sum(axis=1)
    if not no or not yes:
        return {}
    scored = []
    for beginning, counts in found:
        out, within = counts[:, folds].sum(axis=1)
        ratio = (within + 0.5) * no / ((out + 0.5) * yes)
        if within < LEAST_ROWS or ratio < LEAST_RATIO:
            continue
        evidence = 0.0
        for seen, total in ((within, yes), (out, no)):
            expected = (within + out) * total / (yes + no)
            evidence += 2 * seen * np.log(seen / expected) if seen else 0
            left = total - seen
            evidence += 2 * left * np.log(left / (total - expected)) if left else 0
        if evidence >= LEAST_EVIDENCE:
            scored.append((-evidence, -len(beginning), beginning, float(np.log(ratio))))
    kept: dict[str, float] = {}
    told: set[tuple[float, str]] = set()
    for evidence, _, beginning, weight in sorted(scored):
        covered = any(beginning[:size] in kept for size in BEGINNINGS)
        if len(kept) < LEXICON_SIZE and not covered and (evidence, beginning) not in told:
            kept[beginning] = weight
            told.update((evidence, beginning[:size]) for size in BEGINNINGS)
    return kept


# -- learning and scoring ------------------------------------------------------------


class Model:
    def __init__(self, lexicon: dict[str, float], trees: boosting.Calibrated):
        self.lexicon, self.trees = lexicon, trees

    def scores(self, texts: list[str], known: Words) -> np.ndarray:
        return self.trees.scores(matrix(texts, known))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = MAX_ROWS,
) -> Model:
    """A model from labelled rows that are not held out.

    At most ``max_rows`` identifiers are learned from, as many of each label; only
    bounded counts of word beginnings and their features reach the driver.  Rows weigh as much as those of their label that were left
    out, so scores keep to the share of label 1.  Labels other than 0 and 1, null texts and
    a document with contradicting labels teach nothing; of a repeated identifier the least
    text counts.  Without both labels every text scores 0.5."""
    rows = frames.narrow(docs, doc_id=id_col, text=text_col).where(F.col("text").isNotNull())
    marked = sampling.agreed(labels, id_col, label_col)
    present = marked.join(rows.select("doc_id"), "doc_id", "left_semi")
    there = {r["label"]: r["count"] for r in present.groupBy("label").count().collect()}
    chosen = sampling.bounded(present, "label", max_rows // 2)
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    sample = frames.staged(
        sampling.one_row_each(rows.join(F.broadcast(chosen), "doc_id")).select("text", "label", fold),
        "toxicity-sample",
    )
    sizes = np.zeros((2, FOLDS), dtype=np.int64)
    for r in sample.groupBy("label", "fold").count().collect():
        sizes[r["label"], r["fold"]] = r["count"]
    found = candidates(sample)
    lexicons = [lexicon_of(found, sizes, fold) for fold in range(FOLDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Words(lexicon) for lexicon in lexicons]
        for batch in frames.slices(batches):
            described = [
                features(text, known[fold]).tobytes()
                for text, fold in zip(
                    batch.column("text").to_pylist(), batch.column("fold").to_pylist(), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("fold"), pa.array(described, pa.binary())],
                ["label", "fold", "features"],
            )

    table = (
        sample.mapInArrow(run, "label int, fold int, features binary")
        .toArrow()
        .sort_by([("label", "ascending"), ("fold", "ascending"), ("features", "ascending")])
    )
    held = np.array([np.frombuffer(f.as_buffer(), np.float64) for f in table.column("features")])
    marks = np.array(table.column("label").to_pylist(), dtype=np.int64)
    taken = np.maximum(sizes.sum(axis=1), 1)
    share = np.array([there.get(label, 0) for label in (0, 1)]) / taken
    trees = boosting.Calibrated(
        held.reshape(len(marks), len(FEATURES)),
        marks,
        share[marks],
        np.array(table.column("fold").to_pylist(), dtype=np.int64),
    )
    return Model(lexicon_of(found, sizes), trees)


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and score of each row.

    A null text counts as empty, and an empty one scores by its features like any other.
    Null identifiers and repeated rows are kept as they are, an empty table gives an empty
    result, and extra columns are ignored."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = frames.texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(held.value.lexicon)
        for batch in frames.slices(batches):
            found = held.value.scores(batch.column("text").to_pylist(), known)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double")
