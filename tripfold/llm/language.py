"""Language identification in two levels: the family, then pairs of its languages.

The family comes from linear support vector machines, one against the rest; inside a
family, one machine for each pair of languages votes.  Features are hashed runs of one to
three characters of the lower-cased whole text."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm import frames, ngrams, sampling

#: Families of common languages; any other language is a family of its own.
FAMILIES = {
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "germanic": ("en", "de", "nl", "sv", "da", "no", "af"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr"),
}
UNDETERMINED = "und"
SIZES = (1, 2, 3)
BUCKETS = 4096
MAX_ROWS = 6_000  # learned from, over all languages
EPOCHS = 12
SHARPNESS = 4.0  # from margins to scores


def family_of(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), language)


def features(text: str) -> np.ndarray:
    counts = ngrams.character_counts(text.lower(), SIZES, BUCKETS)
    weights = np.sqrt(counts, dtype=np.float32)
    norm = np.linalg.norm(weights)
    return weights / norm if norm else weights


def has_letters(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit_machine(
    rows: np.ndarray, chosen: np.ndarray, signs: np.ndarray, seed: int
) -> np.ndarray:
    """A linear support vector machine by averaged subgradient steps on balanced classes.

    It learns from the ``chosen`` rows, which stay in half precision but for the few of
    each step.  The last weight is the bias."""
    random = np.random.default_rng(seed)
    share = np.where(signs > 0, (signs > 0).mean(), (signs < 0).mean())
    importance = 0.5 / share
    weights = np.zeros(rows.shape[1] + 1)
    mean, steps, decay = np.zeros_like(weights), 0, 1e-4
    for epoch in range(EPOCHS):
        order = random.permutation(len(chosen))
        for start in range(0, len(order), 64):
            part = order[start : start + 64]
            x, y = np.ones((len(part), len(weights)), dtype=np.float32), signs[part]
            x[:, :-1] = rows[chosen[part]]
            pull = np.where(y * (x @ weights) < 1, y * importance[part], 0)
            rate = 2.0 / (1 + 0.05 * steps)
            weights = (1 - rate * decay) * weights + rate * (pull @ x) / len(part)
            steps += 1
            if epoch >= EPOCHS // 2:
                mean += weights
    return (mean / np.linalg.norm(mean) * np.linalg.norm(weights) if mean.any() else mean).astype(
        np.float32
    )


class Model:
    """Machines of the families and of the pairs of languages within each."""

    def __init__(self, rows: np.ndarray, languages: list[str]):
        labels = np.array(languages)
        self.languages = sorted(set(languages))
        groups = np.array([family_of(language) for language in languages])
        self.families = sorted(set(groups))
        self.members = {
            f: [language for language in self.languages if family_of(language) == f]
            for f in self.families
        }
        self.family_machines = np.array(
            [
                fit_machine(rows, np.arange(len(rows)), np.where(groups == f, 1.0, -1.0), k)
                for k, f in enumerate(self.families if len(self.families) > 1 else [])
            ],
            dtype=np.float32,
        )
        self.pair_machines = {}
        for members in self.members.values():
            for one, other in combinations(members, 2):
                of_pair = np.flatnonzero((labels == one) | (labels == other))
                signs = np.where(labels[of_pair] == one, 1.0, -1.0)
                self.pair_machines[one, other] = fit_machine(rows, of_pair, signs, 0)

    def predict(self, text: str) -> tuple[str, float]:
        """Language and score; the score multiplies the confidences of both levels."""
        if not self.languages or not has_letters(text):
            return UNDETERMINED, 0.0
        row = np.append(features(text), np.float32(1))
        family, score = self.families[0], 1.0
        if len(self.families) > 1:
            margins = self.family_machines @ row
            best = int(np.argmax(margins))
            others = np.delete(margins, best).max()
            family, score = self.families[best], _confidence((margins[best] - others) / 2)
        members = self.members[family]
        if len(members) == 1:
            return members[0], score
        wins = dict.fromkeys(members, 0)
        margin = dict.fromkeys(members, 0.0)
        for (one, other), machine in self.pair_machines.items():
            if one in wins:
                value = float(machine @ row)
                wins[one if value >= 0 else other] += 1
                margin[one] += value
                margin[other] -= value
        best = max(members, key=lambda m: (wins[m], margin[m], m))
        return best, score * _confidence(margin[best] / (len(members) - 1))


def _confidence(margin: float) -> float:
    return float(1 / (1 + np.exp(-SHARPNESS * np.clip(margin, -10, 10))))


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_rows: int = MAX_ROWS,
) -> Model:
    """A model from rows with a language that are not held out.

    At most ``max_rows`` identifiers are learned from, as many of each language, and one row
    of each, that of the least language and text; only their feature counts reach the
    driver, 2 bytes a bucket.  No labelled row gives a model that determines nothing."""
    rows = frames.narrow(docs, doc_id=id_col, text=text_col, lang=lang_col)
    labelled = rows.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~sampling.held_out()
    )
    count = labelled.select("lang").distinct().count()
    chosen = sampling.bounded(labelled.select("doc_id", "lang"), "lang", max_rows // max(1, count))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames.slices(batches):
            rows = [
                features(text).astype(np.float16).tobytes()
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(rows, pa.binary())], ["lang", "features"]
            )

    kept = F.broadcast(chosen.withColumnRenamed("doc_id", "__id"))
    sample = labelled.join(kept.drop("lang"), F.col("doc_id").eqNullSafe(F.col("__id")))
    sample = sampling.one_row_each(sample.select("doc_id", "lang", "text")).select("text", "lang")
    table = sample.mapInArrow(run, "lang string, features binary").toArrow()
    table = table.sort_by([("lang", "ascending"), ("features", "ascending")])
    matrix = np.empty((table.num_rows, BUCKETS), dtype=np.float16)
    for k, row in enumerate(table.column("features")):
        matrix[k] = np.frombuffer(row.as_buffer(), dtype=np.float16)
    languages = table.column("lang").to_pylist()
    del table
    pa.default_memory_pool().release_unused()
    return Model(matrix, languages)


def identified(
    docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """One row per input row: ``rest``, a struct of its columns or of those ``keep`` names,
    lang_pred and score.

    Null, empty and letterless texts give ``und`` with score 0.  Null identifiers and
    repeated rows are kept as they are, and an empty table gives an empty result."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def compute(texts: list[str]) -> list[pa.Array]:
        found = [held.value.predict(text) for text in texts]
        return [
            pa.array([language for language, _ in found], pa.string()),
            pa.array([score for _, score in found], pa.float64()),
        ]

    return frames.beside(docs, text_col, compute, "lang_pred string, score double", keep)


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, lang_pred and score of each row, see ``identified``; extra columns are
    ignored."""
    narrow = frames.narrow(docs, doc_id=id_col, text=text_col)
    found = identified(narrow, model, keep=["doc_id"])
    return found.select("rest.doc_id", "lang_pred", "score")
