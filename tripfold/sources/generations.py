"""Generations of gold: tables that share the folders of the months they agree on.

A generation is a set of tables of its own name.  Its month partitions point at folders, and
a month that did not change points where the generation before it points, so a new
generation writes the changed months alone.  Which run of a month a folder was made from is
kept in a control table.  Public names are views of one generation."""

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.config import Layer
from tripfold.sources.dictionary import with_comments
from tripfold.sources.store import MonthStore, quoted

PARTS = "gold_parts"
PARTS_COLUMNS = "model STRING, source_month STRING, run_id STRING, folder STRING"
KEPT = 3  # generations that stay readable, the published one among them
ADDED_AT_ONCE = 100  # partitions a statement


@dataclass(frozen=True)
class Part:
    """Where a month of a model lies, and the run of the month it was made from; a model
    without months has one part, whose month is NULL."""

    model: str
    source_month: str | None
    run_id: str | None
    folder: str


class Generation:
    """One generation's parts, by model and month; its tables once it is declared."""

    def __init__(self, store: MonthStore, name: str, parts: Iterable[Part] = ()):
        self.store, self.name = store, name
        self.parts = {(part.model, part.source_month): part for part in parts}

    def runs(self, model: str) -> dict[str, str]:
        """The run each month of a model was made from."""
        return {p.source_month: p.run_id for p in self.parts.values() if p.model == model}

    def table_name(self, model: str) -> str:
        return self.store.config.name(Layer.GOLD, f"{model}_{self.name}")

    def table(self, model: str) -> DataFrame:
        return self.store.spark.table(self.table_name(model))

    def has(self, model: str) -> bool:
        return any(held == model for held, _ in self.parts)

    def keep(self, other: "Generation", model: str, months: Iterable[str]) -> None:
        """Take over months of a model as another generation has them."""
        for month in months:
            self.parts[model, month] = other.parts[model, month]

    def write(
        self, frame: DataFrame, model: str, runs: dict[str, str] | None = None, rebalance: bool = True
    ) -> DataFrame:
        """Write the months of a model that ``runs`` names, or a model without months, and
        declare the table over these and the months it keeps.

        ``rebalance`` is for aggregates: their rows are spread by group key, so without it
        every task would write a small file into every month.  Adaptive execution merges
        small months into one task and splits a large one over several."""
        store, spark = self.store, self.store.spark
        kind = store.config.table_format
        by = [] if runs is None else ["source_month"]
        folder = store.fresh_folder(Layer.GOLD, model)
        if runs is None or runs:
            if by and rebalance:
                frame = frame.hint("rebalance", "source_month")
            frame.write.format(kind).partitionBy(*by).save(folder)
        for month, run_id in ({None: None} if runs is None else runs).items():
            below = f"/source_month={month}" if by else ""
            self.parts[model, month] = Part(model, month, run_id, folder + below)
        columns = [c for c in frame.columns if c not in by]
        fields = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}"
            + (f" COMMENT '{quoted(told)}'" if (told := f.metadata.get("comment")) else "")
            for f in with_comments(frame.select(*columns, *by)).schema
        )
        name = self.table_name(model)
        root = folder if not by else store.fresh_folder(Layer.GOLD, model)
        spark.sql(
            f"CREATE TABLE {name} ({fields}) USING {kind} "
            + ("PARTITIONED BY (source_month) " if by else "")
            + f"LOCATION '{root}'"
        )
        months = sorted(m for held, m in self.parts if held == model and m is not None)
        for start in range(0, len(months), ADDED_AT_ONCE):
            some = " ".join(
                f"PARTITION (source_month = '{m}') LOCATION '{self.parts[model, m].folder}'"
                for m in months[start : start + ADDED_AT_ONCE]
            )
            spark.sql(f"ALTER TABLE {name} ADD {some}")
        return spark.table(name)


class Generations:
    """All generations of a store, and which of them the public names show."""

    def __init__(self, store: MonthStore):
        self.store, self.spark = store, store.spark
        self.control = store.config.name(Layer.OPS, PARTS)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.control} ({PARTS_COLUMNS}, generation STRING) "
            f"USING {store.config.table_format} PARTITIONED BY (generation)"
        )

    def names(self) -> list[str]:
        """Oldest first; names begin with a running number."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.control}").collect()
        return sorted(row[0].partition("=")[2] for row in rows)

    def load(self, name: str) -> Generation:
        rows = self.spark.table(self.control).where(F.col("generation") == name).collect()
        return Generation(
            self.store, name, [Part(r.model, r.source_month, r.run_id, r.folder) for r in rows]
        )

    def shown(self, models: Iterable[str]) -> dict[str, str]:
        """The generation each public model shows; models without a public name are left out."""
        found = {}
        for model in models:
            if self.store.exists(Layer.GOLD, model):
                view = self.store.config.name(Layer.GOLD, model)
                row = self.spark.sql(f"SHOW TBLPROPERTIES {view} ('generation')").first()
                found[model] = row.value
        return found

    def published(self, models: Iterable[str]) -> Generation | None:
        """The generation that all public models show, or None while they differ."""
        models = tuple(models)
        found = self.shown(models)
        if len(found) < len(models) or len(set(found.values())) != 1:
            return None
        name = next(iter(found.values()))
        return self.load(name) if name in self.names() else None

    def begin(self) -> Generation:
        names = self.names()
        number = int(names[-1].split("_")[0]) + 1 if names else 1
        return Generation(self.store, f"{number:06d}_{uuid.uuid4().hex[:8]}")

    def record(self, generation: Generation) -> None:
        rows = [
            (p.model, p.source_month, p.run_id, p.folder, generation.name)
            for p in generation.parts.values()
        ]
        frame = self.spark.createDataFrame(rows, f"{PARTS_COLUMNS}, generation STRING")
        frame.coalesce(1).write.insertInto(self.control)

    def publish(self, generation: Generation, models: Iterable[str]) -> None:
        """Point the public names at a generation, then give up those that nothing shows and
        that are not among the newest."""
        models = tuple(models)
        for model in models:
            view = self.store.config.name(Layer.GOLD, model)
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {view} "
                f"TBLPROPERTIES ('generation' = '{generation.name}') "
                f"AS SELECT * FROM {generation.table_name(model)}"
            )
        shown = set(self.shown(models).values())
        names = self.names()
        for name in names[:-KEPT]:
            if name not in shown:
                self._give_up(self.load(name))

    def _give_up(self, generation: Generation) -> None:
        others = self.spark.table(self.control).where(F.col("generation") != generation.name)
        self.discard(generation, {row.folder for row in others.select("folder").collect()})
        self.spark.sql(f"ALTER TABLE {self.control} DROP PARTITION (generation = '{generation.name}')")

    def discard(self, generation: Generation, wanted: Iterable[str]) -> None:
        """Drop a generation's tables, and delete its folders but those that others want.

        The tables' data lies outside the catalog's care, so dropping them deletes none."""
        for model in {part.model for part in generation.parts.values()}:
            self.spark.sql(f"DROP TABLE IF EXISTS {generation.table_name(model)}")
        own = {part.folder for part in generation.parts.values()} - set(wanted)
        for folders in (own, ()):  # retired, then deleted
            self.store.retire(f"generation {generation.name}", folders)
