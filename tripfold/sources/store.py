"""Tables by month: atomic replacement, pruned reads, status and events.

A month is written to a folder of its own that no table reads yet, and then the catalog's
partition is pointed at that folder.  A write that fails leaves the old month as it was."""

import hashlib
import threading
import uuid
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructField, StructType, TimestampType

from tripfold.config import FeedConfig, Layer
from tripfold.functions.months import check_month
from tripfold.sources.dictionary import with_comments

#: Columns of the control tables (fixed values).
CONTROL = {
    "run_events": (
        "source_month STRING, run_id STRING, service STRING, status STRING, "
        "event_time TIMESTAMP, error_type STRING"
    ),
    "month_status": (
        "run_id STRING, status STRING, input_count BIGINT, accepted_count BIGINT, "
        "rejected_count BIGINT, unusual_count BIGINT, updated_at TIMESTAMP, "
        "source_month STRING"
    ),
    "reprocessing_evidence": (
        "test_run_id STRING, source_month STRING, stage STRING, recorded_at TIMESTAMP, "
        "evidence_json STRING"
    ),
}
ONE_ROW_A_MONTH = {"month_status"}
#: Formats whose partitions may lie anywhere; others replace a partition in their own way.
POINTED_FORMATS = {"parquet", "orc"}
#: Partitions of this table are folders that were replaced, the last one of each month.
REPLACED = "replaced_folders"

#: Decimal digits of whole numbers by type, and of those that floating types hold exactly.
WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
EXACT_IN = {"float": ("tinyint", "smallint"), "double": ("tinyint", "smallint", "int", "float")}


def holds(target: DataType, source: DataType) -> bool:
    """Whether every value of the source type survives in the target type."""
    to, of = target.simpleString(), source.simpleString()
    if to == of or of == "void" or of in EXACT_IN.get(to, ()):
        return True
    if isinstance(target, DecimalType):
        scale, whole = (
            (source.scale, source.precision - source.scale)
            if isinstance(source, DecimalType)
            else (0, WHOLE_DIGITS.get(of, 99))
        )
        return target.scale >= scale and target.precision - target.scale >= whole
    return to in WHOLE_DIGITS and WHOLE_DIGITS[to] > WHOLE_DIGITS.get(of, 99)


def conformed(frame: DataFrame, schema: StructType, target: str) -> dict[str, Column]:
    """For each column of a table the frame's column that fits it.

    Names match without regard to case, since files spell them differently.  A name that
    then fits several columns, a missing or further column, and a type whose values the
    table's type may not hold are refused: nothing is rounded or cut on the way in."""
    given: dict[str, list[str]] = {}
    for name in frame.columns:
        given.setdefault(name.lower(), []).append(name)
    twice = sorted(name for names in given.values() if len(names) > 1 for name in names)
    if twice:
        raise ValueError(f"{target}: columns differ by case alone: {twice}")
    unexpected = set(given) ^ {field.name.lower() for field in schema}
    if unexpected:
        raise ValueError(f"{target}: columns differ from the table: {sorted(unexpected)}")
    columns, narrow = {}, []
    for field in schema:
        own = frame.schema[given[field.name.lower()][0]]
        if not holds(field.dataType, own.dataType):
            kinds = f"{own.dataType.simpleString()} into {field.dataType.simpleString()}"
            narrow.append(f"{field.name}: {kinds}")
        columns[field.name] = F.col(f"`{own.name}`").cast(field.dataType).alias(field.name)
    if narrow:
        raise ValueError(f"{target}: types that could lose values: {narrow}")
    return columns


def quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


class MonthStore:
    def __init__(self, spark: SparkSession, config: FeedConfig):
        self.spark = spark
        self.config = config

    # -- schemas and control tables ------------------------------------------------

    def bootstrap(self) -> None:
        """Databases of all layers, and the control tables."""
        for layer in Layer:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.config.name(layer)}")
        for name, columns in CONTROL.items():
            by = "PARTITIONED BY (source_month)" if name in ONE_ROW_A_MONTH else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.config.name('ops', name)} ({columns}) "
                f"USING {self.config.table_format} {by}"
            )
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.config.name('ops', REPLACED)} "
            f"(unread INT, owner STRING, version STRING) "
            f"USING {self.config.table_format} PARTITIONED BY (owner, version)"
        )

    def record(self, name: str, month: str, **values: str | int | None) -> None:
        """One row into a control table: one more in a log, the only one in a state table.

        The row follows the table's declared columns.  What is not given is NULL, and a
        time that is not given is now."""
        given = {"source_month": check_month(month), **values}
        fields = StructType.fromDDL(CONTROL[name]).fields
        unknown = set(given) - {field.name for field in fields}
        if unknown:
            raise ValueError(f"{name} has no columns {sorted(unknown)}")

        def value(field: StructField) -> Column:
            now = field.dataType == TimestampType() and field.name not in given
            held = F.current_timestamp() if now else F.lit(given.get(field.name))
            return held.cast(field.dataType).alias(field.name)

        row = self.spark.range(1).select(*map(value, fields))
        if name in ONE_ROW_A_MONTH:
            self.replace_month(row, "ops", name, month)
        else:
            self.append(row, "ops", name)

    # -- reads ---------------------------------------------------------------------

    def exists(self, layer: str, name: str) -> bool:
        return self.spark.catalog.tableExists(self.config.name(layer, name))

    def table(self, layer: str, name: str, *months: str) -> DataFrame:
        """A table, or the given months of it; the literals prune to their partitions."""
        whole = self.spark.table(self.config.name(layer, name))
        if not months:
            return whole
        return whole.where(F.col("source_month").isin(*map(check_month, months)))

    def months(self, layer: str, name: str) -> list[str]:
        """The months a table has partitions of, from the catalog alone."""
        shown = self.spark.sql(f"SHOW PARTITIONS {self.config.name(layer, name)}").collect()
        return sorted({row[0].split("/")[0].partition("=")[2] for row in shown})

    # -- writes --------------------------------------------------------------------

    def replace_month(
        self, frame: DataFrame, layer: str, name: str, month: str, within: tuple[str, ...] = ()
    ) -> None:
        """Replace everything the table holds for one month, and nothing else.

        An empty frame empties the month.  ``within`` names further partition columns below
        the month, which are replaced as a whole too.  A row of any other month fails the
        write, and so does a column whose values the table's type may not hold; see
        ``conformed``.

        Readers see the old month until all new files are complete.  With ``within`` each
        partition is pointed at its folder in turn, so between two of them a reader may see
        one old and one new; the month's status is not SUCCESS then."""
        check_month(month)
        target = self.config.name(layer, name)
        fits = F.col("source_month").eqNullSafe(F.lit(month))
        frame = frame.where(
            F.when(fits, True).otherwise(
                F.raise_error(F.lit(f"row outside month {month} for {target}")).cast("boolean")
            )
        )
        values = [c for c in frame.columns if c not in ("source_month", *within)]
        if not self.spark.catalog.tableExists(target):
            empty = frame.select(*values, *within, "source_month").limit(0)
            (
                with_comments(empty)
                .write.format(self.config.table_format)
                .partitionBy("source_month", *within)
                .saveAsTable(target)
            )
        columns = conformed(frame, self.spark.table(target).schema, target)
        ordered = [c for c in columns if c not in ("source_month", *within)]
        rows = frame.select(*[columns[name] for name in (*ordered, *within)])
        if self.config.table_format in POINTED_FORMATS:
            folder = self.fresh_folder(layer, name, f"source_month={month}")
            rows.write.format(self.config.table_format).partitionBy(*within).save(folder)
            self._point(target, month, self._parts(rows, folder, within))
            return
        partition = ", ".join([f"source_month = '{month}'", *within])
        with self._static_overwrite():
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {target} PARTITION ({partition}) SELECT * FROM {{rows}}",
                rows=rows,
            )

    def fresh_folder(self, layer: str, name: str, *below: str) -> str:
        """A folder beside a table's own that nothing was written to before."""
        database = self.spark.catalog.getDatabase(self.config.name(layer)).locationUri
        return "/".join([database, f"{name}__parts", *below, uuid.uuid4().hex])

    def _parts(self, rows: DataFrame, folder: str, within: tuple[str, ...]) -> dict[str, str]:
        """Folders of the partitions that a write made, by what follows the month."""
        if not within:
            return {"": folder}
        reader = self.spark.read.schema(rows.schema).format(self.config.table_format)
        below = {f.rsplit("/", 1)[0].split(folder.rsplit("/", 1)[1], 1)[1].strip("/")
                 for f in reader.load(folder).inputFiles()}
        return {part: f"{folder}/{part}" for part in below}

    def _point(self, target: str, month: str, parts: dict[str, str]) -> None:
        """Make the catalog read the month from these folders, and from no other."""

        def spec(part: str) -> str:
            pairs = [p.split("=", 1) for p in [f"source_month={month}", *part.split("/")] if p]
            return ", ".join(f"`{key}` = '{quoted(unquote(value))}'" for key, value in pairs)

        shown = self.spark.sql(f"SHOW PARTITIONS {target} PARTITION (source_month = '{month}')")
        held = {row[0].partition("/")[2] for row in shown.collect()}
        before = {part: self._location(target, spec(part)) for part in held}
        for part, folder in parts.items():
            known = f"PARTITION ({spec(part)}) SET LOCATION '{folder}'"
            new = f"ADD PARTITION ({spec(part)}) LOCATION '{folder}'"
            self.spark.sql(f"ALTER TABLE {target} {known if part in held else new}")
        for part in held - set(parts):
            # Dropping deletes what a partition points at, and old readers may still need that.
            nothing = f"{self._location(target, spec(part))}-left"
            self.spark.sql(f"ALTER TABLE {target} PARTITION ({spec(part)}) SET LOCATION '{nothing}'")
            self.spark.sql(f"ALTER TABLE {target} DROP PARTITION ({spec(part)})")
        self.retire(f"{target} {month}", before.values())

    def _location(self, target: str, spec: str) -> str:
        told = self.spark.sql(f"DESCRIBE TABLE EXTENDED {target} PARTITION ({spec})").collect()
        return next(row.data_type for row in told if row.col_name == "Location")

    def retire(self, owner: str, folders) -> None:
        """Delete the folders this owner retired before; keep these until the next time, for
        readers that are under way.

        Dropping a partition of a managed table deletes its folder, wherever it lies."""
        trash = self.config.name("ops", REPLACED)
        owner = hashlib.sha256(owner.encode()).hexdigest()
        old = self.spark.sql(f"SHOW PARTITIONS {trash} PARTITION (owner = '{owner}')").collect()
        for (shown,) in old:
            version = shown.rpartition("=")[2]
            self.spark.sql(
                f"ALTER TABLE {trash} DROP PARTITION (owner = '{owner}', version = '{version}')"
            )
        added = " ".join(
            f"PARTITION (owner = '{owner}', version = '{uuid.uuid4().hex}') LOCATION '{folder}'"
            for folder in folders
        )
        if added:
            self.spark.sql(f"ALTER TABLE {trash} ADD {added}")

    _overwriting = threading.RLock()

    @contextmanager
    def _static_overwrite(self):
        """Dynamic mode would keep the old rows of a partition that is now empty.  The mode is
        the session's, so one write at a time may hold it."""
        key = "spark.sql.sources.partitionOverwriteMode"
        with self._overwriting:
            before = self.spark.conf.get(key)
            self.spark.conf.set(key, "static")
            try:
                yield
            finally:
                self.spark.conf.set(key, before)

    def replace_month_via_staging(
        self, frame: DataFrame, layer: str, name: str, month: str
    ) -> None:
        """Replace a month with a frame computed from the very table it replaces.

        The frame is written to a table of its own first, then read back."""
        staging = self.config.name("ops", f"staging_{layer}_{name}")
        frame.write.format(self.config.table_format).mode("overwrite").saveAsTable(staging)
        self.replace_month(self.spark.table(staging), layer, name, month)

    def replace_table(
        self, frame: DataFrame, layer: str, name: str, rebalance: bool = False
    ) -> DataFrame:
        """Create or replace a whole table; months become partitions where present.

        ``rebalance`` is for aggregates: their rows are spread by group key, so without
        it every task would write a small file into every month.  Adaptive execution
        merges small months into one task and splits a large one over several."""
        target = self.config.name(layer, name)
        if rebalance and "source_month" in frame.columns:
            frame = frame.hint("rebalance", "source_month")
        writer = with_comments(frame).write.format(self.config.table_format).mode("overwrite")
        if "source_month" in frame.columns:
            writer = writer.partitionBy("source_month")
        writer.saveAsTable(target)
        return self.spark.table(target)

    def replace_view(self, layer: str, name: str, query: str) -> DataFrame:
        target = self.config.name(layer, name)
        self.spark.sql(f"CREATE OR REPLACE VIEW {target} AS {query}")
        return self.spark.table(target)

    def append(self, frame: DataFrame, layer: str, name: str) -> None:
        """Add rows to a control table."""
        target = self.config.name(layer, name)
        frame.select(*self.spark.table(target).columns).write.insertInto(target)
