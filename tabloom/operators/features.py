"""Feature tables, training sets by key lookup, and scoring by key lookup."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.joins import (
    ROWS_PER_TASK,
    crowded_keys,
    is_large,
    lookup_join,
    lookup_keys,
)
from tabloom.session import plan_bytes
from tabloom.sources import tables
from tabloom.sources.commits import CommitLog, log_folder

# Properties of the view readers use.
_KEYS = "primary_keys"
_BUCKETS = "buckets"
_BASE = "base_table"
_CHANGES = "changes_tables"
_VERSION = "version"

# With more layers of changes than this, base and changes are written anew as one.
MOST_LAYERS = 8


@dataclass(frozen=True)
class FeatureTableSpec:
    """A feature table is a view: base rows, and layers of changed rows laid over them.

    ``changes`` names the layers, oldest first; ``version`` counts the states of the table.
    """

    name: str
    primary_keys: tuple[str, ...]
    description: str
    base: str
    changes: tuple[str, ...] = ()
    buckets: int | None = None
    version: int = 0


@dataclass(frozen=True)
class FeatureLookup:
    """Features to fetch from a table by key; no names means all but the keys.

    ``lookup_key`` names the columns of the labelled frame, in the order of the
    table's primary keys; left out, they carry the keys' own names.
    """

    table: str
    lookup_key: str | tuple[str, ...] | None = None
    feature_names: tuple[str, ...] | None = None


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are null in part or occur more than once, with their row counts."""
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where((F.col("n_rows") > 1) | some_null)
    )


def _require_keys(df: DataFrame, keys: Sequence[str], what: str) -> None:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks key columns {missing}")
    if not key_violations(df, keys).isEmpty():
        raise ValueError(f"{what} has null or repeated keys in {list(keys)}")


def _select(spec: FeatureTableSpec) -> str:
    """The rows readers see: of each key those of the newest layer that has it."""
    layers = [spec.base, *spec.changes]
    parts = []
    for i, layer in enumerate(layers):
        part = f"SELECT * FROM {layer} AS own"
        # Layers are small, so the newer ones are put together; the base is read once, against all of them.
        newer = " UNION ALL ".join(f"SELECT {', '.join(f'`{k}`' for k in spec.primary_keys)} FROM {n}" for n in layers[i + 1 :])
        if newer:
            same_key = " AND ".join(f"own.`{k}` = newer.`{k}`" for k in spec.primary_keys)
            part += f" LEFT ANTI JOIN ({newer}) AS newer ON {same_key}"
        parts.append(part)
    return " UNION ALL ".join(parts)


def _show(spark: SparkSession, spec: FeatureTableSpec) -> None:
    properties = {
        _KEYS: ",".join(spec.primary_keys),
        _BUCKETS: str(spec.buckets or 0),
        _BASE: spec.base,
        _CHANGES: ",".join(spec.changes),
        _VERSION: str(spec.version),
    }
    tables.publish_view(spark, spec.name, _select(spec), spec.description, properties)


def _publish(spark: SparkSession, spec: FeatureTableSpec, stored: str) -> FeatureTableSpec:
    """Make ``spec`` the table's next state, unless another writer has made one since it was read.

    The commit decides; the view only follows it.  A view that a slower writer has set
    back is put right by that writer, who looks at the log once more.
    """
    log = CommitLog(spark, log_folder(spark, spec.name))
    spec = replace(spec, version=spec.version + 1)
    if not log.commit(spec.version, asdict(spec)):
        spark.sql(f"DROP TABLE IF EXISTS {stored}")
        raise RuntimeError(f"{spec.name} was written by another job meanwhile: upsert again")
    shown = spec
    while True:
        _show(spark, shown)
        newest = feature_table_spec(spark, spec.name)
        if newest.version <= shown.version:
            return spec
        shown = newest


def _store(spark: SparkSession, spec: FeatureTableSpec, df: DataFrame, check: bool = True) -> str:
    """Write rows under a new table name and check their keys there."""
    stored = tables.version_name(spec.name)
    tables.overwrite_table(df, stored, spec.primary_keys, spec.buckets)
    if check:
        try:
            _require_keys(spark.read.table(stored), spec.primary_keys, spec.name)
        except ValueError:
            spark.sql(f"DROP TABLE {stored}")
            raise
    return stored


def create_feature_table(
    spark: SparkSession,
    name: str,
    primary_keys: str | Sequence[str],
    df: DataFrame | None = None,
    schema: T.StructType | None = None,
    description: str = "",
    buckets: int | None = None,
) -> FeatureTableSpec:
    """Create a keyed table from rows, or empty from a schema.

    ``buckets`` hashes it on the keys at write time; key checks, lookups and
    upserts then need no shuffle of the table.
    """
    keys = (primary_keys,) if isinstance(primary_keys, str) else tuple(primary_keys)
    if df is None:
        if schema is None:
            raise ValueError("give the rows or a schema")
        df = spark.createDataFrame([], schema)
    elif schema is not None:
        df = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks key columns {missing}")
    if spark.catalog.tableExists(name):
        raise ValueError(f"feature table {name} exists")
    # Numbers go on after those of an earlier table of the name.
    last = CommitLog(spark, log_folder(spark, name)).numbers()
    spec = FeatureTableSpec(name, keys, description, "", buckets=buckets, version=last[-1] if last else 0)
    stored = _store(spark, spec, df)
    return _publish(spark, replace(spec, base=stored), stored)


def feature_table_spec(spark: SparkSession, name: str) -> FeatureTableSpec:
    """The state that the last commit has made."""
    found = CommitLog(spark, log_folder(spark, name)).latest()
    if found is None or not spark.catalog.tableExists(name):
        raise LookupError(f"there is no feature table {name}")
    held = found[1]
    held["primary_keys"], held["changes"] = tuple(held["primary_keys"]), tuple(held["changes"])
    return FeatureTableSpec(**held)


def write_feature_table(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    mode: str = "merge",
    compact_share: float = 0.1,
) -> FeatureTableSpec:
    """Upsert rows by primary key (``merge``) or replace all rows (``overwrite``).

    An upsert writes its own rows and no others, as one more layer over the base; readers take
    each key from its newest layer.  Once the layers outgrow ``compact_share`` of the base or
    are more than ``MOST_LAYERS``, all is written anew as one.  Of two writers that read the
    same state one is refused, whatever their timing.
    Keys are unique in each layer, so no join here can be skewed.
    """
    spec = feature_table_spec(spark, name)
    base = spark.read.table(spec.base)
    if set(df.columns) != set(base.columns):
        raise ValueError(f"columns of the source and of {name} differ")
    source = df.select(*(F.col(f.name).cast(f.dataType) for f in base.schema.fields))
    if mode not in ("merge", "overwrite"):
        raise ValueError(f"unknown mode {mode}")
    stored = _store(spark, spec, source)
    if mode == "overwrite":
        return _publish(spark, replace(spec, base=stored, changes=()), stored)
    if spark.read.table(stored).isEmpty():
        spark.sql(f"DROP TABLE {stored}")
        return spec
    merged = _publish(spark, replace(spec, changes=(*spec.changes, stored)), stored)
    size = sum(plan_bytes(spark.read.table(layer)) for layer in merged.changes)
    if len(merged.changes) > MOST_LAYERS or size > compact_share * plan_bytes(base):
        merged = compact_feature_table(spark, name)
    return merged


def compact_feature_table(spark: SparkSession, name: str) -> FeatureTableSpec:
    """Write base and changed rows as one new base."""
    spec = feature_table_spec(spark, name)
    stored = _store(spark, spec, spark.sql(_select(spec)), check=False)
    return _publish(spark, replace(spec, base=stored, changes=()), stored)


def drop_superseded(spark: SparkSession, old: FeatureTableSpec) -> None:
    """Free the stored rows of an earlier state once nothing reads them any more."""
    current = feature_table_spec(spark, old.name)
    for stored in {old.base, *old.changes} - {current.base, *current.changes}:
        spark.sql(f"DROP TABLE IF EXISTS {stored}")


def _looked_up(
    lookup: FeatureLookup, spec: FeatureTableSpec, columns: Sequence[str]
) -> list[str]:
    return [n for n in (lookup.feature_names or columns) if n not in spec.primary_keys]


def apply_lookups(
    df: DataFrame,
    lookups: Iterable[FeatureLookup],
    small_bytes: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Fetch the features of every lookup; unmatched keys give null features.

    Only keys and requested features are read from each table.  Keys of all
    lookups into large tables are counted in one pass over ``df``, so that the
    rows are read twice in all, however many lookups there are.
    """
    spark = df.sparkSession
    steps = []
    columns = list(df.columns)
    for lookup in lookups:
        spec = feature_table_spec(spark, lookup.table)
        table = spark.read.table(lookup.table)
        keys = list(spec.primary_keys)
        given = lookup.lookup_key or spec.primary_keys
        given = [given] if isinstance(given, str) else list(given)
        if len(given) != len(keys):
            raise ValueError(f"{lookup.table} has keys {keys}, lookup gives {given}")
        names = _looked_up(lookup, spec, table.columns)
        clash = [n for n in names if n in columns]
        if clash:
            raise ValueError(f"features {clash} of {lookup.table} are already in the frame")
        features = table.select(
            *(F.col(k).alias(g) for k, g in zip(keys, given, strict=True)), *names
        )
        steps.append((features, given))
        columns += names
    # A key that an earlier lookup fetches is counted by its own join.
    counted = [
        i
        for i, (features, given) in enumerate(steps)
        if set(given) <= set(df.columns) and is_large(features, small_bytes)
    ]
    crowded = None
    if counted:
        key_sets = [lookup_keys(df, *steps[i])[0] for i in counted]
        crowded = crowded_keys(df, key_sets, rows_per_task)
    for i, (features, given) in enumerate(steps):
        mine = crowded.where(F.col("set") == counted.index(i)) if i in counted else None
        # Keys of feature tables are checked when they are written.
        df = lookup_join(df, features, given, small_bytes, rows_per_task, True, mine)
    return df


@dataclass(frozen=True)
class TrainingSet:
    """Labelled rows, what to look up for them, and what to leave out."""

    df: DataFrame
    lookups: tuple[FeatureLookup, ...]
    label: str
    excluded: tuple[str, ...] = field(default=())

    def load_df(self) -> DataFrame:
        """The joined frame; it stays distributed and lazy."""
        return apply_lookups(self.df, self.lookups).drop(*self.excluded)

    @property
    def feature_names(self) -> list[str]:
        """Columns a model may train on, known without planning the joins."""
        spark = self.df.sparkSession
        names = list(self.df.columns)
        for lookup in self.lookups:
            spec = feature_table_spec(spark, lookup.table)
            names += _looked_up(lookup, spec, spark.read.table(lookup.table).columns)
        return [c for c in names if c != self.label and c not in self.excluded]

    @property
    def recipe(self) -> list[dict]:
        """What scoring must look up, in a form that can be saved beside the model."""
        return [asdict(lookup) for lookup in self.lookups]


def create_training_set(
    df: DataFrame,
    feature_lookups: Iterable[FeatureLookup],
    label: str,
    exclude_columns: str | Iterable[str] = (),
) -> TrainingSet:
    excluded = (exclude_columns,) if isinstance(exclude_columns, str) else tuple(exclude_columns)
    if label not in df.columns:
        raise ValueError(f"no label column {label}")
    return TrainingSet(df, tuple(feature_lookups), label, excluded)


def lookups_from_recipe(recipe: Iterable[dict]) -> list[FeatureLookup]:
    """Inverse of ``TrainingSet.recipe`` (JSON has turned tuples into lists)."""

    def hashable(value: object) -> object:
        return tuple(value) if isinstance(value, list) else value

    return [FeatureLookup(**{k: hashable(v) for k, v in r.items()}) for r in recipe]
