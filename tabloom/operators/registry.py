"""Runs, model versions, aliases, tags and stages as append-only tables.

Nothing is updated in place.  Every change is a row with a sequence number; the
current state is an aggregate over those rows, so it combines before any
shuffle however often one model changes.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from hashlib import md5

from pyspark.ml.util import MLWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.joins import lookup_join
from tabloom.session import scratch_path
from tabloom.sources.commits import CommitLog, log_folder
from tabloom.sources.models import SavedModel, load_model, save_model
from tabloom.sources.tables import ensure_schema

SCHEMAS = {
    "runs": "run_id string, run_name string, parent_run_id string, start_time timestamp_ntz, "
    "params map<string,string>, metrics map<string,double>, artifacts map<string,string>",
    "model_versions": "seq bigint, name string, version int, run_id string, model_path string",
    "aliases": "seq bigint, name string, alias string, version int",
    "tags": "seq bigint, name string, version int, key string, value string",
    "stages": "seq bigint, name string, version int, stage string",
    "deletions": "seq bigint, name string, version int",
}


# --- runs -----------------------------------------------------------------


def search_runs(
    runs: DataFrame, run_name: str | None = None, parent_run_id: str | None = None
) -> DataFrame:
    """Runs with a name and/or under a parent; the filters reach the scan."""
    if run_name is not None:
        runs = runs.where(F.col("run_name") == run_name)
    if parent_run_id is not None:
        runs = runs.where(F.col("parent_run_id") == parent_run_id)
    return runs


def order_by_metric(runs: DataFrame, metric: str) -> DataFrame:
    """Greatest metric first, runs without it last."""
    return runs.orderBy(F.col("metrics")[metric].desc_nulls_last(), "run_id")


def best_run(runs: DataFrame, metric: str, parent_run_id: str | None = None) -> DataFrame:
    """The run with the greatest metric, among one parent's children if given."""
    return order_by_metric(search_runs(runs, parent_run_id=parent_run_id), metric).limit(1)


def latest_run_per_name(runs: DataFrame) -> DataFrame:
    latest = F.max_by(F.struct("run_id", "start_time"), F.struct("start_time", "run_id"))
    return runs.groupBy("run_name").agg(latest.alias("r")).select("run_name", "r.*")


def runs_by_parent(runs: DataFrame, metric: str) -> DataFrame:
    """Children per parent run, with the best and mean metric among them."""
    value = F.col("metrics")[metric]
    return (
        runs.where(F.col("parent_run_id").isNotNull())
        .groupBy("parent_run_id")
        .agg(
            F.count(F.lit(1)).alias("n_children"),
            F.max(value).alias(f"best_{metric}"),
            F.avg(value).alias(f"mean_{metric}"),
        )
    )


# --- folding events into the current state --------------------------------


def next_versions(versions: DataFrame) -> DataFrame:
    return versions.groupBy("name").agg(
        (F.max(F.col("version").cast("int")) + 1).alias("next_version")
    )


def latest_version(versions: DataFrame, name: str) -> DataFrame:
    """Greatest version number of a model: 1 if it has none, with a flag saying so.

    Versions may be text; they are compared as numbers, so 10 follows 9.
    """
    return versions.where(F.col("name") == name).agg(
        F.coalesce(F.max(F.col("version").cast("int")), F.lit(1)).alias("latest_version"),
        (F.count(F.lit(1)) > 0).alias("found"),
    )


def _last(value: str) -> Column:
    return F.max_by(value, "seq").alias(value)


def current_aliases(alias_events: DataFrame) -> DataFrame:
    """Version each alias points at; letter case does not matter, a null version
    removes the alias."""
    return (
        alias_events.groupBy("name", F.lower("alias").alias("alias"))
        .agg(_last("version"))
        .where(F.col("version").isNotNull())
    )


def current_tags(tag_events: DataFrame) -> DataFrame:
    """Latest value of each tag; a null version means the model itself."""
    return tag_events.groupBy("name", "version", "key").agg(_last("value"))


def current_stages(stage_events: DataFrame) -> DataFrame:
    return stage_events.groupBy("name", "version").agg(_last("stage"))


def after_model_deletion(events: DataFrame, deletions: DataFrame) -> DataFrame:
    """Events of models as they exist now: those after the model's last deletion."""
    gone = (
        deletions.where(F.col("version").isNull())
        .groupBy("name")
        .agg(F.max("seq").alias("gone_at"))
    )
    kept = lookup_join(events, gone, ["name"], unique=True)
    return kept.where(F.col("gone_at").isNull() | (F.col("seq") > F.col("gone_at"))).select(
        *events.columns
    )


def live_versions(versions: DataFrame, deletions: DataFrame) -> DataFrame:
    """Versions not deleted, singly or with their model, since they were registered."""
    gone = (
        deletions.where(F.col("version").isNotNull())
        .groupBy("name", "version")
        .agg(F.max("seq").alias("gone_at"))
    )
    kept = lookup_join(
        after_model_deletion(versions, deletions), gone, ["name", "version"], unique=True
    )
    return kept.where(F.col("gone_at").isNull() | (F.col("seq") > F.col("gone_at"))).select(
        *versions.columns
    )


def live_tags(tag_events: DataFrame, deletions: DataFrame) -> DataFrame:
    """Latest tags of models and versions that exist: set after their last deletion.

    A tag of the model itself has no version and is untouched by deleted versions.
    """
    return current_tags(live_versions(tag_events, deletions))


def parse_uris(df: DataFrame, uri: str = "uri") -> DataFrame:
    """Split model addresses into kind, name and selector columns.

    ``models:/name@alias``, ``models:/name/version``, ``models:/name/stage`` and
    ``runs:/run_id/artifact_path``.
    """
    address = F.col(uri)
    by_alias = address.rlike(r"^models:/[^@]+@[^@]+$")
    by_run = address.rlike(r"^runs:/[^/]+/.+$")
    by_version = address.rlike(r"^models:/.+/\d+$")
    by_stage = address.rlike(r"^models:/[^@]+/[^/@]+$")
    kind = (
        F.when(by_run, "run")
        .when(by_alias, "alias")
        .when(by_version, "version")
        .when(by_stage, "stage")
    )
    run_parts = r"^runs:/([^/]+)/(.+)$"
    model_parts = r"^models:/(.+)[@/]([^@/]+)$"
    name = F.when(by_run, F.regexp_extract(address, run_parts, 1)).otherwise(
        F.regexp_extract(address, model_parts, 1)
    )
    selector = F.when(by_run, F.regexp_extract(address, run_parts, 2)).otherwise(
        F.lower(F.regexp_extract(address, model_parts, 2))
    )
    return df.select(
        "*",
        kind.alias("kind"),
        F.when(kind.isNotNull(), name).alias("name"),
        F.when(kind.isNotNull(), selector).alias("selector"),
    )


def resolve_uris(
    uris: DataFrame,
    versions: DataFrame,
    aliases: DataFrame,
    stages: DataFrame,
    runs: DataFrame | None = None,
) -> DataFrame:
    """Version and stored path behind each address; both null when nothing matches.

    ``versions`` are the live ones.  All ways of naming a model are gathered in
    one table of targets keyed by (kind, name, selector), so one join serves.
    A stage held by several versions gives the greatest of them.
    """
    stored = versions.groupBy("name", F.col("version").cast("int").alias("version")).agg(
        F.max_by("model_path", "seq").alias("model_path")
    )
    pointers = (
        current_aliases(aliases)
        .select(F.lit("alias").alias("kind"), "name", F.col("alias").alias("selector"), "version")
        .unionByName(
            current_stages(stages).select(
                F.lit("stage").alias("kind"), "name", F.lower("stage").alias("selector"), "version"
            )
        )
    )
    pointed = lookup_join(pointers, stored, ["name", "version"], unique=True).where(
        F.col("model_path").isNotNull()
    )
    by_version = stored.select(
        F.lit("version").alias("kind"),
        "name",
        F.col("version").cast("string").alias("selector"),
        "version",
        "model_path",
    )
    named = pointed.unionByName(by_version)
    if runs is not None:
        artifacts = runs.select(
            F.lit("run").alias("kind"),
            F.col("run_id").alias("name"),
            F.explode("artifacts").alias("selector", "model_path"),
        ).withColumn("version", F.lit(None).cast("int"))
        named = named.unionByName(artifacts)
    # One target per address, also where a run id was logged twice.
    targets = (
        named.groupBy("kind", "name", "selector")
        .agg(F.max(F.struct("version", "model_path")).alias("t"))
        .select("kind", "name", "selector", "t.version", "t.model_path")
    )
    found = lookup_join(
        parse_uris(uris), targets, ["kind", "name", "selector"], unique=True
    )
    return found.select(*uris.columns, "kind", "name", "version", "model_path")


# --- the stored registry --------------------------------------------------


class ModelRegistry:
    """The tables above in one catalog schema, with one method per change.

    Writers of the same model should take turns: version numbers are read and
    then appended, without a lock.
    """

    def __init__(self, spark: SparkSession, schema: str, location: str | None = None):
        self.spark = spark
        self.schema = ensure_schema(spark, schema, location)
        for table, columns in SCHEMAS.items():
            spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.{table} ({columns}) USING parquet")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.table(f"{self.schema}.{name}")

    def _append(self, table: str, *rows: tuple) -> None:
        schema = T.StructType.fromDDL(SCHEMAS[table])
        frame = self.spark.createDataFrame(list(rows), schema).coalesce(1)
        frame.write.mode("append").insertInto(f"{self.schema}.{table}")

    def append_runs(self, runs: DataFrame) -> None:
        """Add many runs at once, for instance all trials of a sweep."""
        columns = [f.name for f in T.StructType.fromDDL(SCHEMAS["runs"]).fields]
        runs.select(*columns).write.mode("append").insertInto(f"{self.schema}.runs")

    def log_runs(self, runs: Sequence[dict]) -> list[str]:
        """Append runs in one write; each is a set of ``log_run`` arguments."""
        ids = [uuid.uuid4().hex for _ in runs]
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        rows = [
            (
                run_id,
                run["run_name"],
                run.get("parent_run_id"),
                now,
                {k: str(v) for k, v in (run.get("params") or {}).items()},
                {k: float(v) for k, v in (run.get("metrics") or {}).items() if v is not None},
                dict(run.get("artifacts") or {}),
            )
            for run_id, run in zip(ids, runs, strict=True)
        ]
        self._append("runs", *rows)
        return ids

    def log_run(
        self,
        run_name: str,
        params: dict | None = None,
        metrics: dict[str, float] | None = None,
        artifacts: dict[str, str] | None = None,
        parent_run_id: str | None = None,
    ) -> str:
        """Append one run; ``artifacts`` maps artifact names to stored paths."""
        run = {
            "run_name": run_name,
            "params": params,
            "metrics": metrics,
            "artifacts": artifacts,
            "parent_run_id": parent_run_id,
        }
        return self.log_runs([run])[0]

    def store_model(
        self,
        model: MLWritable,
        signature: T.StructType,
        recipe: list[dict] | None = None,
        output: T.StructType | None = None,
    ) -> str:
        """Save a fitted model in the shared folder; the path goes into a run's artifacts."""
        path = scratch_path(self.spark, "model")
        save_model(model, path, signature, recipe, self.spark, output)
        return path

    def latest_run(self, run_name: str) -> str:
        found = latest_run_per_name(search_runs(self.table("runs"), run_name)).first()
        if found is None:
            raise LookupError(f"no run named {run_name}")
        return found["run_id"]

    def versions(self) -> DataFrame:
        return live_versions(self.table("model_versions"), self.table("deletions"))

    def _current(self, table: str) -> DataFrame:
        return after_model_deletion(self.table(table), self.table("deletions"))

    def tags(self) -> DataFrame:
        return live_tags(self.table("tags"), self.table("deletions"))

    def latest_version(self, name: str) -> int:
        return latest_version(self.versions(), name).first()["latest_version"]

    def register_model(self, run_uri: str, name: str) -> int:
        """Make a run's model the next version of ``name``.

        Its number is claimed by a commit that only one writer can make, so writers at the
        same time get different ones.
        """
        run_id, path = self._resolve(run_uri)
        # A deleted version's number is not handed out again while the model lives.
        used = after_model_deletion(self.table("model_versions"), self.table("deletions"))
        row = next_versions(used.where(F.col("name") == name)).first()
        version = row["next_version"] if row else 1
        version = self._claim_version(name, version, run_id)
        self._append("model_versions", (time.time_ns(), name, version, run_id, path))
        return version

    def _claim_version(self, name: str, version: int, run_id: str | None) -> int:
        """The first number from ``version`` on that no other writer has."""
        # A model that was deleted as a whole starts again at 1, with commits of its own.
        lives = self.table("deletions").where((F.col("name") == name) & F.col("version").isNull()).count()
        model = md5(f"{lives}|{name}".encode()).hexdigest()
        log = CommitLog(self.spark, log_folder(self.spark, f"{self.schema}.model_versions_{model}"))
        while not log.commit(version, {"name": name, "run_id": run_id}):
            version += 1
        return version

    def set_alias(self, name: str, alias: str, version: int) -> None:
        self._append("aliases", (time.time_ns(), name, alias, int(version)))

    def delete_alias(self, name: str, alias: str) -> None:
        self._append("aliases", (time.time_ns(), name, alias, None))

    def set_tag(self, name: str, key: str, value: str, version: int | None = None) -> None:
        self._append("tags", (time.time_ns(), name, version and int(version), key, value))

    def set_stage(self, name: str, version: int, stage: str) -> None:
        self._append("stages", (time.time_ns(), name, int(version), stage))

    def delete_version(self, name: str, version: int) -> None:
        self._append("deletions", (time.time_ns(), name, int(version)))

    def delete_model(self, name: str) -> None:
        """Delete a model with all its versions; doing it twice does no harm."""
        self._append("deletions", (time.time_ns(), name, None))

    def _resolve(self, uri: str) -> tuple[str | None, str]:
        """Run id (for a run's address) and stored path.

        Like ``resolve_uris`` for one address: the name is filtered on before
        anything is folded, and only the table the address needs is read.
        """
        asked = parse_uris(self.spark.range(1).select(F.lit(uri).alias("uri"))).first()
        kind, name, selector = asked["kind"], asked["name"], asked["selector"]
        if kind == "run":
            run = self.table("runs").where(F.col("run_id") == name).select("artifacts").first()
            path = run["artifacts"].get(selector) if run else None
        elif kind is None:
            path = None
        else:
            named = F.col("name") == name
            found = self.versions().where(named)
            if kind == "version":
                found = found.where(F.col("version") == int(selector))
            else:
                if kind == "alias":
                    events = self._current("aliases").where(named)
                    held = current_aliases(events).where(F.col("alias") == selector)
                else:
                    events = self._current("stages").where(named)
                    held = current_stages(events).where(F.lower("stage") == selector)
                found = found.join(held.select("name", "version"), ["name", "version"], "left_semi")
            path = found.agg(F.max_by("model_path", F.struct("version", "seq"))).first()[0]
        if path is None:
            raise LookupError(f"nothing is registered as {uri}")
        return (name if kind == "run" else None), path

    def resolve(self, uri: str) -> str:
        """Stored path of the model behind an address."""
        return self._resolve(uri)[1]

    def load(self, uri: str) -> SavedModel:
        return load_model(self.spark, self.resolve(uri))
