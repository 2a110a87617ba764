"""Runs and registry tables, folded from rows derived from ``events``.

Each event stands for one change: the event type is the model, the user the
version, the event id the sequence number and the value a metric.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import ordering, registry, tuning
from tabloom.operators.registry import ModelRegistry
from tabloom.queries.base import load, query, work_schema

# --- runs ---------------------------------------------------------------------


def _runs(spark, sf_dir):
    k = F.regexp_extract("props", r"(\d+)", 1)
    return load(spark, sf_dir, "events").select(
        F.concat(F.lit("run_"), "event_id").alias("run_id"),
        F.col("event_type").alias("run_name"),
        F.concat(F.lit("parent_"), "user_id").alias("parent_run_id"),
        F.col("ts").alias("start_time"),
        F.create_map(
            F.lit("k"), k, F.lit("user"), F.col("user_id").cast("string")
        ).alias("params"),
        F.create_map(F.lit("auc"), (F.col("value") / 500)).alias("metrics"),
        F.create_map(
            F.lit("model"), F.concat(F.lit("/models/"), F.col("event_id").cast("string"))
        ).alias("artifacts"),
    )


_RUNS = r"""
runs AS (
  SELECT concat('run_', event_id) AS run_id, event_type AS run_name,
         concat('parent_', user_id) AS parent_run_id, ts AS start_time,
         regexp_extract(props, '(\d+)', 1) AS k, CAST(user_id AS VARCHAR) AS "user",
         value / 500 AS auc, concat('/models/', event_id) AS model_path
  FROM events
)
"""


@query(
    "runs_table",
    f"""
    WITH {_RUNS}
    SELECT run_id, run_name, parent_run_id, strftime(start_time, '%Y-%m-%d %H:%M:%S.%f')
             AS start_time, k, "user" AS user, round(auc, 9) AS auc, model_path
    FROM runs
    """,
)
def runs_table(spark, sf_dir):
    """Runs appended to a stored table and read back."""
    store = ModelRegistry(spark, work_schema(spark))
    store.append_runs(_runs(spark, sf_dir))
    return store.table("runs").select(
        "run_id",
        "run_name",
        "parent_run_id",
        F.date_format("start_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("start_time"),
        F.col("params")["k"].alias("k"),
        F.col("params")["user"].alias("user"),
        F.round(F.col("metrics")["auc"], 9).alias("auc"),
        F.col("artifacts")["model"].alias("model_path"),
    )


@query(
    "search_runs_by_name",
    f"""
    WITH {_RUNS}
    SELECT run_id, run_name, parent_run_id, round(auc, 9) AS auc FROM runs
    WHERE run_name = 'purchase'
    """,
)
def search_runs_by_name(spark, sf_dir):
    found = registry.search_runs(_runs(spark, sf_dir), run_name="purchase")
    return found.select(
        "run_id", "run_name", "parent_run_id", F.round(F.col("metrics")["auc"], 9).alias("auc")
    )


@query(
    "best_run",
    f"""
    WITH {_RUNS}
    SELECT run_id, run_name, round(auc, 9) AS auc FROM runs
    WHERE parent_run_id = 'parent_1' ORDER BY auc DESC NULLS LAST, run_id LIMIT 1
    """,
)
def best_run(spark, sf_dir):
    """Best run among one parent's children."""
    best = registry.best_run(_runs(spark, sf_dir), "auc", parent_run_id="parent_1")
    return best.select("run_id", "run_name", F.round(F.col("metrics")["auc"], 9).alias("auc"))


@query(
    "latest_run_per_name",
    f"""
    WITH {_RUNS}
    SELECT run_name, run_id FROM runs
    QUALIFY row_number() OVER (PARTITION BY run_name ORDER BY start_time DESC, run_id DESC) = 1
    """,
)
def latest_run_per_name(spark, sf_dir):
    return registry.latest_run_per_name(_runs(spark, sf_dir)).select("run_name", "run_id")


@query(
    "runs_ranked",
    f"""
    WITH {_RUNS}
    SELECT run_id, round(auc, 9) AS auc,
           row_number() OVER (ORDER BY auc DESC, run_id) - 1 AS place
    FROM runs
    """,
)
def runs_ranked(spark, sf_dir):
    """All runs by metric, with their place in the order."""
    runs = _runs(spark, sf_dir).select(
        "run_id", F.col("metrics")["auc"].alias("auc"), (-F.col("metrics")["auc"]).alias("worse")
    )
    ranked = ordering.dense_row_id(runs, "place", ["worse", "run_id"])
    return ranked.select("run_id", F.round("auc", 9).alias("auc"), "place")


@query(
    "runs_by_parent",
    f"""
    WITH {_RUNS}
    SELECT parent_run_id, count(*) AS n_children, round(max(auc), 9) AS best_auc,
           round(avg(auc), 9) AS mean_auc
    FROM runs GROUP BY parent_run_id
    """,
)
def runs_by_parent(spark, sf_dir):
    children = registry.runs_by_parent(_runs(spark, sf_dir), "auc")
    return children.withColumns({c: F.round(c, 9) for c in ("best_auc", "mean_auc")})


@query(
    "param_metric_corr",
    f"""
    WITH {_RUNS},
    long AS (
      SELECT 'k' AS param, CAST(k AS DOUBLE) AS value, auc FROM runs
      UNION ALL SELECT 'user', CAST("user" AS DOUBLE), auc FROM runs
    )
    SELECT param, count(value) AS n_runs, round(corr(value, auc), 9) AS correlation
    FROM long GROUP BY param
    """,
)
def param_metric_corr(spark, sf_dir):
    """How each parameter goes with the metric, over all runs."""
    corr = tuning.param_metric_corr(_runs(spark, sf_dir), "auc")
    return corr.withColumn("correlation", F.round("correlation", 9))


# --- versions, aliases, tags, stages --------------------------------------------


def _versions(spark, sf_dir):
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("name"),
        (F.col("user_id") + 1).cast("int").alias("version"),
        F.concat(F.lit("run_"), "event_id").alias("run_id"),
        F.concat(F.lit("/models/"), F.col("event_id").cast("string")).alias("model_path"),
    )


def _aliases(spark, sf_dir):
    value = F.col("value")
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("name"),
        F.when(value < 50, "Champion").when(value < 100, "champion").otherwise("Archived").alias(
            "alias"
        ),
        # A few events take their alias away.
        F.when(~value.between(40, 42), (F.col("user_id") + 1).cast("int")).alias("version"),
    )


def _stages(spark, sf_dir):
    value = F.col("value")
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("name"),
        (F.col("user_id") + 1).cast("int").alias("version"),
        F.when(value < 20, "Production")
        .when(value < 50, "Staging")
        .when(value < 150, "Archived")
        .otherwise("None")
        .alias("stage"),
    )


def _deletions(spark, sf_dir):
    """Versions deleted one by one, and once in a while a whole model."""
    value = F.col("value")
    return (
        load(spark, sf_dir, "events")
        .where(value >= 150)
        .select(
            F.col("event_id").alias("seq"),
            F.col("event_type").alias("name"),
            F.when(value < 300, (F.col("user_id") + 1).cast("int")).alias("version"),
        )
    )


_VERSIONS = """
versions AS (
  SELECT event_id AS seq, event_type AS name, CAST(user_id + 1 AS INTEGER) AS version,
         concat('/models/', event_id) AS model_path
  FROM events
)
"""
_ALIASES = """
aliases AS (
  SELECT event_id AS seq, event_type AS name,
         CASE WHEN value < 100 THEN 'champion' ELSE 'archived' END AS alias,
         CASE WHEN NOT value BETWEEN 40 AND 42 THEN CAST(user_id + 1 AS INTEGER) END AS version
  FROM events
),
current_aliases AS (
  SELECT name, alias, version FROM (
    SELECT * FROM aliases
    QUALIFY row_number() OVER (PARTITION BY name, alias ORDER BY seq DESC) = 1
  ) WHERE version IS NOT NULL
)
"""
_STAGES = """
stages AS (
  SELECT event_id AS seq, event_type AS name, CAST(user_id + 1 AS INTEGER) AS version,
         CASE WHEN value < 20 THEN 'Production' WHEN value < 50 THEN 'Staging'
              WHEN value < 150 THEN 'Archived' ELSE 'None' END AS stage
  FROM events
),
current_stages AS (
  SELECT name, version, stage FROM stages
  QUALIFY row_number() OVER (PARTITION BY name, version ORDER BY seq DESC) = 1
)
"""
_LIVE = """
deletions AS (
  SELECT event_id AS seq, event_type AS name,
         CASE WHEN value < 300 THEN CAST(user_id + 1 AS INTEGER) END AS version
  FROM events WHERE value >= 150
),
live AS (
  SELECT * FROM versions v WHERE NOT EXISTS (
    SELECT 1 FROM deletions d
    WHERE d.name = v.name AND d.seq >= v.seq AND (d.version IS NULL OR d.version = v.version)
  )
)
"""


@query(
    "latest_model_version",
    """
    SELECT CAST(coalesce(max(user_id + 1), 1) AS INTEGER) AS latest_version, count(*) > 0 AS found
    FROM events WHERE event_type = 'purchase'
    """,
)
def latest_model_version(spark, sf_dir):
    """Version numbers kept as text still compare as numbers."""
    versions = _versions(spark, sf_dir).withColumn("version", F.col("version").cast("string"))
    return registry.latest_version(versions, "purchase")


@query(
    "next_model_version",
    f"""
    WITH {_VERSIONS} SELECT name, max(version) + 1 AS next_version FROM versions GROUP BY name
    """,
)
def next_model_version(spark, sf_dir):
    return registry.next_versions(_versions(spark, sf_dir))


@query(
    "resolve_alias",
    f"WITH {_ALIASES} SELECT name, alias, version FROM current_aliases",
)
def resolve_alias(spark, sf_dir):
    return registry.current_aliases(_aliases(spark, sf_dir))


@query(
    "current_tags",
    r"""
    SELECT event_type AS name, CAST(user_id + 1 AS INTEGER) AS version,
           concat('tag', substr(regexp_extract(props, '(\d+)', 1), 1, 1)) AS key,
           CAST(arg_max(value, event_id) AS VARCHAR) AS value
    FROM events GROUP BY 1, 2, 3
    """,
)
def current_tags(spark, sf_dir):
    tags = load(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("name"),
        (F.col("user_id") + 1).cast("int").alias("version"),
        F.concat(F.lit("tag"), F.substring(F.regexp_extract("props", r"(\d+)", 1), 1, 1)).alias(
            "key"
        ),
        F.col("value").cast("string").alias("value"),
    )
    return registry.current_tags(tags)


@query(
    "current_stage",
    f"WITH {_STAGES} SELECT name, version, stage FROM current_stages",
)
def current_stage(spark, sf_dir):
    return registry.current_stages(_stages(spark, sf_dir))


@query(
    "registry_after_delete",
    f"""
    WITH {_VERSIONS}, {_LIVE}
    SELECT name, version, model_path FROM live
    """,
)
def registry_after_delete(spark, sf_dir):
    live = registry.live_versions(_versions(spark, sf_dir), _deletions(spark, sf_dir))
    return live.select("name", "version", "model_path")


@query(
    "resolve_model_uri",
    f"""
    WITH {_VERSIONS}, {_LIVE}, {_ALIASES}, {_STAGES},
    stored AS (
      SELECT name, version, arg_max(model_path, seq) AS model_path FROM live GROUP BY name, version
    ),
    targets AS (
      SELECT concat('models:/', name, '@', alias) AS uri, version, model_path
      FROM current_aliases JOIN stored USING (name, version)
      UNION ALL
      SELECT uri, version, model_path FROM (
        SELECT concat('models:/', name, '/', lower(stage)) AS uri, version, model_path
        FROM current_stages JOIN stored USING (name, version)
        QUALIFY row_number() OVER (PARTITION BY name, stage ORDER BY version DESC) = 1
      )
      UNION ALL
      SELECT concat('models:/', name, '/', version), version, model_path FROM stored
      UNION ALL
      SELECT concat('runs:/run_', event_id, '/model'), NULL, concat('/models/', event_id)
      FROM events
    ),
    uris AS (
      SELECT DISTINCT unnest([
        concat('models:/', event_type, '@champion'), concat('models:/', event_type, '@archived'),
        concat('models:/', event_type, '/production'), concat('models:/', event_type, '/staging'),
        concat('models:/', event_type, '/', user_id + 1), concat('runs:/run_', event_id, '/model'),
        concat('models:/', event_type, '@unknown')
      ]) AS uri
      FROM events
    )
    SELECT uri, version, model_path FROM uris LEFT JOIN targets USING (uri)
    """,
)
def resolve_model_uri(spark, sf_dir):
    """Every address in use, by alias, stage, version and run."""
    event_type = F.col("event_type")
    version = (F.col("user_id") + 1).cast("string")
    model = F.concat(F.lit("models:/"), event_type)
    uris = (
        load(spark, sf_dir, "events")
        .select(
            F.explode(
                F.array(
                    F.concat(model, F.lit("@champion")),
                    F.concat(model, F.lit("@archived")),
                    F.concat(model, F.lit("/production")),
                    F.concat(model, F.lit("/staging")),
                    F.concat(model, F.lit("/"), version),
                    F.concat(F.lit("runs:/run_"), "event_id", F.lit("/model")),
                    F.concat(model, F.lit("@unknown")),
                )
            ).alias("uri")
        )
        .distinct()
    )
    versions, deletions = _versions(spark, sf_dir), _deletions(spark, sf_dir)
    return registry.resolve_uris(
        uris,
        registry.live_versions(versions, deletions),
        _aliases(spark, sf_dir),
        _stages(spark, sf_dir),
        _runs(spark, sf_dir),
    ).select("uri", "version", "model_path")
