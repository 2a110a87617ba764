"""Splits and folds by key."""

from __future__ import annotations

from tabloom.operators import splits
from tabloom.queries.base import digest_sql, hash01_sql, load, query


def _split_sql(table: str, key: str, seed: int, cuts: list[tuple[str, float]]) -> str:
    u = hash01_sql(seed, key)
    whens = " ".join(f"WHEN {u} < {upper} THEN '{name}'" for name, upper in cuts[:-1])
    return f"SELECT {key}, CASE {whens} ELSE '{cuts[-1][0]}' END AS split FROM {table}"


_70_30 = _split_sql("events", "event_id", 0, [("train", 0.7), ("test", 1)])


@query("split_70_30", _70_30)
def split_70_30(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id")
    return splits.hash_split(events, ["event_id"], {"train": 0.7, "test": 0.3}, seed=0)


@query("split_80_20", _split_sql("part", "p_partkey", 42, [("train", 0.8), ("test", 1)]))
def split_80_20(spark, sf_dir):
    part = load(spark, sf_dir, "part").select("p_partkey")
    return splits.hash_split(part, ["p_partkey"], {"train": 0.8, "test": 0.2}, seed=42)


@query("split_50_50", _split_sql("documents", "doc_id", 42, [("train", 0.5), ("test", 1)]))
def split_50_50(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id")
    return splits.hash_split(docs, ["doc_id"], {"train": 0.5, "test": 0.5}, seed=42)


@query(
    "split_60_20_20",
    _split_sql(
        "orders", "o_orderkey", 123, [("train", 0.6), ("validation", 0.8), ("test", 1)]
    ),
)
def split_60_20_20(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    weights = {"train": 0.6, "validation": 0.2, "test": 0.2}
    return splits.hash_split(orders, ["o_orderkey"], weights, seed=123)


@query(
    "split_exact",
    f"""
    SELECT o_orderkey,
           CASE WHEN rank < floor(n * 0.6 + 1e-9) THEN 'train'
                WHEN rank < floor(n * 0.8 + 1e-9) THEN 'validation' ELSE 'test' END AS split
    FROM (
      SELECT o_orderkey, count(*) OVER () AS n,
             row_number() OVER (ORDER BY {digest_sql(123, "o_orderkey")}, o_orderkey) - 1 AS rank
      FROM orders
    )
    """,
)
def split_exact(spark, sf_dir):
    """Shares met to the row."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    weights = {"train": 0.6, "validation": 0.2, "test": 0.2}
    return splits.exact_split(orders, ["o_orderkey"], weights, seed=123)


@query(
    "kfold_assign",
    f"""
    SELECT event_id, CAST(floor({hash01_sql(0, "event_id")} * 3) AS INTEGER) AS fold FROM events
    """,
)
def kfold_assign(spark, sf_dir):
    return splits.kfold(load(spark, sf_dir, "events").select("event_id"), ["event_id"], 3, seed=0)


@query("split_counts", f"SELECT split, count(*) AS n_rows FROM ({_70_30}) GROUP BY split")
def split_counts(spark, sf_dir):
    return splits.split_counts(split_70_30(spark, sf_dir))
