"""Random numbers that depend on a row's own key and nothing else.

``rand`` and ``randomSplit`` follow the physical layout of the data: the same
rows in other partitions give other numbers.  Hashing the key gives a uniform
number that survives repartitioning, retries and reruns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_digest(seed: object, *keys: Column | str) -> Column:
    """md5 of seed and key values joined by ``|``, as 32 hex digits."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(p.cast("string") for p in parts)))


def hash01(seed: object, *keys: Column | str) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of the key digest."""
    head = F.substring(key_digest(seed, *keys), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(2**32))


def real_time_measurement(seed: object, *keys: Column | str, scale: float = 10.0) -> Column:
    """A stand-in for a value known only when scoring: uniform in [0, scale)."""
    return F.lit(float(scale)) * hash01(seed, *keys)
