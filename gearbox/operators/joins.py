"""Size-checked broadcast for small tables that were materialised first.

Catalyst broadcasts on its own only when its statistics say a side is under
``spark.sql.autoBroadcastJoinThreshold``; for a checkpointed table those
statistics may be missing or inherited from a much larger input.  Here the
side is measured (cheap: it is already materialised), and the broadcast hint
is given only under the limit.  Beyond it the join stays a shuffle join, where
AQE can still switch strategy or split skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BYTES = 64 * 1024 * 1024


# Bytes of fixed-width types.
_WIDTH = {"byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4, "double": 8, "boolean": 1,
          "date": 4, "timestamp": 8, "timestamp_ntz": 8}


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows of a materialised table: fixed widths, and the measured
    length of text and other types (as text)."""
    sizes = [F.lit(8)]
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in _WIDTH:
            sizes.append(F.lit(_WIDTH[kind]))
        else:
            text = F.col(f.name) if kind in ("string", "binary") else F.col(f.name).cast("string")
            sizes.append(F.coalesce(F.octet_length(text), F.lit(0)) + 8)
    total = sizes[0].cast("long")
    for s in sizes[1:]:
        total = total + s
    return df.agg(F.coalesce(F.sum(total), F.lit(0))).first()[0]


def sized_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` if its measured size is at most ``max_bytes``, else ``df``."""
    limit = max_bytes if max_bytes is not None else DEFAULT_MAX_BYTES
    return F.broadcast(df) if measured_bytes(df) <= limit else df
