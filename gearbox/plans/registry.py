"""Registered queries: one per operator of the inventory, each with its
Spark implementation ``(spark, sf_dir) -> DataFrame`` and, where the result is
exactly defined, the same result as DuckDB SQL over the raw tables.

Conventions that make the two sides comparable:

* every computed column is aliased to the same name on both sides;
* integer results are BIGINT/INTEGER on both sides (casts where the
  engines' defaults differ), text is VARCHAR/STRING;
* computed doubles are rounded to 4 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gearbox.schema import LISTINGS, LISTINGS_RAW
from gearbox.sources.fixtures import LISTINGS_RAW_SQL, LISTINGS_SQL


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]  # inventory ids covered


REGISTRY: dict[str, Query] = {}


def register(name: str, ops: tuple[str, ...], sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco


# --------------------------------------------------------------------------- SQL helpers
def _not_null_sql(schema) -> str:
    terms = []
    for f in schema.fields:
        terms.append(f"{f.name} is not null")
        if f.dataType.typeName() in ("double", "float"):
            terms.append(f"not isnan({f.name})")
    return " and ".join(terms)


_CTES = {
    "listings": LISTINGS_SQL,
    "listings_raw": LISTINGS_RAW_SQL,
    # keyed split and folds (portable md5 bucket)
    "keyed": """
select *,
  case when ('0x' || substr(md5(listing_id), 1, 8))::bigint % 100 < 80 then 'train' else 'test' end as split,
  cast(('0x' || substr(md5('f' || listing_id), 1, 8))::bigint % 3 as integer) as fold
from listings""",
    "terciles": f"""
select min(price) filter (where rn * 100 >= 33 * n) as p33,
       min(price) filter (where rn * 100 >= 67 * n) as p67
from (select price, row_number() over (order by price) as rn, count(*) over () as n
      from listings where {_not_null_sql(LISTINGS)})""",
}
_CTE_ORDER = ["listings", "listings_raw", "keyed", "terciles"]


def sql(body: str, *ctes: str) -> str:
    """Prefix ``body`` with the named fixture CTEs; a body that starts with its
    own ``WITH`` list is merged into the same list."""
    need = [c for c in _CTE_ORDER if c in ctes]
    body = body.strip()
    if not need:
        return body
    head = "WITH " + ",\n".join(f"{c} AS ({_CTES[c]})" for c in need)
    if body[:5].lower() == "with ":
        return head + ",\n" + body[5:]
    return head + "\n" + body


NOT_NULL_LISTINGS = _not_null_sql(LISTINGS)
NOT_NULL_RAW = _not_null_sql(LISTINGS_RAW)

# Import the modules that register queries (order = registry order).
from gearbox.plans import queries_core  # noqa: E402,F401
from gearbox.plans import queries_io  # noqa: E402,F401
from gearbox.plans import queries_models  # noqa: E402,F401
