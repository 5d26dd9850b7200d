"""Lookups in small tables without moving the rows that look up.

What the driver made itself has a known size: up to ``LITERAL_BYTES`` it goes into the plan as a literal map. Any other table is measured
before it is joined: up to ``BROADCAST_BYTES`` it is broadcast, so the rows stay where they are; a larger one is left to the planner, which
sizes and splits the join itself.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LITERAL_BYTES = 1 << 20
BROADCAST_BYTES = 16 << 20


def literal(value: object, kind: str) -> Column:
    """A constant of any type, from what its JSON says."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def byte_size(table: DataFrame) -> int:
    """The bytes of a table's rows as JSON."""
    return table.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns])))), F.lit(0))).first()[0]


def sized(table: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``table``, to be broadcast if it was measured to be small enough."""
    return F.broadcast(table) if byte_size(table) <= most else table


def in_map(key: Column, pairs: dict[str, str], most: int = LITERAL_BYTES) -> Column | None:
    """The value of ``key`` as a literal lookup, null where there is none; None if the map is too large for a literal."""
    if sum(len(k.encode()) + len(v.encode()) for k, v in pairs.items()) > most:
        return None
    if not pairs:
        return F.lit(None).cast("string")
    # Set membership is a hash lookup, a literal map is searched from its start: so only keys that are there go to the map.
    return F.when(key.isin(*pairs), F.element_at(literal(pairs, "map<string,string>"), key))
