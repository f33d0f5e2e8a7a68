"""Dimension enrichment (J1-J6, J11): role-playing left joins.

A dimension is joined once per role (base/quote token, from/to chain). Each
role gets its own renamed projection of the dimension, so the joined columns
never collide and no DataFrame alias bookkeeping is needed.

Broadcast policy: no side is hinted blindly. By default the join is left to
Spark's own size checks - the static estimate (file size of the projected
columns, an upper bound for filters/projections) against
``spark.sql.autoBroadcastJoinThreshold``, then AQE's measured size of the
materialised side - so a dimension that grows past the threshold silently
becomes a shuffle join (with AQE skew splitting).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_role(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[tuple[str, str]],
    columns: Mapping[str, str],
    role: str,
    how: str = "left",
) -> DataFrame:
    """Join one role of ``dim`` onto ``fact``.

    ``keys``: (fact column, dim column) equality pairs.
    ``columns``: output name -> dim column to bring over. An output name that
    already exists on ``fact`` is replaced by the dim's value (NULL when
    unmatched), which is how a role can overwrite e.g. ``base_address``.
    """
    key_alias = {dk: f"__{role}_k{i}" for i, (_, dk) in enumerate(keys)}
    sel = [F.col(dk).alias(key_alias[dk]) for _, dk in keys]
    sel += [F.col(src).alias(f"__{role}_{out}") for out, src in columns.items()]
    side = dim.select(*sel)
    cond: Column | None = None
    for fk, dk in keys:
        c = fact[fk] == side[key_alias[dk]]
        cond = c if cond is None else cond & c
    joined = fact.join(side, cond, how)
    keep = [c for c in fact.columns if c not in columns]
    out = [F.col(f"`{c}`") for c in keep]
    out += [F.col(f"__{role}_{o}").alias(o) for o in columns]
    return joined.select(*out)


def remove_matched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose keys do not occur in ``right`` (left anti).

    Only the key columns of ``right`` are shuffled.
    """
    return left.join(right.select(*keys), list(keys), "left_anti")
