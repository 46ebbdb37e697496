"""Change feed between two versions of a keyed table.

Without a table format that records changes, the feed is derived by a keyed
full outer join of the two versions: a row only in the new version is an
``insert``, only in the old one a ``delete``, and a key whose non-key
columns differ (NULL-safe) gives an ``update_preimage`` and an
``update_postimage`` row. One shuffle on the key; unchanged keys emit nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHANGE_TYPES = ("insert", "update_preimage", "update_postimage", "delete")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``keys + value columns + _change_type`` describing old -> new."""
    keys = list(keys)
    cols = [c for c in new.columns if c not in keys]
    o = old.select(*keys, F.struct(*cols).alias("_old"))
    n = new.select(*keys, F.struct(*cols).alias("_new"))
    j = o.join(n, keys, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))

    def tagged(kind: str, col: str):
        return F.struct(F.lit(kind).alias("_change_type"), F.col(col).alias("_v"))

    events = (
        F.when(F.col("_old").isNull(), F.array(tagged("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(tagged("delete", "_old")))
        .otherwise(F.array(tagged("update_preimage", "_old"), tagged("update_postimage", "_new")))
    )
    return (
        j.select(*keys, F.inline(events))
        .select(*keys, *[F.col(f"_v.{c}").alias(c) for c in cols], "_change_type")
    )


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], recomputed: DataFrame) -> DataFrame:
    """Sync a keyed derived table (e.g. an embedding table) from a change feed.

    Keys deleted or updated in ``changes`` are removed from ``target``; the
    ``recomputed`` rows for inserted and updated keys are added back.
    """
    keys = list(keys)
    touched = changes.select(*keys).distinct()
    kept = target.join(touched, keys, "left_anti")
    fresh = recomputed.join(
        changes.filter(F.col("_change_type").isin("insert", "update_postimage")).select(*keys).distinct(),
        keys,
        "left_semi",
    )
    return kept.unionByName(fresh)
