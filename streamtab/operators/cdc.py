"""Change data: current state of a table and its withdraw-and-add changelog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtab.operators.scan import lag, run_over
from streamtab.sources.sinks import last_per_key


def apply_changes(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op", deletes: Sequence[str] = ("d", "delete")
) -> DataFrame:
    """The table after all changes: each key's last row unless that was a delete."""
    last = last_per_key(changes, keys, order)
    return last.where(~F.lower(F.col(op)).isin(*deletes)).drop(op)


def to_retract(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: Column | None = None
) -> DataFrame:
    """Changelog rows with `is_add`: each change withdraws the key's previous row (unless deleted), then adds its own
    (unless it deletes)."""
    gone = F.lit(False) if deleted is None else deleted
    row = F.struct(*changes.columns)
    boxed = changes.withColumns({"_row": row, "_gone": gone})
    seen = run_over(boxed, keys, order, {"_old": lag("_row"), "_was_gone": lag("_gone")})

    def entry(is_add: bool, col: str) -> Column:
        return F.struct(F.lit(is_add).alias("is_add"), F.col(col).alias("row"))

    withdraw = F.when(F.col("_old").isNotNull() & ~F.col("_was_gone"), entry(False, "_old"))
    add = F.when(~F.col("_gone"), entry(True, "_row"))
    at = [F.col(c).alias(f"change_{c}") for c in order]
    log = seen.select(*at, F.explode(F.array_compact(F.array(withdraw, add))).alias("_e"))
    return log.select(*[f"change_{c}" for c in order], F.col("_e.is_add").alias("is_add"), "_e.row.*")
