"""Models that are computed again only for the months whose input changed.

Beside a model stands what its input looked like, month by month: how many rows, and two
sums of row hashes that do not depend on their order. A month is changed when one of them
differs. The model is partitioned by month, so the other months' files stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators import versions
from skyledger.operators.joins import month_side
from skyledger.session import staged_for

MONTH = "date_id"


def month_state(source: DataFrame, month: Column, settings: str = "") -> DataFrame:
    """``(date_id, rows, mix, total)`` of each month; one row per month, combined per task.

    Repeated rows cancel out in ``mix`` but not in ``total``. ``settings`` names what else the
    model depends on: another text changes every month.
    """
    row = F.xxhash64(*source.columns, F.lit(settings))
    return source.groupBy(month.alias(MONTH)).agg(
        F.count("*").alias("rows"),
        F.bit_xor(row).alias("mix"),
        F.sum(row.cast("decimal(38,0)")).alias("total"),
    )


def refresh(
    source: DataFrame, month: Column, model: Callable[[DataFrame], DataFrame], name: str, settings: str = ""
) -> list[str]:
    """Brings the stored model up to date with its input; returns the months computed again.

    ``model`` makes rows with a ``date_id`` from the source rows of the same months. Months
    that left the input, or that the model gives no row for any more, leave the table. The
    state is published last: after a failure the same months are computed once more.
    """
    state = month_state(source, month, settings).filter(f"{MONTH} is not null")
    with staged_for(state) as now:
        return _refresh(source, month, model, name, now)


def _refresh(
    source: DataFrame, month: Column, model: Callable[[DataFrame], DataFrame], name: str, now: DataFrame
) -> list[str]:
    spark, states = source.sparkSession, f"{name}_months"
    versions.ensure(now, states, None)
    parts = [c for c in now.columns if c != MONTH]
    before = spark.table(states).select(MONTH, *[F.col(c).alias(f"old_{c}") for c in parts])
    unchanged = F.lit(True)
    for c in parts:
        unchanged = unchanged & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    # One row per month, of which there are 2,412 at most.
    months = now.join(before, MONTH, "full").filter(~unchanged)
    found = {r[0]: r[1] for r in months.select(MONTH, F.col("rows").isNotNull()).collect()}
    if not found and versions.is_versioned(spark, name):
        return []
    changed = spark.createDataFrame([(m,) for m, here in found.items() if here], "_changed string")
    keyed = source.withColumn("_month", month)
    rows = keyed.join(month_side(changed), F.col("_month") == F.col("_changed"), "left_semi").drop("_month")
    versions.publish(model(rows), name, MONTH, gone=found)
    versions.publish(now, states)
    return sorted(found)
