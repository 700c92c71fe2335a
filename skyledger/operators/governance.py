"""Role-based projections: which columns of a table a role may see, and how."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.masks import CODE_MASK_SQL, KEY_SQL, RANGE_SQL, RANGE_WIDTH

# The published columns of the masked medication dimension, as (expression,
# name). Co-payment columns are left out.
MASKED_MEDICATIONS = [
    ("medication_id", "medication_id"),
    ("year", "year"),
    ("month", "month"),
    ("ingredient", "ingredient"),
    ("atc_code", "atc_code"),
    (CODE_MASK_SQL.format(code="package_code"), "package_code_masked"),
    (KEY_SQL.format(text="package_label"), "package_label_masked"),
    ("total_packages", "total_packages"),
    ("total_amount", "total_amount"),
    ("health_insurance_amount", "health_insurance_amount"),
    ("amount_over_reference_price", "amount_over_reference_price"),
    (RANGE_SQL.format(count="total_prescriptions", width=RANGE_WIDTH), "total_prescriptions_range"),
    ("total_persons", "total_persons"),
]

# Role -> table -> projection; None shows the table as it is. Other pairs are denied.
POLICY = {
    "analyst_full": {
        "dim_medications": None,
        "dim_weather": None,
        "dim_sunshine": None,
        "dim_date": None,
    },
    "analyst_limited": {
        "dim_medications": MASKED_MEDICATIONS,
        "dim_weather": None,
        "dim_sunshine": None,
        "dim_date": None,
    },
}


def governed(df: DataFrame, role: str, table: str) -> DataFrame:
    """What a role may see of a table. The masks are plain projections, so filters
    on visible columns still reach the scan."""
    try:
        projection = POLICY[role][table]
    except KeyError:
        raise PermissionError(f"role {role!r} may not read {table!r}") from None
    if projection is None:
        return df
    return df.select(*[F.expr(expression).alias(name) for expression, name in projection])


def masked_medications(dim: DataFrame) -> DataFrame:
    return governed(dim, "analyst_limited", "dim_medications")


def role_views(role: str, frames: Mapping[str, DataFrame]) -> dict[str, str]:
    """Temporary views ``<role>_<table>`` of what a role may see; returns their names by table."""
    names = {table: f"{role}_{table}" for table in frames}
    for table, df in frames.items():
        governed(df, role, table).createOrReplaceTempView(names[table])
    return names


def view_queries(gold: str) -> dict[str, str]:
    """SQL of the published views over the gold database."""
    masked = ", ".join(f"{expression} AS {name}" for expression, name in MASKED_MEDICATIONS)
    views = {f"{gold}.v_medications_masked": f"SELECT {masked} FROM {gold}.dim_medications"}
    for subject in ("medications", "weather", "sunshine", "date"):
        views[f"{gold}.v_{subject}_full"] = f"SELECT * FROM {gold}.dim_{subject}"
    for subject in ("weather", "sunshine", "date"):
        views[f"{gold}.v_{subject}_masked"] = f"SELECT * FROM {gold}.dim_{subject}"
    return views
