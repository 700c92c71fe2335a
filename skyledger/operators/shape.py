"""Column shaping: renames, schema conformance."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def tidy_name(name: str) -> str:
    """Header text with every run of white space as one space."""
    return " ".join(str(name).split())


def rename_headers(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename headers to canonical names, matching exactly or after tidying."""
    tidy = {tidy_name(header): canonical for header, canonical in names.items()}
    found = {c: names.get(c, tidy.get(tidy_name(c))) for c in df.columns}
    return df.withColumnsRenamed({c: canonical for c, canonical in found.items() if canonical})


def alias_lookup(aliases: Mapping[str, Iterable[str]]) -> dict[str, str]:
    """``{canonical: headers}`` turned round to ``{tidied header: canonical}``."""
    return {tidy_name(h): canonical for canonical, headers in aliases.items() for h in headers}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of a schema, in order; absent ones become typed nulls."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def empty(df_or_session, schema: StructType) -> DataFrame:
    session = getattr(df_or_session, "sparkSession", df_or_session)
    return session.createDataFrame([], schema)
