"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.text import as_column

# The first 15 hex digits of an md5: 60 bits, never negative, the same in any SQL engine.
KEY_SQL = "cast(conv(substr(md5({text}), 1, 15), 16, 10) as bigint)"


def surrogate_key(
    *parts: Column | str, sep: str = "|", algo: str = "md5", required: bool = False
) -> Column:
    """A key over the text of the parts; null when any part is null.

    Whole numbers of 60 bits with ``md5`` and 63 with ``xxhash64``: among 10^9 keys one pair
    is expected to be equal by chance. ``wide`` keys are binary and hold the whole md5: at
    10^15 keys the chance of any such pair is still under one in a hundred million.

    The separator keeps (2021, 1, '1x') and (2021, 11, 'x') apart. A ``required`` key
    reads absent parts as '' and is never null. Spark knows that, so a later join on
    it does not push a null test, and with it the hash, down to the raw rows.
    """
    spelled: list[Column] = []
    for part in parts:
        if spelled and sep:
            spelled.append(F.lit(sep))
        text = as_column(part).cast("string")
        spelled.append(F.coalesce(text, F.lit("")) if required else text)
    text = F.concat(*spelled)
    if algo == "xxhash64":
        hashed = F.xxhash64(text).bitwiseAND(F.lit((1 << 63) - 1))
        key = F.when(text.isNotNull(), hashed)
    elif algo == "wide":
        return F.unhex(F.md5(F.coalesce(text, F.lit("")) if required else text))
    elif algo == "md5":
        key = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    else:
        raise ValueError(f"unknown key algorithm {algo!r}")
    return F.coalesce(key, F.lit(0)) if required else key
