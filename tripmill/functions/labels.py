"""Code-to-label expressions and the base number rule."""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from tripmill.schemas import PAYMENT_CASE_LABELS, VENDOR_NAMES


def case_label(col: Column | str, labels: Mapping[int, str], default: str | None = None) -> Column:
    """``CASE`` over a mapping; codes outside it give ``default``."""
    col = F.col(col) if isinstance(col, str) else col
    chain = F
    for code, label in labels.items():
        chain = chain.when(col == code, label)
    return chain.otherwise(F.lit(default).cast("string"))


def payment_label(col: Column | str) -> Column:
    return case_label(col, PAYMENT_CASE_LABELS, "Other")


def vendor_label(col: Column | str) -> Column:
    return case_label(col, VENDOR_NAMES)


# Divisor and prefix of the base number rule, tested in this order.
BASE_PREFIXES = ((7, "s"), (3, "a"))
BASE_PREFIX_ELSE = "e"


def base_id(base_num: Column | str) -> Column:
    """Base number such as ``B02884`` to prefix and padded hex, null for unreadable text."""
    base_num = F.col(base_num) if isinstance(base_num, str) else base_num
    number = F.substr(base_num, F.lit(2)).try_cast("int")
    prefix = F
    for divisor, letter in BASE_PREFIXES:
        prefix = prefix.when(number % divisor == 0, letter)
    prefix = prefix.otherwise(BASE_PREFIX_ELSE)
    return F.when(number.isNotNull(),
                  F.concat(prefix, F.lit("/"), F.format_string("%03x", number)))


@F.pandas_udf(T.StringType())
def base_id_udf(base_num: pd.Series) -> pd.Series:
    """The same rule as a vectorised function, for callers that need a registered UDF."""
    number = pd.to_numeric(base_num.str[1:], errors="coerce")
    known = number.dropna().astype("int64")
    out = pd.Series([None] * len(base_num), index=base_num.index, dtype=object)
    prefix = pd.Series(BASE_PREFIX_ELSE, index=known.index)
    for divisor, letter in reversed(BASE_PREFIXES):
        prefix = prefix.mask(known % divisor == 0, letter)
    out.loc[known.index] = prefix + "/" + known.map("{:03x}".format)
    return out
