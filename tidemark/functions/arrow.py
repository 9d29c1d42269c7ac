"""Arrow UDFs around small string helpers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F


def series_udf(change: Callable[[pd.Series], pd.Series]):
    """A string UDF that calls ``change`` on the distinct non-null values of a batch."""

    @F.pandas_udf("string")
    def apply(values: pd.Series) -> pd.Series:
        codes, distinct = pd.factorize(values)
        done = change(pd.Series(distinct, dtype=object)) if len(distinct) else pd.Series(dtype=object)
        return done.reindex(codes).set_axis(values.index)

    return apply


def text_udf(change: Callable[[str], str]):
    """A string UDF that calls ``change`` once per distinct non-null value of a batch."""
    return series_udf(lambda values: values.map(change))
