"""Result typing shared by the registered queries.

Exact decimals are kept inside the library; at the query boundary a whole
number decimal becomes ``bigint`` and a fractional one ``double`` so results
compare by value with other engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("bigint" if f.dataType.scale == 0 else "double")
        cols.append(c.alias(f.name))
    return df.select(*cols)
