"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# A number as the reference's numeric coercion understands it.  Spark's cast
# also accepts 'NaN', 'Infinity', '1d' or '1f'; those must stay unparseable.
NUMERIC_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def q(name: str) -> Column:
    """Column by exact name (names may contain '-', ':' or spaces)."""
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def coerce_numeric(c: Column, dtype=None) -> Column:
    """string/number -> double; anything unparseable -> NULL (never raises, ANSI-safe).
    A numeric input needs no parsing: cast, with NaN folded into NULL."""
    if isinstance(dtype, NumericType):
        return nan_to_null(c.cast("double"))
    s = F.trim(c.cast("string"))
    return F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double")).otherwise(F.lit(None).cast("double"))


def clip(c: Column, lower: float | None, upper: float | None) -> Column:
    """Spark's greatest/least skip nulls, so keep missing values missing explicitly."""
    out = c
    if lower is not None:
        out = F.greatest(out, F.lit(float(lower)))
    if upper is not None:
        out = F.least(out, F.lit(float(upper)))
    return F.when(c.isNotNull(), out)


def stack(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), name: str = "column",
          value: str = "value") -> DataFrame:
    """Wide -> long ``(keep..., column, value)`` with values as double (one row per cell)."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), nan_to_null(q(c).cast("double")).alias(value))
                      for c in columns])
    return df.select(*[q(k) for k in keep], F.inline(pairs))
