"""Source contracts (V1, V2, V14, V17): a schema whose fields say what role a column plays.

A contract is a ``StructType``; the metadata of a field hold its role, whether the column may be
absent, and which labels it may carry.  Checks compare a header with the schema, and text columns
are read by the type of their field: a value that is neither missing nor of that type is unreadable,
it never becomes a null or a truncated number unseen.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from riskloom.functions.columns import coerce_numeric, nan_to_null, q
from riskloom.rules import CreditColumns

# FIXED VALUES: texts that stand for a missing value in an upload, in lower case
MISSING_TEXTS = ("", "#n/a", "#n/a n/a", "#na", "-1.#ind", "-1.#qnan", "-nan", "1.#ind", "1.#qnan", "<na>", "n/a", "na",
                 "nan", "none", "null")
#: Features that count something; the others are amounts, ratios or partly missing.
COUNT_ROLES = ("age", "late_30_59", "open_lines", "late_90", "real_estate", "late_60_89")


class SourceContract(NamedTuple):
    """What a source must hold, and whether it must be there at all."""

    name: str
    schema: StructType
    must_exist: bool = True

    def playing(self, role: str) -> StructField | None:
        return next((f for f in self.schema if f.metadata["role"] == role), None)


def column(name: str, kind: DataType, role: str = "feature", may_lack: bool = False, labels: str = "any") -> StructField:
    """A column of a contract.  ``labels``: ``binary`` (only 0 and 1), ``blank`` (no value at all) or ``any``."""
    return StructField(name, kind, True, {"role": role, "may_lack": may_lack, "labels": labels})


def feature_fields(cols: CreditColumns) -> list[StructField]:
    return [column(c, LongType() if cols.role_of(c) in COUNT_ROLES else DoubleType()) for c in cols.features]


def contracts_for(cols: CreditColumns, submission=("Id", "Probability")) -> dict[str, SourceContract]:
    """The labelled, the unlabelled and the sample answer source of a credit table layout."""
    key, score = submission
    given = feature_fields(cols)
    layouts = {
        "train": ([column(cols.id, LongType(), "id"), column(cols.target, IntegerType(), "target", labels="binary"), *given], True),
        "test": ([column(cols.id, LongType(), "id"), *given,
                  column(cols.target, IntegerType(), "target", may_lack=True, labels="blank")], True),
        "sample_submission": ([column(key, LongType(), "id"), column(score, DoubleType())], False),
    }
    return {name: SourceContract(name, StructType(fields), must) for name, (fields, must) in layouts.items()}


def column_status(header: list[str], contract: SourceContract) -> list[tuple[str, str]]:
    """V1, V2: (column, status) of every column of the contract and of every other one of the header.

    Status: ``expected``, ``optional``, ``missing``, ``absent`` (one that may lack), ``unexpected`` or ``repeated``.
    """
    seen = Counter(header)
    out = []
    for f in contract.schema:
        lacks = f.metadata["may_lack"]
        here, gone = ("optional", "absent") if lacks else ("expected", "missing")
        out.append((f.name, "repeated" if seen[f.name] > 1 else here if seen[f.name] else gone))
    known = set(contract.schema.names)
    return out + [(c, "repeated" if n > 1 else "unexpected") for c, n in seen.items() if c not in known]


def repeated_columns(header: list[str]) -> list[str]:
    """V2 on a raw header (Spark's CSV reader renames duplicates, so the header text counts)."""
    return [c for c, n in Counter(header).items() if n > 1]


def _fraction(kind: DataType) -> bool:
    return isinstance(kind, (DoubleType, FloatType))


def is_missing(name: str, kind: DataType) -> Column:
    """Whether a value is missing: null, NaN or a text that stands for it."""
    if isinstance(kind, StringType):
        return q(name).isNull() | F.lower(F.trim(q(name))).isin(*MISSING_TEXTS)
    return q(name).isNull() | (F.isnan(q(name)) if _fraction(kind) else F.lit(False))


def read_as(name: str, kind: DataType, wanted: DataType) -> Column:
    """The value of a column: text by its contract's type, null where it is missing or unreadable; numbers as they are.

    Whole numbers keep all their digits.
    """
    if not isinstance(kind, StringType):
        return nan_to_null(q(name)) if _fraction(kind) else q(name)
    number = coerce_numeric(q(name), kind)
    if _fraction(wanted):
        return number
    digits = F.regexp_extract(F.trim(q(name)), r"^([+-]?\d+)(\.0*)?$", 1).try_cast(wanted)
    return F.coalesce(digits, F.when((number == F.floor(number)) & (F.abs(number) < 2.0 ** 53), number).try_cast(wanted))


def unreadable(name: str, kind: DataType, wanted: DataType) -> Column:
    """Whether a value is there but not of its contract's type."""
    value = read_as(name, kind, wanted)
    if _fraction(kind) and not _fraction(wanted):
        return F.coalesce(value != F.floor(value), F.lit(False))
    return ~is_missing(name, kind) & value.isNull()
