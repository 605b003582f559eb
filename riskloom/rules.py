"""Column roles and the fixed values the results depend on.

Operators never hard-code column names: a ``CreditColumns`` maps each role to
a column of the caller's table.  ``CASES_COLUMNS`` is the mapping for the
derived ``cases`` relation used by the registered queries.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES - must equal the reference's for equal results.
# Warning cut-offs for the data-quality rules.
AGE_MIN = 18
AGE_MAX = 100
UTILIZATION_MAX = 1.0
DEBT_RATIO_MAX = 5.0
DELINQUENCY_MAX = 20
# Profiling-only cut-offs.
DELINQUENCY_EXTREME = 50
# Clip rules (lower, upper) by role.
CLIP_RULES = {
    "age": (18.0, 100.0),
    "utilization": (0.0, 1.0),
    "debt_ratio": (0.0, 5.0),
    "late_30_59": (0.0, 20.0),
    "late_60_89": (0.0, 20.0),
    "late_90": (0.0, 20.0),
}
# Roles with a missing indicator, in output order.
MISSING_INDICATOR_ROLES = ("income", "dependents")
# Scoring: optional inputs, integer-like inputs, non-negative inputs (by role).
OPTIONAL_INPUT_ROLES = ("income", "dependents")
INTEGER_LIKE_ROLES = ("age", "late_30_59", "open_lines", "late_90", "real_estate", "late_60_89", "dependents")
NON_NEGATIVE_ROLES = ("utilization", "debt_ratio", "income", "late_30_59", "open_lines", "late_90",
                      "real_estate", "late_60_89", "dependents")
INTEGER_TOLERANCE = 1e-9
LOW_RISK_CUTOFF = 0.10
# Threshold search: fixed candidates added to the quantile grid.
FIXED_THRESHOLD_CANDIDATES = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
DEFAULT_MAX_CANDIDATES = 201
# Champion rule.
CHAMPION_AP_TOLERANCE = 0.02
CHAMPION_MAX_BRIER = 0.06
# Split defaults.
SPLIT_TRAIN, SPLIT_VALIDATION, SPLIT_TEST, SPLIT_SEED = 0.70, 0.15, 0.15, 42
# Warning sentences (validation report).
MSG_AGE_BELOW = "Detected {n} rows with age below 18."
MSG_AGE_ABOVE = "Detected {n} rows with age above 100."
MSG_UTILIZATION = "Detected rows where revolving utilization exceeds 1.0."
MSG_DEBT_RATIO = "Detected rows where debt ratio exceeds 5.0."
MSG_INCOME = "Detected rows with non-positive monthly income values."
MSG_DEPENDENTS = "Detected rows with negative dependent counts."
MSG_DELINQUENCY = "Detected rows with unusually large delinquency counts in: {cols}."
MSG_DUPLICATE_COLUMNS = "Duplicate column names detected."
MSG_MISSING_COLUMNS = "Required columns are missing."
MSG_UNEXPECTED_COLUMNS = "Unexpected columns are present."
MSG_ID_MISSING = "Identifier column '{col}' is missing."
MSG_ID_NOT_UNIQUE = "Identifier column is not unique."
MSG_TARGET_MISSING = "Target column '{col}' is missing."
MSG_TARGET_NOT_BINARY = "Target column contains values outside {0, 1}."
MSG_TARGET_NOT_EMPTY = "Target column contains values in a file that should be unlabeled."
MSG_TARGET_PLACEHOLDER = "Target placeholder column is present in the unlabeled test file."
MSG_EMPTY_FILE = "File is empty."
MSG_FILE_MISSING = "File does not exist."
# Row-level scoring messages.
MSG_FIELD_REQUIRED = "Field '{col}' is required."
MSG_FIELD_NUMERIC = "Field '{col}' must be numeric."
MSG_AGE_MINIMUM = "Field 'age' must be at least 18."
MSG_FIELD_NON_NEGATIVE = "Field '{col}' must be non-negative."
MSG_FIELD_INTEGER = "Field '{col}' must be integer-like."
# Risk band labels.
BAND_LOW, BAND_MEDIUM, BAND_HIGH = "Low", "Medium", "High"
# END FIXED VALUES
# ---------------------------------------------------------------------------

DELINQUENCY_ROLES = ("late_30_59", "late_60_89", "late_90")
FEATURE_ROLES = ("utilization", "age", "late_30_59", "debt_ratio", "income", "open_lines", "late_90",
                 "real_estate", "late_60_89", "dependents")


@dataclass(frozen=True)
class CreditColumns:
    """Role -> column name mapping of one table."""

    id: str
    target: str
    utilization: str
    age: str
    late_30_59: str
    debt_ratio: str
    income: str
    open_lines: str
    late_90: str
    real_estate: str
    late_60_89: str
    dependents: str
    extra: dict = field(default_factory=dict)

    def col(self, role: str) -> str:
        return getattr(self, role)

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(self.col(r) for r in FEATURE_ROLES)

    @property
    def delinquency(self) -> tuple[str, ...]:
        return tuple(self.col(r) for r in DELINQUENCY_ROLES)

    def clip_rules(self) -> dict[str, tuple[float | None, float | None]]:
        return {self.col(role): bounds for role, bounds in CLIP_RULES.items()}

    def missing_indicators(self) -> tuple[str, ...]:
        return tuple(self.col(r) for r in MISSING_INDICATOR_ROLES)

    def role_of(self, column: str) -> str | None:
        for role in ("id", "target", *FEATURE_ROLES):
            if self.col(role) == column:
                return role
        return None


CASES_COLUMNS = CreditColumns(
    id="case_id", target="target", utilization="utilization", age="age", late_30_59="late_30_59",
    debt_ratio="debt_ratio", income="income", open_lines="open_lines", late_90="late_90",
    real_estate="real_estate", late_60_89="late_60_89", dependents="dependents",
)
