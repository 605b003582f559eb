"""The full summary against its parts, and what it makes once."""
import random

from riskloom import rules as R
from riskloom.operators import profile as E

C = R.CASES_COLUMNS


def credit_rows(spark):
    rng = random.Random(5)
    kinds = [(f, "double" if f in (C.utilization, C.debt_ratio, C.income, C.dependents) else "long") for f in R.CASES_COLUMNS.features]
    rows = [(i, rng.choice([0, 1, None]), *[rng.choice([None, rng.random() * 90]) if kind == "double" else rng.randrange(70) for _, kind in kinds])
            for i in range(120)]
    rows += [(1000 + i, *rows[0][1:]) for i in range(4)]  # copies but for the id
    return spark.createDataFrame(rows, f"{C.id} long, {C.target} int, " + ", ".join(f"{f} {kind}" for f, kind in kinds))


def test_full_summary_equals_its_parts_and_makes_quantiles_once(spark, monkeypatch):
    df = credit_rows(spark)
    exclude = [C.id, C.target]
    parts = {"numeric": E.numeric_summary(df), "extremes": E.extreme_values(df, exclude)}
    want = {(section, r["column"], name): float(r[name]) for section, part in parts.items() for r in part.collect()
            for name in part.columns if name != "column"}
    calls, quantiles = [], E.exact_quantiles
    monkeypatch.setattr(E, "exact_quantiles", lambda *a: calls.append(1) or quantiles(*a))
    summary = E.full_summary(df, C)
    got = {(r.section, r["item"], r.statistic): r.value for r in summary.collect()}
    assert len(calls) == 1  # fails where each part has its own
    assert {k: v for k, v in got.items() if k[0] in parts} == want
    assert got["shape", None, "duplicate_row_count"] == 4 and got["shape", None, "row_count"] == 124
    assert len({k[1] for k in got if k[0] == "numeric"}) == len(df.columns)
