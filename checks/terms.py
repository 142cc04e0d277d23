"""Coefficient and weight tables for the test data: simple formulas of region key and term position."""

from __future__ import annotations

from hammerline.functions.scoring import NONTRUSTEE_MODELS, TIMES, TRUSTEE_MODELS, VALUATION_MODEL
from hammerline.operators.explain import FAULT_NAMES, TRUSTEE_VARIABLES, VARIABLES

MODELS = {m.name: m for m in (*NONTRUSTEE_MODELS, VALUATION_MODEL, *TRUSTEE_MODELS)}
_SIZE = {  # rough size of each term's values, so that no term drowns the others
    "Reserve": 6, "BPO": 6, "BPOSurplus": 6, "TotalActive": 4, "HomeSquareFootage": 3, "MedianPPSQFT": 3,
    "MedianPPSQFTDeviation": 4, "Age": 2, "ForeclosedPer10000": 1, "Favorites": 1, "RunNum": 1, "Cancellations": 2,
    "Postponements": 2, "BPOSurplusPct": 1, "IntrinsicBidderQuality": 1,
}


def _size(term: str) -> int:
    return sum(_SIZE.get(t, 0) for t in term.split(TIMES)) if term != "Intercept" else 0


def coefficient(model: str, position: int, term: str) -> str:
    """SQL for one coefficient: mixed signs, some zeros, sized to the term's scale."""
    sign = -1 if (position * 7 + len(model)) % 3 == 0 else 1
    base = sign * ((position + len(model)) % 9)
    money = 0 if MODELS[model].logistic else 5
    return f"({base} * (r_regionkey + 2) * 1e{money - _size(term) - 2})"


def coefficient_select(model: str) -> str:
    """Wide coefficient table; one state is left without an intercept row to show that it drops out."""
    names = ["Intercept", *MODELS[model].terms]
    values = ", ".join(f"{coefficient(model, i, t)} AS {t}" for i, t in enumerate(names))
    return f"SELECT r_name AS PropertyState, {values} FROM region WHERE r_regionkey <> 4"


def coefficient_long_select(model: str) -> str:
    names = ["Intercept", *MODELS[model].terms]
    parts = [
        f"SELECT r_name AS PropertyState, '{model}' AS model, '{t}' AS term, {coefficient(model, i, t)} AS value "
        "FROM region WHERE r_regionkey <> 4"
        for i, t in enumerate(names)
    ]
    return " UNION ALL ".join(parts)


def weight_select(trustee: bool = False) -> str:
    """Long attribute weights: every variable, the intercept, and one name outside the list."""
    variables = ["Intercept", *(TRUSTEE_VARIABLES if trustee else VARIABLES), "Unlisted"]
    parts = []
    for i, v in enumerate(variables):
        sign = -1 if i % 2 else 1
        name = FAULT_NAMES.get(v, f"{v} Weight").replace("'", "''")
        parts.append(
            f"SELECT r_name AS PropertyState, '{v}' AS PropertyFaultVariable, '{name}' AS PropertyFaultName, "
            f"{sign * (i % 7 + 1)} * (r_regionkey + 2) * 1e{-_size(v) - 2} AS Value FROM region WHERE r_regionkey <> 3")
    return " UNION ALL ".join(parts)


def score_sql(model: str) -> str:
    """The score as the rule states it, over listing alias ``a`` and coefficient alias ``c_<model>``."""
    m = MODELS[model]
    low = "(a.BPO < 0.15 * a.Reserve OR a.BPO IS NULL)"
    special = {
        "BPO": f"(CASE WHEN {low} THEN 1.2 * a.Reserve ELSE a.BPO END)",
        "BPOSurplus": f"(CASE WHEN {low} THEN 1.2 * a.Reserve ELSE a.BPOSurplus END)",
        "BPOSurplusPct": f"(CASE WHEN {low} THEN 0.2 ELSE a.BPOSurplusPct END)",
        "TotalActive": "coalesce(a.TotalActive, 8000)", "Vacancy": "coalesce(a.Vacancy, 0.087)",
    }
    parts = [f"c_{model}.Intercept"]
    for t in m.terms:
        value = special.get(t, " * ".join(f"a.{f}" for f in t.split(TIMES)))
        parts.append(f"{value} * c_{model}.{t}")
    total = " + ".join(parts)
    return f"1 / (1 + exp(0 - ({total})))" if m.logistic else f"({total})"


def contribution_sql(trustee: bool = False) -> str:
    """CASE over the weighted variables of alias ``w``, reading listing alias ``a``."""
    surplus = "(coalesce(a.BPO, 1.2 * a.Reserve) - a.Reserve)"
    special = {"BPOSurplus": surplus, "BPOSurplusPct": f"{surplus} / nullif(a.Reserve, 0)"}
    names = TRUSTEE_VARIABLES if trustee else VARIABLES
    whens = " ".join(f"WHEN '{v}' THEN {special.get(v, 'a.' + v)}" for v in names)
    return f"w.Value * (CASE w.PropertyFaultVariable {whens} ELSE a.ValueLevel_Med END)"


def fault_names_sql() -> str:
    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in FAULT_NAMES.items())
    return f"SELECT * FROM (VALUES {rows}) t(term, name)"


ACCEPTANCE_MODELS = """
  SELECT 'SC' || CAST(r_regionkey AS VARCHAR(20)) AS SellerCode, r_name AS PropertyState, r_regionkey AS Position,
         r_regionkey * 0.3e0 - 0.5e0 AS intercept, -1 - r_regionkey * 0.1e0 AS b1, 0.5e0 AS b2, -0.2e0 AS b3 FROM region
  UNION ALL SELECT 'SC' || CAST(r_regionkey AS VARCHAR(20)), 'ASIA', 10 + r_regionkey, 0.2e0 * r_regionkey, -2e0, 1e0, -0.1e0
  FROM region WHERE r_regionkey < 3
  UNION ALL SELECT 'OTHER', 'OTHER', 99, 0.1e0, -1.5e0, 0.3e0, 0.05e0 FROM region WHERE r_regionkey = 0"""
