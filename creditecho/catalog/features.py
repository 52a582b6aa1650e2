"""One query per derived loan feature; the DuckDB text is spelled from the same rule."""
from __future__ import annotations

from pyspark.sql import functions as F

from creditecho.catalog.loans import numeric_loans
from creditecho.catalog.registry import Registry, rounded
from creditecho.catalog.views import LOANS_NUM
from creditecho.operators import features as X

R = Registry()
_LOW, _HIGH = "CAST('-infinity' AS DOUBLE)", "CAST('infinity' AS DOUBLE)"


def _divide(r: X.Ratio) -> str:
    a, b = f"CAST({r.top} AS DOUBLE)", f"({r.bottom})"
    if r.guarded:
        return f"({a} / ({b} + 1e-6))"
    return f"(CASE WHEN {b} = 0 THEN CASE WHEN {a} > 0 THEN {_HIGH} WHEN {a} < 0 THEN {_LOW} END ELSE {a} / {b} END)"


def _finite(x: str) -> str:
    return f"CASE WHEN isfinite({x}) THEN {x} END"


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def spell(rule) -> tuple[str, str]:
    """DuckDB expression of a rule, with the statistics it reads."""
    if isinstance(rule, X.Ratio):
        x = _divide(rule)
        return _finite(f"({x} * {x})" if rule.squared else x), ""
    if isinstance(rule, X.Arithmetic):
        return f"CAST({rule.term} AS DOUBLE)", ""
    if isinstance(rule, X.Curve):
        c = f"CAST({rule.of} AS DOUBLE)"
        if rule.name == "square":
            return f"{c} * {c}", ""
        if rule.name == "sqrt":
            return f"CASE WHEN {c} >= 0 THEN sqrt({c}) END", ""
        return f"CASE WHEN {c} > -1 THEN ln(1 + {c}) END", ""
    if isinstance(rule, X.Flag):
        return _flag(rule.condition), ""
    if isinstance(rule, X.RatioFlag):
        return _flag(f"{_divide(rule.ratio)} {rule.op} {rule.level}"), ""
    if isinstance(rule, X.RoundedFlag):
        return _flag(f"{rule.of} % {rule.step} = 0"), ""
    if isinstance(rule, X.TextLength):
        return f"CAST(length({rule.of}) AS DOUBLE)", ""
    q = X.QUANTILES[rule.quantile]
    return _flag(f"{rule.of} {rule.op} s.q"), f", (SELECT quantile_cont(CAST({rule.of} AS DOUBLE), {q}) AS q FROM num) s"


def _is_rounded(rule) -> bool:
    """Engines differ in the last digit of a logarithm."""
    return isinstance(rule, X.Curve) and rule.name == "log1p"


def _register(name: str, rule) -> None:
    text, stats = spell(rule)
    curve = _is_rounded(rule)

    @R.add(f"feat_{name}", f"WITH {LOANS_NUM} SELECT id, {f'round({text}, 6)' if curve else text} AS {name} FROM num{stats}")
    def _(spark, sf):
        out = X.engineer_features(numeric_loans(spark, sf, isinstance(rule, X.QuantileFlag)), [name]).select("id", name)
        return rounded(out) if curve else out


for _name, _rule in X.FEATURES.items():
    _register(_name, _rule)


def _whole() -> tuple[list[str], str]:
    """Output columns of all features and the statistics that they read, each under a name of its own."""
    columns, tables = [], []
    for n, rule in X.FEATURES.items():
        text, stats = spell(rule)
        if stats:
            text, stats = text.replace(" s.q", f" s{len(tables)}.q"), stats.replace(") s", f") s{len(tables)}")
            tables.append(stats)
        columns.append(f"{f'round({text}, 6)' if _is_rounded(rule) else text} AS {n}")
    return columns, "".join(tables)


_COLUMNS, _STATS = _whole()


@R.add("engineer_features", f"WITH {LOANS_NUM} SELECT id, {', '.join(_COLUMNS)} FROM num{_STATS}")
def _(spark, sf):
    out = X.engineer_features(numeric_loans(spark, sf, True), list(X.FEATURES))
    return out.select("id", *[(F.round(n, 6) + 0.0).alias(n) if _is_rounded(r) else F.col(n) for n, r in X.FEATURES.items()])
