"""Registry of derived loan features.

Each entry is a small rule; ``column`` turns it into a Spark expression. Ratios keep IEEE division, so a
zero divisor gives infinity inside an indicator and NULL as a stored value.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditecho.config import DEFAULT_SELECTED, FEATURE_KINDS, QUANTILE_COLUMNS
from creditecho.functions.numeric import finite, guarded_div, ieee_div, indicator
from creditecho.operators.totals import quantile_struct

QUANTILES = {"q20": 0.2, "q25": 0.25, "q75": 0.75, "q80": 0.8}


@dataclass(frozen=True)
class Ratio:
    """Quotient of two arithmetic terms; ``guarded`` adds 1e-6 to the divisor."""

    top: str
    bottom: str
    guarded: bool = False
    squared: bool = False

    def raw(self) -> Column:
        divide = guarded_div if self.guarded else ieee_div
        return divide(F.expr(self.top), F.expr(self.bottom))

    def column(self) -> Column:
        x = self.raw()
        return finite(x * x if self.squared else x)


@dataclass(frozen=True)
class Arithmetic:
    term: str

    def column(self) -> Column:
        return F.expr(self.term).cast("double")


@dataclass(frozen=True)
class Curve:
    """square, log1p or sqrt of one input."""

    name: str
    of: str

    def column(self) -> Column:
        x = F.col(self.of).cast("double")
        if self.name == "square":
            return finite(x * x)
        return finite(F.log1p(x) if self.name == "log1p" else F.sqrt(x))


@dataclass(frozen=True)
class Flag:
    condition: str

    def column(self) -> Column:
        return indicator(F.expr(self.condition))


@dataclass(frozen=True)
class RatioFlag:
    ratio: Ratio
    op: str
    level: float

    def column(self) -> Column:
        x = self.ratio.raw()
        return indicator(x > self.level if self.op == ">" else x < self.level)


@dataclass(frozen=True)
class QuantileFlag:
    of: str
    op: str
    quantile: str

    def column(self) -> Column:
        level = F.col("_stats")[self.of][self.quantile]
        x = F.col(self.of)
        return indicator(x > level if self.op == ">" else x < level)


@dataclass(frozen=True)
class RoundedFlag:
    of: str
    step: int = 1000

    def column(self) -> Column:
        return indicator(F.pmod(F.col(self.of), F.lit(self.step)) == 0)


@dataclass(frozen=True)
class TextLength:
    of: str

    def column(self) -> Column:
        return F.length(F.col(self.of)).cast("double")


_UTIL = Ratio("tot_cur_bal", "total_rev_hi_lim")
_LOAN_INC = Ratio("loan_amnt", "annual_inc")
_BAL_INC = Ratio("tot_cur_bal", "annual_inc")
_LTI = Ratio("loan_amnt", "annual_inc", guarded=True)
_UTIL_SAFE = Ratio("tot_cur_bal", "total_rev_hi_lim", guarded=True)
_OPEN_SHARE = Ratio("open_acc", "total_acc", guarded=True)

# The 98 feature names and what each one computes.
FEATURES = {
    # guarded ratios
    "DTI": Ratio("installment", "annual_inc", guarded=True),
    "Credit_Utilization": _UTIL_SAFE,
    "Payment_to_Income_Ratio": Ratio("installment", "annual_inc / 12", guarded=True),
    "Average_Credit_Line_Size": Ratio("tot_cur_bal", "open_acc", guarded=True),
    "lti": _LTI,
    "loan_to_income": _LTI,
    "utilization_rate": _UTIL_SAFE,
    "util_ratio": _UTIL_SAFE,
    "account_age_ratio": _OPEN_SHARE,
    "open_acc_ratio": _OPEN_SHARE,
    "lti_sq": Ratio("loan_amnt", "annual_inc", guarded=True, squared=True),
    "util_ratio_sq": Ratio("tot_cur_bal", "total_rev_hi_lim", guarded=True, squared=True),
    # balance, collection and limit ratios
    "debt_to_income": _BAL_INC,
    "balance_to_income": _BAL_INC,
    "collection_to_income": Ratio("tot_coll_amt", "annual_inc"),
    "limit_to_income": Ratio("total_rev_hi_lim", "annual_inc"),
    "collection_ratio": Ratio("tot_coll_amt", "tot_cur_bal"),
    "collection_to_limit": Ratio("tot_coll_amt", "total_rev_hi_lim"),
    "balance_to_limit": _UTIL,
    "available_credit_ratio": Ratio("total_rev_hi_lim - tot_cur_bal", "total_rev_hi_lim"),
    "utilization_rate_squared": Ratio("tot_cur_bal", "total_rev_hi_lim", squared=True),
    "debt_to_income_total": Ratio("tot_cur_bal + loan_amnt", "annual_inc"),
    "balance_per_account": Ratio("tot_cur_bal", "total_acc"),
    "balance_per_open_account": Ratio("tot_cur_bal", "open_acc"),
    "collection_per_account": Ratio("tot_coll_amt", "total_acc"),
    "limit_per_account": Ratio("total_rev_hi_lim", "total_acc"),
    # loan ratios
    "partial_payment": Ratio("tot_coll_amt", "loan_amnt"),
    "loan_per_month": Ratio("loan_amnt", "term"),
    "loan_per_term_month": Ratio("loan_amnt", "term"),
    "loan_to_balance": Ratio("loan_amnt", "tot_cur_bal"),
    "loan_to_limit": Ratio("loan_amnt", "total_rev_hi_lim"),
    "loan_to_monthly_income": Ratio("loan_amnt", "annual_inc / 12"),
    "loan_per_year": Ratio("loan_amnt", "emp_length + 1"),
    "loan_income_ratio_squared": Ratio("loan_amnt", "annual_inc", squared=True),
    # income, account and employment ratios
    "income_per_account": Ratio("annual_inc", "total_acc"),
    "inc_per_open_acc": Ratio("annual_inc", "open_acc + 1"),
    "income_per_emp_year": Ratio("annual_inc", "emp_length + 1"),
    "closed_account_ratio": Ratio("total_acc - open_acc", "total_acc"),
    "accounts_per_year": Ratio("total_acc", "emp_length + 1"),
    "open_accounts_per_year": Ratio("open_acc", "emp_length + 1"),
    "delinq_per_account": Ratio("delinq_2yrs", "total_acc"),
    "delinq_per_open_account": Ratio("delinq_2yrs", "open_acc"),
    # sums, differences and products
    "closed_accounts": Arithmetic("total_acc - open_acc"),
    "credit_history_proxy": Arithmetic("total_acc - open_acc"),
    "income_per_month": Arithmetic("annual_inc / 12"),
    "monthly_inc": Arithmetic("annual_inc / 12"),
    "available_credit": Arithmetic("total_rev_hi_lim - tot_cur_bal"),
    "total_debt": Arithmetic("tot_cur_bal + loan_amnt"),
    "net_worth_estimate": Arithmetic("annual_inc - tot_cur_bal - loan_amnt"),
    "loan_income_interaction": Arithmetic("loan_amnt * annual_inc"),
    "balance_limit_interaction": Arithmetic("tot_cur_bal * total_rev_hi_lim"),
    "loan_emp_interaction": Arithmetic("loan_amnt * emp_length"),
    "income_emp_interaction": Arithmetic("annual_inc * emp_length"),
    "loan_accounts_interaction": Arithmetic("loan_amnt * total_acc"),
    "balance_accounts_interaction": Arithmetic("tot_cur_bal * total_acc"),
    "inc_x_delinq": Arithmetic("annual_inc * (delinq_2yrs + 1)"),
    "loan_x_term": Arithmetic("loan_amnt * term"),
    # curves
    "income_squared": Curve("square", "annual_inc"),
    "income_log": Curve("log1p", "annual_inc"),
    "income_sqrt": Curve("sqrt", "annual_inc"),
    "loan_squared": Curve("square", "loan_amnt"),
    "loan_log": Curve("log1p", "loan_amnt"),
    "loan_sqrt": Curve("sqrt", "loan_amnt"),
    "balance_squared": Curve("square", "tot_cur_bal"),
    "balance_log": Curve("log1p", "tot_cur_bal"),
    "balance_sqrt": Curve("sqrt", "tot_cur_bal"),
    "collection_squared": Curve("square", "tot_coll_amt"),
    "collection_log": Curve("log1p", "tot_coll_amt"),
    "limit_squared": Curve("square", "total_rev_hi_lim"),
    "limit_log": Curve("log1p", "total_rev_hi_lim"),
    "emp_length_squared": Curve("square", "emp_length"),
    "emp_length_log": Curve("log1p", "emp_length"),
    # indicators
    "has_delinquency": Flag("delinq_2yrs > 0"),
    "has_multiple_delinq": Flag("delinq_2yrs > 1"),
    "has_collection": Flag("tot_coll_amt > 0"),
    "term_36": Flag("term = 36"),
    "term_60": Flag("term = 60"),
    "long_employment": Flag("emp_length >= 5"),
    "short_employment": Flag("emp_length < 2"),
    "new_employee": Flag("emp_length = 0"),
    "high_utilization": RatioFlag(_UTIL, ">", 0.8),
    "low_utilization": RatioFlag(_UTIL, "<", 0.2),
    "high_risk_utilization": RatioFlag(_UTIL, ">", 0.9),
    "high_risk_loan": RatioFlag(_LOAN_INC, ">", 0.5),
    "high_risk_debt": RatioFlag(_BAL_INC, ">", 2.0),
    "is_loan_amnt_rounded": RoundedFlag("loan_amnt"),
    "is_annual_inc_rounded": RoundedFlag("annual_inc"),
    # indicators against fitted quantiles
    "high_income": QuantileFlag("annual_inc", ">", "q75"),
    "low_income": QuantileFlag("annual_inc", "<", "q25"),
    "high_loan": QuantileFlag("loan_amnt", ">", "q75"),
    "low_loan": QuantileFlag("loan_amnt", "<", "q25"),
    "many_accounts": QuantileFlag("total_acc", ">", "q75"),
    "few_accounts": QuantileFlag("total_acc", "<", "q25"),
    "many_open_accounts": QuantileFlag("open_acc", ">", "q75"),
    "few_open_accounts": QuantileFlag("open_acc", "<", "q25"),
    "inc_group_high": QuantileFlag("annual_inc", ">", "q80"),
    "inc_group_low": QuantileFlag("annual_inc", "<", "q20"),
    # text
    "emp_title_length": TextLength("emp_title"),
}


def fit_stats(df: DataFrame, columns: Iterable[str] = QUANTILE_COLUMNS) -> DataFrame:
    """One-row table of the quantiles used by indicators; store it to score other tables."""
    present = [c for c in columns if c in df.columns]
    return quantile_struct(df, present, list(QUANTILES.values()), list(QUANTILES))


def _inputs(rule) -> set[str]:
    """Column names a rule reads."""
    if isinstance(rule, RatioFlag):
        return _inputs(rule.ratio)
    text = " ".join(str(getattr(rule, f, "")) for f in ("top", "bottom", "term", "of", "condition"))
    for sign in "+-*/()<>=":
        text = text.replace(sign, " ")
    return {w for w in text.split() if not w[0].isdigit()}


def skipped_features(df: DataFrame, selected: Iterable[str]) -> list[str]:
    """Registered features whose input columns are missing from ``df``."""
    return [n for n in selected if n in FEATURES and not _inputs(FEATURES[n]) <= set(df.columns)]


def engineer_features(
    df: DataFrame,
    selected: Iterable[str] | None = None,
    stats: DataFrame | None = None,
    extra: dict[str, Callable[[], Column]] | None = None,
) -> DataFrame:
    """Adds the selected features (all by default) in one projection.

    ``stats`` comes from ``fit_stats`` on the training part; without it the frame itself is used.
    ``extra`` adds user features as functions returning a Column.
    """
    extra = extra or {}
    wanted = list(selected) if selected is not None else list(FEATURES) + list(extra)
    skip = set(skipped_features(df, wanted))
    names = [n for n in wanted if n in FEATURES and n not in skip]
    columns = {n: FEATURES[n].column() for n in names} | {n: extra[n]() for n in wanted if n in extra}
    if not columns:
        return df
    if any(isinstance(FEATURES.get(n), QuantileFlag) for n in names):
        stats = stats if stats is not None else fit_stats(df)
        df = df.withColumn("_stats", stats.select(F.struct(*stats.columns)).scalar())
        return df.withColumns(columns).drop("_stats")
    return df.withColumns(columns)


def select_features(df: DataFrame, requested: Iterable[str] = DEFAULT_SELECTED) -> tuple[DataFrame, list[str]]:
    """Keeps the requested columns that exist; also returns the missing names."""
    requested = list(requested)
    available = [c for c in requested if c in df.columns]
    return df.select(*available), [c for c in requested if c not in df.columns]


def feature_lists(config: dict = FEATURE_KINDS) -> dict[str, list[str]]:
    return {kind: list(columns) for kind, columns in config.items()}


def feature_lists_frame(df: DataFrame, config: dict = FEATURE_KINDS) -> DataFrame:
    """(kind, feature, available) rows, with the number of known values from the table."""
    names = [(k, c) for k, cs in config.items() for c in cs]
    known = df.agg(*[(F.count(F.col(c)) if c in df.columns else F.lit(0)).alias(c) for _, c in names])
    long = known.unpivot([], [c for _, c in names], "feature", "known_values")
    kinds = F.create_map(*[F.lit(x) for k, c in names for x in (c, k)])
    present = F.array(*[F.lit(c) for c in df.columns])
    return long.select(
        kinds[F.col("feature")].alias("kind"), "feature",
        F.array_contains(present, F.col("feature")).alias("available"), "known_values",
    )


def validate_features(df: DataFrame, config: dict = FEATURE_KINDS) -> DataFrame:
    """Per kind: available and missing names and whether all are present."""
    lists = feature_lists_frame(df, config)
    return lists.groupBy("kind").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("available"), F.col("feature")))), ",").alias("available"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("available"), F.col("feature")))), ",").alias("missing"),
        F.bool_and("available").alias("all_valid"),
    )


def classify_columns(df: DataFrame, listed: Iterable[str], threshold: int = 10) -> DataFrame:
    """Kinds for unlisted columns: numeric by type, else by the number of distinct values."""
    rest = [(c, t) for c, t in df.dtypes if c not in set(listed)]
    numeric = {c for c, t in rest if t in ("int", "bigint", "float", "double")}
    counts = df.agg(*[F.count_distinct(F.col(c)).alias(c) for c, _ in rest])
    long = counts.unpivot([], [c for c, _ in rest], "feature", "n_distinct")
    is_number = F.col("feature").isin(*numeric) if numeric else F.lit(False)
    kind = (
        F.when(is_number, "numeric_features")
        .when(F.col("n_distinct") <= threshold, "low_cardinality_nominal")
        .otherwise("high_cardinality_nominal")
    )
    return long.select("feature", "n_distinct", kind.alias("kind"))
