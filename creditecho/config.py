"""Column lists, label maps, word lists and parameter grids."""
from __future__ import annotations

from dataclasses import dataclass, field

# 59 Turkish stop words.
TURKISH_STOP_WORDS = (
    "ve", "veya", "ile", "ama", "gibi", "çok", "daha", "mi", "mı", "mu", "mü", "de", "da", "ki", "bu", "şu", "o",
    "bir", "birçok", "her", "hiç", "olan", "oldu", "olması", "olarak", "için", "üzere", "ise", "yada", "yani",
    "neden", "niye", "çünkü", "fakat", "ancak", "ben", "biz", "siz", "onlar", "hepsi", "şey", "şeyi",
    "var", "yok", "yine", "az", "en", "olanlar", "ettim", "ettik", "ettiniz", "etti", "etmek", "hem",
    "şeklinde", "konu", "konuda", "durum", "durumda",
)

# Employment-length labels in years.
EMPLOYMENT_YEARS = {
    "< 1 year": 0, "1 year": 1, "2 years": 2, "3 years": 3, "4 years": 4, "5 years": 5,
    "6 years": 6, "7 years": 7, "8 years": 8, "9 years": 9, "10+ years": 10,
}

# Column groups of the loan table.
DROP_GROUPS = {
    "data_leakage": ("total_pymnt", "total_pymnt_inv", "last_pymnt_amnt"),
    "multicollinearity": ("funded_amnt", "funded_amnt_inv"),
    "id_columns": ("id", "member_id"),
}
FEATURE_KINDS = {
    "numeric_features": (
        "loan_amnt", "installment", "annual_inc", "delinq_2yrs", "open_acc", "total_acc",
        "tot_coll_amt", "tot_cur_bal", "total_rev_hi_lim",
    ),
    "ordinal_features": ("emp_length",),
    "low_cardinality_nominal": ("term",),
    "high_cardinality_nominal": ("emp_title",),
}
# Chosen derived features and the columns of their quantiles.
DEFAULT_SELECTED = ("DTI", "Credit_Utilization", "Payment_to_Income_Ratio", "Average_Credit_Line_Size", "lti")
NOTEBOOK_SELECTED = (
    "partial_payment", "net_worth_estimate", "high_income", "income_squared", "annual_inc", "income_per_month",
    "monthly_inc",
)
QUANTILE_COLUMNS = ("annual_inc", "loan_amnt", "total_acc", "open_acc")

# Parameter grids of the five classifiers.
PARAM_GRIDS = {
    "logistic_regression": {"C": [0.1, 1.0, 10.0], "penalty": ["l1", "l2"]},
    "hist_gradient_boosting": {
        "max_iter": [100, 200, 300], "max_depth": [3, 5, 7, 10], "learning_rate": [0.01, 0.1, 0.2],
    },
    "knn": {"n_neighbors": [5, 10, 15, 20], "metric": ["euclidean", "manhattan", "minkowski"]},
    "random_forest": {
        "n_estimators": [100, 200, 300], "max_depth": [10, 20, 30, None],
        "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4],
    },
    "xgboost": {
        "n_estimators": [100, 200, 300], "max_depth": [3, 5, 7, 10], "learning_rate": [0.01, 0.1, 0.2],
        "subsample": [0.8, 0.9, 1.0], "colsample_bytree": [0.8, 0.9, 1.0],
    },
}
MODEL_NAMES = tuple(PARAM_GRIDS)
# Share of test rows, seed and number of folds.
TEST_SHARE = 0.2
SEED = 42
FOLDS = 5

# BM25 and rank-fusion constants.
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25
RRF_K = 60
MAX_BM25_ONLY = 1000


@dataclass(frozen=True)
class SearchOptions:
    """Parameters of the two search plans; ``k <= 0`` means every candidate."""

    k_lex: int = 0
    k_vec: int = 0
    rrf_k: int = RRF_K
    min_sim: float = 0.5
    max_bm25_only: int = 0  # 0: all
    limit: int = 0
    sentiment_limit: int = 0  # sentiment of the first results of a query only; 0: of all


@dataclass(frozen=True)
class CreditOptions:
    """Parameters of loan cleaning."""

    target: str = "default_flag"
    drop_groups: tuple = ("id_columns",)
    fill_unknown: tuple = ("emp_title",)
    fill_zero: tuple = ("delinq_2yrs",)
    extra: dict = field(default_factory=dict)
