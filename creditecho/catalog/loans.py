"""Loan queries: cleaning, quality, statistics."""
from __future__ import annotations

from pyspark.sql import functions as F

from creditecho.catalog.registry import Registry, rounded
from creditecho.catalog.views import CAPPED, CLEAN_NUMERIC, CLEANED, LOANS, LOANS_NUM, YEARS
from creditecho.config import FEATURE_KINDS, QUANTILE_COLUMNS
from creditecho.operators import cleaning as C
from creditecho.operators import describe as D
from creditecho.operators import features as X
from creditecho.sources.readers import read_loans
from creditecho.sources.sinks import work_folder
from creditecho.sources.tables import loans, stored_loans

R = Registry()
NUMERIC = list(FEATURE_KINDS["numeric_features"])


def numeric_loans(spark, sf, stored=False):
    source = stored_loans if stored else loans
    return source(spark, sf).withColumn("emp_length", C.employment_years(F.col("emp_length")))


def cleaned_loans(spark, sf):
    return C.clean_loans(stored_loans(spark, sf), keep=("id",)).data


@R.add("src_loans", f"WITH {LOANS} SELECT * FROM loans")
def _(spark, sf):
    folder = work_folder(spark, "loans")
    loans(spark, sf).write.parquet(folder)
    return read_loans(spark, folder)


@R.add("drop_cols", f"WITH {LOANS} SELECT * EXCLUDE (id, member_id) FROM loans")
def _(spark, sf):
    return C.drop_columns(loans(spark, sf), ["id", "member_id", "not_there"])[0]


@R.add("emp_length_num", f"WITH {LOANS_NUM} SELECT id, emp_length FROM num")
def _(spark, sf):
    return numeric_loans(spark, sf).select("id", "emp_length")


@R.add("clamp_business", f"""WITH {CAPPED} SELECT id, loan_amnt, funded_amnt, funded_amnt_inv, total_pymnt,
  total_pymnt_inv, last_pymnt_amnt FROM cap""")
def _(spark, sf):
    return C.clamp_business(loans(spark, sf)).select(
        "id", "loan_amnt", "funded_amnt", "funded_amnt_inv", "total_pymnt", "total_pymnt_inv", "last_pymnt_amnt"
    )


@R.add("clamp_violations", f"""WITH {CAPPED} SELECT
  (SELECT count(*) FROM loans WHERE funded_amnt > loan_amnt) AS funded_amnt_over_loan_amnt,
  (SELECT count(*) FROM cap1 WHERE funded_amnt_inv > funded_amnt) AS funded_amnt_inv_over_funded_amnt,
  (SELECT count(*) FROM loans WHERE total_pymnt_inv > total_pymnt) AS total_pymnt_inv_over_total_pymnt,
  (SELECT count(*) FROM loans WHERE last_pymnt_amnt > total_pymnt) AS last_pymnt_amnt_over_total_pymnt""")
def _(spark, sf):
    return C.clamp_violations(loans(spark, sf))


@R.add("fill_const", f"""WITH {LOANS} SELECT id, coalesce(emp_title,'Unknown') AS emp_title,
  coalesce(delinq_2yrs,0) AS delinq_2yrs FROM loans""")
def _(spark, sf):
    return C.fill_constants(loans(spark, sf)).select("id", "emp_title", "delinq_2yrs")


_FILL = ["emp_length", "open_acc", "total_acc", "tot_cur_bal", "total_rev_hi_lim", "tot_coll_amt"]


@R.add("fill_median", f"""WITH {LOANS_NUM}, m AS (SELECT {", ".join(f"quantile_cont(CAST({c} AS DOUBLE),0.5) AS {c}" for c in _FILL)} FROM num)
SELECT id, {", ".join(f"round(coalesce(CAST(n.{c} AS DOUBLE), m.{c}),6) AS {c}" for c in _FILL)} FROM num n, m""")
def _(spark, sf):
    return rounded(C.fill_median(numeric_loans(spark, sf, True), _FILL).select("id", *_FILL))


@R.add("clean_data", f"WITH {CLEANED} SELECT id, {', '.join(f'round({c},6) AS {c}' for c in CLEAN_NUMERIC)}, emp_title, default_flag FROM cleaned")
def _(spark, sf):
    return rounded(cleaned_loans(spark, sf))


@R.add("select_features", f"""WITH {LOANS_NUM} SELECT installment/(annual_inc+1e-6) AS DTI,
  tot_cur_bal/(total_rev_hi_lim+1e-6) AS Credit_Utilization,
  installment/(annual_inc/12+1e-6) AS Payment_to_Income_Ratio,
  tot_cur_bal/(open_acc+1e-6) AS Average_Credit_Line_Size,
  loan_amnt/(annual_inc+1e-6) AS lti FROM num""")
def _(spark, sf):
    return X.select_features(X.engineer_features(numeric_loans(spark, sf)))[0]


@R.add("feature_lists")
def _(spark, sf):
    return X.feature_lists_frame(loans(spark, sf))


@R.add("validate_features", f"""WITH {LOANS}, have AS (SELECT unnest(['emp_length','emp_title','term','annual_inc','delinq_2yrs',
  'installment','loan_amnt','open_acc','tot_coll_amt','tot_cur_bal','total_acc','total_rev_hi_lim']) AS f)
SELECT 'numeric_features' AS kind, string_agg(f, ',' ORDER BY f) AS available, '' AS missing, (SELECT count(*) FROM loans) > 0 AS all_valid
  FROM have WHERE f NOT IN ('emp_length','emp_title','term')
UNION ALL SELECT 'ordinal_features', 'emp_length', '', true
UNION ALL SELECT 'low_cardinality_nominal', 'term', '', true
UNION ALL SELECT 'high_cardinality_nominal', 'emp_title', '', true""")
def _(spark, sf):
    return X.validate_features(loans(spark, sf))


_REST = [c for c in ("funded_amnt", "funded_amnt_inv", "total_pymnt", "total_pymnt_inv", "last_pymnt_amnt")]


@R.add("classify_cols", f"""WITH {LOANS}, c AS (
{" UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct, true AS num FROM loans" for c in ["id", "member_id", *_REST, "default_flag"])}
UNION ALL SELECT 'emp_length', count(DISTINCT emp_length), false FROM loans
UNION ALL SELECT 'emp_title', count(DISTINCT emp_title), false FROM loans)
SELECT feature, n_distinct, CASE WHEN num THEN 'numeric_features' WHEN n_distinct <= 10 THEN 'low_cardinality_nominal'
  ELSE 'high_cardinality_nominal' END AS kind FROM c""")
def _(spark, sf):
    return X.classify_columns(loans(spark, sf), [*NUMERIC, "term"])


@R.add("split_xy", f"""WITH {LOANS} SELECT count(*) FILTER (WHERE default_flag=0) AS rows_0, count(*) FILTER (WHERE default_flag=1) AS rows_1,
  round(avg(loan_amnt) FILTER (WHERE default_flag=0),4) AS mean_0, round(avg(loan_amnt) FILTER (WHERE default_flag=1),4) AS mean_1 FROM loans""")
def _(spark, sf):
    y = F.col("default_flag")
    return rounded(loans(spark, sf).agg(
        F.count_if(y == 0).alias("rows_0"), F.count_if(y == 1).alias("rows_1"),
        F.avg(F.when(y == 0, F.col("loan_amnt"))).alias("mean_0"),
        F.avg(F.when(y == 1, F.col("loan_amnt"))).alias("mean_1"),
    ), 4)


@R.add("dataset_overview", f"""WITH {LOANS} SELECT count(*) AS total_records, 19 AS total_features, sum(default_flag) AS default_count,
  count(*) FILTER (WHERE default_flag=0) AS non_default_count, round(avg(default_flag)*100,6) AS default_rate,
  round((1-avg(default_flag))*100,6) AS non_default_rate FROM loans""")
def _(spark, sf):
    return rounded(D.dataset_overview(loans(spark, sf)))


@R.add("target_counts", f"""WITH {LOANS} SELECT default_flag, count(*) AS n,
  round(100.0::DOUBLE*count(*)/sum(count(*)) OVER (),6) AS percentage FROM loans GROUP BY default_flag""")
def _(spark, sf):
    return rounded(D.target_counts(loans(spark, sf)))


def _by_target(c):
    return f"""SELECT '{c}' AS feature, avg({c}::DOUBLE) FILTER (WHERE default_flag=0) AS m0, avg({c}::DOUBLE) FILTER (WHERE default_flag=1) AS m1,
  stddev_samp({c}::DOUBLE) FILTER (WHERE default_flag=0) AS s0, stddev_samp({c}::DOUBLE) FILTER (WHERE default_flag=1) AS s1,
  quantile_cont({c}::DOUBLE,0.5) FILTER (WHERE default_flag=0) AS d0, quantile_cont({c}::DOUBLE,0.5) FILTER (WHERE default_flag=1) AS d1 FROM loans"""


@R.add("num_by_target", f"""WITH {LOANS}, t AS ({" UNION ALL ".join(_by_target(c) for c in NUMERIC)})
SELECT feature, round(m0,3) AS non_default_mean, round(m1,3) AS default_mean, round(s0,3) AS non_default_std, round(s1,3) AS default_std,
  round(d0,3) AS non_default_median, round(d1,3) AS default_median,
  round(CASE WHEN s0>0 THEN (m1-m0)/s0 ELSE 0 END,6) AS effect_size FROM t""")
def _(spark, sf):
    return rounded(D.numeric_by_target(stored_loans(spark, sf), features=NUMERIC), 3, effect_size=6)


@R.add("cat_by_target", f"""WITH {LOANS}, g AS (
  SELECT 'term' AS feature, CAST(term AS VARCHAR) AS category, default_flag FROM loans
  UNION ALL SELECT 'emp_length', emp_length, default_flag FROM loans WHERE emp_length IS NOT NULL
  UNION ALL SELECT 'emp_title', emp_title, default_flag FROM loans WHERE emp_title IS NOT NULL)
SELECT feature, coalesce(category,'All') AS category, count(*) FILTER (WHERE default_flag=0) AS n_non_default,
  count(*) FILTER (WHERE default_flag=1) AS n_default, count(*) AS n_all,
  round(100.0::DOUBLE*count(*) FILTER (WHERE default_flag=1)/count(*),2) AS default_rate
FROM g GROUP BY GROUPING SETS ((feature, category),(feature))""")
def _(spark, sf):
    df, out = loans(spark, sf), None
    for c in ("term", "emp_length", "emp_title"):
        part = D.categorical_by_target(df, c).withColumn("feature", F.lit(c))
        out = part if out is None else out.unionByName(part)
    return out


_CORR = [*NUMERIC, "default_flag"]


def _corr(a, b):
    return f"""SELECT '{a}' AS a, '{b}' AS b, round(corr({a}::DOUBLE,{b}::DOUBLE),6) AS corr FROM loans"""


@R.add("corr_matrix", f"WITH {LOANS} " + " UNION ALL ".join(_corr(a, b) for a in _CORR for b in _CORR))
def _(spark, sf):
    return rounded(D.correlation_matrix(loans(spark, sf), NUMERIC))


@R.add("corr_target", f"WITH {LOANS} " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature, round(corr({a}::DOUBLE,default_flag::DOUBLE),6) AS corr FROM loans" for a in NUMERIC))
def _(spark, sf):
    return rounded(D.correlation_with_target(loans(spark, sf), NUMERIC))


@R.add("outliers_iqr", f"""WITH {LOANS}, q AS (SELECT default_flag, quantile_cont(tot_cur_bal,0.25) AS q1, quantile_cont(tot_cur_bal,0.75) AS q3
  FROM loans GROUP BY default_flag)
SELECT id, l.default_flag, tot_cur_bal, round(q1-1.5*(q3-q1),4) AS lower_bound, round(q3+1.5*(q3-q1),4) AS upper_bound
FROM loans l JOIN q ON l.default_flag=q.default_flag WHERE tot_cur_bal < q1-1.5*(q3-q1) OR tot_cur_bal > q3+1.5*(q3-q1)""")
def _(spark, sf):
    return rounded(D.iqr_outliers(stored_loans(spark, sf), "tot_cur_bal"), 4)


@R.add("eda_summary")
def _(spark, sf):
    return D.eda_summary_frame(stored_loans(spark, sf), NUMERIC, ["term", "emp_title"])


_HIST = NUMERIC


@R.add("hist_by_target", f"""WITH {LOANS}, u AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, default_flag, {c}::DOUBLE AS x FROM loans WHERE {c} IS NOT NULL" for c in _HIST)}),
b AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM u GROUP BY feature)
SELECT u.feature, least(CAST(floor(19.0::DOUBLE*(x-lo)/(hi-lo)+1) AS BIGINT),19) AS bin, default_flag, count(*) AS n
FROM u JOIN b ON u.feature=b.feature GROUP BY ALL""")
def _(spark, sf):
    return D.histogram_by_target(loans(spark, sf), _HIST)


@R.add("dist_by_target", f"""WITH {LOANS}, u AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, default_flag, {c}::DOUBLE AS x FROM loans WHERE {c} IS NOT NULL" for c in _HIST)})
SELECT default_flag, feature, round(avg(x),3) AS mean, {", ".join(f"round(quantile_cont(x,{p}),3) AS p{round(p * 100):02d}" for p in (0.05, 0.25, 0.5, 0.75, 0.95))}
FROM u GROUP BY default_flag, feature""")
def _(spark, sf):
    return rounded(D.distribution_by_target(stored_loans(spark, sf), _HIST), 3)


_TYPES = {"emp_length": "string", "emp_title": "string", "delinq_2yrs": "bigint", "open_acc": "bigint", "total_acc": "bigint"}
_NULLABLE = ["emp_length", "emp_title", "delinq_2yrs", "open_acc", "total_acc", "funded_amnt", "funded_amnt_inv", "tot_coll_amt",
             "tot_cur_bal", "total_rev_hi_lim", "total_pymnt", "total_pymnt_inv", "last_pymnt_amnt"]


@R.add("missing_summary", f"""WITH {LOANS}, m AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, count(*) AS n, '{_TYPES.get(c, 'double')}' AS data_type FROM loans"
    for c in _NULLABLE)})
SELECT column_name, missing_count, round(100.0::DOUBLE*missing_count/n,6) AS missing_percentage, data_type FROM m WHERE missing_count > 0""")
def _(spark, sf):
    return rounded(C.missing_summary(loans(spark, sf)))


_CELLS = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in _NULLABLE)


@R.add("quality_report", f"""WITH {LOANS}, d AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM loans)),
t AS (SELECT count(*) AS n_rows, sum({_CELLS}) AS missing_values FROM loans)
SELECT n_rows, 20 AS n_columns, n_rows - n AS duplicates, missing_values, round(100.0::DOUBLE*missing_values/(n_rows*20),6) AS missing_percentage,
 'id,member_id,loan_amnt,funded_amnt,funded_amnt_inv,installment,term,annual_inc,delinq_2yrs,open_acc,total_acc,tot_coll_amt,tot_cur_bal,total_rev_hi_lim,total_pymnt,total_pymnt_inv,last_pymnt_amnt,default_flag' AS numeric_columns,
 'emp_length,emp_title' AS categorical_columns FROM t, d""")
def _(spark, sf):
    return rounded(C.quality_report(loans(spark, sf)))


@R.add("dup_rows", """SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_rows""")
def _(spark, sf):
    from creditecho.sources.tables import table

    return C.duplicate_rows(table(spark, sf, "lineitem"))


@R.add("quantile_stats", f"WITH {LOANS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, " + ", ".join(f"round(quantile_cont({c}::DOUBLE,{p}),4) AS q{round(p * 100)}" for p in (0.2, 0.25, 0.75, 0.8))
    + " FROM loans" for c in QUANTILE_COLUMNS))
def _(spark, sf):
    stats = X.fit_stats(stored_loans(spark, sf))
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c)["q20"].alias("q20"), F.col(c)["q25"].alias("q25"),
                              F.col(c)["q75"].alias("q75"), F.col(c)["q80"].alias("q80")) for c in QUANTILE_COLUMNS])
    return rounded(stats.select(F.inline(rows)), 4)
