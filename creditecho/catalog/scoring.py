"""Splits, encoders and metrics over the loan table."""
from __future__ import annotations

from pyspark.sql import functions as F

from creditecho.catalog.loans import numeric_loans
from creditecho.catalog.registry import Registry, rounded
from creditecho.catalog.views import LOANS, LOANS_NUM, split_sql
from creditecho.functions.text import format_seconds, title_case
from creditecho.operators import encoders as E
from creditecho.operators import metrics as M
from creditecho.operators import splits as S
from creditecho.sources import sinks
from creditecho.session import checkpointed
from creditecho.sources.tables import loans, table

R = Registry()

# ------------------------------------------------------------------ splits
_PLACED = f"WITH {LOANS}, {split_sql('42')}"


@R.add("strat_rownum", f"{_PLACED} SELECT id, default_flag, position, class_rows FROM placed")
def _(spark, sf):
    return S.stratified_positions(loans(spark, sf).select("id", "default_flag"))


@R.add("split_stratified", f"{_PLACED} SELECT id, default_flag, position <= round(0.2::DOUBLE*class_rows) AS is_test FROM placed")
def _(spark, sf):
    return S.stratified_split(loans(spark, sf).select("id", "default_flag"))


_FOLDS = f"""WITH {LOANS}, {split_sql('42')}, train AS (SELECT * EXCLUDE (position, class_rows) FROM placed WHERE position > round(0.2::DOUBLE*class_rows)),
folded AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY default_flag ORDER BY md5(concat(id, ':42-folds')) || '|' || id) - 1) * 5
  / count(*) OVER (PARTITION BY default_flag)) AS INTEGER) AS fold FROM train)"""


def train_part(df):
    return S.stratified_split(df).filter(~F.col("is_test")).drop("is_test")


@R.add("folds_stratified", f"{_FOLDS} SELECT id, default_flag, fold FROM folded")
def _(spark, sf):
    return S.stratified_folds(checkpointed(train_part(checkpointed(loans(spark, sf).select("id", "default_flag")))))


# ---------------------------------------------------------------- encoders
_PARTS = f"""WITH {LOANS_NUM}, {split_sql('42', 'num')}, train AS (SELECT * FROM placed WHERE position > round(0.2::DOUBLE*class_rows)),
test AS (SELECT * FROM placed WHERE position <= round(0.2::DOUBLE*class_rows))"""


def _parts(spark, sf):
    df = numeric_loans(spark, sf, True)
    parts = checkpointed(S.stratified_split(df))
    return parts.filter(~F.col("is_test")).drop("is_test"), parts.filter(F.col("is_test")).drop("is_test")


@R.add("impute_median", f"""{_PARTS}, m AS (SELECT quantile_cont(tot_cur_bal,0.5) AS b, quantile_cont(open_acc::DOUBLE,0.5) AS o FROM train)
SELECT id, round(coalesce(tot_cur_bal, b),4) AS tot_cur_bal, round(coalesce(open_acc, o),4) AS open_acc FROM test, m""")
def _(spark, sf):
    train, test = _parts(spark, sf)
    return rounded(E.impute_median(test, train, ["tot_cur_bal", "open_acc"]).select("id", "tot_cur_bal", "open_acc"), 4)


@R.add("impute_mode", f"""{_PARTS}, m AS (SELECT emp_length AS v FROM train WHERE emp_length IS NOT NULL GROUP BY emp_length ORDER BY count(*) DESC, emp_length LIMIT 1)
SELECT id, coalesce(emp_length, v) AS emp_length FROM test, m""")
def _(spark, sf):
    train, test = _parts(spark, sf)
    return E.impute_mode(test, train, "emp_length").select("id", "emp_length")


@R.add("impute_const", f"{_PARTS} SELECT id, coalesce(emp_title,'Unknown') AS emp_title FROM test")
def _(spark, sf):
    return _parts(spark, sf)[1].select("id", E.impute("emp_title", "Unknown").alias("emp_title"))


@R.add("scale_standard", f"""{_PARTS}, m AS (SELECT avg(loan_amnt) AS m1, stddev_pop(loan_amnt) AS s1, avg(annual_inc) AS m2, stddev_pop(annual_inc) AS s2 FROM train)
SELECT id, round((loan_amnt-m1)/s1,6) AS loan_amnt, round((annual_inc-m2)/s2,6) AS annual_inc FROM test, m""")
def _(spark, sf):
    train, test = _parts(spark, sf)
    return rounded(E.scale_standard(test, train, ["loan_amnt", "annual_inc"]).select("id", "loan_amnt", "annual_inc"))


@R.add("encode_ordinal", f"""{_PARTS}, c AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS code FROM (SELECT DISTINCT emp_length AS v FROM train WHERE emp_length IS NOT NULL))
SELECT id, coalesce(code, -1.0::DOUBLE) AS emp_length FROM test LEFT JOIN c ON emp_length = v""")
def _(spark, sf):
    train, test = _parts(spark, sf)
    code = E.encode_ordinal("emp_length", E.sorted_categories(train, "emp_length"))
    return test.select("id", code.alias("emp_length"))


@R.add("encode_onehot", f"{_PARTS} SELECT id, CASE WHEN term=60 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS term_60 FROM test")
def _(spark, sf):
    train, test = _parts(spark, sf)
    return test.select("id", *[x.alias(n) for n, x in E.encode_onehot("term", E.sorted_categories(train, "term")).items()])


@R.add("encode_target", f"""{_PARTS}, pr AS (SELECT avg(default_flag) AS prior FROM train),
t AS (SELECT coalesce(emp_title,'Unknown') AS c, count(*) AS n, avg(default_flag) AS m FROM train GROUP BY 1),
e AS (SELECT c, m/(1+exp(-(n-20)/10.0::DOUBLE)) + (1-1/(1+exp(-(n-20)/10.0::DOUBLE)))*prior AS v FROM t, pr)
SELECT id, round(coalesce(v, prior),6) AS emp_title FROM pr, test LEFT JOIN e ON coalesce(emp_title,'Unknown') = c""")
def _(spark, sf):
    train, test = (d.withColumn("emp_title", E.impute("emp_title", "Unknown")) for d in _parts(spark, sf))
    return rounded(E.encode_target(test, train, "emp_title", "default_flag").select("id", "emp_title"))


@R.add("class_weights", f"""{_PARTS} SELECT count(*) FILTER (WHERE default_flag=0) AS n0, count(*) FILTER (WHERE default_flag=1) AS n1,
  round(count(*)::DOUBLE/(2*count(*) FILTER (WHERE default_flag=0)),6) AS weight_0, round(count(*)::DOUBLE/(2*count(*) FILTER (WHERE default_flag=1)),6) AS weight_1,
  round(count(*) FILTER (WHERE default_flag=0)::DOUBLE/count(*) FILTER (WHERE default_flag=1),6) AS positive_weight FROM train""")
def _(spark, sf):
    return rounded(E.class_weight_table(_parts(spark, sf)[0]))


# ----------------------------------------------------------------- metrics
_CARDS = """cards AS (
  SELECT id, default_flag AS label, 'income_card' AS model, loan_amnt/(annual_inc+1) AS x FROM loans
  UNION ALL SELECT id, default_flag, 'balance_card', coalesce(tot_cur_bal/(total_rev_hi_lim+1), 0) FROM loans
  UNION ALL SELECT id, default_flag, 'delinq_card', CAST(coalesce(delinq_2yrs,0) AS DOUBLE) FROM loans),
pred AS (SELECT id, label, model, round(x/(1+x),4) AS probability, CASE WHEN x/(1+x) >= 0.5 THEN 1 ELSE 0 END AS prediction FROM cards)"""


def scorecards(df):
    """Three one-rule scorecards as a prediction table (model, id, label, probability, prediction)."""
    rules = {
        "income_card": F.col("loan_amnt") / (F.col("annual_inc") + 1),
        "balance_card": F.coalesce(F.col("tot_cur_bal") / (F.col("total_rev_hi_lim") + 1), F.lit(0.0)),
        "delinq_card": F.coalesce(F.col("delinq_2yrs"), F.lit(0)).cast("double"),
    }
    cards = F.array(*[F.struct(F.lit(n).alias("model"), x.alias("x")) for n, x in rules.items()])
    p = F.col("x") / (1 + F.col("x"))
    keep = [c for c in ("fold",) if c in df.columns]
    return df.select("id", F.col("default_flag").alias("label"), *keep, F.inline(cards)).select(
        "model", "id", "label", *keep, F.round(p, 4).alias("probability"), (p >= 0.5).cast("int").alias("prediction")
    )


def predictions(spark, sf):
    """Scorecard predictions written once, as a stored prediction table."""
    return checkpointed(scorecards(loans(spark, sf)))


_ROC = f"""WITH {LOANS}, {_CARDS}, g AS (SELECT model, probability, sum(label) AS pos, sum(1-label) AS neg FROM pred GROUP BY 1,2),
roc AS (SELECT model, probability, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n
  FROM g WINDOW w AS (PARTITION BY model ORDER BY probability DESC))"""
_AUC = f"""{_ROC}, a AS (SELECT model, sum(CAST(neg AS DOUBLE)*(tp-pos+pos/2.0::DOUBLE))/max(CAST(p AS DOUBLE)*n) AS auc,
  greatest(max(CAST(tp AS DOUBLE)/p - CAST(fp AS DOUBLE)/n),0.0::DOUBLE) AS ks FROM roc GROUP BY model)"""


def _cls(by, source):
    return f"""c AS (SELECT {by}, count(*) AS n, count(*) FILTER (WHERE label=1 AND prediction=1)::DOUBLE AS tp, count(*) FILTER (WHERE label=0 AND prediction=1)::DOUBLE AS fp,
  count(*) FILTER (WHERE label=1 AND prediction=0)::DOUBLE AS fn, count(*) FILTER (WHERE label=0 AND prediction=0)::DOUBLE AS tn FROM {source} GROUP BY {by}),
m AS (SELECT {by}, (tp+tn)/n AS accuracy, CASE WHEN tp+fp=0 THEN 0 ELSE tp/(tp+fp) END AS precision_, CASE WHEN tp+fn=0 THEN 0 ELSE tp/(tp+fn) END AS recall_,
  CASE WHEN 2*tp+fp+fn=0 THEN 0 ELSE 2*tp/(2*tp+fp+fn) END AS f1_score FROM c)"""


@R.add("roc_points", f"{_ROC} SELECT model, probability, round(CAST(tp AS DOUBLE)/p,6) AS tpr, round(CAST(fp AS DOUBLE)/n,6) AS fpr FROM roc")
def _(spark, sf):
    return rounded(M.roc_points(predictions(spark, sf)).select("model", "probability", "tpr", "fpr"))


@R.add("auc", f"{_AUC} SELECT model, round(auc,6) AS roc_auc FROM a")
def _(spark, sf):
    return rounded(M.auc_ks(predictions(spark, sf)).select("model", "roc_auc"))


@R.add("gini", f"{_AUC} SELECT model, round(2*(auc-0.5),6) AS gini FROM a")
def _(spark, sf):
    return rounded(M.auc_ks(predictions(spark, sf)).select("model", "gini"))


@R.add("ks", f"{_AUC} SELECT model, round(ks,6) AS ks_statistic FROM a")
def _(spark, sf):
    return rounded(M.auc_ks(predictions(spark, sf)).select("model", "ks_statistic"))


_EVAL = f"{_AUC}, {_cls('model', 'pred')}"
_SEVEN = """round(auc,6) AS roc_auc, round(2*(auc-0.5),6) AS gini, round(ks,6) AS ks_statistic, round(accuracy,6) AS accuracy,
  round(precision_,6) AS "precision", round(recall_,6) AS recall, round(f1_score,6) AS f1_score"""


@R.add("cls_metrics", f"""WITH {LOANS}, {_CARDS}, {_cls('model', 'pred')} SELECT model, round(accuracy,6) AS accuracy, round(precision_,6) AS "precision",
  round(recall_,6) AS recall, round(f1_score,6) AS f1_score FROM m""")
def _(spark, sf):
    return rounded(M.cls_metrics(predictions(spark, sf)))


@R.add("class_report", f"""WITH {LOANS}, {_CARDS}, k AS (SELECT model, count(*) FILTER (WHERE label=1 AND prediction=1)::DOUBLE AS tp, count(*) FILTER (WHERE label=0 AND prediction=1)::DOUBLE AS fp,
  count(*) FILTER (WHERE label=1 AND prediction=0)::DOUBLE AS fn, count(*) FILTER (WHERE label=0 AND prediction=0)::DOUBLE AS tn FROM pred GROUP BY model),
l AS (SELECT model, '0' AS class, tn AS hit, fn AS wrong, fp AS miss FROM k UNION ALL SELECT model, '1', tp, fp, fn FROM k),
s AS (SELECT model, class, CASE WHEN hit+wrong=0 THEN 0 ELSE hit/(hit+wrong) END AS p, CASE WHEN hit+miss=0 THEN 0 ELSE hit/(hit+miss) END AS r,
  CASE WHEN 2*hit+wrong+miss=0 THEN 0 ELSE 2*hit/(2*hit+wrong+miss) END AS f, hit+miss AS support FROM l)
SELECT model, class, round(p,6) AS "precision", round(r,6) AS recall, round(f,6) AS f1_score, CAST(support AS BIGINT) AS support FROM s
UNION ALL SELECT model, 'macro avg', round(avg(p),6), round(avg(r),6), round(avg(f),6), CAST(sum(support) AS BIGINT) FROM s GROUP BY model
UNION ALL SELECT model, 'weighted avg', round(sum(p*support)/sum(support),6), round(sum(r*support)/sum(support),6), round(sum(f*support)/sum(support),6), CAST(sum(support) AS BIGINT) FROM s GROUP BY model""")
def _(spark, sf):
    return rounded(M.class_report(predictions(spark, sf)))


@R.add("confusion", f"""WITH {LOANS}, {_CARDS}, g AS (SELECT * FROM (SELECT DISTINCT model FROM pred), (VALUES (0,0),(0,1),(1,0),(1,1)) v(label, prediction))
SELECT g.model, g.label, g.prediction, count(pred.id) AS n FROM g LEFT JOIN pred ON g.model=pred.model AND g.label=pred.label AND g.prediction=pred.prediction GROUP BY 1,2,3""")
def _(spark, sf):
    return M.confusion(predictions(spark, sf))


@R.add("evaluate_all", f"{_EVAL} SELECT a.model, {_SEVEN} FROM a JOIN m ON a.model=m.model")
def _(spark, sf):
    return rounded(M.evaluate_all(predictions(spark, sf)))


_TITLE = "array_to_string(list_transform(string_split(a.model,'_'), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


@R.add("compare_models", f"""{_EVAL} SELECT {_TITLE} AS model, round(auc,6) AS roc_auc, round(f1_score,6) AS f1_score, round(accuracy,6) AS accuracy,
  round(precision_,6) AS "precision", round(recall_,6) AS recall FROM a JOIN m ON a.model=m.model""")
def _(spark, sf):
    return rounded(M.compare_models(M.evaluate_all(predictions(spark, sf))))


@R.add("sort_models", f"""{_EVAL} SELECT a.model, row_number() OVER (ORDER BY auc DESC, a.model) AS place, round(auc,6) AS roc_auc FROM a JOIN m ON a.model=m.model""")
def _(spark, sf):
    from pyspark.sql import Window as W

    results = M.evaluate_all(predictions(spark, sf))
    order = W.partitionBy(F.lit(0)).orderBy(F.col("roc_auc").desc(), "model")  # one row per model
    return rounded(results.select("model", F.row_number().over(order).alias("place"), "roc_auc"))


@R.add("best_model", f"""{_EVAL} SELECT min(model) AS best_model, round(max(auc),6) AS roc_auc FROM a WHERE auc = (SELECT max(auc) FROM a)""")
def _(spark, sf):
    return rounded(M.best_model(M.evaluate_all(predictions(spark, sf))))


@R.add("title_case", f"""WITH {LOANS}, a AS (SELECT replace(lower(emp_title),' ','_') AS model, count(*) AS n FROM loans WHERE emp_title IS NOT NULL GROUP BY 1)
SELECT {_TITLE} AS title, n FROM a""")
def _(spark, sf):
    raw = F.replace(F.lower("emp_title"), F.lit(" "), F.lit("_"))
    counts = loans(spark, sf).filter(F.col("emp_title").isNotNull()).groupBy(raw.alias("model")).agg(F.count("*").alias("n"))
    return counts.select(title_case(F.col("model")).alias("title"), "n")


# ------------------------------------------------------- cross-validation
_CV = f"""{_FOLDS}, {_CARDS.replace('FROM loans', 'FROM folded').replace('SELECT id, default_flag', 'SELECT id, fold, default_flag').replace('SELECT id, label, model', 'SELECT id, fold, label, model')},
g AS (SELECT model, fold, probability, sum(label) AS pos, sum(1-label) AS neg FROM pred GROUP BY ALL),
roc AS (SELECT model, fold, pos, neg, sum(pos) OVER w AS tp, sum(pos) OVER (PARTITION BY model, fold) AS p, sum(neg) OVER (PARTITION BY model, fold) AS n
  FROM g WINDOW w AS (PARTITION BY model, fold ORDER BY probability DESC)),
a AS (SELECT model, fold, sum(CAST(neg AS DOUBLE)*(tp-pos+pos/2.0::DOUBLE))/max(CAST(p AS DOUBLE)*n) AS auc FROM roc GROUP BY model, fold),
{_cls('model, fold', 'pred')},
f AS (SELECT model, fold, 'roc_auc' AS metric, auc AS score FROM a UNION ALL SELECT model, fold, 'accuracy', accuracy FROM m
 UNION ALL SELECT model, fold, 'precision', precision_ FROM m UNION ALL SELECT model, fold, 'recall', recall_ FROM m UNION ALL SELECT model, fold, 'f1_score', f1_score FROM m)"""
_CV_SUMMARY = f"""{_CV} SELECT model, upper(replace(metric,'_',' ')) AS metric, round(avg(score),6) AS mean, round(stddev_pop(score),6) AS std, round(min(score),6) AS min, round(max(score),6) AS max
FROM f GROUP BY model, metric"""


def _fold_scores(spark, sf):
    """Out-of-fold scorecard predictions, written once as a stored prediction table would be."""
    columns = ["id", "default_flag", "loan_amnt", "annual_inc", "tot_cur_bal", "total_rev_hi_lim", "delinq_2yrs"]
    train = checkpointed(train_part(checkpointed(loans(spark, sf).select(*columns))))
    return checkpointed(scorecards(S.stratified_folds(train)))


@R.add("cv_evaluate", f"{_CV} SELECT model, fold, metric, round(score,6) AS score FROM f")
def _(spark, sf):
    return rounded(M.fold_scores(_fold_scores(spark, sf)))


@R.add("cv_summary", _CV_SUMMARY)
def _(spark, sf):
    return rounded(M.cv_summary(M.fold_scores(_fold_scores(spark, sf))))


@R.add("union_cv", _CV_SUMMARY)
def _(spark, sf):
    pred, out = _fold_scores(spark, sf), None
    for model in ("income_card", "balance_card", "delinq_card"):
        part = M.cv_summary(M.fold_scores(pred.filter(F.col("model") == model)))
        out = part if out is None else out.unionByName(part)
    return rounded(out)


@R.add("sink_reports", f"{_EVAL} SELECT a.model, {_SEVEN} FROM a JOIN m ON a.model=m.model")
def _(spark, sf):
    results = rounded(M.evaluate_all(predictions(spark, sf))).orderBy(F.col("roc_auc").desc())
    scores = rounded(M.cv_summary(M.fold_scores(_fold_scores(spark, sf))))
    folder = sinks.work_folder(spark, "reports")
    sinks.write_reports(results, scores, M.compare_models(results), folder)
    schema = ", ".join(f"`{c}` {t}" for c, t in results.dtypes)
    return spark.read.schema(schema).option("header", True).csv(f"{folder}/model_test_results")


# ------------------------------------------------------------- run timings
@R.add("fmt_time", """SELECT event_id, CASE WHEN s < 60 THEN printf('%.2f seconds', s)
  WHEN s < 3600 THEN printf('%.2f minutes (%.2f seconds)', s/60, s)
  ELSE printf('%.1f hours %.1f minutes (%.2f seconds)', s/3600, (s % 3600)/60, s) END AS text
FROM (SELECT event_id, CAST(value * event_id / 64 AS DOUBLE) AS s FROM events)""")
def _(spark, sf):
    seconds = (F.col("value") * F.col("event_id") / 64).cast("double")
    return table(spark, sf, "events").select("event_id", format_seconds(seconds).alias("text"))


_BENCH = """WITH runs AS (SELECT CASE WHEN event_type IN ('view','click') THEN 'RAG' ELSE 'Non-RAG' END AS scenario, CAST(value*100 AS BIGINT) AS centi, event_type <> 'error' AS ok FROM events),
t AS (SELECT sum(centi) FILTER (WHERE scenario='RAG' AND ok)::DOUBLE/count(*) FILTER (WHERE scenario='RAG' AND ok)/100 AS q,
  sum(centi) FILTER (WHERE scenario='Non-RAG' AND ok)::DOUBLE/count(*) FILTER (WHERE scenario='Non-RAG' AND ok)/100 AS f FROM runs)"""


@R.add("bench_compare", f"{_BENCH} SELECT round(q,6) AS query_seconds, round(f,6) AS scan_seconds, round(f/q,6) AS speedup, round(f-q,6) AS saved_seconds FROM t")
def _(spark, sf):
    from creditecho.operators.insights import compare_runs

    kind = F.when(F.col("event_type").isin("view", "click"), "RAG").otherwise("Non-RAG")
    runs = table(spark, sf, "events").select(
        kind.alias("scenario"), (F.round(F.col("value") * 100) / 100).alias("seconds"), (F.col("event_type") != "error").alias("ok")
    )
    return rounded(compare_runs(runs))
