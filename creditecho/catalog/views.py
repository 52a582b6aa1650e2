"""DuckDB definitions of the loan and review views."""

LOANS = """loans AS (
  WITH p AS (
    SELECT l_orderkey, l_returnflag, CAST(l_extendedprice AS DECIMAL(12,2)) AS ext,
           CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(l_tax AS DECIMAL(4,2)) AS tax, l_quantity
    FROM lineitem),
  li AS (
    SELECT l_orderkey, count(*) AS n, CAST(sum(ext) AS DOUBLE) AS ext,
           CAST(sum(ext*(1-disc)) AS DOUBLE) AS net, CAST(sum(ext*(1-disc)*(1+tax)) AS DOUBLE) AS gross,
           CAST(max(ext) AS DOUBLE) AS mx, sum(l_quantity) AS qty,
           CAST(sum(CASE WHEN l_returnflag='R' THEN ext*disc ELSE 0 END) AS DOUBLE) AS coll
    FROM p GROUP BY l_orderkey)
  SELECT o_orderkey AS id, o_custkey AS member_id,
    o_totalprice AS loan_amnt, net AS funded_amnt, ext AS funded_amnt_inv,
    o_totalprice/(CASE WHEN o_orderkey%2=0 THEN 36 ELSE 60 END) AS installment,
    CASE WHEN o_orderkey%2=0 THEN 36 ELSE 60 END AS term,
    CASE WHEN c_acctbal>0 THEN c_acctbal*12 ELSE 0 END AS annual_inc,
    CASE o_custkey%13 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years'
         WHEN 11 THEN 'n/a' WHEN 12 THEN NULL ELSE concat(CAST(o_custkey%13 AS VARCHAR),' years') END AS emp_length,
    CASE WHEN o_custkey%7=0 THEN NULL ELSE concat(c_mktsegment,' ',n_name) END AS emp_title,
    CASE WHEN o_orderkey%11=0 THEN NULL ELSE o_orderkey%4 END AS delinq_2yrs,
    n AS open_acc, n + o_custkey%5 AS total_acc,
    coll AS tot_coll_amt, ext AS tot_cur_bal,
    CASE WHEN o_orderkey%17=0 THEN 0 ELSE qty*1000 END AS total_rev_hi_lim,
    net AS total_pymnt, gross AS total_pymnt_inv, mx AS last_pymnt_amnt,
    CASE WHEN o_orderstatus='F' AND o_orderpriority='1-URGENT' THEN 1 ELSE 0 END AS default_flag
  FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey
  LEFT JOIN li ON l_orderkey=o_orderkey)"""

YEARS = """CASE trim(emp_length) WHEN '< 1 year' THEN 0 WHEN '1 year' THEN 1 WHEN '2 years' THEN 2
  WHEN '3 years' THEN 3 WHEN '4 years' THEN 4 WHEN '5 years' THEN 5 WHEN '6 years' THEN 6
  WHEN '7 years' THEN 7 WHEN '8 years' THEN 8 WHEN '9 years' THEN 9 WHEN '10+ years' THEN 10 END"""

LOANS_NUM = LOANS + f""", num AS (SELECT * REPLACE ({YEARS} AS emp_length) FROM loans)"""

CAPPED = LOANS_NUM + """, cap1 AS (
  SELECT * REPLACE (
    CASE WHEN funded_amnt > loan_amnt THEN loan_amnt ELSE funded_amnt END AS funded_amnt,
    CASE WHEN total_pymnt_inv > total_pymnt THEN total_pymnt ELSE total_pymnt_inv END AS total_pymnt_inv,
    CASE WHEN last_pymnt_amnt > total_pymnt THEN total_pymnt ELSE last_pymnt_amnt END AS last_pymnt_amnt)
  FROM num),
cap AS (
  SELECT * REPLACE (CASE WHEN funded_amnt_inv > funded_amnt THEN funded_amnt ELSE funded_amnt_inv END AS funded_amnt_inv)
  FROM cap1)"""

CLEAN_NUMERIC = [
    "loan_amnt", "funded_amnt", "funded_amnt_inv", "installment", "term", "annual_inc", "emp_length", "delinq_2yrs",
    "open_acc", "total_acc", "tot_coll_amt", "tot_cur_bal", "total_rev_hi_lim", "total_pymnt", "total_pymnt_inv",
    "last_pymnt_amnt",
]
CLEANED = (
    CAPPED
    + """, filled AS (SELECT * REPLACE (coalesce(emp_title,'Unknown') AS emp_title, coalesce(delinq_2yrs,0) AS delinq_2yrs) FROM cap),
med AS (SELECT """
    + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in CLEAN_NUMERIC)
    + """ FROM filled),
cleaned AS (SELECT id, """
    + ", ".join(f"coalesce(CAST(f.{c} AS DOUBLE), med.{c}) AS {c}" for c in CLEAN_NUMERIC)
    + """, emp_title, default_flag FROM filled f, med)"""
)

REVIEWS = """reviews AS (
  SELECT d.doc_id AS id, CAST(1+d.doc_id%5 AS DOUBLE) AS score, d.source AS title, d.text AS feedback,
    CASE WHEN d.doc_id%23=0 THEN NULL ELSE CAST('2024-01-01 00:00:00' AS TIMESTAMP) + (d.doc_id%720) * INTERVAL '1' HOUR END AS timestamp,
    CASE WHEN l.toxic=1 OR l.quality=0 THEN 'negative' WHEN l.quality=1 THEN 'positive' END AS sentiment_label,
    CASE WHEN l.toxic=1 OR l.quality=0 THEN -CAST(1+d.doc_id%10 AS DOUBLE)/10 WHEN l.quality=1 THEN CAST(1+d.doc_id%10 AS DOUBLE)/10 END AS sentiment_score
  FROM documents d LEFT JOIN labels l ON d.doc_id=l.doc_id)"""

RAW_REVIEWS = REVIEWS + """, raw AS (
  SELECT * FROM reviews
  UNION ALL SELECT * REPLACE (timestamp + INTERVAL '1' DAY AS timestamp) FROM reviews WHERE id % 10 = 0
  UNION ALL SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS timestamp) FROM reviews WHERE id % 30 = 0)"""


def split_sql(seed: str, source: str = "loans") -> str:
    """CTE ``placed``: place of every row in its class by hash order."""
    return f"""placed AS (
  SELECT *, row_number() OVER (PARTITION BY default_flag ORDER BY md5(concat(id, ':{seed}')) || '|' || id) AS position,
    count(*) OVER (PARTITION BY default_flag) AS class_rows FROM {source})"""
