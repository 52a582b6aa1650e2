"""Loan and review frames built from the driver's Parquet tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditecho.session import checkpointed, pin_utc


# Tables with heavy per-row work; the others are lookups.
WIDE_TABLES = ("documents", "pages", "orders", "lineitem", "events")


def spread(df: DataFrame) -> DataFrame:
    """Uses all cores for an input of fewer splits than cores (one small file); larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in WIDE_TABLES else df


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, shaped as a loan. Money is summed as DECIMAL so that sums are exact."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    net = price * (1 - F.col("l_discount").cast("decimal(4,2)"))
    returned = F.when(F.col("l_returnflag") == "R", price * F.col("l_discount").cast("decimal(4,2)"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n"),
        F.sum(price).cast("double").alias("ext"),
        F.sum(net).cast("double").alias("net"),
        F.sum(net * (1 + F.col("l_tax").cast("decimal(4,2)"))).cast("double").alias("gross"),
        F.max(price).cast("double").alias("mx"),
        F.sum("l_quantity").alias("qty"),
        F.coalesce(F.sum(returned).cast("double"), F.lit(0.0)).alias("coll"),
    )
    people = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "c_acctbal", "c_mktsegment", "n_name")
    base = (
        table(spark, sf_dir, "orders")
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    )
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    term = F.when(key % 2 == 0, F.lit(36)).otherwise(F.lit(60))
    years = cust % 13
    emp_length = (
        F.when(years == 0, "< 1 year").when(years == 1, "1 year").when(years == 10, "10+ years")
        .when(years == 11, "n/a").when(years < 10, F.concat(years.cast("string"), F.lit(" years")))
    )
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return base.select(
        key.alias("id"),
        cust.alias("member_id"),
        F.col("o_totalprice").alias("loan_amnt"),
        F.col("net").alias("funded_amnt"),
        F.col("ext").alias("funded_amnt_inv"),
        (F.col("o_totalprice") / term).alias("installment"),
        term.alias("term"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") * 12).otherwise(F.lit(0.0)).alias("annual_inc"),
        emp_length.alias("emp_length"),
        F.when(cust % 7 != 0, F.concat_ws(" ", "c_mktsegment", "n_name")).alias("emp_title"),
        F.when(key % 11 != 0, key % 4).alias("delinq_2yrs"),
        F.col("n").alias("open_acc"),
        (F.col("n") + cust % 5).alias("total_acc"),
        F.when(F.col("n").isNotNull(), F.col("coll")).alias("tot_coll_amt"),
        F.col("ext").alias("tot_cur_bal"),
        F.when(key % 17 == 0, F.lit(0.0)).otherwise(F.col("qty") * 1000).alias("total_rev_hi_lim"),
        F.col("net").alias("total_pymnt"),
        F.col("gross").alias("total_pymnt_inv"),
        F.col("mx").alias("last_pymnt_amnt"),
        F.when(urgent, 1).otherwise(0).alias("default_flag"),
    )


def stored_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan view written once, for operators that read their input several times."""
    return checkpointed(loans(spark, sf_dir))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews, with stored sentiment where a label exists."""
    docs = table(spark, sf_dir, "documents")
    marks = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "_labelled")
    joined = docs.join(marks, F.col("doc_id") == F.col("_labelled"), "left")
    key = F.col("doc_id")
    negative = (F.col("toxic") == 1) | (F.col("quality") == 0)
    strength = (1 + key % 10).cast("double") / 10
    stamp = F.to_timestamp(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(hours=(key % 720).cast("int"))
    return joined.select(
        key.alias("id"),
        (1 + key % 5).cast("double").alias("score"),
        F.col("source").alias("title"),
        F.col("text").alias("feedback"),
        F.when(key % 23 != 0, stamp).alias("timestamp"),
        F.when(negative, "negative").when(F.col("quality") == 1, "positive").alias("sentiment_label"),
        F.when(negative, -strength).when(F.col("quality") == 1, strength).alias("sentiment_score"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with repeated ids: later copies of every tenth id and undated copies of every thirtieth."""
    base = reviews(spark, sf_dir)
    later = base.filter(F.col("id") % 10 == 0).withColumn(
        "timestamp", F.col("timestamp") + F.expr("INTERVAL '1' DAY")
    )
    undated = base.filter(F.col("id") % 30 == 0).withColumn("timestamp", F.lit(None).cast("timestamp"))
    return base.unionByName(later).unionByName(undated)


def doc_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select(F.col("vec_id").alias("doc_id"), "embedding", "label")


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage as a query, with the vector of the same number as its embedding."""
    items = table(spark, sf_dir, "benchmark")
    vectors = doc_vectors(spark, sf_dir)
    return items.join(vectors, items["item_id"] == vectors["doc_id"], "left").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"), "embedding"
    )
