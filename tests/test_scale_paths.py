"""Scale paths: dictionary join with and without broadcast, reads, skewed keys."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from paysift.functions.casts import try_float, try_int_trunc, try_money
from paysift.operators.dictionary import standardise
from paysift.operators.reports import group_stats, top_k
from paysift.session import work_session
from paysift.sources.derived import raw_survey, written_survey


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dictionary_broadcast_and_shuffle_paths_agree(spark, sf_dir):
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    # a duplicated key must not multiply rows
    nation_dup = nation.unionByName(nation.withColumn("n_name", F.concat(F.col("n_name"), F.lit("~"))))
    small = standardise(cust, nation_dup, on="c_nationkey", key="n_nationkey", value="n_name", out="nation")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = standardise(cust, nation_dup, on="c_nationkey", key="n_nationkey", value="n_name", out="nation")
        assert sorted(small.collect()) == sorted(big.collect())
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert small.count() == cust.count()


def test_dictionary_keeps_unmatched_values(spark):
    df = spark.createDataFrame([("a",), ("zz",), (None,)], "loc string")
    d = spark.createDataFrame([("a", "Alpha")], "k string, v string")
    got = sorted(standardise(df, d, on="loc", key="k", value="v").collect(), key=repr)
    assert [r["loc"] for r in got] == sorted(["Alpha", "zz", None], key=repr)


def test_read_plan_does_not_depend_on_the_number_of_files(spark, tmp_path):
    from paysift.operators.forms import FORM_B
    from paysift.sources.csv_forms import read_form, write_form_csv

    raw = spark.range(40).select(*[F.lit("x").alias(n) for n in FORM_B.names])
    plans = []
    for n in (3, 4):
        write_form_csv(raw.repartition(n), f"{tmp_path}/{n}", FORM_B)
        plans.append(_plan(read_form(spark, f"{tmp_path}/{n}", FORM_B)).replace(f"{tmp_path}/{n}", ""))
    assert all("Exchange" not in p for p in plans)
    assert read_form(spark, f"{tmp_path}/3", FORM_B, spread_to=7).rdd.getNumPartitions() == 7


def test_reports_exact_under_a_hot_key(spark):
    # one key holds a third of all rows; partial aggregation keeps the result exact
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
        .alias("Location"),
        (F.col("id") % 1000).cast("decimal(38,2)").alias("Salary"),
    ).repartition(8)
    stats = {r["Location"]: r for r in group_stats(df, "Location", "Salary", ("a", "mn", "mx")).collect()}
    hot = [i % 1000 for i in range(n) if i % 3 == 0]
    assert stats[""]["a"] == (D(sum(hot)) / len(hot)).quantize(D("0.01"))
    assert stats[""]["mn"] == D(min(hot)) and stats[""]["mx"] == D(max(hot))
    top = top_k(df, "Location", F.count("Salary"), "n", 2).collect()
    assert top[0]["Location"] == "" and top[0]["n"] == n // 3
    assert "partial_try_avg" in _plan(group_stats(df, "Location", "Salary", ("a", "mn", "mx")))


def test_orders_in_one_file_become_several_tasks_of_survey_text(spark, tmp_path):
    orders = spark.range(200_000).selectExpr("id as o_orderkey", "id % 50 as o_custkey", "id / 7 as o_totalprice", "timestamp_ntz'1996-01-01 00:00:00' as o_orderdate")
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(50).selectExpr("id as c_custkey", "'BUILDING' as c_mktsegment", "1 as c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1).selectExpr("1 as n_nationkey", "'FRANCE' as n_name").write.parquet(f"{tmp_path}/nation.parquet")
    raw = raw_survey(spark, str(tmp_path))
    wide = written_survey(spark, str(tmp_path), f"{tmp_path}/rows")
    assert raw.rdd.getNumPartitions() == 1 and wide.rdd.getNumPartitions() > 1
    assert wide.count() == 200_000 and wide.exceptAll(raw).isEmpty()


def test_a_work_session_has_the_callers_settings_and_leaves_them(spark):
    before = spark.conf.getAll
    work = work_session(spark)
    after = work.conf.getAll
    assert spark.conf.getAll == before
    own = {"spark.sql.codegen.hugeMethodLimit", "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.files.minPartitionNum"}
    own |= {"spark.sql.adaptive.coalescePartitions.minPartitionNum"}
    assert {k: after.get(k) for k in before if k not in own} == {k: v for k, v in before.items() if k not in own}
    assert work.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_casts_that_are_not_tried_would_fail(spark):
    """Guarded casts equal plain ones on every short text of these letters and on odd numbers."""
    letters = [chr(c) for c in range(1, 127)] + ["£", "é", "٣"]
    texts = [*letters, *[f"1{x}" for x in letters], *[f"{x}1" for x in letters], *[f"1{x}1" for x in letters], *[f"-.{x}5" for x in letters]]
    texts += ["", " 12.5 ", "1e3", "-1E+2", "NaN", "nan", "inf", "-Infinity", "+INF", "0x1p3", "0X1.8P1", "1f", "1D", "9" * 40, "1,000", "10k", "n/a", "unlimited", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    digits = F.regexp_extract("x", r"^\s*([+-]?[0-9]+)(\.[0-9]*)?\s*$", 1).try_cast("int")
    plain = [F.col("x").try_cast("decimal(38,2)"), F.col("x").try_cast("float"), F.when(F.col("x").rlike(r"^\s*[+-]?\.[0-9]*\s*$"), F.lit(0)).otherwise(digits)]
    same = [a.eqNullSafe(b) for a, b in zip([try_money("x"), try_float("x"), try_int_trunc("x")], plain, strict=True)]
    assert df.where(~(same[0] & same[1] & same[2])).collect() == []
    assert df.select(F.count(try_money("x")), F.count(try_float("x"))).first() == df.select(F.count(plain[0]), F.count(plain[1])).first()
