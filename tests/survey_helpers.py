"""Helpers that several test modules share."""

from pyspark.sql import functions as F


def column_values(spark, values, fn, name="x"):
    """Apply a Column function to a one-column string frame; return results in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")
    out = fn(F.col(name))
    if isinstance(out, tuple):
        rows = df.select("i", *[o.alias(f"o{k}") for k, o in enumerate(out)]).orderBy("i").collect()
        return [tuple(r[1:]) for r in rows]
    return [r[1] for r in df.select("i", out.alias("o")).orderBy("i").collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
