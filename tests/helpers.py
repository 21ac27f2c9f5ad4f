"""Small frames and plan text for the tests."""


def rows(df, *cols):
    """Collected rows as plain tuples."""
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def column(spark, values, expr, dtype="string"):
    """Values of ``expr`` over a one-column frame ``x``, in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
