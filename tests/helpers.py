"""Small inputs that several test files build."""


def matrix(spark, rows, targets=None, named=False):
    """DataFrame with id = row position (0-based) and features as an array
    column ``f`` (or named columns x1..xd when ``named``)."""
    data = []
    for i, r in enumerate(rows):
        y = None if targets is None else (targets[i] if i < len(targets) else None)
        data.append((i, [float(v) for v in r] if r is not None else None, None if y is None else float(y)))
    df = spark.createDataFrame(data, "id long, f array<double>, y double")
    if named:
        d = len(rows[0])
        df = df.selectExpr("id", *[f"f[{j}] AS x{j + 1}" for j in range(d)], "y")
    return df


def named(d):
    return [f"x{j + 1}" for j in range(d)]
