"""Rows shared by the tests of several operators."""

# A null text, empty and blank ones, repeated rows, a null id, and columns named like those the operators make.
ODD = [
    (1, None, "a", 1),
    (2, "", "a", 1),
    (3, " \t\n", None, 2),
    (4, "one two three", "b", 3),
    (4, "one two three", "b", 3),
    (None, "one two three", "b", 3),
    (None, None, None, None),
    (5, "x" * 50000 + " " + "long " * 4000, "a", 9),
]
ODD_SCHEMA = "doc_id long, text string, source string, size int"


def odd(spark, *names):
    """ODD with the extra column `size` and one more for each of `names`."""
    df = spark.createDataFrame(ODD, ODD_SCHEMA)
    for name in names:
        df = df.selectExpr("*", f"'kept' AS {name}")
    return df


def nothing(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
