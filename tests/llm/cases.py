"""Documents with the awkward cases every operator must define."""

import random

from pyspark.sql import types as T

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + (rng.choice(["", "", ",", "."])) for _ in range(n))


def doc_rows(seed=3, n=40):
    """Prose with copies, near copies, repeated rows, ties, NULLs, empty and long texts."""
    rng = random.Random(seed)
    rows = [(i, "\n".join(prose(rng, rng.randrange(1, 60)) for _ in range(rng.randrange(1, 6))), "en", f"s{i % 3}")
            for i in range(n)]
    rows += [(100, rows[0][1], "en", "s0"), (101, rows[0][1] + " omega", "de", None),
             (102, None, None, None), (103, "", "en", "s1"), (104, " \t\n ", "fr", "s1"), (105, "x", "en", "s2"),
             (106, prose(rng, 6000), "en", "s2"), (107, "a" * 5000, "en", "s2"), (108, "naïve café 日本語 🙂 x", "fr", "s0"),
             (None, "no id here at all", "en", "s0"), (None, None, None, "s1"),
             rows[1], rows[1], (-5, rows[2][1].upper(), "en", "é")]
    return [(*r, len(r[1] or "")) for r in rows]


def docs(spark, rows=None, partitions=5):
    return spark.createDataFrame(doc_rows() if rows is None else rows, DOC).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], DOC)


def with_extra(df):
    """Columns that an operator might use itself."""
    from pyspark.sql import functions as F
    return df.selectExpr("*", "1 AS id", "'x' AS score", "2 AS part", "array(1) AS ids", "'k' AS key", "0 AS size",
                         "'t' AS target", "1 AS component_id", "'e' AS rejected", "0.5 AS predicted").withColumn(
        "start", F.lit("s"))
