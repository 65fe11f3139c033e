"""Small tables with the awkward cases that every operator must take."""

import random

from pyspark.sql import functions as F

# Names that operators use inside; as extra columns they must not matter.
CLASHING = ["fp", "th", "score", "rate", "length", "rank", "bucket", "tie", "row", "i", "n", "p", "x", "key",
            "start", "part", "lines", "digest", "places", "grade", "is_target", "_kept_id", "component", "n_chars"]


def words(rnd, n, stem="w"):
    return " ".join(f"{stem}{rnd.randrange(400)}" for _ in range(n))


def awkward(seed=7):
    """(doc_id, text): nulls, empties, white space, copies, near copies,
    repeated rows, odd Unicode and one very long text."""
    rnd = random.Random(seed)
    base = words(rnd, 300)
    near = base.split()
    near[150] = "changed"
    rows = [(10, None), (11, ""), (12, " \t\n "), (13, base), (14, base), (15, " ".join(near)), (15, " ".join(near)),
            (16, "one two"), (17, "One TWO"), (None, base), (None, "no id"), (18, "<|endoftext|> a<|endoftext|>b  c "),
            (19, "é漢字 かな　x y  z \U0001f600 don't it's\r\n\r\n  end"), (20, words(rnd, 30_000, "long"))]
    rows += [(100 + k, words(rnd, rnd.randrange(1, 400))) for k in range(30)]
    rnd.shuffle(rows)
    return rows


def documents(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        df = df.select("*", *[F.lit("other").alias(c) for c in CLASHING])
    return df.repartition(3)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
