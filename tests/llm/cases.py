"""Small tables with every awkward case."""

from pyspark.sql import types as T

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "long text " * 30_000
# Null ids, texts and sources; empty, blank and very long texts; ties and repeated rows.
AWKWARD = [
    (1, "One two three four five six seven.", "en", "a", 34),
    (1, "One two three four five six seven.", "en", "a", 34),
    (2, "One two three four five six seven.", None, None, None),
    (None, "One  two three four five six seven.", "en", "b", 35),
    (None, None, None, None, None),
    (3, None, "en", "a", 0),
    (4, "", "en", "a", 0),
    (5, " \t\n", "en", "a", 3),
    (6, LONG, "en", "b", len(LONG)),
    (7, LONG + "!", "en", "c", len(LONG) + 1),
    (8, "...", "en", "c", 3),
]


def docs(spark, rows):
    """``rows`` of DOCS; shorter rows get nulls."""
    return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], DOCS)


def awkward(spark):
    return docs(spark, AWKWARD)


def clashing(spark, rows=AWKWARD):
    """Documents with columns named as the operators name theirs."""
    df = docs(spark, rows)
    taken = "key keep row hash sha points tokens shard slot part base at first score label labels links root block bucket ids n_tokens round_trip n_lines n_removed gone n_entities exceptions given_text rewritten leaked whole_text item_id toxic id total"
    for name in taken.split():
        df = df.withColumn(name, df["doc_id"].cast("string"))
    return df


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


def rows(df, *columns):
    """Rows in a fixed order, nulls first."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(v is not None, v) for v in r])


LABELS = T.StructType().add("doc_id", "long").add("quality", "integer").add("toxic", "integer")
