import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.sources import evolution, objects
from tests.helpers import rows

KINDS = {
    "int bigint": "bigint", "tinyint smallint": "smallint", "int double": "double", "bigint float": "double",
    "float double": "double", "int decimal(5,2)": "decimal(12,2)", "decimal(5,2) decimal(10,4)": "decimal(10,4)",
    "bigint decimal(38,20)": "string", "date timestamp_ntz": "timestamp_ntz", "date timestamp": "string",
    "boolean int": "string", "string double": "string", "void int": "int", "double decimal(5,2)": "string",
    "array<int> array<double>": "array<double>", "struct<a:int> struct<a:bigint,b:string>": "struct<a:bigint,b:string>",
    "struct<a:int> int": "string",
}


@pytest.mark.parametrize("given", KINDS)
def test_widest(spark, given):
    a, b = (T._parse_datatype_string(k) if k != "void" else T.NullType() for k in given.split(" "))
    assert evolution.widest(a, b).simpleString() == evolution.widest(b, a).simpleString() == KINDS[given]


def test_widened_rows(spark, tmp_path):
    path = str(tmp_path / "d")
    batches = [
        spark.sql("SELECT 1 AS i, 7 AS v, named_struct('a', 1) AS s, array(1, 2) AS l"),
        spark.sql("SELECT 2 AS i, 3000000000 AS v, 'x' AS new"),
        spark.sql("SELECT 3 AS i, double(0.5) AS v, named_struct('b', 'q', 'a', 2L) AS s, array(double(1.5)) AS l"),
        spark.sql("SELECT 4 AS i, CAST(NULL AS INT) AS v"),
    ]
    for b in batches:
        objects.write_dataset(b, path, "parquet", "append")
    got = evolution.read_widened(spark, path)
    assert dict(got.dtypes) == {"i": "int", "v": "double", "s": "struct<a:bigint,b:string>", "l": "array<double>", "new": "string"}
    assert [(r.i, r.v, tuple(r.s) if r.s else None, r.l, r.new) for r in got.orderBy("i").collect()] == [
        (1, 7.0, (1, None), [1.0, 2.0], None), (2, 3e9, None, None, "x"), (3, 0.5, (2, "q"), [1.5], None), (4, None, None, None, None),
    ]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_long_that_a_double_cannot_hold_is_loud(spark):
    parts = [spark.sql(f"SELECT {2**53 + 1}L AS v"), spark.sql("SELECT 0.5D AS v")]
    with pytest.raises(Exception, match="beyond the whole numbers"):
        evolution.union_by_name(parts).collect()
    assert rows(evolution.union_by_name([spark.sql(f"SELECT {2**53}L AS v"), parts[1]])) == [(0.5,), (2.0**53,)]


def test_few_trials_find_the_groups():
    trials = []

    def merged(files):
        trials.append(len(files))
        kinds = {f[0] for f in files}
        if len(kinds) > 1:
            raise RuntimeError("CANNOT_MERGE_SCHEMAS")
        return T.StructType().add("x", {"i": T.IntegerType(), "s": T.StringType()}[kinds.pop()])

    files = [f"{kind}{n}" for kind, many in (("i", 700), ("s", 300), ("i", 24)) for n in range(many)]
    groups = evolution.alike_files(files, merged)
    assert sorted(len(g) for _, g in groups) == [300, 724] and len(trials) < 50
    with pytest.raises(RuntimeError, match="lost"):
        evolution.alike_files(files, lambda some: (_ for _ in ()).throw(RuntimeError("lost")))


def test_partitions_and_missing_folders(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(6).select(F.col("id").cast("int").alias("v"), (F.col("id") % 2).cast("int").alias("p"))
    df.write.partitionBy("p").parquet(path)
    df.withColumn("v", F.col("v").cast("string")).write.mode("append").partitionBy("p").parquet(path)
    got = evolution.read_widened(spark, path)
    assert dict(got.dtypes) == {"v": "string", "p": "int"} and got.count() == 12
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        evolution.read_widened(spark, str(tmp_path / "empty"))
