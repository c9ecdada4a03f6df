from pyspark.sql import functions as F

from ferry.sources import scratch, sizing

TB = 1 << 40
SHUFFLE, SCAN = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"


def test_settings_grow_with_the_input():
    assert sizing.settings_for(0) == {SHUFFLE: 1, SCAN: 128 * sizing.MB}
    assert sizing.settings_for(TB)[SHUFFLE] == 4097
    assert sizing.settings_for(TB)[SCAN] == 128 * sizing.MB
    assert sizing.settings_for(100 * TB) == {SHUFFLE: 50_000, SCAN: 1024 * sizing.MB}


def test_input_is_what_the_files_hold(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.range(100_000).write.parquet(path)
    df = spark.read.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "d").glob("*.parquet"))
    assert size <= sizing.input_bytes(df) < 3 * size
    joined = df.join(df.withColumnRenamed("id", "b"), F.col("id") == F.col("b"))
    assert sizing.input_bytes(joined) > size
    unknown = spark.createDataFrame([(1,)], "id int")
    assert sizing.input_bytes(unknown) < sizing.UNKNOWN


def test_settings_are_raised_and_put_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "d")
    spark.range(100_000).write.parquet(path)
    df = spark.read.parquet(path)
    before = spark.conf.get(SHUFFLE), spark.conf.get(SCAN)
    with sizing.sized_for(df):
        assert (spark.conf.get(SHUFFLE), spark.conf.get(SCAN)) == before
    monkeypatch.setattr(sizing, "SHUFFLE_BYTES", 1000)
    try:
        with sizing.sized_for(df):
            assert int(spark.conf.get(SHUFFLE)) > 100
            raise KeyError
    except KeyError:
        pass
    assert (spark.conf.get(SHUFFLE), spark.conf.get(SCAN)) == before


def test_staging_uses_them(spark, tmp_path, monkeypatch, conf):
    conf(spark__sql__adaptive__enabled="false")
    path = str(tmp_path / "d")
    spark.range(100_000).write.parquet(path)
    counts = spark.read.parquet(path).groupBy("id").count()
    few = len(scratch.stage(counts).rows.inputFiles())
    monkeypatch.setattr(sizing, "SHUFFLE_BYTES", 10_000)
    many = len(scratch.stage(counts).rows.inputFiles())
    assert few <= 4 < many


def test_places_follow_the_input(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "d")
    spark.range(100_000).write.parquet(path)
    df = spark.read.parquet(path)
    assert sizing.shuffle_partitions(df) == int(spark.conf.get(SHUFFLE))
    monkeypatch.setattr(sizing, "SHUFFLE_BYTES", 1000)
    assert sizing.shuffle_partitions(df) > 100


def test_sizes_of_settings():
    assert sizing._bytes("134217728b") == sizing._bytes("128MB") == sizing._bytes("128m") == 128 * sizing.MB
    assert sizing._bytes("200") == 200 and sizing._bytes("1g") == 1024 * sizing.MB
