from tidemark.session import FREE_SHUFFLES, materialise


def test_a_written_table_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f.getName() for f in [disk.getAllFiles().apply(i) for i in range(disk.getAllFiles().size())] if f.getName().startswith("shuffle_")}
    spark.conf.set(FREE_SHUFFLES, "false")
    before = files()
    counts = spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count()
    out = materialise(counts, "freed")
    assert files() <= before
    assert spark.conf.get(FREE_SHUFFLES) == "false"
    assert sorted(r["count"] for r in out.collect()) == [100] * 10 and counts.count() == 10
