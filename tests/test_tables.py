from citemill.sources import tables as src


def test_scans_are_dealt_only_as_the_session_says(spark, small):
    scan = src.table(spark, small, "documents")
    assert src.dealt(scan) is scan
    spark.conf.set(src.SCAN_PARTITIONS, "5")
    try:
        assert src.dealt(scan).rdd.getNumPartitions() == 5
    finally:
        spark.conf.unset(src.SCAN_PARTITIONS)


def test_empty_table(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "none.parquet"))
    assert src.dealt(src.table(spark, str(tmp_path), "none")).count() == 0
