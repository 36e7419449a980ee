from pyspark.sql import functions as F

from lodestone.llm import bloom


def test_no_key_is_missed_and_few_others_pass(spark):
    keys, rows = spark.range(0, 4000, 2).withColumnRenamed("id", "k"), spark.range(0, 4000).withColumnRenamed("id", "k")
    bits = bloom.bits_for(2000)
    got = bloom.test(rows, "k", bloom.filter_of(keys, "k", bits), bits)
    assert got.columns == ["k", "maybe"]
    assert got.filter("k % 2 = 0 AND maybe").count() == 2000
    assert got.filter("k % 2 = 1 AND maybe").count() < 200


def test_an_empty_filter_passes_nothing_and_sizes_are_bounded(spark):
    rows = spark.range(10).withColumnRenamed("id", "k")
    table = bloom.filter_of(rows.limit(0), "k", bloom.BUCKET_BITS)
    assert bloom.test(rows, "k", table, bloom.BUCKET_BITS).filter("maybe").count() == 0
    assert bloom.bits_for(0) == bloom.BUCKET_BITS and bloom.bits_for(10**12) == bloom.MAX_BITS
    assert table.agg(F.count("*")).first()[0] == 0
