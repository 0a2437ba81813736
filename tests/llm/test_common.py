from pyspark.sql import functions as F

from spendframe.llm.common import SHUFFLE_CLEANUP, materialize, release


def shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {str(files.apply(i).getName()) for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_materialize_leaves_no_shuffle_files(spark):
    """The files go with the write, before any garbage is collected, and the setting comes back."""
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    out = materialize(counted.join(spark.range(7).withColumnRenamed("id", "k"), "k"), "common-test")
    assert shuffle_files(spark) <= before
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert sorted(map(tuple, out.collect())) == [(i, 143 if i < 6 else 142) for i in range(7)]
    again = materialize(counted, "common-test")
    assert again.count() == 7
    release(out, again)
