from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import functions as F

from tidemark.llm.components import FILE_CLEANUP, stored


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(p) for folder in folders for p in Path(folder.getPath()).rglob("shuffle_*.data")}


def test_stored_frames_leave_no_shuffle_files(spark):
    rows = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n"))
    before, setting = shuffle_files(spark), spark.conf.get(FILE_CLEANUP)
    first = stored(rows, "counts")
    for _ in range(50):  # files are deleted in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(FILE_CLEANUP) == setting
    # The frame can be used again, also after its files are gone.
    assert sorted(stored(rows, "counts").collect()) == sorted(first.collect()) == sorted(rows.collect()) == [(k, 100) for k in range(10)]
