import pytest
from pyspark.sql import functions as F

from tickloom.session import scratch_path
from tickloom.sources import paged

N = 47


def pages(spark, n=N, per_day=9, first=0, path=None):
    path = path or scratch_path(spark, "t_pages")
    df = spark.range(first, n).select(F.format_string("2024-01-%02d", (F.col("id") / per_day).cast("int") + 1).alias("day"),
                               F.col("id").cast("string").alias("id"), F.lit("t").alias("published_time"),
                               F.when(F.col("id") % 5 > 0, F.concat(F.lit('é "x" '), F.col("id"))).alias("text"),
                               F.lit("0").alias("reposts"), (F.col("id") % 3).cast("string").alias("likes"))
    paged.write_pages(df, path, 4, [F.col("id").cast("bigint")])
    paged.register(spark)
    return path, df


def ids(rows):
    return sorted(int(r["id"]) for r in rows)


def test_batch_follows_every_cursor(spark):
    path, df = pages(spark)
    got = spark.read.format("paged_posts").option("path", path).load()
    assert got.rdd.getNumPartitions() == len(paged.days(path)) == 6
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, df.select(got.columns).collect()), key=repr)


def test_target_ends_a_day(spark):
    path, _ = pages(spark)
    got = spark.read.format("paged_posts").option("path", path).option("target", 6).load()
    assert ids(got.collect()) == [i for i in range(N) if i % 9 < 6]


def test_a_missing_page_is_an_error(spark):
    path, _ = pages(spark, 3)
    with pytest.raises(Exception, match="No such file|does not exist|cannot find|page"):
        list(paged.collect_day(f"file://{path}", "2024-01-09", 10))


def test_killed_and_resumed_loses_and_repeats_no_row(spark):
    path, _ = pages(spark, 18)
    out, ckpt = scratch_path(spark, "t_paged_out"), scratch_path(spark, "t_paged_ckpt")
    fail = {"at": 1}

    def run():
        def sink(batch, epoch):
            batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
            if epoch == fail["at"]:
                raise RuntimeError("killed after writing, before the commit")
        s = spark.readStream.format("paged_posts").option("path", path).load()
        q = s.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()

    def collected():
        return ids(spark.read.parquet(out).collect())

    run()
    assert collected() == list(range(18))
    pages(spark, 36, first=18, path=path)
    with pytest.raises(Exception, match="killed"):
        run()
    fail["at"] = None
    run()                                       # the broken batch again
    assert collected() == list(range(36))
    run()                                       # nothing new
    assert collected() == list(range(36))
    pages(spark, N, first=36, path=path)
    run()
    assert collected() == list(range(N))


def test_many_days_make_few_files_and_tasks(spark, monkeypatch):
    import glob
    path, df = pages(spark)
    assert len(glob.glob(f"{path}/**/part-*", recursive=True)) == 6           # a file a day, not one a page
    monkeypatch.setattr(paged, "MOST", 4)
    assert [p.days for p in paged.runs([str(i) for i in range(6)])] == [["0", "1"], ["2", "3"], ["4", "5"]]
    reader = paged.PagedReader({"path": path})
    got = [row for p in reader.partitions() for row in reader.read(p)]
    assert len(reader.partitions()) == 3 and len(got) == N
    assert sorted(got, key=repr) == sorted(map(tuple, df.select("day", *paged.FIELDS).collect()), key=repr)
