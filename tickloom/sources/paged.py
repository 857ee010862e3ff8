"""A paged collection as a Spark data source, in batch and as a stream.

The collection answers a day's query in pages; each page is one JSON line with its posts and
the cursor of the next page (none on the last).  A partition is a day, or a run of days where
there are many: its task follows each day's cursors from the first page until there is none or
``target`` posts are reached, so days are collected side by side and a lost task starts its days again.

As a stream, the offset is the last day collected (days are served whole and in order).  Spark keeps it in the checkpoint, so a
stopped run resumes behind the last day it finished, and a day that was under way is collected
again from its start and written once.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..operators.upsert import NO_MERGE_AT_THE_END

POST = "day string, id string, published_time string, text string, reposts string, likes string"
FIELDS = ["id", "published_time", "text", "reposts", "likes"]
TARGET = 300            # posts of a day, as collected by default
MOST = 512              # partitions of a collection


def write_pages(posts: DataFrame, path: str, size: int, order: list) -> None:
    """Pages of ``size`` posts a day, from (day, *FIELDS): one folder for each day, holding a file with a JSON line for
    each page.  The pages of a day are made by its number of rows in ``order``; each holds ``size`` posts at most."""
    w = Window.partitionBy("day").orderBy(*order)
    n = posts.withColumns({"_r": F.row_number().over(w), "_n": F.count(F.lit(1)).over(Window.partitionBy("day"))})
    n = n.withColumn("page", F.floor((F.col("_r") - 1) / size).cast("int"))
    pages = n.groupBy("day", "page").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_r", *FIELDS))), lambda p: F.struct(*[p[f].alias(f) for f in FIELDS])).alias("posts"),
        F.first("_n").alias("_n"))
    following = F.when((F.col("page") + 1) * size < F.col("_n"), (F.col("page") + 1).cast("string"))
    lines = pages.select("day", "page", F.to_json(F.struct("posts", following.alias("cursor"))).alias("value"))
    # the number of tasks is given: it is the files that take the time, not their bytes
    lines = lines.repartition(int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "day").sortWithinPartitions("day", "page")
    lines.drop("page").write.mode("append").options(**NO_MERGE_AT_THE_END).partitionBy("day").text(path)


def _entries(path: str) -> list[tuple[str, str]]:
    """(name, path) of what a folder holds, by name."""
    where, name = fs.FileSystem.from_uri(path)
    scheme = path.split("://")[0] + "://" if "://" in path else "file://"
    found = [(i.base_name, f"{scheme}{i.path}") for i in where.get_file_info(fs.FileSelector(name))]
    return sorted(e for e in found if not e[0].startswith(("_", ".")))


def days(path: str) -> list[str]:
    return [n.split("=", 1)[1] for n, _ in _entries(path) if n.startswith("day=")]


def pages(path: str, day: str) -> Iterator[tuple[str, dict]]:
    """(cursor, page) of a day, one at a time.  A folder with another number of files than one is damaged: an error, not
    an empty day."""
    files = _entries(f"{path.rstrip('/')}/day={day}")
    if len(files) != 1:
        raise ValueError(f"the pages of {day} are in {len(files)} files")
    where, name = fs.FileSystem.from_uri(files[0][1])
    with where.open_input_stream(name) as f, io.BufferedReader(f) as lines:
        for n, line in enumerate(lines):
            yield str(n), json.loads(line.decode("utf-8"))


def collect_day(path: str, day: str, target: int) -> Iterator[tuple]:
    cursor, left = "0", target
    served = pages(path, day)
    while cursor is not None and left > 0:
        at, answer = next(served, (None, {}))
        if at != cursor:
            raise ValueError(f"page {cursor} of {day} is missing")
        for p in answer["posts"][:left]:
            yield (day, *[p.get(f) for f in FIELDS])
        left -= len(answer["posts"])
        cursor = answer.get("cursor")


class Days(InputPartition):
    def __init__(self, days: list[str]):
        super().__init__(days[0])
        self.days = days


def runs(found: list[str]) -> list[Days]:
    """A partition for each day, or for a run of days where there are more than ``MOST`` (a task costs more than a small day)."""
    size = max(1, -(-len(found) // MOST))
    return [Days(found[i:i + size]) for i in range(0, len(found), size)]


class _Collector:
    def __init__(self, options: dict):
        self.path = options["path"] if "://" in options["path"] else f"file://{options['path']}"
        self.target = int(options.get("target", TARGET))

    def read(self, partition: Days) -> Iterator[tuple]:
        for d in partition.days:
            yield from collect_day(self.path, d, self.target)


class PagedReader(_Collector, DataSourceReader):
    def partitions(self) -> list[Days]:
        return runs(days(self.path))


class PagedStream(_Collector, DataSourceStreamReader):
    """Offsets are days: {"after": the last day collected, "" before the first}.  A micro-batch collects all days behind
    it; which these are follows from the two offsets alone, so a new reader goes on where the old one stood."""

    def initialOffset(self) -> dict:  # noqa: N802
        return {"after": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"after": max(days(self.path), default="")}

    def partitions(self, start: dict, end: dict) -> list[Days]:
        return runs([d for d in days(self.path) if start["after"] < d <= end["after"]])

    def commit(self, end: dict) -> None:
        pass


class PagedSource(DataSource):
    """``format("paged_posts")``; options: path, target (posts a day)."""

    @classmethod
    def name(cls) -> str:
        return "paged_posts"

    def schema(self) -> str:
        return POST

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))

    def streamReader(self, schema) -> PagedStream:  # noqa: N802
        return PagedStream(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedSource)
