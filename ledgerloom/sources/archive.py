"""The archive as a data source: `spark.read.format("archive")` fetches documents in tasks that share one rate (SRC-04, SRC-05).

Options: `urls` (a JSON list), `user_agent`, `per_second` (of all tasks together,
5 by default), `tasks` (8 by default), `timeout`, `missing_ok` ("true": missing and
forbidden documents are rows without content), and, for an archive that lies in
a folder, `root` with `prefix`, the address that the folder stands for.

A task has an equal share of the rate, so all of them stay within it however they
are scheduled; each retries by the rules of `Fetcher`. A document that cannot be had is a row
with `error`, and the others go on. A task that is run again fetches its
documents again: write what was read before it is used twice.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..plans.fetch import Fetcher, FetchError, NotFound, folder_transport, http_transport


class Share(InputPartition):
    """The addresses of one task, and its part of the rate."""

    def __init__(self, urls: list[str], per_second: float):
        super().__init__(urls)
        self.urls, self.per_second = urls, per_second


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.urls = json.loads(options.get("urls", "[]"))
        if self.urls and not options.get("user_agent"):
            raise ValueError("user_agent has to name who is asking")

    def partitions(self) -> list[Share]:
        tasks = max(1, min(len(self.urls), int(self.options.get("tasks", "8"))))
        rate = float(self.options.get("per_second", "5")) / tasks
        return [Share(self.urls[i::tasks], rate) for i in range(tasks)]

    def fetcher(self, share: Share) -> Fetcher:
        folder = self.options.get("root")
        transport = folder_transport(folder, self.options.get("prefix", "")) if folder else http_transport
        return Fetcher(self.options.get("user_agent", ""), transport, share.per_second, float(self.options.get("timeout", "30")))

    def read(self, partition: Share) -> Iterator[tuple]:
        fetcher, missing_ok = self.fetcher(partition), self.options.get("missing_ok", "false").lower() == "true"
        for url in partition.urls:
            try:
                yield url, fetcher.get(url, missing_ok), None
            except (FetchError, NotFound) as problem:
                yield url, None, f"{type(problem).__name__}: {problem}"


class Archive(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return "url string, content binary, error string"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Archive)
