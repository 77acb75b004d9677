"""Slow-control values of a paged service as a Spark data source.

The service is a function client(parameter, start, end, limit) -> [(time in ns, value), ...], the first ``limit`` values of [start, end)
in time order, named by the option ``client`` as module:function. Each parameter and year is a partition; a partition asks page after
page from behind the last value on, so no page is held longer than it is read.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Longest range of one request, values per page, and the oldest time that the service keeps (fixed values).
YEAR = 360 * 86_400 * 10**9
PAGE = 35_000
OLDEST = 5 * 365 * 86_400 * 10**9


class Span(InputPartition):
    def __init__(self, parameter: str, start: int, end: int):
        self.parameter, self.start, self.end = parameter, start, end


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.client = options["client"]
        self.parameters = json.loads(options["parameters"])
        self.start, self.end, self.page = int(options["start"]), int(options["end"]), int(options.get("page", PAGE))

    def partitions(self) -> Sequence[InputPartition]:
        return [Span(p, t, min(t + YEAR, self.end)) for p in self.parameters for t in range(self.start, self.end, YEAR)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not isinstance(partition, Span):
            return
        module, _, name = self.client.partition(":")
        client, at = getattr(importlib.import_module(module), name), partition.start
        while at < partition.end:
            values = client(partition.parameter, at, partition.end, self.page)
            for time, value in values:
                yield partition.parameter, int(time), None if value is None else float(value)
            if len(values) < self.page:
                return
            at = int(values[-1][0]) + 1


class PagedValues(DataSource):
    @classmethod
    def name(cls) -> str:
        return "slow_control"

    def schema(self) -> str:
        return "parameter string, time long, value double"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


def read_values(spark: SparkSession, client: str, parameters: Sequence[str], start: int, end: int, now: int | None = None, page: int = PAGE) -> DataFrame:
    """(parameter, time, value) of [start, end). Raises if start is not before end, or lies further back from ``now`` than the service keeps."""
    if start >= end:
        raise ValueError("the range is empty")
    if now is not None and start < now - OLDEST:
        raise ValueError("the service keeps five years")
    spark.dataSource.register(PagedValues)
    reader = spark.read.format("slow_control").option("client", client).option("parameters", json.dumps(list(parameters)))
    return reader.option("start", str(start)).option("end", str(end)).option("page", str(page)).load()
