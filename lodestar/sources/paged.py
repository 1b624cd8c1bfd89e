"""A paged web service as a data source: one partition for each stretch of offsets, filters and columns pushed into the request.

    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    spark.dataSource.register(PagedSource)
    spark.read.format("paged").schema(...).option("url", ...).option("where", "island = 1").load()

The service takes ``where``, ``fields``, ``offset`` and ``limit`` and answers with a JSON document whose ``rows`` is an array of objects. With the option ``total`` the offsets are dealt to partitions; without it one
partition asks page after page until a short one comes.
"""

from __future__ import annotations

import json
from urllib.parse import urlencode
from urllib.request import urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition


class Stretch(InputPartition):
    def __init__(self, first: int, last: int | None):
        self.first, self.last = first, last


class PagedReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema, self.url, self.where = schema, options["url"], options.get("where", "")
        self.limit, self.total, self.tasks = int(options.get("limit", 1000)), options.get("total"), int(options.get("partitions", 8))

    def pushFilters(self, filters: list[Filter]):
        """Equalities with a column's whole value go to the service, the others stay with Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and isinstance(f.value, (int, str)):
                value = f.value if isinstance(f.value, int) else "'" + f.value.replace("'", "''") + "'"
                self.where = f"{self.where} AND {f.attribute[0]} = {value}" if self.where else f"{f.attribute[0]} = {value}"
            else:
                yield f

    def partitions(self):
        if self.total is None:
            return [Stretch(0, None)]
        total = int(self.total)
        pages = -(-total // self.limit)
        each = max(1, -(-pages // self.tasks)) * self.limit
        return [Stretch(a, min(a + each, total)) for a in range(0, total, each)]

    def read(self, partition):
        names = [f.name for f in self.schema.fields]
        at = partition.first
        while partition.last is None or at < partition.last:
            size = self.limit if partition.last is None else min(self.limit, partition.last - at)
            asked = urlencode({"where": self.where, "fields": ",".join(names), "offset": at, "limit": size})
            with urlopen(f"{self.url}?{asked}", timeout=60) as answer:  # noqa: S310  (the caller's own address)
                rows = json.load(answer)["rows"]
            for r in rows:
                yield tuple(r.get(n) for n in names)
            at += size
            if len(rows) < size:
                return


class PagedSource(DataSource):
    @classmethod
    def name(cls):
        return "paged"

    def schema(self):
        raise ValueError("a paged source needs a schema")

    def reader(self, schema):
        return PagedReader(schema, self.options)
