"""A connector for sources that serve their rows in numbered pages.

Each page is a task of its own, pages that cannot match a pushed-down filter are
not fetched, and only the wanted columns are decoded. The pages here are parquet
files in a shared folder; another service needs another ``Pages``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)


class Page(InputPartition):
    def __init__(self, name: str):
        self.name = name


class Pages:
    """Numbered parquet pages in a folder, with the range of ``key`` in each."""

    def __init__(self, folder: str, key: str):
        from pyarrow import fs

        self.files, self.root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        self.key = key

    def names(self) -> list[str]:
        from pyarrow import fs

        found = self.files.get_file_info(fs.FileSelector(self.root))
        return sorted(f.path for f in found if f.path.endswith(".parquet"))

    def bounds(self, name: str) -> tuple | None:
        """Smallest and largest key of a page, from its footer; None if unknown."""
        import pyarrow.parquet as pq

        meta = pq.read_metadata(name, filesystem=self.files)
        position = meta.schema.names.index(self.key)
        spans = [meta.row_group(i).column(position).statistics for i in range(meta.num_row_groups)]
        if not spans or any(s is None or not s.has_min_max for s in spans):
            return None
        return min(s.min for s in spans), max(s.max for s in spans)

    def rows(self, name: str, columns: list[str]):
        import pyarrow.parquet as pq

        with pq.ParquetFile(name, filesystem=self.files) as page:
            yield from page.iter_batches(columns=columns)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.folder = options["path"]
        self.key = options["key"]
        self.columns = schema.names
        self.limits: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        """Use comparisons on the key to skip pages; Spark still checks every row."""
        kinds = {
            EqualTo: "eq",
            GreaterThan: "ge",
            GreaterThanOrEqual: "ge",
            LessThan: "le",
            LessThanOrEqual: "le",
        }
        for f in filters:
            if type(f) in kinds and tuple(f.attribute) == (self.key,):
                self.limits.append((kinds[type(f)], f.value))
            yield f

    def _may_match(self, bounds: tuple | None) -> bool:
        if bounds is None:
            return True
        low, high = bounds
        for kind, value in self.limits:
            if kind in ("eq", "ge") and high < value:
                return False
            if kind in ("eq", "le") and low > value:
                return False
        return True

    def partitions(self) -> list[Page]:
        pages = Pages(self.folder, self.key)
        if not self.limits:
            return [Page(n) for n in pages.names()]
        return [Page(n) for n in pages.names() if self._may_match(pages.bounds(n))]

    def read(self, page: Page | None) -> Iterator:
        if page is None:  # no page can match
            return
        yield from Pages(self.folder, self.key).rows(page.name, self.columns)


class PagedSource(DataSource):
    """``spark.read.format("paged").schema(...).option("key", ...).load(folder)``"""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> T.StructType:
        raise ValueError("give the schema of the pages with .schema(...)")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagedReader(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSource)
