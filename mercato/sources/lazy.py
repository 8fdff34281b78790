"""A read-only mapping whose DataFrames are built on first access.

Building a DataFrame in PySpark resolves it on the driver (file listing,
schema, analysis), so a report that needs three tables should not pay for
building all eleven.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping[str, DataFrame]):
    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name not in self._builders:
                raise KeyError(name)
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def with_table(self, name: str, builder: Callable[[], DataFrame]) -> "LazyTables":
        out = LazyTables({**self._builders, name: builder})
        out._built = dict(self._built)
        return out
