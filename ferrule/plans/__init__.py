"""The six jobs.  Each is a function from a dict of DataFrames (+ parameters) to DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class JobResult(Mapping):
    """Named job outputs, each built on first access (with whatever it depends on).

    Building a DataFrame is cheap but not free (driver-side plan construction, and eager
    checkpoints of shared intermediates), so a caller that wants one report pays only for it.
    """

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
