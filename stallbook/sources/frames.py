"""A mapping of frames that are made on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyFrames(Mapping[str, DataFrame]):
    """A query touches only the tables it reads."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)
