"""The input tables of a run, built on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..params import MartParams
from ..schemas import RAW_TABLES
from ..sources.landing import read_table
from . import movement_days


class Tables(Mapping[str, DataFrame]):
    """Table name to DataFrame; a table nobody asks for is never planned."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    @classmethod
    def of(cls, **frames: DataFrame) -> Tables:
        return cls({name: (lambda df=df: df) for name, df in frames.items()})

    @classmethod
    def from_root(cls, spark: SparkSession, root: str) -> Tables:
        """The raw tables the loader keeps under ``root``; they hold one version per key.

        The days of last movements are among them while they are up to date.
        """
        builders = {name: (lambda n=name: read_table(spark, root, n)) for name in RAW_TABLES}
        if movement_days.is_fresh(spark, root):
            builders["movement_days"] = lambda: movement_days.read(spark, root)
        return cls(builders)


def run_sql(spark: SparkSession, text: str, params: MartParams, **frames: DataFrame) -> DataFrame:
    """A query with ``{table}`` placeholders and the run parameters bound by name (``:as_of`` …)."""
    return spark.sql(text, args=params.sql_args(), **frames)
