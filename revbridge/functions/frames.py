"""Named frames of a pipeline, each built when it is first asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


class Frames(dict[str, DataFrame]):
    """A frame that nobody asks for is neither planned nor staged."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self.builders = builders

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.builders[name]()
        return self[name]
