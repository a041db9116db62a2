"""Named tables handed to the analyses, loaded when first asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


class Tables:
    """``t.orders``, ``t.customer_rfm``, … through a loader: name -> DataFrame."""

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._loaded: dict[str, DataFrame] = {}

    def between(self, first: str | None = None, last: str | None = None) -> Tables:
        """The same tables limited to dates from ``first`` to ``last``, both included, ISO text.

        Analyses of it read only those date folders of a layer. Tables without ``date`` are whole.
        """

        def load(name: str) -> DataFrame:
            df = self[name]
            if "date" in df.columns:
                df = df if first is None else df.filter(df["date"] >= first)
                df = df if last is None else df.filter(df["date"] <= last)
            return df

        return Tables(load)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._loaded:
            self._loaded[name] = self._load(name)
        return self._loaded[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]
