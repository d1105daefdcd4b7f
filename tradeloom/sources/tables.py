"""The set of input tables every model is a function of."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators.staging import orders_view, stage_orders


class Tables:
    """Raw tables of one run, each opened on first use and then kept.

    Tables are reached as attributes: `t.orders`, `t.customers`. Those named in `RAW_DDL`
    have a declared schema; others are carried along, so that a copy is complete.
    """

    def __init__(
        self,
        openers: Mapping[str, Callable[[], DataFrame]],
        stored: Mapping[str, DataFrame] | None = None,
        unique_orders: bool = False,
    ):
        self.unique_orders = unique_orders
        self._openers = dict(openers)
        self._shared = dict(stored or {})

    @classmethod
    def of(cls, **frames: DataFrame) -> Tables:
        """Tables from frames at hand."""
        return cls({name: lambda frame=frame: frame for name, frame in frames.items()})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._openers:
            raise AttributeError(name)
        frame = self._openers[name]()
        self.__dict__[name] = frame
        return frame

    @cached_property
    def stg_orders(self) -> DataFrame:
        """The staging model over the raw orders."""
        return self.shared("stg_orders", lambda: stage_orders(self.orders))

    @cached_property
    def placed_orders(self) -> DataFrame:
        """Staged orders of any status, with short column names."""
        return orders_view(self.stg_orders)

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A frame several models start from: the stored one if there is one."""
        if name not in self._shared:
            self._shared[name] = build()
        return self._shared[name]

    def with_stored(self, **frames: DataFrame) -> Tables:
        """The same tables, with stored frames in place of derived shared ones."""
        return Tables(self._openers, frames, self.unique_orders)

    def with_unique_orders(self) -> Tables:
        """The same tables after a check that staged orders have unique, known ids."""
        return Tables(self._openers, self._shared, unique_orders=True)

    def with_raw(self, **frames: DataFrame) -> Tables:
        """The same tables with some raw tables replaced; nothing shared is kept."""
        replaced = {name: lambda frame=frame: frame for name, frame in frames.items()}
        return Tables({**self._openers, **replaced})

    def slice_of(self, key: str, slices: int, number: int) -> Tables:
        """The same tables with the rows of one slice only where a table has the key.

        Rows fall into slices by a hash of the key, so the slices together are the tables. A
        frame that joins and groups by the key alone is the union of what its slices give.
        """

        def cut(frame: DataFrame) -> DataFrame:
            held = [c for c in frame.columns if c.lower() == key.lower()]
            return frame.where(F.pmod(F.xxhash64(held[0]), F.lit(slices)) == number) if held else frame

        opened = {name: lambda name=name: cut(getattr(self, name)) for name in self._openers}
        return Tables(opened, {name: cut(frame) for name, frame in self._shared.items()}, self.unique_orders)

    def names(self) -> list[str]:
        return list(self._openers)

    def by_name(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self._openers}
