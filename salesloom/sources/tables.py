"""The five raw tables as one value."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class RawTables:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    returns: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in self.__dataclass_fields__]
