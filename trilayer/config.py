"""Settings of one lakehouse: where its layers live and the analysis options."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

RAW, SILVER, GOLD = "raw", "silver", "gold"

# The 24 raw tables, 17 dimensions and then 7 facts.
RAW_TABLES = (
    "date_dim", "time_dim", "customer", "customer_address",
    "customer_demographics", "household_demographics", "income_band", "item",
    "store", "call_center", "catalog_page", "web_site", "web_page",
    "warehouse", "ship_mode", "reason", "promotion",
    "store_sales", "store_returns", "catalog_sales", "catalog_returns",
    "web_sales", "web_returns", "inventory",
)

# Tables that reach silver unchanged. ``time_dim`` is one of them
# so that every registered silver name has data behind it.
PASSTHROUGH_TABLES = (
    "store", "warehouse", "ship_mode", "call_center", "catalog_page",
    "web_site", "web_page", "promotion", "reason", "income_band",
    "household_demographics", "customer_demographics", "inventory", "time_dim",
)

GOLD_TABLES = ("sales_fact", "customer_360", "product_performance")


@dataclass(frozen=True)
class LayerConfig:
    """One lakehouse.

    ``root`` is a folder every executor can reach. ``best_is_high`` turns the
    three RFM orders round so that the best customers score highest;
    ``null_as_zero`` lets a channel without sales count as 0 when channels are
    compared. Both are off by default, which keeps the established results.
    While a layer is rebuilt, ``shuffle_partitions`` is set (without it the session's own
    setting stands), and stored tables up to ``broadcast_limit`` are broadcast: a
    larger one is joined by sort-merge, but shuffling a whole fact for a
    dimension of a few MB would cost far more. ``keep_versions`` versions of each table stay:
    the newest and those that readers may have started on. ``compression`` is that of the table format's files;
    without it the session's own setting stands.
    """

    root: str
    database: str = "retail"
    table_format: str = "parquet"
    analysis_date: date = date(2003, 12, 31)
    best_is_high: bool = False
    null_as_zero: bool = False
    shuffle_partitions: int | None = None
    broadcast_limit: str = "32MB"
    keep_versions: int = 2
    compression: str | None = "zstd"
    bases: dict[str, str] = field(
        default_factory=lambda: {RAW: "raw", SILVER: "silver", GOLD: "gold"}
    )

    def name(self, layer: str, table: str) -> str:
        """Unqualified catalog name of a table in a layer."""
        self._check(layer)
        return table if layer == RAW else f"{layer}_{table}"

    def qualified(self, layer: str, table: str) -> str:
        return f"{self.database}.{self.name(layer, table)}"

    def path(self, layer: str, table: str) -> str:
        self._check(layer)
        return "/".join([self.root.rstrip("/"), self.bases[layer], self.name(layer, table)])

    def _check(self, layer: str) -> None:
        if layer not in self.bases:
            raise ValueError(f"Unknown layer: {layer}")
