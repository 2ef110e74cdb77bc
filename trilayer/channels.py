"""The three sales channels, described by the names of their source columns."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Channel:
    """Where one channel keeps what the common sales schema needs."""

    name: str
    sales_table: str
    returns_table: str
    sales: str  # column prefix of the sales table
    returns: str  # column prefix of the returns table
    transaction: str  # the ticket or order number, without prefix
    customer: str
    location: str
    return_amount: str
    has_discount: bool = True  # the channel records coupons and a list price discount
    cleans_quantity: bool = False
    decimal_net_loss: bool = False

    def s(self, column: str) -> str:
        return f"{self.sales}_{column}"

    def r(self, column: str) -> str:
        return f"{self.returns}_{column}"

    @property
    def sales_key(self) -> list[str]:
        return [self.s(self.transaction), self.s("item_sk")]

    @property
    def returns_key(self) -> list[str]:
        return [self.r(self.transaction), self.r("item_sk")]


STORE = Channel(
    "STORE", "store_sales", "store_returns", "ss", "sr", "ticket_number",
    customer="ss_customer_sk", location="ss_store_sk", return_amount="sr_return_amt",
    cleans_quantity=True, decimal_net_loss=True,
)
CATALOG = Channel(
    "CATALOG", "catalog_sales", "catalog_returns", "cs", "cr", "order_number",
    customer="cs_bill_customer_sk", location="cs_call_center_sk", return_amount="cr_return_amount",
)
WEB = Channel(
    "WEB", "web_sales", "web_returns", "ws", "wr", "order_number",
    customer="ws_bill_customer_sk", location="ws_web_site_sk", return_amount="wr_return_amt",
    has_discount=False,
)
CHANNELS = (STORE, CATALOG, WEB)
