"""Parameters of the jobs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime


@dataclass(frozen=True)
class Settings:
    """Defaults are the reporting rules for amounts in whole currency units."""

    #: Orders bought earlier are left out of the models.
    min_order_date: str = "2022-01-01"
    #: Spend from which a customer counts as high or medium value.
    high_value: int = 1000
    medium_value: int = 300
    #: Rows of the product and customer reports.
    top_k: int = 100
    #: The moment recency is measured from; None is the start of the query.
    as_of: datetime | None = None
