"""Folder layout of a lakehouse under one root."""

from __future__ import annotations

import os
from dataclasses import dataclass

from tierline.schemas import SILVER_PARTITION

ROOT_VARIABLE = "LAKEHOUSE_ROOT"


@dataclass(frozen=True)
class Layout:
    """Paths below ``root``; any URI that Spark can read works.

    ``silver_by`` divides Silver: by day, or by ``month(event_date)`` where days are small.
    """

    root: str
    silver_by: str = SILVER_PARTITION

    @classmethod
    def from_environment(cls, default: str = "data") -> Layout:
        return cls(os.environ.get(ROOT_VARIABLE, default))

    def _at(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    @property
    def raw(self) -> str:
        return self._at("sample_raw")

    @property
    def bronze(self) -> str:
        return self._at("bronze", "transactions")

    @property
    def silver(self) -> str:
        return self._at("silver", "transactions")

    @property
    def rejects(self) -> str:
        return self._at("silver", "transactions_rejects")

    @property
    def daily_revenue(self) -> str:
        return self._at("gold", "daily_revenue")

    @property
    def daily_narrow(self) -> str:
        return self._at("gold", "daily_revenue_narrow")

    @property
    def customer_ltv(self) -> str:
        return self._at("gold", "customer_ltv")

    @property
    def customer_days(self) -> str:
        return self._at("gold", "state", "customer_days")

    @property
    def customer_totals(self) -> str:
        return self._at("gold", "state", "customer_totals")

    @property
    def customer_index(self) -> str:
        return self._at("gold", "customer_index")

    @property
    def runs(self) -> str:
        return self._at("models", "runs")

    @property
    def model_versions(self) -> str:
        return self._at("models", "versions")

    @property
    def model_aliases(self) -> str:
        return self._at("models", "aliases")

    @property
    def model_files(self) -> str:
        return self._at("models", "files")

    def checkpoint(self, stream: str) -> str:
        return self._at("checkpoints", stream)
