"""Run parameters: one run date, day windows and the source system's codes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, timedelta

from ledgerline import fixed_values as fv


@dataclass(frozen=True)
class Codes:
    """Code lists and labels of the source system; never written into a pipeline."""

    document_status: tuple[int, ...] = fv.DOCUMENT_STATUS
    invoice_natures: tuple[int, ...] = fv.INVOICE_NATURES
    return_nature: int = fv.RETURN_NATURE
    return_excluded_project: int = fv.RETURN_EXCLUDED_PROJECT
    sale_situation: int = fv.SALE_SITUATION
    sale_project: int = fv.SALE_PROJECT
    labelled_order_type: int = fv.LABELLED_ORDER_TYPE
    order_situations: tuple[int, ...] = fv.ORDER_SITUATIONS
    order_excluded_location: int = fv.ORDER_EXCLUDED_LOCATION
    stock_locations: tuple[int, ...] = fv.STOCK_LOCATIONS
    taxpayer_labels: Mapping[int, str] = field(default_factory=lambda: fv.TAXPAYER_LABELS)
    destination_labels: Mapping[int, str] = field(default_factory=lambda: fv.DESTINATION_LABELS)
    # Label per company id on return lines; the business supplies it.
    company_labels: Mapping[int, str] = field(default_factory=dict)
    # Extra-field patterns. The sale freight field carries the business's own name,
    # so it has no default: the general job demands it, and without it no line is repeated.
    sale_freight_pattern: str | None = None
    return_freight_pattern: str = fv.RETURN_FREIGHT_PATTERN
    traffic_pattern: str = fv.TRAFFIC_PATTERN
    prospect_pattern: str = fv.PROSPECT_PATTERN


@dataclass(frozen=True)
class RunParams:
    """One clock for a whole run: every window is counted back from ``run_date``."""

    run_date: date
    billing_days: int = fv.BILLING_DAYS
    recent_days: int = fv.RECENT_DAYS
    order_days: int = fv.ORDER_DAYS
    mark_fallback_days: int = fv.MARK_FALLBACK_DAYS
    codes: Codes = field(default_factory=Codes)

    def days_back(self, days: int) -> date:
        return self.run_date - timedelta(days=days)

    @property
    def billing_start(self) -> date:
        return self.days_back(self.billing_days)

    @property
    def recent_start(self) -> date:
        return self.days_back(self.recent_days)

    @property
    def order_start(self) -> date:
        return self.days_back(self.order_days)

    @property
    def mark_fallback(self) -> date:
        return self.days_back(self.mark_fallback_days)
