"""All windows, ratios and defaults in one place. Nothing in the package reads a clock."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

LISTING_KEY = ("PropertyId", "AuctionId", "VenueId")


@dataclass(frozen=True)
class Params:
    as_of: date

    # rolling windows
    window_months: int = 5
    bid_months: int = 3
    programme_start: date = date(2013, 7, 1)
    registration_start: date = date(2013, 7, 1)
    training_registration_start: date = date(2013, 6, 1)  # training rows count registrations from earlier on
    horizon_days: int = 120
    holdout_days: int = 30

    # floors for published rates and for fitting a state
    min_listings: int = 10
    min_trustee_listings: int = 5
    min_state_rows: int = 30
    min_trustee_state_rows: int = 50

    # valuation and location defaults at scoring time
    valuation_ratio: float = 1.2
    surplus_share_default: float = 0.2
    absurd_valuation_bound: float = 0.15
    trustee_functional_bound: float = 0.1
    population_default: float = 8000.0
    vacancy_default: float = 0.087

    reference_year: int = 2013
    own_order_parent: str = "Bank of America"

    # Reproduce whole-number rounding of undeclared decimals (1.2 -> 1, 0.087 -> 0, ...).
    legacy_decimal: bool = False
    # Divide a trustee valuation by the reserve instead of by itself.
    trustee_pct_over_reserve: bool = False

    def number(self, name: str) -> float:
        """A default as the scorer sees it: rounded to a whole number under ``legacy_decimal``."""
        value = float(getattr(self, name))
        return float(int(value + 0.5)) if self.legacy_decimal else value
