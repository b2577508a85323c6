"""Declarative description of a panel (key columns, date, target) and of a temporal split."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class PanelSpec:
    """A panel is unique on (date, *keys); one series = one value of `keys`.

    `decimals`: when the target is money with at most this many decimals, rolling
    means of the target are averaged as decimals (exact, independent of the order of
    addition) and returned as double. None keeps plain double arithmetic.
    """

    date: str = "date"
    keys: tuple[str, ...] = ("store_nbr", "family")
    target: str = "sales"
    decimals: int | None = None

    @property
    def key_cols(self) -> list[str]:
        return list(self.keys)

    @property
    def grain(self) -> list[str]:
        return [self.date, *self.keys]


@dataclass(frozen=True)
class SplitSpec:
    """Contiguous date ranges; `horizon` has no target."""

    train: tuple[dt.date, dt.date]
    val: tuple[dt.date, dt.date]
    test: tuple[dt.date, dt.date]
    horizon: tuple[dt.date, dt.date] | None = None
    parts: tuple[str, ...] = field(default=("train", "val", "test"))

    def ranges(self) -> list[tuple[str, dt.date, dt.date]]:
        out = [(p, *getattr(self, p)) for p in self.parts]
        if self.horizon is not None:
            out.append(("horizon", *self.horizon))
        return out


DEFAULT_PANEL = PanelSpec(decimals=4)  # fixture sales are sums of 4-decimal amounts

# Split boundaries of the fixture panel (FIXTURES.md, split table).
DEFAULT_SPLIT = SplitSpec(
    train=(dt.date(1995, 1, 2), dt.date(2001, 9, 19)),
    val=(dt.date(2001, 9, 20), dt.date(2001, 10, 20)),
    test=(dt.date(2001, 10, 21), dt.date(2001, 11, 4)),
    horizon=(dt.date(2001, 11, 5), dt.date(2001, 11, 20)),
)

# Shock period (earthquake-style flag) of the fixture calendar.
SHOCK_PERIODS = ((dt.date(1999, 4, 16), dt.date(1999, 5, 16)),)

# Forecast horizon length in days for the direct multi-step forecast.
HORIZON_DAYS = 16
