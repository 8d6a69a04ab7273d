"""The dates a report run is about."""

from dataclasses import dataclass
from datetime import date

from billscope.functions.months import later_month


@dataclass(frozen=True)
class Periods:
    """`year` drives MRR and retention; `invoices`, `chargebacks` and `closed` are half-open.

    The MRR calendar has `n_months` months from the December before the year on.
    """

    year: int
    invoices: tuple[date, date]
    chargebacks: tuple[date, date]
    closed: tuple[date, date]
    n_months: int = 13

    def __post_init__(self) -> None:
        for name in ("invoices", "chargebacks", "closed"):
            start, end = getattr(self, name)
            if start >= end:
                raise ValueError(f"the period {name} from {start} to {end} is empty")
        if self.n_months < 1:
            raise ValueError("the calendar needs a month")

    @classmethod
    def for_month(
        cls, year: int, month: int, closed_from: date | None = None, n_months: int = 13
    ) -> "Periods":
        """Reconcile one month; its chargebacks restate the closed months before it.

        These start with the year of the month before (so January restates the whole year
        before it), or with `closed_from`.
        """
        start = date(year, month, 1)
        whole = (start, later_month(start, 1))
        closed_from = closed_from or date(later_month(start, -1).year, 1, 1)
        return cls(year, invoices=whole, chargebacks=whole, closed=(closed_from, start), n_months=n_months)

    @property
    def anchor_month(self) -> date:
        """The December before the year: start of the MRR calendar and of the NRR period."""
        return date(self.year - 1, 12, 1)

    @property
    def last_month(self) -> date:
        return later_month(self.anchor_month, self.n_months - 1)

    @property
    def year_start(self) -> date:
        return date(self.year, 1, 1)


# The periods of the published reports.
JUNE_2024 = Periods.for_month(2024, 6)

# The same kind of periods inside the years the sample orders cover.
SAMPLE_1999 = Periods(
    year=1999,
    invoices=(date(1999, 6, 1), date(1999, 12, 1)),
    chargebacks=(date(1999, 6, 1), date(1999, 9, 1)),
    closed=(date(1999, 1, 1), date(1999, 6, 1)),
)
