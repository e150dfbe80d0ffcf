"""Run parameters and the fixed business codes the rollup depends on."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import datetime, timedelta

# Fixed values (must equal the original procedure's codes for equal results):
#   generic cross-store sale item  '00000000000010222778'
#   reorder purchasing location    '00944'
#   reorder item class             'TTB'
#   vendor-returns location        '00300'
#   damage location                '00900'
#   supplies vendor                'WHPBSUPPLY'
#   base-inventory scheme          'BASE INVENTORY'
#   e-commerce scheme              'ECOM'
#   available-stock company        'TTB'
#   excluded wholesale customers   'SAMPLE', 'REPS' and prefixes 'MRDC', 'RDC', 'TTB'
#   default purchases start date   2008-01-01
#   report received-date cutoff    2010-01-01
GENERIC_CROSS_STORE_ITEM = "00000000000010222778"
REORDER_LOCATION = "00944"
REORDER_CLASS = "TTB"
RETURNS_LOCATION = "00300"
DAMAGE_LOCATION = "00900"
SUPPLIES_VENDOR = "WHPBSUPPLY"
BASE_INVENTORY_SCHEME = "BASE INVENTORY"
ECOM_SCHEME = "ECOM"
AVAILABLE_COMPANY = "TTB"
WHOLESALE_EXCLUDED_CUSTOMERS = ("SAMPLE", "REPS")
WHOLESALE_EXCLUDED_PREFIXES = ("MRDC", "RDC", "TTB")
DEFAULT_START = datetime(2008, 1, 1)
DEFAULT_REPORT_CUTOFF = datetime(2010, 1, 1)


@dataclass(frozen=True)
class RollupParams:
    """``as_of`` replaces the wall clock so runs are reproducible."""

    as_of: datetime
    start_date: datetime = DEFAULT_START
    generic_item_code: str = GENERIC_CROSS_STORE_ITEM
    report_cutoff: datetime = DEFAULT_REPORT_CUTOFF
    # digits of a PO number; receipts and shipments carry it with a suffix or prefix
    po_width: int = 6

    @property
    def end_date(self) -> datetime:
        """Midnight of the ``as_of`` day (end of the purchase and sales windows)."""
        return datetime(self.as_of.year, self.as_of.month, self.as_of.day)

    @property
    def ship_end(self) -> datetime:
        """Shipment windows include midnight of the following day."""
        return self.end_date + timedelta(days=1)

    @property
    def one_year_ago(self) -> datetime:
        return _shift_months(self.as_of, -12)


def _shift_months(ts: datetime, months: int) -> datetime:
    m = ts.month - 1 + months
    y, m = ts.year + m // 12, m % 12 + 1
    d = min(ts.day, calendar.monthrange(y, m)[1])
    return ts.replace(year=y, month=m, day=d)


# Parameters used with the synthetic test tables (order dates 1995-2001).
SYNTHETIC = RollupParams(
    as_of=datetime(2001, 8, 1),
    start_date=datetime(1995, 1, 1),
    report_cutoff=datetime(1999, 1, 1),
    po_width=18,
)
