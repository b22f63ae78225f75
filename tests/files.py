"""Observation files for tests."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

from tempspan.schema import OBSERVATION_FIELDS

FIELDS = list(OBSERVATION_FIELDS)
WIDTHS = {"DTG": 21, "LOCATION": 20, "NAME": 48}
HEADER_TEXT = "# Ten-minute observations of the national stations"


def header(fields=FIELDS, widths=WIDTHS, default=20) -> str:
    cells = [f"# {f}" if f == "DTG" else f for f in fields]
    return "".join(c.ljust(widths.get(f, default)) for c, f in zip(cells, fields))


def row(values: dict, fields=FIELDS, widths=WIDTHS, default=20) -> str:
    return "".join(str(values.get(f, "")).ljust(widths.get(f, default)) for f in fields)


def document(rows, fields=FIELDS, widths=WIDTHS, default=20, newline="\n", head=True) -> str:
    lines = [HEADER_TEXT]
    if head:
        lines.append(header(fields, widths, default))
    lines += [row(r, fields, widths, default) for r in rows]
    return newline.join(lines) + newline


def write(path: Path, text: str) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return path


def observation(time, tx=None, tn=None, station="260_T_a", name="De Bilt", **more) -> dict:
    stamp = time.strftime("%Y-%m-%d %H:%M:%S") if isinstance(time, dt.datetime) else time
    values = {"DTG": stamp, "LOCATION": station, "NAME": name, **more}
    if tx is not None:
        values["TX_DRYB_10"] = tx
    if tn is not None:
        values["TN_DRYB_10"] = tn
    return values


# The published results for one station from 2003 on.
GOLDEN_HOT = [
    ("31 Jul 2003", "13 Aug 2003", 14, 7, 35.0),
    ("02 Aug 2004", "11 Aug 2004", 10, 3, 32.5),
    ("18 Jun 2005", "24 Jun 2005", 7, 3, 32.8),
    ("30 Jun 2006", "06 Jul 2006", 7, 3, 32.0),
    ("15 Jul 2006", "30 Jul 2006", 16, 8, 35.7),
    ("21 Jul 2013", "27 Jul 2013", 7, 3, 32.6),
    ("30 Jun 2015", "05 Jul 2015", 6, 3, 33.1),
    ("15 Jul 2018", "27 Jul 2018", 13, 4, 35.7),
    ("29 Jul 2018", "07 Aug 2018", 10, 4, 33.9),
]
GOLDEN_COLD = [("30 Jan 2012", "08 Feb 2012", 10, 5, -18.9)]


def golden_days() -> dict[dt.date, tuple[float, float]]:
    """Daily (max, min) whose periods are the golden ones, with mild days around them."""
    days: dict[dt.date, tuple[float, float]] = {}
    runs = [(True, *g) for g in GOLDEN_HOT] + [(False, *g) for g in GOLDEN_COLD]
    for warm, first, _, length, extreme, temperature in runs:
        start = dt.datetime.strptime(first, "%d %b %Y").date()
        for i in range(-5, length + 5):
            days.setdefault(start + dt.timedelta(i), (24.9, 5.0))
        for i in range(length):
            if warm:
                value = temperature if i == 0 else 30.0 if i < extreme else 25.0
                days[start + dt.timedelta(i)] = (value, 12.0)
            else:
                value = temperature if i == 0 else -10.1 if i < extreme else -10.0
                days[start + dt.timedelta(i)] = (-0.1, value)
    # A long hot spell before the first year, and a short one that is no wave.
    for i in range(9):
        days[dt.date(2001, 7, 1) + dt.timedelta(i)] = (33.0, 12.0)
    for i in range(4):
        days[dt.date(2010, 7, 1) + dt.timedelta(i)] = (33.0, 12.0)
    return days


def golden_observations() -> list[dict]:
    rows = []
    for day, (tx, tn) in sorted(golden_days().items()):
        at = dt.datetime.combine(day, dt.time())
        rows += [
            observation(at, min(tx, 20.0) if tx > 0 else tx - 1, max(tn, 6.0) if tn > 0 else -2.0),
            observation(at.replace(hour=5), tx if tx < 0 else 15.0, tn),
            observation(at.replace(hour=14, minute=50), tx, max(tn, 3.0) if tn > 0 else -1.0),
            observation(at.replace(hour=16), None, 10.0 if tn > 0 else -1.5),
            observation(at.replace(hour=17), station="999_X_a", name="Elsewhere", tx=26.0, tn=9.0),
        ]
    return rows
