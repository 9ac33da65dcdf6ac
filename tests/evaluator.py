"""The determination as a plain loop over small Python data, written apart from the library."""

from __future__ import annotations

from datetime import date, timedelta
from itertools import groupby

ONE = timedelta(days=1)

POINTS = {
    "early": {"D2": 1, "D3a": 2, "D3b": 3, "D4a": 3, "D4b": 3},
    "middle": {"D2": 1, "D3a": 3, "D3b": 4, "D4a": 4, "D4b": 5},
    "late": {"D2a": 1, "D2b": 2, "D3a": 3, "D3b": 4, "D4a": 4, "D4b": 5},
}
NAMES = {"D2a": "D2a_2026", "D2b": "D2b_2026", "SW": "D2b_2026"}
RANK = ["SW", "D3b", "D4b", "D2a", "D2b", "D2", "D3a", "D4a"]


def era(year):
    if year < 2008:
        return None
    return "early" if year <= 2011 else "middle" if year <= 2025 else "late"


def runs_of(weeks):
    """``[(date, level)]`` of one unit and source to ``[(level, first day, last day)]``."""
    known = sorted((d, 0 if c < 3 else c) for d, c in weeks if c is not None)
    out = []
    for level, members in groupby(known, key=lambda x: x[1]):
        days = [d for d, _ in members]
        out.append((level, days[0], days[-1] + 6 * ONE))
    return out


def events_of(runs, start, end):
    """Dated tiers of one window: ``[(date, run start, rank, tier)]``."""
    if start is None or end is None:
        return []
    cut = [
        (level, max(a, start), min(b, end)) for level, a, b in runs if a <= end and b >= start
    ]
    found = []

    def day_number(a, k):
        return a + (k - 1) * ONE

    def size(run):
        return (run[2] - run[1]).days + 1

    for tier, need in (("D2", 56), ("D2a", 28), ("D2b", 49)):
        for run in cut:
            if run[0] == 3 and size(run) >= need:
                found.append((day_number(run[1], need), run[1], tier))
                break
    for tier, level in (("D3b", 4), ("D4b", 5)):
        left = 28
        for run in cut:
            if run[0] != level:
                continue
            if size(run) >= left:
                found.append((day_number(run[1], left), run[1], tier))
                break
            left -= size(run)
    for run in cut:
        if run[0] in (4, 5):
            found.append((run[1], run[1], "D3a" if run[0] == 4 else "D4a"))
    for one, dip, two in zip(cut, cut[1:], cut[2:]):
        if (one[0], dip[0], two[0]) == (3, 0, 3) and size(dip) == 7 and size(one) < 49:
            if size(one) + size(two) >= 49:
                found.append((day_number(two[1], 49 - size(one)), two[1], "SW"))
    return sorted((d, s, RANK.index(t), t) for d, s, t in found)


def determine(weeks, windows):
    """``weeks``: {(fips, source): [(date, level)]}; ``windows``: [(fips, office, year, kind, start,
    end)]. Returns a set of result rows."""
    result = set()
    for fips, office, year, kind, start, end in windows:
        for (unit, source), series in weeks.items():
            if unit != fips or era(year) is None:
                continue
            best = 0
            for day, _, _, tier in events_of(runs_of(series), start, end):
                won = POINTS[era(year)].get("D2b" if tier == "SW" else tier, 0)
                if won > best:
                    best = won
                    result.add(
                        (fips, office, source, year, kind, NAMES.get(tier, tier), day, won)
                    )
    return result


def tuesday(i: int, first: date = date(2024, 1, 2)) -> date:
    return first + i * 7 * ONE
