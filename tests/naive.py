"""The event rules once more, as loops over one trace at a time.

A trace is a list of (time in microseconds, lat, lon, raw id or None), sorted.
"""

from __future__ import annotations

from math import asin, cos, floor, log, radians, sin, sqrt

EDGES = (50, 100, 150, 250, 400, 650, 1050)


def metres(lon1, lat1, lon2, lat2):
    lon1, lat1, lon2, lat2 = map(radians, (lon1, lat1, lon2, lat2))
    a = sin((lat2 - lat1) / 2) ** 2 + cos(lat1) * cos(lat2) * sin((lon2 - lon1) / 2) ** 2
    return 2 * asin(sqrt(min(1.0, a))) * 6371 * 1000


def reach_rows(trace, place):
    if len(trace) < 3:
        return []
    rows, run, in_run, before = [], 0, 0, None
    for i, (t, lat, lon, _) in enumerate(trace):
        distance = round(metres(lon, lat, *place))
        bin_ = sum(distance >= edge for edge in EDGES)
        if bin_ != before:
            run, in_run = run + 1, 0
        tbe = floor((trace[i + 1][0] - t) / 1e6) % 86400 if i + 1 < len(trace) else 0
        in_run += tbe
        rows.append({"t": t, "lat": lat, "lon": lon, "bin": bin_, "tbe": tbe, "in_bin": in_run, "run": run, "prev": before})
        before = bin_
    return rows


def first_reach(trace, place):
    hits = [r for r in reach_rows(trace, place) if r["bin"] * -0.815 + log(r["in_bin"] + 1) * 0.407 - 0.414 >= 0]
    first = min((r["t"] for r in hits), default=None)
    return sorted((r["t"], r["lat"], r["lon"]) for r in hits if r["t"] == first)


def movement_rows(trace, place):
    if len(trace) < 3:
        return []
    rows = []
    for i, (t, lat, lon, raw) in enumerate(trace):
        row = {"t": t, "lat": lat, "lon": lon, "raw": raw, "dist": metres(lon, lat, *place), "to": None, "along": None}
        if i:
            seconds = (t - trace[i - 1][0]) / 1e6
            if seconds:
                row["to"] = (row["dist"] - rows[-1]["dist"]) / seconds
                row["along"] = metres(lon, lat, trace[i - 1][2], trace[i - 1][1]) / seconds
        rows.append(row)
    for i, row in enumerate(rows):
        near = rows[i - 1 : i + 2] if 0 < i < len(rows) - 1 else []
        for speed in ("to", "along"):
            values = [r[speed] for r in near]
            row[f"s_{speed}"] = sum(values) / 3 if near and None not in values else None
        row["log"] = log(row["dist"]) if row["dist"] > 0 else None
        row["leaves"] = (
            None not in (row["s_to"], row["s_along"], row["log"])
            and -5.234 + 0.557 * row["s_to"] + 0.047 * row["s_along"] + 1.165 * row["log"] >= 0
        )
    return rows


def first_depart(trace, place, onway):
    rows = [
        r for r in movement_rows(trace, place) if None not in (r["raw"], r["s_to"], r["s_along"], r["log"], r["to"])
    ]
    answers = []
    for before, row in zip(rows, rows[1:], strict=False):
        fits = onway is None or (row["t"] > onway and before["t"] > onway)
        if row["leaves"] and before["dist"] < 150 and fits:
            answers.append((before["t"], before["lat"], before["lon"]))
    return min(answers, default=None)


def first_client_departure(trace, place, reach, deliver):
    rows = movement_rows(trace, place)
    for row in rows:
        row["rank"] = 1 + sum(r["t"] < row["t"] for r in rows)
    signs = [
        row
        for before, row in zip(rows, rows[1:], strict=False)
        if row["leaves"]
        and row["t"] >= reach
        and before["dist"] < 150
        and (row["t"] - reach > 90e6 or row["t"] >= deliver)
    ]
    if not signs:
        return None
    rank = min(signs, key=lambda r: r["t"])["rank"]
    wanted = rank - 1 if rank > 1 else rank
    answers = [r for r in rows if r["t"] >= reach and r["rank"] in (wanted, wanted + 1)]
    best = min(answers, key=lambda r: (r["rank"], r["lat"], r["lon"]))
    return best["t"], best["lat"], best["lon"]
