"""Great-circle geometry on a spherical earth, as SQL expressions.

The functions take and return SQL text, so that a long formula is one expression for Spark to
parse instead of many calls from Python.
"""

from __future__ import annotations

import math

from meshroad.config import EARTH_RADIUS_MILES


def num(x: float) -> str:
    """A double literal."""
    return f"{float(x)!r}D"


def haversine_miles(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    s = f"sin((radians({lat2}) - radians({lat1})) / 2D)"
    t = f"sin((radians({lon2}) - radians({lon1})) / 2D)"
    a = f"pow({s}, 2D) + cos(radians({lat1})) * cos(radians({lat2})) * pow({t}, 2D)"
    return f"({num(2.0 * EARTH_RADIUS_MILES)} * asin(least(sqrt({a}), 1D)))"


def unit_xyz(lat: str, lon: str) -> tuple[str, str, str]:
    """Position on the unit sphere."""
    return (
        f"(cos(radians({lat})) * cos(radians({lon})))",
        f"(cos(radians({lat})) * sin(radians({lon})))",
        f"sin(radians({lat}))",
    )


def chord(a: tuple[str, str, str], b: tuple[str, str, str]) -> str:
    """Straight-line distance of two positions on the unit sphere; grows with the arc.

    Written as products: a position that is mentioned twice stays a column of its own in the plan
    instead of being computed anew inside a lambda for each candidate.
    """
    return "sqrt(" + " + ".join(f"({p} - {q}) * ({p} - {q})" for p, q in zip(a, b)) + ")"


def chord_miles(a: tuple[str, str, str], b: tuple[str, str, str]) -> str:
    """Straight-line distance in miles, at most as long as the arc."""
    return f"({num(EARTH_RADIUS_MILES)} * {chord(a, b)})"


def chord_to_miles(c: str) -> str:
    return f"({num(2.0 * EARTH_RADIUS_MILES)} * asin(least({c} / 2D, 1D)))"


def miles_to_chord(miles: float) -> float:
    return 2.0 * math.sin(miles / EARTH_RADIUS_MILES / 2.0)
