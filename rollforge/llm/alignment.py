"""Edit distance inside a band of diagonals, with a band's row of differences in one integer (Hyyro 2003)."""

from __future__ import annotations


def banded_distance(a: list, b: list, most: int) -> int:
    """The edit distance of a and b if it is at most `most`, else most + 1. Cells off the 2 * most + 1 middle diagonals are never looked at."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return most + 1
    i, n = 0, len(b)
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : n - j]
    if not b:
        return len(a)
    most_wanted, most = most, min(most, len(a))
    m, width = len(a), 2 * most + 1
    top, full = 1 << (width - 1), (1 << width) - 1
    places: dict = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | (1 << k)
    # Bit k of the window stands for a[i + k - most]; cells before a[0] are off the matrix.
    plus, minus = (full >> most) << most, 0
    at = most  # the distance along the band's lowest diagonal, later along the last row
    across = top >> 1
    for i, x in enumerate(b):
        held = places.get(x, 0)
        match = (held >> (i - most) if i >= most else held << (most - i)) & full
        zero = ((((match & plus) + plus) ^ plus) | match | minus) & full
        hplus = (minus | ~(zero | plus)) & full
        hminus = zero & plus
        if i + most < m:
            at += not zero & top
        else:
            at += bool(hplus & across) - bool(hminus & across)
            across >>= 1
        if at > 2 * most + 1 + m:
            break
        down = zero >> 1
        plus = (hminus | ~(down | hplus)) & full
        minus = down & hplus
    return at if at <= most_wanted else most_wanted + 1


def edit_similarity(a: list, b: list, least: float) -> float:
    """1 - distance / length of the longer, if it is at least `least`, else 0. The band widens as long as the distance needs it."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    limit = int((1 - least) * longer + 1e-9)
    band = min(8, limit)
    while True:
        d = banded_distance(a, b, band)
        if d <= band:
            return 1 - d / longer
        if band >= limit:
            return 0.0
        band = min(limit, band * 4)
