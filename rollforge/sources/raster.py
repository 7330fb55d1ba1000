"""A page's boxes as arrays (height, width[, channels], uint8): cut, masked, with the id moved down and the end marker stamped.

Positions follow `functions.geometry`; these functions draw. A provider decodes images to arrays and back with whatever library it has.
"""

from __future__ import annotations

import numpy as np

from ..functions import geometry as g

WHITE = 255


def box_edges(width: int, height: int) -> list[tuple[int, int, int, int]]:
    """(left, upper, right, lower) of the 30 boxes, by rows."""
    grid = g.margins(width, height, g.Numbers)
    return [g.box_edges(*grid, i // g.COLS, i % g.COLS, g.Numbers) for i in range(g.ROWS * g.COLS)]


def _part(image: np.ndarray, edges: tuple[int, int, int, int]) -> np.ndarray:
    x1, y1, x2, y2 = edges
    return image[y1:y2, x1:x2]


def _size(image: np.ndarray) -> tuple[int, int]:
    return image.shape[1], image.shape[0]


def _fill(image: np.ndarray, x1: int, y1: int, x2: int, y2: int) -> None:
    """White from corner to corner, the far edge included."""
    image[y1 : y2 + 1, x1 : x2 + 1] = WHITE


def _paste(image: np.ndarray, part: np.ndarray, x: int, y: int) -> None:
    h, w = min(len(part), len(image) - y), min(part.shape[1], image.shape[1] - x)
    if h > 0 and w > 0:
        image[y : y + h, x : x + w] = part[:h, :w]


def mask_photo(crop: np.ndarray) -> np.ndarray:
    out = crop.copy()
    _fill(out, *g.photo_edges(*_size(crop), g.Numbers))
    return out


def id_region(crop: np.ndarray) -> np.ndarray:
    return _part(crop, g.id_edges(*_size(crop), g.Numbers))


def id_column(crop: np.ndarray) -> np.ndarray:
    return _part(crop, g.id_column_edges(*_size(crop), g.Numbers))


def relocate_id(crop: np.ndarray) -> np.ndarray:
    """The id's region white, from the crop's upper edge, its content at the lower left, clipped at the edge."""
    out, edges = crop.copy(), g.id_edges(*_size(crop), g.Numbers)
    x, y, _ = g.paste_place(*_size(crop), g.Numbers)
    _fill(out, edges[0], 0, *edges[2:])
    _paste(out, _part(crop, edges).copy(), x, y)
    return out


def enlarge(image: np.ndarray, scale: float) -> np.ndarray:
    """By cubic convolution."""

    def along(x: np.ndarray, n: int) -> np.ndarray:
        at = (np.arange(n) + 0.5) * len(x) / n - 0.5
        base, total = np.floor(at).astype(int), 0.0
        for k in range(-1, 3):
            d = np.abs(at - (base + k))
            w = np.where(d <= 1, 1.5 * d**3 - 2.5 * d**2 + 1, np.where(d < 2, -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2, 0))
            total = total + w.reshape(-1, *[1] * (x.ndim - 1)) * x[np.clip(base + k, 0, len(x) - 1)]
        return total

    tall = along(image.astype(float), int(len(image) * scale))
    wide = along(tall.swapaxes(0, 1), int(image.shape[1] * scale)).swapaxes(0, 1)
    return np.clip(np.round(wide), 0, 255).astype(np.uint8)


def stamp_marker(crop: np.ndarray, marker: np.ndarray, *, scale: float = g.MARKER_SCALE, left: int = g.MARKER_LEFT, bottom: int = g.MARKER_BOTTOM) -> np.ndarray:
    big = enlarge(marker, scale)
    if len(big) + bottom > len(crop):
        raise ValueError(f"marker of {len(big)} px doesn't fit into a crop of {len(crop)} px")
    out = crop.copy()
    _paste(out, big, left, len(crop) - len(big) - bottom)
    return out


def crops(page: np.ndarray, marker: np.ndarray | None = None) -> list[np.ndarray]:
    """The 30 boxes, ready for OCR; with a marker also stamped, for OCR of the whole stack."""
    out = []
    for edges in box_edges(*_size(page)):
        box = relocate_id(mask_photo(_part(page, edges)))
        out.append(box if marker is None else stamp_marker(box, marker))
    return out


def stack(images: list[np.ndarray], *, gap: int = g.STACK_GAP) -> np.ndarray:
    """One below the other on white, widened to the widest."""
    if not images:
        raise ValueError("nothing to stack")
    width = max(i.shape[1] for i in images)
    out = np.full((sum(len(i) for i in images) + gap * (len(images) - 1), width, *images[0].shape[2:]), WHITE, np.uint8)
    y = 0
    for i in images:
        out[y : y + len(i), : i.shape[1]] = i
        y += len(i) + gap
    return out


def header_area(page: np.ndarray) -> np.ndarray:
    return _part(page, g.header_edges(*_size(page), g.Numbers))
