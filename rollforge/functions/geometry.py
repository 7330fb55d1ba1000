"""Rectangles on a page as column expressions. A position is the whole part of an exact product, so ratios are doubles as given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Margins, grid, photo and id regions, marker and paddings.
TOP_MARGIN = BOTTOM_MARGIN = 0.032
LEFT_MARGIN = RIGHT_MARGIN = 0.024
ROWS, COLS = 10, 3
PHOTO_WIDTH, PHOTO_TOP, PHOTO_PAD = 380 / 1555, (620 - 480) / 620, 0.02
ID_LEFT, ID_BOTTOM, ID_TOP_PX = 0.60, 0.25, 10
EMPTY_BOTTOM, PASTE_PAD = 0.30, 6
MARKER_SCALE, MARKER_LEFT, MARKER_BOTTOM = 2.0, 500, 8
STACK_GAP, HEADER_HEIGHT = 10, 0.05


def whole(c: Column) -> Column:
    """The whole part, as truncation gives it."""
    return F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)).cast("bigint")


class Numbers:
    """What the positions are made of, on plain numbers; Columns is the same on columns."""

    whole, least, greatest = staticmethod(int), staticmethod(min), staticmethod(max)


class Columns:
    whole = staticmethod(whole)

    @staticmethod
    def least(*xs):
        return F.least(*[F.lit(x) for x in xs])

    @staticmethod
    def greatest(*xs):
        return F.greatest(*[F.lit(x) for x in xs])


def margins(w, h, o):
    """Left and upper edge of the grid, width and height of a box, not rounded."""
    left, top = o.whole(w * LEFT_MARGIN), o.whole(h * TOP_MARGIN)
    return left, top, (w - left - o.whole(w * RIGHT_MARGIN)) / float(COLS), (h - top - o.whole(h * BOTTOM_MARGIN)) / float(ROWS)


def box_edges(left, top, box_w, box_h, row, col, o):
    x, y = o.whole(left + col * box_w), o.whole(top + row * box_h)
    return x, y, o.whole(x + box_w), o.whole(y + box_h)


def photo_edges(w, h, o):
    pad_x, pad_y = o.whole(w * PHOTO_PAD), o.whole(h * PHOTO_PAD)
    return o.greatest(0, o.whole(w * (1 - PHOTO_WIDTH)) - pad_x), o.greatest(0, o.whole(h * PHOTO_TOP) - pad_y), o.least(w, w + pad_x), o.least(h, h + pad_y)


def id_edges(w, h, o):
    return o.whole(w * ID_LEFT), ID_TOP_PX, w, o.whole(h * ID_BOTTOM)


def id_column_edges(w, h, o):
    """What id OCR reads: the right part at its full height."""
    return o.whole(w * ID_LEFT), 0, w, h


def paste_place(w, h, o):
    """Where the id region goes, with what is visible of its height."""
    y = o.whole(h * (1 - EMPTY_BOTTOM)) + PASTE_PAD
    return PASTE_PAD, y, o.least(o.whole(h * ID_BOTTOM) - ID_TOP_PX, h - y)


def header_edges(w, h, o):
    return 0, 0, w, o.whole(h * HEADER_HEIGHT)


def _rectangle(edges) -> Column:
    return F.struct(*[F.lit(v).cast("bigint").alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), edges)])


def boxes(pages: DataFrame, width: str = "width", height: str = "height") -> DataFrame:
    """pages with a row for each of the 30 boxes: box_no (from 1, by rows), x1, y1, x2, y2."""
    grid = [c.alias(n) for n, c in zip(("__l", "__t", "__w", "__h"), margins(F.col(width), F.col(height), Columns))]
    rows = pages.select("*", *grid, F.explode(F.sequence(F.lit(0), F.lit(ROWS * COLS - 1))).alias("__i"))
    row, col = F.floor(F.col("__i") / COLS), F.col("__i") % COLS
    edges = box_edges(F.col("__l"), F.col("__t"), F.col("__w"), F.col("__h"), row, col, Columns)
    return rows.select(*pages.columns, (F.col("__i") + 1).cast("bigint").alias("box_no"), *[c.alias(n) for n, c in zip(("x1", "y1", "x2", "y2"), edges)])


def photo_mask(w: Column, h: Column) -> Column:
    return _rectangle(photo_edges(w, h, Columns))


def id_region(w: Column, h: Column) -> Column:
    return _rectangle(id_edges(w, h, Columns))


def id_column(w: Column, h: Column) -> Column:
    return _rectangle(id_column_edges(w, h, Columns))


def id_paste(w: Column, h: Column) -> Column:
    """Where the id region goes, with what is visible of its height."""
    return F.struct(*[F.lit(v).cast("bigint").alias(n) for n, v in zip(("x", "y", "visible"), paste_place(w, h, Columns))])


def marker_place(w: Column, h: Column, marker_w: Column, marker_h: Column, *, left: int = MARKER_LEFT) -> Column:
    """Place and size of the scaled marker; an error if it is taller than the crop."""
    tall = whole(marker_h * MARKER_SCALE)
    fits = tall + MARKER_BOTTOM <= h
    y = F.when(fits, h - tall - MARKER_BOTTOM).otherwise(F.raise_error(F.lit("marker too tall for the crop")).cast("bigint"))
    return F.struct(F.lit(left).cast("bigint").alias("x"), y.alias("y"), whole(marker_w * MARKER_SCALE).alias("width"), tall.alias("height"))


def header_area(w: Column, h: Column) -> Column:
    return _rectangle(header_edges(w, h, Columns))


def stack_offsets(heights: Column) -> Column:
    """The top of each image in a vertical stack."""
    return F.transform(heights, lambda _, i: (F.aggregate(F.slice(heights, F.lit(1), i), F.lit(0).cast("bigint"), lambda a, x: a + x) + i * STACK_GAP).cast("bigint"))
