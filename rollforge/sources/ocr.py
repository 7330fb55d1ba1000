"""Rasterising and OCR behind providers: the only place where Python runs for each batch.

A provider is pickled to the executors. FakeRasterizer and FakeOcr serve tests; real ones wrap whatever library a
cluster has (the Tamil model is the provider's to bring).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_lines, detect_language, split_lines, strip
from ..operators.blocks import MARKER
from ..operators.records import N_BLOCKS, POSITION
from ..shipping import ship
from . import raster

DPI = 450
#: Front matter to skip, by language; the last page is dropped too.
FIRST_PAGE = {"eng": 3, "tam+eng": 4}


class PageRasterizer(Protocol):
    def page_count(self, content: bytes) -> int: ...

    def page(self, content: bytes, number: int, dpi: int) -> bytes: ...


class OcrProvider(Protocol):
    def boxes(self, image: bytes) -> list[bytes]:
        """The page's crops, masked, with ids relocated, by rows."""
        ...

    def header(self, image: bytes, lang: str) -> str: ...

    def ocr(self, image: bytes, lang: str) -> str: ...

    def id(self, image: bytes) -> str:
        """The id on a box: one line of capital letters and digits."""
        ...


class Codec(Protocol):
    """Images of whatever format as arrays (height, width[, channels], uint8), and back."""

    def decode(self, image: bytes) -> np.ndarray: ...

    def encode(self, pixels: np.ndarray) -> bytes: ...


class Pgm:
    """Binary grey images (P5, without comments): the plainest format, for tests and tools that read it."""

    def decode(self, image: bytes) -> np.ndarray:
        kind, width, height, top, rest = image.split(maxsplit=3)[0], *image.split(maxsplit=3)[1:3], *image.split(maxsplit=3)[3].split(b"\n", 1)
        if kind != b"P5" or int(top) != 255:
            raise ValueError("not a binary grey image of 8 bits")
        return np.frombuffer(rest, np.uint8, int(width) * int(height)).reshape(int(height), int(width))

    def encode(self, pixels: np.ndarray) -> bytes:
        return b"P5\n%d %d\n255\n" % (pixels.shape[1], pixels.shape[0]) + np.ascontiguousarray(pixels).tobytes()


class GridOcr:
    """Cuts pages by the fixed grid - boxes masked, with the id moved down, the header's area, the id's column - and hands the parts to an engine.

    engine(image, lang, kind) reads text; kind is `block`, `header` or `id` (an engine may set its page mode and letters by it)."""

    def __init__(self, engine, codec: Codec):
        self.engine, self.codec = engine, codec

    def boxes(self, image: bytes) -> list[bytes]:
        return [self.codec.encode(box) for box in raster.crops(self.codec.decode(image))]

    def header(self, image: bytes, lang: str) -> str:
        return self.engine(self.codec.encode(raster.header_area(self.codec.decode(image))), lang, "header")

    def ocr(self, image: bytes, lang: str) -> str:
        return self.engine(image, lang, "block")

    def id(self, image: bytes) -> str:
        return self.engine(self.codec.encode(raster.id_column(self.codec.decode(image))), "eng", "id")


class FakeRasterizer:
    """Documents are texts whose pages are separated by form feeds."""

    def page_count(self, content: bytes) -> int:
        return len(content.split(b"\f"))

    def page(self, content: bytes, number: int, dpi: int) -> bytes:
        return content.split(b"\f")[number - 1]


class FakeOcr:
    """Pages are texts: a header, then blocks, separated by lines of `---`."""

    def boxes(self, image: bytes) -> list[bytes]:
        return image.split(b"\n---\n")[1:]

    def header(self, image: bytes, lang: str) -> str:
        return image.split(b"\n---\n")[0].decode()

    def ocr(self, image: bytes, lang: str) -> str:
        if image.startswith(b"unreadable"):
            raise ValueError("no text")
        return image.decode()

    def id(self, image: bytes) -> str:
        return image.decode().splitlines()[-1]


def rasterize(pdfs: DataFrame, rasterizer: PageRasterizer, *, dpi: int = DPI) -> DataFrame:
    """doc_id, page_no (from 1 behind the front matter), lang, image of pdfs (name, content). A document that can't be read fails the query."""
    held = pdfs.select(F.regexp_replace("name", r"\.[^.]*$", "").alias("doc_id"), detect_language(F.col("name")).alias("lang"), "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, lang, content in batch.itertuples(index=False):
                for no, page in enumerate(range(FIRST_PAGE[lang], rasterizer.page_count(content)), 1):
                    yield pd.DataFrame({"doc_id": [doc_id], "page_no": [no], "lang": [lang], "image": [rasterizer.page(content, page, dpi)]})

    ship(pdfs.sparkSession)
    return held.mapInPandas(run, "doc_id string, page_no bigint, lang string, image binary")


def read_pages(images: DataFrame, provider: OcrProvider, *, keep_images: bool = False) -> DataFrame:
    """doc_id, page_no, lang, header_text, ocr_text, error (and image, if kept) of page images. Each box is read by itself and ends with the marker; a page that fails has its error and no text."""
    names = ["doc_id", "page_no", "lang", "header_text", "ocr_text", "error", *(["image"] if keep_images else [])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, page_no, lang, image in batch[["doc_id", "page_no", "lang", "image"]].itertuples(index=False):
                try:
                    boxes = [provider.ocr(b, lang) for b in provider.boxes(image)]
                    rows.append((doc_id, page_no, lang, provider.header(image, lang), "\n".join(f"{b}\n{MARKER}" for b in boxes), None, image)[: len(names)])
                except Exception as e:  # a page that fails is reported, and the others go on
                    rows.append((doc_id, page_no, lang, None, None, f"{type(e).__name__}: {e}", image)[: len(names)])
            yield pd.DataFrame(rows, columns=names)

    ship(images.sparkSession)
    read = images.mapInPandas(run, "doc_id string, page_no bigint, lang string, header_text string, ocr_text string, error string" + ", image binary" * keep_images)
    return read.withColumns({"header_text": strip(F.col("header_text")), "ocr_text": F.array_join(clean_lines(split_lines(F.col("ocr_text"))), "\n")})


def cut_boxes(images: DataFrame, provider: OcrProvider) -> DataFrame:
    """doc_id, page_no, box_no (from 1), lang, box, error of page images. A page that can't be cut is one row without box, with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, page_no, lang, image in batch[["doc_id", "page_no", "lang", "image"]].itertuples(index=False):
                try:
                    rows = [(doc_id, page_no, no, lang, box, None) for no, box in enumerate(provider.boxes(image), 1)]
                except Exception as e:  # a page that fails is reported, and the others go on
                    rows = [(doc_id, page_no, None, lang, None, f"{type(e).__name__}: {e}")]
                out = pd.DataFrame(rows, columns=["doc_id", "page_no", "box_no", "lang", "box", "error"])
                yield out.astype({"box_no": "Int64"})

    ship(images.sparkSession)
    return images.mapInPandas(run, "doc_id string, page_no bigint, box_no bigint, lang string, box binary, error string")


def read_boxes(images: DataFrame, provider: OcrProvider, *, limit: int | None = None, ids: bool = False) -> DataFrame:
    """doc_id, page_no, box_no (from 1), lang, ocr_text, error of each box of page images; boxes without text are left out, failed boxes and pages stay with their error.

    limit: so many boxes, by document, page and number, before any is read; 0 or None: all. ids: also ocr_id, the letters and digits that id OCR reads on the box."""
    boxes = cut_boxes(images, provider)
    if limit:
        boxes = boxes.orderBy("doc_id", "page_no", "box_no").limit(limit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, found, errors = [], [], []
            for lang, box, error in batch[["lang", "box", "error"]].itertuples(index=False):
                text = own = None
                if error is None:
                    try:
                        text, own = provider.ocr(box, lang), provider.id(box) if ids else None
                    except Exception as e:  # a box that fails is reported, and the others go on
                        text, own, error = None, None, f"{type(e).__name__}: {e}"
                texts.append(text)
                found.append(own)
                errors.append(error)
            yield batch[["doc_id", "page_no", "box_no", "lang"]].assign(ocr_text=texts, ocr_id=found, error=errors)

    read = boxes.mapInPandas(run, "doc_id string, page_no bigint, box_no bigint, lang string, ocr_text string, ocr_id string, error string")
    read = read.withColumns({"ocr_text": F.array_join(clean_lines(split_lines(F.col("ocr_text"))), "\n"), "ocr_id": clean_id(F.col("ocr_id"))})
    kept = ["doc_id", "page_no", "box_no", "lang", "ocr_text", *(["ocr_id"] if ids else []), "error"]
    return read.where("error is not null or ocr_text <> ''").select(*kept)


def page_name(doc_id="doc_id", page_no="page_no") -> F.Column:
    """The name that the text scan would find for a page."""
    return F.concat(doc_id, F.lit("_page_"), F.lpad(F.col(page_no).cast("string"), F.greatest(F.lit(2), F.length(F.col(page_no).cast("string"))), F.lit("0")), F.lit("_stacked_ocr.txt"))


def page_rows(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts with the names that the text scan gives, failed pages) of a table of read pages."""
    good = read.where("error is null and ocr_text is not null and ocr_text <> ''")
    good = good.select(page_name().alias("name"), "ocr_text", "doc_id", "page_no", "header_text", *[c for c in (POSITION, N_BLOCKS) if c in read.columns])
    return good, read.where("error is not null").select("doc_id", "page_no", "error")


def clean_id(text) -> F.Column:
    """What id OCR keeps: letters and digits."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}]", "")
