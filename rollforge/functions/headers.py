"""File names and page headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import D, S, clean_lines, group, let, normalize_text, split_lines, strip, to_bigint

FILE_NAME = rf"(?iu)\A(.+?)_page_({D}+)_stacked_ocr.txt$"


def parse_file_name(name: Column) -> Column:
    """struct<doc_id, page_no> of `<doc>_page_<n>_stacked_ocr.txt`, null for another name."""
    doc = group(name, FILE_NAME, 1)
    return F.when(doc.isNotNull(), F.struct(doc.alias("doc_id"), to_bigint(group(name, FILE_NAME, 2)).alias("page_no")))


def _header(text: Column, assembly: str, part: str, street: str) -> Column:
    def of(lines: Column) -> Column:
        known = F.size(lines) >= 2
        one, two = F.get(lines, F.lit(0)), F.get(lines, F.lit(1))
        return F.struct(
            F.when(known, strip(group(one, assembly))).alias("assembly"),
            F.when(known, to_bigint(group(one, part))).alias("part_no"),
            F.when(known, strip(group(two, street))).alias("street"),
        )

    return let(clean_lines(split_lines(F.coalesce(text, F.lit("")))), of)


def parse_header(text: Column, *, relaxed: bool = False) -> Column:
    """struct<assembly, part_no, street> of an English header. relaxed: any characters in the assembly's name, brackets too."""
    name = ".+?" if relaxed else r"[A-Za-z0-9\- ]+?"
    return _header(text, rf"(?iu)Name{S}*:{S}*({name}){S}+Part", rf"(?iu)Part{S}*No\.?{S}*[:\-]?{S}*({D}+)", rf"(?iu)Section{S}+No{S}+and{S}+Name{S}*[:\-]?{S}*(.+)$")


def parse_header_tamil(text: Column) -> Column:
    return _header(normalize_text(F.coalesce(text, F.lit(""))), rf"பெயர்{S}*:{S}*(.+?){S}+பாகம்", rf"பாகம்{S}*எண்\.?{S}*[:\-]?{S}*({D}+)", rf"பிரிவு{S}*எண்.*?பெயர்{S}*[:\-]?{S}*(.+)$")


def parse_any_header(text: Column, tamil: Column) -> Column:
    return F.when(tamil, parse_header_tamil(text)).otherwise(parse_header(text))
