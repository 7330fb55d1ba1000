"""Person blocks to fields, in English and Tamil.

Each line of a block is claimed once: it becomes a struct of the field that claims it and the value found (null where the label
stands without a readable value). Fields then take the last value that was found, or, for a Tamil name, the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import D, S, clean_lines, found, group, let, normalize_id, normalize_text, replace_words, split_lines, strip, to_bigint

PERSON = ("epic_id", "name", "father_name", "husband_name", "mother_name", "other_name", "house_no", "age", "gender")
PERSON_SCHEMA = "struct<epic_id:string,name:string,father_name:string,husband_name:string,mother_name:string,other_name:string,house_no:string,age:bigint,gender:string>"
#: Labels.
EN_NAME, TA_NAME = "Name", "பெயர்"
EN_RELATIONS = (("Father", "father_name"), ("Mother", "mother_name"), ("Husband", "husband_name"))
TA_RELATIONS = (("தந்தை", "father_name"), ("தாய்", "mother_name"), ("கணவர்", "husband_name"))
TA_OTHER, TA_AGE, TA_GENDER, TA_MALE, TA_FEMALE = "மற்றவர்", "வயது", "பாலினம்", "ஆண்", "பெண்"

#: The patterns of a line's value, in English, in Tamil and in the older layout of three people side by side.
EN_VALUE = {label: rf"{label}{S}*[:=]{S}*(.+)" for label in ("Name", "Other")} | {label: rf"{label}{S}+Name{S}*[:=]{S}*(.+)" for label, _ in EN_RELATIONS}
EN_HOUSE, EN_AGE, EN_GENDER = rf"House{S}+Number{S}*[:=]{S}*([A-Za-z0-9/().,-]+)", rf"Age{S}*[:+]{S}*({D}+)", rf"(?iu)Gender{S}*[:+]{S}*(Male|Female)"
TA_PLAIN_NAME, TA_OTHER_NAME, TA_HOUSE = rf"{TA_NAME}{S}*(?:[:=])?{S}*(.+)$", rf"{TA_OTHER}{S}*[:=]{S}*(.+)$", rf"வீட்டு{S}*எண்{S}*[:=]{S}*(.+)$"
TA_RELATED = {label: rf"{label}.*?{TA_NAME}{S}*[:=]{S}*(.+)$" for label, _ in TA_RELATIONS}
TA_AGES, TA_GENDERS, TA_ID = rf"{TA_AGE}{S}*[:+]{S}*({D}+)", rf"{TA_GENDER}{S}*[:+]{S}*({TA_MALE}|{TA_FEMALE})", r"\A[A-Z]{2,4}[0-9]{6,8}\z"
ROW_BREAK, ROW_NAME, ROW_HOUSE = rf"\n{S}*\n", rf"Name{S}*[:=]{S}*([^:]+?)(?={S}+Name|$)", rf"House Number{S}*[:=]{S}*([A-Za-z0-9/]+)"
ROW_RELATION = rf"(Father Name|Mother Name|Husband Name|Other){S}*[:=]{S}*([^:]+?)(?={S}+(Father|Mother|Husband|Other){S}+Name|$)"

_CLAIM = "struct<field:string,value:string,more:string>"


def _claim(field: str, value: Column, more: Column | None = None) -> Column:
    return F.struct(F.lit(field).alias("field"), value.alias("value"), (F.lit(None).cast("string") if more is None else more).alias("more"))


def cut_before(text: Column, label: str) -> Column:
    """The text from the first label on, null if it has none."""
    at = F.instr(text, label)
    return F.when(at > 0, F.substring(text, at, F.length(text)))


def lines_en(block: Column) -> Column:
    return clean_lines(split_lines(cut_before(replace_words(block), EN_NAME)))


def lines_ta(block: Column) -> Column:
    return clean_lines(split_lines(cut_before(replace_words(normalize_text(block)), TA_NAME)))


def _only_alnum(line: Column) -> Column:
    return F.regexp_replace(line, "[^A-Za-z0-9]", "")


def claims_en(lines: Column) -> Column:
    """A line belongs to the first label that it begins with (or holds), even if its value can't be read."""

    def claim(x: Column) -> Column:
        out = F.when(x.startswith(EN_NAME), _claim("name", strip(group(x, EN_VALUE[EN_NAME]))))
        for label, field in EN_RELATIONS:
            out = out.when(x.startswith(label), _claim(field, strip(group(x, EN_VALUE[label]))))
        out = out.when(x.startswith("Other"), _claim("other_name", strip(group(x, EN_VALUE["Other"]))))
        out = out.when(F.contains(x, F.lit("House Number")), _claim("house_no", group(x, EN_HOUSE)))
        gender = F.upper(F.substring(group(x, EN_GENDER), 1, 1))
        out = out.when(F.contains(x, F.lit("Age")) & F.contains(x, F.lit("Gender")), _claim("age", group(x, EN_AGE), gender))
        token = _only_alnum(x)
        good = (F.length(token) >= 8) & token.rlike("[0-9]") & ~token.rlike("[a-z]")
        return out.otherwise(_claim("id", F.when(good, token)))

    return F.transform(lines, claim)


def claims_ta(lines: Column) -> Column:
    """A label without a readable value leaves the line to the labels behind it; the first line with a plain name is the name."""
    relations = "|".join([*(r for r, _ in TA_RELATIONS), TA_OTHER])
    plain = F.transform(lines, lambda x: found(x, TA_PLAIN_NAME) & ~found(x, relations))

    def claim(first: Column, x: Column, i: Column) -> Column:
        out = F.when(i + 1 == first, _claim("name", strip(group(x, TA_PLAIN_NAME))))
        for label, field in TA_RELATIONS:
            p = TA_RELATED[label]
            out = out.when(found(x, p), _claim(field, strip(group(x, p))))
        for field, p in (("other_name", TA_OTHER_NAME), ("house_no", TA_HOUSE)):
            out = out.when(found(x, p), _claim(field, strip(group(x, p))))
        said = group(x, TA_GENDERS)
        gender = F.when(said == TA_MALE, "M").when(said == TA_FEMALE, "F")
        out = out.when(F.contains(x, F.lit(TA_AGE)) & F.contains(x, F.lit(TA_GENDER)), _claim("age", group(x, TA_AGES), gender))
        raw = _only_alnum(x)
        token = normalize_id(raw)
        return out.otherwise(_claim("id", F.when((F.length(raw) >= 8) & token.rlike(TA_ID), token)))

    return let(F.array_position(plain, True), lambda first: F.transform(lines, lambda x, i: claim(first, x, i)))


def person(claims: Column, tamil: Column) -> Column:
    """PERSON_SCHEMA of a block's claims; null claims give a person without values."""

    def last(field: str, part: str = "value") -> Column:
        return F.try_element_at(F.transform(F.filter(claims, lambda c: (c["field"] == field) & c[part].isNotNull()), lambda c: c[part]), F.lit(-1))

    ids = F.transform(F.filter(claims, lambda c: (c["field"] == "id") & c["value"].isNotNull()), lambda c: c["value"])
    digits = lambda x: F.when(tamil, F.length(F.regexp_replace(x, "[^0-9]", ""))).otherwise(0)
    best = F.array_max(F.transform(ids, lambda x, i: F.struct(digits(x).alias("digits"), F.length(x).alias("size"), (-i).alias("first"), x.alias("id"))))
    return F.struct(
        best["id"].alias("epic_id"),
        last("name").alias("name"),
        last("father_name").alias("father_name"),
        last("husband_name").alias("husband_name"),
        last("mother_name").alias("mother_name"),
        last("other_name").alias("other_name"),
        last("house_no").alias("house_no"),
        to_bigint(last("age")).alias("age"),
        last("age", "more").alias("gender"),
    )


def parse_blocks(blocks: DataFrame, *, text: str = "block", tamil: Column | None = None) -> DataFrame:
    """blocks with the columns of PERSON in place of text; every row stays. tamil: which rows hold Tamil, by default none."""
    tamil = F.lit(False) if tamil is None else tamil
    rest = [c for c in blocks.columns if c != text]
    held = blocks.select(*rest, tamil.alias("__tamil"), F.when(tamil, lines_ta(F.col(text))).otherwise(lines_en(F.col(text))).alias("__lines"))
    held = held.select(*rest, "__tamil", F.when(F.col("__tamil"), claims_ta(F.col("__lines"))).otherwise(claims_en(F.col("__lines"))).alias("__claims"))
    held = held.select(*rest, person(F.col("__claims"), F.col("__tamil")).alias("__person"))
    return held.select(*rest, *[F.col(f"__person.{f}").alias(f) for f in PERSON])


def parse_table_rows(text: Column) -> Column:
    """The older layout of three people side by side: array<struct> with three people for each row of four lines or more."""
    people = "array<struct<name:string,father_name:string,mother_name:string,husband_name:string,other_name:string,house_no:string,age:bigint,gender:string>>"

    def row(lines: Column) -> Column:
        every = lambda i, p, g=1: F.regexp_extract_all(F.get(lines, F.lit(i)), F.lit("(?d)" + p), F.lit(g))
        names = F.transform(every(0, ROW_NAME), strip)
        labels, values = every(1, ROW_RELATION, 1), F.transform(every(1, ROW_RELATION, 2), strip)
        houses = every(2, ROW_HOUSE)
        ages, genders = every(3, EN_AGE), every(3, EN_GENDER)

        def one(i: Column) -> Column:
            related = lambda label: F.when(F.get(labels, i) == label, F.get(values, i))
            return F.struct(
                F.get(names, i).alias("name"),
                related("Father Name").alias("father_name"),
                related("Mother Name").alias("mother_name"),
                related("Husband Name").alias("husband_name"),
                related("Other").alias("other_name"),
                F.get(houses, i).alias("house_no"),
                to_bigint(F.get(ages, i)).alias("age"),
                F.initcap(F.get(genders, i)).alias("gender"),
            )

        return F.transform(F.sequence(F.lit(0), F.lit(2)), one)

    rows = F.transform(F.split(strip(text), ROW_BREAK), lambda r: clean_lines(split_lines(r)))
    return F.flatten(F.transform(F.filter(rows, lambda lines: F.size(lines) >= 4), row)).cast(people)
