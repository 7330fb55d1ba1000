"""Literal cases of the text functions, headers, block splitter and parsers."""

import pytest
from pyspark.sql import functions as F

from rollforge.functions import headers, text
from rollforge.operators import blocks, people


def value(spark, column, **given):
    return spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} string" for k in given) or "x string").select(column.alias("v")).first().v if given else spark.range(1).select(column.alias("v")).first().v


def on(spark, build, given):
    return value(spark, build(F.col("t")), t=given)


ALL_BLANKS = "".join(chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def test_strip_is_wide(spark):
    assert on(spark, text.strip, ALL_BLANKS + "a b" + ALL_BLANKS) == "a b"
    assert on(spark, text.strip, "\u200ca\u200c") == "\u200ca\u200c"


@pytest.mark.parametrize("t", ["a\nb", "a\r\nb\r", "\n", "", "a\x0bb\x0cc\x1cd\x1de\x1ef\x85g\u2028h\u2029i", "a\n\nb\n\n"])
def test_split_lines(spark, t):
    assert on(spark, text.split_lines, t) == t.splitlines()


def test_digits_of_any_script(spark):
    assert on(spark, text.to_bigint, "\u0bed\u0bef") == 79
    assert on(spark, text.to_bigint, "9" * 25) is None


@pytest.mark.parametrize(("name", "lang"), [("a-tam-1.jpg", "tam+eng"), ("TAMILX.pdf", "tam+eng"), ("x-ENG-1.pdf", "eng"), ("x.pdf", "eng")])
def test_language(spark, name, lang):
    assert on(spark, text.detect_language, name) == lang


def test_scalars(spark):
    assert on(spark, text.drop_id_lines, "ABC1234567 DEF7654321\nName : X\n\nabc") == "Name : X\n\nabc"
    assert on(spark, text.looks_like_id, "ab-12345") is True
    assert on(spark, text.looks_like_id, "A12345") is False
    assert on(spark, text.normalize_id, "v0I") == "Y01"
    assert on(spark, text.normalize_id, "IOB1") == "10B1"
    assert on(spark, lambda c: text.labelled_values(c, "Father Name"), "Name : A - Father Name : B") == ["B"]
    assert on(spark, lambda c: text.labelled_values(c, "Name"), "Name : A - Father Name : B") == ["A", "B"]
    assert [tuple(x) for x in on(spark, text.column_spans, "Name : A Name : B")] == [(0, 9), (9, None)]
    assert on(spark, text.normalize_text, "a\u200c\u00a0 \t b\r\n\r\n c\rd") == "a b\nc\nd"
    assert on(spark, lambda c: text.drop_lines_containing(c, ["x", "y"]), " a \nbx\n\ny\nc") == " a \n\nc"


@pytest.mark.parametrize(("said", "literal", "right"), [("female", "M", "F"), ("f", "F", "F"), ("ஆண்", "M", "M"), ("x", None, None)])
def test_gender(spark, said, literal, right):
    assert on(spark, text.normalize_gender, said) == right
    assert on(spark, lambda c: text.normalize_gender(c, literal=True), said) == literal


@pytest.mark.parametrize(("name", "want"), [("roll-ENG-7_page_03_stacked_ocr.txt", ("roll-ENG-7", 3)), ("x_page_1_page_02_stacked_ocr.txt", ("x_page_1", 2)), ("x_stacked_ocr.txt", None)])
def test_file_name(spark, name, want):
    got = on(spark, headers.parse_file_name, name)
    assert (got and tuple(got)) == want


@pytest.mark.parametrize(
    ("t", "want"),
    [
        ("No and Name : 116-Alpha Part No. : 7\nSection No and Name 1-Main Street", ("116-Alpha", 7, "1-Main Street")),
        ("No and Name : 116-Alpha (South) Part No. : 7\nSection No and Name 1-Main Street", (None, 7, "1-Main Street")),
        ("No and Name : 116-Alpha Part No. : 7", (None, None, None)),
        ("No and Name :   Part No. : 7\nSection No and Name 1-Main Street", ("", 7, "1-Main Street")),
        (None, (None, None, None)),
    ],
)
def test_header(spark, t, want):
    assert tuple(on(spark, headers.parse_header, t)) == want


def test_header_relaxed_and_tamil(spark):
    t = "No and Name : 116-Alpha (South) Part No. : 7\nSection No and Name 1-Main Street"
    assert on(spark, lambda c: headers.parse_header(c, relaxed=True), t).assembly == "116-Alpha (South)"
    t = "பெயர் : 9-மாதிரி (தெற்கு) பாகம் எண் : 1\nபிரிவு எண் மற்றும் பெயர் 1-சோதனை தெரு"
    assert tuple(on(spark, headers.parse_header_tamil, t)) == ("9-மாதிரி (தெற்கு)", 1, "1-சோதனை தெரு")


@pytest.mark.parametrize(
    ("t", "want"),
    [
        ("x\nName : A \r\nVOTER_END\n\nVOTER_END\nName : B\nABC1234567 VOTER_END\ntrailing", ["x\nName : A", "Name : B\nABC1234567"]),
        ("A VOTER_END B VOTER_END", ["A  B"]),
        ("no marker", []),
        ("", []),
        (None, []),
    ],
)
def test_split_blocks(spark, t, want):
    assert on(spark, blocks.split_blocks, t) == want


EN = [
    ("junk\nName : Asha K\nFather Name : Ravi P\nHouse Number : 12/3-A Photo\nAge : 41 Gender : Female\nABC1234567", dict(name="Asha K", father_name="Ravi P", house_no="12/3-A", age=41, gender="F", epic_id="ABC1234567")),
    ("Narne = Asha\nAge + 30 Gander + Famale", dict(name="Asha", age=30, gender="F")),
    ("Father Name : Ravi\nAge : 20 Gender : Male", dict(name="Ravi", age=20, gender="M")),
    ("Name : A\nName : B\nName C", dict(name="B")),
    ("Name : A\nABC12345\nXYZ12345\nabc123456789", dict(name="A", epic_id="ABC12345")),
    ("Name : A\n4000000001 |", dict(name="A", epic_id="4000000001")),
    ("ABC1234567\nName : A", dict(name="A")),
    ("Name : A\nMother : X", dict(name="A")),
    ("Name : A\nHouse Number : 5 Age : 30 Gender : Male", dict(name="A", house_no="5")),
    ("Name : A\nOther : G", dict(name="A", other_name="G")),
    ("Name : A\nOther Name : G", dict(name="A")),
    ("Name :\nAge : 9 Gender : Male", dict(age=9, gender="M")),
    ("Age : 9 Gender : Male", {}),
    ("", {}),
    (None, {}),
]
TA = [
    ("பெயர் : மாதிரி\nதந்தையின் பெயர் : சோதனை\nவீட்டு எண் : 12/4 B\nவயது : 41 பாலினம் : பெண்\nvdz1O5O7O5", dict(name="மாதிரி", father_name="சோதனை", house_no="12/4 B", age=41, gender="F", epic_id="YDZ1050705")),
    ("பெயர் :\nவயது : 20 பாலினம் : ஆண்", dict(name=":", age=20, gender="M")),
    ("பெயர் : அ\nபெயர் : ஆ", dict(name="அ")),
    ("பெயர் : அ\n4000000001", dict(name="அ")),
    ("பெயர் : அ\nIOB1234567", dict(name="அ")),
    ("பெயர் : அ\nABCD123456\nAB12345678", dict(name="அ", epic_id="AB12345678")),
    ("பெயர்\u200c : அ\nவயது : \u0bed\u0bef பாலினம் : ஆண்", dict(name="அ", age=79, gender="M")),
    (None, {}),
]


@pytest.mark.parametrize("tamil", [False, True])
def test_people(spark, tamil):
    cases = TA if tamil else EN
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, block string")
    got = {r.i: r for r in people.parse_blocks(df, tamil=F.lit(tamil)).collect()}
    assert len(got) == len(cases)
    for i, (t, want) in enumerate(cases):
        assert {k: v for k, v in got[i].asDict().items() if k != "i" and v is not None} == want, t


def test_table_rows(spark):
    t = "Name : A Name : B\nFather Name : C Husband Name : D\nHouse Number : 1 House Number : 2/A\nAge : 30 Gender : male Age : 40 Gender : FEMALE"
    a, b, c = on(spark, people.parse_table_rows, t)
    assert (a.name, a.father_name, a.house_no, a.age, a.gender) == ("A", "C", "1", 30, "Male")
    assert (b.name, b.husband_name, b.house_no, b.age, b.gender) == ("B", "D", "2/A", 40, "Female")
    assert not any(c)
    assert on(spark, people.parse_table_rows, "a\nb\nc") == []
    shifted = on(spark, people.parse_table_rows, "Name : A\nFather Name : A Other : B\nHouse Number : 1\nAge : 1")[0]
    assert (shifted.father_name, shifted.other_name) == (None, "B")
