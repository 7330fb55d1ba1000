"""Numbering, sources, sinks, viewer, comparison, geometry, providers and the command line."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollforge import cli
from rollforge.functions import geometry
from rollforge.operators import diff, records, viewer
from rollforge.plans.roll import Config, records_of_pdfs, write_pages
from rollforge.sources import ocr, raster, readers, sinks
from rollforge.streaming import landing

PAGES = "source_image string, ocr_text string, doc_id string, assembly string, part_no bigint, street string, page_no bigint"


def page(doc, no, *names, street="s"):
    return (f"{doc}_page_{no:02d}_stacked_ocr.txt", "".join(f"Name : {n}\nVOTER_END\n" for n in names), doc, "a", 1, street, no)


def test_serials_by_numeric_page(spark):
    rows = [page("d", 10, "ten"), page("d", 9, "nine", "also nine"), page("d", 100, "hundred"), page("e", 1, "one"), page("e", 1, "one"), page("f", 1)]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    got = sorted((r.doc_id, r.serial_no, r.name) for r in records.parse_and_number(pages).collect())
    assert got == [("d", 1, "nine"), ("d", 2, "also nine"), ("d", 3, "ten"), ("d", 4, "hundred"), ("e", 1, "one"), ("e", 2, "one")]
    plain = records.assign_serial_numbers(records.parse_pages(pages.where("doc_id = 'd'")))
    assert sorted((r.serial_no, r.name) for r in plain.collect()) == [(1, "nine"), (2, "also nine"), (3, "ten"), (4, "hundred")]


def test_records_equal_blocks_and_nulls(spark):
    rows = [("x.txt", "VOTER_END\njunk\nVOTER_END", None, None, None, None, None), ("y.txt", None, "d", None, None, None, 1)]
    got = records.parse_and_number(spark.createDataFrame(rows, PAGES)).collect()
    assert [(r.doc_id, r.serial_no, r.name) for r in got] == [(None, 1, None)]
    assert records.parse_and_number(spark.createDataFrame([], PAGES)).count() == 0


def test_limits(spark):
    pages = spark.createDataFrame([page("d", i, "a", "b", "c") for i in (1, 2)], PAGES)
    assert records.parse_pages(pages, page_limit=1).count() == 3
    assert records.parse_pages(pages, page_limit=0).count() == 0
    assert records.parse_pages(pages, block_limit=0).count() == 2


def test_strict_headers(spark):
    pages = spark.createDataFrame([("d", 1)], "doc_id string, page_no bigint")
    none = spark.createDataFrame([], "doc_id string, page_no bigint, header_text string")
    assert records.attach_headers(pages, none).first().header_text is None
    with pytest.raises(Exception, match="no header for page 1"):
        records.attach_headers(pages, none, strict=True).collect()


def test_text_folder_to_csv_bytes(spark, tmp_path):
    texts, heads, out = tmp_path / "texts", tmp_path / "heads", tmp_path / "out"
    texts.mkdir()
    heads.mkdir()
    (texts / "d-ENG-1_page_02_stacked_ocr.txt").write_text('Name : B "x"\nVOTER_END')
    (texts / "d-ENG-1_page_01_stacked_ocr.txt").write_text("Name : A\nAge : 7 Gender : Male\nVOTER_END\n")
    (texts / "blank_page_01_stacked_ocr.txt").write_text(" \n")
    (texts / "other.txt").write_text("Name : C\nVOTER_END")
    for n in (1, 2):
        (heads / f"d-ENG-1_page_0{n}_street.txt").write_text("Name : 7-X Part No. 3\nSection No and Name 1-Main, East")
    assert cli.main(["--texts", str(texts), "--headers", str(heads), "--output", str(out), "--delete-old"]) == 0
    want = "serial_no,epic_id,name,father_name,mother_name,husband_name,other_name,age,gender,house_no,street,part_no,assembly\r\n" '1,,A,,,,,7,M,,"1-Main, East",3,7-X\r\n' '2,,"B ""x""",,,,,,,,"1-Main, East",3,7-X\r\n'
    assert (out / "csv" / sinks.CSV_NAME).read_bytes() == want.encode()
    assert '"mother_name":null' in next((out / "json").glob("part-*.json")).read_text()
    back = readers.load_csv_folder(spark, readers.list_files(spark, str(out / "csv")))
    assert viewer.total_rows(back).first().total_rows == 2
    assert {r.field: r.n_missing for r in viewer.missing_cells(back).collect()}["age"] == 1


def test_csv_union(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("z,y\n3,4\n")
    got = readers.load_csv_folder(spark, [str(tmp_path / f) for f in ("a.csv", "b.csv")])
    assert sorted(map(str, (r.asDict() for r in got.collect()))) == ["{'x': '1', 'y': '2', 'z': None}", "{'x': None, 'y': '4', 'z': '3'}"]
    assert readers.load_csv_folder(spark, []).count() == 0


def test_json_pages(spark, tmp_path):
    (tmp_path / "p.json").write_text('[{"source_image": "s", "ocr_text": "t", "doc_id": "d", "page_no": 1, "part_no": null}]')
    assert readers.load_page_json(spark, str(tmp_path / "p.json")).first().page_no == 1


def test_viewer(spark):
    df = spark.createDataFrame([("Ann", 1.0, "a; b"), (None, 2.5, "b;;"), ("bob", None, None)], "name string, age double, rule string")
    assert df.where(viewer.contains_pattern(F.col("name"), "^a")).count() == 1
    assert df.where(viewer.contains_pattern(F.col("name"), "^a", literal=True)).count() == 0
    assert [r.rule for r in viewer.distinct_rules(df, "rule").collect()] == ["a", "b"]
    assert [r.v for r in df.select(viewer.whole_age(F.col("age")).alias("v")).collect()] == [1, 2, None]
    some = spark.createDataFrame([("NaN", float("nan")), ("null", 1.0), ("", None), (None, 2.0)], "t string, x double")
    assert {r.field: r.n_missing for r in viewer.missing_cells(some).collect()} == {"t": 3, "x": 2}


def test_diff(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], "k int, s string, n int")
    b = spark.createDataFrame([(1, "x", 5), (3, "z", 3)], "k int, s string, n int")
    got = sorted((r.k, r.field, r.actual, r.expected) for r in diff.record_diff(a, b, ["k"]).collect())
    assert got == [(1, "n", "1", "5"), (2, "n", "2", None), (2, "s", "y", None), (3, "n", None, "3"), (3, "s", None, "z")]
    assert [(r.field, r.n) for r in diff.mismatch_histogram(diff.record_diff(a, b, ["k"])).collect()] == [("n", 3), ("s", 2)]
    assert [tuple(r) for r in diff.normalize_rows(spark.createDataFrame([(" b ", 1)], "z string, a int")).collect()] == [(1, "b")]
    wide = diff.record_diff(a, b.drop("n").withColumn("m", F.lit("q")), ["k"]).collect()
    assert {(r.k, r.field) for r in wide} == {(1, "n"), (1, "m"), (2, "s"), (2, "n"), (3, "s"), (3, "m")}


def test_geometry(spark):
    boxes = {r.box_no: r for r in geometry.boxes(spark.sql("select 3000L width, 4000L height")).collect()}
    assert len(boxes) == 30
    assert tuple(boxes[1])[3:] == (72, 128, 1024, 502)
    assert tuple(boxes[30])[3:] == (1976, 3497, 2928, 3871)
    w, h = F.lit(952), F.lit(374)
    one = spark.range(1).select(geometry.photo_mask(w, h).alias("m"), geometry.id_region(w, h).alias("i"), geometry.id_paste(w, h).alias("p"), geometry.stack_offsets(F.array(F.lit(5), F.lit(7), F.lit(9))).alias("s")).first()
    assert tuple(one.m) == (700, 77, 952, 374)
    assert tuple(one.i) == (571, 10, 952, 93)
    assert tuple(one.p) == (6, 267, 83)
    assert one.s == [0, 15, 32]
    with pytest.raises(Exception, match="too tall"):
        spark.range(1).select(geometry.marker_place(w, F.lit(40), F.lit(10), F.lit(30))).collect()


def sheet(*names):
    return "\n---\n".join(["Name : 7-X Part No. 3\nSection No and Name 1-Main", *(f"Name : {n}" for n in names)])


def write_pdfs(folder):
    (folder / "d-ENG-1.PDF").write_text("\f".join(["a", "b", sheet("A", "B"), sheet("bad"), sheet("C"), "last"]))
    (folder / "skip.txt").write_text("x")


def test_pdfs_to_records(spark, tmp_path):
    class Broken(ocr.FakeOcr):  # inside, so that it is pickled by value
        def ocr(self, image, lang):
            if b"bad" in image:
                raise ValueError("no text")
            return image.decode()

    write_pdfs(tmp_path)
    good, failed, counts = records_of_pdfs(spark, Config(str(tmp_path), str(tmp_path / "out")), ocr.FakeRasterizer(), Broken())
    assert sorted((r.doc_id, r.page_no, r.serial_no, r.name, r.assembly) for r in good.collect()) == [("d-ENG-1", 1, 1, "A", "7-X"), ("d-ENG-1", 1, 2, "B", "7-X"), ("d-ENG-1", 3, 3, "C", "7-X")]
    assert [(r.page_no, r.error) for r in failed.collect()] == [(2, "ValueError: no text")]
    assert counts == {"pages": 3, "failed_pages": 1, "blank_pages": 0, "pages_without_header": 0}
    assert readers.scan_pdfs(spark, str(tmp_path), limit=0).count() == 0
    assert readers.scan_pdfs(spark, str(tmp_path), limit=1).select("name").collect()[0].name == "d-ENG-1.PDF"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pages_are_read_once(spark, tmp_path):
    """A provider that never gives the same text twice loses no record; the plan holds one rasteriser and one OCR."""

    class Random(ocr.FakeOcr):
        def ocr(self, image, lang):
            import uuid

            return f"Name : {uuid.uuid4().hex}"

    write_pdfs(tmp_path)
    images = ocr.rasterize(readers.scan_pdfs(spark, str(tmp_path)), ocr.FakeRasterizer())
    good, _ = ocr.page_rows(ocr.read_pages(images, Random()))
    direct = records.parse_and_number(readers.page_text(good))
    assert plan_of(direct).count("MapInPandas") == 2
    assert sorted(r.serial_no for r in direct.collect()) == [1, 2, 3, 4]
    by_table, failed, _ = records_of_pdfs(spark, Config(str(tmp_path), str(tmp_path / "out"), keep_images=True), ocr.FakeRasterizer(), Random())
    assert plan_of(by_table).count("MapInPandas") == plan_of(failed).count("MapInPandas") == 0
    window = next(line for line in plan_of(by_table).splitlines() if " Window " in line)
    assert "ocr_text" not in window and "blocks#" not in window.replace("n_blocks#", "")
    assert sorted(map(str, by_table.collect())) == sorted(map(str, by_table.collect()))
    assert sorted(r.serial_no for r in by_table.collect()) == [1, 2, 3, 4]
    assert spark.read.parquet(str(tmp_path / "out/pages")).where("image is not null").count() == 3


def test_position_or_window(spark, tmp_path):
    """A written table of pages gives the same numbers as pages in flight, with pages of the same name, limits and null keys."""
    rows = [page("d", 10, "ten"), page("d", 9, "nine", "also nine"), page("d", 9, "again"), page("e", 1, "one"), (None, "Name : N\nVOTER_END", None, None, None, None, None)]
    pages = spark.createDataFrame(rows, PAGES).coalesce(1).withColumns({"header_text": F.lit("h"), "error": F.lit(None).cast("string")})
    table, counts = write_pages(pages, str(tmp_path / "pages"))
    assert counts["pages"] == 5
    for limit in (None, 1):
        a = {(r.doc_id, r.page_no, r.name): r.serial_no for r in records.parse_and_number(table, block_limit=limit).collect()}
        b = {(r.doc_id, r.page_no, r.name): r.serial_no for r in records.parse_and_number(pages, block_limit=limit).collect()}
        assert set(a) == set(b)
        for doc in ("d", "e", None):
            n = sum(k[0] == doc for k in a)
            assert sorted(v for k, v in a.items() if k[0] == doc) == sorted(v for k, v in b.items() if k[0] == doc) == list(range(1, n + 1))
        assert a["d", 10, "ten"] == b["d", 10, "ten"] == (4 if limit is None else 3)


def test_boxes(spark):
    class Cut(ocr.FakeOcr):
        def boxes(self, image):
            if image == b"torn":
                raise ValueError("no grid")
            return super().boxes(image)

    rows = [("d", 1, "eng", sheet("A", "B").encode()), ("d", 2, "eng", b"torn"), ("d", 3, "eng", b"h\n---\nunreadable x\n---\n \n---\nName : C\nAB-12 3")]
    images = spark.createDataFrame(rows, "doc_id string, page_no bigint, lang string, image binary")
    got = ocr.read_boxes(images, Cut(), ids=True).orderBy("page_no", "box_no").collect()
    assert [(r.page_no, r.box_no, r.ocr_text, r.ocr_id, r.error) for r in got] == [
        (1, 1, "Name : A", "NameA", None),
        (1, 2, "Name : B", "NameB", None),
        (2, None, None, None, "ValueError: no grid"),
        (3, 1, None, None, "ValueError: no text"),
        (3, 3, "Name : C\nAB-12 3", "AB123", None),
    ]
    assert [(r.page_no, r.box_no) for r in ocr.read_boxes(images, Cut(), limit=1).collect()] == [(1, 1)]
    assert ocr.read_boxes(images, Cut(), limit=0).columns == ["doc_id", "page_no", "box_no", "lang", "ocr_text", "error"]


def test_grid_provider(spark):
    """Boxes cut from pixels: each box's shade is its number, the header's area has one of its own."""

    def engine(image, lang, kind):
        shades = ocr.Pgm().decode(image)
        if kind == "header":
            return f"Name : {int(shades[0, 0])}-X Part No. 3\nSection No and Name 1-Main"
        if kind == "id":
            return f"ID {int(shades[-1, -1])}"
        return f"Name : box {int(shades[shades.shape[0] // 3, 50])}"

    pixels = np.full((4000, 3000), 255, np.uint8)
    for i, (x1, y1, x2, y2) in enumerate(raster.box_edges(3000, 4000)):
        pixels[y1:y2, x1:x2] = i + 1
    pixels[: 4000 // 50] = 77
    images = spark.createDataFrame([("d", 1, "eng", bytearray(ocr.Pgm().encode(pixels)))], "doc_id string, page_no bigint, lang string, image binary")
    page = ocr.read_pages(images, ocr.GridOcr(engine, ocr.Pgm())).first()
    assert page.header_text.startswith("Name : 77-X")
    assert page.ocr_text.split("\n")[::2] == [f"Name : box {i}" for i in range(1, 31)]
    boxes = ocr.read_boxes(images, ocr.GridOcr(engine, ocr.Pgm()), ids=True, limit=5).collect()
    assert [(r.box_no, r.ocr_id) for r in sorted(boxes, key=lambda r: r.box_no)] == [(i, "ID255") for i in range(1, 6)]
    assert np.array_equal(ocr.Pgm().decode(ocr.Pgm().encode(pixels[:7, :9])), pixels[:7, :9])
    spaces = np.full((2, 3), 10, np.uint8)  # pixels that look like white space
    assert np.array_equal(ocr.Pgm().decode(ocr.Pgm().encode(spaces)), spaces)


def test_readers_by_name(spark, tmp_path):
    for n in ("b_page_02_stacked_ocr.txt", "a+b c_page_01_stacked_ocr.TXT", "c_page_03_stacked_ocr.txt", "notes.txt"):
        (tmp_path / n).write_text("Name : X\nVOTER_END")
    for n in ("x.jpg", "y.JPG", "z.png", "w.PNG"):
        (tmp_path / n).write_bytes(b"\xff\x00")
    assert sorted(r.name for r in readers.scan_images(spark, str(tmp_path)).collect()) == ["x.jpg", "y.JPG"]
    assert sorted(r.name for r in readers.scan_images(spark, str(tmp_path), suffix="png", limit=1).collect()) == ["w.PNG"]
    assert sorted(r.name for r in readers.scan_page_texts(spark, str(tmp_path)).collect()) == ["a+b c_page_01_stacked_ocr.TXT", "b_page_02_stacked_ocr.txt", "c_page_03_stacked_ocr.txt"]
    assert sorted(r.name for r in readers.scan_page_texts(spark, str(tmp_path), limit=2).collect()) == ["a+b c_page_01_stacked_ocr.TXT", "b_page_02_stacked_ocr.txt"]
    assert "Sort" not in plan_of(readers.scan_files(spark, str(tmp_path), "jpg"))


def test_command_line_as_a_process(tmp_path):
    write_pdfs(tmp_path)
    out = tmp_path / "out"
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    command = [sys.executable, os.path.join(here, "rollforge", "cli.py"), "--regression", str(tmp_path), "--output", str(out), "--max-workers", "2", "--delete-old"]
    command += ["--rasterizer", "rollforge.sources.ocr:FakeRasterizer", "--provider", "rollforge.sources.ocr:FakeOcr"]
    head = "serial_no,epic_id,name,father_name,mother_name,husband_name,other_name,age,gender,house_no,street,part_no,assembly\r\n"
    rows = "".join(f"{i},,{n},,,,,,,,1-Main,3,7-X\r\n" for i, n in enumerate(("A", "B", "bad", "C"), 1))
    (tmp_path / cli.EXPECTED).write_bytes((head + rows).encode())
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--conf spark.ui.enabled=false pyspark-shell"}
    done = subprocess.run(command, capture_output=True, text=True, timeout=300, env=env, cwd="/")
    assert done.returncode == 0, done.stderr[-2000:]
    assert "3 pages" in done.stderr
    assert (out / "csv" / sinks.CSV_NAME).read_bytes() == (head + rows).encode()
    (tmp_path / cli.EXPECTED).write_bytes((head + rows.replace("bad", "good")).encode())
    done = subprocess.run(command, capture_output=True, text=True, timeout=300, env=env, cwd="/")
    assert done.returncode == 1
    assert "row 3, name: 'bad', expected 'good'" in done.stderr


def test_numbered_stream(spark, tmp_path):
    spark.createDataFrame([page("d", 2, "c"), page("d", 1, "a", "b")], PAGES).coalesce(1).write.parquet(str(tmp_path / "in"))
    landing.write_numbered(landing.stream_pages(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert sorted((r.serial_no, r.name) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_stream(spark, tmp_path):
    spark.createDataFrame([page("d", 1, "a", "b")], PAGES).write.parquet(str(tmp_path / "in"))
    landing.write_records(landing.stream_pages(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert sorted(r.name for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_paths():
    assert readers.paths_of(" s3a://a/b.pdf, c ,") == ["s3a://a/b.pdf", "c"]


def test_raster():
    page = np.random.RandomState(1).randint(0, 255, (4000, 3000), np.uint8)
    edges = raster.box_edges(3000, 4000)
    assert (edges[0], edges[-1]) == ((72, 128, 1024, 502), (1976, 3497, 2928, 3871))
    crop = page[128:502, 72:1024]
    masked = raster.mask_photo(crop)
    assert (masked[77:, 700:] == 255).all()
    assert np.array_equal(masked[:77], crop[:77])
    moved = raster.relocate_id(masked)
    assert np.array_equal(moved[267:350, 6:387], masked[10:93, 571:952])
    assert (moved[:94, 571:] == 255).all()
    marker = np.zeros((30, 100), np.uint8)
    boxes = raster.crops(page, marker)
    assert len(boxes) == 30
    assert (boxes[0][374 - 60 - 8 : 374 - 8, 500:700] == 0).all()
    with pytest.raises(ValueError, match="fit"):
        raster.stamp_marker(crop[:50], marker)
    tall = raster.stack([np.zeros((5, 3), np.uint8), np.zeros((4, 7), np.uint8)])
    assert tall.shape == (19, 7)
    assert (tall[:5, 3:] == 255).all()
    assert (tall[5:15] == 255).all()
    assert raster.enlarge(np.full((4, 4, 3), 9, np.uint8), 2.0).shape == (8, 8, 3)
    assert raster.header_area(page).shape == (200, 3000)
