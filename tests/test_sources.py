import io

import pytest

from tallyport.sources import delimited, dumpscan, dumpsource, files, parquet


def scan(text):
    return dumpscan.blocks(io.BytesIO(text.encode() if isinstance(text, str) else text))


def test_blocks_and_statements():
    text = 'x;\nCOPY public.a (id, "odd,""n)") FROM stdin;\n1\t2\n\\.\ny;\ncopy b ( c ) from STDIN\n\\.\nz;\n'
    found = scan(text)
    assert [(b.schema, b.table, b.columns) for b in found] == [("public", "a", ("id", 'odd,"n)')), ("public", "b", ("c",))]
    assert text[found[0].data_start : found[0].data_end] == "1\t2\n"
    assert dumpscan.statements_text(io.BytesIO(text.encode()), found) == "x;\ny;\nz;\n"


@pytest.mark.parametrize(
    ("text", "error"),
    [
        ("COPY a FROM stdin;\n\\.\n", dumpscan.MissingColumnList),
        ("COPY a (b FROM stdin;\n\\.\n", dumpscan.MalformedColumnList),
        ("COPY a () FROM stdin;\n\\.\n", dumpscan.MalformedColumnList),
        ("COPY a (b) FROM stdin;\n1\n", dumpscan.MissingTerminator),
        ("COPY a (b) FROM stdin;\n1\n\\.\r", dumpscan.MissingTerminator),
        (b"PGDMP\x01", dumpscan.NotPlainText),
    ],
)
def test_scan_errors(text, error):
    with pytest.raises(error):
        scan(text)


@pytest.mark.parametrize("end", ["\\.", "\\.\n", "\\.\r\n"])
def test_terminators(end):
    assert len(scan("COPY a (b) FROM stdin;\n1\n" + end)) == 1


def test_find_block():
    found = scan("COPY a (b) FROM stdin;\n\\.\nCOPY a (b) FROM stdin;\n\\.\nCOPY c (b) FROM stdin;\n\\.\n")
    assert dumpscan.find_block(found, "public", "c").table == "c"
    with pytest.raises(dumpscan.Duplicate):
        dumpscan.find_block(found, "public", "a")
    with pytest.raises(dumpscan.NotFound):
        dumpscan.find_block(found, "public", "x")


def test_every_newline_is_a_row_in_some_chunk(spark, tmp_path):
    rows = "".join(f"{i}\tvalue {i}\r\n" if i % 3 else f"{i}\n" if i % 2 else "\n" for i in range(500))
    path = tmp_path / "d.sql"
    path.write_text(f"COPY t (id, v) FROM stdin;\n{rows}\\.\n", newline="")
    with files.parse_uri(str(path)).open() as file:
        block = dumpscan.blocks(file)[0]
    lines = dumpsource.raw_lines(spark, str(path), block.data_start, block.data_end, chunk_bytes=700)
    got = dumpsource.scan(lines, block.columns).collect()
    assert len(got) == rows.count("\n")
    assert len({r.chunk_id for r in got}) > 5
    third = dumpsource.raw_lines(spark, str(path), block.data_start, block.data_end, chunk_bytes=700).where("chunk_id = 2").collect()
    assert {(r.line_no, r.raw) for r in third} == {(r.line_no, r.raw) for r in got if r.chunk_id == 2}
    assert dumpsource.raw_lines(spark, str(path), block.data_start, block.data_start).count() == 0
    assert sum(r.good for r in got) == sum(1 for i in range(500) if i % 3)
    assert {r.v for r in got if r.good and r.id == "7"} == {"value 7"}


def test_chunks_cover_the_range_and_end_after_lines():
    data = b"".join(b"x" * (i % 50) + b"\n" for i in range(2000))
    parts = list(files.chunks(io.BytesIO(data), 0, len(data), 5000))
    assert parts[0].start == 0
    assert parts[-1].end == len(data)
    assert all(a.end == b.start and data[a.end - 1 : a.end] == b"\n" for a, b in zip(parts, parts[1:], strict=False))


def test_estimates_and_row_groups():
    assert files.estimate_rows(b"ab\nab\n", 100) == 33
    assert files.estimate_rows(b"abc", 100) is None
    assert files.estimate_rows(b"", 0) == 0
    assert [(c.start, c.end) for c in files.row_group_chunks([5, 5, 20, 1], 10)] == [(0, 2), (2, 3), (3, 4)]


def test_chunks_within_one_long_line_are_empty():
    data = b"a\n" + b"x" * 100 + b"\nlast"
    parts = list(files.chunks(io.BytesIO(data), 0, len(data), 10))
    assert b"".join(data[c.start : c.end] for c in parts) == data
    assert [data[c.start : c.end] for c in parts if c.start < c.end] == [data[:103], b"last"]
    assert files.rows_in(io.BytesIO(data), 0, len(data)) == len(data) // (len(data) // 2)


def test_parsed_lines_equal_the_csv_scan(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("".join(f'{i},"a, ""{i}"""\r\n' if i % 7 else f"{i},x,y\n\n" if i % 2 else f"{i}\n" for i in range(300)), newline="")
    lines = dumpsource.raw_lines(spark, str(path), 0, path.stat().st_size, chunk_bytes=500)
    got = delimited.parsed(lines, ["id", "v"])
    want = delimited.scan(spark, str(path), delimited.CSV, ["id", "v"])
    assert sorted((r.id, r.v, r.good) for r in got.collect()) == sorted((r.id, r.v, r[delimited.BAD] is None) for r in want.collect())


def test_places(tmp_path):
    place = files.Place.of(tmp_path.as_uri()) / "d" / "x.txt"
    assert place.read_text() is None
    place.write_text("é")
    place.write_text("ü")
    assert (place.read_text(), place.size(), (files.Place.of(str(tmp_path)) / "d").names()) == ("ü", 2, ["x.txt"])
    (files.Place.of(str(tmp_path)) / "d").remove()
    assert (files.Place.of(str(tmp_path)) / "d").names() == []


@pytest.mark.parametrize(("uri", "scheme", "path"), [("/a/b", "file", "/a/b"), ("file:///a", "file", "/a"), ("s3://b/k", "s3", "b/k")])
def test_uri(uri, scheme, path):
    assert files.parse_uri(uri) == files.Source(scheme, path)


@pytest.mark.parametrize("uri", ["", "http://x/y", "s3://b", "s3:///k"])
def test_bad_uri(uri):
    with pytest.raises(ValueError):
        files.parse_uri(uri)


def test_csv_dialects(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,text\n1,"a, ""b"""\n2,\n3,"  "\n4\n5,x,y\n6, keep \r\n', newline="")
    rows = delimited.scan(spark, str(path), delimited.CSV.with_(header=True))
    good, bad = delimited.split_bad(rows)
    assert {r.id: r.text for r in good.collect()} == {"1": 'a, "b"', "2": None, "3": None, "6": " keep "}
    assert len(bad.collect()) == 2
    path.write_text('1\t"a\\"b"\n', newline="")
    escaped = delimited.scan(spark, str(path), delimited.TSV.with_(escape="\\"))
    assert escaped.first()["column_2"] == 'a"b'


def test_csv_multiline(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('1,"two\nlines"\n2,b\n')
    assert delimited.scan(spark, str(path), delimited.CSV.with_(multiline=True), ["id", "v"]).count() == 2


def test_parquet_blanks_and_nested(spark, tmp_path):
    spark.createDataFrame([(1, " "), (2, "x")], "id int, v string").write.parquet(str(tmp_path / "p"))
    assert {r.id: r.v for r in parquet.scan(spark, str(tmp_path / "p")).collect()} == {1: None, 2: "x"}
    spark.createDataFrame([(1, [1])], "id int, v array<int>").write.parquet(str(tmp_path / "n"))
    with pytest.raises(ValueError, match="nested"):
        parquet.scan(spark, str(tmp_path / "n"))
