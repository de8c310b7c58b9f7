import csv as stdlib_csv
import datetime
import random
from decimal import Decimal

import pytest

from layouts import layout

from lodestrata.sources import records
from lodestrata.sources.csv import csv_rejects, escaped_glob, tolerant_csv

SCHEMA = layout("id int; name string; amount decimal(18,2); day date; note string")


@pytest.fixture
def write(tmp_path):
    def _write(body, name="f.csv"):
        path = tmp_path / name
        path.write_bytes(b"h1,h2,h3,h4,h5\n" + body)
        return escaped_glob(str(path))

    return _write


def load(spark, path, schema=SCHEMA, **options):
    df = tolerant_csv(spark, [path], schema, **options).drop("source_id")
    return [tuple(r)[:-1] for r in df.collect()]


def test_plain_row_is_typed(spark, write):
    assert load(spark, write(b"1,a,2.50,2024-02-29,n\n")) == [
        (1, "a", Decimal("2.50"), datetime.date(2024, 2, 29), "n")
    ]


def test_columns_bind_by_position_and_header_is_skipped(spark, write):
    assert load(spark, write(b"7,x,0,2024-01-01,y\n"))[0][:2] == (7, "x")


def test_short_row_is_filled_with_null_but_empty_text_stays_empty(spark, write):
    assert load(spark, write(b"1,\n2,,3,2024-01-01,\n3\n")) == [
        (1, "", None, None, None),
        (2, "", Decimal("3.00"), datetime.date(2024, 1, 1), ""),
        (3, None, None, None, None),
    ]


def test_empty_text_as_null_on_request(spark, write):
    assert load(spark, write(b'2,"",3,2024-01-01,\n'), empty_as_null=True)[0][1::3] == (None, None)


def test_quoted_delimiter_and_doubled_quote(spark, write):
    assert load(spark, write(b'1,"a,b ""c""",1,2024-01-01,"x"\n'))[0][1] == 'a,b "c"'


def test_short_row_with_quoted_delimiter(spark, write):
    assert load(spark, write(b'1,"a,b,c,d,e,f,g"\n'))[0] == (1, "a,b,c,d,e,f,g", None, None, None)


def test_quoted_line_break_with_multi_line(spark, write):
    assert load(spark, write(b'1,"a\nb",1,2024-01-01,x\n'), multi_line=True)[0][1] == "a\nb"


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        (b"\xff\xfex", "??x"),
        ("中é".encode(), "中é"),
        (b"\xe4\xb8x", "??x"),
        (b"a\xc3\xa9\xe9", "aé?"),
        (b"\xed\xa0\x80", "???"),
        ("\U0001f600".encode() + b"\x80", "\U0001f600?"),
        ("�".encode(), "�"),
    ],
)
def test_each_invalid_byte_becomes_a_question_mark(spark, write, raw, expected):
    assert load(spark, write(b"1," + raw + b",1,2024-01-01,x\n"))[0][1] == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("x" * 300, "x" * 256), ("é" * 200, "é" * 128), ("a" + "é" * 200, "a" + "é" * 127), ("中" * 100, "中" * 85)],
)
def test_long_text_is_cut_by_bytes_at_a_character(spark, write, text, expected):
    assert load(spark, write(f"1,{text},1,2024-01-01,x\n".encode()), text_bytes={"name": 256})[0][1] == expected


def test_text_without_a_declared_length_is_not_cut(spark, write):
    text = "é" * 300
    assert load(spark, write(f"1,{text},1,2024-01-01,{text}\n".encode()), text_bytes={"note": 256})[0][1::3] == (text, "é" * 128)
    assert load(spark, write(f"1,{text},1,2024-01-01,{text}\n".encode()))[0][1::3] == (text, text)


def test_very_long_text_with_stray_bytes(spark, write):
    raw = ("é" * 20_000).encode() + b"\xff"
    value = load(spark, write(b"1," + raw + b",1,2024-01-01,x\n"), text_bytes={"name": 65535})[0][1]
    assert value == "é" * 20_000 + "?"


@pytest.mark.parametrize(
    ("text", "expected"),
    [("1.999", "1.99"), ("-1.999", "-1.99"), (".5", "0.50"), ("12.", "12.00"), ("1.5E2", "150.00"), (" 3.1 ", "3.10")],
)
def test_decimal_surplus_digits_are_cut(spark, write, text, expected):
    assert load(spark, write(f"1,a,{text},2024-01-01,x\n".encode()))[0][2] == Decimal(expected)


@pytest.mark.parametrize(("text", "expected"), [("12.9", 12), (".9", 0), ("-12.9", -12), ("7", 7)])
def test_scale_zero_cuts_the_fraction(spark, write, text, expected):
    schema = layout("id int; name string; amount decimal(18,0); day date; note string")
    assert load(spark, write(f"1,a,{text},2024-01-01,x\n".encode()), schema)[0][2] == expected


@pytest.mark.parametrize(
    ("line", "reason"),
    [
        (b"x,a,1,2024-01-01,n", "unreadable value in id"),
        (b"80.5,a,1,2024-01-01,n", "unreadable value in id"),
        (b"1,a,abc,2024-01-01,n", "unreadable value in amount"),
        (b"1,a,12345678901234567890,2024-01-01,n", "unreadable value in amount"),
        (b"1,a,1,01/02/2024,n", "unreadable value in day"),
        (b"1,a,1,2024-01-01,n,extra", "extra columns"),
        (b"1,a,1,2024-01-01,n,", "extra columns"),
        (b"1,a,1,2024-01-01,,extra", "extra columns"),
    ],
)
def test_anything_else_stops_the_load(spark, write, line, reason):
    with pytest.raises(Exception, match=reason):
        load(spark, write(b"1,a,1,2024-01-01,n\n" + line + b"\n"))


def test_smallint_overflow_stops_the_load(spark, write):
    with pytest.raises(Exception, match="unreadable value in id"):
        load(spark, write(b"40000\n"), layout("id smallint; name string"))


def test_rejects_are_counted_per_file_and_column(spark, write):
    path = write(b"x,a,1,2024-01-01,n\ny,a,?,2024-01-01,n\n1,a,1,2024-01-01,n,more\n2\n", "bad one.csv")
    found = {(r["source_file"], r["column"]): r["rejected"] for r in csv_rejects(spark, [path], SCHEMA).collect()}
    assert found == {
        ("bad one.csv", "id"): 2,
        ("bad one.csv", "amount"): 1,
        ("bad one.csv", "(surplus fields)"): 1,
    }


@pytest.mark.parametrize("name", ["plain.csv", "with space.csv", "a+b%20.csv", "set[1]{x}*.csv", "ünï.csv"])
def test_file_name_comes_back_as_it_is(spark, write, name):
    df = tolerant_csv(spark, [write(b"1,a\n", name)], SCHEMA)
    assert [r["source_file"] for r in df.collect()] == [name]


def test_pruned_columns_do_not_hide_the_width(spark, write):
    df = tolerant_csv(spark, [write(b"1,\n2,,3,2024-01-01,\n")], SCHEMA)
    assert [r["note"] for r in df.select("note").collect()] == [None, ""]


def test_halves_of_a_torn_row_stop_the_load(spark, tmp_path):
    (tmp_path / "torn.csv").write_bytes(b'a,b,c\na,"x\ny",n1\n')
    schema = "a string, b string, c string"
    from pyspark.sql import types as T

    from lodestrata.sources import csv as reader

    layout = T.StructType.fromDDL(schema)
    with pytest.raises(Exception, match="multi_line"):
        reader.tolerant_csv(spark, [str(tmp_path)], layout).collect()
    whole = reader.tolerant_csv(spark, [str(tmp_path)], layout, multi_line=True).collect()
    assert [tuple(r)[:3] for r in whole] == [("a", "x\ny", "n1")]


def test_text_without_a_limit_is_never_cut(spark, tmp_path):
    long = "é" * 70_000
    (tmp_path / "long.csv").write_bytes(f"a\n{long}\n".encode())
    from pyspark.sql import types as T

    from lodestrata.sources import csv as reader

    rows = reader.tolerant_csv(spark, [str(tmp_path)], T.StructType.fromDDL("a string"), text_bytes={reader.EVERY_COLUMN: None})
    assert rows.collect()[0]["a"] == long


# Quoted line breaks in byte ranges ------------------------------------------------------------------------------------

PLAIN = layout("a string; b string; c string")


@pytest.fixture
def small_ranges(spark):
    """Files are read in ranges of some ninety bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "90")
    yield
    for n, value in zip(names, before, strict=True):
        spark.conf.set(n, value)


def by_force(path):
    """Python's own CSV reader over the whole file."""
    with open(path, newline="", encoding="utf-8") as file:
        rows = list(stdlib_csv.reader(file))[1:]
    return sorted((tuple([*r, *[None] * 3][:3]) for r in rows if r and any(r)), key=str)


def multi(spark, path):
    return tolerant_csv(spark, [escaped_glob(str(path))], PLAIN, multi_line=True)


@pytest.mark.parametrize("seed", range(6))
def test_records_of_many_ranges_equal_those_of_the_whole_file(spark, tmp_path, small_ranges, seed):
    pick = random.Random(seed)
    words = ["x", "two words", 'a "quoted" word', "line\nbreak", "\n\n", "ends\n", "", "é,ü", '"', "long " * 60, "many\nlines\n" * 25, "\r\nreturn"]
    rows = [["h\n1" if seed % 2 else "h1", "h2", "h3"]] + [[f"k{n}", pick.choice(words), pick.choice(words)] for n in range(120)]
    path = tmp_path / "many.csv"
    with open(path, "w", newline="", encoding="utf-8") as file:
        stdlib_csv.writer(file, lineterminator="\r\n" if seed == 3 else "\n").writerows(rows)
    df = multi(spark, path)
    assert sorted((tuple(r)[:3] for r in df.collect()), key=str) == by_force(path)
    assert records.lines_of(spark, [str(path)]).rdd.getNumPartitions() > 20


def test_ranges_without_any_record_end_and_files_side_by_side(spark, tmp_path, small_ranges):
    """One field over many ranges, an empty file, one of a header alone; a quote that never closes stops the load."""
    long = "\n".join(f"line {n} with, commas" for n in range(80))
    (tmp_path / "a.csv").write_bytes(f'a,b,c\n1,"{long}",x\n2,"{long}","{long}"\n3,y,z'.encode())
    (tmp_path / "b.csv").write_bytes(b"a,b,c\n")
    (tmp_path / "c.csv").write_bytes(b"")
    found = {r["a"]: (r["b"], r["c"], r["source_file"]) for r in multi(spark, tmp_path).collect()}
    assert {k: found[k] for k in "123"} == {"1": (long, "x", "a.csv"), "2": (long, long, "a.csv"), "3": ("y", "z", "a.csv")}
    assert set(found) == {"1", "2", "3"}
    (tmp_path / "d.csv").write_bytes(b'a,b,c\n7,"open\nto the end,1\n2,3\n' * 2 + b'8,"open')
    with pytest.raises(Exception, match="quote that never closes, file d.csv"):
        multi(spark, tmp_path).collect()


def test_both_readers_agree_where_no_line_breaks_are_quoted(spark, write, small_ranges):
    body = b"1,\n2,,3,2024-01-01,\n\n3\n" + b'4,"a,b ""c""",1,2024-01-01,"x"\n5,\xff\xfex,1,2024-01-01,x\n' * 9
    assert sorted(load(spark, write(body), multi_line=True), key=str) == sorted(load(spark, write(body)), key=str)
    with pytest.raises(Exception, match="extra columns"):
        load(spark, write(body + b"1,a,1,2024-01-01,n,extra\n"), multi_line=True)
