from __future__ import annotations

import datetime as dt
import gzip

import pytest
from pyspark.sql import types as T

from cohortlake.contract import RECORDS, Contract, ContractError, EmptyInputError
from cohortlake.operators import record_count
from cohortlake.sources import (
    RAGGED,
    files_by_header,
    ragged_rows,
    read_frames,
    read_raw,
    read_records,
    read_text_columns,
    records,
)

HEADER = ",".join(RECORDS.names)
ROW = "P1,T1,A,S,10.5,40,70,2023-01-05,active,55.25"
TWO = Contract(
    T.StructType([T.StructField("id", T.StringType()), T.StructField("age", T.IntegerType())]),
    critical=("id",),
    key="id",
)


def read(spark, path, contract=TWO, **options):
    return [tuple(r) for r in read_records(spark, path, contract, **options).collect()]


def test_typed_record(spark, write):
    df = read_records(spark, write(f"{HEADER}\n{ROW}\n"), RECORDS)
    assert df.schema == RECORDS.schema
    day = dt.date(2023, 1, 5)
    assert tuple(df.first()) == ("P1", "T1", "A", "S", 10.5, 40, 70.0, day, "active", 55.25)


def test_columns_are_found_by_name(spark, write):
    assert read(spark, write("age,more,id\n40,x,P1\n")) == [("P1", 40)]


def test_missing_column(spark, write):
    with pytest.raises(ContractError, match="missing columns: age"):
        read(spark, write("id,more\nP1,x\n"))


def test_names_are_case_sensitive(spark, write):
    with pytest.raises(ContractError, match="missing columns: id"):
        read(spark, write("ID,age\nP1,1\n"))


def test_repeated_header_name(spark, write):
    with pytest.raises(ContractError, match="missing columns: age"):
        read(spark, write("id,age,age\nP1,40,41\n"))


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="input not found"):
        read(spark, str(tmp_path / "nowhere.csv"))


def test_no_records(spark, write):
    assert read(spark, write("id,age\n")) == []
    with pytest.raises(EmptyInputError):
        read(spark, write(""))


def test_malformed_rows(spark, write):
    text = "id,age\nP1,40\n\nP2\nP3,41,42,43\nP4,abc\nP5,45.0\n"
    assert read(spark, write(text)) == [
        ("P1", 40), ("P2", None), ("P3", 41), ("P4", None), ("P5", None)
    ]


def test_blank_lines_are_no_records(spark, write):
    df = read_raw(spark, write("id,age\nP1,40\n\n\nP2,41\n"), TWO)
    assert record_count(df).first().record_count == 2


def test_quotes(spark, write):
    text = 'id,age\n"P ""1"", x",40\n"",41\n'
    assert read(spark, write(text)) == [('P "1", x', 40), (None, 41)]


def test_line_break_in_quotes(spark, write):
    path = write('id,age\n"P1\nx",40\n')
    assert read(spark, path, multi_line=True) == [("P1\nx", 40)]


def test_carriage_returns_and_byte_order_mark(spark, write):
    assert read(spark, write("﻿id,age\r\nP1,40\r\n")) == [("P1", 40)]


def test_reader_options(spark, write):
    assert read(spark, write("id;age\nP1;40\n"), sep=";") == [("P1", 40)]


def test_many_files(spark, write, tmp_path):
    write("id,age\nP1,40\n", "many/1.csv")
    write("id,age\nP2,41\n", "many/2.csv")
    write("", "many/3.csv")
    path = str(tmp_path / "many")
    assert sorted(read(spark, path)) == [("P1", 40), ("P2", 41)]
    both = [f"{path}/1.csv", f"{path}/2.csv"]
    assert sorted(read(spark, both)) == [("P1", 40), ("P2", 41)]


@pytest.mark.parametrize("other", ["age,id\n41,P2\n", "\nid,more,age\nP2,x,41\n"])
def test_files_with_other_column_order(spark, write, tmp_path, other):
    write("id,age\nP1,40\n", "mixed/a 1.csv")
    write(other, "mixed/2.csv")
    write(other, "mixed/day=1/3.csv")
    write("", "mixed/4.csv")
    write("id,age\nP4,43\n", "mixed/5.csv")
    path = str(tmp_path / "mixed")
    expected = [("P1", 40), ("P2", 41), ("P4", 43)]
    assert sorted(read(spark, path + "/*.csv")) == expected
    every = read(spark, path, recursiveFileLookup="true")
    assert sorted(every) == sorted([*expected, ("P2", 41)])
    groups = files_by_header(spark, path, recursiveFileLookup="true")
    assert sorted(map(len, groups.values())) == [2, 2]


def test_headers_are_read_without_a_task_per_file(spark, write, tmp_path, monkeypatch):
    """Files that share a task are found as well."""
    for i in range(9):
        write("\n" * i + ("id,age\n" if i % 2 else "age,id\n") + "1,2\n" * 50, f"s/{i}.csv")
    monkeypatch.setattr(records, "ONE_FILE_A_TASK", {"spark.sql.files.openCostInBytes": 1})
    groups = files_by_header(spark, str(tmp_path / "s"))
    assert sorted(map(len, groups.values())) == [4, 5]


def test_a_file_without_a_column(spark, write, tmp_path):
    write("id,age\nP1,40\n", "less/1.csv")
    write("id,more\nP2,x\n", "less/2.csv")
    path = str(tmp_path / "less")
    with pytest.raises(ContractError, match="missing columns: age"):
        read(spark, path)
    rows = read_text_columns(spark, path).select("id", "age", "more").collect()
    assert sorted(map(tuple, rows)) == [("P1", "40", None), ("P2", None, "x")]


def test_only_needed_columns_are_parsed(spark, write, plan_of):
    df = read_records(spark, write(f"{HEADER}\n{ROW}\n"), RECORDS).select("age")
    assert "ReadSchema: struct<age:string>" in plan_of(df)


def test_nothing_is_inferred(spark, write):
    df = read_text_columns(spark, write("id,age\nP1,40\n"))
    assert {f.dataType for f in df.schema} == {T.StringType()}


def test_rows_of_a_wrong_length(spark, write):
    path = write('a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x, ""y""",,\n\n,,\n')
    rows = [tuple(r) for r in ragged_rows(spark, path).select("text").collect()]
    assert rows == [("4,5",), ("6,7,8,9",)]
    (frame,) = read_frames(spark, path, ragged=True)
    assert frame.columns == ["a", "b", "c", RAGGED]
    assert [tuple(r)[:3] for r in frame.collect()] == [
        ("1", "2", "3"), ("4", "5", None), ("6", "7", "8"), ('x, "y"', None, None), (None, None, None)
    ]
    assert frame.where(f"{RAGGED} IS NOT NULL").count() == 2
    assert frame.select(RAGGED).where(f"{RAGGED} IS NULL").count() == 3


def test_rows_of_a_wrong_length_over_lines_and_headers(spark, write, tmp_path):
    write('a,b\n"1\n2",3\n"4\n5"\n', "r/one.csv")
    write("b,a,c\n1,2,3\n4\n", "r/two.csv")
    found = ragged_rows(spark, str(tmp_path / "r"), multi_line=True)
    assert {(r.file.rsplit("/", 1)[1], r.text) for r in found.collect()} == {
        ("one.csv", '"4\n5"'), ("two.csv", "4")
    }


@pytest.mark.parametrize("few", [0, 1024])
def test_headers_from_the_driver_and_from_tasks(spark, write, tmp_path, monkeypatch, few):
    monkeypatch.setattr(records, "FEW_FILES", few)
    long = ",".join(f"column{i}" for i in range(9000))
    for name, text in {
        "a.csv": "\r\n \nx,y\r\n1,2\r\n", "b.csv": "x,y\n3,4\n", "c.csv": "y,x\n5,6", "d.csv": "",
        "e.csv": f"{long}\n", "f.csv": "x,y", "g.csv": "x,y\r", "h i.csv": "y,x\n",
    }.items():
        write(text, f"h/{name}")
    with gzip.open(tmp_path / "h" / "z.csv.gz", "wt") as out:
        out.write("y,x\n7,8\n")
    groups = files_by_header(spark, str(tmp_path / "h"))
    short = {line: [f.rsplit("/", 1)[1] for f in found] for line, found in groups.items()}
    assert short == {
        "x,y": ["a.csv", "b.csv", "f.csv", "g.csv"], "y,x": ["c.csv", "h i.csv", "z.csv.gz"], long: ["e.csv"]
    }


def test_headers_of_many_files(spark, write, tmp_path):
    for i in range(200):
        write(f"{'a,b' if i % 3 else 'b,a'}\n{i},x\n", f"m/f{i}.csv")
    groups = files_by_header(spark, str(tmp_path / "m"))
    assert {line: len(found) for line, found in groups.items()} == {"a,b": 133, "b,a": 67}
    rows = read_text_columns(spark, str(tmp_path / "m"))
    assert rows.where("a = 'x'").count() == 67 and rows.where("b = 'x'").count() == 133


def test_one_header_is_taken_for_all_unless_looked_at(spark, write, tmp_path):
    write("a,b\n1,2\n", "o/one.csv")
    write("b,a\n1,2\n", "o/two.csv")
    (frame,) = read_frames(spark, str(tmp_path / "o"), look=False, ragged=True)
    with pytest.raises(Exception) as error:
        frame.collect()
    assert records.header_differs(error.value)
    assert len(read_frames(spark, str(tmp_path / "o"))) == 2
