import random

import pytest

from gridlake.sources import dialects as d


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8", newline="")


ROWS = [("Nord, Ost", -1234.5, "2024-01-05"), ("Süd; West", 0.25, "2024-02-06"), ("Mitte | A", 17.0, "2024-03-07"), ("", 3.5, "2024-04-08")]


def text_of(delimiter, quote, decimal, header, end="\n"):
    def cell(v):
        v = str(v).replace(".", decimal) if isinstance(v, float) else str(v)
        return f"{quote}{v}{quote}" if quote and (delimiter in v or quote in v) else v.replace(delimiter, " ")

    lines = [["Area", "Price[Currency/MWh]", "Day"]] * header + [list(r) for r in ROWS] * 3
    return end.join(delimiter.join(map(cell, line)) for line in lines) + end


@pytest.mark.parametrize("delimiter", [",", ";", "\t", "|"])
@pytest.mark.parametrize("quote", ["", '"', "'"])
@pytest.mark.parametrize("decimal", [".", ","])
@pytest.mark.parametrize("header", [True, False])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_dialects_are_found(delimiter, quote, decimal, header, end):
    if delimiter == decimal and not quote:
        pytest.skip("no such file can be read back")
    found = d.sniff(text_of(delimiter, quote, decimal, header, end))
    assert (found["delimiter"], found["decimal"], found["header"]) == (delimiter, decimal, header)
    assert found["names"] == (["Area", "Price[Currency/MWh]", "Day"] if header else ["column0", "column1", "column2"])


@pytest.mark.parametrize(
    "text, want",
    [
        ("a\n1\n2\n", {"header": True, "names": ["a"]}),
        ("x;1,5\ny;2,5\n", {"delimiter": ";", "decimal": ",", "header": False}),
        ("1,5;2,5\n3,5;4,5\n", {"delimiter": ";", "decimal": ",", "header": False}),
        ('"a","b"\n"x, y","two\nlines"\n', {"delimiter": ",", "quote": '"', "header": True, "names": ["a", "b"]}),
        ("k|v\none|1.234\ntwo|5.678\n", {"delimiter": "|", "decimal": "."}),
        ("k|v\none|1.234,5\ntwo|5.678,25\n", {"delimiter": "|", "decimal": ","}),
        ("\ufeffa;b\n1;2\n", {"delimiter": ";", "names": ["a", "b"]}),
        ("name,town\nAnn,Ulm\nBob,Bonn\n", {"delimiter": ",", "header": True}),
        ("Ann,Ulm\nBob,Ulm\nAnn,Ulm\n", {"delimiter": ",", "header": False}),
        ("only a header;of two\n", {"delimiter": ";", "header": True}),
        ("\n\n", {"header": False, "names": []}),
    ],
)
def test_sniff(text, want):
    found = d.sniff(text)
    assert {k: found[k] for k in want} == want


def test_read_of_a_mixed_folder(spark, tmp_path, rows):
    folder = tmp_path / "mixed"
    write(folder, "a [1].csv", "Area;Price;Units\nNord;-1.234,5;7\nSüd;0,25;8\n")
    write(folder, "b.csv", 'Area,Price,Note\n"Ost, See",3.5,x\n')
    write(folder, "c.csv", "Area\tPrice\tUnits\nWest\t4.5\t9\n")
    write(folder, "none.csv", "")
    df = d.read_sniffed(spark, str(folder), tag_source=True)
    assert dict(df.dtypes) == {"Area": "string", "Price": "double", "Units": "bigint", "Note": "string", "_source_file": "string"}
    assert rows(df.select("Area", "Price", "Units", "Note", "_source_file")) == [
        ("Nord", -1234.5, 7, None, "a [1].csv"), ("Ost, See", 3.5, None, "x", "b.csv"),
        ("Süd", 0.25, 8, None, "a [1].csv"), ("West", 4.5, 9, None, "c.csv"),
    ]


def test_a_late_text_makes_the_column_text(spark, tmp_path):
    write(tmp_path / "late", "a.csv", "k;v\n" + "".join(f"{i};{i}\n" for i in range(3000)) + "3000;n/a\n")
    df = d.read_sniffed(spark, str(tmp_path / "late"))
    assert dict(df.dtypes) == {"k": "bigint", "v": "string"} and df.where("v = 'n/a'").count() == 1


def test_large_whole_numbers_are_not_rounded(spark, tmp_path):
    write(tmp_path / "large", "a.csv", "k;v\n1;9007199254740993\n2;1\n")
    assert d.read_sniffed(spark, str(tmp_path / "large")).agg({"v": "max"}).first()[0] == 9007199254740993


def test_one_task_a_file_reads_its_first_lines(spark, tmp_path):
    draw = random.Random(1)
    for i in range(5):
        write(tmp_path / "many", f"{i}.csv", "k;v\n" + "".join(f"{j};{draw.random()}\n" for j in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = d.sniff_files(spark, [str(tmp_path / "many")]).collect()
    assert len(found) == 5 and {(r.delimiter, r.decimal, tuple(r.names)) for r in found} == {(";", ".", ("k", "v"))}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_nothing_to_read(spark, tmp_path):
    write(tmp_path / "empty", "a.csv", "")
    with pytest.raises(ValueError, match="no lines"):
        d.read_sniffed(spark, str(tmp_path / "empty"))
