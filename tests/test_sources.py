import pytest

from ledgerloom.constants import FEED_COLUMNS, HISTORY_HEADERS, SALES_HEADERS
from ledgerloom.sources import overlong_rows, read_history, read_sales, tag_history_sheet, tag_sales, unify


def write(path, text, encoding="latin-1"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


SALES = ",".join(SALES_HEADERS)
SHEET = ",".join(HISTORY_HEADERS)


def test_sales_file_is_latin_1_text_by_header_name(spark, tmp_path):
    path = write(
        tmp_path / "sales.csv",
        "Extra," + ",".join(reversed(SALES_HEADERS))
        + '\nx,España,17850.0,2.55,12/1/2010 8:26,6,"CAFÉ ""A"", big",85123A,536365\n'
        + "x,NA,nan,#N/A,NULL,n/a,null,None,<NA>\n",
    )
    rows = read_sales(spark, path)
    assert rows.columns == [*FEED_COLUMNS, "_source"]
    assert {kind for _, kind in rows.dtypes} == {"string"}
    first, second = rows.collect()
    assert tuple(first) == (
        "536365", "85123A", 'CAFÉ "A", big', "6", "12/1/2010 8:26", "2.55", "17850.0", "España",
        "sales_csv",
    )
    assert tuple(second) == (None,) * 8 + ("sales_csv",)


def test_part_files_with_swapped_columns_stop_the_read(spark, tmp_path):
    swapped = ["StockCode", "InvoiceNo"]
    rest = [name for name in SALES_HEADERS if name not in swapped]
    write(tmp_path / "sales" / "a.csv", ",".join([*reversed(swapped), *rest]) + "\n1,A" + ",x" * 6)
    write(tmp_path / "sales" / "b.csv", ",".join([*swapped, *rest]) + "\nB,2" + ",x" * 6)
    with pytest.raises(Exception, match="(?i)header"):
        read_sales(spark, str(tmp_path / "sales")).collect()


def test_sales_file_without_a_column_is_an_error(spark, tmp_path):
    path = write(tmp_path / "sales.csv", "InvoiceNo,StockCode\n1,A\n")
    with pytest.raises(Exception, match="description"):
        read_sales(spark, path)


def test_history_sheets_may_lack_columns(spark, tmp_path):
    write(tmp_path / "history" / "a.csv", SHEET + "\n1,A,pen,2,2009-12-01 07:45:00,1.5,7,X\n")
    write(tmp_path / "history" / "b.csv", "Invoice,Price,Note\n2,3.5,hello\n")
    rows = read_history(spark, str(tmp_path / "history")).orderBy("invoice_no").collect()
    assert [tuple(r) for r in rows] == [
        ("1", "A", "pen", "2", "2009-12-01 07:45:00", "1.5", "7", "X", "history_csv"),
        ("2", None, None, None, None, "3.5", None, None, "history_csv"),
    ]


def test_sheets_may_be_parquet_or_listed(spark, tmp_path):
    sheet = spark.createDataFrame([("1", 2.5)], "Invoice string, Price double")
    path = str(tmp_path / "sheet.parquet")
    sheet.write.parquet(path)
    rows = read_history(spark, [path]).collect()
    assert [(r.invoice_no, r.unit_price, r.country) for r in rows] == [("1", "2.5", None)]


def test_no_sheets_is_an_error(spark, tmp_path):
    (tmp_path / "history").mkdir()
    with pytest.raises(FileNotFoundError):
        read_history(spark, str(tmp_path / "history"))


def test_quoted_line_breaks_need_multiline(spark, tmp_path):
    path = write(tmp_path / "s.csv", SALES + '\n1,A,"two\nlines",1,12/1/2010 8:26,1,7,X\n')
    rows = read_sales(spark, path, multiline=True).collect()
    assert [r.description for r in rows] == ["two\nlines"]


def test_unify_adds_columns_no_source_has(spark):
    sheet = tag_history_sheet(spark.createDataFrame([("1",)], "Invoice string"))
    rows = unify([sheet])
    assert rows.columns == [*FEED_COLUMNS, "_source"]
    sales = tag_sales(spark.createDataFrame([tuple("abcdefgh")], list(SALES_HEADERS)))
    assert unify([sales, sheet]).count() == 2


def test_rows_longer_than_the_header_stop_the_read(spark, tmp_path):
    short = '1,A,"pen, ""red"", big"\n'
    rows = read_sales(spark, write(tmp_path / "short.csv", f"{SALES}\n{short}"))
    assert rows.first()[:4] == ("1", "A", 'pen, "red", big', None)
    long = "1,A,pen,2,12/1/2010 8:26,1.5,7,Spain,\n"
    rows = read_sales(spark, write(tmp_path / "long.csv", f"{SALES}\n{long}"))
    with pytest.raises(Exception, match="more fields than the header"):
        rows.select("invoice_no").collect()


VALID = "1,A,pen,2,12/1/2010 8:26,1.5,7,Spain"


@pytest.mark.parametrize("multiline", [False, True])
@pytest.mark.parametrize(
    "line",
    [VALID + ",", VALID + ",x", '1,A,"a, ""b"", c",2,d,1,7,Spain,"x,y"', '1,A,5" pipe,2,d,1,7,Spain,x', ",,,,,,,,"],
)
def test_every_plan_refuses_an_overlong_row(spark, tmp_path, line, multiline):
    path = write(tmp_path / "s.csv", f"{SALES}\n{VALID}\n{line}\n")
    rows = read_sales(spark, path, multiline=multiline)
    for plan in (
        lambda: rows.collect(),
        lambda: rows.count(),
        lambda: rows.select("invoice_no").collect(),
        lambda: rows.groupBy("country").count().collect(),
        lambda: rows.filter("quantity = '77'").first(),
        lambda: rows.select(rows.unit_price).limit(5).collect(),
    ):
        with pytest.raises(Exception, match="more fields than the header"):
            plan()
    (found,) = overlong_rows(spark, path).collect()
    assert (found.line, found.expected) == (line, 8) and found.fields in (9, 10)


@pytest.mark.parametrize("multiline", [False, True])
def test_every_plan_reads_valid_and_short_rows(spark, tmp_path, multiline):
    lines = [VALID, '1,A,"a, ""b"", c",2,d,1,7,Spain', "2,B", '3,"",x,,,,,', '4,A,5" pipe,2,d,1,7,Sp"ain', '5,"""",x']
    path = write(tmp_path / "s.csv", "\n".join([SALES, *lines]))
    rows = read_sales(spark, path, multiline=multiline)
    assert rows.count() == 6 and rows.first().invoice_no == "1"
    assert sorted(r.invoice_no for r in rows.select("invoice_no").collect()) == ["1", "1", "2", "3", "4", "5"]
    found = {r.invoice_no: r for r in rows.collect()}
    assert found["1"].description == 'a, "b", c' and found["2"].description is None
    assert found["3"].stock_code is None and found["4"].description == '5" pipe' and found["4"].country == 'Sp"ain'
    assert found["5"].stock_code == '"'
    assert overlong_rows(spark, path).count() == 0


def test_one_long_quoted_field_does_not_overflow_a_stack(spark, tmp_path):
    path = write(tmp_path / "s.csv", f'{SALES}\n1,A,"{"a, " * 200_000}{chr(34) * 2000}",2,d,1,7,Spain\n')
    (row,) = read_sales(spark, path).collect()
    assert len(row.description) == 601_000 and row.country == "Spain"


def test_a_header_below_the_first_line_is_a_row(spark, tmp_path):
    path = write(tmp_path / "s.csv", f"{SALES}\n{VALID}\n{SALES}\n")
    assert read_sales(spark, path).count() == 2
    with pytest.raises(ValueError, match="no header"):
        read_sales(spark, write(tmp_path / "empty.csv", ""))
    assert read_sales(spark, write(tmp_path / "bare.csv", SALES)).count() == 0


def test_many_sheets_are_one_scan_per_header(spark, tmp_path):
    folder = tmp_path / "history á+ b"
    for i in range(300):
        write(folder / f"sheet {i:03d}+é.csv", f"{SHEET}\n" + f"{i},A,pen,2,2009-12-01 07:45:00,1.5,7,X\n" * (i % 3))
    for i in range(200):
        write(folder / f"dir{i:03d}" / "part-0.csv", f"Invoice,Price,Note\nn{i},3.5,hello\n")
        write(folder / f"dir{i:03d}" / "_SUCCESS", "")
    rows = read_history(spark, str(folder), name_sheets=True)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan csv") == 2
    counts = {r._sheet: r["count"] for r in rows.groupBy("_sheet").count().collect()}
    expected = {f"sheet {i:03d}+é.csv": i % 3 for i in range(300) if i % 3} | {f"dir{i:03d}": 1 for i in range(200)}
    assert counts == expected
    assert rows.columns == [*FEED_COLUMNS, "_source", "_sheet"]
    listed = read_history(spark, [str(folder / "dir007"), str(folder / "sheet 001+é.csv")], name_sheets=True)
    assert sorted(tuple(r)[-1] for r in listed.collect()) == ["dir007", "sheet 001+é.csv"]
