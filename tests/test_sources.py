import io
import json
import zipfile

import pytest

from distriq.durable import durable, remove, shared_dir
from distriq.sources.documents import html_rows, index_rows, rows_to_payouts, sheet_cells, text_rows, workbook_rows
from distriq.sources.files import export_csv, export_xlsx, read_labelled, read_registry, read_snapshot, read_universe, report_json, report_markdown, write_snapshot


def test_html_headers(spark):
    page = "<table><tr><td>Totals 2024</td></tr><tr><td>Ex-Date</td><td>Amount</td></tr><tr><td>Mar 5, 2024</td><td>$0.5</td></tr></table><TABLE><tr><th>Type</th></tr><tr><th scope='row'>a</th><td>b</td></tr></TABLE>"
    rows = html_rows(spark.createDataFrame([(1, page), (2, None), (3, "<p>no table")], "id int, p string"), "id", "p").orderBy("table_no").collect()
    assert [(r["table_no"], list(r["headers"]), list(r["cells"])) for r in rows] == [(0, ["ex-date", "amount"], ["Mar 5, 2024", "$0.5"]), (1, ["type"], ["a", "b"])]


def test_total_column_wins_and_other_symbols_go(spark):
    rows = spark.createDataFrame([(1, ["ticker", "ex-date", "cash dividend", "total distribution"], ["X", "2024-01-02", "0.1", "0.3"]), (2, ["ticker", "ex-date", "amount"], ["Y", "2024-01-02", "1"]), (3, ["ex-date"], ["2024-01-02", "9"])], "id int, headers array<string>, cells array<string>")
    assert [(r["id"], r["amount"]) for r in rows_to_payouts(rows, ["id"], ("x",)).collect()] == [(1, 0.3)]


def test_text_schedule(spark):
    text = "Fund X\nEx-Date Record Date Amount\n2024-06-21  June 24, 2024  $0.8800\n2024-07-21 only one 0.5\nno dates 0.5\n"
    got = text_rows(spark.createDataFrame([(1, text), (2, "")], "id int, t string"), "id", "t").collect()
    assert [(list(r["headers"]), list(r["cells"])) for r in got] == [(["ex-date", "record date", "amount"], ["2024-06-21", "2024-06-24", "$0.8800"])]


def test_index(spark):
    text = "497  Not yet  12  20240101  a.txt\n----------\n497K   Some Fund Trust   0000036405   20240322   f/1.txt\nbroken line\n8-K   Other   0   20241399   f/2.txt"
    got = index_rows(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t").collect()
    assert [(r["form"], r["company"], r["filer"], str(r["filed"]), r["path"]) for r in got] == [("497K", "Some Fund Trust", "36405", "2024-03-22", "f/1.txt")]


def test_workbook(spark):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c></row><row><c r="A2" t="s"><v>1</v></c><c r="C2" t="inlineStr"><is><t>Amount</t></is></c></row><row><c r="A3"><v>2024-01-02</v></c><c r="C3"><v>0.5</v></c></row></sheetData></worksheet>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as book:
        book.writestr("xl/worksheets/sheet1.xml", sheet)
        book.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Title</t></si><si><t>Ex-Date</t></si></sst>")
    df = spark.createDataFrame([(1, bytearray(buffer.getvalue())), (2, bytearray(b"no zip")), (3, None)], "id int, c binary")
    got = workbook_rows(df, "id", "c").collect()
    assert [(r["id"], list(r["headers"]), list(r["cells"])) for r in got] == [(1, ["ex-date", "", "amount"], ["2024-01-02", "", "0.5"])]


def test_files(spark, tmp_path):
    (tmp_path / "u.json").write_text(json.dumps([{"fund_id": "F", "is_etf": True, "extra": 1}, {"fund_id": "G"}]))
    assert [(r["fund_id"], r["is_etf"], r["is_verified"]) for r in read_universe(spark, str(tmp_path / "u.json")).collect()] == [("F", True, False), ("G", False, False)]
    (tmp_path / "g.csv").write_text("a,b\n x , \n,\n")
    assert [tuple(r) for r in read_labelled(spark, str(tmp_path / "g.csv"), ["a"]).collect()] == [("x", None)]
    with pytest.raises(ValueError, match="missing columns: z"):
        read_labelled(spark, str(tmp_path / "g.csv"), ["z"])
    pytest.importorskip("yaml")
    (tmp_path / "r.yaml").write_text("sources:\n- {source_id: s, source_tier: 1, limitations: [a, b]}\n")
    assert read_registry(spark, str(tmp_path / "r.yaml")).first()["limitations"] == ["a", "b"]
    (tmp_path / "bad.yaml").write_text("sources:\n- {source_id: s, source_tier: 7}\n")
    with pytest.raises(ValueError, match="source_tier"):
        read_registry(spark, str(tmp_path / "bad.yaml"))


def test_xlsx_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-02", "<&>\x01", ["a"]), (2, None, "é", None)], "id int, `ex-date` string, amount string, tags array<string>")
    export_xlsx({"a table with a name that is far too long": df, "b": df.limit(0)}, str(tmp_path / "x.xlsx"))
    cells = [(sheet, i, c) for sheet, i, c in sheet_cells((tmp_path / "x.xlsx").read_bytes())]
    assert cells == [("xl/worksheets/sheet1.xml", 0, ["id", "ex-date", "amount", "tags"]), ("xl/worksheets/sheet1.xml", 1, ["1", "2024-01-02", "<&>", '["a"]']), ("xl/worksheets/sheet1.xml", 2, ["2", "", "é", ""]), ("xl/worksheets/sheet2.xml", 0, ["id", "ex-date", "amount", "tags"])]


def test_export_snapshots_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"])], "id int, tags array<string>")
    export_csv({"t": df}, str(tmp_path))
    assert spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/t").first()["id"] == "1"
    root = str(tmp_path / "table")
    write_snapshot(df, root)
    write_snapshot(read_snapshot(spark, root).union(df), root)
    assert read_snapshot(spark, root).count() == 2
    metrics = spark.createDataFrame([("checks", None, "3"), ("by", "US", "1"), ("by", "CA", "2")], "metric string, key string, value string")
    assert json.loads(report_json(metrics)) == {"checks": "3", "by": {"US": "1", "CA": "2"}}
    assert "  - CA: 2" in report_markdown(metrics)


def test_durable(spark):
    df = durable(spark.range(5).toDF("id"), "t")
    assert df.count() == 5
    assert shared_dir(spark)
    remove(spark, shared_dir(spark) + "/nothing-here")


def test_package_reaches_workers_elsewhere(tmp_path):
    """A driver that found the package by its own path runs Python workers that don't have that path."""
    import os
    import subprocess
    import sys

    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "import __spark_entry__ as e; from distriq.session import local_session\n"
        "s = local_session(2); print('ROWS', e.queries()['p4_graph'](s, '/root/testdata/sf0.001').count())"
    ) % os.getcwd()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("SPARK")}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "ROWS" in run.stdout, run.stderr[-2000:]
