"""Files in and out: universe and registry, labelled rows, exports, snapshots, reports."""

from __future__ import annotations

import json
import re
import uuid
import zipfile
from collections.abc import Collection
from itertools import chain
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNIVERSE = "fund_id string, country string, fund_name string, fund_type string, fund_family string, official_source_url string, distribution_api_url string, ticker string, cik string, sec_series_id string, sec_class_id string, sedar_id string, fundserv_code string, expected_frequency string, is_etf boolean, is_monthly_payer boolean, is_verified boolean"


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of funds; flags that are missing are false. Fields the schema doesn't have are left out."""
    return _flagged(spark.read.schema(UNIVERSE).json(path, multiLine=True))


def read_universe_text(df: DataFrame, column: str) -> DataFrame:
    """As :func:`read_universe`, of JSON arrays in a column; a text that isn't one gives no rows."""
    return _flagged(df.select(F.inline(F.from_json(F.col(f"`{column}`"), f"array<struct<{UNIVERSE.replace(' ', ':').replace(',:', ',')}>>"))))


def _flagged(funds: DataFrame) -> DataFrame:
    return funds.fillna(False, ["is_etf", "is_monthly_payer", "is_verified"])


def read_registry(spark: SparkSession, path: str, key: str = "sources") -> DataFrame:
    """A YAML list of sources as rows with array columns; raises ValueError if a tier isn't 1, 2 or 3."""
    import yaml

    with open(path, encoding="utf-8") as file:
        entries = yaml.safe_load(file)[key]
    for e in entries:
        if e.get("source_tier") not in (1, 2, 3):
            raise ValueError(f"source_tier of {e.get('source_id')}")
    kinds = "source_id string, source_type string, source_tier int, role_category string, applicable_country string, applicable_fund_types array<string>, evidence_capabilities array<string>, available_date_fields array<string>, limitations array<string>, access_method string, notes string"
    names = [k.split()[0] for k in kinds.split(", ")]
    return spark.createDataFrame([tuple(e.get(n) for n in names) for e in entries], kinds)


#: Values that come back from a file as they were written: blanks around them, quotes, backslashes and line breaks in them.
_CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_labelled(spark: SparkSession, path: str, columns: list[str], unchanged: Collection[str] = (), blank_rows: bool = False) -> DataFrame:
    """A CSV with a header that must have ``columns``; cells trimmed of spaces of all kinds, blank ones NULL.

    Tabs and line breaks are no spaces. Quotes within quotes are doubled. ``unchanged``: columns read as they are
    written. Blank rows are left out, unless ``blank_rows``.
    """
    # NULL by a name no cell has, so that it isn't the empty text
    rows = spark.read.options(**_CSV, multiLine=True, nullValue=uuid.uuid4().hex, emptyValue="").csv(path)
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    tidy = rows.select(*(F.col(f"`{c}`") if c in unchanged else F.nullif(F.regexp_replace(F.col(f"`{c}`"), r"^\p{Zs}+|\p{Zs}+\z", ""), F.lit("")).alias(c) for c in rows.columns))
    return tidy if blank_rows else tidy.na.drop("all")


def export_csv(tables: dict[str, DataFrame], directory: str) -> None:
    """Each table as CSV with a header under ``<directory>/<name>``, written by all tasks; nested columns as JSON.

    Text is written as it is: with the blanks around it, quotes doubled, the empty text quoted, NULL as nothing.
    """
    for name, df in tables.items():
        flat = [F.to_json(c).alias(c) if kind.startswith(("array", "map", "struct")) else F.col(f"`{c}`") for c, kind in df.dtypes]
        df.select(*flat).write.mode("overwrite").options(**_CSV).csv(f"{directory}/{name}")


#: Characters that XML can't hold.
_UNPRINTABLE = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")
_SHEET_ROWS = 1_048_576


def export_xlsx(tables: dict[str, DataFrame], path: str) -> None:
    """Each table as a sheet of one workbook, names cut to 31 characters, cells as text; for tables a person reads.

    Rows pass through the driver one partition at a time and are never held together. A sheet has at most 1,048,576
    rows, by the format; a table with more raises ValueError, as it is meant for :func:`export_csv`.
    """
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    names = [name[:31] for name in tables]
    numbered = list(enumerate(names, 1))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml."
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kinds}worksheet+xml"/>' for i, _ in numbered)
        book.writestr("[Content_Types].xml", f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kinds}sheet.main+xml"/>{parts}</Types>')
        book.writestr("_rels/.rels", f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{links}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{links}"><sheets>' + "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="r{i}"/>' for i, n in numbered) + "</sheets></workbook>")
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}/relationships">' + "".join(f'<Relationship Id="r{i}" Type="{links}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in numbered) + "</Relationships>")
        for (i, _), df in zip(numbered, tables.values()):
            flat = df.select(*(F.to_json(c).alias(c) if kind.startswith(("array", "map", "struct")) else F.col(f"`{c}`").cast("string") for c, kind in df.dtypes))
            with book.open(f"xl/worksheets/sheet{i}.xml", "w", force_zip64=True) as out:
                out.write(f"<worksheet {main}><sheetData>".encode())
                for n, row in enumerate(chain([df.columns], flat.toLocalIterator())):
                    if n == _SHEET_ROWS:
                        raise ValueError(f"a sheet has at most {_SHEET_ROWS} rows")
                    cells = ("<c/>" if v is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_UNPRINTABLE.sub("", v))}</t></is></c>' for v in row)
                    out.write(f"<row>{''.join(cells)}</row>".encode())
                out.write(b"</sheetData></worksheet>")


def _folder(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, root: str) -> list[int]:
    _, at, files = _folder(spark, root)
    names = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
    return sorted(int(n[8:]) for n in names if re.fullmatch(r"CURRENT-\d{12}", n))


def snapshot_parts(spark: SparkSession, root: str) -> list[str] | None:
    """The folders that make up a table's current state; None if none was ever written."""
    versions = _versions(spark, root)
    return None if not versions else [r[0] for r in spark.read.text(f"{root}/CURRENT-{versions[-1]:012d}").collect()]


def _point(spark: SparkSession, root: str, parts: list[str]) -> None:
    """Make these parts the current state: a pointer with the next number is put in place, and none is ever taken away.

    Readers go by the highest number, so at no moment is there none. A writer that finds its number taken raises.
    """
    jvm, at, files = _folder(spark, root)
    number = (_versions(spark, root) or [0])[-1] + 1
    draft, final = (jvm.org.apache.hadoop.fs.Path(f"{root}/{name}") for name in (f"_draft.{uuid.uuid4().hex}", f"CURRENT-{number:012d}"))
    out = files.create(draft, True)
    out.write(bytearray("\n".join(parts).encode()))
    out.close()
    if files.exists(final) or not files.rename(draft, final):
        files.delete(draft, False)
        raise RuntimeError(f"another writer changed {root}")


def write_snapshot(df: DataFrame, root: str) -> str:
    """Write a table's new state beside the old one and point to it: readers see the one or the other, never a half.

    ``df`` may read the current snapshot. Returns the new snapshot's path; older ones stay until somebody removes them.
    """
    path = f"{root}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _point(df.sparkSession, root, [path])
    return path


def append_snapshot(df: DataFrame, root: str) -> str:
    """Add rows to a table's state: they alone are written, and the pointer names them beside what there was."""
    spark = df.sparkSession
    path = f"{root}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _point(spark, root, [*(snapshot_parts(spark, root) or []), path])
    return path


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The state that was written last; raises FileNotFoundError if none was."""
    parts = snapshot_parts(spark, root)
    if parts is None:
        raise FileNotFoundError(root)
    return spark.read.parquet(*parts)


def report_json(metrics: DataFrame) -> str:
    """A tidy report (metric, key, value; one row each, few rows) as JSON with sorted keys."""
    out: dict[str, object] = {}
    for metric, key, value in metrics.select("metric", "key", "value").toLocalIterator():
        if key is None:
            out[metric] = value
        else:
            out.setdefault(metric, {})[key] = value
    return json.dumps(out, sort_keys=True, ensure_ascii=False)


def report_markdown(metrics: DataFrame) -> str:
    """The same report as a nested list."""
    lines: list[str] = []
    for metric, value in json.loads(report_json(metrics)).items():
        if isinstance(value, dict):
            lines += [f"- **{metric}**", *(f"  - {k}: {v}" for k, v in value.items())]
        else:
            lines.append(f"- **{metric}**: {value}")
    return "\n".join(lines)
