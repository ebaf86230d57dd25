"""Where results go."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from typing import BinaryIO
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_version(df: DataFrame, folder: str, version: int) -> str:
    """A new version of a table in a folder of its own; readers switch when it is whole."""
    path = f"{folder.rstrip('/')}/v{version:06d}"
    df.write.mode("error").parquet(path)
    return path


def json_by_file(df: DataFrame, folder: str, file_column: str = "source_file") -> None:
    df.write.partitionBy(file_column).mode("append").json(folder)


def merged_json(df: DataFrame, path: str) -> None:
    """All rows as JSON lines, in one folder whatever files they came from."""
    df.write.mode("overwrite").json(path)


def decision_lines(decisions: DataFrame) -> DataFrame:
    """A log line (JSON) for each decision."""
    return decisions.select(F.to_json(F.struct(*decisions.columns)).alias("line"))


def workbook_tables(projects: DataFrame, team: DataFrame, folder: str) -> None:
    """Two sheets as CSV, with a header each."""
    projects.write.mode("overwrite").option("header", True).csv(f"{folder}/projects")
    team.write.mode("overwrite").option("header", True).csv(f"{folder}/team")


#: Rows of a sheet at most, in the workbook format.
SHEET_ROWS = 1_048_576
_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _sheet(df: DataFrame, widths: dict[str, int]) -> Iterator[str]:
    """One sheet's XML, in parts: widths, a bold header that stays in view, then a row a row."""

    def cell(value: object, style: int = 0) -> str:
        if value is None:
            return "<c/>"
        if isinstance(value, int | float) and not isinstance(value, bool):
            return f"<c><v>{value}</v></c>"
        plain = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(value))
        return f'<c t="inlineStr" s="{style}"><is><t xml:space="preserve">{escape(plain)}</t></is></c>'

    columns = "".join(f'<col min="{k}" max="{k}" width="{widths[c]}" customWidth="1"/>' for k, c in enumerate(df.columns, 1))
    yield f'{_XML}<worksheet xmlns="{_MAIN}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><cols>{columns}</cols><sheetData>'
    yield f"<row>{''.join(cell(c, 1) for c in df.columns)}</row>"
    for n, r in enumerate(df.toLocalIterator(), 2):
        if n > SHEET_ROWS:
            raise ValueError(f"a sheet holds {SHEET_ROWS} rows")
        yield f"<row>{''.join(map(cell, r))}</row>"
    yield "</sheetData></worksheet>"


def workbook(sheets: dict[str, DataFrame], file: BinaryIO) -> None:
    """A workbook of named sheets, with a styled header and columns as wide as their values.

    Rows come to the driver one by one, as one file needs; more than a sheet holds raise ValueError.
    """
    names = list(sheets)
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as book:
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1))
        book.writestr("[Content_Types].xml", f'{_XML}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{parts}</Types>')
        book.writestr("_rels/.rels", f'{_XML}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{_LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1))
        book.writestr("xl/workbook.xml", f'{_XML}<workbook xmlns="{_MAIN}" xmlns:r="{_LINKS}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{k}" Type="{_LINKS}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f'{_XML}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}<Relationship Id="rId{len(names) + 1}" Type="{_LINKS}/styles" Target="styles.xml"/></Relationships>')
        fonts = '<fonts count="2"><font/><font><b/><color rgb="FFFFFFFF"/></font></fonts><fills count="3"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill><fill><patternFill patternType="solid"><fgColor rgb="FF2F5496"/></patternFill></fill></fills>'
        styles = '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" fillId="2" applyFont="1" applyFill="1" applyAlignment="1"><alignment horizontal="center" wrapText="1"/></xf></cellXfs>'
        book.writestr("xl/styles.xml", f'{_XML}<styleSheet xmlns="{_MAIN}">{fonts}{styles}</styleSheet>')
        for k, name in enumerate(names, 1):
            widths = {r["column_name"]: r["width"] for r in column_widths(sheets[name]).collect()}
            with book.open(f"xl/worksheets/sheet{k}.xml", "w") as out:
                for part in _sheet(sheets[name], widths):
                    out.write(part.encode())


def column_widths(df: DataFrame, most: int = 60) -> DataFrame:
    """The width of each column for display: its longest value or name, and 4, at most ``most``."""
    longest = df.agg(*(F.coalesce(F.max(F.length(F.col(c).cast("string"))), F.lit(0)).alias(c) for c in df.columns))
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.least(F.greatest(F.col(c), F.lit(len(c))) + 4, F.lit(most)).alias("width")) for c in df.columns))
    return longest.select(F.explode(pairs).alias("x")).select("x.*")


def decision_stats(decisions: DataFrame, column: str = "decision") -> DataFrame:
    return decisions.groupBy(column).agg(F.count("*").alias("n"))
