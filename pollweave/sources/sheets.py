"""Workbooks (.xlsx) as a Spark data source, read and written with the standard library.

``spark.read.format("sheets").option("path", file)`` gives ``session, row_no, cells map<string,string>``
with one partition per sheet; options ``sheet`` (one name) and ``which`` (``last`` or ``first``) prune
sheets before they are read. ``df.write.format("sheets")`` stages each task's rows and writes one workbook.
"""

from __future__ import annotations

import csv
import os
import re
import shutil
import uuid
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def sheet_names(path: str) -> list[tuple[str, str]]:
    """``(name, member)`` of the sheets of a workbook in file order."""
    with zipfile.ZipFile(path) as z:
        book = ET.fromstring(z.read("xl/workbook.xml"))
        rel = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    return [(s.get("name"), "xl/" + rel[s.get(_R + "id")].lstrip("/").removeprefix("xl/")) for s in book.iter(_M + "sheet")]


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def sheet_rows(path: str, member: str) -> Iterator[list[str | None]]:
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(_M + "t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(_M + "si")]
        with z.open(member) as f:
            for _, el in ET.iterparse(f):
                if el.tag != _M + "row":
                    continue
                row: list[str | None] = []
                for i, c in enumerate(el.iter(_M + "c")):
                    at = _column(c.get("r")) if c.get("r") else i
                    row += [None] * (at + 1 - len(row))
                    kind, v = c.get("t"), c.find(_M + "v")
                    if kind == "inlineStr":
                        row[at] = "".join(t.text or "" for t in c.iter(_M + "t"))
                    elif v is not None and v.text is not None:
                        row[at] = shared[int(v.text)] if kind == "s" else v.text
                yield row
                el.clear()


def headers(row: list[str | None]) -> list[str]:
    """Trimmed header names; a repeated one gets a number, as ``x.1``."""
    seen: dict[str, int] = {}
    out = []
    for i, h in enumerate(row):
        h = (h or f"column{i + 1}").strip()
        n = seen.get(h, 0)
        seen[h] = n + 1
        out.append(f"{h}.{n}" if n else h)
    return out


class _Sheet(InputPartition):
    def __init__(self, name: str, member: str):
        super().__init__(None)
        self.name, self.member = name, member


class SheetReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.sheet, self.which = options.get("sheet"), options.get("which")

    def partitions(self) -> list[_Sheet]:
        names = sheet_names(self.path)
        if self.sheet is not None:
            names = [x for x in names if x[0] == self.sheet]
        if self.which in ("first", "last"):
            names = names[:1] if self.which == "first" else names[-1:]
        return [_Sheet(*x) for x in names]

    def read(self, partition: _Sheet):
        head = None
        for n, row in enumerate(sheet_rows(self.path, partition.member)):
            if head is None:
                head = headers(row)
                continue
            cells = {h: v for h, v in zip(head, row, strict=False) if v is not None}
            if cells:
                yield partition.name, n, cells


class _Staged(WriterCommitMessage):
    def __init__(self, folder: str, sizes: dict[str, tuple[str, int]]):
        self.folder, self.sizes = folder, sizes  # sheet -> file and its bytes


class SheetWriter(DataSourceWriter):
    """Tasks stage their rows, a file for each sheet, in a folder beside the workbook; the driver joins them.

    The folder of the workbook must therefore be one that all executors and the driver share: the driver checks that
    it sees every staged file whole and refuses to write a workbook if it does not.
    """

    def __init__(self, options: dict, schema):
        self.path = options["path"]
        self.columns = [f.name for f in schema.fields]
        self.at = self.columns.index(options.get("sheetcolumn", "session"))
        self.folder = f"{self.path}.staged-{uuid.uuid4().hex}"

    def write(self, rows) -> _Staged:
        os.makedirs(self.folder, exist_ok=True)
        files: dict[str, tuple] = {}
        try:
            for r in rows:
                sheet = "" if r[self.at] is None else str(r[self.at])
                if sheet not in files:
                    name = os.path.join(self.folder, uuid.uuid4().hex)
                    f = open(name, "w", newline="", encoding="utf-8")  # noqa: SIM115 - closed below
                    files[sheet] = (name, f, csv.writer(f))
                files[sheet][2].writerow(["" if v is None else v for v in r])
        finally:
            for _, f, _ in files.values():
                f.close()
        return _Staged(self.folder, {s: (n, os.path.getsize(n)) for s, (n, *_) in files.items()})

    def _rows(self, messages: list[_Staged], sheet: str) -> Iterator[list[str]]:
        for m in messages:
            if sheet in m.sizes:
                with open(m.sizes[sheet][0], newline="", encoding="utf-8") as f:
                    yield from csv.reader(f)

    def commit(self, messages: list[_Staged]) -> None:
        messages = [m for m in messages if m is not None]
        for m in messages:
            for file, size in m.sizes.values():
                if not os.path.exists(file) or os.path.getsize(file) != size:
                    raise OSError(f"{file} was staged by a task but is not seen here: {os.path.dirname(self.path)} must be shared by all nodes")
        names = sorted({s for m in messages for s in m.sizes}, key=lambda s: (int(m.group()) if (m := re.match(r"\d+", s)) else 1 << 60, s))
        main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
        office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        with zipfile.ZipFile(self.path, "w", zipfile.ZIP_DEFLATED) as z:
            kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(len(names)))
            z.writestr("[Content_Types].xml", f'<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
            z.writestr("_rels/.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i + 1}" Type="{office}/worksheet" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(names))) + "</Relationships>")
            z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>' + "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{i + 1}" r:id="r{i + 1}"/>' for i, n in enumerate(names)) + "</sheets></workbook>")
            for i, name in enumerate(names):
                with z.open(f"xl/worksheets/sheet{i + 1}.xml", "w") as f:
                    line = lambda vs: ("<row>" + "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' if v != "" else "<c/>" for v in vs) + "</row>").encode()
                    f.write(f'<worksheet xmlns="{main}"><sheetData>'.encode())
                    keep = [j for j in range(len(self.columns)) if j != self.at]
                    f.write(line([self.columns[j] for j in keep]))
                    for r in self._rows(messages, name):
                        f.write(line([r[j] for j in keep]))
                    f.write(b"</sheetData></worksheet>")
        self.abort(messages)

    def abort(self, messages: list[_Staged]) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)


class Sheets(DataSource):
    """The data source ``sheets``."""

    @classmethod
    def name(cls) -> str:
        return "sheets"

    def schema(self) -> str:
        return "session string, row_no int, cells map<string,string>"

    def reader(self, schema) -> SheetReader:
        return SheetReader(self.options)

    def writer(self, schema, overwrite: bool) -> SheetWriter:
        if os.path.exists(self.options["path"]) and not overwrite:
            raise FileExistsError(self.options["path"])
        return SheetWriter(self.options, schema)


def workbook(spark: SparkSession, path: str, columns: dict[str, str], **options: str) -> DataFrame:
    """A workbook's sheets as one table: ``session`` and the given columns with their types; a sheet that
    lacks a column has nulls there, text that is no value of the type becomes null."""
    spark.dataSource.register(Sheets)
    d = spark.read.format("sheets").options(path=path, **options).load()
    return d.select("session", *[F.try_element_at("cells", F.lit(c)).try_cast(t).alias(c) for c, t in columns.items()])
