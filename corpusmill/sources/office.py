"""Text of office files (docx, pptx, xlsx, odt) with the standard library: archives of XML, one file a row.

PDF and scans need programs that are not part of this engine; ``read_documents`` takes further readers for them.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Section = tuple[str, str, str]  # kind, label, text
_SECTIONS = "array<struct<section_no int, kind string, label string, text string>>"


def _name(e) -> str:
    return e.tag.rsplit("}", 1)[-1]


def _texts(e, leaf: str, breaks: tuple[str, ...] = (), tab: str = "tab") -> str:
    out = []
    for x in e.iter():
        n = _name(x)
        if n == leaf and x.text:
            out.append(x.text)
        elif n in breaks:
            out.append("\n")
        elif n == tab:
            out.append(" ")
    return "".join(out).strip()


def _rows(table, row: str, cell: str, text: Callable) -> str:
    lines = []
    for r in table.iter():
        if _name(r) == row:
            cells = [" ".join(text(c).split()) for c in r if _name(c) == cell]
            if any(cells):
                lines.append(" ".join(c for c in cells if c))
    return "\n".join(lines)


def _blocks(found: list[tuple[str, str]]) -> list[Section]:
    """Sections from (kind, text) blocks in order; a heading opens one and is its label."""
    out: list[Section] = []
    label, parts = "", []
    for kind, text in [*found, ("heading", "")]:
        if kind == "heading":
            if parts or label:
                out.append(("section", label, "\n".join([*([label] if label else []), *parts])))
            label, parts = text, []
        elif text:
            parts.append(text)
    return out


def docx(data: bytes) -> list[Section]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml"))
        found = []
        for b in next(e for e in body.iter() if _name(e) == "body"):
            if _name(b) == "p":
                style = next((v for e in b.iter() if _name(e) == "pStyle" for k, v in e.attrib.items() if k.endswith("val")), "")
                found.append(("heading" if style.lower().startswith("heading") else "text", _texts(b, "t", ("br", "cr"))))
            elif _name(b) == "tbl":
                found.append(("text", _rows(b, "tr", "tc", lambda c: _texts(c, "t"))))
        edges = [_texts(ElementTree.fromstring(z.read(n)), "t") for n in sorted(z.namelist()) if re.fullmatch(r"word/(header|footer)\d*\.xml", n)]
    edges = list(dict.fromkeys(filter(None, edges)))
    return [*_blocks(found), *([("header_footer", "", "\n".join(edges))] if edges else [])]


def odt(data: bytes) -> list[Section]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("content.xml"))
    found = []
    plain = lambda e: " ".join("".join(e.itertext()).split())

    def walk(e) -> None:
        for b in e:
            n = _name(b)
            if n == "h":
                found.append(("heading", plain(b)))
            elif n == "p":
                found.append(("text", plain(b)))
            elif n == "table":
                found.append(("text", _rows(b, "table-row", "table-cell", plain)))
            else:
                walk(b)

    walk(next(e for e in root.iter() if _name(e) == "text"))
    return _blocks(found)


def _numbered(names: list[str], pattern: str) -> list[str]:
    hits = [(int(m.group(1)), n) for n in names if (m := re.fullmatch(pattern, n))]
    return [n for _, n in sorted(hits)]


def pptx(data: bytes) -> list[Section]:
    out = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        for k, n in enumerate(_numbered(names, r"ppt/slides/slide(\d+)\.xml"), 1):
            parts = [_texts(p, "t", ("br",)) for p in ElementTree.fromstring(z.read(n)).iter() if _name(p) == "p"]
            number = re.search(r"\d+", n.rsplit("/", 1)[1]).group()
            notes = f"ppt/notesSlides/notesSlide{number}.xml"
            if notes in names:
                parts += [_texts(p, "t", ("br",)) for p in ElementTree.fromstring(z.read(notes)).iter() if _name(p) == "p"]
            if text := "\n".join(filter(None, parts)):
                out.append(("slide", f"Slajd {k}", text))
    return out


def xlsx(data: bytes) -> list[Section]:
    out = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        shared = [_texts(e, "t") for e in ElementTree.fromstring(z.read("xl/sharedStrings.xml")) if _name(e) == "si"] if "xl/sharedStrings.xml" in names else []
        titles = [e.attrib.get("name", "") for e in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if _name(e) == "sheet"]
        for k, n in enumerate(_numbered(names, r"xl/worksheets/sheet(\d+)\.xml")):
            lines = []
            for r in ElementTree.fromstring(z.read(n)).iter():
                if _name(r) != "row":
                    continue
                cells = []
                for c in r:
                    value = next((e for e in c if _name(e) == "v"), None)
                    inline = next((e for e in c if _name(e) == "is"), None)
                    formula = next((e for e in c if _name(e) == "f"), None)
                    if inline is not None:
                        cells.append(_texts(inline, "t"))
                    elif value is not None and value.text is not None:
                        cells.append(shared[int(value.text)] if c.attrib.get("t") == "s" else value.text)
                    else:
                        cells.append(f"={formula.text}" if formula is not None and formula.text else "")
                while cells and not cells[-1].strip():
                    cells.pop()
                if cells:
                    lines.append(" ".join(x.strip() for x in cells if x.strip()))
            if lines:
                out.append(("worksheet", titles[k] if k < len(titles) else f"Arkusz {k + 1}", "\n".join(lines)))
    return out


def pdf(pages: Callable[[bytes], list[str | Exception]] | None = None, least_chars: int = 20) -> Callable[[bytes], list[Section]]:
    """A reader of PDF files for ``read_documents``, a section a page. ``pages`` gives the text of each page, or the error that it met, which
    costs that page only; without it, the pypdf package is used where it is installed. A file of fewer than ``least_chars``
    characters has no text of its own: it needs recognition, and is reported as failed with that reason."""

    def installed(data: bytes) -> list[str | Exception]:
        import pypdf  # not part of the engine

        doc = pypdf.PdfReader(io.BytesIO(data))
        if doc.is_encrypted:
            doc.decrypt("")
        out: list[str | Exception] = []
        for page in doc.pages:
            try:
                out.append(page.extract_text() or "")
            except Exception as e:  # noqa: BLE001  one page fails alone
                out.append(e)
        return out

    def read(data: bytes) -> list[Section]:
        found = (pages or installed)(data)
        texts = [("page", f"Strona {n}", t.strip()) for n, t in enumerate(found, 1) if isinstance(t, str) and t.strip()]
        if sum(len(t) for _, _, t in texts) < least_chars:
            failed = sum(isinstance(t, Exception) for t in found)
            raise ValueError(f"needs_ocr: {len(found)} pages, {failed} unreadable")
        return texts

    return read


def recognized(images: Callable[[bytes], list[bytes]], recognize: Callable[[bytes], str], least_chars: int = 20) -> Callable[[bytes], list[Section]]:
    """A reader of scanned files: ``images`` gives a picture of each page in order, ``recognize`` its text; both are programs outside the
    engine. A file of fewer than ``least_chars`` characters fails as ocr_failed."""

    def read(data: bytes) -> list[Section]:
        texts = [("page", f"Strona {n}", recognize(image).strip()) for n, image in enumerate(images(data), 1)]
        if sum(len(t) for _, _, t in texts) < least_chars:
            raise ValueError(f"ocr_failed: {len(texts)} pages")
        return [s for s in texts if s[2]]

    return read


def first_that_reads(*readers: Callable[[bytes], list[Section]]) -> Callable[[bytes], list[Section]]:
    """A reader that tries others in order (say, converters of old formats) and fails with the last one's error."""

    def read(data: bytes) -> list[Section]:
        for k, reader in enumerate(readers):
            try:
                return reader(data)
            except Exception:
                if k + 1 == len(readers):
                    raise
        raise ValueError("no reader")

    return read


READERS: dict[str, Callable[[bytes], list[Section]]] = {"docx": docx, "odt": odt, "pptx": pptx, "xlsx": xlsx}


def read_documents(files: DataFrame, readers: dict[str, Callable[[bytes], list[Section]]] | None = None, most_bytes: int = 30_000_000) -> DataFrame:
    """(path, extension, content_sha256, status, error, text, sections) of ``binaryFile`` rows.

    status: ok, empty_text, too_large, failed (unreadable, or no reader for the extension). One file fails alone.
    """
    known = {**READERS, **(readers or {})}
    rows = files.select("path", F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("extension"), F.sha2("content", 256).alias("content_sha256"), "content")

    def run(batches):
        for batch in batches:
            status, errors, texts, sections = [], [], [], []
            for ext, data in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                found: list[Section] = []
                error = None
                if len(data) > most_bytes:
                    state = "too_large"
                elif ext not in known:
                    state, error = "failed", f"no reader for {ext}"
                else:
                    try:
                        found = known[ext](data)
                        state = "ok" if sum(len(s[2]) for s in found) >= 5 else "empty_text"
                    except Exception as e:  # a broken file must not end the job
                        state, error = "failed", f"{type(e).__name__}: {e}"[:300]
                status.append(state)
                errors.append(error)
                texts.append("\n\n".join(s[2] for s in found))
                sections.append([{"section_no": i, "kind": k, "label": lab, "text": t} for i, (k, lab, t) in enumerate(found)])
            kind = pa.list_(pa.struct([("section_no", pa.int32()), ("kind", pa.string()), ("label", pa.string()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(status, pa.string()), pa.array(errors, pa.string()), pa.array(texts, pa.string()), pa.array(sections, kind)],
                names=["path", "extension", "content_sha256", "status", "error", "text", "sections"],
            )

    return rows.mapInArrow(run, f"path string, extension string, content_sha256 string, status string, error string, text string, sections {_SECTIONS}")
