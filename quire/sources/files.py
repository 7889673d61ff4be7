"""File sources and sinks: converted archives, Markdown folders, documents to register, notes to write."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import paths, text
from quire.operators import markdown


def documents(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(source_id, path, sha256, n_bytes) of the files below a path; any file system Spark can read."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    stem = F.regexp_replace(paths.basename(F.col("path")), r"\.[^.]*$", "")
    return b.select(text.source_slug(stem).alias("source_id"), "path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("n_bytes"))


def register(found: DataFrame, known: DataFrame) -> DataFrame:
    """The files that are new or whose content changed."""
    return found.join(known.select("source_id", "sha256"), ["source_id", "sha256"], "left_anti")


def markdown_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of the Markdown files below a path, one row a file."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(path)
    return b.select("path", F.expr("make_valid_utf8(cast(content as string))").alias("text"))


def _unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows: list[tuple[str, str, str | None, bytes | None]] = []
        for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
            try:
                z = zipfile.ZipFile(io.BytesIO(content))
            except zipfile.BadZipFile:
                rows.append((path, "", "bad archive", None))
                continue
            for name in z.namelist():
                if name.endswith("/") or ".." in name.split("/"):
                    continue
                data = z.read(name)
                is_text = name.endswith((".md", ".json"))
                rows.append((path, name, data.decode("utf-8", "replace") if is_text else None, None if is_text else data))
        cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.binary())], names=["path", "entry", "text", "data"])


def archive_entries(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    """(path, entry, text, data) of every file in every archive; entries that climb out of it are left out.

    Text entries decode with replacement; a file that is no archive gives one row with an empty entry.
    """
    b = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return b.select("path", "content").mapInArrow(_unzip, "path string, entry string, text string, data binary")


def archive_markdown(entries: DataFrame) -> DataFrame:
    """(path, text): ``content.md`` of each archive, else its first Markdown file by name; blank ones are left out."""
    md = entries.where(F.col("entry").endswith(".md"))
    best = md.groupBy("path").agg(F.min_by("text", F.struct((F.col("entry") != "content.md").alias("o"), "entry")).alias("text"))
    return best.where(F.length(F.trim("text")) > 0)


def archive_assets(entries: DataFrame) -> DataFrame:
    """The images directly below ``assets``."""
    return entries.where(F.col("entry").rlike("^assets/[^/]+$")).select("path", F.substring_index("entry", "/", -1).alias("name"), "data")


def render_notes(sections: DataFrame) -> DataFrame:
    """(path, content): front matter in a fixed order, the title, and the text without it, or a placeholder.

    ``sections``: path, pdf_path, sha256, source_id, section_id, level, pages, parent_id, printed pages, title, text.
    Printed pages are listed only where known; a null title is an empty one.
    """
    q = lambda c: F.when(c.isNull(), F.lit("null")).when(c.rlike(r"^[A-Za-z]([A-Za-z0-9 /_.():-]*[A-Za-z0-9)])?$") & ~F.contains(c, F.lit(": ")) & ~F.lower(c).isin("null", "true", "false", "yes", "no", "on", "off", "y", "n"), c).otherwise(F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')))
    num = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    line = lambda k, c: F.concat(F.lit(k + ": "), c)
    ref = F.concat(paths.basename(F.col("pdf_path")), F.lit(" (sha256:"), F.left("sha256", F.lit(16)), F.lit(")"))
    printed = [F.when(F.col(c).isNotNull(), line(c, q(F.col(c)))) for c in ("printed_page_start", "printed_page_end")]
    head = F.concat_ws(
        "\n", F.lit("---"), line("source_pdf", q(ref)), line("source_pdf_id", q(F.col("source_id"))), line("section_id", q(F.col("section_id"))), line("level", num(F.col("level"))),
        line("pdf_page_start", num(F.col("pdf_page_start"))), line("pdf_page_end", num(F.col("pdf_page_end"))), line("parent_section_id", q(F.nullif("parent_id", F.lit("")))), F.lit("aliases: []"), F.lit("tags:\n- rulebook\n- imported"), *printed, F.lit("---"),
    )
    title = F.coalesce("title", F.lit(""))
    text_ = text.rsub(F.coalesce("text", F.lit("")), r"^\s+|\s+\z", "")
    body = F.when(text_ != "", F.when(title != "", markdown.drop_title_heading(text_, title)).otherwise(text_)).otherwise("> Content extraction not yet populated.")
    return sections.select("path", F.concat(head, F.lit("\n\n# "), title, F.lit("\n\n"), body, F.lit("\n")).alias("content"))


def write_notes(notes: DataFrame, root: str) -> None:
    """One file a note below a folder that all executors share; the files of a task are written by the task."""

    def put(rows) -> None:
        for r in rows:
            at = os.path.join(root, r.path)
            os.makedirs(os.path.dirname(at), exist_ok=True)
            with open(at, "w", encoding="utf-8") as f:
                f.write(r.content)

    notes.foreachPartition(put)


ENGINES: dict[str, Callable[..., DataFrame]] = {}


def register_engine(name: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Decorator: a text engine is a function of a session and a path that gives (path, text)."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        ENGINES[name] = f
        return f

    return add


def engine(name: str, fallback: str | None = None) -> Callable[..., DataFrame]:
    """A registered engine; an unknown one is an error unless a fallback is named."""
    if name not in ENGINES and fallback is None:
        raise KeyError(f"no engine {name!r}; there are {sorted(ENGINES)}")
    return ENGINES.get(name) or ENGINES[fallback]


register_engine("markdown")(markdown_files)
register_engine("archive")(lambda spark, path: archive_markdown(archive_entries(spark, path)))
