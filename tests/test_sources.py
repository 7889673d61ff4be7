import zipfile

import pytest
from pyspark.sql import functions as F

from quire.sources import files
from quire.streaming import arrivals


@pytest.fixture
def folder(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("z.md", "# other")
        z.writestr("content.md", "# Book")
        z.writestr("assets/p.png", b"\x89PNG")
        z.writestr("assets/deep/q.png", b"x")
        z.writestr("../evil.md", "no")
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    (tmp_path / "PF2e - Core (3rd).pdf").write_bytes(b"%PDF")
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "x.md").write_text("# X\n")
    return tmp_path


def test_archives(spark, folder):
    e = files.archive_entries(spark, str(folder))
    assert {r.entry for r in e.collect()} == {"z.md", "content.md", "assets/p.png", "assets/deep/q.png", ""}
    assert [r.text for r in files.archive_markdown(e).collect()] == ["# Book"]
    assert [(r.name, bytes(r.data)) for r in files.archive_assets(e).collect()] == [("p.png", b"\x89PNG")]
    assert [r.text for r in files.engine("archive")(spark, str(folder)).collect()] == ["# Book"]


def test_registration(spark, folder):
    d = files.documents(spark, str(folder))
    assert [(r.source_id, r.n_bytes) for r in d.collect()] == [("pf2e-core-3rd", 4)]
    assert files.register(d, d).count() == 0 and files.register(d, d.withColumn("sha256", F.lit("x"))).count() == 1


def test_engines(spark, folder):
    assert [r.text for r in files.engine("unknown", fallback="markdown")(spark, str(folder / "n")).collect()] == ["# X\n"]
    with pytest.raises(KeyError):
        files.engine("unknown")


def test_notes(spark, tmp_path):
    cols = "source_id string, section_id string, title string, level int, pdf_page_start int, pdf_page_end int, printed_page_start string, printed_page_end string, text string, path string, pdf_path string, sha256 string, parent_id string"
    book = ("/p/my book.pdf", "0123456789abcdefgh")
    df = spark.createDataFrame([("s", "s/a", 'A "b"', 1, 0, 3, "117", None, "Body", "books/s/a.md", *book, None), ("s", "s/c", "C", 1, 4, 5, None, None, None, "books/s/c.md", *book, "s/a")], cols)
    files.write_notes(files.render_notes(df), str(tmp_path))
    a = (tmp_path / "books/s/a.md").read_text()
    assert a.startswith("---\nsource_pdf: my book.pdf (sha256:0123456789abcdef)\nsource_pdf_id: s\nsection_id: s/a\nlevel: 1\n") and 'printed_page_start: "117"\n---' in a and a.endswith('\n\n# A "b"\n\nBody\n')
    c = (tmp_path / "books/s/c.md").read_text()
    assert "\nparent_section_id: s/a\n" in c and "> Content extraction not yet populated." in c


def test_arrivals_are_handled_once(spark, folder, tmp_path_factory):
    seen, ck = [], str(tmp_path_factory.mktemp("ck"))
    run = lambda: arrivals.run_once(arrivals.arriving(spark, str(folder / "n"), "*.md"), lambda df, i: seen.extend(r.path for r in df.collect()), ck)
    run()
    run()
    (folder / "n" / "y.md").write_text("y")
    run()
    assert [p.rsplit("/", 1)[-1] for p in seen] == ["x.md", "y.md"]
