"""Pipe tables: discovery in text, parsing, filtering, rendering. Lines and cells are arrays inside their row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import rsub

SEPARATOR = r"^[ \t]*\|?[ \t]*:?-+:?[ \t]*(\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*$"


def is_separator(line: Column) -> Column:
    return F.contains(line, F.lit("-")) & F.contains(line, F.lit("|")) & line.rlike(SEPARATOR)


def cells(line: Column) -> Column:
    """Cells of a row, one leading and one closing pipe dropped, blanks around them trimmed."""
    inner = rsub(rsub(F.trim(line), r"^\|", ""), r"\|$", "")
    return F.transform(F.split(inner, r"\|", -1), lambda x: F.trim(x))


def headers_of(raw: Column) -> Column:
    """Names of columns: a placeholder for an empty one, a counted suffix for a repeated one."""
    named = F.transform(raw, lambda h, i: F.when(h == "", F.concat(F.lit("col_"), (i + 1).cast("string"))).otherwise(h))
    return F.transform(named, lambda h, i: F.concat(h, F.when(F.size(F.filter(F.slice(named, F.lit(1), i), lambda x: x == h)) > 0, F.concat(F.lit("_"), F.size(F.filter(F.slice(named, F.lit(1), i), lambda x: x == h)).cast("string"))).otherwise("")))


def parse_tables(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, headers, body): the pipe table of a text; rows are padded or cut to the headers. Others give no row.

    A table is a header line, a separator line and at least one row; it ends at the first line without a pipe.
    """
    lines = F.transform(F.split(rsub(F.col(text), r"^\s+|\s+\z", ""), "\n"), lambda x: rsub(x, r"[\r]+$", ""))
    t = df.select(key, lines.alias("lines")).where(F.size("lines") >= 3)
    t = t.withColumn("at", F.expr("array_position(transform(lines, x -> if(" + _separator_sql("x") + ", 1, 0)), 1)").cast("int")).where("at >= 2")
    t = t.withColumn("headers", headers_of(cells(F.element_at("lines", F.col("at") - 1))))
    rest = F.slice("lines", F.col("at") + 1, F.size("lines"))
    t = t.withColumn("rest", F.filter(rest, lambda x: F.trim(x) != ""))
    stop = F.expr("array_position(transform(rest, x -> if(contains(x, '|'), 1, 0)), 0)").cast("int")
    t = t.withColumn("rest", F.when(stop > 0, F.slice("rest", F.lit(1), stop - 1)).otherwise(F.col("rest")))
    t = t.withColumn("rest", F.filter("rest", lambda x: ~is_separator(x)))
    width = F.size("headers")
    t = t.withColumn("rows", F.transform("rest", cells))
    pad = lambda r: F.concat(F.slice(r, F.lit(1), width), F.array_repeat(F.lit(""), F.greatest(width - F.size(r), F.lit(0))))
    body = F.transform("rows", pad)
    return t.withColumn("body", body).where(F.size("body") > 0).select(key, "headers", "body")


def _separator_sql(x: str) -> str:
    return f"contains({x}, '-') and contains({x}, '|') and {x} rlike '{SEPARATOR.replace(chr(92), chr(92) * 2)}'"


def filter_tables(tables: DataFrame, min_rows: int = 2, min_cols: int = 2) -> DataFrame:
    return tables.where((F.size("body") >= min_rows) & (F.size("headers") >= min_cols))


def table_cells(tables: DataFrame, key: str) -> DataFrame:
    """Long form: (key, row, col, header, value), counted from 0."""
    rows = tables.select(key, "headers", F.posexplode("body").alias("row", "values"))
    return rows.select(key, "row", F.posexplode(F.arrays_zip("headers", "values")).alias("col", "x")).select(key, "row", "col", F.col("x.headers").alias("header"), F.col("x.values").alias("value"))


def render(tables: DataFrame, key: str) -> DataFrame:
    """(key, markdown): the table as a pipe table again."""
    line = lambda c: F.concat(F.lit("| "), F.array_join(c, " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.array_join(F.transform("headers", lambda _: F.lit(" --- ")), "|"), F.lit("|"))
    return tables.select(key, F.concat_ws("\n", line(F.col("headers")), rule, F.array_join(F.transform("body", line), "\n")).alias("markdown"))


def to_csv(tables: DataFrame, key: str) -> DataFrame:
    """(key, csv): quoted where needed, rows end in CR LF."""
    q = lambda c: F.when(c.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    line = lambda c: F.array_join(F.transform(c, q), ",")
    return tables.select(key, F.concat(F.array_join(F.concat(F.array(line(F.col("headers"))), F.transform("body", line)), "\r\n"), F.lit("\r\n")).alias("csv"))
