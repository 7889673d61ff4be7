"""Column functions over posix paths. No UDF: split, fold and join stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dirname(path: Column) -> Column:
    """The folder of a path without the closing slash; empty for a bare name."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.lit(""))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def normalize(path: Column) -> Column:
    """Resolve ``.``, ``..`` and empty parts. A ``..`` above the top is dropped. Null stays null."""
    empty = F.array().cast("array<string>")
    parts = F.aggregate(
        F.split(path, "/"),
        empty,
        lambda acc, x: F.when((x == "") | (x == "."), acc)
        .when((x == "..") & (F.size(acc) > 0), F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(x == "..", acc)
        .otherwise(F.concat(acc, F.array(x))),
    )
    return F.array_join(parts, "/")


def resolve(file: Column, target: Column) -> Column:
    """``target`` as seen from the folder of ``file``; a target that begins with a slash starts at the top."""
    joined = F.when(target.startswith("/"), target).otherwise(F.concat(dirname(F.coalesce(file, F.lit(""))), F.lit("/"), target))
    return normalize(joined)


def relative(from_path: Column, to_path: Column) -> Column:
    """The link from one file to another: ``..`` for each folder below the common one, then the rest of the target."""
    a = F.slice(F.split(from_path, "/"), F.lit(1), F.size(F.split(from_path, "/")) - 1)
    b = F.split(to_path, "/")
    n = F.least(F.size(a), F.size(b) - 1)
    same = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x == y)
    common = F.aggregate(
        same,
        F.struct(F.lit(0).alias("k"), F.lit(True).alias("go")),
        lambda acc, x: F.struct((acc["k"] + F.when(acc["go"] & x, 1).otherwise(0)).alias("k"), (acc["go"] & x).alias("go")),
        lambda acc: acc["k"],
    )
    ups = F.array_repeat(F.lit(".."), F.size(a) - common)
    return F.array_join(F.concat(ups, F.slice(b, common + 1, F.size(b) - common)), "/")
