"""CSV files of many layouts in one scan.

Spark's CSV reader applies one header to all files of a scan. Here the files
are read as lines, each line is cut into cells by a quote-aware pattern, and
every line meets the header of its own file by a join on the file: the
headers are a dictionary of one row per file, found by an aggregate with a
partial step. No job runs while the plan is built, and thousands of small
files are one scan whose splits hold many files each.

A line holds a whole record: a quoted cell that goes on in the next line is
an error, not a wrong row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A quoted cell (quotes within it are doubled) or a plain one, up to its comma.
_CELL = r'(?:^|(?<=,))("[^"]*+(?:""[^"]*+)*+"(?=,)|[^,]*+),'
FILE, POS, CELLS, NAMES = "_file", "_pos", "_cells", "_names"


def csv_cells(line: Column) -> Column:
    """The cells of a CSV line; empty unquoted cells are null."""
    raw = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(_CELL), F.lit(1))

    def cell(c: Column) -> Column:
        open_ = c.startswith('"') & ~((F.length(c) > 1) & c.endswith('"'))
        quoted = F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
        broken = F.raise_error(F.concat(F.lit("a quoted cell does not end in its line: "), line)).cast("string")
        return F.when(c == "", F.lit(None)).when(open_, broken).when(c.startswith('"'), quoted).otherwise(c)

    return F.transform(raw, cell)


def _read_text(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The lines of some files. Files of one folder are read as that folder with
    a name filter, which takes one listing; as many paths they would take a
    job while the plan is built."""
    paths = list(paths)
    folders = {p.rpartition("/")[0] for p in paths}
    names = [p.rpartition("/")[2] for p in paths]
    folder = next(iter(folders))
    if len(folders) == 1 and folder and not set("*?[{") & set(folder) and (len(names) > 1 or set("*?") & set(names[0])):
        if all(re.fullmatch(r"[\w.*?-]+", n) for n in names):
            return spark.read.option("pathGlobFilter", names[0] if len(names) == 1 else "{" + ",".join(names) + "}").text(folder)
    return spark.read.text(paths)


def scan_cells(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(_file, _pos, _cells)`` of every line that is not empty; ``_pos``
    orders the lines of a file."""
    lines = _read_text(spark, paths).where(F.col("value") != "")
    position = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    text = F.regexp_replace("value", "^\\x{FEFF}", "")
    return lines.select(F.col("_metadata.file_path").alias(FILE), position.alias(POS), csv_cells(text).alias(CELLS))


def with_headers(rows: DataFrame, normalise: Callable[[Column], Column], is_header: Column | None = None) -> DataFrame:
    """The data lines with the normalised names of their own file's header.

    The header is a file's first line, or its first line for which
    ``is_header`` holds; such lines are no data. A file without a header has
    null ``_names``. Of equal names the first one counts.
    """
    headers = rows if is_header is None else rows.where(is_header)
    names = F.transform(CELLS, lambda c: F.coalesce(normalise(c), F.lit("")))
    headers = headers.groupBy(FILE).agg(F.min_by(names, POS).alias(NAMES), F.min(POS).alias("_header"))
    data = rows.join(headers, FILE, "left")
    if is_header is None:
        return data.where(F.col(POS) != F.col("_header")).drop("_header")
    return data.where(~F.coalesce(is_header, F.lit(False))).drop("_header")


def cell(name: str) -> Column:
    """A data line's cell under a header name; null where either is missing."""
    at = F.array_position(NAMES, F.lit(name)).cast("int")
    return F.when(at > 0, F.try_element_at(CELLS, at))


def file_name(suffix: str = ".csv") -> Column:
    """The file's name without ``suffix``."""
    name = F.url_decode(F.regexp_extract(FILE, "[^/]*$", 0))
    return F.regexp_extract(name, "^(.*)" + suffix.replace(".", r"\.") + "$", 1)
