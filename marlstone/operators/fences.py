"""Tables of claims and facts that pages carry between marker lines: reading and rewriting them.

A fence is ``<!-- name -->``, a pipe table whose first cell is a row number, and ``<!-- /name -->``. A
struck-through cell means that its row holds no more. All are expressions over the page's text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _body(text: Column, name: str) -> Column:
    return F.regexp_extract(text, rf"(?s)<!-- {name} -->\r?\n(.*?)<!-- /{name} -->", 1)


def rows(df: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """(key, row_num, cells, active): the rows of each page's fence; heads and rules are no rows."""
    found = df.select(key, F.explode(F.split(_body(F.col(text), name), r"\r?\n")).alias("line")).where(F.col("line").rlike(r"^\|\s*\d+\s*\|"))
    # a bar behind a backslash belongs to its cell
    cells = F.transform(F.split(F.regexp_replace(F.regexp_replace("line", r"^\||\|\s*$", ""), r"\\\|", "\u0001"), r"\|"), lambda c: F.replace(F.trim(c), F.lit("\u0001"), F.lit("|")))
    bare = F.transform(F.slice("c", 2, 100), lambda c: F.regexp_replace(c, r"^~~(.*)~~$", "$1"))
    struck = F.exists(F.slice("c", 2, 100), lambda c: c.rlike(r"^~~.*~~$"))
    return found.select(key, cells.alias("c")).select(key, F.col("c")[0].cast("int").alias("row_num"), bare.alias("cells"), (~struck).alias("active"))


def line_of(row: Column, *cells: Column) -> Column:
    """A row's line; bars in cells are escaped."""
    out = [F.lit("| "), row.cast("string")]
    for cell in cells:
        out += [F.lit(" | "), F.replace(F.coalesce(cell.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))]
    return F.concat(*out, F.lit(" |"))


def fence_of(lines: Column, name: str, head: str) -> Column:
    """A fence with rows (an array of lines) under a head."""
    width = head.count("|") - 1
    return F.concat(F.lit(f"<!-- {name} -->\n{head}\n|{'---|' * width}\n"), F.array_join(lines, "\n"), F.when(F.size(lines) > 0, "\n").otherwise(""), F.lit(f"<!-- /{name} -->"))


def struck(text: Column, row: Column) -> Column:
    """The text with the second cell of a row struck through; a row that is struck stays so."""
    pattern = F.concat(F.lit(r"(?m)^\| *"), row.cast("string"), F.lit(r" *\| *(?!~~)((?:[^|\\\n]|\\.)*?) *\|"))
    return F.regexp_replace(text, pattern, F.concat(F.lit("| "), row.cast("string"), F.lit(r" | ~~$1~~ |")))


def put_row(text: Column, name: str, row: Column, line: Column) -> Column:
    """The text with a row's line replaced, or added as the last one."""
    pattern = F.concat(F.lit(r"(?m)^\| *"), row.cast("string"), F.lit(r" *\|.*$"))
    safe = F.regexp_replace(line, r"([\\$])", r"\\$1")
    added = F.regexp_replace(text, F.lit(f"<!-- /{name} -->"), F.concat(safe, F.lit(f"\n<!-- /{name} -->")))
    return F.when(F.regexp_like(text, pattern), F.regexp_replace(text, pattern, safe)).otherwise(added)


def superseded(text: Column, name: str, old: Column, new: Column, line: Column) -> Column:
    """The text with the old row struck and the new one added."""
    return put_row(struck(text, old), name, new, line)


def appended(text: Column, section: str, lines: Column) -> Column:
    """The text with lines added at the end of the table under a heading; without that heading they come under a new one at the end."""
    heading = rf"(?s)(## {section}\n+(?:\|[^\n]*\n)+)"
    block = F.concat(F.array_join(lines, "\n"), F.lit("\n"))
    has = F.regexp_like(text, F.lit(heading))
    safe = F.regexp_replace(block, r"([\\$])", r"\\$1")
    return F.when(has, F.regexp_replace(text, F.lit(heading), F.concat(F.lit("$1"), safe))).otherwise(F.concat(text, F.lit(f"\n\n## {section}\n\n"), block))
