"""Names, labels and short forms of text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_LIMIT = 63


def safe_name(header: str) -> str:
    """A SQL-safe identifier for a column header."""
    name = re.sub("[^a-z0-9]+", "_", header.replace("﻿", "").strip().lower()).strip("_") or "col"
    return (f"c_{name}" if name[0].isdigit() else name)[:NAME_LIMIT]


def safe_names(headers: list[str]) -> list[str]:
    """Safe names of all headers; the second of two that collide gets _2, the next _3."""
    out: list[str] = []
    for header in headers:
        name, n = safe_name(header), 2
        unique = name
        while unique in out:
            unique, n = f"{name}_{n}", n + 1
        out.append(unique)
    return out


def safe_name_column(header: Column) -> Column:
    name = F.regexp_replace(F.lower(F.trim(F.replace(header, F.lit("﻿"), F.lit("")))), "[^a-z0-9]+", "_")
    name = F.regexp_replace(name, "^_+|_+$", "")
    name = F.when(name == "", "col").otherwise(name)
    return F.left(F.when(name.rlike("^[0-9]"), F.concat(F.lit("c_"), name)).otherwise(name), F.lit(NAME_LIMIT))


def dataset_name(path: Column) -> Column:
    """Dataset of a file: its name without extension, trailing date and long export number."""
    stem = F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), r"\.[^.]*$", "")
    stem = F.regexp_replace(F.regexp_replace(stem, r"[-_]?\d{4}-\d{2}-\d{2}$", ""), r"[-_]?-?\d{12,}$", "")
    return safe_name_column(stem)


def one_line(text: Column, limit: int = 1000) -> Column:
    """Lines trimmed and joined by one space, blank ones gone, cut with an ellipsis."""
    lines = F.filter(F.transform(F.split(text, r"\r\n|\r|\n"), lambda x: F.trim(x)), lambda x: x != "")
    flat = F.array_join(lines, " ")
    return F.when(F.length(flat) > limit, F.concat(F.left(flat, F.lit(limit - 1)), F.lit("…"))).otherwise(flat)


def label(column: str) -> str:
    if column.endswith("_masked"):
        return column.removesuffix("_masked").replace("_", " ") + " (masked)"
    return column.replace("_", " ")


def tile_label(column: str, limit: int = 12) -> str:
    text = label(column).upper()
    return text if len(text) <= limit else text[:limit - 1] + "…"


def number(value: float | None) -> str:
    """Thousands separated, one decimal, none if it is zero; a dash for nothing."""
    if value is None:
        return "—"
    return f"{int(value):,}" if float(value) == int(value) else f"{float(value):,.1f}"


def number_column(value: Column) -> Column:
    whole = value == F.floor(value)
    return F.when(value.isNull(), "—").when(whole, F.format_number(value, 0)).otherwise(F.format_number(value, 1))
