"""Text cleaning, generated column names and display labels (SC8, P15)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Policy codes that a display label leaves out.
POLICY_CODES = ("c1m", "c2m", "c3m", "c4m", "c5m", "c6m", "c7m", "c8ev", "h6m", "h7")

NAME_LENGTH = 25

#: What ``str.strip`` takes off.
EDGE_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def clean_text(col: Column | str) -> Column:
    """Trimmed lower-case text; a missing value is spelled ``nan`` so that counts add up."""
    value = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.lower(F.trim(value)), F.lit("nan"))


def safe_name(text: str, prefix: str = "fc_") -> str:
    """Column name for a category: separators become ``_``, punctuation goes, the text part is cut."""
    name = text.strip()
    for separator in (" ", "/"):
        name = name.replace(separator, "_")
    for mark in ("'", '"', ".", "(", ")"):
        name = name.replace(mark, "")
    return prefix + name[:NAME_LENGTH]


def unique_names(texts: Iterable[str], prefix: str = "fc_", taken: Iterable[str] = ()) -> list[str]:
    """``safe_name`` for each text; a clash is resolved by appending ``_2`` until it is free."""
    used, out = set(taken), []
    for text in texts:
        name = safe_name(text, prefix)
        while name in used:
            name += "_2"
        used.add(name)
        out.append(name)
    return out


def underscore_name(text: str) -> str:
    """Column name for a pivoted indicator."""
    return text.strip().replace(" ", "_")


def underscore_expr(col: Column | str) -> Column:
    """``underscore_name`` of a name held in a column."""
    value = F.col(col) if isinstance(col, str) else col
    return F.replace(F.regexp_replace(value, EDGE_BLANKS, ""), F.lit(" "), F.lit("_"))


def label_of(name: str, length: int | None = None) -> str:
    """Display label of a column name, on the driver."""
    label = name.replace("_", " ")
    for code in POLICY_CODES:
        label = label.replace(code + " ", "")
    return label.title() if length is None else label.title()[:length]


def label_expr(col: Column | str, length: int | None = None) -> Column:
    """Display label of a column name held in a column."""
    value = F.col(col) if isinstance(col, str) else col
    spaced = F.translate(value, "_", " ")
    label = F.initcap(F.regexp_replace(spaced, f"({'|'.join(POLICY_CODES)}) ", ""))
    return label if length is None else F.substring(label, 1, length)
