"""String helpers: literal search, initials, id-derived display names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: display names and fallback classes,
# picked by (number - 1) mod list length, where number is the id's numeric part.
DISPLAY_NAMES = [
    "Aarav Sharma", "Priya Patel", "Rahul Gupta", "Anjali Singh", "Vikram Reddy",
    "Sanya Iyer", "Arjun Nair", "Meera Joshi", "Rohan Verma", "Kavya Menon",
    "Dev Malhotra", "Isha Rao", "Aditya Kumar", "Pooja Bhat", "Karan Mishra",
    "Sneha Das", "Harsh Agarwal", "Riya Thakur", "Nikhil Pandey", "Divya Chauhan",
]
FALLBACK_CLASSES = ["6A", "6B", "7A", "7B", "8A", "8B", "9A", "9B", "10A", "10B"]


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def id_number(id_col: Column | str) -> Column:
    """Numeric part of an id: the id itself if integral, else the text after the last '_'."""
    c = _c(id_col)
    return F.coalesce(c.cast("string").try_cast("bigint"),
                      F.substring_index(c.cast("string"), "_", -1).try_cast("bigint"))


def _pick(id_col, values: list[str]) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    idx = F.pmod(id_number(id_col) - 1, F.lit(len(values)))
    return F.element_at(arr, (idx + 1).cast("int"))


def name_from_id(id_col: Column | str, names: list[str] = DISPLAY_NAMES) -> Column:
    """Display name = names[(number - 1) mod len(names)]."""
    return _pick(id_col, names)


def class_from_id(id_col: Column | str, classes: list[str] = FALLBACK_CLASSES) -> Column:
    """Fallback class = classes[(number - 1) mod len(classes)]."""
    return _pick(id_col, classes)


def contains_literal(col: Column | str, text: str) -> Column:
    """Case-insensitive literal substring test (no LIKE wildcards)."""
    return F.lower(_c(col).cast("string")).contains(F.lit(text.lower()))


def initials(name: Column | str) -> Column:
    """First letter of each space-separated word, at most two."""
    words = F.split(_c(name), " ")
    letters = F.transform(words, lambda w: F.substring(w, 1, 1))
    return F.substring(F.array_join(letters, ""), 1, 2)
