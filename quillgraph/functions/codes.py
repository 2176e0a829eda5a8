"""Lookup of a diagnosis code's chapter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Each chapter holds the three-digit categories below its bound; the last one is open.
CHAPTER_BOUNDS = [
    ("INFECTIOUS", 140),
    ("NEOPLASMS", 240),
    ("ENDOCRINE", 280),
    ("BLOOD", 290),
    ("MENTAL", 320),
    ("NERVOUS", 390),
    ("CIRCULATORY", 460),
    ("RESPIRATORY", 520),
    ("DIGESTIVE", 580),
    ("GENITOURINARY", 630),
    ("SKIN", 680),
    ("MUSCULOSKELETAL", 740),
    ("CONGENITAL", 800),
    ("INJURY", None),
]


def code_chapter(code: Column) -> Column:
    """Chapter of a code by its first three characters; ``UNK`` if null or empty, ``OTHER`` if not a number."""
    category = F.substring(F.trim(code), 1, 3).try_cast("int")
    chapter = F.when(F.coalesce(F.length(code), F.lit(0)) == 0, "UNK").when(category.isNull(), "OTHER")
    for name, bound in CHAPTER_BOUNDS:
        chapter = chapter.otherwise(name) if bound is None else chapter.when(category < bound, name)
    return chapter
