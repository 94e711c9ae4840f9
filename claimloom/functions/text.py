"""Text expressions for names, categories, ids and paths."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two day counts are spelled out before special characters go.
DAY_COUNTS = {
    "no longer leaking, wet <1 day": "no longer leaking, wet less than 1 day",
    "no longer leaking, wet >1 day": "no longer leaking, wet more than 1 day",
}


# Every ASCII character outside letters, digits and space.
ASCII_SPECIALS = "".join(chr(i) for i in range(128) if not (chr(i).isalnum() or chr(i) == " "))
WHITESPACE = " \t\n\x0b\f\r"


def blank_specials(col: Column) -> Column:
    """Each character outside letters, digits and space becomes a space.

    Plain ASCII text goes through a character map, about five times cheaper than the pattern.
    """
    mapped = F.translate(col, ASCII_SPECIALS, " " * len(ASCII_SPECIALS))
    is_ascii = F.octet_length(col) == F.char_length(col)
    return F.when(is_ascii, mapped).otherwise(F.regexp_replace(col, "[^0-9a-zA-Z ]", " "))


def normalise_category(col: Column) -> Column:
    """Spell out day counts, then blank special characters."""
    renamed = col
    for raw, spelled in DAY_COUNTS.items():
        renamed = F.when(col == raw, F.lit(spelled)).otherwise(renamed)
    return blank_specials(renamed)


def strip_whitespace(col: Column) -> Column:
    return F.translate(col, WHITESPACE, "")


def document_kind(doc_type: Column) -> Column:
    """``base``, ``endo`` or ``dec``: the first that the lower-cased type contains."""
    lowered = F.lower(doc_type)
    kind = F.lit(None).cast("string")
    for word in ("dec", "endo", "base"):
        kind = F.when(lowered.contains(word), F.lit(word)).otherwise(kind)
    return kind


def base_id(doc_id: Column) -> Column:
    """The part before the first underscore; null if there is none."""
    return F.when(doc_id.contains("_"), F.substring_index(doc_id, "_", 1))


def path_part(path: Column, index: int) -> Column:
    """Folder or file of a path: 1 is the first part, -1 the file name."""
    return F.try_element_at(F.split(path, "/"), F.lit(index))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(path_part(path, -1), r"\.[^.]*$", "")


def feature_token(name: str, value: Column, sep: str = "_") -> Column:
    return F.concat(F.lit(name + sep), value)


def feature_tokens(df: DataFrame, columns: Sequence[str], sep: str = "_", out: str = "token") -> DataFrame:
    """One row per record and answer, ``<column><sep><value>``; null answers give no token."""
    tokens = F.array_compact(F.array(*[feature_token(c, F.col(c).cast("string"), sep) for c in columns]))
    return df.withColumn(out, F.explode(tokens))


def confidence(probabilities: Column) -> Column:
    """Highest probability as percentage text with two decimals."""
    return F.format_string("%.2f", F.array_max(probabilities) * 100)


def clean_name(name: str) -> str:
    return re.sub(r"[ (]", "_", name).replace(")", "").replace("\r", "")


def clean_columns(df: DataFrame) -> DataFrame:
    """Ledger column names made safe; two names that become equal are an error."""
    names = [clean_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after clean-up: {clashes}")
    return df.toDF(*names)
