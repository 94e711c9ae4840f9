"""Document fingerprints as Merkle trees, DataFrame operations only.

A text is cut into sections (at empty lines), paragraphs (lines) and pieces (behind a mark or line end).
A piece's digest is its MD5; a paragraph's is the MD5 of its pieces' digests, and so on up to the root.
Equal texts have equal roots; where roots differ, only differing branches need to be followed down.

The fingerprint is text: the root, a colon, and the short digests of all pieces, joined by ``,``, with
``.`` between paragraphs and ``/`` between sections. Likeness counts the distinct short digests that two fingerprints
share, against the mean of how many they have: 1 for equal texts, 0 for texts with no piece in common.

Null texts are empty texts; all empty texts are equal. Texts are taken whole. Null ids come first and
are ordered by their texts, as are repeated ids; fully repeated rows are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


SECTION, PARAGRAPH = "\n\n", "\n"
ENDS = (".", ",", ";", ":", "!", "?")
SHORT = 8  # hex digits of a piece in the fingerprint


def _md5(value: Column) -> Column:
    return F.md5(value.cast("binary"))


def pieces(paragraph: Column) -> Column:
    """A paragraph cut behind its marks; the cuts take nothing away, so no character is special."""
    return F.filter(F.split(paragraph, f"(?<=[{''.join(ENDS)}])"), lambda p: p != "")


def merkle_tree(text: Column) -> Column:
    """Array of sections, each an array of paragraphs, each an array of piece digests."""
    sections = F.split(text, SECTION)
    return F.transform(sections, lambda s: F.transform(F.split(s, PARAGRAPH), lambda p: F.transform(pieces(p), _md5)))


def paragraph_digests(tree: Column) -> Column:
    return F.transform(tree, lambda s: F.transform(s, lambda p: _md5(F.concat_ws(",", p))))


def section_digests(tree: Column) -> Column:
    return F.transform(paragraph_digests(tree), lambda s: _md5(F.concat_ws(",", s)))


def root(tree: Column) -> Column:
    return _md5(F.concat_ws(",", section_digests(tree)))


def fingerprint(tree: Column) -> Column:
    short = F.transform(tree, lambda s: F.array_join(F.transform(s, lambda p: F.array_join(F.transform(p, lambda d: F.substring(d, 1, SHORT)), ",")), "."))
    return F.concat(root(tree), F.lit(":"), F.array_join(short, "/"))


def fingerprint_pieces(mark: Column) -> Column:
    """The distinct short digests of a fingerprint."""
    return F.array_remove(F.array_distinct(F.split(F.substring(mark, 34, 1 << 30), "[,./]")), "")


def likeness(mark: str, other: str) -> Column:
    """Likeness of two fingerprint columns that have their digests in columns ``<name>_pieces``."""
    mine, theirs = F.col(f"{mark}_pieces"), F.col(f"{other}_pieces")
    shared = 2.0 * F.size(F.array_intersect(mine, theirs)) / F.greatest(F.lit(1), F.size(mine) + F.size(theirs))
    return F.when(F.col(mark) == F.col(other), 1.0).otherwise(shared)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """The fingerprint of a text column; the tree is a column of its own, so that it is built once."""
    return df.withColumn("_tree", merkle_tree(F.col(text))).withColumn(name, fingerprint(F.col("_tree"))).drop("_tree")


def differing_paragraphs(tree: Column, other: Column) -> Column:
    """Numbers (from 0) of the paragraphs, counted through all sections, that differ between two trees."""
    mine, theirs = F.flatten(paragraph_digests(tree)), F.flatten(paragraph_digests(other))
    last = F.greatest(F.size(mine), F.size(theirs)) - 1
    return F.filter(F.sequence(F.lit(0), last), lambda k: ~F.get(mine, k).eqNullSafe(F.get(theirs, k)))


def with_next(rows: DataFrame, per_part: int = 2_000) -> DataFrame:
    """The text and fingerprint of the next row by ``doc_id`` beside each row; after the last, the first's.

    Rows are dealt to ranges of ids. A range's first row is also sent to the range before it, behind that
    one's rows, so that each range finds its successors alone. ``per_part``: rows of a range.
    """
    lowest = F.lit(-(1 << 63)).cast("long")
    rows = rows.withColumn("place", F.coalesce(F.col("doc_id"), lowest))
    facts = rows.agg(F.count("*").alias("n"), F.min("place").alias("first")).first()
    columns = ("text", "fingerprint")
    if not facts.n:
        return rows.select("*", *[F.col(c).alias(f"next_{c}") for c in columns]).drop("place")
    parts = max(1, facts.n // per_part)
    shares = [k / parts for k in range(1, parts)]
    found = rows.agg(F.percentile_approx("place", shares or [0.5], max(10_000, parts * 20)).alias("cuts")).first().cuts
    cuts = sorted({facts.first, *(found if shares else [])})
    firsts = F.lit(cuts)
    own = F.size(F.filter(firsts, lambda c: c <= F.col("place"))) - 1
    before = (own + len(cuts) - 1) % len(cuts)
    dealt = rows.select(
        "*",
        F.explode(
            F.when(
                F.array_contains(firsts, F.col("place")),
                F.array(F.struct(own.alias("part"), F.lit(False).alias("guest")), F.struct(before.alias("part"), F.lit(True).alias("guest"))),
            ).otherwise(F.array(F.struct(own.alias("part"), F.lit(False).alias("guest"))))
        ).alias("seat"),
    ).select("doc_id", *columns, "place", "seat.part", "seat.guest")
    following = Window.partitionBy("part").orderBy("guest", "place", "text")
    ahead = dealt.select("*", *[F.lead(c).over(following).alias(f"next_{c}") for c in columns])
    return ahead.where("NOT guest").drop("part", "guest", "place")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document, of its edited text, and how like the edited and next texts are."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(with_fingerprint(rows, "text", "fingerprint"))
    n = F.char_length("text")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("tail", F.floor(n / 4).cast("int"))
    edited = F.concat(F.left("text", n - F.col("tail")), F.left("next_text", F.col("tail")))
    rows = with_fingerprint(rows.withColumn("edited", edited), "edited", "edited_fingerprint")
    for name in ("fingerprint", "edited_fingerprint", "next_fingerprint"):
        rows = rows.withColumn(f"{name}_pieces", fingerprint_pieces(F.col(name)))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
