"""One-hot features, label codes and splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.text import normalise_category
from claimloom.session import stored

MISSING = "NA"
HASH_BITS = 60
BUCKET_BITS = 16


def fill_na(df: DataFrame, value: str = MISSING) -> DataFrame:
    return df.na.fill(value)


def normalise_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: normalise_category(F.col(c)) for c in columns})


def split_label(df: DataFrame) -> tuple[list[str], str]:
    """Feature columns and label column of a table whose last column is the label."""
    *columns, label = df.columns
    return columns, label


def long_answers(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``(keep, name, answer)``: one row per known answer."""
    answers = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("answer")) for c in columns])
    return df.select(*keep, F.explode(answers).alias("_a")).select(*keep, "_a.*").filter(F.col("answer").isNotNull())


def learn_vocabulary(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct answers of each column, found in one pass.

    The answers become column names, so there are as many as a table can have columns; open-ended
    columns belong into ``one_hot_long`` or ``one_hot_pipeline``.
    """
    rows = long_answers(df, columns).distinct().collect()
    return {c: sorted(r.answer for r in rows if r.name == c) for c in columns}


def one_hot_columns(vocabulary: Mapping[str, Sequence[str]], sep: str = "_") -> list[Column]:
    """One 0/1 column per answer; an unknown or missing answer gives zeros."""
    return [
        F.when(F.col(f"`{name}`") == answer, 1).otherwise(0).alias(f"{name}{sep}{answer}")
        for name, answers in vocabulary.items()
        for answer in answers
    ]


def one_hot_fixed(
    df: DataFrame, vocabulary: Mapping[str, Sequence[str]], keep: Sequence[str] = (), sep: str = "_"
) -> DataFrame:
    return df.select(*keep, *one_hot_columns(vocabulary, sep))


def one_hot_learned(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), sep: str = "_") -> DataFrame:
    """Missing answers count as an answer of their own."""
    filled = df.na.fill(MISSING, list(columns))
    return one_hot_fixed(filled, learn_vocabulary(filled, columns), keep, sep)


def one_hot_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str], sep: str = "_") -> DataFrame:
    """The ones of the learned encoding, for any number of answers: ``(keep, feature, position)``.

    ``position`` numbers the features by column and answer, as the columns of ``one_hot_learned``. The
    vocabulary is numbered within ranges of answers, whose totals are counted up per column, so a column
    with an answer of its own in every row is no task's alone.
    """
    known = long_answers(df.na.fill(MISSING, list(columns)), columns, keep)
    ranges = known.select("name", "answer").distinct().repartitionByRange("name", "answer")
    # stored, since the ranges are sampled
    counts = stored(ranges.withColumn("_range", F.spark_partition_id()), "answers")
    totals = counts.groupBy("name", "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("name").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("name", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    sizes = {r.name: r.n for r in counts.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = {}, 0
    for c in columns:
        before[c], total = total, total + sizes.get(c, 0)
    start = reduce(lambda case, c: case.when(F.col("name") == c, before[c]), columns, F.when(F.lit(False), 0))
    place = F.row_number().over(Window.partitionBy("name", "_range").orderBy("answer")) - 1
    placed = counts.withColumn("_place", place).join(totals, ["name", "_range"])
    numbered = placed.select("name", "answer", (start + F.col("_before") + F.col("_place")).cast("bigint").alias("position"))
    return known.join(numbered, ["name", "answer"]).select(*keep, F.concat_ws(sep, "name", "answer").alias("feature"), "position")


def one_hot_pipeline(columns: Sequence[str], prefix: str = "hot_") -> Pipeline:
    """Indexer and encoder; the slot for unknown answers is the last one and is dropped."""
    indexed = [f"index_{c}" for c in columns]
    return Pipeline(
        stages=[
            StringIndexer(
                inputCols=list(columns), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
            ),
            OneHotEncoder(inputCols=indexed, outputCols=[prefix + c for c in columns], dropLast=True),
        ]
    )


def label_index(df: DataFrame, label: str, out: str = "label_id") -> tuple[DataFrame, StringIndexerModel]:
    """Class number by sorted class name; the model carries the names for decoding."""
    model = StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc").fit(df)
    return model.transform(df).withColumn(out, F.col(out).cast("int")), model


def row_hash(keys: Sequence[str], seed: int) -> Column:
    """60 bits of the MD5 of seed and keys, the same number in any SQL engine."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def hash_split(df: DataFrame, keys: Sequence[str], test: float, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: a row's side depends on its key and the seed only, not on partitions."""
    share = row_hash(keys, seed) / float(1 << HASH_BITS)
    return df.withColumn("is_test", share < test)


def stratified_split(df: DataFrame, label: str, keys: Sequence[str], test: float = 0.25, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: the rounded share of every class, lowest key hashes first.

    Rows are ranked within hash buckets of a class, and the buckets are counted up per class. So a
    class with nearly all rows is spread over 65,536 groups, and the quota is still exact.
    """
    hashed = df.withColumns(
        {"_stratum": F.coalesce(F.col(label).cast("string"), F.lit("\0")), "_hash": row_hash(keys, seed)}
    ).withColumn("_bucket", F.shiftright("_hash", HASH_BITS - BUCKET_BITS))
    group = ["_stratum", "_bucket"]
    counts = hashed.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    stratum = Window.partitionBy("_stratum")
    before = stratum.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    quotas = counts.select(
        *group,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.round(F.sum("_n").over(stratum) * test).alias("_quota"),
    )
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_hash", *keys))
    placed = hashed.withColumn("_rank", rank).join(quotas, group)
    return placed.select(*df.columns, (F.col("_before") + F.col("_rank") <= F.col("_quota")).alias("is_test"))
