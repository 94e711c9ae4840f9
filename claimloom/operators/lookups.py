"""First-match look-ups, updates through id arrays and ordered array resolution, all as equi-joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tie_break(df: DataFrame, used: Sequence[str]) -> Column:
    """A number from all columns but ``used``, to order rows that agree in those; maps are left out."""
    others = [f.name for f in df.schema.fields if f.name not in used and "map<" not in f.dataType.simpleString()]
    return F.xxhash64(F.lit(0), *others)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key; each map task keeps one row per key before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def lookup_first(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    values: Mapping[str, str],
    order: Sequence[str],
    null_safe: bool = False,
) -> DataFrame:
    """Add columns of the first matching row of ``dim``; null if there is none.

    ``on`` maps columns of ``df`` to keys of ``dim``, ``values`` maps new columns to columns of
    ``dim``; ``order`` decides which row of ``dim`` comes first.
    """
    first = first_per_key(dim, list(on.values()), [*order, *values.values()])
    slim = first.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(on.values())],
        *[F.col(v).alias(new) for new, v in values.items()],
    )
    pairs = [(F.col(f"_left.{c}"), F.col(f"_right._key{i}")) for i, c in enumerate(on)]
    terms = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    joined = df.alias("_left").join(slim.alias("_right"), reduce(Column.__and__, terms), "left")
    return joined.select("_left.*", *[f"_right.{new}" for new in values])


def exploded_ids(dim: DataFrame, ids: str, out: str = "id") -> DataFrame:
    """One row per id of an array column; a scalar id column counts as an array of one."""
    column = F.col(ids)
    if dim.schema[ids].dataType.typeName() != "array":
        column = F.array_compact(F.array(column))
    return dim.withColumn(out, F.explode(column))


def lookup_first_in_array(
    df: DataFrame, key: str, dim: DataFrame, ids: str, values: Mapping[str, str], order: Sequence[str]
) -> DataFrame:
    """Look-up where the key of ``dim`` is an array: exploded first, then an equi-join."""
    return lookup_first(df, exploded_ids(dim, ids, "_id_of_row"), {key: "_id_of_row"}, values, order)


def last_updates(source: DataFrame, key: str, ids: str, values: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    """One row ``(key, new values)`` per id in the arrays of the source; the last source row wins."""
    named = exploded_ids(source, ids, "_target_id").select(
        F.col("_target_id").alias(key),
        *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)],
        *[F.col(v).alias(t) for t, v in values.items()],
    )
    last = first_per_key(named, [key], [F.desc(f"_order{i}") for i in range(len(order))])
    return last.select(key, *values)


def apply_updates(
    target: DataFrame, updates: DataFrame, key: str, columns: Sequence[str], first_only: Sequence[str] | None = None
) -> DataFrame:
    """Target with columns set from ``updates`` (unique per key) where the key occurs, nulls included.

    With ``first_only`` (columns that order the target rows) only the first target row of each key is
    changed. Rows that agree in these columns are ordered by ``tie_break``; of equal rows one is changed.
    """
    parts = [F.struct(*[F.col(c) for c in columns]).alias("_new"), F.col(key).alias("_key")]
    if first_only:
        # the first target per key is an aggregate, so a key with many targets needs no big window
        firsts = target.groupBy(key).agg(F.min(F.struct(*first_only)).alias("_first"))
        updates = updates.join(firsts, key)
        parts.append(F.col("_first"))
    left = target.withColumn("_tie", tie_break(target, [key, *first_only])) if first_only else target
    joined = left.alias("_left").join(updates.select(*parts).alias("_right"), F.col(f"_left.{key}") == F.col("_right._key"), "left")
    hit = F.col("_right._new").isNotNull()
    if first_only:
        # only rows that agree in the order too share a window
        twins = Window.partitionBy(f"_left.{key}", *[f"_left.{c}" for c in first_only]).orderBy("_left._tie")
        joined = joined.withColumn("_twin", F.row_number().over(twins))
        same = [F.col(f"_left.{c}").eqNullSafe(F.col(f"_right._first.{c}")) for c in first_only]
        hit = reduce(Column.__and__, [hit, F.col("_twin") == 1, *same])
    changed = {t: F.when(hit, F.col(f"_right._new.{t}")).otherwise(F.col(f"_left.{t}")).alias(t) for t in columns}
    return joined.select(*[changed.get(c, F.col(f"_left.{c}")) for c in target.columns])


def update_from(
    target: DataFrame,
    source: DataFrame,
    key: str,
    ids: str,
    values: Mapping[str, str],
    order: Sequence[str],
    first_only: Sequence[str] | None = None,
) -> DataFrame:
    """Set columns of all targets whose key is in the id array of a source row.

    If several source rows name an id, the last one by ``order`` wins; a null it carries is set too.
    ``values`` maps target columns to source columns; ``first_only`` as in ``apply_updates``.
    """
    return apply_updates(target, last_updates(source, key, ids, values, order), key, list(values), first_only)


def _tagged_ids(out: str, ids: str) -> Column:
    return F.transform(ids, lambda x, i: F.struct(F.lit(out).alias("out"), i.alias("pos"), x.alias("id")))


def array_hits(
    df: DataFrame, row_key: str, arrays: Mapping[str, str], dim: DataFrame, dim_key: str, children: Mapping[str, Column]
) -> DataFrame:
    """One row per array entry: ``(row_key, out, pos, id)`` and a struct per output of ``dim``.

    ``arrays`` maps an output name to its id array, ``children`` to the struct made from ``dim``
    (null if there is no such row). A row without any id keeps one entry with a null position.
    """
    nothing = F.array().cast("array<struct<out:string,pos:int,id:string>>")
    tagged = [F.coalesce(_tagged_ids(out, ids), nothing) for out, ids in arrays.items()]
    entries = df.select(row_key, F.explode_outer(F.concat(*tagged)).alias("_entry")).select(row_key, "_entry.*")
    found = dim.select(F.col(dim_key).alias("id"), *[c.alias(out) for out, c in children.items()])
    return entries.join(found, "id", "left")


def resolved_arrays(
    df: DataFrame, row_key: str, arrays: Mapping[str, str], dim: DataFrame, dim_key: str, children: Mapping[str, Column]
) -> DataFrame:
    """``row_key`` and one array of structs per output, in the order of the id arrays, misses left out.

    ``row_key`` and ``dim_key`` are unique. All arrays are resolved by one join; a regrouped array
    is never longer than the array of its own row.
    """
    return listed_hits(array_hits(df, row_key, arrays, dim, dim_key, children), row_key, list(arrays))


def listed_hits(hits: DataFrame, row_key: str, outs: Sequence[str]) -> DataFrame:
    """The entries of ``array_hits`` as one array per row and output, in order, misses left out."""
    lists = []
    for out in outs:
        entry = F.when((F.col("out") == out) & F.col(out).isNotNull(), F.struct("pos", F.col(out).alias("child")))
        lists.append(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["child"]).alias(out))
    return hits.groupBy(row_key).agg(*lists)


def resolve_children(
    df: DataFrame, row_key: str, ids: str, dim: DataFrame, dim_key: str, child: Column, out: str
) -> tuple[DataFrame, DataFrame]:
    """Add an array column with a struct of ``dim`` per id, and the misses ``(row_key, id)``."""
    wanted = (row_key, {out: ids}, dim, dim_key, {out: child})
    full = df.join(resolved_arrays(df, *wanted), row_key)
    misses = array_hits(df, *wanted).filter(F.col(out).isNull() & F.col("pos").isNotNull())
    return full, misses.select(row_key, "id")
