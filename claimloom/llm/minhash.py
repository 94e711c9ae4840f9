"""Near-duplicate groups by min-max hashing.

A document's set of word shingles is hashed under some permutations, and both the smallest and the
largest value are kept of each, so half as many hashes are computed as a signature has values. Bands of
the signature name buckets; documents that share a bucket are candidates, and a candidate pair is linked
if the full sets are similar enough.

Equal sets are one class, named by its smallest id; only classes are compared. Within a bucket no table
of pairs is formed: first, members are compared with one member of the bucket, and what is linked
becomes one component. Documents in buckets that still hold several components are then compared in
blocks, each two blocks in a task that returns only links between components, so no link that a bucket
shows is lost.

With 40 bands of 6 values a pair of exactly 0.8 similarity shares no bucket with probability 5e-6.

Null and empty texts, and texts without words, have an empty set and are linked with nothing. Rows with a
null id are linked with nothing either and have a null component. Rows with the same id are one document,
linked if one of its texts is. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import arrow_map, utf8
from claimloom.llm.graph import components
from claimloom.session import stored

GOLDEN = 0x9E3779B97F4A7C15
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; ASCII letters are lower-cased."""
    from xxhash import xxh3_64_intdigest

    words = text.lower().split()
    if not words:
        return np.empty(0, U)
    hashes = np.fromiter(map(xxh3_64_intdigest, words), U, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    value = np.full(n, size, U)
    for k in range(size):
        value = mixed(value * U(GOLDEN) + hashes[k : n + k])
    return np.unique(value)


class Signer:
    """Band keys of a set of hashes."""

    def __init__(self, bands: int, rows: int, seed: int = 1) -> None:
        if rows % 2:
            raise ValueError("a band holds pairs of a smallest and a largest value")
        draw = np.random.default_rng(seed)
        permutations = bands * rows // 2
        self.bands = bands
        self.shift = draw.integers(0, 1 << 64, permutations, U)[:, None]
        self.factor = draw.integers(0, 1 << 64, permutations, U)[:, None] | U(1)
        self.weights = draw.integers(0, 1 << 64, rows, U) | U(1)
        self.salt = mixed(np.arange(1, bands + 1, dtype=U) * U(GOLDEN))

    def keys(self, values: np.ndarray, step: int = 4096) -> np.ndarray:
        low = high = None
        for k in range(0, len(values), step):
            hashed = (values[k : k + step] ^ self.shift) * self.factor
            a, b = hashed.min(axis=1), hashed.max(axis=1)
            low, high = (a, b) if low is None else (np.minimum(low, a), np.maximum(high, b))
        both = np.concatenate([low.reshape(self.bands, -1), high.reshape(self.bands, -1)], axis=1)
        return mixed(mixed(both) @ self.weights + self.salt)


def signatures(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """Set size, digest of the set and band keys of each document; no keys for an empty set."""
    signer = Signer(bands, rows)

    def run(batch: pa.RecordBatch) -> dict:
        sizes, digests, keys = [], [], []
        for text in utf8(batch):
            values = shingle_set(text, shingle)
            sizes.append(len(values))
            digests.append(np.array([mixed(values).sum(dtype=U), mixed(values ^ U(GOLDEN)).sum(dtype=U)]).tobytes())
            keys.append(signer.keys(values).view(np.int64) if len(values) else np.empty(0, np.int64))
        return {"doc_id": batch.column(0), "n_shingles": sizes, "digest": digests, "bands": pa.array(keys, pa.list_(pa.int64()))}

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>")


def sets_of(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(rep, n, hashes) for the documents whose ids are asked for."""

    def run(batch: pa.RecordBatch) -> dict:
        values = [shingle_set(t, shingle).view(np.int64) for t in utf8(batch)]
        return {"rep": batch.column(0), "n": [len(v) for v in values], "hashes": pa.array(values, pa.list_(pa.int64()))}

    asked = docs.select("doc_id", "text").join(ids.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    return arrow_map(asked, run, "rep bigint, n bigint, hashes array<bigint>").where("n > 0")


def _may_link(a: Column, b: Column, percent: int) -> Column:
    """Sizes of two sets that can be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (lo, hi) whose full sets are similar enough."""
    low = sets.select(F.col("rep").alias("lo"), F.col("n").alias("n_lo"), F.col("hashes").alias("h_lo"))
    high = sets.select(F.col("rep").alias("hi"), F.col("n").alias("n_hi"), F.col("hashes").alias("h_hi"))
    both = pairs.join(low, "lo").join(high, "hi")
    shared = both.select("lo", "hi", "n_lo", "n_hi", F.size(F.array_intersect("h_lo", "h_hi")).alias("shared"))
    return shared.where(100 * F.col("shared") >= percent * (F.col("n_lo") + F.col("n_hi") - F.col("shared"))).select("lo", "hi").distinct()


def _links_between(crowd: DataFrame, sets: DataFrame, percent: int, block: int = 200_000, least: int = 200) -> DataFrame:
    """Links (lo, hi) that join different components, among documents that share buckets.

    ``crowd`` has a document (rep, comp, n) and the first document (first) of a bucket it is in, once
    for each. Documents connected by buckets are a neighbourhood. It is cut into blocks of about ``block``
    hashes (a document counts ``least`` at least), a large component into blocks of its own. Every two
    blocks meet in one task, which compares all their documents and returns only links that join
    components; blocks of one component do not meet.
    """
    near = components(crowd.select(F.col("rep").alias("a"), F.col("first").alias("b")), "near-hoods")
    people = crowd.select("rep", "comp", "n").distinct().join(near.select(F.col("id").alias("rep"), F.col("component").alias("hood")), "rep")
    people = people.withColumn("weight", F.greatest("n", F.lit(least)))
    large = people.groupBy("hood", "comp").agg(F.sum("weight").alias("all")).where(F.col("all") >= block).select("hood", "comp", F.col("comp").cast("string").alias("side"))
    people = people.join(large, ["hood", "comp"], "left").withColumn("side", F.coalesce("side", F.lit("rest")))
    counts = people.groupBy("hood", "side").agg(F.ceil(F.sum("weight") / block).alias("blocks"))
    people = stored(
        people.join(counts, ["hood", "side"]).select("hood", "rep", "comp", F.concat("side", F.lit("/"), F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("string")).alias("place"), "side"),
        "near-people",
    )
    places = people.select("hood", "place", "side").distinct()
    others = places.select("hood", F.col("place").alias("place2"), F.col("side").alias("side2"))
    meets = places.join(others, "hood").where("place <= place2 AND (side != side2 OR side = 'rest')")
    meets = stored(meets.select("hood", "place", "place2", F.concat_ws("|", F.col("hood").cast("string"), "place", "place2").alias("meeting")), "near-meetings")
    left = meets.select("hood", "place", "meeting", F.lit(0).alias("row"))
    right = meets.where("place != place2").select("hood", F.col("place2").alias("place"), "meeting", F.lit(1).alias("row"))
    seats = people.join(left.unionByName(right), ["hood", "place"]).select("meeting", "row", "rep", "comp").join(sets.select("rep", "hashes"), "rep")

    def compare(table: pa.Table) -> pa.Table:
        rows = table["row"].to_numpy()
        reps, comps = table["rep"].to_numpy(), table["comp"].to_numpy()
        hashes = table["hashes"].combine_chunks()
        sizes = np.diff(hashes.offsets.to_numpy())
        first = np.flatnonzero(rows == 0)
        second = np.flatnonzero(rows == 1) if rows.any() else first
        shared = shared_counts(hashes.flatten().to_numpy(), sizes, first, second)
        total = sizes[first][:, None] + sizes[second][None, :] - shared
        linked = (100 * shared >= percent * total) & (comps[first][:, None] != comps[second][None, :])
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while (up := root.get(c, c)) != c:
                c = up
            return c

        out = []
        for i, j in zip(*np.nonzero(linked)):
            a, b = find(int(comps[first[i]])), find(int(comps[second[j]]))
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(reps[first[i]]), int(reps[second[j]])))
        low, high = [min(p) for p in out], [max(p) for p in out]
        return pa.table({"lo": pa.array(low, pa.int64()), "hi": pa.array(high, pa.int64())})

    return seats.groupBy("meeting").applyInArrow(compare, "lo bigint, hi bigint").distinct()


def shared_counts(hashes: np.ndarray, sizes: np.ndarray, first: np.ndarray, second: np.ndarray, step: int = 2048) -> np.ndarray:
    """How many hashes each set of ``first`` shares with each of ``second``, by products of 0/1 matrices.

    ``hashes`` are the sets laid end to end; hashes that occur once are left out.
    """
    _, number, count = np.unique(hashes, return_inverse=True, return_counts=True)
    again = np.cumsum(count > 1) - 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    some = count[number] > 1
    column, owner = again[number[some]], owner[some]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = int(again[-1]) + 1 if len(again) else 0
    out = np.zeros((len(first), len(second)), np.float32)
    for low in range(0, width, step):
        part = slice(*np.searchsorted(column, [low, low + step]))
        matrix = np.zeros((len(sizes), step), np.float32)
        matrix[owner[part], column[part] - low] = 1
        out += matrix[first] @ matrix[second].T
    return out.astype(np.int64)


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after components joined by links have become one."""
    low = labels.select(F.col("rep").alias("lo"), F.col("comp").alias("a"))
    high = labels.select(F.col("rep").alias("hi"), F.col("comp").alias("b"))
    named = components(links.join(low, "lo").join(high, "hi").select("a", "b"))
    new = labels.join(named.withColumnRenamed("id", "comp"), "comp", "left")
    return stored(new.select("rep", F.coalesce("component", "comp").alias("comp")), "near-labels")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 40, rows: int = 6, rounds: int = 1
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links) and kept, for each row.

    ``rounds``: how often buckets are compared with one of their members before what is left is
    compared in blocks; it changes the work, not the result.
    """
    signed = stored(signatures(docs, shingle, bands, rows), "near-signatures")
    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(named.groupBy("digest", "n_shingles").agg(F.min("doc_id").alias("rep")), "near-classes")
    belongs = stored(named.select("doc_id", "digest", "n_shingles").join(classes, ["digest", "n_shingles"]).select("doc_id", "rep"), "near-belongs")

    # the bands of a class are those of the document that names it
    heads = named.join(classes.drop("n_shingles").withColumnRenamed("rep", "doc_id"), ["digest", "doc_id"], "left_semi")
    seats = heads.select(F.explode("bands").alias("key"), F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"))
    shared = seats.groupBy("key").agg(F.min("rep").alias("first"), F.max("rep").alias("last")).where("first < last").select("key")
    members = stored(seats.join(shared, "key"), "near-members")
    ids = stored(members.select("rep").distinct(), "near-ids")
    sets = stored(sets_of(docs, ids, shingle), "near-sets")
    labels = ids.select("rep", F.col("rep").alias("comp"))
    tested = None

    for turn in range(rounds):
        seated = members.join(labels, "rep")
        lead = F.min(F.struct((F.xxhash64("rep", F.lit(turn)) if turn else F.col("rep")).alias("order"), "rep", "comp", "n")).alias("lead")
        chosen = seated.groupBy("key").agg(lead, F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
        other = seated.join(chosen.select("key", F.col("lead.rep").alias("other"), F.col("lead.comp").alias("other_comp"), F.col("lead.n").alias("other_n")), "key")
        other = other.where((F.col("comp") != F.col("other_comp")) & _may_link(F.col("n"), F.col("other_n"), percent))
        pairs = other.groupBy("rep", F.col("other")).agg(F.count("*").alias("common"))
        pairs = pairs.select("rep", "common", F.least("rep", "other").alias("lo"), F.greatest("rep", "other").alias("hi"))
        if tested is not None:
            pairs = pairs.join(tested, ["lo", "hi"], "left_anti")
        # one comparison a round for each member: with whom it shares most buckets
        pairs = pairs.groupBy("rep").agg(F.max(F.struct("common", "lo", "hi")).alias("best")).select("best.lo", "best.hi")
        pairs = stored(pairs.distinct(), "near-pairs")
        if pairs.isEmpty():
            continue
        links = stored(_linked(pairs, sets, percent), "near-links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        if not links.isEmpty():
            labels = _merged(labels, links)

    seated = members.join(labels, "rep")
    unsure = seated.groupBy("key").agg(F.min("rep").alias("first"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    crowd = stored(seated.join(unsure.select("key", "first"), "key").select("rep", "comp", "n", "first").distinct(), "near-crowd")
    if not crowd.isEmpty():
        links = stored(_links_between(crowd, sets, percent), "near-links")
        if not links.isEmpty():
            labels = _merged(labels, links)

    # ids that stand for different texts join what each of them is in
    named_as = belongs.join(labels, "rep", "left").select("doc_id", F.coalesce("comp", "rep").alias("comp"))
    twice = named_as.groupBy("doc_id").agg(F.min("comp").alias("a"), F.max("comp").alias("b"))
    found = twice.select("doc_id", F.col("a").alias("comp"))
    if not twice.where("a != b").isEmpty():
        joined = components(named_as.join(twice, "doc_id").where("a != b").select("a", F.col("comp").alias("b")))
        found = found.join(joined.withColumnRenamed("id", "comp"), "comp", "left").select("doc_id", F.coalesce("component", "comp").alias("comp"))
    out = signed.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    component = F.coalesce("comp", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))
