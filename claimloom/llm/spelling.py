"""Spelling variants: words one edit apart, found by walking tries that are tables of edges.

The words are counted over all texts. Each word, and each word backwards, is a path of a trie; a node is a
beginning of words, an edge leads to the next node where words part, with the letters between as its label.
States (word, what is left of it, node) have made one edit: at each node of the second half of its path a
word replaces its next letter by a larger one, or leaves it out, and takes another edge. What is left has to
match level by level: the states are joined with the edges that begin with their next letter, until a word
ends. Words that differ in their first half part in the second half backwards, so no state starts near the
root, where every letter has an edge; and an edit found from one word need not be found from the other.

A word's form is its near word that occurs most often, if it does at least ``times`` as often; its root is
reached by following forms. A form occurs more often, so forms end. Paths of long words are hashed as they
go, so the work is linear in a word's length; nodes of up to 40 letters are named by these, others by SHA-256.

Null and empty texts have no words; bytes that are not UTF-8 end a word. A null doc_id counts as empty text.
Repeated rows count. Of near words that occur equally often the smallest in code-point order is the form.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import arrow_map, pa_schema, slices, utf8
from claimloom.session import stored

LETTERS = "A-Za-zÀ-ÿ"
END = "$"  # behind every word, smaller than any letter
SHORT = 40
MASK = 62  # longer words share the last bit of the lengths of an edge
STATE = ("word", "rest", "node", "target")


def occurrence(doc_id: str, run: str, one_in: int) -> str:
    """The word that a run stands for in a document: now and then a letter is missing."""
    number = zlib.crc32(f"{doc_id}:{run}".encode())
    if number % one_in:
        return run
    gone = number % len(run)
    return run[:gone] + run[gone + 1 :]


def count_words(docs: DataFrame, least: int = 7, one_in: int = 31, most: int = 200_000) -> DataFrame:
    """word and n, the occurrences of words of at least ``least`` letters; tasks add up before the shuffle."""
    runs = re.compile(f"[{LETTERS}]{{{least},}}")
    kinds = pa_schema(docs.sparkSession, "word string, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch), strict=True):
                name = "" if doc_id is None else str(doc_id)
                for found, n in Counter(runs.findall(text.lower().decode(errors="replace"))).items():
                    seen[occurrence(name, found, one_in)] += n
            if len(seen) > most:
                yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], schema=kinds)
                seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], schema=kinds)

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return found.where(F.char_length("word") >= least).groupBy("word").agg(F.sum("n").alias("n"))


def bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def length_bit(length: Column) -> Column:
    return bit(F.least(length, F.lit(MASK)))


def letter_bit(code: Column) -> Column:
    """A bit of a letter's code point, which a few letters share."""
    return bit((code % 63).cast("int"))


def named(text: str) -> bytes:
    return text.encode() if len(text) <= SHORT else b"#" + hashlib.sha256(text.encode()).digest()


def path_nodes(word: str, backward: bool) -> Iterator[tuple[int, bytes, int]]:
    """(depth, node, code point of the next letter) of the second half of a word's path, one letter earlier than the word's
    own edits start: words that are one letter shorter start there."""
    mark, path = (b">", word[::-1]) if backward else (b"<", word)
    start = len(path) // 2 if backward else (len(path) - 1) // 2
    running = hashlib.sha256(path[:start].encode())
    letters = path + END
    for depth in range(start, len(path) + 1):
        yield depth, mark + (path[:depth].encode() if depth <= SHORT else b"#" + running.digest()), ord(letters[depth])
        running.update(letters[depth].encode())


def paths(words: DataFrame) -> DataFrame:
    """id (of the word), backward, depth, node and letter of all paths."""
    schema = "id binary, backward boolean, depth int, node binary, letter int"
    kinds = pa_schema(words.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for word in batch.column(0).to_pylist():
                name = named(word)
                for backward in (False, True):
                    for node in path_nodes(word, backward):
                        rows.append((name, backward, *node))
                        if len(rows) == 50_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)
                            rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)

    return words.select("word").mapInArrow(run, schema)


def tries(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The steps of all words, (word, backward, depth, node, child, ahead, rest, label), and the edges they make.

    Only nodes where words part are kept: a label leads to the next such node, or to the end of a word.
    ``ahead`` has the bits of the letters that follow at the child.
    """
    all_nodes = stored(paths(words), "trie-paths")
    ahead = F.bit_or(letter_bit(F.col("letter"))).alias("ahead")
    parting = all_nodes.groupBy("node").agg(F.min("letter").alias("first"), F.max("letter").alias("last"), ahead).where("first < last").select("node", "ahead")
    kept = all_nodes.join(parting, "node").groupBy("id", "backward")
    mine = kept.agg(F.array_sort(F.collect_list(F.struct("depth", "node", "ahead"))).alias("nodes"))

    def names(batch: pa.RecordBatch) -> dict:
        return {"word": batch.column(0), "id": [named(w) for w in batch.column(0).to_pylist()]}

    known = arrow_map(words.select("word"), names, "word string, id binary").join(mine, "id")
    placed = known.select("word", "backward", "nodes", F.posexplode("nodes").alias("k", "here"))
    letters = F.concat(F.when(F.col("backward"), F.reverse("word")).otherwise(F.col("word")), F.lit(END))
    following = F.get("nodes", F.col("k") + 1)
    rest = F.substring(letters, F.col("here.depth") + 1, F.char_length("word") + 1)
    steps = placed.select(
        "word", "backward", F.col("here.depth").alias("depth"), F.col("here.node").alias("node"), following["node"].alias("child"), following["ahead"].alias("ahead"), rest.alias("rest"), (following["depth"] - F.col("here.depth")).alias("n")
    ).withColumn("label", F.when(F.col("n").isNull(), F.col("rest")).otherwise(F.substring("rest", F.lit(1), F.col("n"))))
    steps = stored(steps.drop("n"), "trie-steps")
    # what an edge leads to is the same for all words on it; only an edge to the end of a word has one word
    found = F.when(F.col("child").isNull(), F.col("word")).alias("found")
    edges = steps.groupBy("node", F.substring("label", 1, 1).alias("letter"), "label", "child", "ahead", found).agg(F.bit_or(length_bit(F.char_length("word"))).alias("lengths"))
    return steps, stored(edges, "trie-edges")


def one_edit_pairs(words: DataFrame) -> DataFrame:
    """Pairs (word, found) of words one edit apart, each at least once, from either side."""
    steps, edges = tries(words)
    n = F.char_length("word")
    start = F.when(F.col("backward"), n - F.floor(n / 2)).otherwise(F.floor(n / 2))
    edge = edges.select(F.col("node"), F.col("letter"), F.col("label").alias("_label"), F.col("child").alias("_child"), F.col("ahead").alias("_ahead"), "found", "lengths")
    size = F.char_length("_label")

    def fits(target: Column) -> Column:
        return F.col("lengths").bitwiseAND(length_bit(target)) != 0

    def after(k: int) -> Column:  # what is left behind the label and k letters more
        return F.substring("rest", size + 1 + k, F.char_length("rest"))

    def goes_on(left: Column) -> Column:
        return F.col("_child").isNull() | (F.col("_ahead").bitwiseAND(letter_bit(F.ascii(left))) != 0)

    begun = steps.where((F.col("depth") >= start) & (F.col("depth") < n)).select("word", "rest", "node")
    replaced = (F.col("letter") > F.substring("rest", 1, 1)) & F.startswith(F.substring("rest", F.lit(2), F.char_length("rest")), F.substring("_label", F.lit(2), size)) & fits(n) & goes_on(after(0))
    left_out = F.startswith(F.substring("rest", F.lit(2), F.char_length("rest")), F.col("_label")) & fits(n - 1) & goes_on(after(1))
    met = begun.join(edge, "node").where(replaced | left_out)
    both = F.array(
        F.when(replaced, F.struct(after(0).alias("rest"), n.alias("target"))), F.when(left_out, F.struct(after(1).alias("rest"), (n - 1).alias("target")))
    )
    states = met.select("word", F.explode(F.array_compact(both)).alias("now"), F.col("_child").alias("node"), "found")
    level = stored(states.select("word", "now.rest", "node", "now.target", "found"), "trie-states")
    pairs = [level.where("node IS NULL").select("word", "found")]
    while not (states := level.where("node IS NOT NULL").select(*STATE)).isEmpty():
        asked = states.withColumn("letter", F.substring("rest", 1, 1))
        met = asked.join(edge, ["node", "letter"]).where(F.startswith("rest", "_label") & fits(F.col("target")) & goes_on(after(0)))
        level = stored(met.select("word", after(0).alias("rest"), F.col("_child").alias("node"), "target", "found"), "trie-states")
        pairs.append(level.where("node IS NULL").select("word", "found"))
    every = pairs[0]
    for more in pairs[1:]:
        every = every.unionByName(more)
    return every


def follow_forms(forms: DataFrame) -> DataFrame:
    """word and root: forms followed to the last one, twice as far in each step."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stored(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def spelling_variants(docs: DataFrame, least: int = 7, min_count: int = 2, times: int = 10, one_in: int = 31) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word with ``min_count`` occurrences."""
    words = stored(count_words(docs, least, one_in).where(F.col("n") >= min_count), "spelling-words")
    pairs = one_edit_pairs(words)
    near = pairs.unionByName(pairs.select(F.col("found").alias("word"), F.col("word").alias("found"))).distinct()
    counted = near.join(words.select(F.col("word").alias("found"), F.col("n").alias("found_n")), "found")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("found_n")).alias("less"), F.col("found").alias("form"))).alias("best"))
    form_n = -F.col("best.less")
    known = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(form_n >= times * F.col("n"), F.struct(F.col("best.form").alias("form"), form_n.alias("form_n"))).alias("to")
    )
    known = stored(known.select("word", "n", "n_near", "to.form", "to.form_n"), "spelling-forms")
    roots = follow_forms(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
