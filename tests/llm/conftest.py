from __future__ import annotations

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, shard string, key string, kept int, n bigint, _key int"


def prose(seed: int, n: int) -> str:
    out, state = [], seed * 7919 + 1
    for k in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(state >> 8) % len(WORDS)] + ("." if k % 9 == 8 else "," if k % 5 == 4 else "") + ("\n" if k % 31 == 30 else ""))
    return " ".join(out).replace("\n ", "\n")


def document(doc_id, text, lang="en", source="a"):
    """A row with extra columns whose names the operators use themselves."""
    return (doc_id, text, lang, source, len(text) if text is not None else None, 7, "s", "k", 1, 3, 5)


PASSAGE = "\n".join(prose(900 + k, 14) for k in range(6))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls everywhere, empty and long texts, repeated rows, ties, awkward characters."""
    long = prose(5, 30_000)
    rows = [document(k, prose(k, 60 + k), "de" if k % 3 else "en", f"s{k % 4}") for k in range(20)]
    rows += [
        document(30, None),
        document(31, ""),
        document(32, " \n\t "),
        document(33, "word"),
        document(34, "two words", None, None),
        document(35, long),
        document(36, long.upper()),
        document(37, prose(1, 61), None, None),
        document(None, None, None, None),
        document(None, prose(77, 90)),
        document(None, prose(77, 90)),
        document(38, prose(38, 80)),
        document(38, prose(38, 80)),
        document(38, prose(39, 80)),
        document(39, "nul \0 byte, \x01 mark. \x1f é ß 漢字 \U0001f600 <turn> \\ </turn>\u00a0x"),
        document(40, "x" * 20_000),
        document(41, prose(3, 40) + "\n" + PASSAGE + "\n" + prose(4, 40)),
        document(42, prose(6, 33) + "\n" + PASSAGE + "\n" + prose(7, 50)),
        document(43, "be " * 300),
    ]
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(k, 1, 0) for k in range(20)] + [(43, 0, 0), (None, 1, 0), (30, None, None), (31, 1, None), (5, 1, 0), (35, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality bigint, toxic bigint")
