"""Small tables with the cases that every corpus operator must define."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

WORDS = "the of and tion here where stone river light other under seven".split()
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " row long, node long, queue string, part int, bucket int, slot int, score double, weight int"
)


def prose(seed: int, n_words: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(40)) for _ in range(n_words))


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls, empties, copies, repeated rows, a long text, odd white space and special strings."""
    texts = [None, "", " \t\n", "a", "a", prose(1, 60), prose(1, 60), prose(1, 60) + " \n"]
    texts += [prose(1, 59) + " changed", prose(2, 9000), "x" * 50_000, "▁ é ☃ 日本語\x1f  b"]
    texts += ["<|endoftext|> </s> it's\r\n\r\n two  spaces ", "A B C D", "a b c d", "tail"]
    texts += [prose(k, 30 + k % 50) for k in range(3, 60)]
    rows = [
        (k, text, None if k % 7 == 3 else "en", None if k % 5 == 1 else f"s{k % 3}", 1)
        for k, text in enumerate(texts)
    ]
    rows += [rows[5], rows[5], (None, prose(1, 60), None, None, None), (None, None, None, None, None)]
    return rows


def _frame(spark, rows, folder):
    extra = (9, 9, "x", 9, 9, 9, 0.5, 9)
    frame = spark.createDataFrame([(*row, *extra) for row in rows], SCHEMA)
    frame.repartition(3).write.parquet(str(folder))
    return spark.read.schema(SCHEMA).parquet(str(folder))


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows, tmp_path_factory):
    return _frame(spark, awkward_rows, tmp_path_factory.mktemp("docs") / "d")


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return _frame(spark, [], tmp_path_factory.mktemp("docs") / "e")


def groups_of(keys, linked):
    """Smallest index reachable for each of the keys, by comparing all pairs."""
    root = list(range(len(keys)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(keys)):
        for j in range(i):
            if linked(keys[i], keys[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(k) for k in range(len(keys))]


def by_key(rows, key):
    found = defaultdict(list)
    for row in rows:
        found[row[key]].append(row)
    return found


def crc_of_ids(ids) -> int:
    import numpy as np

    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())
