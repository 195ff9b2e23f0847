from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing, token_files
from tidemark.llm.common import new_folder

from .conftest import crc_of_ids

LIBRARY = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def ids_of(text, end):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, end]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é1'.!\n\t \x1c᠎|<>") | st.characters(codec="utf-8"), max_size=40))
def test_cached_ids_equal_the_library(text):
    found = bpe.encoder().encode(pa.array([text, None, "it's <|endoftext|> " + text], pa.string()))
    assert found[0] == bpe.encoder().whole(text) and found[1] == b""
    assert found[2] == bpe.encoder().whole("it's <|endoftext|> " + text)


KINDS = "abZ éßÿ×÷Жж日ª²19.,!-_'|/<>\n\n  \t\xa0\x00\x7f"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(KINDS), max_size=30), max_size=8))
def test_parts_of_any_kind_equal_the_library(texts):
    encoder = bpe.encoder()
    for _ in range(2):
        assert encoder.encode(pa.array(texts, pa.string())) == list(map(encoder.whole, texts))


class Counted:
    """An object of the library that counts the calls of its methods."""

    def __init__(self, inner, calls):
        self.inner, self.calls = inner, calls

    def __getattr__(self, name):
        self.calls[name] += 1
        return getattr(self.inner, name)


def test_new_words_are_encoded_many_at_a_call():
    calls = Counter()
    encoder = bpe.UnitEncoder(public_tokenizers.path(bpe.VOCABULARY))
    words = [f"{a}{b}é{c}" for a in "bcdfghjk" for b in "aeiou" for c in "lmnprstvwxyz" * 3]
    text = ", ".join(f"{word}{chr(97 + k % 26)}{k // 26}x" for k, word in enumerate(words))
    expected = encoder.whole(text)
    for name in ("tokenizer", "model", "bare"):
        setattr(encoder, name, Counted(getattr(encoder, name, None), calls))
    assert encoder.encode(pa.array([text])) == [expected]
    assert sum(calls.values()) <= 20


def test_remembered_parts_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_UNITS", 50)
    encoder = bpe.UnitEncoder(public_tokenizers.path(bpe.VOCABULARY))
    for k in range(40):
        text = " ".join(f"w{'abcdefghij'[n % 10]}{'abcdefgh'[k % 8]}{'xyz'[n % 3]}" for n in range(30))
        assert encoder.encode(pa.array([text])) == [encoder.whole(text)]
        assert len(encoder.units) == len(encoder.ids) == len(encoder.used) <= 50 + 30


def test_cuts_do_not_depend_on_blocks(monkeypatch):
    text = "aé.×b1é2!ÿ÷Zßa" * 9
    data = np.frombuffer(text.encode(), "u1")
    expected = bpe.kind_changes(data).tolist()
    for size in range(1, 9):
        monkeypatch.setattr(bpe, "BLOCK_BYTES", size)
        assert bpe.kind_changes(data).tolist() == expected


def check_pieces(pieces, expected, size):
    """Every id of every document in exactly one piece; sequences without gaps, one not full."""
    documents = Counter()
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
    for rows in by_doc.values():
        documents[rows[0]["doc_id"]] += sum(p["start"] == 0 for p in rows)
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= size
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert sum(sum(n for _, n in s) < size for s in by_sequence.values()) <= 1
    wanted = Counter((doc, k, t) for doc, ids in expected for k, t in enumerate(ids))
    got = Counter()
    for p in pieces:
        ids = memoryview(p["ids"]).cast("I")
        assert len(ids) == p["length"]
        got.update((p["doc_id"], p["start"] + k, t) for k, t in enumerate(ids))
    assert got == wanted


@pytest.mark.parametrize("size, window, unit", [(2048, 65_536, 256), (64, 256, 16)])
def test_each_id_is_packed_once(awkward, awkward_rows, size, window, unit):
    pieces = packing.pack(
        awkward, sequence_tokens=size, window_tokens=window, unit_tokens=unit
    ).collect()
    check_pieces(pieces, [(r[0], ids_of(r[1], 1)) for r in awkward_rows], size)


def simulated(rows, shares, window, unit):
    """Deficit round-robin by its definition: tokens served to each source in each round."""
    left = Counter()
    for source, n in rows:
        left[source] += n
    deficit = dict.fromkeys(shares, 0.0)
    rounds = []
    while any(left.values()):
        served = {}
        for source, share in shares.items():
            deficit[source] += share * window
            n = min(left[source], int(deficit[source] // unit) * unit)
            deficit[source] -= n
            left[source] -= n
            served[source] = n
        rounds.append(served)
    return rounds


def test_rounds_follow_deficit_round_robin(awkward, awkward_rows):
    targets = {"s0": 0.5, "s1": 0.25, "s2": 0.125, None: 0.125}
    window, unit = 512, 32
    tokens = packing.tokenized(awkward, bpe.VOCABULARY, 1)
    places = packing._queue_places(tokens, targets)
    runs = packing.runs_of(tokens, places, window, unit).collect()
    got = Counter()
    for run in runs:
        got[run["round"], run["queue"]] += run["high"] - run["low"]
    rounds = simulated(
        [(r[3], len(ids_of(r[1], 1))) for r in awkward_rows], targets, window, unit
    )
    expected = {
        (k + 1, "null" if source is None else f"={source}"): n
        for k, served in enumerate(rounds)
        for source, n in served.items()
        if n
    }
    assert dict(got) == expected


def test_windows_hold_the_mixture(awkward):
    tokens = packing.tokenized(awkward, bpe.VOCABULARY, 1)
    runs = packing.runs_of(tokens, packing._queue_places(tokens, None), 2048, 32).collect()
    total, upto = Counter(), Counter()
    for run in runs:
        total[run["queue"]] += run["high"] - run["low"]
    for number in sorted({run["round"] for run in runs}):
        for run in runs:
            if run["round"] == number:
                upto[run["queue"]] += run["high"] - run["low"]
        for queue, n in total.items():
            credit = min(n, number * 2048 * n / sum(total.values()))
            assert -33 <= upto[queue] - credit <= 1


def test_source_without_target_is_packed_last(awkward, awkward_rows):
    pieces = packing.pack(awkward, targets={"s0": 1.0}).collect()
    check_pieces(pieces, [(r[0], ids_of(r[1], 1)) for r in awkward_rows], 2048)


def test_token_files_are_read_back(spark, awkward, awkward_rows):
    path = new_folder(spark, "files")
    token_files.write_token_files(awkward, path)
    got = sorted(token_files.token_digests(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted(
        (r[0] for r in awkward_rows), key=lambda d: (d is not None, d)
    )
    at = 0
    for row in got:
        assert row["start"] == at
        at += row["n_tokens"]
    expected = Counter((r[0], crc_of_ids(ids_of(r[1], 0))) for r in awkward_rows)
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in got) == expected
    some = token_files.read_tokens(spark, path, 5, 9).select("doc_id", "ids").collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in some) == Counter(
        (r[0], tuple(ids_of(r[1], 0))) for r in awkward_rows if r[0] is not None and 5 <= r[0] <= 9
    )


def test_reading_is_selective(spark, awkward):
    path = new_folder(spark, "files")
    token_files.write_token_files(awkward, path)
    plan = token_files.read_metadata(spark, path)._jdf.queryExecution().toString()
    assert "ids:array" not in plan.split("== Physical Plan ==")[1].split("ReadSchema")[1]
    plan = token_files.read_tokens(spark, path, 5, 9)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,5)" in plan
    import pyarrow.dataset as ds
    import pyarrow.parquet as pq

    files = [f for f in ds.dataset(path.removeprefix("file:")).files if pq.read_metadata(f).num_rows]
    columns = [pq.read_metadata(files[0]).row_group(0).column(k) for k in range(5)]
    encodings = {c.path_in_schema: c.encodings for c in columns}
    assert "DELTA_BINARY_PACKED" in encodings["doc_id"]
    assert any("DICTIONARY" in e for e in encodings["ids.list.element"])


def test_empty_table(spark, empty):
    assert packing.pack(empty).collect() == []
    path = new_folder(spark, "files")
    token_files.write_token_files(empty, path)
    assert token_files.token_digests(spark, path).collect() == []


def test_crc_of_pieces(awkward):
    pieces = {tuple(r[:6]): r["ids"] for r in packing.pack(awkward).collect()}
    for row in packing.piece_digests(packing.pack(awkward)).collect():
        assert row["ids_crc32"] == zlib.crc32(pieces[tuple(row[:6])])
