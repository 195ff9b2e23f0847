from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tidemark.llm import (
    chat_format,
    exact_dedup,
    kd_shards,
    packing,
    quality,
    sentence_pieces,
    simhash,
    url_rules,
)
from tidemark.llm.common import stored

from .conftest import groups_of, prose

PIECES = sentence_pieces.model()
PAIRS = {piece[k : k + 2] for piece in PIECES.pieces for k in range(len(piece) - 1)}
MARK = sentence_pieces.MARK


def _fields(data, at, end):
    """(field number, wire type, start of value, end of value) of a protocol buffer message."""

    def number(at):
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    while at < end:
        tag, at = number(at)
        if tag & 7 == 2:
            size, start = number(at)
            stop = start + size
        elif tag & 7 == 0:
            start, stop = at, number(at)[1]
        else:
            start, stop = at, at + (4 if tag & 7 == 5 else 8)
        yield tag >> 3, tag & 7, start, stop
        at = stop


@pytest.fixture(scope="module")
def unigram_library():
    """The library on the same file, with the unigram type and the operator's scores."""
    with open(public_tokenizers.path(sentence_pieces.MODEL), "rb") as file:
        data = bytearray(file.read())
    for field, _, start, stop in list(_fields(data, 0, len(data))):
        if field == 1:
            for inner, kind, a, b in list(_fields(data, start, stop)):
                if (inner, kind) == (2, 5):
                    score = sentence_pieces.piece_score(struct.unpack("<f", data[a:b])[0])
                    data[a:b] = struct.pack("<f", score)
        if field == 2:
            for inner, kind, a, _ in list(_fields(data, start, stop)):
                if (inner, kind) == (3, 0):
                    data[a] = 1
    return sentencepiece.SentencePieceProcessor(model_proto=bytes(data))


def marked(text):
    return MARK + text.replace(" ", MARK) if text else ""


@pytest.mark.parametrize(
    "text", ["", "a", "  a  b ", "the quick brown fox", "日本語 ok ☃ \x01", "stone river", "\n\n x"]
)
def test_pieces_equal_the_library_on_short_texts(unigram_library, text):
    ids = np.frombuffer(PIECES.ids(marked(text)), "<u4")
    assert ids.tolist() == (unigram_library.nbest_encode_as_ids(text, 2)[0] if text else [])
    assert PIECES.decode(ids) == text


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(f"abthe in{MARK}é☃."), min_size=1, max_size=200), st.integers(16, 70))
def test_chunks_make_the_same_path(text, size):
    text = MARK + text
    starts = range(0, len(text), size)
    matrices = [
        PIECES.matrix(
            text[a : a + size + PIECES.reach], min(size, len(text) - a), a + size >= len(text)
        )
        for a in starts
    ]
    best = PIECES.forward(text, 0, len(text))[0][-1]
    assert sentence_pieces.combine_all(matrices)[0, 0, 0] == best
    states = sentence_pieces.border_states(matrices, 0, 0)
    spans = [
        text[a + i : min(a + size, len(text)) + j]
        for a, i, j in zip(starts, states, states[1:], strict=False)
    ]
    assert "".join(spans) == text
    assert sum(PIECES.score(s) for s in spans) == best
    assert b"".join(PIECES.ids(s) for s in spans) == PIECES.ids(text)


@settings(max_examples=150, deadline=None)
@given(
    st.one_of(st.text("ab", min_size=1, max_size=300), st.text(f"aten{MARK}", max_size=300)),
    st.lists(st.integers(16, 70), min_size=1, max_size=20),
)
def test_ids_do_not_depend_on_where_chunks_end(text, sizes):
    """Ties too: places carry the choice over borders, in whatever order matrices are combined."""
    text, at, chunks = MARK + text, 0, []
    while at < len(text):
        size = min(sizes[len(chunks) % len(sizes)], len(text) - at)
        shown = text[at : at + size + PIECES.reach]
        chunks.append((at, size, PIECES.matrix(shown, size, at + size == len(text))))
        at += size
    half = len(chunks) // 2
    blocks = [part for part in (chunks[:half], chunks[half:]) if part]
    outer = sentence_pieces.border_states(
        [sentence_pieces.combine_all([m for *_, m in part]) for part in blocks], 0, 0
    )
    ids = b""
    for part, first, last in zip(blocks, outer, outer[1:], strict=False):
        states = sentence_pieces.border_states([m for *_, m in part], first, last)
        for (start, size, _), i, j in zip(part, states, states[1:], strict=False):
            ids += PIECES.ids(text[start + i : start + size + j])
    assert ids == PIECES.ids(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from(f"abthe in{MARK}é☃.\n"), max_size=60), max_size=20))
def test_texts_of_a_batch_as_one_by_one(texts):
    blobs = PIECES.ids_of_all(pa.array(texts, pa.string()))
    assert blobs == [PIECES.ids(marked(text)) for text in texts]
    assert PIECES.decode_all(blobs) == [text.replace(MARK, " ") for text in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(f"abthe in{MARK}é☃д.,\n\"("), max_size=60), max_size=20))
def test_units_are_cut_where_no_piece_reaches(texts):
    distinct, numbers, starts = PIECES.units(pa.array(texts, pa.string()))
    assert len(set(distinct)) == len(distinct)
    for text, a, b in zip(texts, starts, starts[1:], strict=False):
        own = [distinct[k] for k in numbers[a:b]]
        assert "".join(own) == text
        assert not {one[-1] + other[0] for one, other in pairwise(own)} & PAIRS
        score, _ = PIECES.forward(text, 0, len(text))
        assert sum(PIECES.score(unit) for unit in own) == score[-1]


def test_words_are_remembered_apart_from_the_marks_beside_them():
    words = ["stone", "river", "été", "größe", "дом"]
    texts = [mark.join(words) for mark in (f",{MARK}", f"!{MARK}", ".\n", "\n", "(")]
    distinct, numbers, _ = PIECES.units(pa.array([MARK + text for text in texts]))
    assert {unit.strip(MARK) for unit in distinct if unit.strip(MARK).isalpha()} == set(words)
    assert len(distinct) <= 2 * len(words) + 5 < len(numbers)


def test_giant_path_round_trips(awkward, awkward_rows, empty):
    encoded = sentence_pieces.encode(awkward, giant_chars=200, chunk_chars=64)
    got = sentence_pieces.decode(encoded).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(
        (r[0], (r[1] or "").replace(MARK, " ")) for r in awkward_rows
    )
    plain = {
        (r["doc_id"], r["text"]): r["ids_crc32"]
        for r in sentence_pieces.decode(sentence_pieces.encode(awkward)).collect()
    }
    assert all(plain[r["doc_id"], r["text"]] == r["ids_crc32"] for r in got)
    assert len({r["row"] for r in got}) == len(got)
    assert sentence_pieces.round_trip(empty).collect() == []


def test_shards(awkward, awkward_rows, empty):
    got = kd_shards.shard(awkward, 8).collect()
    expected = Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()))
        for r in awkward_rows
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert kd_shards.shard(empty, 8).collect() == []


def test_shard_sizes_are_near_equal_with_one_hot_text(spark, tmp_path):
    rows = [(k, prose(k, 20 + k % 90), "hot" if k % 2 else f"s{k % 9}", "en") for k in range(2000)]
    rows += [(10_000 + k, prose(7, 60), "hot", "en") for k in range(1000)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(
        str(tmp_path / "d")
    )
    docs = spark.read.parquet(str(tmp_path / "d"))
    for shards in (3,):
        got = kd_shards.shard(docs, shards).collect()
        sizes = Counter()
        for r in got:
            sizes[r["shard"]] += r["size"]
        assert max(sizes.values()) < 1.02 * sum(sizes.values()) / shards
        homes = defaultdict(set)
        for r in got:
            if r["doc_id"] < 2000:
                homes[r["text_crc32"]].add(r["shard"])
        hot = zlib.crc32(prose(7, 60).encode())
        assert all(len(s) == 1 for crc, s in homes.items() if crc != hot)
    target = kd_shards.shard(docs, None, target_bytes=100_000).collect()
    assert len({r["shard"] for r in target}) == -(-sum(r["size"] for r in target) // 100_000)


RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("a.com", "/", "block"),
    ("a.com", "/", "allow"), ("b.a.com", "/de", "allow"), ("org.uk", "/", "block"),
]


def judged(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fitting = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fitting, default=None)
    return (host, path, best and best[3], best[4] if best else "allow")


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1?q#f", "x://org", "x://org/"]
    urls += ["a://b.a.com/de/1", "a://b.a.com:80/de", "a://xb.a.com/de", "a://org.uk/x", "a://É.org/?"]
    urls += [f"h://w{k % 5}.example.org/en/{k}" for k in range(400)]
    urls += [f"h://{h}/{p}/{k}" for k in range(30) for h in ("a.com", "z.com", "com") for p in ("fr", "de")]
    rows = [(k if k != 3 else None, url, 1, "x") for k, url in enumerate(urls)] + [(5, urls[5], 1, "x")]
    rows.append((2**60 + 1, urls[9], 1, "x"))
    pages = spark.createDataFrame(rows, "page_id long, url string, part int, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = url_rules.judge(pages, rules).collect()
    assert Counter(tuple(r) for r in got) == Counter((r[0], *judged(r[1])) for r in rows)
    none = url_rules.judge(pages, rules.limit(0), default="block").collect()
    assert {(r["rule"], r["verdict"]) for r in none} == {(None, "block")} and len(none) == len(rows)
    assert url_rules.judge(pages.limit(0), rules).collect() == []


def labelled(spark, tmp_path, n=600):
    rows, labels = [], []
    for k in range(n):
        good = k % 3 > 0
        text = prose(k, 80) if good else " ".join(f"{w.upper()}!!" for w in prose(k, 80).split())
        rows.append((k, text, "en", "s"))
        labels.append((k, int(good), 0))
    rows += [(n, None, None, None), (n + 1, "", None, None), (None, prose(1, 80), None, None)]
    rows.append(rows[0])
    labels += [(n, None, None), (5, 7, 0), (None, 1, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    read = spark.read.parquet
    return read(str(tmp_path / "documents.parquet")), read(str(tmp_path / "labels.parquet")), rows


def test_quality(spark, tmp_path, empty):
    docs, labels, rows = labelled(spark, tmp_path)
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 600]
    assert sum(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held) >= 0.97 * len(held)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["predicted"] for r in got)
    # labels of held-out rows change nothing
    spoiled = labels.withColumn("quality", quality.F.when(
        quality.held_out(labels["doc_id"]), 1 - labels["quality"]).otherwise(labels["quality"]))
    assert quality.fit(docs, spoiled) == model
    bare = quality.fit(docs, labels.limit(0))
    assert {round(r["score"], 6) for r in quality.score(docs, bare).collect()} == {0.5}
    assert quality.score(empty, model).collect() == []


MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/", "s>", "é", "INST]"]
CONTROLS = st.lists(st.sampled_from(MARKS), max_size=8).map("".join)


@settings(
    max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "x\n[INST]"]), CONTROLS)), max_size=5))
def test_chat_examples_read_back(spark, conversations):
    rows = [
        (c, t, role, text, 1)
        for c, turns in enumerate(conversations)
        for t, (role, text) in enumerate(turns)
    ]
    rows.append((None, None, None, None, 2))
    rows.append((99, 1, "assistant", None, 2))
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int")
    got = chat_format.conversation_digests(chat_format.examples(turns)).collect()
    expected = defaultdict(list)
    for conv, _, role, text, _ in rows:
        expected[conv].append((role or "", text or ""))
    assert {r["conv_id"] for r in got} == set(expected) and len(got) == len(expected)
    for r in got:
        turns = expected[r["conv_id"]]
        spelled = "".join(f"{role}\n{text}\n" for role, text in turns)
        trained = "".join(text for role, text in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(spelled.encode()).hexdigest()
        assert r["loss_chars"] == len(trained)
        assert r["loss_sha256"] == hashlib.sha256(trained.encode()).hexdigest()


def test_each_reply_is_trained_once_after_its_context(spark):
    rows = [(1, 0, "user", "u0"), (1, 1, "assistant", "a1"), (1, 2, "user", "u2"),
            (1, 3, "assistant", "</s>"), (1, 4, "user", "end")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(chat_format.examples(frame).collect(), key=lambda r: r["example"])
    assert [r["example"] for r in got] == [2, 4, 5]
    assert [r["has_target"] for r in got] == [True, True, False]
    for row, reply in zip(got, ["a1", "<\\/s>", ""], strict=True):
        assert row["text"][row["loss_start"] :][: row["loss_length"]] == reply
    assert got[1]["text"].startswith(got[0]["text"]) and got[2]["text"].startswith(got[1]["text"])
    assert chat_format.examples(frame.limit(0)).collect() == []


def test_repeated_rows_are_turns(spark):
    rows = [(1, 0, "user", "u")] * 3
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (row,) = chat_format.conversation_digests(chat_format.examples(frame)).collect()
    assert row["n_turns"] == 3 and row["loss_chars"] == 0


def test_pipeline_against_plain_python(spark, tmp_path):
    docs, labels, rows = labelled(spark, tmp_path)
    scores = quality.score(docs, quality.fit(docs, labels)).collect()
    good = {(r["doc_id"]) for r in scores if r["predicted"]}
    kept = [r for r in rows if r[0] in good]
    best = {}
    for r in kept:
        text = re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")
        rank = (-len(r[1] or ""), r[0] is None, r[0])
        best[text] = min(best.get(text, (rank, r)), (rank, r), key=lambda x: x[0])
    unique = [r for _, r in best.values()]
    codes = [simhash.fingerprint((r[1] or "").encode()) for r in unique]
    roots = groups_of(codes, lambda a, b: (a ^ b).bit_count() <= 4)
    groups = defaultdict(list)
    for k, root in enumerate(roots):
        groups[root].append((unique[k][0] is None, unique[k][0]))
    expected = sorted(min(g)[1] or -1 for g in groups.values())
    frames = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frames = stored(stage(spark, frames, str(tmp_path)), name.replace(" ", "-"))
        assert frames.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in frames.collect()) == expected
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in frames.collect()}
    direct = packing.piece_digests(packing.pack(frames)).collect()
    key = lambda r: (str(r["doc_id"]), r["start"])
    assert sum(r["length"] for r in pieces) == sum(r["length"] for r in direct)
    assert {key(r)[0] for r in direct} == {key(r)[0] for r in pieces}


def test_pipeline_stages_on_awkward_rows(spark, awkward, empty):
    for docs in (awkward, empty):
        for keep in (exact_dedup.keep_winners, simhash.keep_firsts):
            assert keep(docs).columns == docs.columns
    assert simhash.keep_firsts(empty).count() == 0
    assert simhash.near_groups(empty).collect() == []
