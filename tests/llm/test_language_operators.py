"""LM scores, phrase collocations and lexical search against brute force."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import lexical_search, lm_scoring, phrases

from .conftest import prose

DOCS = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts_of(rows):
    return [(r[0], (r[1] or "").translate(LOWER), r[2]) for r in rows]


def docs_of(spark, rows, folder):
    spark.createDataFrame([r[:3] for r in rows], DOCS).repartition(3).write.parquet(str(folder))
    return spark.read.parquet(str(folder))


# --- language model


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def left_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def quantised(count):
    """The mean of the counts that share a power of two with this one."""
    if not count:
        return 0.0
    low = 1 << (count.bit_length() - 1)
    return (low + 2 * low - 1) / 2


def plain_scores(rows, order):
    """Base and model scores from exact counts, quantised but without a filter."""
    grams = Counter()
    for doc_id, text, _ in texts_of(rows):
        if not left_out(doc_id):
            tokens = ["\n s", *words_of(text), "\n e"]
            grams[("\n s",)] += 1
            for k in range(1, order + 1):
                spans = (tuple(tokens[i : i + k]) for i in range(len(tokens) - k + 1))
                grams.update(s for s in spans if s != ("\n s",))
    single = {g[0]: c for g, c in grams.items() if len(g) == 1 and g[0] != "\n s"}
    n, v = sum(single.values()), len(single)
    out = []
    for doc_id, text, _ in texts_of(rows):
        tokens = ["\n s", *words_of(text), "\n e"]
        base = sum(math.log10((single.get(w, 0) + 1) / (n + v + 1)) for w in tokens[1:])
        score = 0.0
        for i in range(1, len(tokens)):
            chance = (quantised(single.get(tokens[i], 0)) + 1) / (n + v + 1)
            for k in range(2, min(order, i + 1) + 1):
                history = quantised(grams[tuple(tokens[i - k + 1 : i])])
                count = min(quantised(grams[tuple(tokens[i - k + 1 : i + 1])]), history)
                chance = (count + lm_scoring.PRIOR * chance) / (history + lm_scoring.PRIOR)
            score += math.log10(chance)
        known = sum(w in single for w in tokens[1:])
        out.append((doc_id, left_out(doc_id), len(tokens) - 1, known, n, base, score))
    return out


def by_size(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[2], r[5]))


@pytest.mark.parametrize(("order", "limit"), [(2, 1 << 20), (2, 0), (3, 1 << 20), (3, 0)])
def test_scores_are_those_of_quantised_counts(spark, awkward, awkward_rows, monkeypatch, order, limit):
    monkeypatch.setattr(lm_scoring, "SEGMENT_GRAMS", 1000)
    monkeypatch.setattr(lm_scoring, "HEAD_WORDS", 50)
    model = lm_scoring.fit(awkward, order)
    assert model.n_segments > 5
    got = by_size(lm_scoring.score(awkward, model, limit).collect())
    expected = by_size(plain_scores(awkward_rows, order))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5] for r in got], [r[5] for r in expected], rtol=1e-12)
    # the filter may read a few unseen n-grams as seen
    difference = np.array([abs(a[6] - b[6]) / a[2] for a, b in zip(got, expected, strict=True)])
    assert difference.max() < 0.35 and difference.mean() < 0.02
    assert all(r[6] < 0 for r in got)


def test_both_ways_give_one_score(spark, awkward, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SEGMENT_GRAMS", 1000)
    model = lm_scoring.fit(awkward)
    first, second = (by_size(lm_scoring.score(awkward, model, n).collect()) for n in (1 << 20, 0))
    assert [r[6] for r in first] == [r[6] for r in second]


def test_filter_is_never_too_low_and_seldom_too_high():
    import pyarrow as pa

    pick = np.random.default_rng(4)
    prints = pick.permutation(np.unique(pick.integers(0, 1 << 64, 60_000, dtype=np.uint64)))
    seen, unseen = np.sort(prints[:30_000]), np.sort(prints[30_000:])
    times = pick.geometric(0.3, len(seen)).astype("<i8")
    half = pa.table({"segment": [0], "prints": [seen.tobytes()], "times": [times.tobytes()]})
    row = lm_scoring._segment_filter(half, 1).to_pylist()[0]
    held = lm_scoring.Filter([row], 1, row["n_words"])
    levels = np.floor(np.log2(times)).astype(int) + 1
    assert (held.levels(seen) >= levels).all()
    assert (held.levels(seen) > levels).mean() < 0.02 and (held.levels(unseen) > 0).mean() < 0.02


def test_scores_without_rows_or_training_texts(spark, empty):
    assert lm_scoring.score(empty, lm_scoring.fit(empty)).collect() == []
    out = next(k for k in range(50) if left_out(k))
    docs = spark.createDataFrame([(out, "a b", "en")], DOCS)
    row = lm_scoring.score(docs, lm_scoring.fit(docs)).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0)


# --- phrases


def plain_phrases(rows, least, top):
    counts = defaultdict(Counter)
    for _, text, lang in texts_of(rows):
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                spans = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
                counts["und" if lang is None else lang].update(spans)
    out = []
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        wanted = {g for g, c in f.items() if len(g) > 1 and c >= least}
        hidden = {
            g[i : i + k] for g in wanted for k in range(2, len(g)) for i in range(len(g) - k + 1)
            if 100 * f[g] >= 100 * f[g[i : i + k]]
        }
        found = []
        for g in wanted - hidden:
            cuts = [(1000 * f[g] * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            found.append((-score, -f[g], " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def repetitive(awkward_rows):
    passage = "one two three four five six"
    rows = list(awkward_rows)
    rows += [(1000 + k, f"{passage} {prose(k, 5)}. Lead\x1f\x01 on,{passage}\tone two", "en") for k in range(40)]
    rows += [(2000 + k, "a a a a a a a! é è\x01 é è\x01; x", None if k % 2 else "f\tr") for k in range(30)]
    return rows


@pytest.mark.parametrize("ways", [{}, {"broadcast_bytes": 0, "shard_bytes": 20_000}, {"shard_bytes": 1}, {"broadcast_bytes": 20_000}])
def test_phrases_against_brute_force(spark, awkward_rows, tmp_path, ways):
    rows = repetitive(awkward_rows)
    docs = docs_of(spark, rows, tmp_path / "d")
    got = phrases.collocations(docs, least=3, top=70, **ways).collect()
    expected = plain_phrases(rows, 3, 70)
    assert len(expected) > 70 and {2, 5} < {len(r[2].split(" ")) for r in expected}
    assert sorted(tuple(r) for r in got) == expected


def test_no_phrases(spark, empty, awkward):
    assert phrases.collocations(empty).collect() == []
    assert phrases.collocations(awkward, least=10**6).collect() == []


def test_codes_of_rare_phrases_only_add_phrases():
    """With the codes of all pairs and triples let through, every phrase of a shard comes out, counted."""
    import pyarrow as pa

    texts = [("en", b"a b a b c, a b"), ("en", b"b a b a b c"), ("fr", b"a b"), ("en", b"c")]
    rows = pa.table(
        {
            "row": pa.array(range(4), pa.int64()),
            "lang": [lang for lang, _ in texts],
            "text": pa.array([text for _, text in texts], pa.binary()),
        }
    )
    (_, index), = phrases._indexes([phrases._shard_row(rows, 5)])
    likely = phrases.Likely(index.names, 3, [])
    for _ in range(2):
        ids = phrases.likely_phrases(index, likely, len(likely.codes) + 1)[-1][0]
        likely.codes.append(np.unique(phrases.phrase_codes(index, ids, 3)))
    found = {
        (text.decode()): n
        for ids, _, _, count in phrases.likely_phrases(index, likely, 4)
        for text, n in zip(index.spelled(ids).to_pylist(), count.tolist(), strict=True)
    }
    expected = Counter()
    for lang, text in texts:
        for piece in text.decode().split(","):
            words = piece.split()
            for k in range(2, 6):
                spans = [words[i : i + k] for i in range(len(words) - k + 1)]
                expected.update(f"{lang}\t{' '.join(span)}" for span in spans)
    assert found == expected


def test_phrases_leave_python_once(spark, awkward_rows, tmp_path, monkeypatch):
    """However many tasks hold a phrase, its counts are summed before it is spelled out."""
    made = []
    real = type(spark.range(1)).mapInArrow

    def noted(frame, *given):
        made.append(real(frame, *given))
        return made[-1]

    docs = docs_of(spark, repetitive(awkward_rows), tmp_path / "d")
    assert docs.rdd.getNumPartitions() == 3
    monkeypatch.setattr(type(docs), "mapInArrow", noted)
    _, frequent = phrases.phrase_counts(docs, least=3, shard_bytes=1000)
    spelled = [f.filter("phrase like '% %'") for f in made if "phrase" in f.columns]
    n_rows = sum(f.count() for f in spelled)
    assert n_rows == sum(f.count() for f in frequent[1:]) > 200


def test_codes_of_any_size_are_summed_exactly():
    """Blocks of several tasks hold codes of one to eight bytes and counts beyond 32 bits."""
    import pyarrow as pa

    pick = np.random.default_rng(2)
    codes = np.concatenate([np.arange(300), pick.integers(0, 1 << 60, 300), [(1 << 62) + 5]])
    counts = np.append(pick.integers(1, 300, 600), 1 << 40)
    halves = [(codes[a:b], counts[a:b]) for a, b in [(0, 400), (200, 601), (0, 150)]]
    expected = Counter()
    for half in halves:
        for code, n in zip(*half, strict=True):
            expected[int(code)] += int(n)
    blocks = pa.Table.from_batches([phrases._blocks(halves[:2], 7), phrases._blocks(halves[2:], 7)])
    found = {}
    for segment in range(7):
        rows = phrases._frequent_in(blocks.filter(pa.compute.equal(blocks["segment"], segment)), 100, 7)
        (row,) = rows.to_pylist()
        found |= zip(*(np.frombuffer(row[name], "<i8").tolist() for name in ("codes", "counts")), strict=True)
    assert found == {code: n for code, n in expected.items() if n >= 100}


def test_codes_spell_the_phrases_they_came_from():
    """No two phrases of a length share a code, and codes of rare parts are none."""
    import pyarrow as pa

    texts = [("e\tn", b"a b a b c d, a b c"), ("fr", b"a b c a b c"), ("fr", b"b c a b c")]
    rows = pa.table(
        {
            "row": pa.array(range(3), pa.int64()),
            "lang": [lang for lang, _ in texts],
            "text": pa.array([text for _, text in texts], pa.binary()),
        }
    )
    (_, index), = phrases._indexes([phrases._shard_row(rows, 5)])
    words = index.names.filter(pa.compute.not_equal(index.names, b"e\tn\td"))
    likely = phrases.Likely(words, 4, [])
    everything = index.single()
    for length in range(2, 6):
        everything = phrases._step(index, everything, length - 2)[0]
        index.learn(likely)
        codes = phrases.phrase_codes(index, everything[0], 4)
        texts = index.spelled(everything[0]).to_pylist()
        assert [c < 0 for c in codes] == [b"d" in t.split(b"\t")[-1].split() for t in texts]
        held = codes >= 0
        assert len(set(codes[held].tolist())) == held.sum() > 0
        assert likely.spelled(codes[held], length).to_pylist() == [t for t, h in zip(texts, held, strict=True) if h]
        likely.codes.append(np.sort(codes[held]))


def test_shards_are_small_rows():
    """A shard of the default size is a row of 2 MB or less, whatever a task reads: numbers take few bytes."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(range(300), pa.int64()),
            pa.array(["en", "fr"] * 150),
            pa.array([prose(k, 2000).encode() for k in range(300)], pa.binary()),
        ],
        names=["row", "lang", "text"],
    )
    assert pa.compute.sum(pa.compute.binary_length(batch["text"])).as_py() > 3 << 20
    rows = list(phrases._sharded(5, phrases.SHARD_BYTES)(iter([batch])))
    assert len(rows) > 2 and max(row.get_total_buffer_size() for row in rows) < 2 << 20
    indexes = [index for _, index in phrases._indexes(rows)]
    assert sum(int(index.counts[1:].sum()) for index in indexes) == 300 * 2000


def test_readers_hold_few_shards(spark, awkward_rows, tmp_path, monkeypatch):
    """Row groups have four shards at most and Arrow batches 4 MB, however many shards a task writes."""
    from urllib.parse import urlparse

    import pyarrow.parquet as pq

    kept = {}
    real = phrases.stored

    def noted(frame, label, **options):
        kept[label] = real(frame, label, **options)
        return kept[label]

    monkeypatch.setattr(phrases, "stored", noted)
    docs = docs_of(spark, repetitive(awkward_rows), tmp_path / "d").coalesce(1)
    phrases.phrase_counts(docs, least=3, shard_bytes=1000)
    (file,) = kept["phrase-shards"].inputFiles()
    held = pq.ParquetFile(urlparse(file).path).metadata
    sizes = [held.row_group(k).num_rows for k in range(held.num_row_groups)]
    assert held.num_rows > 8 and max(sizes) == 4
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20


def test_shards_learned_together_as_one_by_one():
    import pyarrow as pa

    rows = [
        pa.table({"row": pa.array([k], pa.int64()), "lang": ["en"], "text": pa.array([text], pa.binary())})
        for k, text in enumerate([b"a b a c", b"", b"c d, a", b"x"])
    ]
    indexes = [index for _, index in phrases._indexes([phrases._shard_row(r, 5) for r in rows])]
    likely = phrases.Likely(pa.array([b"en\ta", b"en\tc", b"en\tq"], pa.binary()), 3, [])
    phrases.learn_all(indexes, likely)
    together = [index.numbers.tolist() for index in indexes]
    for index in indexes:
        index.learn(likely)
    assert together == [index.numbers.tolist() for index in indexes]
    assert [sorted(n for n in numbers if n >= 0) for numbers in together] == [[0, 1], [], [0, 1], []]


def test_places_of_codes():
    codes = np.array([3, 5, 9])
    assert phrases.places(codes, np.array([9, 3, 4, 10, -1, 5])).tolist() == [2, 0, -1, -1, -1, 1]
    assert phrases.places(codes[:0], np.array([9, -1])).tolist() == [-1, -1]


def test_transform_counts_patterns():
    pick = np.random.default_rng(3)
    sequence = np.append(pick.integers(0, 4, 500), 0).astype(np.int32)
    order = sorted(range(501), key=lambda i: ([int(sequence[(i + k) % 501]) for k in range(5)], i))
    assert phrases.transform(sequence, 5).tolist() == [int(sequence[i - 1]) for i in order]


# --- lexical search


def plain_search(docs, items, top):
    def terms(text):
        pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
        return re.findall(pattern, (text or "").translate(LOWER))

    bags = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    bags = [(d, bag, sum(bag.values())) for d, bag in bags if bag]
    n_docs, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, bag, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * bag[t]) // (1000 * bag[t] + 12 * m))
                for t in terms(text)
                if t in bag
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored, key=lambda s: s[:3])[:top], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("slices", "blocks"), [(8 << 20, 1 << 20), (3000, 200)])
def test_search_against_brute_force(spark, awkward_rows, tmp_path, monkeypatch, slices, blocks):
    monkeypatch.setattr(lexical_search, "SLICE_BYTES", slices)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", blocks)
    docs = docs_of(spark, awkward_rows, tmp_path / "d")
    items = [(k, prose(k, 3 + k), "x") for k in range(6)]
    items += [(6, "A a b tail 日本語 it's", "x"), (6, "A a b tail 日本語 it's", "x"), (7, None, "x")]
    items += [(8, "?!", "x"), (None, "the the under", "x"), (9, "unheardof", "x")]
    schema = "item_id long, text string, score string"
    queries = spark.createDataFrame(items, schema)
    index = lexical_search.build_index(docs)
    got = lexical_search.search(index, queries, top=7).collect()
    expected = plain_search([r[:2] for r in awkward_rows], [i[:2] for i in items], 7)
    assert sorted((tuple(r) for r in got), key=repr) == expected


def test_search_stops_early_without_losing_ties():
    import pyarrow as pa

    texts = pa.array([b"t " + b"u " * (k % 40) for k in range(400)], pa.binary())
    words = lexical_search.words_of(texts, lexical_search.TERM_BYTES)
    row = lexical_search._index_row(pa.array(range(400)), words, 400, len(words.ids))
    queries = lexical_search.Queries(pa.array([b"t"], pa.binary()), np.array([700]), [0], [])
    part = lexical_search.Slice(row, 0, queries)
    visited = []
    plain = part._scores
    part._scores = lambda g, i: (visited.append(len(g)), plain(g, i))[1]
    docs, _ = part.best(np.array([0]), np.array([1]), 5)
    assert part.ids[docs].tolist() == [0, 40, 80, 120, 160]
    assert sum(visited) < len(part.m) / 4


def test_index_rows_and_row_groups_are_small(spark, tmp_path):
    from pyarrow import parquet

    rows = [(k, prose(k % 40, 2_000), "en") for k in range(1_500)]
    index = lexical_search.build_index(docs_of(spark, rows, tmp_path / "d").coalesce(1))
    files = [parquet.ParquetFile(f.removeprefix("file:")) for f in index.slices.inputFiles()]
    groups = [f.metadata.row_group(k) for f in files for k in range(f.metadata.num_row_groups)]
    assert sum(g.num_rows for g in groups) > 6
    assert max(g.num_rows for g in groups) <= 4
    sizes = [b.nbytes for f in files for b in f.iter_batches(1)]
    assert max(sizes) < 4 << 20
    assert index.slices.selectExpr("sum(size(doc_ids))").first()[0] == len(rows)


@pytest.mark.parametrize("held", [0, 1 << 20])
def test_a_task_merges_the_answers_of_its_slices(monkeypatch, held):
    import pyarrow as pa
    from types import SimpleNamespace

    monkeypatch.setattr(lexical_search, "HELD_ROWS", held)
    texts = pa.array([b"t " + b"u " * (k % 40) for k in range(400)], pa.binary())
    ids = pa.array([None if k == 0 else 1_000 - k for k in range(400)], pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, texts], names=["id", "text"])
    monkeypatch.setattr(lexical_search, "SLICE_BYTES", 900)
    slices = list(lexical_search._indexed(400, 8_200)([batch]))
    members = [(np.array([0]), np.array([1]))] * 2
    queries = lexical_search.Queries(pa.array([b"t"], pa.binary()), np.array([700]), [3, 8], members)
    out = list(lexical_search._searched(SimpleNamespace(value=queries), 11)(slices))
    assert len(slices) > 5 and (len(out) == 1) == (held > 0)
    got = sorted((r["row"], -r["score"], r["doc_id"] is None, r["doc_id"] or 0) for b in out for r in b.to_pylist())
    for row in (3, 8):
        best = [(none, doc_id) for at, _, none, doc_id in got if at == row]
        assert best[:11] == [(False, 1_000 - k) for k in range(360, 0, -40)] + [(True, 0), best[10]]
        assert held == 0 or len(best) == 11


def test_search_of_nothing(spark, empty, awkward):
    queries = spark.createDataFrame([(1, "the under")], "item_id long, text string")
    assert lexical_search.search(lexical_search.build_index(empty), queries).collect() == []
    index = lexical_search.build_index(awkward)
    assert lexical_search.search(index, queries.limit(0)).collect() == []
