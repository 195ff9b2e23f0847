from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import cap_filters, exact_dedup, simhash
from tidemark.llm.components import components
from tidemark.llm.common import row_id, stored

from .conftest import groups_of


def digest_of(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()


def test_exact_groups_and_winners(awkward, awkward_rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in awkward_rows:
        groups[digest_of(text)].append((-len(text or ""), doc_id is None, doc_id))
    got = exact_dedup.exact_dedup(awkward).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in awkward_rows)
    for row in got:
        members = groups[row["text_sha256"]]
        assert row["group_size"] == len(members)
        assert row["keep_id"] == min(members)[2]
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert sorted(kept) == sorted(groups)


def test_keep_winners_keeps_columns(awkward, awkward_rows):
    kept = exact_dedup.keep_winners(awkward)
    assert kept.columns == awkward.columns
    assert len({digest_of(r["text"]) for r in kept.collect()}) == kept.count()
    assert kept.count() == len({digest_of(r[1]) for r in awkward_rows})


def test_slots_are_minimal_and_perfect(spark):
    keys = spark.range(3000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text_sha256"),
        F.lit(2).cast("long").alias("group_size"),
        F.col("id").alias("keep_id"),
        F.col("id").alias("keep_row"),
    )
    functions, slots, n_buckets = exact_dedup.build_index(stored(keys, "keys"))
    assert n_buckets == 12
    sizes = {r["bucket"]: r["n_keys"] for r in functions.collect()}
    found = defaultdict(list)
    for r in slots.collect():
        found[r["bucket"]].append(r["slot"])
    assert {b: sorted(s) for b, s in found.items()} == {b: list(range(n)) for b, n in sizes.items()}


def agreeing_digests(n, modulus):
    """n digests of one bucket; the words of the first two agree modulo ``modulus``."""
    found = ["0" * 8 + digest_of(str(k))[8:] for k in range(n)]
    words = [int(found[0][8 * k : 8 * k + 8], 16) for k in range(1, 8)]
    moved = [w - modulus if w >= modulus else w + modulus for w in words]
    found[1:2] = ["0" * 8 + "".join(f"{w:08x}" for w in moved)] * (n > 1)
    return found


def test_every_bucket_size_finds_a_seed():
    for n in (*range(1, 65), 128, 256):
        for digests in (agreeing_digests(n, n), [digest_of(f"{n} {k}") for k in range(n)]):
            made = exact_dedup._build_bucket(pd.DataFrame({"bucket": 0, "text_sha256": digests}))
            assert made["n_keys"][0] == n and made["shifts"][0] is not None


@pytest.mark.parametrize("max_seeds", [1000, 0])
def test_digests_that_agree_modulo_the_bucket_size(spark, max_seeds):
    digests = agreeing_digests(256, 256)
    rows = [(d, 2, k, k) for k, d in enumerate(digests)]
    keys = spark.createDataFrame(rows, "text_sha256 string, group_size long, keep_id long, keep_row long")
    index = exact_dedup.build_index(stored(keys, "keys"), max_seeds=max_seeds)
    assert sorted(r["slot"] for r in index[1].collect()) == list(range(256))
    asked = [*digests, *(digest_of(f"other {k}") for k in range(50))]
    found = exact_dedup.lookup(spark.createDataFrame([(d,) for d in asked], "text_sha256 string"), index)
    got = {r["text_sha256"]: (r["member"], r["keep_id"]) for r in found.collect()}
    assert got == {d: (k < 256, k if k < 256 else None) for k, d in enumerate(asked)}


def test_later_delivery_against_an_index(spark, awkward, empty):
    rows = stored(exact_dedup.with_digests(awkward), "rows")
    index = exact_dedup.build_index(stored(exact_dedup.winners(rows), "groups"))
    again = exact_dedup.remove_seen(awkward, index)
    assert again.filter("kept").count() == 0 and again.count() == awkward.count()
    nothing = exact_dedup.build_index(stored(exact_dedup.winners(rows).limit(0), "groups"))
    fresh = exact_dedup.remove_seen(awkward, nothing).drop("row").collect()
    first = exact_dedup.exact_dedup(awkward).drop("row").collect()
    key = lambda r: str(sorted(r.asDict().items(), key=str))
    assert sorted(map(key, fresh)) == sorted(map(key, first))
    assert exact_dedup.exact_dedup(empty).collect() == []


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    ones = Counter()
    for s in shingles:
        value = xxhash.xxh64_intdigest(s.encode(), 42)
        ones.update(b for b in range(64) if value >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(shingles))


def test_near_groups(awkward, awkward_rows):
    codes = [plain_fingerprint(r[1]) for r in awkward_rows]
    roots = groups_of(codes, lambda a, b: (a ^ b).bit_count() <= 4)
    ids = defaultdict(list)
    for k, root in enumerate(roots):
        ids[root].append((awkward_rows[k][0] is None, awkward_rows[k][0]))
    expected = Counter(
        (awkward_rows[k][0], f"{codes[k]:016x}", min(ids[root])[1]) for k, root in enumerate(roots)
    )
    got = simhash.near_groups(awkward).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == expected
    assert sum(r["kept"] for r in got) == len(set(roots))
    kept = simhash.keep_firsts(awkward)
    assert kept.columns == awkward.columns and kept.count() == len(set(roots))


def test_search_finds_all_pairs_and_prunes():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = base[:100] ^ (np.uint64(1) << rng.integers(0, 63, 100).astype(np.uint64))
    codes = np.concatenate([base, near])
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    i, j = simhash.search(codes, codes, 4)
    every = np.argwhere(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 4)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(map(tuple, every.tolist()))


@settings(max_examples=100, deadline=None)
@given(st.integers(0, (1 << 64) - 1), st.integers(0, 63))
def test_gray_rank_and_orders(code, step):
    value = np.array([code], dtype=np.uint64)
    rank = simhash.gray_rank(value)
    assert int(rank[0] ^ (rank[0] >> np.uint64(1))) == code
    for n in (10, 10**7, 10**10):
        leading, blocks = simhash.orders_for(n)
        out = simhash.reordered(value, leading[step % len(leading)], blocks)
        assert int(out[0]).bit_count() == code.bit_count()


@pytest.mark.parametrize("leaf, n", [(64, 1500), (1024, 1500)])
def test_one_dense_group_over_many_leaves(spark, monkeypatch, leaf, n):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    pairs = [(a, b) for a in range(64) for b in range(a)][: n - 1]
    codes = [0, *[(1 << a) | (1 << b) for a, b in pairs]]
    signed = [(int(np.array([c], dtype=np.uint64).view(np.int64)[0]),) for c in codes]
    links = simhash.fingerprint_links(stored(spark.createDataFrame(signed, "fp long"), "fp"))
    roots = components(links)
    assert roots.count() == n - 1 and roots.select("component").distinct().count() == 1
    assert links.count() < 60 * n


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(0, 300)] + [(1000, k) for k in range(900, 999)] + [(5000, 5000)]
    found = components(spark.createDataFrame(chain, "a long, b long"))
    expected = {k: 0 for k in range(1, 301)} | {k: 900 for k in range(901, 999)} | {1000: 900}
    assert {r["node"]: r["component"] for r in found.collect()} == expected


def vectors_of(spark, rows, kind, tmp_path):
    schema = f"vec_id long, embedding array<{kind}>, label int, node long, weight int, filter int"
    spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema).repartition(3).write.parquet(
        str(tmp_path / kind)
    )
    return spark.read.parquet(str(tmp_path / kind))


@pytest.mark.parametrize("kind", ["float", "double"])
def test_near_vectors_against_all_pairs(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(cap_filters, "LEAF", 32)
    rng = np.random.default_rng(1)
    centers = rng.standard_normal((30, 24)).astype(np.float32)
    rows = []
    for k in range(900):
        spread = rng.choice([0.0, 0.02, 0.08, 0.12])
        center = centers[rng.integers(0, 3 if k % 2 else 30)]
        vector = (center + spread * rng.standard_normal(24)).astype(np.float32)
        rows.append((k, vector.astype(float).tolist(), int(rng.integers(0, 3))))
    rows += [rows[0], (None, rows[1][1], rows[1][2]), (2000, None, 1), (2001, [], 1)]
    rows += [(2002, [0.0] * 24, 1), (2003, [float("nan")] * 24, 1), (2004, rows[0][1], None)]
    rows += [(2005, [1.0, None] * 12, 1), (2006, [1.0] * 5, 1), (2007, [float("inf")] * 24, 1)]
    usable = [
        r
        for r in rows
        if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])
    ]

    def linked(a, b):
        if a[2] != b[2] or len(a[1]) != len(b[1]):
            return False
        x, y = np.array(a[1]), np.array(b[1])
        return x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98

    near = np.array([[linked(a, b) for b in usable] for a in usable])
    links = near.sum(axis=1) - 1
    roots = groups_of(list(range(len(usable))), lambda i, j: near[i, j])
    ids = defaultdict(list)
    for k, root in enumerate(roots):
        ids[root].append((usable[k][0] is None, usable[k][0]))
    expected = Counter(
        (usable[k][0], int(links[k]), min(ids[root])[1]) for k, root in enumerate(roots)
    )
    expected.update((r[0], 0, r[0]) for r in rows if r not in usable and r[0] != 2003)
    expected[2003, 0, 2003] += 1
    frame = vectors_of(spark, rows, kind, tmp_path)
    got = cap_filters.near_vectors(frame).collect()
    found = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got)
    assert sum(r["n_links"] for r in got) >= 0.999 * links.sum()
    assert found == expected
    assert sum(r["kept"] for r in got) == len(set(roots)) + len(rows) - len(usable)


def test_no_vectors(spark, tmp_path):
    assert cap_filters.near_vectors(vectors_of(spark, [], "float", tmp_path)).collect() == []


def test_row_numbers_repeat(awkward):
    one = [r[0] for r in awkward.select(row_id(), "text").collect()]
    assert one == [r[0] for r in awkward.select(row_id(), "doc_id", "text").collect()]


def test_rows_keep_their_numbers_when_the_split_changes(spark, tmp_path, monkeypatch):
    """The split of the files moves between the decision and the reading of the kept rows."""
    texts = [f"text {k % 150} of {k % 150 * 7} and {k % 150 * 11}" for k in range(300)]
    rows = [(k, text) for k, text in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    vectors = [(k, [float(k % 50 == d) for d in range(50)], 0) for k in range(100)]
    schema = "vec_id long, embedding array<float>, label int"
    spark.createDataFrame(vectors, schema).repartition(6).write.parquet(str(tmp_path / "v"))
    key, before = "spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.openCostInBytes")
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for keep in (exact_dedup.keep_winners, simhash.keep_firsts, cap_filters.near_vectors):
            spark.conf.set(key, "1")
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 30))
            is_vectors = keep is cap_filters.near_vectors
            kept = keep(spark.read.parquet(str(tmp_path / "v")) if is_vectors else docs)
            spark.conf.set(key, str(1 << 30))
            spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
            ids = sorted(r[0] for r in (kept.filter("kept") if is_vectors else kept).collect())
            assert ids == list(range(50 if is_vectors else 150))
    finally:
        spark.conf.set(key, before)
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)


def test_kept_rows_keep_columns_of_any_name(spark, awkward, empty):
    """Names that an added column could have, or that need quoting, come back as they were."""
    from tidemark.llm import quality

    names = ["__row", "ROW_NUMBER_0", "__SCORE", "Score_0", "a.b", "kept", "fp"]
    for docs in (awkward, empty):
        for name in names:
            docs = docs.withColumn(name, F.lit(f"value of {name}"))
        model = quality.QualityModel(b"good text", b"bad text", (0.0,) * 6, (1.0,) * 6, (0.0,) * 6, 9.0)
        keeps = (exact_dedup.keep_winners, simhash.keep_firsts, lambda d: quality.keep_good(d, model))
        for keep in keeps:
            kept = keep(docs)
            assert kept.columns == docs.columns
            rows = kept.select(*[F.col(f"`{name}`") for name in names]).distinct().collect()
            assert [tuple(r) for r in rows] == [tuple(f"value of {n}" for n in names)] * (docs is not empty and bool(rows))


def test_a_sampled_doc_id_on_many_rows_stays_within_the_bounds(spark, monkeypatch):
    """A third of all documents carry one labelled doc_id; the fit takes no more rows than it says."""
    from tidemark.llm import quality

    monkeypatch.setattr(quality, "DICTIONARY_ROWS", {1: 20, 0: 10})
    monkeypatch.setattr(quality, "CALIBRATION_ROWS", 30)
    ids = spark.range(3000)
    labels = ids.select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    hot = quality.sample_rows(labels)[1].first()["doc_id"]
    doc_id = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id"))
    docs = ids.select(doc_id.alias("doc_id"), F.concat(F.lit("text of "), "id").alias("text"))
    seen = []
    plain = quality._logistic
    monkeypatch.setattr(quality, "_logistic", lambda x, y: (seen.append(len(x)), plain(x, y))[1])
    model = quality.fit(docs, labels)
    assert docs.filter(F.col("doc_id") == hot).count() >= 1000 and seen in ([], [30])
    assert model.good.count(b"text of") <= 20 and model.bad.count(b"text of") <= 10


def test_members_and_nonmembers_of_the_history(spark, awkward):
    found = exact_dedup.exact_dedup(awkward).collect()
    digests = exact_dedup.with_digests(awkward).filter(exact_dedup.in_history(F.col("row")))
    held = {r["text_sha256"] for r in digests.collect()}
    inside = [r for r in found if r["text_sha256"] in held]
    assert inside and len(inside) < len(found)
    assert len(found) == awkward.count() == sum(r["group_size"] for r in found if r["kept"])
