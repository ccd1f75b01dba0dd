"""Exact copies, near copies, repeated passages and near vectors against plain versions."""

import collections
import hashlib
import random

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fareline.llm import common, embedding_dedup, exact_dedup, jaccard_join, substring_dedup


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_copies(spark, clashing):
    docs = plain.edge(spark, clashing)
    found = exact_dedup.exact_duplicates(docs).collect()
    groups = collections.defaultdict(list)
    for doc_id, text in plain.pairs(docs):
        groups[text or ""].append(doc_id)
    expected = []
    for text, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        for i in ids:
            expected.append((i, top, len(ids)))
    assert plain.sorted_rows((r.id, r.keep_id, r.group_size) for r in found) == plain.sorted_rows(expected)
    # One row of every group stays, and it is the one with the largest id.
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.id == r.keep_id for r in found if r.kept)
    for r in found:
        if r.full_hash is None:
            assert r.group_size == 1
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_equal_prefix_and_length_is_not_equal(spark):
    rows = [(k, "p" * 400 + str(k % 3), "en", "a", 1) for k in range(9)]
    found = exact_dedup.exact_duplicates(spark.createDataFrame(rows, plain.DOCUMENTS)).collect()
    assert {(r.id, r.keep_id, r.group_size) for r in found} == {(k, 6 + k % 3, 3) for k in range(9)}


@pytest.mark.parametrize("few", [250_000, 0])
def test_rows_of_exact_copies_stay_where_they_are_while_groups_are_few(spark, monkeypatch, few):
    monkeypatch.setattr(common, "SMALL_ROWS", few)
    rows = [(k, "p" * 300 + str(k % 7 if k % 2 else k), "en", "a", 1) for k in range(60)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = exact_dedup.without_copies(spark.createDataFrame(rows, plain.DOCUMENTS).repartition(3))
        exchanges = kept._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        found = plain.sorted_rows((r.doc_id, r.text) for r in kept.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    last = {r[1]: r[0] for r in rows}
    assert found == plain.sorted_rows((i, t) for t, i in last.items())
    assert (exchanges == 0) == (few > 0)


def test_exact_copies_write_no_whole_row(spark, monkeypatch):
    """Rows that stay come from the input; equal rows and null ids included."""
    written = []
    for module in (exact_dedup, common):
        monkeypatch.setattr(module, "stored", lambda df, name, store=module.stored: written.append(df.schema.json()) or store(df, name))
    rows = [(3, "x", "a"), (3, "x", "a"), (1, "x", "b"), (None, "y", "c"), (None, "y", "c"), (5, "", "d"), (6, None, "e"), (7, "z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, payload string").repartition(3)
    kept = exact_dedup.without_copies(docs).collect()
    assert plain.sorted_rows(map(tuple, kept)) == plain.sorted_rows([(3, "x", "a"), (None, "y", "c"), (6, None, "e"), (7, "z", None)])
    assert written and not any("payload" in schema for schema in written)


def test_exact_copies_run_without_python(spark):
    plan = exact_dedup.exact_duplicates(plain.edge(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_tables(spark):
    docs = plain.empty(spark)
    assert exact_dedup.exact_duplicates(docs).count() == 0
    assert jaccard_join.near_duplicates(docs).count() == 0
    assert jaccard_join.one_of_each(docs).count() == 0
    assert substring_dedup.without_repeats(docs).count() == 0
    vectors = spark.createDataFrame([], plain.VECTORS)
    assert embedding_dedup.near_vectors(vectors).count() == 0


# --- Near copies ------------------------------------------------------------------------


def components(df):
    return plain.sorted_rows((r.id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("clashing", [False, True])
def test_near_copies_of_odd_rows(spark, clashing):
    docs = plain.edge(spark, clashing)
    found = jaccard_join.near_duplicates(docs)
    assert components(found) == plain.sorted_rows(plain.jaccard(plain.pairs(docs)))
    stay = jaccard_join.one_of_each(docs)
    assert stay.columns == docs.columns
    kept = plain.sorted_rows((r.doc_id, r.text) for r in stay.collect())
    ids = [i for i, _ in kept if i is not None]
    # Texts without words are linked with nothing, so each of them stays.
    assert set(ids) == {0, 1, 2, 3, 5, 6, 9, 11, 12, 13} and len(ids) == 10


def test_near_copies_write_no_whole_row(spark, monkeypatch):
    """Rows that stay come from the input; equal rows, null ids and texts without words included."""
    written = []
    for module in (jaccard_join, common):
        monkeypatch.setattr(module, "stored", lambda df, name, store=module.stored: written.append(df.schema.json()) or store(df, name))
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(3, text, "a"), (3, text, "a"), (3, text, "b"), (4, text + " more", "c"), (None, text, "d"),
            (None, "one alone", "e"), (None, "one alone", "e"), (7, None, "f"), (7, "", "f"), (7, None, "f"), (9, "other", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, payload string").repartition(3)
    kept = [tuple(r) for r in jaccard_join.one_of_each(docs).collect()]
    assert len(kept) == 6 and all(k in rows for k in kept)
    assert plain.sorted_rows((i, t) for i, t, _ in kept) == plain.sorted_rows(
        [(3, text), (None, "one alone"), (7, None), (7, ""), (7, None), (9, "other")]
    )
    assert written and not any("payload" in schema for schema in written)


def test_near_copies_of_all_documents(spark):
    docs = plain.sample(spark)
    assert components(jaccard_join.near_duplicates(docs)) == plain.sorted_rows(plain.jaccard(plain.pairs(docs)))


def near_copy_rows(seed, groups=6, members=25):
    """Groups of copies that differ a little, chains among them, all sharing one passage."""
    random.seed(seed)
    passage = [f"p{k}" for k in range(40)]
    rows, doc_id = [], 0
    for g in range(groups):
        own = [f"g{g}x{k}" for k in range(random.randint(4, 160))] + passage
        for _ in range(members):
            text = list(own)
            for _ in range(random.randint(0, 6)):
                text[random.randrange(len(text))] = f"n{random.randrange(10**6)}"
            if random.random() < 0.3:
                own = text  # a chain: later members are copies of this one
            rows.append((doc_id, " ".join(text), "en", "a", 1))
            doc_id += 1
    return rows


@pytest.mark.parametrize("frequent", [2, 16])
def test_near_copies_in_groups(spark, monkeypatch, frequent):
    """With `frequent` 2 nearly all shingles are indexed in combinations."""
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", frequent)
    rows = near_copy_rows(frequent)
    docs = spark.createDataFrame(rows, plain.DOCUMENTS)
    expected = plain.jaccard([(r[0], r[1]) for r in rows])
    assert components(jaccard_join.near_duplicates(docs)) == plain.sorted_rows(expected)
    assert len({c for _, _, c in expected}) < len(rows)


@pytest.mark.parametrize("limits", [(16_384, 2_000_000), (20, 40)])
def test_near_copies_mostly_below_the_threshold(spark, monkeypatch, limits):
    """One large group whose pairs mostly miss the threshold by little: sketches and pivots leave
    many to the last round. The small limits deal the entries of a pivot out and settle pairs
    several times in one part."""
    for name, value in zip(("GROUP_ROWS", "MOST_PAIRS"), limits):
        monkeypatch.setattr(jaccard_join, name, value)
    random.seed(17)
    base = [f"b{k}" for k in range(300)]
    rows = []
    for doc_id in range(300):
        text = list(base)
        for _ in range(random.randint(6, 12)):
            text[random.randrange(len(text))] = f"n{random.randrange(10**6)}"
        rows.append((doc_id, " ".join(text), "en", "a", 1))
    random.shuffle(rows)
    expected = plain.jaccard([(r[0], r[1]) for r in rows])
    assert 1 < len({c for _, _, c in expected}) < len(rows)
    docs = spark.createDataFrame(rows, plain.DOCUMENTS).repartition(3)
    assert components(jaccard_join.near_duplicates(docs)) == plain.sorted_rows(expected)


def test_few_pairs_join_a_large_group(spark, monkeypatch):
    """Sets that miss their pivot but not the others of their group cost a few pairs each, not one with every member."""
    random.seed(29)
    base = [f"b{k}" for k in range(300)]
    rows = []
    for doc_id in range(300):
        text = list(base)
        for at in random.sample(range(300), random.randint(1, 7)):
            text[at] = f"n{random.randrange(10**6)}"
        rows.append((doc_id, " ".join(text), "en", "a", 1))
    compared, whole = [], jaccard_join._compared

    def counted(pairs, *more):
        compared.append(pairs.count())
        return whole(pairs, *more)

    monkeypatch.setattr(jaccard_join, "_compared", counted)
    found = components(jaccard_join.near_duplicates(spark.createDataFrame(rows, plain.DOCUMENTS)))
    assert found == plain.sorted_rows(plain.jaccard([(r[0], r[1]) for r in rows]))
    assert sum(compared) < 12 * len(rows), compared


def test_most_alike_pairs_of_two_components():
    sides = np.array([[1, 1, 2, 1, 1], [5, 5, 5, 5, 5]])
    share = np.array([0.2, 0.4, 0.1, 0.5, 0.3])
    assert sorted(jaccard_join._most_alike(sides, share, 2).tolist()) == [1, 2, 3]
    assert len(jaccard_join._most_alike(sides[:, :0], share[:0], 2)) == 0


def test_prefixes_lose_no_pair():
    """Any two similar sets share an index entry, whatever the frequent shingles are."""
    rng = np.random.default_rng(5)
    for trial in range(300):
        n = int(rng.integers(3, 200))
        base = np.unique(rng.integers(1, 2**63, n).astype(np.uint64))
        n = len(base)
        a = base[np.sort(rng.permutation(n)[: n - rng.integers(0, n // 4 + 1)])]
        fresh = rng.integers(1, 2**63, rng.integers(0, n // 4 + 1)).astype(np.uint64)
        b = np.unique(np.concatenate([base, fresh]))
        common = len(np.intersect1d(a, b))
        if 100 * common < 75 * (len(a) + len(b) - common) or np.array_equal(a, b):
            continue
        often = np.sort(rng.permutation(b)[: rng.integers(0, len(b) + 1)])
        rank = rng.permutation(len(often))
        left, _ = jaccard_join.entries(a, often, rank, 75)
        right, _ = jaccard_join.entries(b, often, rank, 75)
        assert len(np.intersect1d(left, right)), (trial, len(a), len(b), len(often))


def test_sketches_bound_what_sets_share():
    rng = np.random.default_rng(8)
    for _ in range(200):
        base = rng.integers(0, 2**64, rng.integers(1, 3000), dtype=np.uint64)
        x = np.unique(base[: rng.integers(1, len(base) + 1)])
        y = np.unique(np.concatenate([base[rng.integers(0, len(base)) :], rng.integers(0, 2**64, 50, dtype=np.uint64)]))
        common, both = jaccard_join.most_shared(jaccard_join.sketch(x), jaccard_join.sketch(y))
        assert common >= len(np.intersect1d(x, y)) and both == len(x) + len(y)
    assert jaccard_join.sketch(np.arange(300, dtype=np.uint64)) == b""  # a count over 255


def test_flips_bound_what_sets_do_not_share():
    rng = np.random.default_rng(9)
    sets = []
    for _ in range(60):
        base = np.unique(rng.integers(0, 2**64, rng.integers(200, 3000), dtype=np.uint64))
        sets += [base, np.unique(np.concatenate([base[rng.integers(0, 40) :], rng.integers(0, 2**64, 30, dtype=np.uint64)]))]
    i, j = (k.ravel() for k in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    column = pa.array([b"left out", *(jaccard_join.flips(s) for s in sets)], pa.binary())[1:]
    apart = jaccard_join.flips_apart(jaccard_join._bytes_of(column), i, j)
    assert all(a <= len(np.setxor1d(sets[x], sets[y])) for a, x, y in zip(apart.tolist(), i.tolist(), j.tolist()))
    # Sets of any size that share nothing are told apart, and copies are not.
    total = np.array([len(s) for s in sets])
    other = (i // 2 != j // 2) & (100 * np.minimum(total[i], total[j]) >= 75 * np.maximum(total[i], total[j]))
    assert other.any() and ((total[i] + total[j] - apart) * 175 < 150 * (total[i] + total[j]))[other].all()
    assert not apart[i == j].any()


def test_long_texts_that_share_a_passage_alone_are_not_compared_pair_by_pair(spark, monkeypatch):
    """Their counts in 256 parts agree whatever they say; the flips do not. The passage is rare, as in a large corpus."""
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", 100)
    random.seed(31)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for doc_id in range(30):
        text = [f"w{random.randrange(10**9)}" for _ in range(6000)] + passage
        rows.append((doc_id, " ".join(text), "en", "a", 1))
    compared, whole = [], jaccard_join._compared

    def counted(pairs, *more):
        compared.append(pairs.count())
        return whole(pairs, *more)

    monkeypatch.setattr(jaccard_join, "_compared", counted)
    found = components(jaccard_join.near_duplicates(spark.createDataFrame(rows, plain.DOCUMENTS)))
    assert found == plain.sorted_rows((r[0], 6056, r[0]) for r in rows)
    assert 0 < sum(compared) < 6 * len(rows), compared


@pytest.mark.parametrize("block", [4096, 40])
def test_sets_of_a_pivot_are_dealt_once_each(spark, monkeypatch, block):
    """A hundred sets that share fifty entries are a hundred rows a block, not five thousand; every two meet once."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    rows = [(t, 1, k, 400, 7, k, 0.3, 0.3) for t in range(50) for k in range(100)] + [(k // 2, 2, k, 400, 7, k, 0.3, 0.3) for k in range(200, 204)]
    fields = "token long, pivot long, key long, n int, place int, component long, low double, high double"
    groups = spark.createDataFrame(rows, fields)
    listed, named = (df.collect() for df in jaccard_join._dealt(groups, jaccard_join._shapes(groups)))
    dealt = [r for r in (*listed, *named) if r.side < 3]
    blocks = -(-100 // block)
    assert len(dealt) == 100 * blocks + 4 and len(listed) == 4
    assert {(r.part, r.key) for r in named if r.side == 3} == {(r.part, r.key) for r in listed}
    entries = collections.defaultdict(list)
    for r in dealt:
        entries[r.part, r.token].append((r.key, r.side))
    met = collections.Counter(
        (a, b) for own in entries.values() for a, x in own for b, y in own if a < b and (x != y or not x)
    )
    assert len(met) == 100 * 99 // 2 + 2 and set(met.values()) == {1}


@pytest.mark.parametrize("short", [64, 4])
def test_near_copies_in_blocks(spark, monkeypatch, short):
    """One large group whose sets are dealt into blocks of some twenty."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 20)
    monkeypatch.setattr(jaccard_join, "SMALL_GROUP", short)
    random.seed(37)
    base = [f"b{k}" for k in range(300)]
    rows = []
    for doc_id in range(200):
        text = list(base)
        for at in random.sample(range(300), random.randint(6, 12)):
            text[at] = f"n{random.randrange(10**6)}"
        rows.append((doc_id, " ".join(text), "en", "a", 1))
    expected = plain.jaccard([(r[0], r[1]) for r in rows])
    assert 1 < len({c for _, _, c in expected}) < len(rows)
    docs = spark.createDataFrame(rows, plain.DOCUMENTS).repartition(3)
    assert components(jaccard_join.near_duplicates(docs)) == plain.sorted_rows(expected)


# --- Repeated passages ------------------------------------------------------------------


def removed(df):
    return plain.sorted_rows(
        (r.id, r.n_words, sum(s.end - s.begin for s in r.removed), r.kept_text) for r in df.collect()
    )


@pytest.mark.parametrize("window", [3, 35])
def test_repeats_of_odd_rows(spark, window):
    docs = plain.edge(spark, clashing=True)
    found = substring_dedup.without_repeats(docs, window=window)
    assert removed(found) == plain.sorted_rows(plain.repeats(plain.pairs(docs), window))


def test_repeats_of_all_documents(spark):
    docs = plain.sample(spark)
    found = removed(substring_dedup.without_repeats(docs))
    assert found == plain.sorted_rows(plain.repeats(plain.pairs(docs), 35))
    assert sum(r[2] for r in found) > 0


def test_repeats_in_texts_of_few_words(spark):
    """Runs, periods and passages of other passages, where anchors repeat inside a document."""
    random.seed(4)
    rows = []
    for k in range(120):
        letters = "ab" if k % 3 else "abcdefgh"
        words = [random.choice(letters) for _ in range(random.randint(1, 90))]
        if k % 4 == 0:
            words = words[:3] * random.randint(2, 30)
        if rows and k % 5 == 0:
            other = rows[random.randrange(len(rows))][1].split()
            words = words[:4] + other[2:60] + words[4:9]
        rows.append((k, " ".join(words), "en", "a", 1))
    docs = spark.createDataFrame(rows, plain.DOCUMENTS)
    for window in (4, 9, 35):
        found = substring_dedup.without_repeats(docs, window=window)
        assert removed(found) == plain.sorted_rows(plain.repeats([(r[0], r[1]) for r in rows], window))


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    for letters in (1, 2, 3, 40):
        base = rng.integers(0, letters, 90)
        texts = [rng.integers(0, letters, rng.integers(5, 120)) for _ in range(60)]
        texts = [np.concatenate([t[:9], base, t[9:]]) if k % 3 else t for k, t in enumerate(texts)]
        flat = np.concatenate(texts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(77)
        sizes = np.array([len(t) for t in texts])
        anchor, _ = substring_dedup.anchors(flat, sizes, 35)
        names = substring_dedup.window_names(flat, 35, 1)
        seen = {}
        for p in np.flatnonzero(substring_dedup._fits(sizes, 35)):
            window = flat[p : p + 35].tobytes()
            assert seen.setdefault(window, (anchor[p], names[p])) == (anchor[p], names[p])
        assert len({n for _, n in seen.values()}) == len(seen)


# --- Vectors ----------------------------------------------------------------------------


def plain_links(rows, threshold=0.95):
    """(id, links, component) per row, by comparing everything."""
    usable = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows
    ]
    n = len(rows)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and usable[i] and usable[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], np.float32).astype(float) for k in (i, j))
                link[i, j] = a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold
    part = list(range(n))
    for _ in range(n):
        new = [min([part[i], *(part[j] for j in range(n) if link[i, j])]) for i in range(n)]
        if new == part:
            break
        part = new
    lowest = {p: min((rows[i][0] for i in range(n) if part[i] == p and rows[i][0] is not None), default=None) for p in part}
    return [(rows[i][0], int(link[i].sum()), lowest[part[i]]) for i in range(n)]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], plain.VECTORS)


def clustered(seed, n=240, size=16, spread=0.09):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, size))
    rows = [(k, (centres[k % 8] + rng.normal(size=size) * spread * (k % 5)).tolist()) for k in range(n)]
    return rows + [(n + k, rng.normal(size=size).tolist()) for k in range(60)]


def test_vectors_with_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, None), (4, []),
        (5, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 0.0]), (7, [inf, 1.0, 0.0]), (8, [None, 1.0, 0.0]), (9, [1.0, 0.0]),
        (None, [0.0, 1.0, 0.0]), (10, [0.0, 1.0, 0.01]), (None, None), (11, [1e30, 0.0, 0.0]), (12, [-1.0, 0.0, 0.0]),
    ]
    found = embedding_dedup.near_vectors(vectors(spark, rows)).collect()
    assert plain.sorted_rows((r.id, r.n_links, r.component_id) for r in found) == plain.sorted_rows(plain_links(rows))
    assert all(r.kept == (r.id == r.component_id) for r in found)


@pytest.mark.parametrize("block", [7, 2048])
def test_vectors_recall_and_components(spark, monkeypatch, block):
    """Blocks of seven rows deal every list out; the result is the same."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = clustered(2)
    expected = {r[0]: r for r in plain_links(rows)}
    found = {r.id: (r.id, r.n_links, r.component_id) for r in embedding_dedup.near_vectors(vectors(spark, rows)).collect()}
    assert all(found[i][1] <= expected[i][1] for i in expected)  # nothing below the threshold
    total = sum(e[1] for e in expected.values())
    assert total > 1000 and sum(f[1] for f in found.values()) >= 0.99 * total


@pytest.mark.parametrize("dimension", [1, 2, 3, 8, 64])
def test_recall_whatever_dimensions_the_vectors_fill(spark, dimension):
    """Vectors of 64 numbers that fill some dimensions only, half of them in pairs near the threshold."""
    rng = np.random.default_rng(dimension)
    inside = embedding_dedup.unit(rng.normal(size=(400, dimension)))
    noise = rng.normal(size=inside.shape)
    noise -= (noise * inside).sum(axis=1, keepdims=True) * inside
    near = 0.953 * inside + np.sqrt(1 - 0.953**2) * noise / np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-9)
    turned = np.linalg.qr(rng.normal(size=(64, 64)))[0][:dimension]
    data = np.concatenate([inside, near]) @ turned
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    expected = {r[0]: r for r in plain_links(rows)}
    found = {r.id: (r.id, r.n_links, r.component_id) for r in embedding_dedup.near_vectors(vectors(spark, rows)).collect()}
    total = sum(e[1] for e in expected.values())
    assert all(found[i][1] <= expected[i][1] for i in expected)
    assert total >= 790 and sum(f[1] for f in found.values()) >= 0.97 * total


def test_short_vectors_without_a_place_in_the_sample(spark, monkeypatch):
    """Their reference points are random, but not closer together than vectors that link."""
    monkeypatch.setattr(embedding_dedup, "SAMPLE", 0)
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 2)))]
    expected = plain_links(rows)
    found = embedding_dedup.near_vectors(vectors(spark, rows)).collect()
    assert plain.sorted_rows((r.id, r.n_links, r.component_id) for r in found) == plain.sorted_rows(expected)


def test_vectors_with_clashing_columns_and_long_vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(6, 20_000))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, base + 0.01 * rng.normal(size=base.shape)]))]
    names = ["node", "low", "weight", "hash", "list", "block", "with", "side", "pivots", "vector", "id", "n_links"]
    extra = vectors(spark, rows)
    for name in names:
        extra = extra.withColumn(name, F.lit("x"))
    found = embedding_dedup.near_vectors(extra).collect()
    assert plain.sorted_rows((r.id, r.n_links, r.component_id) for r in found) == plain.sorted_rows(plain_links(rows))


def test_pairs_at_the_threshold_share_pivots():
    rng = np.random.default_rng(11)
    a = embedding_dedup.unit(rng.normal(size=(2000, 64)))
    noise = rng.normal(size=a.shape)
    noise -= (noise * a).sum(axis=1, keepdims=True) * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * embedding_dedup.unit(noise)
    points = embedding_dedup.reference_points(embedding_dedup.unit(rng.normal(size=(1000, 64))))
    x, y = embedding_dedup.nearest(a, points), embedding_dedup.nearest(b, points)
    shared = (x[:, :, None] == y[:, None, :]).sum(axis=(1, 2))
    assert (shared >= 2).mean() > 0.99


def test_sha_of_the_query_is_of_the_whole_text(spark):
    row = exact_dedup.op10_exact_dedup(spark, plain.SF).orderBy("doc_id").first()
    text = plain.sample(spark).filter(f"doc_id = {row.doc_id}").first().text
    assert row.text_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("percent", [0, 49, 66, 101])
def test_jaccard_refuses_percents_it_does_not_cover(spark, percent):
    with pytest.raises(ValueError, match="percent must be"):
        jaccard_join.near_duplicates(plain.edge(spark), percent=percent)
