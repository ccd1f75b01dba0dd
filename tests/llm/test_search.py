"""Ranked search against a plain version."""

import math
import random
import re
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fareline.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])
ITEMS = StructType([StructField("item_id", LongType()), StructField("text", StringType())])


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranking(docs, items, k=50):
    counts = [Counter(terms(text)) for _, text in docs]
    n_docs, n_terms = sum(bool(c) for c in counts), sum(c.total() for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        asked, scored = set(terms(text)), []
        for (doc, _), c in zip(docs, counts):
            if asked & c.keys():
                m = 50 + (50 * c.total() * n_docs) // n_terms
                score = sum(
                    math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in asked & c.keys()
                )
                if score > 0:
                    scored.append((-score, doc is None, doc))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k=50, parts=3):
    table = spark.createDataFrame(docs, DOCS).repartition(parts)
    asked = spark.createDataFrame(items, ITEMS).repartition(2)
    got = lexical_search.search(lexical_search.build_index(table), lexical_search.item_terms(asked), k)
    return sorted((tuple(r) for r in got.select("item_id", "rank", "id", "score").collect()), key=repr)


def zipf(seed, count, words=400):
    draw = random.Random(seed)
    weights = [1 / (k + 1) for k in range(words)]
    return [
        (i, " ".join(f"w{w}" for w in draw.choices(range(words), weights, k=draw.randrange(1, 60))))
        for i in range(count)
    ]


EDGE = [(r[0], r[1]) for r in plain.EDGE] + [
    (30, "Fox-fox.FOX fÖx föx   x y ½"), (31, "fox"), (32, "fox"), (33, "fox"), (33, "fox"), (None, "fox"), (-1, "fox"),
]
ASKED = [
    (0, "the lazy fox"), (1, None), (2, ""), (3, "... !"), (4, "nowhere"), (None, "fox"), (5, "FOX fox dog"), (5, "same"),
    (6, "w0 w1 w2 v1 v2 v299"), (7, "FÖX föx"), (8, "日本語 ½"), (9, plain.LONG),
]


@pytest.mark.parametrize("k", [1, 3, 50])
@pytest.mark.parametrize("small", [False, True])
def test_edge_cases_equal_the_plain_ranking(spark, monkeypatch, k, small):
    if small:
        for name, value in [("BLOCK_BYTES", 200), ("RANGE", 2), ("STRIDE", 1), ("PASS_TERMS", 2000), ("SLICE_BYTES", 64)]:
            monkeypatch.setattr(lexical_search, name, value)
    assert found(spark, EDGE, ASKED, k) == ranking(EDGE, ASKED, k)


@pytest.mark.parametrize("share", [1, 16, 10**9])
def test_many_documents_equal_the_plain_ranking(spark, monkeypatch, share):
    """All lists short, both kinds, and all lists long; with blocks of some hundred documents."""
    monkeypatch.setattr(lexical_search, "LONG_SHARE", share)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 30_000)
    monkeypatch.setattr(lexical_search, "RANGE", 8)
    docs, items = zipf(1, 3000), zipf(2, 25)
    docs += [(5000 + i, docs[7][1]) for i in range(900)]  # a large group of copies
    assert found(spark, docs, items, 20) == ranking(docs, items, 20)


def test_documents_are_skipped(monkeypatch):
    """Once the best are known, most ranges and candidates are left out."""
    docs = zipf(3, 4000)
    block = lexical_search._block(pa.array([d for d, _ in docs]), pa.array([t for _, t in docs]), True)
    row = block.to_pylist()[0]
    n_docs, n_terms = row["n_with_terms"], row["n_terms"]
    here = np.frombuffer(row["terms"], np.uint64)
    counts = lexical_search._unpacked(row["counts"], len(here))
    weights = np.array([lexical_search.weight(n_docs, int(n)) for n in counts])
    lists = lexical_search.Lists(row, here, weights, n_docs, n_terms)
    best = lexical_search.Best(5, 0)
    best.block = np.arange(4000), np.zeros(4000, bool)
    asked = np.searchsorted(here, np.unique(lexical_search.terms_of(pa.array(["w0 w1 w2 w300 w301"]))[0]))
    lists.search(asked, best)
    again, offered = lexical_search.Best(5, best.least()), []
    again.block = best.block
    offer = lexical_search.Best.offer
    monkeypatch.setattr(lexical_search.Best, "offer", lambda self, d, s: (offered.append(len(d)), offer(self, d, s)))
    lists.search(asked, again)
    assert again.ids.tolist() == best.ids.tolist() and sum(offered) < 40


def test_empty_tables_and_clashing_columns(spark):
    assert found(spark, [], ASKED) == found(spark, EDGE, []) == found(spark, [(1, None), (2, " ")], ASKED) == []
    names = ["id", "nth", "terms", "rank", "score", "lead", "sizes", "item_id"]
    docs = spark.createDataFrame(
        [r + tuple(names) for r in EDGE], StructType([*DOCS.fields, *(StructField(n, StringType()) for n in names)])
    )
    asked = spark.createDataFrame(
        [r + tuple(names[:-1]) for r in ASKED], StructType([*ITEMS.fields, *(StructField(n, StringType()) for n in names[:-1])])
    )
    got = lexical_search.search(lexical_search.build_index(docs), lexical_search.item_terms(asked))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == ranking(EDGE, ASKED)


def test_factors_beyond_64_bits():
    sizes = np.array([0, 7, 10**9])
    assert lexical_search.length_factors(sizes, 10**12, 10**15).tolist() == [50 + 50 * n * 10**12 // 10**15 for n in sizes.tolist()]
