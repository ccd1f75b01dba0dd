"""The conversation trie against a plain version and its SQL twin."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fareline.llm import conversation_trie

TURNS = StructType(
    [
        StructField("conv_id", LongType()), StructField("turn", LongType()),
        StructField("role", StringType()), StructField("text", StringType()),
    ]
)
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        said = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        own.setdefault(conv, []).append(((turn is not None, turn or 0), said, (role, text)))
    own = {c: [t[2] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for conv, turns in own.items():
        heads = zlib.crc32(b"" if conv is None else str(conv).encode()) % 4
        base = [] if conv is None else own.get(conv - int(math.fmod(conv, 20)), [])
        whole = base[:heads] + turns[heads:]
        for depth in range(len(whole) + 1):
            members.setdefault(tuple(whole[:depth]), []).append(conv)
        ends.setdefault(tuple(whole), []).append(conv)
    low = {node: min((c for c in convs if c is not None), default=None) for node, convs in members.items()}
    children, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += children[node] == 0
            saved[node[:depth]] += (len(convs) - 1) * words
    out = []
    for node, convs in members.items():
        ids = ",".join(str(c) for c in sorted(c for c in ends.get(node, []) if c is not None))
        out.append(
            (low[node], len(node), low[node[:-1]] if node else None, len(convs), children[node], leaves[node],
             saved[node], hashlib.sha256(ids.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


EDGE = [
    (0, 0, "user", "same first words"), (0, 1, "assistant", "an answer"), (0, None, None, "before all others"),
    (3, 0, "user", "same first words"), (3, 1, None, None), (3, 1, None, None), (3, 2, "", ""),
    (7, 5, "user", "tie b"), (7, 5, "user", "tie a"), (7, 5, "system", "tie a"),
    (21, 0, "user", "no base there"), (22, 0, "x", "one two"), (23, 0, "y", "a b c d"), (24, 0, "user", "one"),
    (19, 0, "user", "x " * 5000), (None, 0, "user", "no id"), (None, 1, "user", "no id"),
    (-5, 0, "user", "below zero"), (40, 0, "user", "日本語 ▁\x00 é́"),
    *[(1000 + k, t, "user", f"copy {t}") for k in range(0, 400, 20) for t in range(3)],
]


def random_turns(seed, count=300):
    draw = random.Random(seed)
    return [
        (conv, turn, draw.choice(["user", "assistant", None]), draw.choice(["a", "a b", "", None]))
        for conv in range(count) for turn in range(draw.randrange(5))
    ]


@pytest.mark.parametrize("rows", [EDGE, random_turns(1)], ids=["edge", "random"])
@pytest.mark.parametrize("small", [False, True])
def test_trie_equals_the_plain_one(spark, monkeypatch, rows, small):
    """Also where the tour is contracted, sums cross blocks, and ends make several chunks."""
    if small:
        monkeypatch.setattr(conversation_trie, "WALKED", 40)
        monkeypatch.setattr(conversation_trie, "BLOCK", 7)
        monkeypatch.setattr(conversation_trie, "CHUNK", 60)
    table = spark.createDataFrame(rows, TURNS).repartition(5)
    assert found(conversation_trie.trie(table)) == plain(rows)


@pytest.mark.parametrize("rows", [EDGE, random_turns(2)], ids=["edge", "random"])
def test_twin_gives_the_same(rows):
    columns = zip(*rows)
    duck = duckdb.connect()
    duck.register("conversations", pa.table(dict(zip(TURNS.names, (pa.array(c) for c in columns)))))
    twin = duck.execute(f"SELECT {', '.join(COLUMNS)} FROM ({conversation_trie.OP12_SQL})").fetchall()
    assert sorted(twin, key=repr) == plain(rows)


def test_one_conversation_holds_most_turns(spark, monkeypatch):
    """Its places, prefixes and subtrees come from several tasks."""
    monkeypatch.setattr(conversation_trie, "BLOCK", 64)
    monkeypatch.setattr(conversation_trie, "WALKED", 500)
    rows = [(20, t, "user", f"turn {t % 7}") for t in range(900)] + [(21, t, "user", f"turn {t % 7}") for t in range(3)]
    rows += [(20, 901, "user", "the same")] * 50 + [(c, 0, "user", "other") for c in range(60, 90)]
    table = spark.createDataFrame(rows, TURNS).repartition(5)
    assert found(conversation_trie.trie(table)) == plain(rows)


def test_ranks_of_a_list(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "WALKED", 10)
    order = random.Random(3).sample(range(10_000), 400)
    links = spark.createDataFrame(list(zip(order, [*order[1:], None])), "id long, next long")
    ranks = {r.id: r.rank for r in conversation_trie.ranked(links).collect()}
    assert [ranks[i] for i in order] == list(range(400))


def test_empty_table_and_clashing_columns(spark):
    names = ["conv", "place", "words", "index", "nth", "a", "b", "depth", "size", "id", "rank", "said"]
    schema = StructType([*TURNS.fields, *(StructField(n, StringType()) for n in names)])
    assert conversation_trie.trie(spark.createDataFrame([], schema)).collect() == []
    rows = [(r[:4] + tuple(names)) for r in EDGE[:9]]
    assert found(conversation_trie.trie(spark.createDataFrame(rows, schema))) == plain(EDGE[:9])


def test_heads_are_checksums(spark):
    ids = [0, 1, 19, 20, 123456789, -7]
    got = spark.createDataFrame([(i,) for i in ids], "c long").select(conversation_trie.heads_of(F.col("c"))).collect()
    assert [r[0] for r in got] == [zlib.crc32(str(i).encode()) % 4 for i in ids]
