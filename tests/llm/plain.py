"""Small fixtures, and plain versions of the operators to compare with."""

import collections
import math
import re
import zlib

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, FloatType, LongType, StringType, StructField, StructType,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"

DOCUMENTS = StructType(
    [
        StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
        StructField("source", StringType()), StructField("n_chars", LongType()),
    ]
)
# Names that the operators use inside, or return.
CLASHING = StructType(
    [
        *DOCUMENTS.fields, StructField("id", LongType()), StructField("row", StringType()),
        StructField("kept", BooleanType()), StructField("size", LongType()), StructField("hash", StringType()),
        StructField("key", StringType()), StructField("shared", StringType()), StructField("length", StringType()),
        StructField("copies", StringType()), StructField("nth", StringType()), StructField("block", StringType()),
        StructField("score", StringType()), StructField("component_id", StringType()),
    ]
)

LONG = " ".join(f"w{k * 7919 % 5003}" for k in range(20_000))
NEAR = " ".join(f"v{k}" for k in range(300))
EDGE = [
    (0, "The quick brown fox jumps over the lazy dog.", "en", "a", 1),
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (None, "words without any id at all here", "en", "b", 1),
    (None, None, "en", "b", 1),
    (3, LONG, "en", "c", 1),
    (4, LONG, "en", None, 1),
    (4, LONG, "en", None, 1),
    (5, " \t\n\r ", "en", "c", 1),
    (6, NEAR, "en", "a", 1),
    (7, NEAR + " another end", "en", "b", 1),
    (8, "start " + NEAR, "en", None, 1),
    (9, "two words", "en", "a", 1),
    (10, "Two Words", "en", "a", 1),
    (11, "same same same same " * 40, "en", "d", 1),
    (12, "日本語 のテキスト é́ 😀😀 a\x00b ▁x ▁ <|endoftext|> <s>", "ja", "d", 1),
    (13, "x" * 3000, "xx", "d", 1),
]


def edge(spark, clashing=False):
    if not clashing:
        return spark.createDataFrame(EDGE, DOCUMENTS).repartition(3)
    extra = (1, "r", True, 2, "h", "k", "s", "l", "c", "n", "b", "s", "c")
    return spark.createDataFrame([r + extra for r in EDGE], CLASHING).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def sample(spark):
    """The whole smallest table of documents."""
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df, *columns):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def sorted_rows(rows):
    return sorted(rows, key=repr)


def repeats(docs, window):
    """(id, words, removed, kept text) of every document."""
    found = [words(t) for _, t in docs]
    seen = collections.Counter(tuple(w[k : k + window]) for w in found for k in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, found):
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((doc_id, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def shingles(text, size=5):
    w = words(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1)))


def jaccard(docs, percent=75):
    """(id, shingles, smallest id of the component) of every document; docs are (id, text)."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(set)
    for k, own in enumerate(sets):
        for s in own:
            holders[s].add(k)
    for k, own in enumerate(sets):
        for j in {j for s in own for j in holders[s] if j < k}:
            common = len(own & sets[j])
            if 100 * common >= percent * (len(own) + len(sets[j]) - common):
                parent[find(k)] = find(j)
    lowest = {}
    for k, (doc_id, _) in enumerate(docs):
        root = find(k)
        known = [i for i in (lowest.get(root), doc_id) if i is not None]
        lowest[root] = min(known) if known else None
    return [(docs[k][0], len(sets[k]), lowest[find(k)]) for k in range(len(docs))]


def suffix_tree(docs, depth, p_min, least_gain, mass):
    """{id: (held out, tokens, known, N, base score, score)} for documents (id, text)."""
    end = object()
    tokens = {i: [*words(lower(t or "")), end] for i, t in docs}
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i in tokens}
    train = [t for i, t in tokens.items() if not held[i]]
    counts = [collections.Counter() for _ in range(depth + 2)]
    for t in train:
        for length in range(1, depth + 2):
            counts[length].update(tuple(t[k : k + length]) for k in range(len(t) - length + 1))
    n = sum(map(len, train))
    v = len(counts[1])
    least = max(1, math.ceil(p_min * n))
    often = [{s: c for s, c in own.items() if c >= least} for own in counts]

    def base(w):
        return (counts[1][(w,)] + 0.5) / (n + 0.5 * (v + 1))

    total = collections.Counter()
    for length in range(2, depth + 2):
        for s, c in often[length].items():
            total[s[:-1]] += c

    def probability(context, w):
        if not context:
            return base(w)
        below = probability(context[1:], w)
        return (often[len(context) + 1].get((*context, w), 0) + mass * below) / (total[context] + mass)

    retained = set()
    for length in range(depth, 0, -1):
        gains = collections.Counter()
        for s, c in often[length + 1].items():
            gains[s[:-1]] += c * math.log(probability(s[:-1], s[-1]) / probability(s[1:-1], s[-1]))
        keep = {s for s in often[length] if gains[s] >= least_gain and s[-1] is not end}
        keep |= {s[1:] for s in retained if len(s) == length + 1}
        retained |= keep
    out = {}
    for i, t in tokens.items():
        score = plain_score = known = 0
        for k, w in enumerate(t):
            plain_score += math.log10(base(w))
            known += counts[1][(w,)] > 0
            context = ()
            for length in range(1, min(depth, k) + 1):
                if tuple(t[k - length : k]) not in retained:
                    break
                context = tuple(t[k - length : k])
            score += math.log10(probability(context, w))
        out[i] = (held[i], len(t), known, n, plain_score, score)
    return out


VECTORS = StructType(
    [
        StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType())),
        StructField("label", StringType()), StructField("node", DoubleType()),
    ]
)
