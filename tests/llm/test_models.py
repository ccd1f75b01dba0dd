"""Scores, the classifier, the mix and the encoders against plain versions."""

import collections
import zlib

import numpy as np
import plain
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fareline.llm import mixing, quality, sentence_pieces, suffix_tree, token_files
from fareline.session import scratch_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def held(docs):
    return suffix_tree.fold(F.col("doc_id")) == suffix_tree.HELD_OUT


# --- Language model ---------------------------------------------------------------------


@pytest.mark.parametrize("block,p_min,gain", [(50, 2e-4, 2.0), (2_000_000, 1e-6, 8.0)])
def test_scores_equal_the_plain_tree(spark, monkeypatch, block, p_min, gain):
    """Also with blocks of a few documents each."""
    monkeypatch.setattr(suffix_tree, "BLOCK_TOKENS", block)
    docs = plain.sample(spark).select("doc_id", "text").limit(60)
    rows = plain.pairs(docs)
    fixed = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffix_tree.scores(fixed, held(fixed), p_min=p_min, least_gain=gain).collect()
    expected = plain.suffix_tree(rows, suffix_tree.DEPTH, p_min, gain, suffix_tree.MASS)
    assert len(found) == len(rows)
    for r in found:
        out, n, known, total, base, score = expected[r.id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


@pytest.mark.parametrize("block", [50, 500, 2_000_000])
def test_every_string_counts(spark, monkeypatch, block):
    """Contexts of one block and of several, whatever the blocks are."""
    monkeypatch.setattr(suffix_tree, "BLOCK_TOKENS", block)
    rows = plain.pairs(plain.sample(spark).select("doc_id", "text").limit(60))
    fixed = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffix_tree.scores(fixed, held(fixed), least_gain=2.0).collect()
    expected = plain.suffix_tree(rows, suffix_tree.DEPTH, 0, 2.0, suffix_tree.MASS)
    assert len(found) == len(rows)
    for r in found:
        assert r.score == pytest.approx(expected[r.id][5], rel=1e-9)


def test_strings_travel_in_parts_of_a_block(spark, monkeypatch):
    """A written row holds the strings that a block has of a part, not one string."""
    monkeypatch.setattr(suffix_tree, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(suffix_tree, "PART_TOKENS", 1000)
    written, store = {}, suffix_tree.stored

    def counted(df, name):
        out = store(df, name)
        written[name] = written.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(suffix_tree, "stored", counted)
    rows = plain.pairs(plain.sample(spark).select("doc_id", "text").limit(60))
    fixed = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = suffix_tree.scores(fixed, held(fixed), least_gain=2.0).collect()
    expected = plain.suffix_tree(rows, suffix_tree.DEPTH, 0, 2.0, suffix_tree.MASS)
    assert all(r.score == pytest.approx(expected[r.id][5], rel=1e-9) for r in found) and len(found) == len(rows)
    parts = 1 + sum(r.n_tokens for r in found) // 1000
    blocks = written["token-blocks"]
    assert parts > 1 and blocks > 3
    assert written["string-counts"] <= blocks * parts * (suffix_tree.DEPTH + 1)
    assert written["retained"] <= blocks * (parts + 1) * suffix_tree.DEPTH


def test_gains_and_names_travel_whole():
    gains = np.array([0.0, -3.25, 8.0, 1e5, np.inf, 1e-9])
    assert np.allclose(suffix_tree._gains_back(suffix_tree._gains(gains)), gains, rtol=0, atol=2.0**-33)
    names = np.sort(np.random.default_rng(5).integers(0, 1 << 63, 1000).astype(np.uint64) * 2 + 1)
    assert (suffix_tree._names_back(suffix_tree._names(names)) == names).all()
    counts = np.array([0, 1, 254, 255, 256, 10**12])
    assert (suffix_tree._counts(suffix_tree._packed(counts)) == counts).all()


def test_rare_strings_count_in_a_large_corpus(spark):
    """With 3.2 million training tokens, a millionth of them is more than three."""
    rows, k = [], 0
    for text, out in [("x " * 3_200_000, False), ("ab cd ef gh", False), ("ab cd ef gh", True)]:
        while (zlib.crc32(str(k).encode()) % 5 == 1) != out:
            k += 1
        rows.append((k, text))
        k += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.id: r for r in suffix_tree.scores(docs, held(docs)).collect()}
    expected = plain.suffix_tree(rows, suffix_tree.DEPTH, 0, suffix_tree.LEAST_GAIN, suffix_tree.MASS)
    for i, r in found.items():
        assert r.score == pytest.approx(expected[i][5], rel=1e-9)
    last = found[rows[2][0]]
    assert last.held_out and last.score > last.base_score + 5


def test_rare_next_words_keep_their_share(spark):
    """Most of what follows `ab` are words met three times, less than a millionth of the tokens."""
    train, out = [k for k in range(40) if zlib.crc32(str(k).encode()) % 5 != 1], 5
    while zlib.crc32(str(out).encode()) % 5 != 1:
        out += 1
    tail = [f"t{k}" for k in range(60)]
    seen = " ".join(f"ab {w}" for w in tail * 3) + " ab often" * 60
    rows = [(train[0], "x " * 3_200_000), (train[1], seen), (out, " ".join(f"ab {w}" for w in tail))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    last = next(r for r in suffix_tree.scores(docs, held(docs)).collect() if r.held_out)
    assert last.score > last.base_score


def test_scores_of_odd_rows(spark):
    docs = plain.edge(spark, clashing=True)
    found = suffix_tree.scores(docs, held(docs)).collect()
    assert collections.Counter(r.id for r in found) == collections.Counter(i for i, _ in plain.pairs(docs))
    by_id = {r.id: r for r in found}
    assert by_id[1].n_tokens == by_id[2].n_tokens == by_id[5].n_tokens == 1
    assert by_id[3].n_tokens == 20_001 and all(r.score <= 0 for r in found)
    assert by_id[1].held_out == (zlib.crc32(b"1") % 5 == 1)
    empty = plain.empty(spark)
    assert suffix_tree.scores(empty, held(empty)).count() == 0
    nothing = suffix_tree.scores(docs, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 for r in nothing)


def test_contexts_help_on_held_out_documents(spark):
    docs = plain.sample(spark).select("doc_id", "text")
    out = suffix_tree.scores(docs, held(docs)).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


def test_next_words_sum_to_one():
    rng = np.random.default_rng(0)
    found = rng.integers(0, 6, 5000)
    words, counts = np.unique(found, return_counts=True)
    first = suffix_tree.Strings(words, counts, np.zeros(len(words), np.int64))
    at = np.arange(1, len(found))
    keys, n = np.unique(found[at - 1] << suffix_tree.WORD_BITS | found[at], return_counts=True)
    second = suffix_tree.Strings(keys, n, keys & ((1 << suffix_tree.WORD_BITS) - 1))
    suffix_tree.retain([first, second], len(found), len(words), -1e9)
    base = (counts + 0.5) / (len(found) + 0.5 * (len(words) + 1))
    for context in range(len(words)):
        total = sum(
            suffix_tree.probabilities([first, second], np.array([context, w]), np.array([2]), base[[context, w]])[1]
            for w in range(len(words))
        )
        # The root leaves half a count to unknown words.
        assert total == pytest.approx(
            (first.total[context] + suffix_tree.MASS * base.sum()) / (first.total[context] + suffix_tree.MASS)
        )


# --- Quality ----------------------------------------------------------------------------


def test_classifier_agrees_with_labels(spark):
    """Labels are not used in training, so all of them are held out."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality.classify(docs).withColumnRenamed("id", "doc_id").join(labels, "doc_id")
    counts = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) == 0  # clean documents stay
    assert counts.get((0, False), 0) >= 0.9 * (counts.get((0, False), 0) + counts.get((0, True), 0))


def test_classifier_with_odd_rows(spark):
    docs = plain.edge(spark, clashing=True)
    found = quality.classify(docs)
    assert found.count() == docs.count()
    assert found.filter("kept IS NULL OR score IS NULL OR posterior IS NULL").count() == 0
    assert {tuple(r.votes) for r in found.filter("id IN (1, 2, 5)").collect()} == {(0,) * len(quality.LABELLERS)}
    kept = quality.good_documents(docs)
    assert kept.columns == docs.columns and kept.count() == found.filter("kept").count()
    assert quality.classify(plain.empty(spark)).count() == 0


def test_sample_stays_bounded_with_repeated_rows(spark, monkeypatch):
    """The row of least hash repeated 3,000 times is one document of the sample."""
    monkeypatch.setattr(quality, "SAMPLE", 100)
    docs = spark.read.parquet(f"{plain.SF}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    tie = F.xxhash64("doc_id", "text")
    hashed = docs.select(tie.alias("tie"), "text")
    least = hashed.orderBy(F.col("tie").bitwiseAND(F.lit(2**63 - 1))).limit(1)
    many = hashed.unionByName(least.crossJoin(spark.range(3000)).select("tie", "text"))
    model = quality.train(many)
    assert 1 <= model["sampled"] <= 100


def test_weights_stand_for_repeated_documents():
    """Fitting with counts equals fitting on the repeated rows."""
    rng = np.random.default_rng(3)
    count = 40
    doc = np.repeat(np.arange(count), 5)
    column, value = rng.integers(0, 30, len(doc)), rng.random(len(doc))
    goal, times = rng.random(count), rng.integers(1, 5, count)
    weights, bias = quality.fit(doc, column, value, goal, times=times.astype(float))
    order = np.repeat(np.arange(count), times)
    repeated = [np.flatnonzero(doc == d) for d in order]
    again, bias_again = quality.fit(
        np.repeat(np.arange(len(order)), 5), column[np.concatenate(repeated)], value[np.concatenate(repeated)], goal[order]
    )
    assert np.allclose(weights, again, atol=1e-6) and abs(bias - bias_again) < 1e-6


def test_estimation_finds_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(40_000) < 0.8
    right = np.array([[0.9, 0.98], [0.7, 0.95], [0.6, 0.99], [0.8, 0.9]])  # on poor, on good
    votes = np.stack([
        np.where(rng.random(len(good)) < 0.2, 0, np.where(rng.random(len(good)) < r[good.astype(int)], 1, -1) * np.where(good, 1, -1))
        for r in right
    ], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    prior, praise, _ = quality.estimate(patterns, counts)
    assert prior == pytest.approx(0.8, abs=0.03)
    assert np.abs(praise[:, 1] - right[:, 1]).max() < 0.03 and np.abs(1 - praise[:, 0] - right[:, 0]).max() < 0.05


# --- Mixing -----------------------------------------------------------------------------


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = total - sum(fixed.values())
        open_ = [s for s in names if s not in fixed]
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update((s, 3 * sizes[s]) for s in over)


def check_mix(docs):
    found = mixing.mix(docs).collect()
    assert len(found) == docs.count()
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r.source] += len(plain.words(r.text))
    goal, taken, largest = plain_targets(sizes), collections.Counter(), collections.Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source], rel=1e-12)
        assert 0 <= r.copies <= 3
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
    for source, target in goal.items():
        assert abs(taken[source] - target) <= largest[source], source
    return found


def test_mix_of_all_documents(spark):
    docs = plain.sample(spark)
    found = check_mix(docs)
    again = mixing.mix(docs.repartition(5)).collect()
    assert plain.sorted_rows(found) == plain.sorted_rows(again)


def test_mix_with_odd_rows(spark):
    docs = plain.edge(spark, clashing=True)
    found = mixing.mix(docs).collect()
    assert len(found) == len(plain.EDGE)
    assert {r.size for r in found if r.id in (1, 2, 5)} == {0}
    # Repeated rows are taken alike.
    assert len({r.copies for r in found if r.id == 4}) == 1
    rows = mixing.mixed(docs)
    assert rows.columns == docs.columns and rows.count() == sum(r.copies for r in found)
    assert mixing.mix(plain.empty(spark)).count() == 0
    silent = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", None, 0)], plain.DOCUMENTS)
    # Nothing to share out: such rows fit into a budget of 0 and are taken once.
    assert [(r.target, r.size, r.copies) for r in mixing.mix(silent).collect()] == [(0.0, 0, 1)] * 2


def test_refinement_finds_one_boundary(spark):
    """Many documents of one word: the boundary needs several levels, and the mix is exact."""
    rows = [(k, f"w{k}", "en", "a" if k % 10 else "b", 1) for k in range(4000)]
    found = check_mix(spark.createDataFrame(rows, plain.DOCUMENTS))
    taken = collections.Counter()
    for r in found:
        taken[r.source] += r.size * r.copies
        assert abs(r.copies * r.source_size - r.target) <= r.source_size
    assert taken == {"a": 2800, "b": 1200}


# --- Encoders ---------------------------------------------------------------------------


def texts_to_encode(spark):
    return [t or "" for _, t in plain.pairs(plain.edge(spark))] + [
        " lead", "trail ", "a\n\nb\tc", "▁▁a", "<0x41>", "ﬁ Å Å", "İSTANBUL ΑΣ.", "don't I'LL", "a b\x1cc　d",
    ]


def test_pieces_equal_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = texts_to_encode(spark) + [t for _, t in plain.pairs(plain.sample(spark))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sentence_pieces.encode_and_decode(docs, PIECES).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert list(r.piece_ids) == ids and r.decoded_text == library.decode(ids)


def test_agenda_by_heap_and_together():
    model = sentence_pieces.Model(open(PIECES, "rb").read())
    rng = np.random.default_rng(2)
    for _ in range(300):
        chunk = "▁" + "".join(rng.choice(list("abtheinor▁é日"), rng.integers(1, 90))).replace("▁", "")
        symbols = model.symbols(chunk)
        ids = model.spelled(model.merge_alone(symbols))
        assert ids == model.spelled(model.merge_together([symbols, symbols])[1])
        assert ids == model.library.encode(chunk[1:]) or chunk == "▁"


def test_a_difference_from_the_library_stops_the_job():
    model = sentence_pieces.Model(open(PIECES, "rb").read())
    model.pair_into = model.pair_into[::-1].copy()
    with pytest.raises(ValueError, match="the library encodes"):
        model.encode_chunks(["▁there", "▁another", "▁working"])


@pytest.mark.parametrize("chunk", ["there", "another", "\n", "é", "▁"])
def test_chunks_without_a_mark_are_compared(chunk):
    model = sentence_pieces.Model(open(PIECES, "rb").read())
    found = model.encode_chunks([chunk])
    with pytest.raises(ValueError, match="the library encodes"):
        model.compare([chunk], [[*found[0], found[0][0]]])


def test_pieces_keep_columns(spark):
    docs = plain.edge(spark, clashing=True)
    found = sentence_pieces.encode(docs, PIECES)
    assert found.columns == [*docs.columns, "piece_ids"] and found.count() == docs.count()
    assert sentence_pieces.encode(plain.empty(spark), PIECES).count() == 0
    with pytest.raises(ValueError, match="already has"):
        sentence_pieces.encode(found, PIECES)


def plain_tokens(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    return [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_token_files_equal_the_library(spark):
    texts = texts_to_encode(spark) + [t for _, t in plain.pairs(plain.sample(spark))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs, path, WORDS)
    found = token_files.read_token_files(spark, path).orderBy("doc_id").collect()
    expected, start = plain_tokens(texts), 0
    assert [r.doc_id for r in found] == list(range(len(texts)))
    for r, ids in zip(found, expected):
        assert (r.start, r.n_tokens, list(r.ids)) == (start, len(ids), ids)
        start += len(ids)
    sums = {r.doc_id: r.ids_crc32 for r in token_files.with_crc32(token_files.read_token_files(spark, path)).collect()}
    assert sums == {k: zlib.crc32(np.array(ids, "<u4").tobytes()) for k, ids in enumerate(expected)}


def test_token_files_of_odd_rows(spark):
    docs = plain.edge(spark, clashing=True)
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs, path, WORDS)
    found = token_files.read_token_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((r[0] for r in plain.EDGE), key=lambda i: -1 if i is None else i)
    assert found[-1].start + found[-1].n_tokens == sum(r.n_tokens for r in found)
    assert [list(r.ids) for r in found if r.doc_id in (1, 2, 5)] == [[1]] * 3
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(plain.empty(spark), path, WORDS)
    assert token_files.read_token_files(spark, path).count() == 0


def test_token_files_are_pruned_by_id(spark):
    """The filter reaches the ORC reader, and the files hold indexes and Bloom filters."""
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(plain.sample(spark), path, WORDS)
    one = spark.read.schema(token_files.SCHEMA).orc(path).filter("doc_id = 7")
    assert "EqualTo(doc_id,7)" in one._jdf.queryExecution().toString() and one.count() == 1
    files = spark.read.format("binaryFile").load(path).filter("path LIKE '%.orc'").collect()
    assert files and all(bytes(f.content[:3]) == b"ORC" for f in files)


def test_workers_forget_what_other_operators_kept():
    """Python workers outlive a step; the next one's tasks free the caches that are not theirs."""
    from fareline.llm import common

    with open(PIECES, "rb") as file:
        proto = file.read()
    first = list(sentence_pieces.model_of(proto).encode(["some words"]))
    common.names(["some", "words"])
    assert sentence_pieces._models and common._names
    common.drop_caches()
    assert not sentence_pieces._models and not common._names
    again = list(sentence_pieces.model_of(proto).encode(["some words"]))
    assert [[a.tolist() for a in s] for s in first] == [[a.tolist() for a in s] for s in again]


def test_tasks_leave_their_worker_without_free_memory(monkeypatch):
    """A task begins without the caches of other operators but with its own, and gives free memory back."""
    from fareline.llm import common

    with open(PIECES, "rb") as file:
        model = sentence_pieces.model_of(file.read())
    common.names(["some", "words"])
    released = []
    monkeypatch.setattr(common, "release", lambda: released.append(True))
    found = common.tidy(lambda batches: (b for b in batches), keep=sentence_pieces._models)(iter([1, 2]))
    assert next(found) == 1 and not released
    assert model in sentence_pieces._models.values() and not common._names
    found.close()
    assert released == [True]  # also if the task ends before its rows do


def test_pieces_hold_a_bounded_slice_of_a_batch(monkeypatch):
    """Of a batch of long texts only a slice becomes strings, and few new chunks are encoded at once."""
    from fareline.llm import common

    with open(PIECES, "rb") as file:
        model = sentence_pieces.Model(file.read())
    texts = [" ".join(f"w{k}x{i}" for i in range(20_000)) for k in range(16)]
    sizes, news, whole, encode_chunks = [], [], common.strings, model.encode_chunks
    monkeypatch.setattr(sentence_pieces, "strings", lambda c: sizes.append(c.nbytes) or whole(c))
    monkeypatch.setattr(model, "encode_chunks", lambda c: news.append(len(c)) or encode_chunks(c))
    monkeypatch.setattr(common, "NEW_PIECES", 5_000)
    found = [ids for _, some in sentence_pieces.encoded_batch(model, pa.array(texts)) for ids in some]
    assert max(sizes) < 2_000_000 and max(news) <= 5_000
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == model.library.encode(text, add_bos=True, add_eos=True)


def test_a_cache_looks_known_pieces_up_once():
    """A lookup hashes a known piece once; results stay right over generations, repeats included."""
    from fareline.llm import common

    class Piece(str):
        hashed = 0

        def __hash__(self):
            Piece.hashed += 1
            return str.__hash__(self)

    def many(pieces):
        return common.flattened(pieces, [[len(p), ord(p[0])] for p in pieces])

    cache = common.PieceCache(many, limit=40)
    cache(["a", "bb", "a"])
    ids, lengths = cache([Piece("bb"), Piece("a")])
    assert ids.tolist() == [2, 98, 1, 97] and lengths.tolist() == [2, 2] and Piece.hashed == 2
    rng = np.random.default_rng(1)
    for _ in range(50):
        pieces = [chr(97 + k) * (k % 5 + 1) for k in rng.integers(0, 26, 30).tolist()]
        ids, lengths = cache(pieces)
        assert ids.tolist() == [i for p in pieces for i in (len(p), ord(p[0]))] and set(lengths.tolist()) == {2}
