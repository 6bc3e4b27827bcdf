"""Fingerprints, classifiers, chats, search, mixing, packing and the pipeline."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import ann, chat, edit_fingerprint, mixing, packing, quality, toxicity

VOCAB_FILE = packing.VOCABULARY


def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


# ------------------------------------------------------------- fingerprints

def in_order(spark, docs):
    """Documents by falling id, null last; those of one id by the hash of their text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64(F.col("text").cast("binary")))
    return [(d, t) for d, _, t in sorted(((-(1 << 63) if r.doc_id is None else r.doc_id, r.h, r.text) for r in rows.collect()),
                                         key=lambda x: (-x[0], x[1], x[2].encode()))]


def test_fingerprints_pair_every_document_with_the_next(spark, docs, clashing, none, monkeypatch):
    monkeypatch.setattr(edit_fingerprint, "_ROWS", 7)  # many ranges and groups
    got = edit_fingerprint.fingerprint_documents(docs).collect()
    order = in_order(spark, docs)
    want = []
    for (d, t), (_, following) in zip(order, order[1:] + order[:1]):
        new = edit_fingerprint.edited(t, following)
        want.append((d, len(t), hashlib.sha256(new.encode()).hexdigest()))
    have = [(-(1 << 63) if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256) for r in got]
    assert sorted(have) == sorted(want)
    by_text = {}
    for r in got:
        assert by_text.setdefault((r.doc_id), r.fingerprint) == r.fingerprint
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert sorted(edit_fingerprint.fingerprint_documents(clashing).collect(), key=str) == sorted(got, key=str)
    empty = edit_fingerprint.fingerprint_documents(none)
    assert empty.count() == 0 and empty.columns[:7] == edit_fingerprint.fingerprint_documents(docs).columns[:7]
    long = [r for r in got if r.n_chars > 300]
    assert np.mean([r.near_edited for r in long]) > 0.3 > np.mean([r.near_next for r in long])


def test_an_id_on_most_rows_is_cut_into_ranges(spark, monkeypatch):
    monkeypatch.setattr(edit_fingerprint, "_ROWS", 20)
    rows = [(i, f"text {i}") for i in range(150)] + [(70, f"of one id {i}") for i in range(300)] + [(None, f"null {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    dealt = edit_fingerprint.with_next(docs).withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in dealt.groupBy("task").count().collect()]
    assert dealt.groupBy("range").agg(F.count_distinct("task").alias("n")).where("n > 1").count() == 0
    assert max(sizes) < 60 and dealt.where("halo = 1").count() == dealt.select("range").distinct().count() == len(sizes)
    order = in_order(spark, docs)
    want = [(t, hashlib.sha256(edit_fingerprint.edited(t, f).encode()).hexdigest()) for (_, t), (_, f) in zip(order, order[1:] + order[:1])]
    got = edit_fingerprint.fingerprint_documents(docs).collect()
    assert sorted((r.n_chars, r.edited_sha256) for r in got) == sorted((len(t), h) for t, h in want)


def test_fingerprints_are_those_of_a_walk_read_character_by_character():
    rng, walk = random.Random(8), edit_fingerprint.Walk(slots=16)
    texts = ["", "a", "ab", "héllo wörld", "".join(rng.choices("abc déf", k=500)), "".join(rng.choices("xyz", k=37))]
    have = edit_fingerprint.fingerprints(texts, walk)

    def slot(text: str, k: int, steps: int) -> int:
        """What slot k samples of a walk that counts as ``steps`` long."""
        read, w, place = edit_fingerprint.classes(text).tolist(), k % walk.walks, 0
        for step in range(walk.sampled(k, steps)):
            place += int(walk.row(step)[256 * w + read[place]])
        value = read[place]
        for ahead in range(1, 4):
            value = (value * 0x9E3779B1 + (read[min(place + ahead, len(read) - 1)] if read[place] else 0)) & 0xFFFFFFFF
        value = (value ^ value >> 15) * 0x85EBCA6B & 0xFFFFFFFF
        return value >> 24

    def length(text: str, w: int) -> int:
        read, place, step = edit_fingerprint.classes(text).tolist(), 0, 0
        while read[place]:
            place += int(walk.row(step)[256 * w + read[place]])
            step += 1
        return step

    checks = [1]  # the steps after which walks are asked whether they are over
    while checks[-1] < 5000:
        checks.append(max(checks[-1] + 1, checks[-1] + checks[-1] // 32))
    for t, print_ in zip(texts, have):
        ends = [next(c for c in checks if c >= length(t, w)) for w in range(walk.walks)]
        assert print_.tolist() == [slot(t, k, ends[k % walk.walks]) for k in range(16)]


def test_equal_texts_equal_fingerprints_and_small_edits_stay_near():
    rng = random.Random(0)
    walk = edit_fingerprint.Walk()
    t = "".join(rng.choices("abcdefgh ", k=4000))
    one = t[:2000] + "X" + t[2001:]
    other = "".join(rng.choices("abcdefgh ", k=4000))
    alone = edit_fingerprint.fingerprints([t], edit_fingerprint.Walk())[0]
    p = edit_fingerprint.fingerprints([t, t, one, other, ""], walk)
    assert (p[0] == p[1]).all() and (p[0] == alone).all()  # whatever else is in the batch
    assert (p[0] == p[2]).mean() > 0.9
    assert (p[0] == p[3]).mean() < 0.1
    cut = edit_fingerprint.fingerprints([t[:100 * i] + t[100 * i + 5:] for i in range(1, 30)], walk)
    assert np.mean(cut == p[0]) > 0.75  # five characters gone, anywhere


def test_near_documents_finds_copies_and_small_edits(spark):
    rng = random.Random(1)
    rows = []
    for i in range(30):
        t = "".join(rng.choices("abcdefghij ", k=800))
        rows += [(3 * i, t), (3 * i + 1, t), (3 * i + 2, t[:400] + "Z" + t[401:])]
    walk = edit_fingerprint.Walk()
    p = edit_fingerprint.fingerprints([t for _, t in rows], walk)
    frame = spark.createDataFrame([(d, x.tobytes().hex()) for (d, _), x in zip(rows, p)], "doc_id long, fingerprint string")
    got = {(r.doc_id_a, r.doc_id_b): r.likeness for r in edit_fingerprint.near_documents(frame).collect()}
    assert set(got) == {(3 * i, 3 * i + 2) for i in range(30) if 0.8 <= (p[3 * i] == p[3 * i + 2]).mean() < 1}
    assert len(got) >= 15


@pytest.mark.parametrize("block", [1024, 16])
def test_near_documents_keeps_every_pair_of_a_group(spark, block, monkeypatch):
    """Groups of 10 and 100 independent edits of one text, against all pairs."""
    monkeypatch.setattr(edit_fingerprint, "_BLOCK", block)
    rng, texts = random.Random(2), []
    for size in (10, 10, 100):
        t = "".join(rng.choices("abcdefghij ", k=600))
        for _ in range(size):
            at = rng.randrange(580)
            texts.append(t[:at] + "Z" + t[at + 1:])
        texts += texts[-2:]  # copies
    p = edit_fingerprint.fingerprints(texts, edit_fingerprint.Walk())
    ids = [None, *range(1, len(texts))]
    frame = spark.createDataFrame([(d, x.tobytes().hex()) for d, x in zip(ids, p)], "doc_id long, fingerprint string")
    like = (p[:, None] == p[None]).mean(axis=2)
    near = like >= 0.8
    first = [int(np.flatnonzero(r == 1)[0]) for r in like]
    want = {(ids[i], ids[j]): like[i, j] for i in set(first) for j in set(first) if i < j and near[i, j]}
    got = edit_fingerprint.near_documents(frame).collect()
    assert {(r.doc_id_a, r.doc_id_b): r.likeness for r in got} == want and len(got) == len(want) > 1500
    label = list(range(len(p)))
    for _ in label:  # smallest label of the near ones, until nothing changes
        label = [min(label[j] for j in np.flatnonzero(r)) for r in near]
    classes = edit_fingerprint.near_classes(frame).collect()
    assert (sorted(((r.doc_id or 0), (r.class_id or 0), r.n_links) for r in classes)
            == [(i, label[i], int(near[i].sum()) - 1) for i in range(len(p))])
    assert edit_fingerprint.near_classes(frame.limit(0)).count() == 0


# ------------------------------------------------------------- classifiers

def test_isotonic_is_the_least_squares_fit():
    y = np.array([1.0, 3.0, 2.0, 2.0, 5.0, 4.0])
    w = np.ones(6)
    assert quality.pool_adjacent_violators(y, w).tolist() == [1, 7 / 3, 7 / 3, 7 / 3, 4.5, 4.5]


def labelled_corpus(spark, n=600):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        good, toxic = rng.random() < 0.7, rng.random() < 0.3
        w = [f"{rng.choice('bcdfgl')}{rng.choice('aeiou')}{rng.choice('nrst')}{rng.choice(['', 'ing', 'ed'])}" for _ in range(rng.randint(20, 120))]
        if toxic:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(["grumblesnark", "grumblesnarks", "fizzlewort"]))
        t = " ".join(w) if good else " ".join(x + "!!" for x in w).upper()
        rows.append((i, t, "en", "s", len(t)))
        labels.append((i, int(good), int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows, labels)


def test_classifiers_on_held_out_rows_and_misspellings(spark):
    docs, labels, rows, truth = labelled_corpus(spark)
    q = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    t = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    out = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(q[i].held_out == (i in set(out)) == t[i].held_out for i, *_ in rows)
    assert np.mean([q[i].predicted == truth[i][1] for i in out]) > 0.97
    assert np.mean([t[i].predicted == truth[i][2] for i in out]) > 0.95
    # labels of held-out rows are not used
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.score_documents(docs, flipped).collect()}
    assert all(abs(again[i] - q[i].score) < 1e-9 for i in again)
    # a misspelling that never occurred
    more = docs.unionByName(spark.createDataFrame([(10_005, rows[1][1] + " grumblesnarky", "en", "s", 1),
                                                   (10_006, "", "en", "s", 0), (10_007, None, None, None, None)], docs.schema))
    scored = {r.doc_id: r for r in toxicity.score_documents(more, labels).collect()}
    assert scored[10_005].score > 0.5
    assert 0 <= scored[10_006].score == scored[10_007].score <= 1
    kept = quality.kept_documents(docs.withColumn("score", F.lit("x")), labels)
    assert kept.columns == [*docs.columns, "score"]
    assert {r.doc_id for r in kept.collect()} == {i for i, r in q.items() if r.predicted}


def test_statistics_of_training_texts_only(spark):
    docs, labels, rows, _ = labelled_corpus(spark)
    fit_rows = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5}
    every = quality.training_documents(docs, labels, "quality", 10 ** 6, "seed")
    assert {r.doc_id for r in every.collect()} == fit_rows
    few = labels.where("doc_id % 7 = 0").unionByName(spark.createDataFrame([(None, 1, 1), (3, None, 1)], labels.schema))
    more = docs.unionByName(spark.createDataFrame([(None, None, None, None, None), (None, "x", None, None, None)], docs.schema))
    got = [(r.doc_id, r.text) for r in quality.training_documents(more, few, "quality", 10 ** 6, "seed").collect()]
    assert sorted(got, key=str) == sorted([(i, t) for i, t, *_ in rows if i in fit_rows and i % 7 == 0]
                                          + ([(None, None), (None, "x")] if zlib.crc32(b"") % 5 else []), key=str)
    hot = min(fit_rows)
    many = docs.unionByName(spark.createDataFrame([(hot, f"text {i} of one id", "en", "s", 1) for i in range(2000)], docs.schema))
    share = quality.training_documents(many, labels, "quality", 200, "seed")
    assert 130 <= share.count() <= 280 and 0.5 < share.where(f"doc_id = {hot}").count() / share.count() <= 1
    assert quality.training_documents(docs.limit(0), labels, "quality", 10, "seed").count() == 0
    kept = quality.kept_documents(docs, labels, max_rows=150)
    right = {i for i, good, _ in labels.collect() if good}
    assert len({r.doc_id for r in kept.collect()} ^ right) < 0.06 * len(rows)


def test_classifiers_without_labels_and_without_rows(spark, docs, none, clashing):
    labels = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    q = quality.score_documents(clashing, labels).collect()
    assert len(q) == docs.count() and {(r.score, r.predicted) for r in q} == {(0.5, 1)}
    t = toxicity.score_documents(clashing, labels).collect()
    assert len(t) == docs.count() and {(r.score, r.predicted) for r in t} == {(0.0, 0)}
    assert quality.score_documents(none, labels).count() == 0
    assert toxicity.score_documents(none, labels).count() == 0


def test_one_id_on_a_third_of_the_rows_stays_within_the_training_bounds(spark, monkeypatch):
    """Documents and labels both repeat one id; copies of its text and other texts."""
    docs, labels, rows, _ = labelled_corpus(spark)
    hot = next(i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5)
    many = docs.unionByName(spark.createDataFrame(
        [(hot, f"{'same' if i % 3 else i} text of one id", "en", "s", 1) for i in range(300)], docs.schema))
    known = labels.unionByName(spark.createDataFrame([(hot, 1, 1)] * 300, labels.schema))
    whole, share = toxicity.training_rows(many, known, "toxic", 1000, 1000)
    got = [(bytes(r.text), r.y) for r in whole.collect()]
    assert sum(t.endswith(b"text of one id") and y == 1 for t, y in got) == 101 and share == {0: 1.0, 1: 1.0}
    part, share = toxicity.training_rows(many, known, "toxic", 60, 60)
    assert 30 <= part.where("y = 1").count() <= 90 and share[1] < 0.5
    monkeypatch.setattr(toxicity, "MAX_BYTES", 4000)
    assert sum(len(r.text) for r in toxicity.training_rows(many, known, "toxic", 1000, 1000)[0].collect()) < 16_000
    monkeypatch.setattr(toxicity, "MAX_TEXT", 30)
    assert all(len(r.text) <= 30 for r in toxicity.training_rows(many, known, "toxic", 1000, 1000)[0].collect())
    stats = quality.with_statistics(many)
    assert 30 <= quality.labelled(stats, known, "quality", 100, "seed").count() <= 200
    assert {r["count"] for r in quality.labelled(stats, known, "quality", 10 ** 6, "seed").groupBy("stats").count().collect()} == {1}
    assert toxicity.score_documents(many, known, max_toxic=60, max_clean=60).count() == many.count()


def test_ridge_is_the_direct_least_squares_solution(spark):
    docs, labels, *_ = labelled_corpus(spark, 300)
    train = quality.staged(quality.labelled(quality.with_statistics(docs), labels, "quality", 10 ** 6, "seed"), "train")
    model = quality.fit(train, dimensions=24)
    rows = train.where("fold != 0").collect()
    x, y = quality.matrix([bytes(r.stats) for r in rows]), np.array([r.y for r in rows], float)
    z = np.hstack([np.sqrt(2 / 24) * np.cos(np.clip((x - model.mean) / model.scale, -6, 6) @ model.w + model.b), np.ones((len(x), 1))])
    weight = (quality.RIDGE * len(x) + 1e-9) / 24  # of the squared length of the solution
    direct = np.linalg.lstsq(np.vstack([z, np.sqrt(weight) * np.eye(25)]), np.append(y, np.zeros(25)), rcond=None)[0]
    assert np.allclose(model.weights, direct, atol=1e-6)


def test_passage_scores_are_averages_of_their_ngrams():
    """Against a plain loop over passages, words and n-grams."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    model = toxicity.Subwords(rng.normal(size=(toxicity.BUCKETS, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    table = model.weights()
    texts = [b"One two\tthree four five six seven eight", b"ab  c", b"", b" lone ", "caf\u00e9 z z z z z z z".encode()]

    def bucket(g: bytes) -> int:
        return int(list(toxicity.grams(np.frombuffer(g, np.uint8)))[len(g) - 3][0][0])

    def highest(text: bytes) -> float:
        bias = float(model.bias[1] - model.bias[0])
        words = text.lower().split()
        runs = [words[i:i + 6] for i in range(max(1, len(words) - 5))] if words else []
        scores = []
        for run in runs:
            got = [table[bucket(w[i:i + n])] for w in (b" " + w + b" " for w in run)
                   for n in toxicity.SIZES for i in range(len(w) - n + 1)]
            scores.append(sum(map(float, got)) / max(1, len(got)) + bias)
        return max(scores, default=bias)

    have = model.highest(pa.array(texts, pa.binary()), table)[0]
    assert np.allclose(have, [highest(t) for t in texts], atol=1e-4)


# ------------------------------------------------------------- chats

def test_snapshots_collapse_to_the_longest(spark):
    rows = []
    for n in (1, 2, 3):  # snapshots 0, 1, 2 of one conversation
        rows += [(n - 1, t, "user" if t % 2 == 0 else "bot", f"m{t}") for t in range(n)]
    rows += [(7, 0, "user", "m0"), (7, 1, "bot", "other")]  # shares a first turn only
    rows += [(8, t, "user" if t % 2 == 0 else "bot", f"m{t}") for t in range(3)]  # a copy of 2
    rows += [(9, 0, None, None), (None, 0, "user", "x"), (10, 0, "", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.n_turns, r.n_copies, r.chat) for r in chat.rendered(turns).collect()}
    assert got == {
        2: (3, 2, "<|user|>\nm0\n<|bot|>\nm1\n<|user|>\nm2\n"),
        7: (2, 1, "<|user|>\nm0\n<|bot|>\nother\n"),
        9: (1, 1, "<|unknown|>\n\n"), 10: (1, 1, "<||>\n\n"), None: (1, 1, "<|user|>\nx\n")}
    assert chat.rendered(turns.where("false")).count() == 0
    clash = turns.withColumn("n", F.lit("c")).withColumn("h1", F.lit("c")).withColumn("kept_id", F.lit("c")).withColumn("n_turns", F.lit("c"))
    assert chat.rendered(clash).count() == 5


# ------------------------------------------------------------- search

def test_search_recall_scores_and_edge_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 1500)
    monkeypatch.setattr(ann, "QUERIES", 40)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(4000, None), (4001, [0.0] * 32), (4002, [float("nan")] * 32), (4020, [None] + [1.0] * 31), (4004, [1.0] * 3)]
    rows += [(5000 + i, x[40].tolist()) for i in range(500)]  # ties
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("block", F.lit("clash"))
    got = {}
    for r in ann.neighbours(frame).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ids = np.array([i for i, v in rows if i < 4000 or i >= 5000])
    vec = np.stack([v for i, v in rows if i < 4000 or i >= 5000])
    hits = total = 0
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    for q, found in got.items():
        s = vec @ vec[ids == q][0]
        s[ids == q] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        hits, total = hits + len(best & {f[1] for f in found}), total + 20
    assert hits / total >= 0.9
    assert {f[1] for f in got[40]} == set(range(5000, 5020))


def test_search_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    got = ann.neighbours(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 1.0])], schema)).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(0, 1, 2, 1.0), (0, 2, 1, 0.5)]
    assert ann.neighbours(spark.createDataFrame([], schema)).count() == 0
    assert ann.neighbours(spark.createDataFrame([(0, None)], schema)).count() == 0


# ------------------------------------------------------------- mixing

def clamped(sizes, budget=1.5, epochs=2.0):
    """Targets by repeated clamping, the slow way."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, target, free = budget * sum(sizes.values()), {}, set(names)
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > epochs * sizes[s]}
        if not over:
            target.update({s: level * weight[s] for s in free})
            break
        target.update({s: epochs * sizes[s] for s in over})
        free -= over
    return target


def test_targets_match_repeated_clamping(spark):
    rng = random.Random(2)
    for n in (1, 2, 5, 17):
        sizes = {f"s{i}" if i else None: rng.choice([0, 5, 5, 40, 300]) for i in range(n)}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(frame).collect()}
        assert got == pytest.approx(clamped(sizes))


def test_mix_meets_targets_and_repeats_agree(docs, clashing, none):
    rows = mixing.mix_documents(docs).collect()
    assert len(rows) == docs.count()
    assert sorted(rows, key=str) == sorted(mixing.mix_documents(docs.repartition(7)).collect(), key=str)
    size = {}
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size)
        t = size.setdefault((r.source_size, r.target), [0, 0])
        t[0] += r.taken
        t[1] = max(t[1], r.size)
    for (_, target), (taken, largest) in size.items():
        assert abs(taken - target) <= largest
    out = mixing.mixed_rows(clashing)
    assert out.columns == clashing.columns
    assert out.count() == sum(r.taken // r.size for r in rows if r.size) + sum(
        1 for r in out.where("trim(translate(coalesce(text, ''), '\n', '')) = ''").collect())
    assert mixing.mix_documents(none).count() == 0 and mixing.mixed_rows(none).count() == 0


# ------------------------------------------------------------- packing

def test_words_encode_like_whole_texts(docs):
    import public_tokenizers

    cache = packing.WordCache(public_tokenizers.path(VOCAB_FILE), limit=50)
    odd = ["", " ", "  ", "a  b", " a", "a ", "a \nb", "a   b", "\n a\n\n b \t c", "don't  'll it's <|endoftext|> z", "x <|endoftext|> y", "a<|endoftext|>", "<|endoftext|> <|endoftext|>b <| endoftext |>",
           "  a  b", "1 2  33 !!  ?? a\x1cb \x1cq", "日本 語 テ", "é \U0001f600 a", "x  y  z   w"]
    sample = odd + [t for _, t in texts(docs)] + odd
    got = [np.frombuffer(b, "<u4").tolist() for b in cache.encode(sample)]
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(VOCAB_FILE))  # with no setting changed
    assert got == [e.ids for e in plain.encode_batch(sample, add_special_tokens=False)]
    assert got[sample.index("x <|endoftext|> y")] == [87, 220, 50256, 331]


def test_latin_words_get_the_ids_of_the_plain_tokenizer():
    """Words through the ranks, mixed with others, odd white space, joined tokens and long runs."""
    import json
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(VOCAB_FILE)
    plain, cache, rng = Tokenizer.from_file(path), packing.WordCache(path, limit=2000), random.Random(3)
    visible = [t.replace("\u0120", "") for t in plain.get_vocab()]
    letters = [chr(c) for c in range(0x280)] + [chr(c) for c in range(128)] * 4
    made = ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(3000)]
    made += [" ".join("".join(rng.choices(visible, k=rng.randint(1, 5))) for _ in range(5)) for _ in range(3000)]
    made += [" ".join("".join(rng.choices("abcdest'AB19.,-\n\t\u00e9\u00a0", k=rng.randint(1, 90))) for _ in range(4)) for _ in range(3000)]
    assert cache.latin is not None
    want = [e.ids for e in plain.encode_batch_fast(made, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in cache.encode(made)] == want
    cache.latin, cache.known = None, {}
    assert [np.frombuffer(b, "<u4").tolist() for b in cache.encode(made)] == want
    # a vocabulary that ranks cannot stand for goes through its tokenizer alone
    spec = json.loads(plain.to_str())
    merges = spec["model"]["merges"]
    assert packing.latin_encoding(spec | {"model": spec["model"] | {"merges": merges[::-1]}}) is None
    assert packing.latin_encoding(spec | {"pre_tokenizer": None}) is None


def test_packing_is_whole_gapless_and_tight(docs, clashing, none, monkeypatch):
    import public_tokenizers

    cache = packing.WordCache(public_tokenizers.path(VOCAB_FILE))
    rows = packing.pack_documents(clashing, group_pieces=20).collect()
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))] and sum(n for _, n in s) <= 1024
    want = []
    for d, t in texts(docs):
        ids = next(cache.encode([t])) + np.array([2], "<u4").tobytes()
        for k, (at, n) in enumerate(packing.cut(len(ids) // 4, 1024)):
            want.append((d, k, at, n, zlib.crc32(ids[4 * at:4 * (at + n)])))
    assert sorted((tuple(r[:5]) for r in rows), key=str) == sorted(want, key=str)
    assert packing.pack_documents(none).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_holds_every_capacity(rule):
    rng = np.random.default_rng(5)
    n = rng.integers(1, 1025, 3000)
    for docs, cost in ((None, None), (3, None), (None, 600_000 + 1024 ** 2), (4, 1024 ** 2)):
        b, off = packing.best_fit(n, 1024, docs, cost, rule=rule)
        tokens, count, square = (np.bincount(b, w) for w in (n, np.ones(len(n)), n.astype(float) ** 2))
        assert tokens.max() <= 1024 and (docs is None or count.max() <= docs) and (cost is None or square.max() <= cost)
        order = np.lexsort((off, b))
        end = np.r_[0, np.cumsum(n[order])[:-1]]
        assert (off[order] == end - end[np.searchsorted(b[order], b[order])]).all()
        if docs is None and cost is None:
            assert len(tokens) <= 1.03 * n.sum() / 1024 + 1
    with pytest.raises(ValueError):
        packing.best_fit(np.array([2000]), 1024)


def test_documents_are_packed_by_the_vector_rule(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, "a " * rng.choice([1, 3, 20, 90, 200, 400, 700]) + "b " * rng.randrange(60))
                                  for i in range(500)], "doc_id long, text string")

    def sequences(ids, lengths):
        out = {}
        for s, n in zip(ids, lengths):
            out.setdefault(s, []).append(n)
        return sorted(sorted(v) for v in out.values())

    rows = {rule: packing.pack_documents(docs, **kw).collect()
            for rule, kw in (("norm", {}), ("dot", {"rule": "dot"}), ("few", {"max_docs": 3, "max_cost": 2.0 * 1024 ** 2}))}
    lengths = np.array([r.length for r in rows["norm"]])

    def best(*caps, **kw):
        return sequences(packing.best_fit(lengths, *caps, **kw)[0].tolist(), lengths.tolist())

    got = {k: sequences([r.sequence_id for r in v], [r.length for r in v]) for k, v in rows.items()}
    assert got["norm"] == best(1024, 1024, 1024 ** 2) != best(1024)
    assert got["dot"] == best(1024, 1024, 1024 ** 2, rule="dot")
    assert got["few"] == best(1024, 3, 2.0 * 1024 ** 2) and max(map(len, got["few"])) == 3


def test_query_rows_that_share_an_id_are_searched_by_the_smallest_vector(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(1, 40) if i != 20]
    twins = [(20, rng.normal(size=8).tolist()) for _ in range(4)]
    y = np.array(min((np.array(v) for _, v in twins), key=lambda v: v.tobytes()))
    want = sorted(((float((np.array(v) * y).sum()), i) for i, v in rows), key=lambda t: (-t[0], t[1]))[:5]
    for order in (twins, twins[::-1]):
        frame = spark.createDataFrame([(i, v, "clash") for i, v in order + rows], "vec_id long, embedding array<double>, vector string")
        got = ann.neighbours(frame.repartition(3), 5).where("query_id = 20").orderBy("rank").collect()
        assert [(r.score, r.vec_id) for r in got] == want
