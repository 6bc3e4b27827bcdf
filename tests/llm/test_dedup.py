"""Near-dedup and the two substring operators against brute force."""

import hashlib
import random
from collections import Counter
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tillwise.llm import minhash, repeats, suffix_array, suffix_tree
from tillwise.llm.components import components


def data(docs):
    return [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]


def near(docs, k, percent):
    """doc_id -> smallest id reachable."""
    ids = {d: -1 if d is None else d for d, _ in docs}
    parent = {v: v for v in ids.values()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(ids[d], minhash.shingles(t, k)) for d, t in docs]
    for i, (a, s) in enumerate(sets):
        for b, u in sets[:i]:
            if s and u and 100 * len(s & u) >= percent * len(s | u):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (lambda r: None if r == -1 else r)(find(v)) for d, v in ids.items()}


@pytest.mark.parametrize("rule", [minhash.CONTRACT, minhash.Rule()])
def test_near_duplicates_match_all_pairs(docs, rule):
    want = near(data(docs), rule.words, rule.percent)
    got = minhash.near_duplicates(docs, rule).collect()
    assert len(got) == docs.count()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len(set(want.values())) < len(want)


def test_rows_of_one_id_are_one_document(spark):
    """Ids repeated over different, equal, empty and null texts, against all pairs."""
    rng = random.Random(8)
    a, b, c, d = ("".join(f"{w} " for w in rng.sample(range(10 ** 6), 40)) for _ in range(4))
    cases = [[(3, b), (5, a), (5, b)], [(9, a), (9, b), (2, b), (7, None), (7, a), (4, None)],
             [(1, a), (2, a), (2, b), (3, b), (3, c), (4, c), (None, d), (6, d), (8, ""), (8, d)], [(5, a), (5, a), (5, None)]]
    pool = [a, b, c, d, a + "1 2", None, "", "x"]
    cases.append([(rng.randrange(25), rng.choice(pool) if i % 2 else " ".join(map(str, rng.sample(range(900), 9)))) for i in range(60)])
    for rows in cases:
        frame = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")
        got = minhash.link_documents(frame).collect()
        want = near([(i, (t or "").encode()) for i, t in rows], 3, 85)
        assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == sorted(
            ((i, want[i], i == want[i]) for i, _ in rows), key=str)
    kept = minhash.one_of_each(spark.createDataFrame(cases[0], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.text) for r in kept] == [(3, b)]


def test_the_row_that_stays_is_the_same_in_every_run(spark):
    rows = [(1, "one two three four five six", lang, source, n) for lang, source, n in
            (("de", "s", 5), ("en", "a", 1), (None, "z", 9), ("de", None, 2))]
    for n in (1, 4):
        frame = spark.createDataFrame(rows[::-1] if n > 1 else rows, "doc_id long, text string, lang string, source string, n_chars long")
        (r,) = minhash.one_of_each(frame.repartition(n)).collect()
        assert tuple(r) == rows[2]


def test_cross_pairs_alone_find_every_link(docs, monkeypatch):
    """With no component known, the block step must find all links by itself."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(minhash, "_BLOCK", 2)
    rule = minhash.CONTRACT
    sig = minhash.staged(minhash.signatures(docs, rule), "test-signatures")
    classes = (sig.where("n_shingles > 0").groupBy("set_hash").agg(F.min(F.struct("id", "bands", "sketch")).alias("c"))
               .select("set_hash", "c.*"))
    members = classes.select("id", F.explode("bands").alias("key"))
    nothing = docs.sparkSession.createDataFrame([], "id long, component long")
    links = minhash.cross_links(members, nothing, classes, docs, rule)
    got = {(r.a, r.b) for r in minhash.verified(links, docs, rule).collect()}
    first = {}
    for d, t in data(docs):
        s, d = frozenset(minhash.shingles(t, rule.words)), minhash._NULL_ID if d is None else d
        if s:
            first[s] = min(d, first.get(s, d))
    reps = list(first.items())
    want = {(min(a, b), max(a, b)) for i, (s, a) in enumerate(reps) for u, b in reps[:i]
            if 100 * len(s & u) >= 85 * len(s | u)}
    assert got <= want and got

    def joined(links):
        parent = {x: x for pair in want for x in pair}
        for a, b in links:
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            parent[max(a, b)] = min(a, b)
        roots = {}
        for x in parent:
            r = x
            while parent[r] != r:
                r = parent[r]
            roots[x] = r
        return roots

    assert joined(got) == joined(want)  # nothing that is linked stays apart


def test_intersections_count_shared_elements():
    import numpy as np

    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 30_000, rng.integers(0, 9_000)).astype(np.uint64)) for _ in range(7)]
    got = minhash.intersections(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(7) for j in range(7) if i != j)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 60, 1)] + [(100, i) for i in range(101, 300)] + [(7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 300)}}


def test_miss_rate_is_stated():
    assert minhash.CONTRACT.miss_rate < 1e-5 and minhash.Rule().miss_rate < 1e-5


def test_sketch_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.r_[a[:800], rng.integers(0, 2**63, 200).astype(np.uint64)]
    s = minhash.sketches([np.unique(a), np.unique(b), a[:3], a[:0]], 512)
    assert abs((s[0] == s[1]).mean() - 800 / 1200) < 0.08
    assert (s[2] != np.iinfo(np.uint64).max).all()  # three elements fill all coordinates
    assert (s[3] == np.iinfo(np.uint64).max).all()


def words_removed(docs, window=13):
    least = {}
    for d, t in docs:
        w = t.split()
        for x in zip(*(w[j:] for j in range(window))):
            least[x] = min(least.get(x, 1 << 62), -1 if d is None else d)
    out = []
    for d, t in docs:
        w = t.split()
        gone = [False] * len(w)
        for s, x in enumerate(zip(*(w[j:] for j in range(window)))):
            if least[x] < (-1 if d is None else d):
                gone[s:s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("small", [False, True])
def test_suffix_tree_matches_brute_force(docs, small, monkeypatch):
    if small:  # many chunks and groups
        monkeypatch.setattr(repeats, "CHUNK_BYTES", 3000)
        monkeypatch.setattr(suffix_tree, "BUCKET_BYTES", 5000)
    got = [tuple(r) for r in suffix_tree.dedup_documents(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()]
    want = words_removed(data(docs))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(r[2] for r in want) > 100


def test_prefixes_split_until_they_fit():
    import numpy as np

    rng = np.random.default_rng(0)
    s = rng.integers(0, 50, (4000, 13)).astype(np.uint32)
    s[:2000, 0] = 7  # one first word holds half of all
    split = suffix_tree.split_prefixes(s, 10)
    g = suffix_tree.prefix_group(s, split, 10)
    assert len(split) >= 1 and np.bincount(g, minlength=10).max() < 1200
    assert (suffix_tree.prefix_group(s, [], 10)[:2000] == suffix_tree.prefix_group(s[:1], [], 10)).all()


def bytes_removed(docs, length=200):
    count = Counter(t[s:s + length] for _, t in docs for s in range(len(t) - length + 1))
    out = []
    for d, t in docs:
        gone = [False] * len(t)
        for s in range(len(t) - length + 1):
            if count[t[s:s + length]] > 1:
                gone[s:s + length] = [True] * length
        kept = bytes(x for x, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), sum(1 for g, _ in groupby(gone) if g), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_suffix_array_matches_brute_force(docs, small, monkeypatch):
    if small:
        monkeypatch.setattr(repeats, "CHUNK_BYTES", 3000)
        monkeypatch.setattr(suffix_array, "BUCKET_BYTES", 5000)
        monkeypatch.setattr(suffix_array, "_SLICE", 777)
    got = [tuple(r) for r in suffix_array.dedup_documents(docs)
           .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    want = bytes_removed(data(docs))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(r[2] for r in want) > 1000


@pytest.mark.parametrize("size", [40, 120, 199, 260])
def test_a_line_with_other_text_around_it_is_not_one_bucket(spark, size, monkeypatch):
    """A line in every document: its suffixes all lead alike and all surroundings differ."""
    rng = random.Random(size)

    def noise(n):
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))

    line, rows = noise(size).replace(" ", "_"), []
    for i in range(150):
        before = rows[-1][1][100:300] if i % 10 == 1 else noise(rng.randrange(200, 400))
        rows.append((i, before[:-180] + noise(180) + line + (noise(200) if i % 7 else "same end" * 20)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(suffix_array, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(suffix_array, "HOT_ROWS", 20, raising=False)
    monkeypatch.setattr(suffix_array, "HOT_SHARE", 1.0, raising=False)
    largest, answer_each = [], suffix_array.answer_each

    def seen(questions, kind, *args, **kw):
        if kind == 2:  # bytes asked of the largest bucket, and of all
            by = [r.n for r in questions.groupBy("bucket").agg(F.sum(F.length("message")).alias("n")).collect()]
            largest.append((max(by), sum(by)))
        return answer_each(questions, kind, *args, **kw)

    monkeypatch.setattr(suffix_array, "answer_each", seen)
    got = [tuple(r) for r in suffix_array.dedup_documents(docs)
           .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got, key=key) == sorted(bytes_removed(data(docs)), key=key)
    assert largest[0][0] < 0.25 * largest[0][1]


def test_samples_do_not_vanish_when_chunks_are_short(docs, monkeypatch):
    """One sampled string in many chunks: the splitters and the histogram stay."""
    seen = {}
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 2000)
    for module, answer, wanted in ((suffix_array, suffix_array.dedup_documents, bytes_removed(data(docs))),
                                   (suffix_tree, suffix_tree.dedup_documents, None)):
        monkeypatch.setattr(module, "BUCKET_BYTES", 8000)
        monkeypatch.setattr(module, "SAMPLE", 1)
        answer_each = module.answer_each

        def buckets(questions, kind, *args, answer_each=answer_each, name=module.__name__, **kw):
            if kind == 2:
                seen[name] = questions.select("bucket").distinct().count()
            return answer_each(questions, kind, *args, **kw)

        monkeypatch.setattr(module, "answer_each", buckets)
        split_prefixes = suffix_tree.split_prefixes
        monkeypatch.setattr(suffix_tree, "split_prefixes",
                            lambda sample, groups: seen.update(sample=len(sample)) or split_prefixes(sample, groups))
        got = [tuple(r) for r in answer(docs).collect()]
        monkeypatch.setattr(suffix_tree, "split_prefixes", split_prefixes)
        assert len(got) == docs.count()
        if wanted:
            assert sorted(got, key=key) == sorted(wanted, key=key)
    assert seen[suffix_array.__name__] > 4 and seen["sample"] > 4


@pytest.mark.parametrize("chunk", [10, 1000, 100_000])
def test_a_sample_has_its_share_whatever_the_chunk_length(chunk):
    import numpy as np

    rng = np.random.default_rng(chunk)
    n = sum(len(repeats.sampled_places(chunk, rng.integers(0, 256, 50).astype(np.uint8), 1 / 2500)) for _ in range(1_000_000 // chunk))
    assert 300 < n < 500  # of 400 expected


def test_multikey_order_is_byte_order():
    import numpy as np

    rng = np.random.default_rng(3)
    rows = rng.integers(0, 2, (500, 40)).astype(np.uint8)
    rows[100:200] = rows[0]
    order = suffix_array.multikey_order(rows)
    assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)


def test_empty_tables(none):
    assert minhash.link_documents(none).count() == 0
    assert suffix_tree.dedup_documents(none).count() == 0
    assert suffix_array.dedup_documents(none).count() == 0


def test_clashing_columns(docs, clashing):
    assert minhash.link_documents(clashing).count() == docs.count()
    kept = suffix_tree.marked_rows(clashing)
    assert kept.columns == [*clashing.columns, "n_words", "n_removed"] and kept.where("chunk = 'clash'").count() == docs.count()
    assert suffix_array.remove_repeats(clashing).where("message = 'clash'").count() == docs.count()
    assert minhash.one_of_each(clashing).columns == clashing.columns
