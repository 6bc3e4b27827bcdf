"""Centroid clustering, license scans and the filter audit against brute force."""

import hashlib
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import centroids, filter_audit, licenses
from tillwise.llm.common import table

LABELS = "doc_id long, quality int, toxic int"


# -------------------------------------------------------------- clustering

def floor256(x):
    """floor(256 x) of a double, exactly, without numpy."""
    top, bottom = float(x).as_integer_ratio()
    return 256 * top // bottom


def lloyd(rows, k, rounds, dim):
    """Plain Python over all distances: (vec_id, cluster, distance), centroids."""
    kept = [(i, [floor256(v) for v in x]) for i, x in rows
            if x is not None and len(x) == dim and all(v is not None and abs(v) < float("inf") for v in x)]
    key = {i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest() for i, _ in kept}
    given = {id(x): [float(v) for v in y] for (_, x), y in zip(kept, [x for _, x in rows if x is not None and len(x) == dim
             and all(v is not None and abs(v) < float("inf") for v in x)])}
    c = [x for _, x in sorted(kept, key=lambda r: (key[r[0]], given[id(r[1])]))[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in enumerate(c))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        c = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else y for j, y in enumerate(c)]
    return [(i, *nearest(x)[::-1]) for i, x in kept], c


def check_clusters(frame, rows, k=5, rounds=4, dim=3):
    got = centroids.cluster_vectors(frame, k, rounds, dim).collect()
    want, c = lloyd(rows, k, rounds, dim)
    fits = lambda d: d if d < 1 << 63 else None
    order = lambda r: str(r)
    assert sorted([(r.vec_id, r.cluster, r.distance) for r in got], key=order) == sorted([(i, j, fits(d)) for i, j, d in want], key=order)
    for r in got:
        assert r.cluster_inertia == fits(sum(d for _, j, d in want if j == r.cluster))
        assert r.inertia == fits(sum(d for _, _, d in want))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, c[r.cluster])).encode()).hexdigest()


VEC = "vec_id long, embedding array<double>, cluster string, x string, distance string"


def vec_frame(spark, rows):
    return spark.createDataFrame([(i, x, "clash", "clash", "clash") for i, x in rows], VEC).repartition(3)


def test_clusters_match_plain_lloyd(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(rng.choice([0, 3]), 1) for _ in range(3)]) for i in range(150)]
    rows += [(i, [0.25 * rng.randrange(3) for _ in range(3)]) for i in range(60)]  # ties, repeated ids and vectors
    rows += [rows[0]] * 40 + [(None, [1.0, 2.0, 3.0])] * 2  # a hot vector, null ids
    rows += [(900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 2.0]), (904, [1.0, float("nan"), 2.0]),
             (905, [float("inf"), 0.0, 0.0]), (906, [-0.0, 1e-300, -1e-300])]
    check_clusters(vec_frame(spark, rows), rows)


@pytest.mark.parametrize("size", [1e7, 1e12, 1e38, 1e307])
def test_clusters_of_huge_components_are_exact(spark, size):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * size, rng.random(), 1 / 256]) for i in range(40)]
    check_clusters(vec_frame(spark, rows), rows, k=4, rounds=3)


def test_clusters_of_few_or_no_vectors(spark):
    few = [(1, [1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0])]
    check_clusters(vec_frame(spark, few), few)
    assert centroids.cluster_vectors(vec_frame(spark, few).limit(0), 5, 2, 3).collect() == []


def test_tournament_is_the_nearest_centroid_and_ties_go_to_the_smaller_number():
    rng = np.random.default_rng(0)
    c = [tuple(map(int, r)) for r in rng.integers(-4, 4, (30, 3))]
    c[7] = c[3]  # equal centroids
    tests = centroids.Bisectors(c)
    x = rng.integers(-5, 5, (500, 3)).astype(float)
    d = ((x[:, None] - np.array(c)[None]) ** 2).sum(2)
    assert (tests.nearest(x) == d.argmin(1)).all()
    exact = centroids._integers(x)
    assert (tests.nearest(exact) == d.argmin(1)).all()
    assert tests.distances(x, d.argmin(1)) == tests.distances(exact, d.argmin(1)) == d.min(1).astype(int).tolist()


@pytest.mark.parametrize("value", [0, 1, -1, 1 << 31, -(1 << 31), (1 << 200) + 12345, -(1 << 200) - 1])
def test_limbs_add_up(value):
    limbs = list(centroids._limbs(value))
    assert sum(v << (32 * p) for p, v in limbs) == value and all(abs(v) < 1 << 32 for _, v in limbs)


# ---------------------------------------------------------------- licenses

def scanned(text, phrases=licenses.PHRASES, templates=licenses.TEMPLATES, percent=licenses.PERCENT):
    """One text by loops over every place, block and template."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(i, label) for p, label in phrases for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    span = 2 * max(len(t.split()) for t, _ in templates)
    best, found = 0.0, set()
    for i in range(0, len(words), span // 2):
        block = set(words[i:i + span])
        for t, label in templates:
            t = set(t.split())
            if 100 * len(t & block) >= percent * len(t):
                found.add(label)
                best = max(best, len(t & block) / len(t))
    base = {label for _, label in at}
    starts = [i for i, _ in at]
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | found)), 1.0 if at else best)


def license_texts():
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(50)] + ["the", "of", "to", "this", "license", "public", "under", "software"]
    notices = [t for t, _ in licenses.TEMPLATES] + [p for p, _ in licenses.PHRASES]
    texts = [None, "", " \n", "K", "Under the KMIT license", "UNDER THE MIT-LICENSE", "the", "cc by nc cc by nc, CC-BY-NC!",
             "under the mit licenseİ", "İ under_the\x7fmit\x00license", "apache license version 20", "apache license version 2.0",
             "mit under the mit mit license", "w " * 20_000 + notices[0]]
    for _ in range(120):
        words = rng.choices(vocab, k=rng.choice([3, 20, 90, 400]))
        for _ in range(rng.randrange(3)):
            notice = rng.choice(notices).split()
            for _ in range(rng.randrange(4)):  # some words lost or changed
                notice[rng.randrange(len(notice))] = rng.choice(vocab)
            spot = rng.randrange(len(words) + 1)
            words[spot:spot] = rng.choice([notice, [w.upper() for w in notice]])
        texts.append(rng.choice([" ", "\n", ", "]).join(words))
    return texts


def license_rows(frame, **options):
    return sorted(((r.doc_id, *r[1:]) for r in licenses.scan(frame, **options).collect()), key=str)


def test_license_scan_matches_loops_over_all_blocks(spark):
    texts = license_texts()
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[20]), (None, texts[21])] + [(7, texts[30])] * 3
    frame = (spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
             .withColumns({c: F.lit("clash") for c in ("words", "met", "at0", "n_words", "labels", "w")}))
    want = sorted(((i, *scanned(t)) for i, t in rows), key=str)
    assert license_rows(frame) == want
    assert {r[6] for r in want} >= {"mit", "gpl", "bsd", ""} and any(0.8 <= r[7] < 1 for r in want)
    assert sum(r[6] != r[5] for r in want) > 20


@pytest.mark.parametrize("percent", [1, 50, 100])
def test_license_scan_at_other_thresholds_and_lists(spark, percent):
    phrases = (("a b a", "aba"), ("a", "one"), ("a b a", "again"))
    templates = (("a b c d e f", "six"), ("a", "one"), ("f e x y z", "five"), ("c d e f x", "other"))
    rng = random.Random(percent)
    rows = [(i, " ".join(rng.choices("abcdefxyzq", k=rng.randrange(30)))) for i in range(60)]
    got = license_rows(spark.createDataFrame(rows, "doc_id long, text string"), phrases=phrases, templates=templates, percent=percent)
    assert got == sorted(((i, *scanned(t, phrases, templates, percent)) for i, t in rows), key=str)


def test_license_scan_of_no_rows_and_of_the_corpus(docs, none, clashing):
    assert license_rows(none) == []
    want = sorted(((r.doc_id, *scanned(r.text)) for r in docs.collect()), key=str)
    assert license_rows(clashing) == want


def test_global_order_is_rarest_first(spark):
    rows = [("the of",), ("the of",), ("the gnu",)]
    words = spark.createDataFrame(rows, "text string").select(licenses.words_of(F.col("text")).alias("words"))
    order = licenses.global_order(words, (("the of gnu zlib", "x"),))
    assert order == ["zlib", "gnu", "of", "the"]
    (t,) = licenses.ranked((("the of gnu zlib", "x"),), order)
    assert t.need == 4 and t.prefix == (0,)


def test_license_scan_runs_no_python_and_no_shuffle_of_documents(spark):
    plan = licenses.scan(table(spark, "/root/testdata/sf0.001", "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# ------------------------------------------------------------ filter audit

def failed(rows):
    out = []
    for i, text, lang in rows:
        text = text or ""
        words = text.encode().split()
        f = "A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words))
        f += "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
        f += "E" * (i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows))
        out.append((lang or "", i, set(f)))
    return out


def audited(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    docs, out = failed(rows), []
    for part in {p for p, _, _ in docs}:
        mine, total, lines = [(i, f) for p, i, f in docs if p == part], {}, []
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                total[f] = total.get(f, 0) + len(gone)
                lines.append([part, "".join(order), k + 1, len(left), len(gone), sum(f in r[1] for r in mine) - len(gone),
                              sum(r[1] == {f} for r in mine), sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone), f])
        out += [(*x[:-1], total[x[-1]]) for x in lines]
    return sorted(out)


def test_filter_audit_matches_simulation_of_every_order(spark, docs):
    rng = random.Random(11)
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    shout = " ".join(f"W{i}" for i in range(150))
    rows += [(i, rng.choice([shout, shout.lower(), shout.lower() + " #", "Same Text", "a|b", None]), rng.choice(["en", "de", None, ""]))
             for i in range(200, 260)]
    rows += [(300, shout, "en")] * 5 + [(300, shout, "de"), (None, shout, "en"), (None, "new", None)] + [(7, f"{i} text", "fr") for i in range(40)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in list(range(0, 310, 2)) + [7, 7, 300, 300]] + [(None, 1, 1)]
    frame = (spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
             .withColumns({c: F.lit("clash") for c in ("id", "part", "fails", "n", "digest", "first", "v", "s", "steps", "quality")}))
    marks = spark.createDataFrame(labels, LABELS).withColumns({c: F.lit("clash") for c in ("good", "fails", "part", "n")})
    got = filter_audit.audit(frame, marks)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == audited(rows, labels)


def test_filter_audit_without_documents_or_labels(spark, none, docs):
    empty = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(none, empty).collect() == []
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert sorted(map(tuple, filter_audit.audit(docs, empty).collect())) == audited(rows, [])


def test_least_squares_give_the_shapley_weights():
    """Against the average over all orders, for random games of 2 to 5 filters."""
    rng = random.Random(3)
    for n in (2, 3, 4, 5):
        v = [0] + [rng.randrange(-50, 50) for _ in range((1 << n) - 1)]
        want = [0] * n
        for order in permutations(range(n)):
            s = 0
            for i in order:
                want[i] += v[s | 1 << i] - v[s]
                s |= 1 << i
        assert [sum(w * x for w, x in zip(row, v)) for row in filter_audit.shapley_weights(n)] == want
