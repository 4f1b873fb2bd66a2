"""Clustering, the filter audit and toxicity against brute force, on small tables with awkward rows."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import audit, centroids, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

# ---- clustering


def brute_clusters(rows, dims=64, k=16, rounds=3, scale=64, seed="1"):
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` by plain loops over Python integers."""
    kept = [
        (i, tuple(math.floor(scale * float(x)) for x in v)) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]

    def place(row):
        return (row[0] is None, hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])

    centres = [list(v) for _, v in sorted(kept, key=place)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for n, vs in groups.items():
            centres[n] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    final = [(i, *nearest(v)) for i, v in kept]
    inertia = collections.Counter()
    for _, d, n in final:
        inertia[n] += d
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), shas[n]) for i, d, n in final), key=repr)


def vectors_of(spark, rows):
    frame = spark.createDataFrame(
        [(i, v, 7, "a") for i, v in rows],
        "vec_id long, embedding array<double>, cluster int, apex string",
    )
    return frame.repartition(3)


def clusters_of(spark, rows, **settings):
    got = centroids.clustered(vectors_of(spark, rows), **settings).drop("compared").collect()
    return sorted((tuple(r) for r in got), key=repr)


@pytest.mark.parametrize("pivots", [1, 3, 8, 16])
def test_clusters_match_plain_loops(spark, pivots):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(9, 64))
    rows = [(k, (middle[k % 9] + 0.3 * rng.normal(size=64)).tolist()) for k in range(150)]
    rows += [(200 + k, rows[0][1]) for k in range(40)]
    rows += [(5, rows[8][1]), (None, rows[9][1]), (None, rows[9][1])]
    rows += [(300, None), (301, [0.5] * 63), (302, [float("nan")] + [0.0] * 63), (303, [None] + [0.0] * 63)]
    rows += [(304, [float("inf")] + [0.0] * 63), (305, [0.0] * 64), (306, [-1e-9] * 64)]
    assert clusters_of(spark, rows, pivots=pivots) == brute_clusters(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.1] * 64)], [(k, [0.1 * (k % 2)] * 64) for k in range(7)]])
def test_few_or_no_vectors(spark, rows):
    assert clusters_of(spark, rows) == brute_clusters(rows)


def test_ties_go_to_the_first_centroid(spark):
    rows = [(k, [float(x)] * 2) for k, x in enumerate([0, 2, 4, 6, 1, 1, 3, 5, 5])]
    settings = {"k": 4, "dims": 2, "rounds": 1, "scale": 1}
    got = clusters_of(spark, rows, clusters=4, dimensions=2, rounds=1, scale=1)
    assert got == brute_clusters(rows, **settings)


def test_bounds_enclose_every_distance_and_rule_centroids_out():
    rng = np.random.default_rng(5)
    middle = rng.integers(-60, 60, (12, 64))
    points = (middle[rng.integers(0, 12, 2000)] + rng.integers(-9, 9, (2000, 64))).astype(np.int64)
    simplex = centroids.Simplex(middle.astype(np.int64), 8)
    x, c = simplex.apexes(points), simplex.apexes(middle)
    exact = centroids.squared_distances(points, middle)
    low = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    high = low + 4 * x[:, None, -1] * c[None, :, -1]
    assert (low <= exact * (1 + 1e-9) + 1e-6).all() and (exact <= high * (1 + 1e-9) + 1e-6).all()
    cluster, distance, compared = centroids.assigned(points, x, middle, c)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert compared.mean() < 6


def test_components_beyond_a_long_are_an_error(spark):
    with pytest.raises(Exception, match="beyond a long"):
        clusters_of(spark, [(1, [1e9] * 64)])


# ---- the filter audit


def brute_audit(docs, labels):
    firsts, fails = {}, []
    for i, text, _ in docs:
        if i is not None:
            firsts[text or ""] = min(i, firsts.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    for i, text, source in docs:
        text = text or ""
        words = WORDS.findall(text)
        failing = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and firsts[text] < i,
        }
        fails.append((source or "", {f for f, x in failing.items() if x}, i in good, i in toxic))
    out = []
    for part in {f[0] for f in fails}:
        own = [f[1:] for f in fails if f[0] == part]
        shapley, rows = collections.Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, start=1):
                gone = [f for f in left if name in f[0]]
                failing = [f for f in own if name in f[0]]
                left = [f for f in left if name not in f[0]]
                shapley[name] += len(gone)
                rows.append((
                    part, "".join(order), step, len(left), len(gone), len(failing) - len(gone),
                    sum(f[0] == {name} for f in own), sum(f[1] for f in gone), sum(f[2] for f in gone),
                ))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in rows]
    return sorted(out)


def audit_of(spark, docs, labels):
    frame = spark.createDataFrame(
        [(*d, "x", 1) for d in docs], "doc_id long, text string, source string, row string, target int"
    ).repartition(3)
    marks = spark.createDataFrame([(*r, "y") for r in labels], "doc_id long, quality int, toxic int, part string")
    return sorted(tuple(r) for r in audit.filter_audit(audit.text_failures(frame), marks).collect())


def awkward_texts():
    rng = np.random.default_rng(11)
    texts = ["", None, " \t", "ONE two", "a|b", "x" * 5000, "Ä \U0001f600 B" * 3, "w " * 300, "W# " * 300]
    for k in range(40):
        size = int(rng.integers(1, 500))
        words = [f"w{x}" for x in rng.integers(0, int(rng.integers(2, 400)), size)]
        if k % 3 == 0:
            words[0] = "ABCDEFGHIJKLMN"
        if k % 4 == 0:
            words.append("$")
        texts.append(" ".join(words))
    return texts


def test_audit_matches_plain_loops(spark):
    texts = awkward_texts()
    docs = [(k, t, [None, "", "a", "b"][k % 4]) for k, t in enumerate(texts)]
    docs += [(100 + k, texts[k % 12], "a") for k in range(40)]
    docs += [(3, texts[20], "b"), (3, texts[21], "b"), (None, texts[22], "a"), (None, None, None), (None, texts[22], "a")]
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 120)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (7, None, None), (999, 1, 1)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    assert audit_of(spark, docs, labels) == brute_audit(docs, labels)


def test_audit_of_hot_groups(spark, monkeypatch):
    """Groups over the share that is broadcast, and others beside them."""
    monkeypatch.setattr(audit, "HOT_GROUPS", 8)
    docs = [(k, ["same", "other", f"own {k}", "rare"][min(k % 5, 3)] if k % 9 else f"t{k // 18}", "s") for k in range(120)]
    assert audit_of(spark, docs, []) == brute_audit(docs, [])


def test_audit_without_rows_or_labels(spark):
    assert audit_of(spark, [], []) == []
    assert audit_of(spark, [], [(1, 1, 1)]) == []
    assert len(audit_of(spark, [(None, None, None)], [])) == 600


def test_audit_of_other_filters(spark):
    facts = spark.createDataFrame(
        [(k, k, "p", k % 2 == 0, None if k % 5 == 0 else k % 3 == 0) for k in range(30)],
        "row long, doc_id long, part string, even boolean, third boolean",
    )
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {(r["filter_order"], r["step"]): r for r in audit.filter_audit(facts, none, ("even", "third")).collect()}
    assert got["eventhird", 1]["removed"] == 15 and got["eventhird", 2]["removed"] == 4
    assert got["thirdeven", 1]["removed"] == 8 and got["thirdeven", 2]["redundant"] == 4
    assert got["thirdeven", 2]["kept"] == 30 - 15 - 4
    with pytest.raises(ValueError, match="filters"):
        audit.filter_audit(facts, none, tuple("abcdefg"))


# ---- toxicity

INSULTS = ("grumbo", "flinterei", "vexadoso")


def planted(seed=0, n=600):
    """Texts of invented words; a third of the toxic ones hold an insult with another ending."""
    rng = np.random.default_rng(seed)
    docs, labels = [], []
    for k in range(n):
        sentences = [
            " ".join("".join(rng.choice(list("aeioulmnrst"), int(rng.integers(2, 9)))) for _ in range(int(rng.integers(3, 15))))
            for _ in range(int(rng.integers(1, 30)))
        ]
        bad = k % 8 == 0
        if bad:
            word = INSULTS[k // 8 % 3] + ("" if k // 24 % 3 else "".join(rng.choice(list("aeiou"), 2)))
            at = int(rng.integers(0, len(sentences)))
            sentences[at] += " " + (word.upper() if k % 16 else word + "$$$")
        docs.append((k, ". ".join(sentences) + ".", bad))
        labels.append((k, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = planted()
    docs += [(1000, None, False), (1001, "", False), (1002, "你好 \U0001f600 !!!", False), (None, "grumbo here", True)]
    docs += [(1003, "A quiet line. " * 20_000, False), (1004, "a tale. " * 9_000 + "you GRUMBO! " + "its end. " * 9_000, True)]
    docs += [(0, docs[0][1], True), (1005, "x" * 200_000, False)]
    frame = spark.createDataFrame([(i, t, "l", "s", 1) for i, t, _ in docs], "doc_id long, text string, label string, score string, size int")
    marks = spark.createDataFrame(
        [*labels, (None, 1), (5, None), (8, 1), (7000, 1)], "doc_id long, toxic int"
    )
    rows = toxicity.toxicity(frame.repartition(4), marks).collect()
    return docs, rows


def test_held_out_documents_are_told_apart(judged):
    docs, rows = judged
    assert len(rows) == len(docs)
    by_id = {i: bad for i, _, bad in docs}
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 1000]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in held) and len(held) > 150
    wrong = [r["doc_id"] for r in held if r["predicted"] != by_id[r["doc_id"]]]
    assert len(wrong) <= 1, wrong
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_odd_texts_and_the_sentence_that_offends(judged):
    docs, rows = judged
    texts = {i: t for i, t, _ in docs}
    rows = {r["doc_id"]: r for r in rows}
    for k in (1000, 1001, 1002, 1003, 1005):
        assert rows[k]["predicted"] == 0 and rows[k]["offending"] == []
    assert rows[None]["held_out"] is False and rows[None]["score"] > 0.3, rows[None]
    assert rows[1004]["predicted"] == 1
    (span,) = rows[1004]["offending"]
    assert "GRUMBO" in texts[1004][span["start"] : span["start"] + span["length"]] and span["length"] < 30


def test_scores_are_the_noisy_or_of_plain_sentence_scores(spark):
    """The same model applied by string slices and dictionaries."""
    docs, labels = planted(1, 200)
    frame = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id long, text string")
    model = toxicity.fit_toxicity(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    weights = dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True))

    def bucket(gram):
        h = 0
        for c in gram:
            h = (h * int(toxicity._BASE) + (0 if c == "\0" else ord(c))) % 2**64
        h = (h ^ len(gram)) * int(toxicity._SPREAD) % 2**64
        h = (h ^ (h >> 29)) * int(toxicity._BASE) % 2**64
        return h >> (64 - toxicity.BUCKET_BITS)

    def plain(text):
        text = text.lower() + "\n"
        symbols = [c if c.isalnum() else "\0" for c in text]
        found, number, start = collections.defaultdict(set), 0, 0
        for at, c in enumerate(text):
            if at and (c in toxicity._ENDS or at - start == toxicity.SENTENCE_CHARS):
                number, start = number + 1, at
            for order in toxicity.ORDERS:
                gram = symbols[at : at + order]
                if len(gram) == order and "\0" not in gram[1:-1]:
                    found[number].add(bucket(gram))
        clean = math.exp(-model.leak)
        for k in range(number + 1):
            weight = sum(weights.get(b, 0) for b in found[k])
            if weight > 0:
                clean *= (1 + math.exp(toxicity.BIAS)) / (1 + math.exp(toxicity.BIAS + weight))
        return 1 - clean

    texts = [t for _, t, _ in docs[:40]] + ["", "ab", "x" * 900]
    pieces, rates = toxicity.sentence_scores(texts, model, toxicity._places(model.buckets))
    got = toxicity.document_scores(pieces, rates, model)
    assert len(model.buckets) > 10
    assert np.allclose(got, [plain(t) for t in texts], atol=1e-9)


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1)], [(1, None), (None, 1)]])
def test_toxicity_without_two_classes(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, None)], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, marks).collect()
    assert len(rows) == 3 and len({round(r["score"], 9) for r in rows}) == 1
    assert toxicity.toxicity(docs.limit(0), marks).count() == 0
    assert toxicity.toxicity(docs.filter(F.lit(False)), marks.filter(F.lit(False))).count() == 0
