"""The training-data operators against brute force, on small tables with awkward rows."""

import collections
import dataclasses
import hashlib
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm import exact, jaccard, language, mixing, packing, passages, quality, repeats, search
from gleaner.llm.components import components
from gleaner.llm.html import block_labels, extracted, main_text, page_blocks
from gleaner.llm.suffixes import Shard

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use themselves.
        T.StructField("score", T.StringType()),
        T.StructField("copy", T.StringType()),
        T.StructField("size", T.StringType()),
    ]
)


def docs_of(spark, rows):
    """Rows of ``(doc_id, text)`` or ``(doc_id, text, lang, source)``."""
    full = [(*r, *[None] * (4 - len(r)), len(r[1] or ""), "x", "y", "z") for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def prose(seed, n, vocabulary=400):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{k}" for k in rng.integers(0, vocabulary, n))


@pytest.fixture(scope="module")
def awkward():
    """Copies, near copies, shared passages, nulls, empty, short and long texts, odd white space."""
    base, passage = prose(1, 300), prose(2, 70)
    words = base.split()
    near = " ".join([*words[:150], "changed", *words[151:]])
    rows = [
        (1, base), (2, near), (3, base), (4, base.replace(" ", " \n ")), (5, None), (6, ""), (7, " \t"),
        (8, "one two"), (9, "one two"), (10, prose(3, 40) + " " + passage + " " + prose(4, 40)),
        (11, prose(5, 40) + "\n" + passage + "\n" + prose(6, 40)), (12, "Å" * 60 + " é " + "ü" * 90),
        (13, "x" + "Å" * 60 + " é " + "ü" * 90), (14, "a b " * 200), (15, prose(7, 6000)), (16, "ONE TWO"),
        (17, "\x0b1\x1c2 3"), (18, passage), (20, prose(8, 5)), (21, prose(8, 6)),
    ]
    return rows


def repeated_rows(awkward):
    """The same with rows that share an id or have none."""
    return [*awkward, (1, awkward[0][1]), (2, prose(9, 120)), (None, awkward[0][1]), (None, None), (None, "one two")]


# ---- exact

@pytest.mark.parametrize("table_bytes", [48 << 20, 300])
def test_grace_groups_match_a_dictionary(tmp_path, table_bytes):
    rng = np.random.default_rng(0)
    records = [(k, int(rng.integers(0, 500)), 1, b"text %d" % rng.integers(0, 60)) for k in range(400)]
    records += [(400 + k, k, 2, b"") for k in range(5)]
    want = collections.defaultdict(list)
    for key, doc_id, copies, content in records:
        want[content].append((doc_id, key, copies))
    seen = {}
    for keys, entries, table in exact.grace_groups(iter(records), str(tmp_path), table_bytes):
        for key, entry in zip(keys, entries, strict=True):
            assert key not in seen
            seen[key] = (table.content[entry], table.best[entry], table.copies[entry])
    assert len(seen) == len(records) and not list(tmp_path.iterdir())
    for key, _, _, content in records:
        group = want[content]
        assert seen[key] == (content, min(g[:2] for g in group), sum(g[2] for g in group))


def test_exact_groups(spark, awkward):
    for rows in (awkward, repeated_rows(awkward)):
        got = exact.exact_groups(docs_of(spark, rows)).collect()
        groups = collections.defaultdict(list)
        for doc_id, text in rows:
            groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
        want = collections.Counter()
        for content, ids in groups.items():
            least = min((i for i in ids if i is not None), default=None)
            for i in ids:
                want[(i, least, len(ids), hashlib.sha256(content.encode()).hexdigest())] += 1
        assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
        assert all(r.doc_id == r.keep_id for r in got if r.kept)
        left = exact.without_copies(docs_of(spark, rows))
        assert left.schema == DOCS and left.count() == len(groups)


# ---- similarity join

def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = words_of(lower)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute_components(sets):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                parent[find(a)] = find(b)
    return [find(k) for k in range(len(sets))]


def check_components(spark, rows):
    got = jaccard.linked(docs_of(spark, rows)).collect()
    sets = [shingles(t) for _, t in rows]
    roots = brute_components(sets)
    least = {}
    for (doc_id, _), root in zip(rows, roots, strict=True):
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, doc_id))
    want = collections.Counter(
        (doc_id, len(s), least.get(root)) for (doc_id, _), s, root in zip(rows, sets, roots, strict=True)
    )
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    return len({r for r, s in zip(roots, sets, strict=True) if s})


def test_linked(spark, awkward):
    check_components(spark, awkward)


def test_linked_with_repeated_and_missing_ids(spark, awkward):
    rows = repeated_rows(awkward)
    groups = check_components(spark, rows)
    left = jaccard.one_of_each(docs_of(spark, rows))
    assert left.schema == DOCS
    assert left.count() == groups + sum(not shingles(t) for _, t in rows)


def test_linked_large_groups(spark, monkeypatch):
    """Mutants of one text, linked only by it; a chain; texts that share a passage. Groups are large."""
    monkeypatch.setattr(jaccard, "SMALL_GROUP", 3)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng = np.random.default_rng(5)
    base = prose(11, 200).split()
    rows = [(100, " ".join(base))]
    for k in range(40):
        own = list(base)
        for at in rng.choice(200, 3 if k % 2 else 6, replace=False):
            own[at] = f"m{k}"
        rows.append((k, " ".join(own)))
    chain = prose(12, 120).split()
    for k in range(12):
        chain = [*chain[2:], f"c{k}", f"d{k}"]
        rows.append((200 + k, " ".join(chain)))
    passage = prose(13, 60)
    rows += [(300 + k, prose(20 + k, 60) + " " + passage) for k in range(20)]
    check_components(spark, rows)


def check_links(spark, rows):
    got = jaccard.linked(docs_of(spark, rows)).collect()
    sets = {k: shingles(t) for k, t in rows}
    different = set(sets.values()) - {frozenset()}
    want = {}
    for k, s in sets.items():
        want[k] = sum(100 * len(s & o) >= 80 * len(s | o) for o in different if o != s)
    assert {r.doc_id: r.n_links for r in got} == want
    return sum(want.values())


@pytest.mark.parametrize("block, block_shingles", [(2048, 1 << 20), (8, 1 << 20), (2048, 1500)])
def test_all_links_are_counted(spark, monkeypatch, block, block_shingles):
    """Groups over ``SMALL_GROUP``: mutants of one text, most of which link with one another, and a chain."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block_shingles, raising=False)
    rng = np.random.default_rng(6)
    base = prose(31, 200).split()
    rows = []
    for k in range(40):
        own = list(base)
        for at in rng.choice(200, k % 5, replace=False):
            own[at] = f"m{k}"
        rows.append((k, " ".join(own)))
    chain = prose(32, 120).split()
    for k in range(12):
        chain = [*chain[2:], f"c{k}", f"d{k}"]
        rows.append((200 + k, " ".join(chain)))
    rows += [(300, prose(33, 90)), (301, prose(33, 90)), (302, prose(33, 90) + " more"), (303, None), (304, "a")]
    assert check_links(spark, rows) > 600


def edge_rows(count, words=60, changed=2):
    """Texts of one origin, each with words of its own, so that most pairs are just below the limit."""
    rng = np.random.default_rng(8)
    base = prose(41, words).split()
    rows = []
    for k in range(count):
        own = list(base)
        for at in rng.choice(words, changed, replace=False):
            own[at] = f"e{k}"
        rows.append((k, " ".join(own)))
    return rows


def test_edge_groups_give_no_more_pairs_than_sets(spark, monkeypatch):
    made, candidates = [], jaccard._candidates

    def counted(dealt, forest):
        out = candidates(dealt, forest)
        groups = dealt.groupBy("token", "i", "j").agg(F.count_distinct("uid").alias("members"))
        small = groups.filter(F.col("members") <= jaccard.SMALL_GROUP).count() * jaccard.SMALL_GROUP**2
        made.append((out.count(), groups.agg(F.sum("members")).first()[0] + small * (not forest)))
        return out

    monkeypatch.setattr(jaccard, "_candidates", counted)
    rows = edge_rows(150)
    check_components(spark, rows)
    assert len(made) == 2
    assert all(pairs <= limit for pairs, limit in made)
    check_links(spark, rows)


def test_forests_connect_what_links_connect():
    texts = [t for _, t in edge_rows(80)] + [t for _, t in edge_rows(30, 200, 5)]
    sets = []
    for text in texts:
        h, _ = jaccard.shingle_hashes(*jaccard.text_bytes(pa.array([text])))
        sets.append(np.unique(h))
    links = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if 100 * (c := len(np.intersect1d(sets[a], sets[b]))) >= 80 * (len(sets[a]) + len(sets[b]) - c)
    ]

    def roots(pairs):
        label = list(range(len(sets)))
        for a, b in pairs:
            label = [label[a] if v == label[b] else v for v in label]
        return [label.index(v) for v in label]

    for given in ([], links[:7]):
        x, y = jaccard.connecting_links(np.array(roots(given)), sets)
        found = list(zip(x.tolist(), y.tolist(), strict=True))
        assert {tuple(sorted(p, reverse=True)) for p in found} <= set(links)
        assert len(found) < len(sets)
        assert roots([*given, *found]) == roots(links)


def test_signature_tree_misses_no_link():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 1 << 59, rng.integers(1, 200), dtype=np.uint64)
        sets.append(np.unique(base))
        sets.append(np.unique(base[rng.random(len(base)) > 0.1]))
    sets = [s for s in sets if len(s)]
    tree = jaccard.SignatureTree(
        np.array([len(s) for s in sets]),
        [np.frombuffer(jaccard.signature(s), np.uint64) for s in sets],
        np.full(len(sets), -1),
    )
    found = {tuple(sorted(p)) for x, y in tree.pairs() for p in zip(x.tolist(), y.tolist(), strict=True)}
    for a in range(len(sets)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                assert (b, a) in found
    assert len(found) < 400


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(400, 460)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {n: find(n) for a, b in edges if a != b for n in (a, b)}


# ---- repeated passages

def brute_words(rows):
    first, out = {}, []
    for doc_id, text in rows:
        words = words_of(text)
        for k in range(len(words) - 49):
            key = tuple(words[k : k + 50])
            if doc_id is not None:
                first[key] = min(doc_id, first.get(key, doc_id))
    for doc_id, text in rows:
        words = words_of(text)
        gone = [False] * len(words)
        for k in range(len(words) - 49):
            if doc_id is not None and first[tuple(words[k : k + 50])] < doc_id:
                gone[k : k + 50] = [True] * 50
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def brute_bytes(rows):
    first, out = {}, []
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (text or "").encode()
        for k in range(len(data) - 99):
            first.setdefault(data[k : k + 100], (doc_id, k))
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 99):
            if doc_id is not None and first[data[k : k + 100]] < (doc_id, k):
                gone[k : k + 100] = b"\1" * 100
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [2000, 2])
def test_repeated_words_and_bytes(spark, awkward, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    rows = [*awkward, *[(100 + k, prose(60 + k, 30) + " " + awkward[-3][1]) for k in range(12)]]
    got = passages.without_repeated_words(docs_of(spark, rows))
    assert {tuple(r) for r in got.drop("kept").collect()} == set(brute_words(rows))
    got = passages.without_repeated_bytes(docs_of(spark, rows))
    assert {tuple(r) for r in got.drop("kept").collect()} == set(brute_bytes(rows))


def test_repeated_words_with_repeated_and_missing_ids(spark, awkward):
    rows = repeated_rows(awkward)
    got = passages.without_repeated_words(docs_of(spark, rows)).drop("kept").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(brute_words(rows))
    got = passages.without_repeated_bytes(docs_of(spark, rows)).drop("kept").collect()
    assert len(got) == len(rows)
    both = [r for r in got if r.doc_id == 1]
    assert len(both) == 2 and both[0] == both[1]


@pytest.mark.parametrize("kind", [passages.WORDS, passages.BYTES])
def test_collapsing_does_not_depend_on_batches(kind):
    """Leaders, followers and rows that share an anchor are the same however the rows are cut in batches."""
    rng = np.random.default_rng(11)
    rows = sorted({
        (int(a), int(a) * 10 + int(s), int(d), 0, int(p))
        for a, s, d, p in rng.integers(0, (40, 3, 5, 9), (150, 4))
    })
    want, by_anchor = set(), collections.defaultdict(list)
    for row in rows:
        by_anchor[row[0]].append(row)
    for group in by_anchor.values():
        heads, led = {}, set()
        for row in group:
            head = heads.setdefault(row[1], row)
            if row is not head and (kind.within or row[2] != head[2]):
                led.add(row[1])
        for row in group:
            head = heads[row[1]]
            if row is not head and (kind.within or row[2] != head[2]):
                want.add((*row, 2))
            elif len(group) > 1:
                want.add((*row, int(row is head and row[1] in led)))
    names = ["anchor", "segment", "doc_id", "copy", "at", "state"]
    for size in (1, 2, 3, 7, 1000):
        batches = [
            pa.RecordBatch.from_pylist([dict(zip(names, (*r, 0), strict=True)) for r in rows[k : k + size]])
            for k in range(0, len(rows), size)
        ]
        got = [tuple(r.values()) for b in repeats._collapsed(kind, batches) for r in b.to_pylist()]
        assert len(got) == len(want)
        assert {r[:5] for r in got} == {r[:5] for r in want}
        assert {r for r in got if r[5] == 2} == {r for r in want if r[5] == 2}
        # A leader may be taken for one too often, never too rarely.
        assert {r for r in want if r[5] == 1} <= set(got)


def test_no_repeat_without_the_index(spark):
    """Whole copies too are repeats only because the index of a shard finds the first one's windows."""

    class BlindIndex(passages.FMIndex):
        def matches(self, segments, lengths, starts):
            return iter(())

    rows = [(k, prose(k // 3, 120)) for k in range(9)]
    docs = docs_of(spark, rows).select("doc_id", F.lit(0).cast("bigint").alias("copy"), "text")
    blind = dataclasses.replace(passages.WORDS, index=BlindIndex)
    assert repeats.marks(docs, blind).count() == 0
    assert {r.doc_id for r in repeats.marks(docs, passages.WORDS).collect()} == {1, 2, 4, 5, 7, 8}


@pytest.mark.parametrize("kind", [passages.WORDS, passages.BYTES])
def test_index_finds_the_earliest_window(kind):
    rng = np.random.default_rng(4)
    width, parts = 8, [rng.integers(1, 4, rng.integers(8, 15)) for _ in range(80)]
    lengths = np.array([len(p) for p in parts])
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    text = np.concatenate([np.append(p, 0) for p in parts])
    matrix = np.zeros((len(parts), lengths.max()), np.int64)
    for k, p in enumerate(parts):
        matrix[k, : len(p)] = p
    first = {}
    for start, p in zip(starts, parts, strict=True):
        for k in range(len(p) - width + 1):
            first.setdefault(tuple(p[k : k + width]), start + k)
    count = 0
    for row, at, place in kind.index(Shard(text, width)).matches(matrix, lengths, starts):
        for r, k, p in zip(row, at, place, strict=True):
            want = first[tuple(parts[r][k : k + width])]
            own = starts[r] + k
            assert tuple(text[p : p + width]) == tuple(parts[r][k : k + width])
            assert (p < own) == (want < own)
            count += 1
    assert count == int((lengths - width + 1).sum())


def test_ids_beyond_sixteen_bits_are_kept(spark, monkeypatch):
    """Pieces that are cut keep their ids, whatever number type the vocabulary needs."""
    rows = [(k, prose(k, int(37 * (k % 13) + 300))) for k in range(60)]
    want = sorted(map(str, packing.packed(docs_of(spark, rows).coalesce(1)).collect()))
    assert packing.id_width(packing.public_tokenizers.path(packing.TOKENIZER)) == "<u2"
    monkeypatch.setattr(packing, "id_width", lambda path: "<u4")
    assert sorted(map(str, packing.packed(docs_of(spark, rows).coalesce(1)).collect())) == want


# ---- mixing

def test_documents_of_the_mix_are_whole(spark):
    rows = [(k, " ".join(f"w{k}  x{j}" for j in range(k % 40 + 1)) + "\n", "en", "ab"[k % 2]) for k in range(300)]
    texts = {r[1] for r in rows}
    got = mixing.mixture(docs_of(spark, rows)).collect()
    assert got and all(r.text in texts and r.n_chars == len(r.text) for r in got)


def test_mixing(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(400):
        source = [None, "a", "b", "c", "é", "Z"][int(rng.integers(0, 6))]
        rows.append((k, None if k % 50 == 0 else prose(k, int(rng.integers(0, 60))), "en", source))
    rows += [(None, "a b c", "en", "a"), (7, "a b c", "en", "a"), (7, "a b c", "en", "a"), (500, None, "en", "empty")]
    docs = docs_of(spark, rows)
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len(words_of(text))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, open_ones, budget = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        level = budget / sum(weight[s] for s in open_ones)
        above = {s for s in open_ones if level * weight[s] > 2 * sizes[s]}
        if not above:
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            budget -= target[s]
        open_ones -= above
    target |= {s: level * weight[s] for s in open_ones}
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        assert r.size == 0 or r.taken % r.size == 0
    # One document of each source lies on the edge and goes with the nearer side.
    longest = collections.Counter()
    for r in got:
        longest[r.source] = max(longest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 0.5 for s in order)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixed(docs.repartition(5)).collect()))
    mix = mixing.mixture(docs)
    assert mix.schema.names == DOCS.names
    words = collections.Counter()
    for r in mix.collect():
        words[r.source] += len(words_of(r.text))
    assert words == +taken
    plan = mixing.mixed(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan


# ---- packing

def test_packing_round_trip(spark, awkward):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    odd = ["it's 'sun I'M", "<|endoftext|>x <|ENDOFTEXT|>", "ÀÉ×÷ß ¿qué? İ ΣΑΣ", "a\x1cb\x85c", "日本 👍🏽 Café́", "12ab3!!x"]
    rows = [*awkward, *[(1000 + k, t) for k, t in enumerate(odd)]]
    rows += [(2000 + k, prose(k, 40 + k)) for k in range(60)]
    got = packing.packed(docs_of(spark, rows)).collect()
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(want)
    for doc_id, ids in want.items():
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            own = ids[at : at + r.length]
            assert (r.start, r.doc_tokens) == (at, len(ids)) and len(own) == r.length
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
            at += r.length
        assert at == len(ids)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW
    assert len(sequences) == -(-sum(map(len, want.values())) // packing.WINDOW)


def test_packing_repeated_ids(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (None, None)]
    got = packing.packed(docs_of(spark, rows)).collect()
    assert sum(r.length for r in got) == 3 + 3 + 2 + 1 and len({r.sequence_id for r in got}) == 1


def test_repeats_of_combinations_use_no_piece_twice():
    rng = np.random.default_rng(0)
    for histogram in (rng.integers(0, 50, 257), np.eye(257, dtype=np.int64)[40] * 999, np.zeros(257, np.int64)):
        histogram[[0, 256]] = 0
        matrix, listed = packing.combinations()
        used = sum((matrix[:, j] * n for j, n in packing.repeats(histogram)), np.zeros(257))
        assert (used <= histogram).all()
    assert all(sum(s * n for s, n in c) == packing.SLOTS for c in listed)


def test_least_squares_has_no_negative_value():
    rng = np.random.default_rng(0)
    a, want = rng.random((30, 12)), np.maximum(rng.normal(size=12), 0)
    assert np.allclose(packing.non_negative_least_squares(a, a @ want), want, atol=1e-5)
    x = packing.non_negative_least_squares(a, -np.ones(30))
    assert (x >= 0).all() and not x.any()


# ---- search

@pytest.mark.parametrize("kind", ["float", "double"])
def test_nearest_with_an_id_on_many_rows(spark, kind):
    """Thirty rows of one id near a query in one block are one neighbour."""
    rng = np.random.default_rng(3)
    near = rng.normal(size=16)
    rows = [(20, near)] + [(7, near + 0.01 * rng.normal(size=16)) for _ in range(30)]
    rows += [(100 + k, near + 0.5 * rng.normal(size=16)) for k in range(200)] + [(101, -near), (40, near * 2), (40, -near)]
    rows = [(i, v.astype(np.float32).astype(float).tolist()) for i, v in rows]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").coalesce(1)
    got = search.nearest(frame, F.col("vec_id") % 20 == 0, 20).collect()
    for q in {i for i, _ in rows if i % 20 == 0}:
        best = collections.defaultdict(lambda: -np.inf)
        for i, v in rows:
            if i != q:
                for j, w in rows:
                    if j == q:
                        best[i] = max(best[i], float(np.sum(np.array(v) * np.array(w))))
        want = sorted((-s, i) for i, s in best.items())[:20]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [i for _, i, _ in mine] == [i for _, i in want]
        assert np.allclose([s for *_, s in mine], [-s for s, _ in want])


def test_nearest(spark):
    rng = np.random.default_rng(0)
    vectors = [(int(k), [float(v) for v in rng.normal(size=6)]) for k in range(300)]
    vectors += [(1000 + k, vectors[4][1]) for k in range(60)]
    vectors += [(2000, None), (2020, [0.0] * 6), (2040, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2060, [float("nan")] * 6)]
    vectors += [(2080, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (2100, [1.0, 2.0]), (2101, [2.0, 2.0]), (None, [1.0] * 6)]
    vectors += [(7, vectors[7][1])]
    frame = spark.createDataFrame([(*v, "x", "y") for v in vectors], "vec_id long, embedding array<float>, score string, rank string")
    frame = frame.withColumn("embedding", F.col("embedding").cast("array<float>")).repartition(4)
    got = search.nearest(frame, F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False)), 20).collect()
    fine = {}
    for k, v in vectors:
        if k is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v):
            fine[k] = [float(np.float32(c)) for c in v]
    want = {}
    for q in (k for k in fine if k % 20 == 0):
        scored = []
        for k, v in fine.items():
            if k != q and len(v) == len(fine[q]):
                total = 0.0
                for x, y in zip(fine[q], v, strict=True):
                    total += x * y
                scored.append((-total, k))
        for rank, (s, k) in enumerate(sorted(scored)[:20], 1):
            want[q, rank] = (k, -s)
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == want


# ---- html

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- x <p>no</p> -->
<div class="cookie-notice">We use cookies</div><article><header><h1>Head &lt;line&gt;</h1></header>
<p><b>First</b>   one<br>two&nbsp;three.<p>Second &#233;<script>no()</script> <a href='x">'>link</a></p>
<form><input>Sign</form><aside>Side</aside><ul><li>item</li></ul>
<section class="comments"><p>Nice post</p></section></article><div class="ad">Buy</div><footer>&copy; x</footer></body>"""


def test_main_text():
    assert main_text(PAGE) == "Head <line>\nFirst one two three.\nSecond é link\nitem"
    assert main_text(None) == main_text("") == main_text("<nav>a</nav><p cl") == ""
    assert main_text("plain words") == "plain words"
    assert main_text("<nav><a>never closed<article><p>text</p>") == "text"


LONG = "The house of the man is in the town and it was built by the people that he knew in the old days of the war"


@pytest.mark.parametrize(
    "other",
    ["section class=comments", "div id=disqus", "div class='cookie-notice'", "footer", "aside", "div class=ad", "form"],
)
def test_long_blocks_under_a_mark_stay_out_beside_an_article(other):
    tag = other.split()[0]
    extra = f"<{other}><h3>Title</h3><p>{LONG} as a reader said</p><p>Nice one!</p></{tag}>"
    body = f"<p>{LONG}</p><p>{LONG} again</p>"
    want = f"{LONG}\n{LONG} again"
    assert main_text(f"<article>{body}</article>{extra}") == want
    assert main_text(f"<article>{body}{extra}</article>") == want
    assert main_text(f"<div>{body}</div>{extra}") == want


@pytest.mark.parametrize(
    "around",
    ["article class='post has-comments'", "main class='with-sidebar'", "div class='no-sidebar'", "div class=has-sidebar",
     "div class='elementor-widget-container'", "section id=social-post", "form id=aspnetForm", "nav"],
)
def test_marks_do_not_empty_a_page(around):
    name = around.split()[0]
    menu = "<div class=menu><a href=a>One</a> <a href=b>Two</a></div>"
    kept = main_text(f"<body>{menu}<{around}><p>{LONG}</p></{name}><footer>End</footer>")
    assert kept == LONG
    if name != "nav":
        nested = f"<{around}><article><h1>Head</h1><p>{LONG}</p><p>Short</p></article></{name}>"
        assert name == "form" or main_text(f"<body>{menu}{nested}") == f"Head\n{LONG}\nShort"
    assert main_text(f"<div hidden><article><p>{LONG}</p></article></div><p>{LONG} now</p>") == f"{LONG} now"


def test_blocks_in_articles_are_judged_by_links():
    links = "<ul><li><a href=a>Another story</a></li><li><a href=b>One more story</a></li></ul>"
    page = f"<article><h1><a href=x>Head</a></h1><p>{LONG}</p><p>See <a href=y>that</a> too, some more.</p>{links}</article>"
    assert main_text(page) == f"Head\n{LONG}\nSee that too, some more."


@pytest.mark.parametrize(
    "part, want",
    [
        ('<svg class="icon"/>', "one two three four"),
        ('<svg class="icon"><path d=""/></svg>', "one two three four"),
        ("<math/>", "one two three four"),
        ("<button>Press", "one two three four"),
        ("<button>Press<div>in</div></button>", "one two three four"),
        ("<p>x<button>Press</p><button>Again</button>", "one x two three four"),
        ("<select><option>a", "one two three four"),
        ("<video src=x><source>", "one two three four"),
        ("<object><p>in</p><object>in</object></object>", "one two three four"),
        ("<div><svg><path></div>", "one two three four"),
        ("<noscript><p>in</p></noscript>", "one two three four"),
        ("<textarea></p></article></textarea>", "one two three four"),
        ("<script>var t = '<p>'", "one"),
    ],
)
def test_raw_elements_end(part, want):
    page = f"<article><p>one</p>{part}<p>two</p><p>three</p></article><p>four</p>"
    assert " ".join(b.text for b in page_blocks(page)) == want


def test_short_blocks_follow_their_neighbours():
    long = "The house of the man is in the town and it was built by the people that he knew in the old days of the war"
    page = (f"<div><a href=x>One</a> <a href=y>Two</a></div><div>Short a</div><div>{long}</div>"
            f"<div>Short b</div><div><a href=z>Three</a></div><div>Short c</div>")
    blocks = page_blocks(page)
    assert [b.text for b, keep in zip(blocks, block_labels(blocks), strict=True) if keep] == ["Short a", long]


def test_extracted(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, "z"), (2, None, None, "z"), (2, "u", "", "z"), (None, "u", "<p>a", "z")],
        "page_id long, url string, html string, text string",
    )
    got = collections.Counter(map(tuple, extracted(pages).collect()))
    text = main_text(PAGE)
    assert got == collections.Counter([(1, "u", text, len(text)), (2, None, "", 0), (2, "u", "", 0), (None, "u", "a", 1)])


# ---- classifiers

def test_languages(spark):
    tongues = {"xx": "abc", "yy": "bcd", "zz": "éàü"}
    rng = np.random.default_rng(0)
    rows = []
    for k in range(300):
        lang = ["xx", "yy", "zz"][k % 3]
        text = " ".join("".join(rng.choice(list(tongues[lang]), rng.integers(2, 7))) for _ in range(12))
        rows.append((k, text, None if k % 10 == 0 else lang, "s"))
    rows += [(400, None, "xx", "s"), (401, "12 ! ", "yy", "s"), (None, "abcabc cab", "yy", "s"), (5, "ABC CAB AACB", None, "s")]
    got = language.languages(docs_of(spark, rows)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    truth = {r[0]: ["xx", "yy", "zz"][r[0] % 3] for r in rows[:300]}
    held = [r for r in got if r.held_out and r.doc_id < 300]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert {r.lang_pred for r in got if r.doc_id in (400, 401)} == {"und"}
    none = language.languages(docs_of(spark, [(1, "abc", None, "s"), (2, None, "xx", "s")])).collect()
    assert [r.lang_pred for r in none] == ["und", "und"]


def test_quality(spark):
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for k in range(400):
        good = k % 3 > 0
        words = [f"word{n}" for n in rng.integers(0, 300, 40)]
        rows.append((k, " ".join(words if good else [w.upper() + "!!" for w in words])))
        labels.append((k, int(good), 0))
    rows += [(500, None), (501, ""), (None, "x"), (3, "x" * 200_000)]
    labels += [(500, None, 0), (None, 1, 0), (999, 0, 1), (4, 1, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.judged(docs_of(spark, rows), table).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) >= 0.95 * len(held)
    kept = quality.accepted(docs_of(spark, rows), table)
    assert kept.schema == DOCS and kept.count() == sum(r.predicted for r in got)
    few = quality.judged(docs_of(spark, rows[:4]), table.limit(0)).collect()
    assert [r.score for r in few] == [0.5] * 4


# ---- all of them

def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (
        exact.exact_groups(docs), exact.without_copies(docs), jaccard.linked(docs), jaccard.one_of_each(docs),
        passages.without_repeated_words(docs), passages.without_repeated_bytes(docs), mixing.mixed(docs),
        mixing.mixture(docs), packing.packed(docs), language.languages(docs), quality.judged(docs, labels),
        quality.accepted(docs, labels),
        search.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)),
        extracted(spark.createDataFrame([], "page_id long, url string, html string")),
    ):
        assert out.collect() == []


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(0)
    rows, labels = [], []
    for k in range(120):
        good = k % 4 > 0
        text = prose(k, int(rng.integers(20, 80)))
        rows.append((k, text if good else " ".join(w.upper() + "!!" for w in text.split()), "en", f"s{k % 3}"))
        labels.append((k, int(good), 0))
    rows += [(200 + k, rows[4 * k + 1][1], "en", "s1") for k in range(10)]
    folder = str(tmp_path)
    plain = [c for c in DOCS.names if c in ("doc_id", "text", "lang", "source", "n_chars")]
    docs_of(spark, rows).select(plain).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, sizes = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == plain
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        sizes.append(docs.count())
    assert 100 <= sizes[0] < len(rows) and sizes[1] == sizes[2] == sizes[0] - 10
    # The mix and its packing are what the single operators give for the rows before them.
    mixed = spark.read.parquet(f"{folder}/mixing")
    tokens = docs.agg(F.sum("length")).first()[0]
    assert tokens == packing.packed(mixed).agg(F.sum("length")).first()[0]
    run = corpus_pipeline.run(spark, folder)
    assert isinstance(run.first(), Row) and run.agg(F.sum("length")).first()[0] == tokens
