import random

import numpy as np
from llm_cases import SCHEMA, clashing, frame, odd_rows, plain_words, prose

from jobmill.llm import neardup
from jobmill.llm.graph import components


def _shingles(text):
    words = plain_words(text)
    if not words:
        return {}
    out = {}
    for i in range(max(1, len(words) - 4)):
        key = tuple(words[i : i + 5])
        out[key] = out.get(key, 0) + 1
    return out


def _edited(text, seed, edits):
    draw = random.Random(seed)
    words = text.split()
    for i in range(edits):
        words[draw.randrange(len(words))] = f"edit{seed}x{i}"
    return " ".join(words)


def _corpus():
    rows, n = [], 0
    for g in range(12):
        base = prose(f"base{g}", 150 + 10 * g)
        for k in range(1 + g):
            rows.append(_edited(base, 100 * g + k, k % 4))
    rows += [prose(f"alone{i}", 80) for i in range(60)]
    rows += [rows[3]] * 4 + [rows[20].upper() + "!"] * 3 + ["four words are one", "four words are one!", "other four words here"]
    return [(n + i, t, "aa", "s", 0) for i, t in enumerate(rows)]


def _brute(rows):
    """Classes by weighted Jaccard with exact document frequencies."""
    sets = {i: _shingles(t) for i, t, *_ in rows}
    total = sum(1 for s in sets.values() if s)
    seen = {}
    for s in sets.values():
        for k in s:
            seen[k] = seen.get(k, 0) + 1

    def weight(k):
        share = min(max(seen[k] / total, neardup.RARE), 1.0)
        return neardup.IDF_FLOOR + np.log(1 / share) / np.log(1 / neardup.RARE)

    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    near = []
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            s, t = sets[a], sets[b]
            keys = s.keys() | t.keys()
            if not s.keys() & t.keys():
                continue
            low = sum(min(s.get(k, 0), t.get(k, 0)) * weight(k) for k in keys)
            high = sum(max(s.get(k, 0), t.get(k, 0)) * weight(k) for k in keys)
            if abs(low / high - 0.8) < 0.004:
                near.append((a, b))
            if low / high >= 0.8:
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in sets}, near


def test_classes_against_brute_force(spark):
    rows = _corpus()
    found = neardup.near_duplicate_classes(frame(spark, rows), ["doc_id"]).collect()
    expected, near = _brute(rows)
    got = {r["doc_id"]: r["class_id"] for r in found}
    assert len(found) == len(rows)
    unsure = {i for pair in near for i in pair}
    assert {i: c for i, c in got.items() if i not in unsure} == {i: c for i, c in expected.items() if i not in unsure}
    sizes = {}
    for c in got.values():
        sizes[c] = sizes.get(c, 0) + 1
    assert all(r["class_rows"] == sizes[r["class_id"]] for r in found)


def test_large_group_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CHUNK", 8)
    base = prose("hot", 200)
    rows = [(i, _edited(base, i, 1), "aa", "s", 0) for i in range(150)]
    rows += [(200 + i, prose(f"alone{i}", 60), "aa", "s", 0) for i in range(20)]
    found = neardup.near_duplicate_classes(frame(spark, rows), ["doc_id"]).collect()
    assert {r["class_id"] for r in found if r["doc_id"] < 150} == {0}
    assert all(r["class_id"] == r["doc_id"] for r in found if r["doc_id"] >= 200)


def test_no_link_is_lost_between_chunks(spark, monkeypatch):
    """Buckets of three or more nodes are cut, and still every similar pair is found."""
    monkeypatch.setattr(neardup, "CHUNK", 2)
    base, passage = prose("hot", 120), prose("passage", 90)
    texts = [_edited(base, i, 1 + i % 5) for i in range(60)]
    texts += [f"{passage} {prose(f'own{i}', 40)}" for i in range(40)]
    texts += [_edited(texts[60 + i], i, 1) for i in range(0, 40, 3)]
    rows = [(i, t, "aa", "s", 0) for i, t in enumerate(texts)]
    for rows in (rows, _corpus()):
        found = neardup.near_duplicate_classes(frame(spark, rows), ["doc_id"]).collect()
        expected, near = _brute(rows)
        unsure = {i for pair in near for i in pair}
        got = {r["doc_id"]: r["class_id"] for r in found}
        assert {i: c for i, c in got.items() if i not in unsure} == {i: c for i, c in expected.items() if i not in unsure}


def test_samples_match_weighted_jaccard():
    """The share of equal samples estimates the weighted Jaccard similarity."""
    draw = np.random.default_rng(1)
    codes = np.sort(draw.integers(0, 1 << 52, 500).astype(np.uint64))
    a = draw.uniform(1, 5, 500)
    b = a * draw.choice([1.0, 0.5, 2.0], 500)
    keep = draw.random(500) < 0.9
    exact = np.minimum(a, b * keep).sum() / np.maximum(a, b * keep).sum()
    sampler = neardup.Sampler()
    left = sampler.samples(codes, a, np.array([0, 500]), 250)
    right = sampler.samples(codes[keep], b[keep], np.array([0, keep.sum()]), 250)
    assert abs((left == right).mean() - exact) < 0.1


def test_odd_rows_keepers_and_empty_table(spark):
    docs = clashing(frame(spark, odd_rows()), "class_id", "node", "root", "n", "bucket")
    found = neardup.near_duplicate_classes(docs, ["doc_id", "text", "node"]).collect()
    assert len(found) == len(odd_rows())
    assert {r["class_id"] for r in found if r["text"] is None} == {1}
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted((1, 2, 3, None, 5, 6, 7, 8), key=str)
    empty = frame(spark, [], SCHEMA)
    assert neardup.near_duplicate_classes(empty, ["doc_id"]).collect() == []
    assert neardup.keep_one(empty).collect() == []


def test_keep_one_leaves_one_row_per_class(spark):
    rows = _corpus()
    classes = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicate_classes(frame(spark, rows), ["doc_id"]).collect()}
    kept = [r["doc_id"] for r in neardup.keep_one(frame(spark, rows)).collect()]
    assert sorted(kept) == sorted(set(classes.values()))


def test_components(spark):
    draw = random.Random(5)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(400, x) for x in range(401, 480)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
