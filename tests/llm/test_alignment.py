import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import clashing, frame, odd_rows, prose

from jobmill.llm import alignment
from jobmill.llm.alignment import NUMBERS, Encoder, Tokenizers, Units, align, translation
from jobmill.llm.perfect_hash import PerfectHash
from jobmill.llm.q_alignment import TOKENIZERS
from jobmill.llm.spans import U64

FILES = Tokenizers.read(f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
ENCODER = Encoder(FILES)
ODD = [" ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "　", " ", "\x1c", "\x85", "a", "Bc", "é", "é", "中",
       "🙂", "'s", "12", "!", "...", "▁", "<s>", "<|endoftext|>", "<0x41>", "\x00", "﻿", "​", "᠎", "{", "}"]


def whole(text):
    """Ids and byte ends of both tokenizers over the uncut text; None without tokens."""
    if not text:
        return None
    data = (" " + text).encode()
    a = ENCODER.a.encode(" " + text, add_special_tokens=False).ids
    b = ENCODER.b.encode(text)
    bytes_a, bytes_b = [ENCODER.bytes_a[i] for i in a], [ENCODER.bytes_b[i] for i in b]
    if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
        return None
    return a, b, np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()


def brute_force(texts):
    """The result rows by quadratic overlap over whole texts."""
    tokens = [whole(t) for t in texts]
    links, groups = [], []
    for found in tokens:
        if found is None:
            links.append([])
            groups.append([])
            continue
        a, b, ends_a, ends_b = found
        spans_a, spans_b = list(zip([0, *ends_a], ends_a)), list(zip([0, *ends_b], ends_b))  # noqa: B905
        links.append([(x, y) for x, (p, q) in zip(a, spans_a, strict=True)
                      for y, (r, s) in zip(b, spans_b, strict=True) if p < s and r < q])
        cut, own, lo = sorted(set(ends_a) & set(ends_b)), [], 0
        for hi in cut:
            left = [str(x) for x, e in zip(a, ends_a, strict=True) if lo < e <= hi]
            right = [str(x) for x, e in zip(b, ends_b, strict=True) if lo < e <= hi]
            own.append(",".join(left) + "|" + ",".join(right))
            lo = hi
        groups.append(own)
    counts = Counter(p for own in links for p in set(own))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    rows = []
    for found, own, cut in zip(tokens, links, groups, strict=True):
        n_a, n_b = (len(found[0]), len(found[1])) if found else (0, 0)
        sha = hashlib.sha256(";".join(cut).encode()).hexdigest() if found else ""
        rows.append((n_a, n_b, len(cut), len(own), sum(counts[p] == best[p[0]] for p in own), sum(counts[p] for p in own), sha))
    return rows, counts


def texts():
    draw = random.Random(5)
    odd = ["".join(draw.choices(ODD, k=draw.randint(1, 14))) for _ in range(150)]
    return [None, "", " ", "\n", "  \n ", *odd, *odd[:20], *(prose(i, 60) for i in range(20)), "x" * 900, prose("x", 200)]


@pytest.mark.parametrize(
    "limits", [{}, {"BUCKET": 40, "PAIRS_AT_ONCE": 100, "GROUP_ROWS": 8}, {"UNITS": 5, "LOT": 7, "SEGMENT": 16}]
)
def test_as_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(alignment, name, value)
    given = texts()
    if "UNITS" in limits:  # workers have modules of their own; the pieces of a worker are run here
        return small_units(given)
    want, _ = brute_force(given)
    docs = frame(spark, [(i, t, None, None, 0) for i, t in enumerate(given)]).repartition(3)
    got = align(docs, ["doc_id"], FILES).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == want
    assert got[0].asDict().keys() == {"doc_id", *NUMBERS, "groups_sha256"}


def small_units(given):
    """Both passes of one task, with units forgotten all the time, also within a text."""
    import pyarrow as pa

    from jobmill.llm.spans import blocks

    class Held:
        def __init__(self, value):
            self.value = value

    caught = {}
    keep = alignment.fold_texts, alignment.map_texts
    alignment.fold_texts = lambda df, columns, schema, worker: caught.update(first=worker)
    alignment.map_texts = lambda df, text, keep, fields, worker: caught.update(second=worker)
    try:
        want, counts = brute_force(given)
        column = pa.array(given)
        alignment.pair_documents(None, "text", Held(FILES))
        take, give = caught["first"]()
        for block in blocks(column):
            take(block, None)
        found = Counter()
        for batch in give():
            for key, _, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found[key >> 32, key & 0xFFFFFFFF] += n
        assert found == counts

        keys = np.array([a << 32 | b for a, b in counts], U64)
        function = PerfectHash.build(keys)
        known, vector = np.empty(len(keys), U64), np.empty(len(keys), np.int64)
        known[function.index(keys)], vector[function.index(keys)] = keys, list(counts.values())
        best = np.zeros(1 << 17, np.int64)
        for (a, _), n in counts.items():
            best[a] = max(best[a], n)
        lookup = alignment.Lookup(1, [(0, function.tobytes(), known.tobytes(), vector.tobytes())], best)
        alignment._looked_up(None, [], Held(FILES), Held(lookup))
        work = caught["second"]()
        rows = [r for block in blocks(column) for r in zip(*(list(c) for c in work(block)), strict=True)]
        assert rows == want
    finally:
        alignment.fold_texts, alignment.map_texts = keep


def test_units_are_the_whole_text():
    draw = random.Random(8)
    for _ in range(3000):
        text = "".join(draw.choices(ODD, k=draw.randint(1, 12)))
        units = [u for own in ENCODER.units(text) for u in own]
        assert "".join(units) == " " + text
        found = whole(text)
        learned = Units(ENCODER, texts=True)
        learned.learn([(0, units)])
        assert (found is not None) == (not learned.bad)
        if found:
            a, b = ENCODER.encode(units)
            assert (sum(a, []), sum(b, [])) == found[:2]


def test_units_encoded_together_are_as_alone():
    draw = random.Random(9)
    calls = []

    class Quick:
        def encode_ordinary(self, text):
            calls.append(text)
            return ENCODER.quick.encode_ordinary(text)

    for _ in range(300):
        texts = ["".join(draw.choices(ODD, k=draw.randint(1, 12))) for _ in range(6)] + [prose(f"u{_}", 9), "x" * 300]
        units = [u for text in texts for own in ENCODER.units(text) for u in own]
        own = Encoder.__new__(Encoder)
        own.__dict__.update(ENCODER.__dict__, quick=Quick())
        calls.clear()
        assert own.encode(units)[0] == [ENCODER.a.encode(u, add_special_tokens=False).ids for u in units]
        apart = sum(u[0] != " " or u[-1].isspace() for u in units if len(u) <= alignment.QUICK_CHARS)
        assert len(calls) == 1 + apart
        learned = Units(ENCODER, texts=True)
        learned.learn([(0, units)])
        for unit, number in learned.known.items():
            want, _ = brute_force([unit[1:]]) if unit[0] == " " and len(unit) > 1 else ([], None)
            if want and number not in learned.bad:
                assert hashlib.sha256(learned.groups[number]).hexdigest() == want[0][6]


def test_odd_rows_clashes_and_none(spark):
    docs = clashing(frame(spark, odd_rows()), "n_a", "kept", "key", "Text2")
    found = align(docs, ["doc_id", "lang", "kept", "n_a", "Text2"], FILES)
    assert found.columns == ["doc_id", "lang", "kept", "Text2", *NUMBERS, "groups_sha256"]
    rows = found.collect()
    assert len(rows) == docs.count() and {r["kept"] for r in rows} == {"own kept"}
    want, _ = brute_force([r[1] for r in odd_rows() if r[0] != 8])
    assert sorted(r["n_links"] for r in rows if r["doc_id"] != 8) == sorted(w[3] for w in want)
    assert align(docs.limit(0), ["doc_id"], FILES).collect() == []


def test_translation(spark):
    given = ["the cat sat", "the cat", "a cat"]
    _, counts = brute_force(given)
    best = {}
    for (a, b), n in sorted(counts.items()):
        if n > best.get(a, (0, 0))[1]:
            best[a] = (b, n)
    docs = frame(spark, [(i, t, None, None, 0) for i, t in enumerate(given)])
    assert sorted(map(tuple, translation(docs, FILES).collect())) == sorted((a, *x) for a, x in best.items())


def test_perfect_hash():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 1000, 50_000):
        keys = np.unique(draw.integers(0, 1 << 62, n).astype(U64))
        function = PerfectHash.frombytes(PerfectHash.build(keys).tobytes())
        assert sorted(function.index(keys).tolist()) == list(range(len(keys)))
    others = draw.integers(1 << 62, 1 << 63, 1000).astype(U64)
    at = function.index(others)
    assert ((at >= -1) & (at < len(keys))).all()
