import random
import re

import numpy as np
import pyarrow as pa
from llm_cases import clashing, frame, odd_rows

from jobmill.llm import pii
from jobmill.llm.pii_candidates import KINDS, Finder
from jobmill.llm.spans import blocks

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        total = sum((int(d) * 2 - 9 * (int(d) > 4)) if i % 2 else int(d) for i, d in enumerate(digits[::-1]))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return True


def brute_force(text):
    found = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text or ""):
            if passes(kind, m.group()):
                found.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(found))


def strict_spans(texts):
    out = []
    for block in blocks(pa.array(texts, pa.string())):
        finder = Finder(block)
        out += pii._listed(finder, finder.strict())
    return out


CARD = "4845168114407329"
GIVEN = [
    None, "", "ünï a.b+c@d-e.fr, x", "a@b.c_d@e.f@g.h", "@b.c a@b a@b. a@@b.c", "1.2.3.4.5.6.7.8.9", "256.1.1.1 001.002.003.0255",
    CARD, f"{CARD} {CARD}", "4845 1681-1440 7329.", "+1 (017) 555-7713!", "+1 2 3", "++49 30 1234567 890 -", "+12345678901234567",
    "１２ ٣ é1.2.3.4é", "9" * 5000, "1." * 3000, "a" * 5000 + "@" + "b." * 2000, "+1 " * 500,
]


def test_strict_matches_as_patterns():
    draw = random.Random(4)
    parts = [*"0123456789", *"0123456789", *"+-. @()", *"ab%_é", "  ", "\n", CARD, "1.2.3.4", "a@b.c", "255", "+4930"]
    texts = GIVEN + ["".join(draw.choices(parts, k=draw.randint(1, 25))) for _ in range(6000)]
    assert strict_spans(texts) == [brute_force(t) for t in texts]


def test_query_columns_and_odd_rows(spark):
    rows = [(100 + i, t, "aa", "s", 0) for i, t in enumerate(GIVEN)]
    docs = clashing(frame(spark, odd_rows() + rows), "kind", "n", "SPANS2", "votes")
    found = pii.find(docs, pii.train(docs), ["doc_id", "kind", "votes"])
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in found.collect():
        assert (r["kind"], r["votes"]) == ("own kind", "own votes")
        assert r["base_spans"] == brute_force(texts[r["doc_id"]])
        strict = r["base_spans"].split(",") if r["base_spans"] else []
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s.startswith(k + ":") for s in strict) for k in KINDS]
        assert set(strict) <= set(r["spans"].split(","))
    none = docs.limit(0)
    assert pii.find(none, pii.train(none), ["doc_id"]).collect() == []


def corpus():
    """Texts with strict and near matches of known truth."""
    draw = random.Random(6)
    rows, truth = [], {}
    for i in range(600):
        good = draw.choice(["41", "51", "37"]) + "".join(draw.choices("0123456789", k=13))
        good += next(d for d in "0123456789" if passes("card", good + d))
        noise = draw.choice("0789") + "".join(draw.choices("0123456789", k=15))
        noise = noise if not passes("card", noise) else noise[:-1] + str((int(noise[-1]) + 1) % 10)
        area, line = draw.randint(200, 999), draw.randint(1000, 9999)
        text, near = draw.choice([
            (f"call +1 ({area}) 555-{line} now", None),
            (f"phone 0{area} 5555-{line} today", None),
            (f"my card {good} is", None),
            (f"cards {good} {good} end", ("card", 6, 22)),
            (f"number {noise} end", None),
            ("plain words only, version 2.300.1.1 of it", None),
        ])
        rows.append((i, text, "aa", "s", 0))
        truth[i] = near
    return rows, truth


def test_adds_near_misses_and_leaves_failing_numbers(spark):
    rows, truth = corpus()
    docs = frame(spark, rows)
    model = pii.train(docs)
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs, model, ["doc_id"]).collect()}
    for i, text, *_ in rows:
        if truth[i]:
            kind, start, end = truth[i]
            assert f"{kind}:{start}:{end}" in found[i].split(","), (text, found[i])
        if text.startswith(("number", "plain")):
            assert found[i] == brute_force(text), (text, found[i])
    check = model.labels[KINDS.index("card")].votes[pii._CHECK]
    assert check[0, 2] > 0.9 and check[1, 0] > 0.9  # the checksum is found reliable both ways


def test_reliabilities_of_simulated_labelers():
    draw = np.random.default_rng(2)
    truth = draw.random(20_000) < 0.3
    right = np.array([0.95, 0.8, 0.7, 0.9])
    votes = np.where(draw.random((20_000, 4)) < right, 1, -1) * np.where(truth, 1, -1)[:, None]
    votes[draw.random((20_000, 4)) < 0.2] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    labels, belief = pii.reliabilities(patterns, counts.astype(float), check=0)
    assert abs(labels.prior - 0.3) < 0.02
    assert np.allclose(labels.votes[:, 0, 2], right, atol=0.03)
    assert ((belief > 0.5) == (patterns @ np.log(right / (1 - right)) + np.log(0.3 / 0.7) > 0)).mean() > 0.95


def test_masked():
    text = "é a@b.c and 1.2.3.4"
    assert pii.masked(text, brute_force(text)) == "é [email] and [ip]"
    assert pii.masked("none", "") == "none"
