import math
import random

import numpy as np
from llm_cases import SCHEMA, SPACED, clashing, frame, odd_rows, prose
from pyspark.sql import functions as F

from jobmill.llm import lm, quality, toxicity
from jobmill.llm.spans import Block, held_out

LABELS = "doc_id long, quality int, toxic int"


def _brute(text):
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    symbols = sum(text.count(x) for x in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    draw = random.Random(2)
    made = ["".join(draw.choices("ab \n\t#é|", k=draw.randrange(120))) for _ in range(60)]
    made += ["a b c d e a b c d e", "x\nx\n\nx \nx", "\n\n", "a b c d e f a b c d e g", "é" * 50 + "   z"]
    docs = frame(spark, odd_rows() + [(100 + i, t, "aa", "s", 0) for i, t in enumerate(made)])
    for r in quality.apply_rules(docs, None, ["text"]).collect():
        assert tuple(r[x] for x in quality.COUNTS) == _brute(r["text"]), r["text"]
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed)


def _labelled(spark):
    draw = random.Random(4)
    docs, labels = [], []
    for i in range(400):
        text = prose(f"q{i}", 60)
        bad, toxic = i % 4 == 0, i % 5 == 0
        if bad:
            text = " ".join(w + draw.choice(["%%%", "###", "$$$"]) for w in text.split())
        if toxic:
            words = text.split()
            for insult in ("zzidiot", "zzscum", "zzmoron"):
                words.insert(draw.randrange(len(words)), insult)
            text = " ".join(words) + " you!"
        docs.append((i, text, "aa", "s", 0))
        if i % 8 != 7:
            labels.append((i, int(not bad), int(toxic)))
    return frame(spark, docs), spark.createDataFrame(labels, LABELS)


def test_quality_verdict(spark):
    docs, labels = _labelled(spark)
    model = quality.train(clashing(docs, "label", "fold", "rank"), labels)
    rows = quality.apply_rules(docs, model, ["doc_id"]).collect()
    assert sum(r["kept"] == (r["doc_id"] % 4 != 0) for r in rows) >= 395
    assert all(0 <= r["quality"] <= 1 for r in rows)


def test_toxicity_held_out(spark):
    docs, labels = _labelled(spark)
    model = toxicity.train(docs, labels, eligible=~held_out("id"))
    rows = toxicity.toxicity(docs, model, ["doc_id"]).withColumn("h", held_out()).filter("h").collect()
    assert len(rows) > 60
    assert sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_isotonic_is_the_pooled_mean():
    score = np.arange(6.0)
    steps, levels = toxicity.isotonic(score, np.array([0, 1, 0, 1, 1, 1]), np.full(6, 1000.0))
    assert np.allclose(np.interp(score, steps, levels), [0, 0.5, 0.5, 1, 1, 1], atol=1e-3)


def test_classifiers_on_odd_and_empty_tables(spark):
    docs, labels = _labelled(spark)
    odd = clashing(frame(spark, odd_rows()), "score", "quality", "kept", "predicted")
    dirty = labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, None, None), (5, 1, 0), (5, 1, 0)], LABELS))
    both = odd.select(docs.columns).unionByName(docs)
    wide = ["doc_id", "text", "score", "quality", "kept", "predicted"]
    a = quality.apply_rules(odd, quality.train(both, dirty), wide).collect()
    b = toxicity.toxicity(odd, toxicity.train(both, dirty), wide).collect()
    assert len(a) == len(b) == len(odd_rows())
    assert len({r["score"] for r in b if not r["text"]}) == 1
    empty, none = frame(spark, [], SCHEMA), spark.createDataFrame([], LABELS)
    assert quality.train(docs, none) is None and toxicity.train(docs, none) is None
    assert quality.train(empty, labels) is None and toxicity.train(empty, labels) is None
    assert quality.apply_rules(empty, None, ["doc_id"]).collect() == []
    assert {r["score"] for r in toxicity.toxicity(odd, None, ["doc_id"]).collect()} == {0.0}


def test_lm_prefers_the_order_it_learned(spark):
    cycle = [f"w{i}" for i in range(12)]
    draw = random.Random(1)
    rows = []
    for i in range(400):
        start = draw.randrange(12)
        rows.append((i, " ".join(cycle[(start + k) % 12] for k in range(60)), "aa", "s", i))
    docs = frame(spark, rows)
    mixed = [x for x in rows[0][1].split()]
    draw.shuffle(mixed)
    vocabulary = lm.Vocabulary.of(lm.count_bins(docs, "text"))
    probe = frame(spark, [(1, rows[7][1], "", "", 0), (2, " ".join(mixed), "", "", 0)])
    network = lm.train(docs, vocabulary)
    got = {r["doc_id"]: r for r in lm.score(probe, vocabulary, network, ["doc_id"]).collect()}
    fresh = {r["doc_id"]: r for r in lm.score(probe, vocabulary, lm.Network(vocabulary), ["doc_id"]).collect()}
    assert got[1]["mean_log_prob"] > got[2]["mean_log_prob"] + 0.3
    assert got[1]["mean_log_prob"] > fresh[1]["mean_log_prob"] + 0.5


def test_lm_sums_and_counts_against_brute_force(spark):
    docs = frame(spark, [*odd_rows(), *((50 + i, prose(f"l{i}", 90), "aa", "s", 0) for i in range(30))])
    from llm_cases import plain_words

    counts = lm.count_bins(docs, "text")
    texts = [r["text"] for r in docs.collect()]
    assert counts.sum() == sum(len(plain_words(t)) for t in texts)
    vocabulary = lm.Vocabulary.of(counts)
    network = lm.train(docs, vocabulary)
    around = np.array([[0, 300, 7, 0]])
    every = network.log_probability(np.repeat(around, lm.WORD_BINS, axis=0), np.arange(lm.WORD_BINS))
    assert abs(np.exp(every).sum() - 1) < 1e-3
    wide = clashing(docs, "n_words", "log_prob")
    for r in lm.score(wide, vocabulary, network, ["text"]).collect():
        assert r["n_words"] == len(plain_words(r["text"]))
        assert (r["log_prob"] == 0) == (r["n_words"] == 0)
    assert lm.score(frame(spark, [], SCHEMA), vocabulary, network, ["doc_id"]).collect() == []


def _plain_score(network, bins):
    """Log-probability of a text's words, decision by decision."""
    known, rows, total = network.known, network.rows.astype(float), 0.0
    inner = rows[network.inner : network.nodes - 1]
    for i, b in enumerate(bins):
        near = [i + step for step in (-2, -1, 1, 2)]
        joined = np.concatenate([rows[known.own[bins[j]] if 0 <= j < len(bins) else 0] for j in near])
        hidden = np.tanh(joined @ inner + rows[network.nodes - 1])
        hidden[-1] = 1
        total += known.share[b]
        for at in range(known.first[known.group[b]], known.first[known.group[b] + 1]):
            odds = rows[network.nodes + known.node[at]] @ hidden
            total -= math.log1p(math.exp(-odds if known.side[at] else odds))
    return total


def test_lm_scores_against_brute_force(spark):
    docs = frame(spark, [(i, prose(f"b{i}", 3 + i), "aa", "s", 0) for i in range(40)])
    vocabulary = lm.Vocabulary.of(lm.count_bins(docs, "text"))
    network = lm.train(docs, vocabulary)
    for r in lm.score(docs, vocabulary, network, ["text"]).collect():
        data = r["text"].encode()
        block = Block(np.frombuffer(data, np.uint8), np.array([0, len(data)]), 0)
        assert abs(_plain_score(network, lm._bins(block)[0]) - r["log_prob"]) < 1e-3 * r["n_words"]


def test_lm_steps_against_plain_ones():
    draw = np.random.default_rng(4)
    counts = np.zeros(lm.WORD_BINS, np.int64)
    counts[draw.choice(lm.WORD_BINS, 400, replace=False)] = draw.zipf(1.5, 400).clip(1, 9000)
    bins = draw.choice(lm.WORD_BINS, 500, p=counts / counts.sum())
    learner = lm.Learner(lm.Network(lm.Vocabulary.of(counts)))
    network = learner.network
    around = network.neighbours(bins, np.array([0, 200, 200, 500]))
    known, rows = network.known, network.rows.astype(float)
    slope, inner = np.zeros(rows.shape), slice(network.inner, network.nodes - 1)
    met = np.zeros(len(rows))
    for near, b in zip(around, bins, strict=True):
        joined = rows[near].ravel()
        hidden = np.tanh(joined @ rows[inner] + rows[network.nodes - 1])
        hidden[-1] = 1
        back = np.zeros(lm.WIDTH)
        for at in range(known.first[known.group[b]], known.first[known.group[b] + 1]):
            row = network.nodes + known.node[at]
            error = 1 / (1 + math.exp(-rows[row] @ hidden)) - known.side[at]
            back += error * rows[row]
            slope[row] += error * hidden
            met[row] += 1
        back *= 1 - hidden * hidden
        slope[inner] += np.outer(joined, back)
        slope[network.nodes - 1] += back
        np.add.at(slope, near, (rows[inner] @ back).reshape(-1, lm.WIDTH))
        np.add.at(met, near, 1)
    met[network.inner : network.nodes] = len(bins)
    seen = met > 0
    rows[seen] -= lm.RATE * slope[seen] / np.sqrt(1e-6 + slope[seen] ** 2)
    learner.learn(around, bins)
    firm = (np.abs(slope) > 1e-2) | ~seen[:, None]
    assert np.allclose(network.rows[firm], rows[firm], atol=1e-4)
    assert np.array_equal(learner.met, met)
    assert known.turns.shape[1] > 4 and (known.below > 0).any()


def test_lm_tells_equally_frequent_words_apart(spark):
    draw = random.Random(5)
    rows = []
    for i in range(6000):
        words = [f"f{draw.randrange(8)}" for _ in range(20)]
        pair = ("left", "upon") if i % 2 else ("right", "below")
        rows.append((i, " ".join([*words[:10], *pair, *words[10:]]), "aa", "s", 0))
    docs = frame(spark, rows).coalesce(2)
    vocabulary = lm.Vocabulary.of(lm.count_bins(docs, "text"))
    probe = frame(spark, [(1, "f1 f2 left upon f3 f4", "", "", 0), (2, "f1 f2 right upon f3 f4", "", "", 0)])
    got = {r["doc_id"]: r["log_prob"] for r in lm.score(probe, vocabulary, lm.train(docs, vocabulary), ["doc_id"]).collect()}
    assert got[1] > got[2] + 1


def test_lm_training_without_rows(spark):
    docs = frame(spark, [], SCHEMA)
    vocabulary = lm.Vocabulary.of(lm.count_bins(docs, "text"))
    assert np.array_equal(lm.train(docs, vocabulary).rows, lm.Network(vocabulary).rows)
    assert F is not None


def test_lm_learns_from_every_document(spark):
    for i in range(3):
        docs = frame(spark, [(i, f"one text {i} is all there is", "aa", "s", i)])
        vocabulary = lm.Vocabulary.of(lm.count_bins(docs, "text"))
        learned = lm.train(docs, vocabulary)
        assert not np.array_equal(learned.rows, lm.Network(vocabulary).rows)
