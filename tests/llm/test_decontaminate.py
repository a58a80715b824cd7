import hashlib
import random
import time
import tracemalloc

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from llm_cases import SCHEMA, clashing, frame, odd_rows, plain_words, prose

from jobmill.llm import decontaminate as dec
from jobmill.llm.spans import PLAIN_WORD, Block


def brute(text, items):
    words = plain_words(text)
    hit, found = set(), set()
    for item_id, item in items:
        own = plain_words(item)
        size = min(10, len(own))
        if not size:
            continue
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                if item_id is not None:
                    found.add(str(item_id))
    ids = sorted(found)
    return len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


def check(spark, docs, items, **options):
    found = dec.contamination(
        frame(spark, docs), frame(spark, items, "item_id long, text string"), ["doc_id", "text"], **options
    ).collect()
    assert len(found) == len(docs)
    for r in found:
        own = (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
        assert own == brute(r["text"], items), r["text"]


def _cases():
    a, b = prose("a", 40), prose("b", 14)
    items = [(1, a), (2, b), (2, "three short words"), (3, None), (4, "..."), (None, "nobody owns this"), (12, b)]
    docs = [
        (1, prose("x", 50) + " " + " ".join(a.split()[5:15]) + " " + prose("y", 30), "aa", "s", 0),
        (2, " ".join(a.split()[5:14]) + " cut", "aa", "s", 0),  # nine words are too few
        (3, b.upper().replace(" ", " -- ") + "!", "aa", "s", 0),
        (4, "Three, short; WORDS and nobody owns this", "aa", "s", 0),
        (5, (b + " ") * 30, "aa", "s", 0),
        (6, " ".join(["w"] * 300), "aa", "s", 0),
    ]
    return [*docs, *odd_rows()], [*items, (9, " ".join(["w"] * 12))]


def test_against_brute_force(spark):
    check(spark, *_cases())


def test_slices_agree(spark):
    check(spark, *_cases(), slice_words=20)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.lists(st.sampled_from("abcd"), max_size=40), min_size=1, max_size=6),
    st.lists(st.lists(st.sampled_from("abcd"), max_size=16), min_size=1, max_size=5),
)
def test_random_words_of_a_tiny_alphabet(spark, texts, items):
    docs = [(i, " ".join(t), "aa", "s", 0) for i, t in enumerate(texts)]
    check(spark, docs, [(i, " ".join(t)) for i, t in enumerate(items)])


def test_empty_tables_and_clashing_columns(spark):
    docs, items = _cases()
    none = frame(spark, [], "item_id long, text string")
    assert not any(r["contaminated"] for r in dec.contamination(frame(spark, docs), none, ["doc_id"]).collect())
    assert dec.contamination(frame(spark, [], SCHEMA), none, ["doc_id"]).collect() == []
    wide = clashing(frame(spark, docs), "n_words", "hit_words", "item", "words")
    found = dec.contamination(wide, clashing(frame(spark, items, "item_id long, text string"), "words"), ["doc_id", "item"])
    assert found.filter("contaminated").count() == 5


def test_repeated_words_cost_little():
    data = np.frombuffer(b"same " * 20_000, np.uint8)
    words = Block(data, np.array([0, len(data)]), 0).words(PLAIN_WORD)
    hashes = words.hashes()
    known = dec._slice([{"item": "i", "words": hashes.tobytes()}])
    assert len(known.prints[10][0]) < 20
    hit = np.zeros(len(hashes), bool)
    tracemalloc.start()
    begun = time.monotonic()
    assert dec._extend(known, words, hashes, hit) == {(0, 0)}
    assert hit.all()
    assert time.monotonic() - begun < 10
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()


def test_repeated_items_are_one(spark):
    text = prose("hot item", 14)
    items = [(1, text)] * 2000 + [(2, text)]
    check(spark, [(1, "before " + text + " behind", "aa", "s", 0), (2, "none of it", "aa", "s", 0)], items)


def test_repeating_texts_against_brute_force(spark):
    draw = random.Random(3)

    def some(most, tail):
        words = [draw.choice("ab") for _ in range(draw.randint(1, most))] + ["a"] * draw.choice(tail)
        return " ".join(words + [draw.choice("ab") for _ in range(draw.randint(0, 9))])

    docs = [(i, some(60, [0, 15, 40]), "aa", "s", 0) for i in range(80)]
    items = [(i, some(30, [0, 5, 20])) for i in range(15)]
    check(spark, docs, items)
    check(spark, docs, items, slice_words=60)
