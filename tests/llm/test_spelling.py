import random
import zlib
from collections import Counter

import pytest

from sessionrank.llm import spelling
from tests.llm.texts import awkward, documents


def near(a, b):
    """Whether one code point inserted, deleted or replaced makes a word of the other."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p:] == b[p + 1:] or a[p + 1:] == b[p + 1:]


def by_hand(words):
    out = {}
    for a, n in words.items():
        others = sorted((b for b in words if near(a, b)), key=lambda b: (-words[b], b))
        form = others[0] if others and words[others[0]] >= 10 * n else None
        out[a] = (form, n, len(others), words[form] if form else None)
    rows = []
    for a, (form, n, k, m) in out.items():
        root = a
        while out[root][0]:
            root = out[root][0]
        rows.append((a, form, root, n, k, m))
    return sorted(rows, key=str)


def variants(spark, words, **options):
    df = spark.createDataFrame(list(words.items()) or [], "word string, n bigint")
    return sorted(map(tuple, spelling.variants(df, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


@pytest.mark.parametrize("pairs_per_key", [0, 20, 10**9])
def test_variants_equal_all_pairs(spark, pairs_per_key):
    rng = random.Random(3)
    words = {}
    while len(words) < 220:  # few letters, so that most keys are shared and words have several edits in common places
        w = "".join(rng.choice("aabÿé") for _ in range(rng.choice((2, 3, 7, 7, 8, 9))))
        words[w] = rng.choice((2, 3, 20, 30, 30, 400, 5000))
    assert variants(spark, words, pairs_per_key=pairs_per_key) == by_hand(words)


def test_chains_ties_and_long_words(spark):
    words = {
        "abcdefg": 2, "abcdefh": 20, "abcdexh": 200, "abcdyxh": 2000, "abczyxh": 2000, "naïvety": 5, "naivety": 50, "naivetyy": 50,
        "z" * 3000: 2, "z" * 3001: 20, "z" * 1500 + "y" + "z" * 1500: 300,
    }
    got = variants(spark, words)
    assert got == by_hand(words)
    assert {r[0]: r[2] for r in got}["abcdefg"] == "abcdyxh"
    assert variants(spark, {}) == []


def test_words_of_a_table(spark):
    texts = [*awkward(words="Colour colour color colours cølour ÉTUDIER étudier centre0centre the-theatre theater".split()), "COLOUR " * 50]
    ids = [None if i % 11 == 0 else i % 40 for i in range(len(texts))]
    counts = Counter()
    for i, t in zip(ids, texts):
        name = "" if i is None else str(i)
        run = ""
        for c in [*(t or ""), " "]:
            if "a" <= c.lower() <= "z" and c.isascii() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                x = zlib.crc32(f"{name}:{run}".encode())
                if x % 31 == 0:
                    run = run[:x % len(run)] + run[x % len(run) + 1:]
                counts[run] += 1
                run = ""
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    got = spelling.group_variants(documents(spark, texts, ids=ids), spelling.noisy).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(words) and len(words) > 3


def test_no_key_is_joined_beyond_its_limit(spark):
    """A chunk that all words share is cut again, so that candidates stay near the number of true pairs."""
    words = spark.createDataFrame([(f"commonprefix{a}{b}{c}",) for a in "abcdefgh" for b in "ijklmnop" for c in "qrstuvwx"], "word string")
    pairs = spelling.near_pairs(words, 16)
    assert pairs.count() == 512 * 21 // 2 and pairs.distinct().count() == pairs.count()
