"""Spelling variants against a comparison of all words."""

import itertools
import random

import numpy as np
import pytest

from sentsift.llm import spelling


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def expected(counts, ratio=10):
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if one_apart(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def got(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.fixture(scope="module")
def counts():
    """Words of common syllables and their misspellings, so that grams are frequent and neighbours many."""
    rng = random.Random(5)
    syllables = ["ing", "tion", "ab", "e", "ment", "é", "re", "q", "ion", "ÿ", "×"]
    out = {}
    for _ in range(350):
        w = "".join(rng.choice(syllables) for _ in range(rng.randint(2, 5)))
        out[w] = rng.choice([2, 3, 20, 40, 500, 6000])
        for _ in range(2):
            p, kind = rng.randrange(len(w) + 1), rng.random()
            out.setdefault(w[:p] + w[p + 1:] if kind < 0.3 else w[:p] + rng.choice("abeéx") + w[p + (kind < 0.6):],
                           rng.choice([2, 3, 20, 40, 500]))
    # Both ends, ties, long words, other alphabets, one-letter words, a chain of forms.
    out |= {"bcdefgh": 2, "abcdefgh": 30, "abcdefg": 30, "a" * 300: 5, "a" * 301: 60, "a" * 150 + "b" + "a" * 150: 7,
            "\U0001d4b3слово": 2, "слово": 50, "x": 3, "y": 40, "chaina": 1, "chainab": 10, "chainabc": 100, "chainabcd": 1000}
    out.pop("", None)
    return out


def test_groups(spark, counts):
    rows = list(counts.items()) + [("", 9), (None, 9)]
    table = spark.createDataFrame(rows, "word string, n long").selectExpr("*", "'clash' as form", "1 as key", "2 as root")
    assert got(spelling.spelling_groups(table)) == expected(counts)


def test_repeated_rows_add_up_and_empty_table(spark):
    twice = spark.createDataFrame([("letters", 6), ("letters", 6), ("leters", 1)], "word string, n long")
    assert got(spelling.spelling_groups(twice)) == expected({"letters": 12, "leters": 1})
    assert got(spelling.spelling_groups(twice.limit(0))) == {}


@pytest.mark.parametrize("dictionary", [[], ["ab", "bc", "abc"], ["aa", "aaa", "aaaa"]])
def test_any_dictionary_finds_all(spark, dictionary):
    """Long and short grams change the lists only."""
    hashes = np.sort(np.array([spelling._gram(spelling._characters([g])[1], len(g))[0] for g in dictionary], np.uint64))
    words = ["abcabc", "abcbc", "abcab", "bcabc", "abxabc", "aaaaaaa", "aaaaaa", "aaabaaa", "ab", "b", "bc", "abcabcx"]
    keys = spark.createDataFrame([(w, 1) for w in words], "word string, n long").mapInArrow(
        spelling._keys(hashes), "key long, word string, n long, adds boolean")
    pairs = {(r.word, r.other) for r in spelling.near_words(keys).collect()}
    assert pairs == {(a, b) for a in words for b in words if one_apart(a, b)}


def test_affected_grams_bound():
    dictionary = np.zeros(0, np.uint64)
    assert spelling.affected("letters", dictionary) == [1, 2, 2, 2, 2, 2, 2]
    assert max(spelling.affected("lettersandmore", dictionary)) <= spelling.QMAX


def test_dictionary_is_pruned(spark):
    rows = [(f"common{chr(97 + i % 26)}{chr(97 + i // 26)}", 1) for i in range(200)]
    hashes = spelling.gram_dictionary(spark.createDataFrame(rows, "word string, n long"))
    gram = lambda g: spelling._gram(spelling._characters([g])[1], len(g))[0]
    assert gram("com") in hashes and gram("na") not in hashes and len(hashes) < 40


def test_vocabulary_and_runs(spark):
    runs = spark.createDataFrame([("Abcdefgh ijklmno-pqrstuv", ), (None, ), ("éééééééé ×÷×÷×÷×", )], "text string").select(
        spelling.letter_runs("text", 7).alias("r"))
    assert [r.r for r in runs.collect()] == [["Abcdefgh", "ijklmno", "pqrstuv"], [], ["éééééééé", "×÷×÷×÷×"]]
    words = spark.createDataFrame([("letters",), ("letters",), ("short",), ("short",), ("singles",), (None,)], "word string")
    assert [(r.word, r.n) for r in spelling.vocabulary(words).collect()] == [("letters", 2)]
