"""Periodic runs against a direct search over all periods."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentsift.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, least=6, times=4):
    """Every stretch of words equal one period on, smallest period first."""
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - start + q >= max(least, times * q):
                out.setdefault((start, i - start + q), q)
            i = max(i, start + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def found(texts, least=6, times=4):
    offsets = np.cumsum([0] + [len(t) for t in texts])
    text, *columns = periodic.runs_of(np.array(sum(texts, []), np.int64), offsets, least, times)
    return [[tuple(int(c[i]) for c in columns) for i in np.flatnonzero(text == k)] for k in range(len(texts))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=4))
def test_small_alphabets(texts):
    assert [sorted(r) for r in found(texts)] == [brute_runs(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 12), st.data())
def test_nested_repetitions(unit, times, cut, data):
    """Repeated units of repeated units, with a word changed somewhere."""
    text = (unit * times + [9]) * 5
    text = text[min(cut, len(text) - 1):]
    at = data.draw(st.integers(0, len(text) - 1))
    changed = text[:at] + [data.draw(st.integers(0, 3))] + text[at + 1:]
    assert [sorted(r) for r in found([text, changed, text])] == [brute_runs(t) for t in (text, changed, text)]


def test_extensions_are_exact():
    rng = np.random.default_rng(3)
    for size in (1, 2, 7, 60, 400):
        body = rng.integers(5, 7, size)
        text = np.concatenate([[0], body, [1], np.tile(body[: size // 2 + 1], 3), [2]]).astype(np.int64)
        levels = periodic.recompress(text, 3)
        assert len(levels[-1][0]) == 5  # two texts between three fences, each one symbol
        inner = np.flatnonzero(text > 2)
        i, j = rng.choice(inner, 300), rng.choice(inner, 300)
        i, j = i[i != j], j[i != j]
        right = periodic.extensions(levels, i, j)
        left = periodic.extensions(periodic.mirrored(levels), len(text) - 1 - i, len(text) - 1 - j)
        for a, b, r, k in zip(i.tolist(), j.tolist(), right.tolist(), left.tolist(), strict=True):
            assert r == next(n for n in range(len(text)) if text[a + n] != text[b + n])
            assert k == next(n for n in range(len(text)) if text[a - n] != text[b - n])


def test_levels_are_linear_in_the_text():
    text = np.concatenate([[0], np.random.default_rng(4).integers(2, 500, 20_000), [1]]).astype(np.int64)
    levels = periodic.recompress(text, 2)
    assert sum(len(s) for s, _ in levels) < 8 * len(text) and len(levels) < 120


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([
        (1, "a b a b a b a b c"), (1, "a b a b a b a b c"), (2, None), (3, ""), (4, " \t\n "), (None, "x " * 6),
        (5, "x " * 5), (6, "a b c " * 4 + "a b " + "q " * 7 + "é   é   é   é  "),
        (7, "y x " * 20_000 + "z")], "id long, body string").selectExpr("id", "body", "'runs' as runs", "1 as doc_id", "2 as text")


def test_rows_of_odd_tables(spark, odd):
    rows = periodic.find_runs(odd, "id", "body").collect()
    assert len(rows) == odd.count()
    for r, (i, body) in zip(sorted(rows, key=lambda r: (r.doc_id or 0, r.n_words)),
                            sorted(((r.id, r.body) for r in odd.collect()), key=lambda x: (x[0] or 0, len(WORD.findall(x[1] or "")))),
                            strict=True):
        w = WORD.findall(body or "")
        assert r.doc_id == i and r.n_words == len(w)
        if i != 7:
            expected = brute_runs(w)
            assert [(x.start, x.length, x.period) for x in r.runs] == sorted(expected, key=lambda x: (x[0], x[2]))
            gone = {k for s, n, q in expected for k in range(s + q, s + n)}
            assert r.collapsed == " ".join(x for k, x in enumerate(w) if k not in gone)
        else:
            assert [(x.start, x.length, x.period) for x in r.runs] == [(0, 40_000, 2)] and r.collapsed == "y x z"
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.find_runs(empty).count() == 0


def test_strongest_run(spark):
    runs = "array(named_struct('start', 9L, 'length', 8L, 'period', 2L), named_struct('start', 3L, 'length', 12L, 'period', 3L)," \
           " named_struct('start', 3L, 'length', 16L, 'period', 4L), named_struct('start', 0L, 'length', 39L, 'period', 10L))"
    r = spark.range(1).selectExpr(f"{runs} as runs").select(periodic.strongest("runs").alias("r")).first().r
    assert (-r.before, r.length, -r.short) == (3, 12, 3)
    none = spark.range(1).selectExpr(f"slice({runs}, 1, 0) as runs").select(periodic.strongest("runs").alias("r")).first().r
    assert none is None
