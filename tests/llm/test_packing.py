"""Packing: every id in one piece, ids by the tokenizer itself, windows full or powers of two."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sentsift.llm import packing

TEXTS = ["a  b", "a  \nx", "\n\n  x\n y  ", None, "", " ", "a\t\tb \n", "it's  we'll  z", "  lead", "x<|endoftext|> y",
         "é" * 50 + " \r\n\r\n q", "  x  \n y", "a  b", "\x1c c", "word " * 3000, "\U0001d4b3 ok", "a\x0b\x0c b"]


@pytest.fixture(scope="module")
def table(spark, docs):
    odd = spark.createDataFrame([(700 + k, t) for k, t in enumerate(TEXTS)] + [(700, "a  b"), (None, "null id")],
                                "doc_id long, text string")
    return docs.select("doc_id", "text").unionByName(odd).selectExpr("*", "0 as row", "'x' as start", "1 as `group`")


def ids_of(texts):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(packing.tokenizer_path())
    return [e.ids + [packing.END] for e in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pieces(table):
    rows = [(r.doc_id, r.text) for r in table.collect()]
    left = collections.Counter((i, tuple(ids)) for (i, _), ids in zip(rows, ids_of([t for _, t in rows]), strict=True))
    pieces = packing.pack(table, windows=8).collect()
    by_doc = collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for (i, ids), times in left.items():
        own = [p for p in by_doc[i] if p.doc_tokens == len(ids)]
        raw = np.array(ids, "<u4").tobytes()
        assert all(p.ids_crc32 == zlib.crc32(raw[4 * p.start: 4 * (p.start + p.length)]) for p in own)
        assert sorted(k for p in own for k in range(p.start, p.start + p.length)) == sorted(list(range(len(ids))) * times)
    windows = collections.defaultdict(list)
    for p in pieces:
        assert p.length > 0
        windows[p.sequence_id].append((p.offset, p.length))
    sizes = []
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sizes.append(at)
    assert all(n == packing.CAPACITY or n < packing.CAPACITY and n & (n - 1) == 0 for n in sizes)
    assert sum(n == packing.CAPACITY for n in sizes) > 0.9 * len(sizes) - 40


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_segments_give_the_ids_of_the_whole_text():
    encoder = packing.Encoder(packing.tokenizer_path())
    for _ in range(2):  # the second time from the store
        at, ids = encoder.encode(pa.array(TEXTS, pa.string()))
        assert [ids[a:b].tolist() + [packing.END] for a, b in zip(at[:-1], at[1:], strict=True)] == ids_of(TEXTS)


def test_store_forgets(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 3)
    encoder = packing.Encoder(packing.tokenizer_path())
    for texts in (["a b c d", "e f"], ["c d e", None], ["a b c d", "x y"]):
        at, ids = encoder.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() + [packing.END] for a, b in zip(at[:-1], at[1:], strict=True)] == ids_of(texts)


def sums(sizes, windows):
    return [sum(sizes[i] for i in w) for w in windows]


def test_differencing_is_near_equal():
    """The textbook case, and fewer items than windows."""
    assert sorted(sums([8, 7, 6, 5, 4], packing.difference([8, 7, 6, 5, 4], 2))) == [14, 16]
    assert sorted(sums([4, 5, 6, 7, 8], packing.difference([4, 5, 6, 7, 8], 3))) == [8, 11, 11]
    assert packing.difference([3, 2], 5) in ([[0], [1]], [[1], [0]])
    assert packing.difference([], 3) == []
    rng = random.Random(6)
    for _ in range(50):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(40, 200))]
        k = rng.randint(2, 6)
        got = packing.difference(sizes, k)
        assert sorted(i for w in got for i in w) == list(range(len(sizes)))
        # First-come dealing leaves gaps of up to one item; differencing with many items a window far smaller ones.
        assert max(sums(sizes, got)) - min(sums(sizes, got)) <= 25


def test_windows_rise_until_all_fit():
    rng = random.Random(7)
    for _ in range(50):
        sizes = [rng.randint(1, 1023) for _ in range(rng.randint(0, 150))]
        found = packing.windows_of(sizes, 1024)
        assert sorted(i for w in found for i in w) == list(range(len(sizes)))
        assert all(n <= 1024 for n in sums(sizes, found))
        assert len(found) <= 1.4 * sum(sizes) / 1024 + 2
    assert packing.windows_of([1000] * 40, 1024) and len(packing.windows_of([1000] * 40, 1024)) == 40


def test_levelled_windows():
    rng = random.Random(8)
    for _ in range(100):
        sizes = [rng.randint(1, 1023) for _ in range(rng.randint(0, 60))]
        pieces = packing.level(sizes, packing.windows_of(sizes, 1024), 1024)
        held = [sum(hi - lo for _, lo, hi in w) for w in pieces]
        assert all(n == 1024 or n & (n - 1) == 0 for n in held) and sum(n < 1024 for n in held) <= 10
        cover = collections.defaultdict(list)
        for w in pieces:
            for i, lo, hi in w:
                assert lo < hi
                cover[i].append((lo, hi))
        for i, n in enumerate(sizes):
            at = 0
            for lo, hi in sorted(cover[i]):
                assert lo == at
                at = hi
            assert at == n
