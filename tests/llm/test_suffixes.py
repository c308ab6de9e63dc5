"""Removal of repeated strings beside a plain version."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rushline.llm import suffixes
from rushline.llm.common import table

L = suffixes.LENGTH


def plain(rows):
    """rows: (key, text) -> (key, n_bytes, spans, sha256), sorted."""
    texts = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(t[p:p + L] for _, t in texts for p in range(len(t) - L + 1))
    out = []
    for k, t in texts:
        gone = bytearray(len(t) + 1)
        for p in range(len(t) - L + 1):
            if seen[t[p:p + L]] > 1:
                gone[p:p + L] = b"\1" * L
        edges = np.flatnonzero(np.diff(np.frombuffer(bytes(gone), np.int8), prepend=0)).tolist()
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((k, len(t), list(zip(edges[::2], edges[1::2])), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df, **options):
    rows = suffixes.repeated_strings(df, **options).collect()
    for r in rows:
        if r["kept"] is not None:
            assert hashlib.sha256(r["kept"]).hexdigest() == r["sha256"]
            assert len(r["kept"]) + sum(s["end"] - s["start"] for s in r["spans"]) == r["n_bytes"]
        else:
            assert not r["spans"]
    return sorted(((r["key"], r["n_bytes"], [tuple(s) for s in r["spans"]], r["sha256"])
                   for r in rows), key=repr)


def made(spark, rows):
    extra = [(*r, "clash", "clash", "clash", "clash") for r in rows]
    return spark.createDataFrame(
        extra, "doc_id long, text string, page string, bits string, key string, spans string")


def prose(rng, n):
    return "".join(rng.choice("abcdefgh ,.éß") for _ in range(n))


@pytest.fixture
def small_pages(monkeypatch):
    monkeypatch.setattr(suffixes, "PAGE_BYTES", 5000)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 3000)


def test_cover():
    """Every difference of the cover stands once; the block lies in every string."""
    differences = Counter((int(a) - int(b)) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER)
    assert all(differences[x] == 1 for x in range(1, suffixes.PERIOD))
    assert suffixes.PERIOD - 1 + suffixes.BLOCK == L


def test_special_cases(spark, small_pages):
    rng = random.Random(1)
    shared, other = prose(rng, 900), prose(rng, 1300)
    ascii_ = "".join(rng.choice("abcdefgh ") for _ in range(400))
    rows = [(1, None), (2, ""), (None, "short"), (3, "x" * L), (4, "y" * (L + 1)), (5, "y" * 399)]
    rows += [(6, shared), (6, shared), (7, shared), (8, prose(rng, 77) + shared + prose(rng, 700))]
    # exactly 400 and 399 bytes in common, at many shifts
    rows += [(20 + i, prose(rng, i * 7) + ascii_ + prose(rng, i)) for i in range(9)]
    almost = "".join(rng.choice("abcdefgh ") for _ in range(399))
    rows += [(40, "1" + almost + "2" + prose(rng, 500)), (41, "3" + almost + "4" + prose(rng, 500))]
    # a repeat within one document, overlapping itself, and edits of one byte
    rows += [(50, "ab" * 900), (51, other + other[:650] + "!" + other[100:])]
    rows += [(60 + i, other[:i * 90] + "#" + other[i * 90:]) for i in range(14)]
    rows += [(90, prose(rng, 30_000) + shared[200:700] + prose(rng, 9000))]
    df = made(spark, rows).repartition(4)
    assert found(df) == plain(rows)
    # two cuts meet at the end of one document and the start of the next
    rows = [(1, shared), (2, shared), (3, other), (4, other)]
    assert found(made(spark, rows).coalesce(1)) == plain(rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_copies(spark, small_pages, seed):
    rng = random.Random(seed)
    passages = [prose(rng, rng.randint(300, 2500)) for _ in range(12)]
    rows = []
    for i in range(160):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, 300) if rng.random() < .5 else 0
            p = p[a:len(p) - (rng.randint(0, 300) if rng.random() < .5 else 0)]
            if rng.random() < .3 and len(p) > 10:
                x = rng.randrange(len(p))
                p = p[:x] + rng.choice("ZQ") + p[x + rng.randint(0, 2):]
            parts += [p, prose(rng, rng.choice([0, 0, 5, 600]))]
        rows.append((i, "".join(parts)))
    rows += rows[:20] * 3
    assert found(made(spark, rows).repartition(3)) == plain(rows)


def test_hot_passage(spark, small_pages):
    """A passage in a third of all documents; every bucket gets it once a page."""
    rng = random.Random(9)
    hot = prose(rng, 600)
    rows = [(i, hot + prose(rng, 50) if i % 3 == 0 else prose(rng, 700)) for i in range(600)]
    assert found(made(spark, rows)) == plain(rows)


def test_empty_table(spark):
    assert found(made(spark, [])) == []


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert found(docs) == plain(rows)
