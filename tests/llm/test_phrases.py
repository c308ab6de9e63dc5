"""Phrase mining beside a plain version."""

import re
from collections import Counter

import pytest

from rushline.llm import phrases
from rushline.llm.common import table

SCHEMA = "text string, lang string, w1 string, n string, slice string"


def plain(rows, at_least, most=2000, scale=2000000, inside=80):
    f, n = Counter(), Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for i in range(len(w)):
                for k in range(1, min(4, len(w) - i) + 1):
                    f[lang or "und", tuple(w[i:i + k])] += 1
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= at_least}
    gone = {(lang, w[i:i + k]) for (lang, w), a in found.items() for k in range(2, len(w))
            for i in range(len(w) - k + 1) if 100 * a >= inside * f[lang, w[i:i + k]]}
    out = []
    for (lang, w), a in found.items():
        if (lang, w) not in gone:
            score, k = min((scale * a // (f[lang, w[:k]] + f[lang, w[k:]]), k)
                           for k in range(1, len(w)))
            out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], k))
    rows = []
    for lang in n:
        best = sorted(o for o in out if o[0] == lang)[:most]
        rows += [(lang, i, p.decode(), -a, l, r, n[lang], -s, k)
                 for i, (_, s, a, p, l, r, k) in enumerate(best, 1)]
    return sorted(rows)


def mined(spark, rows, **options):
    extra = [(*r, "clash", "clash", "clash") for r in rows]
    df = spark.createDataFrame(extra, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def test_small_table_with_every_special_case(spark):
    rows = [
        ("One two three four five. ONE two three,four", "en"), (None, "en"), ("", "en"),
        ("one two\tthree  four\x0bfive six", None), ("one two", "und"), (" \t ", "de"),
        ("É é É é É é", "fr"), ("a b a b a b a b a b", "en"), ("a b a b a b a b a b", "en"),
        ("x\xa0y z x\xa0y z ; - - - -", None), ("w " * 5000, "en"), ("one two three four", "en"),
    ]
    for at_least in (1, 2, 3):
        assert mined(spark, rows, at_least=at_least) == plain(rows, at_least)
    assert mined(spark, rows, at_least=2, most=3) == plain(rows, 2, 3)
    assert mined(spark, rows, at_least=1, inside_percent=30) == plain(rows, 1, inside=30)


def test_chunks_do_not_change_counts(spark, monkeypatch):
    rows = [(f"the red fox {i % 3} saw the red dog {i % 5}", "en") for i in range(200)]
    assert mined(spark, rows, at_least=20) == plain(rows, 20)
    assert mined(spark, rows, at_least=300) == plain(rows, 300)  # beyond one byte


def test_empty_table(spark):
    assert mined(spark, []) == []


def test_exact_beyond_64_bits(spark):
    """The products of score and containment are decimals."""
    df = spark.createDataFrame([("a b", "en")] * 40, "text string, lang string")
    scale = 9_000_000_000
    (row,) = phrases.collocations(df, scale=scale).collect()
    assert row["score"] == scale * 40 // 80
    with pytest.raises(ValueError):
        phrases.collocations(df, at_least=0)


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    got = sorted(tuple(r) for r in phrases.collocations(docs).collect())
    assert got == plain(rows, 30)
    assert len(got) > 100
