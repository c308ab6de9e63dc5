"""Decontamination, token counts, mixing, toxicity, line dedup and the Jaccard join
beside plain Python, on small and awkward tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from rushline.llm import decontam, jaccard, lines, mixing, tokens, toxicity
from tests.llm import brute

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PIECES = sentencepiece.SentencePieceProcessor(model_file=MODEL)
DOCS = "doc_id long, text string, source string, found string, n_chars long, row string"


def make(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


# -- decontamination ---------------------------------------------------------

ITEMS = [(1, "Alpha, beta; gamma"), (2, " ".join(f"w{i}" for i in range(20))), (3, None), (4, "!!"),
         (None, "É x"), (1, "other words entirely"), (30, " ".join(f"w{i}" for i in range(5, 20)))]
HIT_TEXTS = [
    None, "", "...", "ALPHA beta\ngamma!", "x alpha beta gamma beta alpha beta gamma y",
    "pre " + " ".join(f"W{i}" for i in range(2, 17)) + " post", " ".join(f"w{i}" for i in range(12)),
    "É x é x", "alpha beta gamma " + "filler " * 60, "😀 alpha-beta:gamma 😀",
    ("lorem ipsum " * 30_000) + " ".join(f"w{i}" for i in range(20)),
]


@pytest.mark.parametrize("block_bytes", [10**9, 60])
def test_contamination_equals_brute_force(spark, block_bytes):
    docs = make(spark, [(i, t, "s", "clash", 1, "c") for i, t in enumerate(HIT_TEXTS)] + [
        (3, HIT_TEXTS[3], "s", None, None, None)])
    bench = make(spark, ITEMS, "item_id long, text string")
    rows = decontam.find(docs, bench, block_bytes=block_bytes, into="hits").select(
        "doc_id", "text", *decontam.digest(F.col("hits")), "hits.spans").collect()
    assert len(rows) == len(HIT_TEXTS) + 1
    for r in rows:
        expected = brute.contamination(r["text"], ITEMS)
        assert {k: r[k] for k in expected} == expected
        covered = [brute.BENCH_WORD.findall(r["text"][a:b].lower()) for a, b in r["spans"]]
        assert sum(map(len, covered)) == r["n_hit"]


def test_no_benchmark_and_no_documents(spark):
    bench = make(spark, [], "item_id long, text string")
    docs = make(spark, [(1, "a b", "s", "", 1, "")])
    assert decontam.find(docs, bench).select("found.n_hit").first()[0] == 0
    assert decontam.find(docs.limit(0), bench).count() == 0


# -- token counts -------------------------------------------------------------

def test_token_counts_equal_the_library(spark):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "the", "é", "ß", "日本", "▁", "<s>", "</s>", "<unk>", "\r",
             " ", "　", "x1", "🙂", "\x00", "<0x0A>", "Ａ", "²", "worthless", "."]
    texts = [None, "", " ", "\n", "▁", "a" * 5000, "word " * 20_000] + [
        "".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    docs = make(spark, [(i, t, "s", "", 1, "") for i, t in enumerate(texts)])
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in tokens.count_tokens(docs, MODEL).collect():
        text = texts[r["doc_id"]] or ""
        assert r["n_tokens"] == len(model.encode(text)), text
        assert r["n_bytes"] == len(text.encode()) and r["over_limit"] == (r["n_tokens"] > 4096)
    assert tokens.count_tokens(docs.limit(0), MODEL).count() == 0


def test_cache_starts_anew_and_counts_stay_right(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 10)
    lengths = tokens.PieceLengths(MODEL, {" the": 1})
    texts = [f"the word{i} and word{i % 7}" for i in range(200)]
    assert [lengths.count(t) for t in texts] == [len(lengths.model.encode(t)) for t in texts]
    assert len(lengths) <= 11 and lengths.additive


def held_tables(spark):
    """Sizes of the first tier in every worker that has one, and of its query's names."""
    def look(batches):
        for _ in batches:
            yield pd.DataFrame({"size": [len(x.frequent) for x in tokens._WORKER.values()]}, dtype="int64")

    return {r["size"] for r in spark.range(64).repartition(16).mapInPandas(look, "size long").collect()}


def test_first_tier_is_that_of_the_query(spark):
    """Reused workers look up in the table of the query they run, not in an earlier one's."""
    for words in (30, 170):
        rows = [(i, " ".join(f"t{words}x{(i + j) % words}" for j in range(40)), "s", "", 1, "")
                for i in range(400)]
        docs = make(spark, rows).repartition(8)
        table = tokens.frequent_lengths(docs, MODEL)
        assert len(table) == words
        assert tokens.count_tokens(docs, MODEL).agg(F.sum("n_tokens")).first()[0] == sum(
            len(PIECES.encode(r[1])) for r in rows)
        assert held_tables(spark) == {words}


def test_first_tier_samples_every_partition(spark, monkeypatch):
    monkeypatch.setattr(tokens, "SAMPLE_ROWS", 100)
    rows = [(i, f"part{i // 250} common", "s", "", 1, "") for i in range(1000)]
    docs = make(spark, rows).repartition(8, "text")
    assert {f" part{k}" for k in range(4)} < set(tokens.frequent_lengths(docs, MODEL))
    assert tokens.frequent_lengths(docs.limit(0), MODEL) == {}


# -- mixing --------------------------------------------------------------------

def mix_rows(rng):
    rows = []
    for source, n in (("a", 400), ("b", 100), ("c", 40), ("é", 300), (None, 200), ("d", 1)):
        for _ in range(n):
            rows.append((len(rows), "w " * int(rng.lognormvariate(4, 1)), source, "", 1, ""))
    return rows + [(9000, None, "a", "", 1, ""), (9001, "", "empty", "", 1, "")] + rows[:5]


def test_mix_meets_the_targets(spark):
    rows = mix_rows(random.Random(5))
    got = mixing.mixed_sizes(make(spark, rows), (5, 2, 1)).collect()
    sizes, taken = Counter(), Counter()
    source = {r[0]: r[2] for r in rows}
    for r in got:
        assert 0 <= r["copies"] <= 3
        sizes[source[r["doc_id"]]] += r["size"]
        taken[source[r["doc_id"]]] += r["size"] * r["copies"]
    expected = brute.targets(sizes)
    for r in got:
        name = source[r["doc_id"]]
        assert r["target"] == pytest.approx(expected[name]) and r["source_size"] == sizes[name]
    for name, n in Counter(source.values()).items():
        if n >= 40:
            assert taken[name] == pytest.approx(expected[name], rel=0.01)
    assert len(got) == len(rows)


def test_mix_reruns_agree_and_keep_the_columns(spark):
    docs = make(spark, mix_rows(random.Random(6)))
    first = mixing.with_copies(docs, (5, 2, 1))
    again = mixing.with_copies(docs.repartition(7), (5, 2, 1))
    assert first.columns == [*docs.columns, "mix"]
    counted = [Counter((r["doc_id"], r["mix"]["copies"]) for r in x.collect()) for x in (first, again)]
    small = Counter((r["doc_id"], r["copies"]) for r in mixing.mixed_sizes(docs, (5, 2, 1)).collect())
    assert counted[0] == counted[1] == small
    assert mixing.mixed_sizes(docs.limit(0), (5, 2, 1)).count() == 0


def test_newton_balances_two_families_with_priors(spark):
    """Token shares by source and by language at once, documents with priors."""
    rng = np.random.default_rng(1)
    cells = [(s, g, float(p), int(t)) for s in "ab" for g in "xy"
             for p, t in zip(rng.uniform(0.5, 2, 4), rng.integers(100, 900, 4))]
    total = sum(c[3] for c in cells)
    frame = spark.createDataFrame(cells, "g0 string, g1 string, prior double, tokens long")
    wanted = [{"a": 0.6 * total, "b": 0.4 * total}, {"x": 0.55 * total, "y": 0.45 * total}]
    tables = [spark.createDataFrame(list(w.items()), "group string, target double") for w in wanted]
    found = mixing.newton(frame, tables, mixing.Balance(iterations=30, tolerance=1e-7))
    m = [{r["group"]: r["multiplier"] for r in f.collect()} for f in found]
    got = [Counter(), Counter()]
    for s, g, p, t in cells:
        rate = min(3.0, p * np.exp(m[0][s] + m[1][g]))
        got[0][s] += rate * t
        got[1][g] += rate * t
    for family in (0, 1):
        for name, target in wanted[family].items():
            assert got[family][name] == pytest.approx(target, rel=1e-3)


# -- toxicity ------------------------------------------------------------------

def test_pu_learning_on_held_out_rows(spark):
    rng = random.Random(2)
    bad = ["gribble", "zonk", "flarp"]
    rows, labels = [], []
    for i in range(1500):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(5, 60))]
        toxic = i % 8 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad).upper()
        rows.append((i, " ".join(words), "s", "", 1, ""))
        if i % 16 < 10:
            labels.append((i, int(toxic), "clash"))
    rows += [(5000, None, "s", "", 1, ""), (5001, "", "s", "", 1, ""), (None, "w1", "s", "", 1, "")]
    labels += [(0, 1, ""), (0, 1, ""), (None, 1, ""), (7, None, "")]
    docs = make(spark, rows)
    frame = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    model = toxicity.train(docs, frame)
    assert model == toxicity.train(docs.repartition(5), frame)
    scored = docs.select("doc_id", toxicity.is_held_out(F.col("doc_id")).alias("h"),
                         toxicity.score(docs, model).alias("score")).collect()
    assert all(0 <= r["score"] <= 1 for r in scored) and len(scored) == len(rows)
    held = [r for r in scored if r["h"] and r["doc_id"] < 1500]
    right = sum((r["score"] >= 0.3) == (r["doc_id"] % 8 == 0) for r in held)
    assert len(held) > 300 and right / len(held) > 0.97
    assert all(r["score"] < 0.3 for r in scored if r["doc_id"] in (5000, 5001))


def test_without_positives_nothing_is_toxic(spark):
    docs = make(spark, [(1, "a b", "s", "", 1, "")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train(docs, none) is None
    assert docs.select(toxicity.score(docs, None).alias("s")).first()["s"] == 0.0


def test_the_negative_risk_is_not_driven_below_zero():
    """Without the correction, positives learnt by heart make clean texts of the
    same vocabulary look negative without bound; scores must stay near the prior."""
    rng = random.Random(1)
    texts = [sorted({rng.randrange(50) for _ in range(8)}) for _ in range(200)]
    positive = np.array([i < 40 for i in range(200)])
    weights = toxicity.nnpu_fit(texts, positive, 50, 0.2, toxicity.Training(steps=200))
    sums = np.array([weights[t].sum() for t in texts])
    logits = sums[40:] + toxicity.prior_bias(sums[40:], np.ones(160), 0.2)
    assert -8 < np.mean(logits) < 2
    assert toxicity.nnpu_fit(texts, np.ones(200, bool), 50, 0.2, toxicity.Training()) is None


def dense_risk(weight, bias, matrix, positive, prior):
    """The risk from a dense matrix, term by term."""
    z = matrix @ weight + bias
    as_positive, as_negative = np.log1p(np.exp(-z)), np.log1p(np.exp(z))
    bracket = as_negative[~positive].mean() - prior * as_negative[positive].mean()
    return prior * as_positive[positive].mean() + max(0.0, bracket), bracket


@pytest.mark.parametrize("scale", [0.3, 6.0])
def test_risk_and_gradient_equal_a_dense_version(scale):
    rng = np.random.default_rng(int(scale * 10))
    matrix = (rng.random((60, 9)) < 0.3).astype(float)
    positive = rng.random(60) < 0.4
    matrix[positive, 0] = 1
    row, column = np.nonzero(matrix)
    weight, bias, prior = rng.normal(size=9) * scale, -0.5, 0.45
    weight[0] = scale
    shares = positive / positive.sum(), ~positive / (~positive).sum()

    def ours(w, b):
        return toxicity.risk_and_slope(w, b, row, column, 60, *shares, prior)

    risk, slope = ours(weight, bias)
    wanted, bracket = dense_risk(weight, bias, matrix, positive, prior)
    assert risk == pytest.approx(wanted)
    step = 1e-6
    for i in range(10):
        move = np.eye(10)[i] * step
        up, down = (dense_risk(weight + m[:9], bias + m[9], matrix, positive, prior) for m in (move, -move))
        # where the bracket is below zero, the slope leads out of it, not down the risk
        numeric = (up[0] - down[0] if bracket >= 0 else down[1] - up[1]) / (2 * step)
        assert slope[i] == pytest.approx(numeric, abs=1e-5)


def plain_slots(text):
    """The slots of a text, one feature and one byte after the other."""
    def mixed(x):
        x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 % (1 << 64)
        return (x ^ x >> 29) >> 64 - toxicity.SLOT_BITS

    out = set()
    for word in set(re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())):
        power, whole, part = 1, 0, 0
        for k, byte in enumerate(word):
            power = power * 0x9E3779B97F4A7C15 % (1 << 64)
            whole += (byte + 1) * power
            if k < 8:
                part = (part ^ byte + 1) * 0xD6E8FEB86659FD93 % (1 << 64)
                part ^= part >> 32
                if k + 1 in toxicity.PREFIXES and len(word) > k + 1:
                    out.add(mixed((part + k) % (1 << 64)))
        out.add(mixed(whole % (1 << 64)))
    return sorted(out)


def test_slots_of_whole_texts():
    texts = ["One two ONE", "", " \n", "Éa éa x9", "l" * 5, "longword " * 3000 + "end", None, "a" * 300_000]
    text, slot = toxicity.text_slots([(t or "").encode() for t in texts])
    for i, t in enumerate(texts):
        assert slot[text == i].tolist() == plain_slots(t)
    keep = np.array(plain_slots("one longword end"))
    lists = toxicity.slot_lists(texts, keep)
    assert [keep[x].tolist() for x in lists] == [
        [s for s in plain_slots(t) if s in set(keep.tolist())] for t in texts]
    assert toxicity.slot_lists([], keep) == []


def test_vocabulary_counts_every_training_text(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK_BYTES", 500)
    rng = random.Random(4)
    rows = [(i % 5 == 0, " ".join(f"w{int(rng.random() ** 2 * 60)}" for _ in range(30)) + " bad" * (i % 5 == 0))
            for i in range(400)]
    positive = defaultdict(int)
    every = defaultdict(int)
    for flag, text in rows:
        for s in plain_slots(text):
            every[s] += 1
            positive[s] += flag
    settings = toxicity.Training(vocabulary=20, min_contrast=1.0)
    strength = {s: abs(toxicity.contrast(positive[s], n, 80, 400)) for s, n in every.items()}
    wanted = sorted((-z, s) for s, z in strength.items() if z >= 1.0 and every[s] + positive[s] >= 3)[:20]
    df = spark.createDataFrame(rows, "positive boolean, text string").select(
        "positive", F.col("text").cast("binary").alias("text")).repartition(5)
    assert toxicity.vocabulary_of(df, 80, 400, settings) == sorted(s for _, s in wanted)


def test_few_positives_and_lean_sample(spark):
    """One to three positives among 400 texts: parts without one do not count."""
    for n in (1, 2, 3):
        rows = [(i, f"zonk w{i % 7} w{i % 11}" if i < n * 4 else f"w{i % 7} w{i % 11}", "s", "", 1, "")
                for i in range(400)]
        ids = [i for i in range(n * 4) if zlib.crc32(str(i).encode()) % 4 != 2][:n]
        labels = [(i, 1) for i in ids] + [(i, 0) for i in range(20, 400) if i % 2]
        docs, frame = make(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
        model = toxicity.train(docs, frame)
        assert model is not None and -15 < model.bias < 5
        known, _ = toxicity.training_rows(docs, frame, toxicity.Training())
        lean = toxicity.fit_rows(known, [1, 2], toxicity.Training())
        assert lean.columns == ["part", "doc_id", "positive", "words"]
        assert lean.schema["words"].dataType.simpleString() == "array<int>"


# -- line dedup -----------------------------------------------------------------

def linked(a, b):
    """Whether two texts are equal or share 85 % of their 4-word shingles."""
    def shingles(text):
        w = brute.WORD.findall(brute.lower(text))
        return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} - {()}

    x, y = shingles(a), shingles(b)
    return a == b or bool(x and y) and 100 * len(x & y) >= 85 * len(x | y)


def plain_lines(rows, rule):
    def trimmed(line):
        return line.strip(" \t\n\x0b\x0c\r")

    places, words = defaultdict(set), {}
    for _, text, site, *_ in rows:
        for line in (text or "").split("\n"):
            if brute.WORD.search(line):
                key = trimmed(line)
                words[key] = len(brute.WORD.findall(key))
                places[key].add(text if words[key] >= rule.long_words else site)
    least = max(rule.least, -(-len({r[2] for r in rows}) * rule.percent // 100))
    common = {k for k, s in places.items() if len(s) >= least}
    marked = []
    for doc, text, *_ in rows:
        parts = (text or "").split("\n")
        hit = [i for i, x in enumerate(parts) if trimmed(x) in common]
        share = sum(words[trimmed(parts[i])] for i in hit)
        marked.append((doc, text, parts, hit, 100 * share > rule.mostly_percent * len(
            brute.WORD.findall(text or ""))))
    out = []
    for at, (doc, text, parts, hit, mostly) in enumerate(marked):
        copy = mostly and any(
            m and k != at and linked(text, t) for k, (_, t, _, _, m) in enumerate(marked))
        gone = [] if copy else hit
        kept = "\n".join(x for i, x in enumerate(parts) if i not in gone)
        out.append((repr(doc), None if text is None else kept, len(hit), len(gone)))
    return sorted(out, key=repr)


def cleaned(spark, rows, rule=lines.Spread()):
    got = lines.clean(make(spark, rows), F.col("source"), rule, into="done").collect()
    return got, sorted(((repr(r["doc_id"]), r["text"], r["done"]["n_flagged"], r["done"]["n_removed"])
                        for r in got), key=repr)


def test_lines_equal_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        body = [f"own line {i} {k} of some length" for k in range(rng.randint(0, 6))]
        body += [f"  shared {rng.randrange(12)} menu \t" for _ in range(rng.randint(0, 3))] + ["", " \r"]
        rng.shuffle(body)
        rows.append((i, "\n".join(body), f"site{rng.randrange(6)}", "x", 7, "y"))
    rows += [(400, None, None, "", None, ""), (401, "", "s", "", 0, ""), rows[3], rows[3],
             (402, "shared 1 menu", "new", "", 13, ""), (None, "shared 1 menu\nown words here now", None, "", 1, ""),
             (403, "shared 2 menu\n" + "very long " * 60_000, "s", "", 1, "")]
    for rule in (lines.Spread(), lines.Spread(percent=60), lines.Spread(least=7, percent=1)):
        got, found = cleaned(spark, rows, rule)
        assert found == plain_lines(rows, rule)
        for r in got:
            assert r["found"] in ("x", "") and (r["done"]["n_removed"] == 0 or r["n_chars"] == len(r["text"]))


def test_far_above_the_band_needs_no_exact_count(spark):
    rows = [(i, f"everywhere in all places\nonly here {i} and some more words", f"s{i % 40}", "", 1, "")
            for i in range(120)]
    got, _ = cleaned(spark, rows, lines.Spread(percent=1))
    assert all(r["done"]["n_removed"] == 1 for r in got)


def test_the_threshold_follows_the_corpus(spark):
    """A line on 8 of 16 sites goes, on 8 of 40 it stays."""
    for sites, gone in ((16, 1), (40, 0)):
        rows = [(i, (f"menu home about\n" if i < 8 else "") + f"text {i} of one site only", f"s{i}", "", 1, "")
                for i in range(sites)]
        got, found = cleaned(spark, rows)
        assert found == plain_lines(rows, lines.Spread())
        assert {r["done"]["n_removed"] for r in got if r["doc_id"] < 8} == {gone}


def test_a_long_passage_goes_from_texts_that_are_no_copies(spark):
    """60 of 90 words are a shared passage, on one hot site as on many."""
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(i, passage + "\n" + " ".join(f"own{i}x{j}" for j in range(30)), "hot", "", 1, "") for i in range(9)]
    rows += [(100 + i, f"other text {i} " * 9, f"s{i}", "", 1, "") for i in range(12)]
    got, found = cleaned(spark, rows)
    assert found == plain_lines(rows, lines.Spread())
    assert all(r["text"].startswith("own") and r["done"]["n_removed"] == 1 for r in got if r["doc_id"] < 9)
    # the same passage in equal copies of one text counts once
    rows = [(i, rows[0][1], f"s{i}", "", 1, "") for i in range(9)] + rows[9:]
    assert {r["done"]["n_flagged"] for r in cleaned(spark, rows)[0] if r["doc_id"] < 9} == {1}


def test_only_copies_keep_widespread_lines(spark):
    shared = "one widely shared passage " + " ".join(f"p{k}" for k in range(50))
    story = [f"story {k} " + " ".join(f"s{k}x{j}" for j in range(30)) for k in range(8)]
    own = {i: " ".join(f"own{i}x{j}" for j in range(30)) for i in [*range(6), None]}
    rows = [(i, f"{shared}\n{own[i]}", f"s{i}", "", 1, "") for i in range(6)]
    # Copies of a whole text on as many sites, one line of each edited.
    rows += [(100 + i, "\n".join([*story, f"edited {i}"]), f"s{i}", "", 1, "") for i in range(6)]
    rows += [(200, shared, "s0", "", 1, ""), (None, f"{shared}\n{own[None]}", None, "", 1, "")]
    got, found = cleaned(spark, rows)
    assert found == plain_lines(rows, lines.Spread())
    for r in got:
        i = r["doc_id"]
        if i is None or i < 6:
            assert (r["text"], r["done"]["n_removed"]) == (own[i], 1)
        elif i < 200:
            assert r["text"] == rows[6 + i - 100][1]
        else:
            assert (r["text"], r["done"]["n_removed"]) == ("", 1)


# -- Jaccard join -----------------------------------------------------------------

def near_copies(rng, n_words, groups):
    rows = [None, "", " \n", "one", "One", "one two", "two one", "a b c d", "A b\tc d", "a b c d e"]
    for size in groups:
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(*n_words))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 30))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(copy))
    return rows


@pytest.mark.parametrize("seed, rule", [
    (1, jaccard.Join()), (2, jaccard.Join(sample_part=1, min_frequent=2)),
    (3, jaccard.Join(sample_part=1, min_frequent=2, most_combined=3, block=4)),
    (4, jaccard.Join(sample_part=2, slot_bits=4, pivots=1, block=8)),
])
def test_components_equal_brute_force(spark, seed, rule):
    rng = random.Random(seed)
    shared = " ".join(f"c{i}" for i in range(30))
    texts = near_copies(rng, (8, 80), [1] * 30 + [2] * 20 + [5] * 6 + [30, 40])
    texts += [f"{shared} {' '.join(f'u{rng.randrange(10**6)}' for _ in range(rng.randint(0, 12)))}"
              for _ in range(40)]
    texts += texts[20:30] + [texts[40]] * 30
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i, texts[k], "s", "", 1, "") for i, k in enumerate(order)]
    expected = brute.components([brute.shingles(r[1]) for r in rows])
    got = {r["doc_id"]: r for r in jaccard.classes(make(spark, rows), rule).collect()}
    assert len(got) == len(rows)
    for i, row in enumerate(rows):
        assert got[i]["component_id"] == expected[i], row
        assert got[i]["n_shingles"] == len(brute.shingles(row[1]))


def test_levels_count_every_set(spark):
    """64 sets with a shingle make its slot frequent, 63 do not: none is left out."""
    rule = jaccard.Join()
    many, few = "a shingle of many", "a shingle of few"
    rows = [(i, f"{many if i < 64 else few} w{i}", "s", "", 1, "") for i in range(127)]
    rows += [(1000 + i, f"{few} w126", "s", "", 1, "") for i in range(3)] + [(None, None, "s", "", 1, "")]
    made = jaccard.sets_of(make(spark, rows).coalesce(3), rule)
    levels = jaccard.frequency_levels(made.where("slice is not null").select("slice", "counts"), rule)
    slot = [int(jaccard.slots_of(jaccard.token_set(t, 4), rule)[0]) for t in (many, few)]
    assert levels[slot].tolist() == [1, 0] and levels.sum() == 1
    assert made.where("n is not null").count() == len(rows)


def test_cross_blocks_find_every_pair(spark):
    """One bucket larger than a block, with a large component and a rest."""
    rule = jaccard.Join(block=4)
    tokens_of = [np.arange(100 * (i // 3), 100 * (i // 3) + 40, dtype=np.uint64) for i in range(30)]
    tokens_of = [np.unique(np.append(t[:-1], np.uint64(10**6 + i))) for i, t in enumerate(tokens_of)]
    members = spark.createDataFrame(
        [(7, i, 40, 99, 40) for i in range(30)], "bucket long, id long, n long, pivot long, pivot_n long")
    parts = spark.createDataFrame([(i, 0) for i in range(0, 12)], "id long, component long")
    maps = spark.createDataFrame(
        [(i, 40, bytearray(jaccard.parity_bitmap(t))) for i, t in enumerate(tokens_of)],
        "key long, n long, bitmap binary")
    found = {(r["a"], r["b"]) for r in jaccard.cross_pairs(members, parts, maps, rule).collect()}
    wanted = {(i, j) for i in range(30) for j in range(i + 1, 30)
              if i // 3 == j // 3 and not (i < 12 and j < 12)}
    assert wanted <= found


def test_bitmap_bound_is_never_above_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9],
                                      rng.integers(0, 2**63, 20).astype(np.uint64)]))
        exact = len(np.setxor1d(a, b))
        assert jaccard.least_difference(jaccard.parity_bitmap(a), jaccard.parity_bitmap(b)) <= exact


def test_one_row_stays_of_each_component(spark):
    rng = random.Random(9)
    texts = near_copies(rng, (20, 60), [1, 1, 2, 6, 12])
    rows = [(i, t, "s", "", 1, "") for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], rows[0], (None, texts[15], "s", "", 1, "")]
    kept = jaccard.one_per_component(make(spark, rows))
    assert kept.columns == DOCS.replace(",", "").split()[::2]
    got = [r["doc_id"] for r in kept.collect()]
    first = brute.components([brute.shingles(t) for t in texts])
    wanted = sorted([i for i, t in enumerate(texts) if not (t or "").split()] + [0] + sorted(
        {c for c, t in zip(first, texts) if (t or "").split()}))
    assert sorted(got) == wanted


def test_empty_tables(spark):
    none = make(spark, [])
    assert jaccard.classes(none).count() == 0
    assert lines.clean(none, F.col("source")).count() == 0
