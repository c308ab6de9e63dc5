"""Toxicity by non-negative positive-unlabelled learning.

Numpy classifiers are trained from confirmed toxic texts and unlabelled ones. The
risk of the negative class is that of the unlabelled texts less the class prior's
share of the positive ones, and never below zero, so memorising the positives
does not pay.

Features are words and beginnings of words, hashed into a fixed number of slots.
Every training text is counted, by class, in tables of that size in the map tasks;
the vocabulary is the slots whose shares differ most. Only then is a bounded sample
taken: rows of vocabulary numbers, no text, in three overlapping parts, of which one
Spark task each fits a classifier. Their mean scores every whole text, with the bias
at which all training texts together score the class prior.

Defined results: NULL and empty texts have no words and get the score of the
bias; a NULL label is no label, a document labelled more than once is positive if
any label is 1; a NULL id is never trained on; repeated rows score alike; very long
texts are worked through whole, in pieces of whole documents; without a positive
text, or without rows, every score is 0, and a part without a positive is left out.
Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rushline.llm.common import ship_package, stored

#: Lengths, in bytes, of the beginnings of words that are features.
PREFIXES = (4, 5, 6, 7, 8)
#: Features are hashed into 2^22 slots, whatever the size of the corpus.
SLOT_BITS = 22
SLICES = 32
#: Bytes of text worked through at once.
CHUNK_BYTES = 1 << 20
#: Width and bound of the buckets of logits that the bias is taken from.
LOGIT_STEP, LOGIT_BOUND = 1 / 64, 60
FOLDS = 4
HELD_OUT_FOLD = 2
#: Scores from here on are predicted toxic.
REJECTED_FROM = 0.3

#: Word bytes of lower-cased text: digits, letters and all beyond ASCII.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*b"0123456789", *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


@dataclass(frozen=True)
class Training:
    """Bounds of the sample, expected rows, and the settings of a fit."""

    positives: int = 4000
    unlabelled: int = 8000
    parts: int = 3
    vocabulary: int = 2000
    min_texts: int = 3
    #: Least two-proportion statistic of a slot, in standard deviations.
    min_contrast: float = 4.0
    steps: int = 300
    rate: float = 0.1
    ridge: float = 3e-5
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Weights of slots, ascending, and the bias of a linear classifier."""

    slots: tuple[int, ...]
    weights: tuple[float, ...]
    bias: float


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == HELD_OUT_FOLD, F.lit(False))


# --------------------------------------------------------------------------
# Features
# --------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def word_slots(words: pa.LargeBinaryArray) -> np.ndarray:
    """Slots of the features of some words: a row a word, -1 where it has fewer.

    First the word itself, then its beginnings, which inflected words share. All
    are hashed column by column; two different hashes keep words and beginnings apart.
    """
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[:offsets[-1]].astype(np.uint64)
    starts, sizes = offsets[:-1], np.diff(offsets)
    powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(offsets[0], offsets[-1]) - np.repeat(starts, sizes)
    whole = np.add.reduceat((data[offsets[0]:] + np.uint64(1)) * powers[place], starts - offsets[0])
    columns = [_mixed(whole)]
    part = np.zeros(len(words), np.uint64)
    missing = np.zeros((len(words), 1 + len(PREFIXES)), bool)
    for k in range(max(PREFIXES)):
        byte = data[np.minimum(starts + k, len(data) - 1)]
        part = (part ^ (byte + np.uint64(1))) * np.uint64(0xD6E8FEB86659FD93)
        part ^= part >> np.uint64(32)
        if k + 1 in PREFIXES:
            missing[:, len(columns)] = sizes <= k + 1
            columns.append(_mixed(part + np.uint64(k)))
    slots = (np.stack(columns, 1) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    slots[missing] = -1
    return slots


def text_slots(texts: Sequence[bytes], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) pairs, each once, in order; with ``keep`` only its slots, as places in it."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = _INSIDE[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts),
        [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw[inside]])]).dictionary_encode()
    slots, word = word_slots(coded.dictionary), coded.indices.to_numpy()
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    if keep is not None:
        place = np.searchsorted(keep, slots)
        known = keep[np.minimum(place, len(keep) - 1)] == slots if len(keep) else np.zeros(slots.shape, bool)
        slots = np.where(known, place, -1)
        some = known.any(1)[word]
        text, word = text[some], word[some]
    text, word = np.divmod(np.unique(text * len(slots) + word), len(slots))
    found = slots[word]
    there = found >= 0
    both = np.unique((np.repeat(text, there.sum(1)) << SLOT_BITS) | found[there])
    return both >> SLOT_BITS, both & ((1 << SLOT_BITS) - 1)


def _chunks(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Whole texts, about CHUNK_BYTES of them at a time."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def slot_lists(texts: pd.Series, keep: np.ndarray) -> list[np.ndarray]:
    """For every text the places of its slots in ``keep`` (ascending), ascending."""
    out = []
    for chunk in _chunks(b"" if t is None else t.encode() for t in texts):
        text, place = text_slots(chunk, keep)
        out += np.split(place, np.searchsorted(text, np.arange(1, len(chunk))))
    return out


def contrast(in_positive, in_unlabelled, n_positive: int, n_unlabelled: int):
    """Signed root of the two-proportion statistic of a slot."""
    p, u = (in_positive + 0.5) / (n_positive + 1), (in_unlabelled + 0.5) / (n_unlabelled + 1)
    mean = (in_positive + in_unlabelled + 1) / (n_positive + n_unlabelled + 2)
    return (p - u) / np.sqrt(mean * (1 - mean) * (1 / n_positive + 1 / n_unlabelled))


def vocabulary_of(rows: DataFrame, n_positive: int, n_unlabelled: int, settings: Training) -> list[int]:
    """The slots of strongest contrast over all training rows (positive, text), ascending.

    A task counts into two tables of fixed size and sends what it found of each slice;
    slices are added up by tasks of their own, which let through only slots that may
    be in the vocabulary.
    """
    size = (1 << SLOT_BITS) // SLICES

    def count(batches):
        tables = np.zeros((2, 1 << SLOT_BITS), np.int32)

        def add(texts, flags):
            text, slot = text_slots(texts)
            for table, picked in zip(tables, (slice(None), np.array(flags, bool)[text])):
                found, n = np.unique(slot[picked], return_counts=True)
                table[found] += n.astype(np.int32)

        for batch in batches:
            flags = iter(batch.column(0).to_pylist())
            for chunk in _chunks(t.as_buffer().to_pybytes() for t in batch.column(1)):
                add(chunk, [next(flags) for _ in chunk])
        pack = zstandard.ZstdCompressor(level=1)
        for i in range(SLICES):
            part = np.ascontiguousarray(tables[:, i * size:(i + 1) * size])
            if part.any():
                yield pa.record_batch({"slice": pa.array([i], pa.int32()),
                                       "counts": pa.array([pack.compress(part.tobytes())])})

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i, counts in zip(*batch.to_pydict().values()):
                part = np.frombuffer(unpack.decompress(counts), np.int32).reshape(2, size)
                sums[i] = sums.get(i, 0) + part.astype(np.int64)
        for i, (unlabelled, positive) in sums.items():
            strength = np.abs(contrast(positive, unlabelled, n_positive, n_unlabelled))
            picked = np.flatnonzero(
                (strength >= settings.min_contrast) & (unlabelled + positive >= settings.min_texts))
            picked = picked[np.lexsort((picked, -strength[picked]))][:settings.vocabulary]
            yield pa.record_batch({"slot": pa.array(picked + i * size, pa.int64()),
                                   "strength": pa.array(strength[picked], pa.float64())})

    found = rows.mapInArrow(count, "slice int, counts binary").repartition(
        SLICES, "slice").mapInArrow(merge, "slot long, strength double")
    best = found.orderBy(F.desc("strength"), "slot").limit(settings.vocabulary).collect()
    return sorted(r["slot"] for r in best)


# --------------------------------------------------------------------------
# The sample
# --------------------------------------------------------------------------

def sampled(name: str, expected: int, rows: int, *by: Column) -> Column:
    """Whether a row is in a hash sample of so many expected rows."""
    share = min(1.0, expected / max(rows, 1))
    return F.pmod(F.xxhash64(F.lit(name), *by), F.lit(1 << 30)) < int(share * (1 << 30))


def training_rows(docs: DataFrame, labels: DataFrame, settings: Training) -> tuple[DataFrame, float]:
    """All training rows (doc_id, positive, unlabelled, text), and the class prior.

    ``positive`` marks confirmed positives of the bounded sample, ``unlabelled`` rows of
    the other sample. Held-out documents are in neither. The prior is the share of
    positives among the labelled training rows.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(
        ~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = stored(known, "toxic_labels")
    n_known, n_positive = known.agg(
        F.count(F.lit(1)), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0))).first()
    prior = n_positive / n_known if n_known else 0.0
    # At most the bounded sample of ids, which is why it may be broadcast.
    positives = known.where((F.col("toxic") == 1) & sampled(
        "positive", settings.positives, n_positive, F.col("doc_id"))).select(
        F.col("doc_id").alias("positive_id"))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.where(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    n_docs = docs.select("doc_id").count()
    return rows.join(
        F.broadcast(positives), F.col("doc_id") == F.col("positive_id"), "left").select(
        "doc_id", F.col("positive_id").isNotNull().alias("positive"),
        sampled("unlabelled", settings.unlabelled, n_docs, F.col("doc_id"), F.col("text"))
        .alias("unlabelled"), "text"), prior


def fit_rows(rows: DataFrame, vocabulary: Sequence[int], settings: Training) -> DataFrame:
    """(part, doc_id, positive, words) of the sample: numbers of the vocabulary, no text.

    Every row goes to all parts but one.
    """
    keep = np.array(vocabulary, np.int64)

    @F.pandas_udf("array<int>")
    def numbers(texts: pd.Series) -> pd.Series:
        return pd.Series(slot_lists(texts, keep))

    picked = rows.where("positive or unlabelled").withColumn("words", numbers("text"))
    # A sampled positive may also be an unlabelled row: both classes are drawn apart.
    roles = F.concat(
        F.when(F.col("positive"), F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")),
        F.when(F.col("unlabelled"), F.array(F.lit(False))).otherwise(
            F.array().cast("array<boolean>")))
    own = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(settings.parts))
    others = F.filter(F.array(*[F.lit(p) for p in range(settings.parts)]),
                      lambda p: (p != own) | F.lit(settings.parts == 1))
    return picked.select("doc_id", "words", roles.alias("roles"), others.alias("parts")).select(
        F.explode("parts").alias("part"), "doc_id", "words", "roles",
    ).select("part", "doc_id", F.explode("roles").alias("positive"), "words")


# --------------------------------------------------------------------------
# The fit
# --------------------------------------------------------------------------

def risk_and_slope(weight, bias, row, column, n_rows, share_p, share_u, prior):
    """The non-negative risk and its gradient by (weights, bias).

    The risk is prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the logistic loss.
    Where the bracket is negative its gradient is turned round, so the fit steps back
    from texts it has learnt by heart. Entry k says that text row[k] has feature column[k].
    """
    z = np.bincount(row, weights=weight[column], minlength=n_rows) + bias
    up = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))  # gradient of the loss against 0
    below = np.logaddexp(0, z)  # loss against 0
    negative_risk = (share_u * below).sum() - prior * (share_p * below).sum()
    if negative_risk >= 0:
        pull = prior * share_p * (up - 1) + share_u * up - prior * share_p * up
    else:
        pull = prior * share_p * up - share_u * up
    slope = np.append(np.bincount(column, weights=pull[row], minlength=len(weight)), pull.sum())
    risk = prior * (share_p * np.logaddexp(0, -z)).sum() + max(0.0, negative_risk)
    return risk, slope


def nnpu_fit(words: Sequence[Sequence[int]], positive: np.ndarray, size: int, prior: float,
             settings: Training) -> np.ndarray | None:
    """Weights of ``size`` features of one linear classifier, from the features each text has.

    None where either class has no text.
    """
    n_pos, n_unl = int(positive.sum()), int((~positive).sum())
    if not n_pos or not n_unl:
        return None
    length = np.array([len(w) for w in words])
    column = np.concatenate([np.asarray(w, np.int64) for w in words])
    row = np.repeat(np.arange(len(words)), length)
    weight, bias = np.zeros(size), math.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    share_p, share_u = positive / n_pos, ~positive / n_unl
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, settings.steps + 1):
        _, slope = risk_and_slope(
            weight, bias, row, column, len(words), share_p, share_u, prior)
        slope[:-1] += settings.ridge * weight
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope * slope
        move = settings.rate * (mean / (1 - 0.9 ** step)) / (
            np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        weight, bias = weight - move[:-1], bias - move[-1]
    return weight


def prior_bias(logits: np.ndarray, counts: np.ndarray, prior: float) -> float:
    """The bias with which so many texts of these logits score the class prior on average."""
    low, high = -LOGIT_BOUND - logits.max(), LOGIT_BOUND - logits.min()
    for _ in range(60):
        middle = (low + high) / 2
        shares = 1.0 / (1.0 + np.exp(-np.clip(logits + middle, -LOGIT_BOUND, LOGIT_BOUND)))
        low, high = (middle, high) if (shares * counts).sum() < prior * counts.sum() else (low, middle)
    return float((low + high) / 2)


def train(docs: DataFrame, labels: DataFrame, settings: Training = Training()) -> Model | None:
    """The mean of the parts' classifiers, or None without a positive text.

    Reads the training texts three times: to count features, to number those of the
    sample, and for the logits that the bias rests on.
    """
    ship_package(docs.sparkSession)
    rows, prior = training_rows(docs, labels, settings)
    n_unlabelled, n_positive = rows.agg(F.count(F.lit(1)), F.count_if("positive")).first()
    if not n_positive or not prior:
        return None
    vocabulary = vocabulary_of(
        rows.select("positive", F.col("text").cast("binary").alias("text")), n_positive,
        n_unlabelled, settings)
    size = len(vocabulary)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "positive"], kind="stable")
        weight = nnpu_fit(
            part["words"].tolist(), part["positive"].to_numpy(dtype=bool), size, prior, settings)
        return pd.DataFrame({"part": part["part"].iloc[:1].tolist(), "weights": [weight]})

    fitted = fit_rows(rows, vocabulary, settings).groupBy("part").applyInPandas(
        fit, "part int, weights array<double>").where("weights is not null").collect()
    if not fitted:
        return None
    weights = sum(np.array(r["weights"]) for r in sorted(fitted, key=lambda r: r["part"])) / len(fitted)
    model = Model(tuple(vocabulary), tuple(weights.tolist()), 0.0)
    bucket = F.round(logit(rows, model) / LOGIT_STEP).cast("int")
    histogram = rows.select(F.greatest(F.lit(-LOGIT_BOUND / LOGIT_STEP), F.least(
        F.lit(LOGIT_BOUND / LOGIT_STEP), bucket)).alias("bucket")).groupBy("bucket").count().collect()
    logits = np.array([r["bucket"] * LOGIT_STEP for r in histogram])
    counts = np.array([r["count"] for r in histogram])
    return Model(model.slots, model.weights, prior_bias(logits, counts, prior))


def logit(docs: DataFrame, model: Model) -> Column:
    """A column expression: the bias and the weights of what ``text`` holds, added up."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def added(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keep, weights = np.array(held.value.slots, np.int64), np.array(held.value.weights)
        for texts in batches:
            # in the order of the slots, so equal texts add up alike everywhere
            yield pd.Series([held.value.bias + weights[places].sum()
                             for places in slot_lists(texts, keep)], dtype=float)

    return added.asNondeterministic()(F.col("text").cast("string"))


def score(docs: DataFrame, model: Model | None) -> Column:
    """A column expression: the probability that ``text`` is toxic."""
    if model is None:
        return F.lit(0.0)
    return 1.0 / (1.0 + F.exp(-logit(docs, model)))
