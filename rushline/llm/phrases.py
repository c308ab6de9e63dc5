"""Phrase collocation mining by top-order marginalisation.

Only the longest windows are counted: every word with the words that lead it by
one to three places, padded where its piece ends. A Spark ROLLUP over these
columns sums the windows of each shorter prefix, so the counts of phrases of
every length come from one table of windows; no n-gram is unfolded by itself.

A window that cannot matter is padded earlier. Two passes count words and
adjacent pairs, then triples of such pairs, into tables of fixed size (hashed
counters, so a count is never too small); a window ends before a pair or triple
that stands less than ``at_least`` times, and a word that stands less often is
counted as padding alone. Phrases below ``at_least`` never decide a result, so
all counts that do are exact.
Windows are summed within Arrow batches and in Spark's map side before they are
shuffled: a phrase that fills a third of all text costs one row a task.

Results for special cases: a NULL, empty or wordless text adds nothing; a NULL
language is ``und``; repeated rows count each time; very long texts are worked
through in pieces of whole documents, and one document is held as often as
numpy's few columns need; an empty table gives no rows; other columns are not
read, so their names may be anything.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rushline.llm.common import ship_package, stored

WORDS = ["w1", "w2", "w3", "w4"]
#: Hashed counters of a pass: 2^25, whatever the size of the corpus; the broadcast
#: table of those that reach ``at_least`` is a bit each, 4 MB.
SLOT_BITS = 25
SLICES = 64
#: Bytes of text worked through at once.
CHUNK_BYTES = 3 << 20

_SPACE, _BREAK = 1, 2
_KINDS = np.zeros(256, np.uint8)
_KINDS[[0x20, 0x09]] = _SPACE
_KINDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of some texts as numbers into a dictionary, with their pieces."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        names = sorted(set(langs))
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        kinds = _KINDS[raw]
        inside = kinds == 0
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        letters = _LOWER[raw[inside]]
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        coded = words.dictionary_encode()
        self.names = names
        self.dictionary = coded.dictionary
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.searchsorted(np.flatnonzero(kinds == _BREAK), starts)
        #: whether the next word stands in the same piece
        self.joined = np.append(piece[1:] == piece[:-1], False) if len(piece) else np.zeros(0, bool)
        stops = np.cumsum([len(t) + 1 for t in texts])
        numbers = np.array([names.index(x) for x in langs] if len(names) < 50 else
                           np.searchsorted(names, langs), np.int64)
        self.lang = numbers[np.searchsorted(stops, starts, side="right")]
        hashes = np.array([zlib.crc32(w) for w in self.dictionary.to_pylist()], np.uint64)
        seeds = np.array([zlib.crc32(x.encode()) for x in names], np.uint64)
        self._hash = hashes[self.word] if len(self.word) else np.zeros(0, np.uint64)
        self._seed = seeds[self.lang] if len(self.word) else np.zeros(0, np.uint64)

    def word_slots(self) -> np.ndarray:
        return _slot(self._hash * np.uint64(0x9E3779B97F4A7C15) + self._seed)

    def pair_slots(self) -> np.ndarray:
        """A slot for each word and the next one; only meant where ``joined``."""
        return _slot(self._hash * np.uint64(0xC2B2AE3D27D4EB4F)
                     + lead(self._hash, 1) * np.uint64(0x165667B19E3779F9)
                     + self._seed + np.uint64(1))

    def triple_slots(self) -> np.ndarray:
        """A slot for each word and the next two; only meant where both are joined."""
        return _slot(self._hash * np.uint64(0xD6E8FEB86659FD93)
                     + lead(self._hash, 1) * np.uint64(0xA0761D6478BD642F)
                     + lead(self._hash, 2) * np.uint64(0xE7037ED1A0B428DB)
                     + self._seed + np.uint64(2))

    def pairs(self, frequent: np.ndarray) -> np.ndarray:
        """Where a word and the next one are a frequent pair of frequent words."""
        kept = _has(frequent, self.word_slots())
        return self.joined & kept & lead(kept, 1) & _has(frequent, self.pair_slots())


def lead(column: np.ndarray, places: int) -> np.ndarray:
    """The column's value ``places`` rows ahead; 0 beyond the end."""
    ahead = np.zeros_like(column)
    ahead[:max(len(column) - places, 0)] = column[places:]
    return ahead


def _has(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 > 0


def _slot(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Whole documents, about CHUNK_BYTES of them at a time."""
    texts, langs, held = [], [], 0
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1)):
            texts.append(text.as_buffer().to_pybytes())
            langs.append(lang.as_py())
            held += len(texts[-1])
            if held >= CHUNK_BYTES:
                yield Words(texts, langs)
                texts, langs, held = [], [], 0
    if texts:
        yield Words(texts, langs)


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(values, return_counts=True)


def _words_and_pairs(chunk: Words) -> list[np.ndarray]:
    return [chunk.word_slots(), chunk.pair_slots()[chunk.joined]]


def frequent_slots(docs: DataFrame, at_least: int, slots_of: Callable) -> np.ndarray:
    """One bit a slot: whether what falls into it stands ``at_least`` times together."""
    most = min(at_least, 0xFFFF)
    kind = np.uint8 if most <= 0xFF else np.uint16
    size = (1 << SLOT_BITS) // SLICES

    def count(batches):
        table = np.zeros(1 << SLOT_BITS, kind)
        for chunk in _chunks(batches):
            for slots in slots_of(chunk):
                slot, n = _counted(slots)
                table[slot] = np.minimum(table[slot] + n, most)
        pack = zstandard.ZstdCompressor(level=1)
        for i in range(SLICES):
            part = table[i * size:(i + 1) * size]
            if part.any():
                yield pa.record_batch({"slice": pa.array([i], pa.int32()),
                                       "counts": pa.array([pack.compress(part.tobytes())])})

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i, counts in zip(*batch.to_pydict().values()):
                part = np.frombuffer(unpack.decompress(counts), kind).astype(np.int64)
                sums[i] = np.minimum(sums.get(i, 0) + part, most)
        for i, total in sums.items():
            yield pa.record_batch({"slice": pa.array([i], pa.int32()),
                                   "counts": pa.array([np.packbits(total >= most).tobytes()])})

    schema = "slice int, counts binary"
    bits = np.zeros((SLICES, size // 8), np.uint8)
    for row in docs.mapInArrow(count, schema).repartition(SLICES, "slice").mapInArrow(
            merge, schema).collect():
        bits[row["slice"]] = np.frombuffer(row["counts"], np.uint8)
    return bits.ravel()


def _windows_of(chunk: Words, frequent: np.ndarray, triples: np.ndarray) -> pa.RecordBatch:
    """The padded windows of a chunk, each distinct one once with its number."""
    v = max(len(chunk.dictionary), 1)
    pair = chunk.pairs(frequent)
    triple = pair & lead(pair, 1) & _has(triples, chunk.triple_slots())
    # the word itself, then its leading words while the phrase up to them may be frequent
    holds = [_has(frequent, chunk.word_slots()), pair, triple, triple & lead(triple, 1)]
    columns = [np.where(h, lead(chunk.word, i), v) for i, h in enumerate(holds)]
    # exact keys: fold in one column at a time, numbering what has been seen
    key = chunk.lang
    for column in columns:
        _, key = np.unique(key * (v + 1) + column, return_inverse=True)
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    lookup = pa.concat_arrays([chunk.dictionary, pa.array([b""], pa.large_binary())])
    words = [lookup.take(pa.array(c[first])) for c in columns]
    window = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary()))
    langs = pa.array(chunk.names, pa.string()).take(pa.array(chunk.lang[first]))
    return pa.record_batch(
        [langs, window.cast(pa.large_string()).cast(pa.string()), pa.array(counts, pa.int64())],
        ["lang", "window", "n"])


def windows(docs: DataFrame, at_least: int) -> DataFrame:
    """Counts of padded windows (lang, w1 .. w4, n); "" is padding.

    The four words travel as one text, the padding as its empty parts.
    """
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_slots(docs, at_least, _words_and_pairs))

    def triples_of(chunk):
        pair = chunk.pairs(frequent.value)
        return [chunk.triple_slots()[pair & lead(pair, 1)]]

    triples = spark.sparkContext.broadcast(frequent_slots(docs, at_least, triples_of))

    def count(batches):
        for chunk in _chunks(batches):
            if len(chunk.word):
                yield _windows_of(chunk, frequent.value, triples.value)

    found = docs.mapInArrow(count, "lang string, window string, n long").groupBy(
        "lang", "window").agg(F.sum("n").alias("n"))
    parts = F.split("window", " ")
    return found.select("lang", *[F.get(parts, F.lit(i)).alias(w) for i, w in enumerate(WORDS)], "n")


def phrase_counts(docs: DataFrame, at_least: int, text: str = "text", lang: str = "lang"
                  ) -> DataFrame:
    """Occurrences of every phrase of up to four words that stands ``at_least`` times.

    Columns lang, size, phrase (joined by spaces), f; the row of size 0 holds the
    number of all words of a language.
    """
    spark = docs.sparkSession
    ship_package(spark)
    narrow = docs.select(
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    rolled = windows(narrow, at_least).rollup("lang", *WORDS).agg(F.sum("n").alias("f"))
    size = sum((F.col(w).isNotNull().cast("int") for w in WORDS), F.lit(0))
    deepest = F.coalesce(*reversed([F.col(w) for w in WORDS]), F.lit("-"))
    return rolled.where(F.col("lang").isNotNull() & (deepest != "")).select(
        "lang", size.alias("size"), F.concat_ws(" ", *WORDS).alias("phrase"), "f",
    ).where((F.col("f") >= at_least) | (F.col("size") == 0))


def _wide(x: Column) -> Column:
    return x.cast("decimal(20,0)")


def collocations(docs: DataFrame, at_least: int = 30, most: int | None = 2000, scale: int = 2000000,
                 inside_percent: int = 80, text: str = "text", lang: str = "lang") -> DataFrame:
    """Ranked phrases of two to four words of every language.

    Columns lang, rank, phrase, a, l, r, n, score and k, the cut of the phrase.
    ``most`` bounds the report of a language (None: all of them).
    """
    if at_least < 1:
        raise ValueError("at_least must be positive")
    counts = stored(phrase_counts(docs, at_least, text, lang), "phrase_counts")
    found = counts.where("size > 1").select(
        "lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))

    def joined(part: Column) -> Column:
        return F.array_join(part, " ")

    cuts = found.select(
        "lang", "phrase", "a", "words", "size",
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
    ).select("lang", "phrase", "a", "k",
             joined(F.slice("words", F.lit(1), F.col("k"))).alias("left"),
             joined(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k"))).alias("right"))
    parts = counts.where("size > 0")
    scored = cuts.join(
        parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]
    ).join(
        parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")),
        ["lang", "right"]
    ).withColumn("product", _wide(F.col("a")) * F.lit(scale).cast("decimal(10,0)")
                 ).withColumn("parts", _wide(F.col("l")) + _wide(F.col("r"))
                              ).withColumn("score", F.expr("product div parts"))
    best = scored.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # the most frequent longer phrase around every candidate
    starts = F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)
    around = found.where("size > 2").withColumn(
        "length", F.explode(F.sequence(F.lit(2), F.col("size") - 1))
    ).withColumn("start", F.explode(starts)).groupBy(
        "lang", joined(F.slice("words", F.col("start"), F.col("length"))).alias("phrase")
    ).agg(F.max("a").alias("longer"))
    kept = best.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull()
        | (_wide(F.col("longer")) * 100 < _wide(F.col("a")) * F.lit(inside_percent)))

    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "cut.*").withColumn(
        "rank", F.row_number().over(order).cast("long"))
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", F.col("k").cast("long").alias("k"))
