"""Suffix-array dedup by difference-cover blockwise construction.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts at any
other place. Only ties of that length matter, so only suffixes that tie so long
are sorted, a bucket at a time:

1. *Cover sample.* Positions whose place in the document is in a difference cover
   modulo ``PERIOD`` get a name, a fingerprint of the ``BLOCK`` bytes that follow.
   Any two positions have a common shift below the period that takes both into the
   sample, so of two equal strings both hold a cover block of one name, at the same
   place. Names are counted bucket by bucket; a sample whose name stands once can
   take part in no tie, and documents without any other sample are done.
2. *Ranks of long ties.* The rest get a second name: of the block with all bytes
   that a string through it can have. Where that name stands twice, every string
   through the sample repeats: such long ties are resolved by the sample alone, and
   one place (the first) stands for all of them.
3. *Suffix buckets.* What is left are suffixes at the ends of ties, and the places
   that stand for long ties next to them. They are dealt to buckets by the leading
   bits of the fingerprint of their string, each bucket is sorted by itself, and
   equal neighbours repeat.

A task holds a page of documents (``PAGE_BYTES``, or one longer document) or one
bucket. Within a page equal entries are sent once, so a passage that fills a third
of all documents costs a bucket one entry a page. Answers go back as bits by page;
texts move only as compressed pages. Names that only rule out ties have 64 bits;
the two that decide have 128 bits from two separate chains of fingerprints.

Results for special cases: a NULL or empty text has no bytes and loses none; texts
shorter than ``LENGTH`` are kept whole; repeated rows remove each other, all copies
included, as the definition has it; matches never run over the end of a document;
cuts are by bytes, so what remains need not be valid UTF-8; keys may be NULL or
repeat; an empty table gives no rows; other columns are not read, so their names
may be anything.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rushline.llm.common import ship_package, stored

LENGTH = 400
PERIOD = 183
#: A difference cover of 0 .. 182, every difference once.
COVER = np.array([0, 1, 3, 16, 23, 28, 42, 76, 82, 86, 119, 137, 154, 175])
#: A string of LENGTH bytes holds the block of any sample that lies in its first PERIOD bytes.
BLOCK = LENGTH - PERIOD + 1
PAGE_BYTES = 2 << 20
#: Bytes of text for each bucket; a bucket gets at most as many suffixes.
BUCKET_BYTES = 8 << 20
#: Positions whose fingerprints are made at once, to stay in the processor's cache.
STRIDE = 1 << 15

_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_MOST_BATCH = 16 << 20


# --------------------------------------------------------------------------
# Fingerprints
# --------------------------------------------------------------------------

_CHAINS = ((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F))


def _fold(left: np.ndarray, right: np.ndarray, factor: int) -> np.ndarray:
    x = left >> np.uint64(29)
    x ^= left
    x *= np.uint64(factor)
    x += right
    return x


def _last(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _levels(buf: np.ndarray, a: int, b: int, chain: int, widths: tuple[int, ...]):
    """Fingerprints of the ``w`` bytes from every position a .. b-1, for each width (a power of
    two from 8); positions too near the end of ``buf`` get none."""
    first, factor = _CHAINS[chain]
    end = min(len(buf), b + max(widths))
    n = end - a - 7
    if n <= 0:
        return {w: np.zeros(0, np.uint64) for w in widths}
    x = np.ndarray((n,), "<u8", buffer=buf[a:end].tobytes(), strides=(1,)) * np.uint64(first)
    x ^= x >> np.uint64(32)
    found, width = {}, 8
    while True:
        if width in widths:
            found[width] = x[:b - a]
        if width == max(widths):
            return found
        x = _fold(x[:-width], x[width:], factor) if len(x) > width else x[:0]
        width *= 2


def _named(buf: np.ndarray, chain: int, parts: list[np.ndarray], width: int) -> np.ndarray:
    """One fingerprint an entry, of the texts of ``width`` bytes from each of its ``parts``.

    Parts are arrays of positions, of which the first is ascending; all positions of
    an entry lie close together.
    """
    out = np.empty(len(parts[0]), np.uint64)
    order = parts[0]
    for a in range(0, len(buf), STRIDE):
        lo, hi = np.searchsorted(order, [a, a + STRIDE])
        if lo == hi:
            continue
        here = [p[lo:hi] for p in parts]
        begin, end = min(p.min() for p in here), max(p.max() for p in here) + 1
        level = _levels(buf, begin, end, chain, (width,))[width]
        x = level[here[0] - begin]
        for p in here[1:]:
            x = _fold(x, level[p - begin], _CHAINS[1 - chain][0])
        out[lo:hi] = _last(x)
    return out


# --------------------------------------------------------------------------
# Pages
# --------------------------------------------------------------------------

class Page:
    """Some documents one after the other, with the places of their samples."""

    def __init__(self, lengths: np.ndarray, text: bytes):
        self.buf = np.frombuffer(text, np.uint8)
        self.lengths = lengths
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        steps = {}
        found = []
        for start, length in zip(self.starts.tolist(), lengths.tolist()):
            if length >= LENGTH:
                turns = -(-length // PERIOD)
                if turns not in steps:
                    steps[turns] = (np.arange(turns)[:, None] * PERIOD + COVER).ravel()
                places = steps[turns]
                found.append(places[:np.searchsorted(places, length - BLOCK + 1)] + start)
        self.samples = np.concatenate(found) if found else np.zeros(0, np.int64)

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, positions, side="right")

    def names(self) -> np.ndarray:
        """The name of every sample's block."""
        return _named(self.buf, 0, [self.samples, self.samples + BLOCK - 128], 128)

    def long_names(self, samples: np.ndarray) -> np.ndarray:
        """Two names of a sample's block with all that strings through it can hold, or up to
        the end of the document; where that is is part of the name."""
        doc = self.doc_of(samples)
        lo = np.maximum(samples - PERIOD + 1, self.starts[doc])
        hi = np.minimum(samples + LENGTH, self.ends[doc])
        cut = ((samples - lo) * 1024 + (hi - samples)).astype(np.uint64)
        names = [_named(self.buf, chain, [lo, (lo + hi) // 2 - 128, hi - 256], 256)
                 for chain in (0, 1)]
        return np.stack([_last(n + cut) for n in names], 1)

    def string_names(self, positions: np.ndarray) -> np.ndarray:
        return np.stack([_named(self.buf, chain, [positions, positions + LENGTH - 256], 256)
                         for chain in (0, 1)], 1)

    def around(self, samples: np.ndarray) -> np.ndarray:
        """Whether any of the samples lies less than PERIOD behind a position."""
        steps = np.zeros(len(self.buf) + PERIOD, np.int8)
        steps[samples] += 1  # shifted by PERIOD - 1: before the page is room for one period
        steps[samples + PERIOD] -= 1
        return np.cumsum(steps, dtype=np.int8)[PERIOD - 1:PERIOD - 1 + len(self.buf)] > 0

    def fits(self) -> np.ndarray:
        """Whether a string begins at a position and ends in the same document."""
        steps = np.zeros(len(self.buf) + 1, np.int32)
        long = self.lengths >= LENGTH
        steps[self.starts[long]] += 1
        steps[self.ends[long] - LENGTH + 1] -= 1
        return np.cumsum(steps[:-1], dtype=np.int32) > 0

    def covered(self, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the runs of bytes that the strings from ``begins`` (ascending) cover; no run
        goes over the end of a document, but two may meet there."""
        if not len(begins):
            return begins, begins
        doc = self.doc_of(begins)
        new = np.append(True, (begins[1:] > begins[:-1] + LENGTH) | (doc[1:] != doc[:-1]))
        return begins[new], begins[np.append(new[1:], True)] + LENGTH


def _pack(text: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(text)


def _unpack(text: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(text)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


def _page_of(row: dict) -> Page:
    return Page(np.array(row["lengths"], np.int64), _unpack(row["text"]))


# --------------------------------------------------------------------------
# Buckets
# --------------------------------------------------------------------------

def _dealt(page: int, keys: np.ndarray, payload: list[np.ndarray], buckets: int, schema):
    """Rows (bucket, page, entries): the entries of one page by the leading bits of their keys.

    Keys are in the order of ``bucket_of``; payload arrays follow them.
    """
    bucket = bucket_of(keys, buckets)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(cuts[1:], len(bucket))
    columns = [pa.array(bucket[cuts], pa.int32()), pa.array(np.full(len(cuts), page), pa.int64())]
    for values in payload:
        columns.append(pa.array([values[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending with the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _answered(table: pa.Table, answer: np.ndarray, sizes: list[int]) -> pa.Table:
    cuts = np.cumsum([0, *sizes])
    return pa.table({
        "page": table.column("page"), "bucket": table.column("bucket"),
        "bits": pa.array([answer[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})


def _join(table: pa.Table, name: str, kind) -> tuple[np.ndarray, list[int]]:
    parts = [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
    return np.concatenate(parts), [len(p) for p in parts]


_ANSWER = "page long, bucket int, bits binary"


def _repeats(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of the keys, and which entry of it equals a neighbour."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    equal = np.ones(max(len(order) - 1, 0), bool)
    for k in keys:
        s = k[order]
        equal &= s[1:] == s[:-1]
    return order, equal


def _sort_names(table: pa.Table) -> pa.Table:
    """One bucket of names: 1 where a name stands at a second place."""
    keys, sizes = _join(table, "keys", np.uint64)
    many, _ = _join(table, "many", np.uint8)
    order, equal = _repeats(keys)
    answer = many.copy()
    answer[order[1:][equal]] = 1
    answer[order[:-1][equal]] = 1
    return _answered(table, answer, sizes)


def _sort_strings(table: pa.Table) -> pa.Table:
    keys, sizes = _join(table, "keys", np.uint64)
    more, _ = _join(table, "more", np.uint64)
    many, _ = _join(table, "many", np.uint8)
    order, equal = _repeats(keys, more)
    answer = many.copy()
    answer[order[1:][equal]] = 1
    answer[order[:-1][equal]] = 1
    return _answered(table, answer, sizes)


TIED, FIRST, OPEN = 1, 2, 4


def _sort_long_names(table: pa.Table) -> pa.Table:
    """One bucket of samples: TIED where the long name stands twice, FIRST at the page that
    stands for it, OPEN where another sample of the same name is not tied."""
    keys, sizes = _join(table, "keys", np.uint64)
    longs, _ = _join(table, "longs", np.uint64)
    longs = longs.reshape(-1, 2)
    many, _ = _join(table, "many", np.uint8)
    page = np.repeat(table.column("page").to_numpy(), sizes)
    order = np.lexsort((page, longs[:, 1], longs[:, 0], keys))
    k, l0, l1 = keys[order], longs[order, 0], longs[order, 1]
    new_key = np.append(True, k[1:] != k[:-1])
    new_long = new_key | np.append(True, (l0[1:] != l0[:-1]) | (l1[1:] != l1[:-1]))
    group = np.cumsum(new_long) - 1
    tied = (np.bincount(group) + np.bincount(group, many[order]))[group] > 1
    of_key = np.cumsum(new_key) - 1
    opened = (np.bincount(of_key, ~tied) > 0)[of_key]
    answer = np.empty(len(order), np.uint8)
    answer[order] = tied * TIED + new_long * FIRST + opened * OPEN
    return _answered(table, answer, sizes)


def _by_page(answers: DataFrame) -> DataFrame:
    """All answers for a page in one row, in the order the page sent them."""
    return answers.groupBy("page").agg(
        F.array_sort(F.collect_list(F.struct("bucket", "bits"))).alias("answers")
    ).select("page", F.col("answers.bits").alias("bits"))


def _bits(parts) -> np.ndarray:
    return np.frombuffer(b"".join(parts or []), np.uint8)


# --------------------------------------------------------------------------
# The operator
# --------------------------------------------------------------------------

def pages(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents packed into pages, written once: page, keys, lengths, text (compressed)."""
    schema = T.StructType([
        T.StructField("page", T.LongType()), T.StructField("keys", T.ArrayType(docs.schema[key].dataType)),
        T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("text", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def pack(batches):
        number = TaskContext.get().partitionId() << 33
        keys, texts, held = [], [], 0

        def page():
            return pa.RecordBatch.from_pylist([{
                "page": number, "keys": keys, "lengths": [len(t) for t in texts],
                "text": _pack(b"".join(texts))}], schema=arrow)

        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1)):
                t = t.as_py()
                if texts and held + len(t) > PAGE_BYTES:
                    yield page()
                    number, keys, texts, held = number + 1, [], [], 0
                keys.append(k.as_py())
                texts.append(t)
                held += len(t)
        if texts:
            yield page()

    content = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return stored(docs.select(F.col(key).alias("key"), content.alias("text")).mapInArrow(
        pack, schema), "suffix_pages")


def _deal_names(buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("page", pa.int64()), ("keys", pa.binary()),
                        ("many", pa.binary())])

    def deal(batches):
        for row in _rows(batches):
            keys, counts = np.unique(_page_of(row).names(), return_counts=True)
            if len(keys):
                yield _dealt(row["page"], keys, [keys, (counts > 1).astype(np.uint8)],
                             buckets, schema)

    return deal


def _sift(arrow):
    """Documents that share no name are done; the others go on with their tied samples."""
    def sift(batches):
        for row in _rows(batches):
            page = _page_of(row)
            names = page.names()
            _, back = np.unique(names, return_inverse=True)
            tied = page.samples[_bits(row["bits"])[back] > 0] if len(names) else page.samples
            on = np.zeros(len(page.lengths), bool)
            on[page.doc_of(tied)] = True
            raw = page.buf.tobytes()
            cuts = list(zip(page.starts.tolist(), page.ends.tolist()))
            moved = np.cumsum(np.where(on, 0, page.lengths)) - np.where(on, 0, page.lengths)
            places = tied - moved[page.doc_of(tied)]
            done = [i for i in range(len(cuts)) if not on[i]]
            goes = np.flatnonzero(on)
            yield pa.RecordBatch.from_pylist([{
                "page": row["page"], "keys": [row["keys"][i] for i in goes],
                "lengths": page.lengths[goes].tolist(),
                "text": _pack(b"".join(raw[a:b] for a, b in (cuts[i] for i in goes))),
                "samples": _pack(places.astype(np.int64).tobytes()),
                "done": [{"key": row["keys"][i], "n_bytes": cuts[i][1] - cuts[i][0],
                          "sha256": hashlib.sha256(raw[slice(*cuts[i])]).hexdigest()}
                         for i in done]}], schema=arrow)

    return sift


def _sample_names(row: dict):
    """A page's tied samples with the distinct pairs of their names.

    Returns page, samples, the number of each sample's pair, the pairs' names in the
    order they are dealt in, and the first sample of each pair.
    """
    page = _page_of(row)
    samples = np.frombuffer(_unpack(row["samples"]), np.int64)
    names = _named(page.buf, 0, [samples, samples + BLOCK - 128], 128)
    longs = page.long_names(samples)
    order = np.lexsort((samples, longs[:, 1], longs[:, 0], names))
    new = np.append(True, (names[order][1:] != names[order][:-1])
                    | (longs[order][1:] != longs[order][:-1]).any(1))
    pair = np.empty(len(order), np.int64)
    pair[order] = np.cumsum(new) - 1
    first = order[new]
    return page, samples, pair, names[first], longs[first], first


def _deal_long_names(buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("page", pa.int64()), ("keys", pa.binary()),
                        ("longs", pa.binary()), ("many", pa.binary())])

    def deal(batches):
        for row in _rows(batches):
            if row["lengths"]:
                _, _, pair, names, longs, _ = _sample_names(row)
                many = (np.bincount(pair) > 1).astype(np.uint8)
                yield _dealt(row["page"], names, [names, longs, many], buckets, schema)

    return deal


def _resolved(row: dict):
    """A page, the positions whose strings repeat in long ties, and those left to sort."""
    page, samples, pair, _, _, first = _sample_names(row)
    bits = _bits(row["bits"])[pair]
    stands = np.zeros(len(samples), bool)
    stands[first] = True
    stands &= (bits & FIRST) > 0
    tied = (bits & TIED) > 0
    fits = page.fits()
    open_ = page.around(samples[(bits & OPEN) > 0]) & fits
    open_ &= ~page.around(samples[tied & ~stands])
    return page, page.around(samples[tied]) & fits, np.flatnonzero(open_)


def _distinct_strings(page: Page, positions: np.ndarray):
    """Distinct strings from the positions in the order they are dealt in: their two names,
    whether one stands more than once here, and the number of each position's string."""
    names = page.string_names(positions)
    order, equal = _repeats(names[:, 0], names[:, 1])
    new = np.append(True, ~equal)[:len(order)]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    kept = names[order[new]]
    return kept, (np.bincount(number, minlength=len(kept)) > 1).astype(np.uint8), number


def _deal_strings(buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("page", pa.int64()), ("keys", pa.binary()),
                        ("more", pa.binary()), ("many", pa.binary())])

    def deal(batches):
        for row in _rows(batches):
            if row["lengths"]:
                page, _, left = _resolved(row)
                names, many, _ = _distinct_strings(page, left)
                if len(left):
                    first, more = np.ascontiguousarray(names.T)
                    yield _dealt(row["page"], first, [first, more, many], buckets, schema)

    return deal


def _cut(arrow):
    """The runs that go and what is kept, for every document of a page."""
    def cut(batches):
        for row in _rows(batches):
            found = list(row["done"])
            if row["lengths"]:
                page, begins, left = _resolved(row)
                if len(left):
                    number = _distinct_strings(page, left)[2]
                    begins[left[_bits(row["string_bits"])[number] > 0]] = True
                starts, ends = page.covered(np.flatnonzero(begins))
                where = np.searchsorted(starts, np.append(page.starts, len(page.buf)))
                raw = page.buf.tobytes()
                for i, key in enumerate(row["keys"]):
                    start, end = int(page.starts[i]), int(page.ends[i])
                    runs = [(int(a) - start, int(b) - start) for a, b in zip(
                        starts[where[i]:where[i + 1]], ends[where[i]:where[i + 1]])]
                    kept, at = [], 0
                    for a, b in runs:
                        kept.append(raw[start + at:start + a])
                        at = b
                    kept = b"".join([*kept, raw[start + at:end]])
                    found.append({
                        "key": key, "n_bytes": end - start,
                        "spans": [{"start": a, "end": b} for a, b in runs],
                        "kept": kept if runs else None,
                        "sha256": hashlib.sha256(kept).hexdigest()})
            for i in range(0, len(found), 200):
                yield pa.RecordBatch.from_pylist(
                    [{"spans": [], "kept": None, **f} for f in found[i:i + 200]], schema=arrow)

    return cut


def repeated_strings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What repeated strings of LENGTH bytes cover, one row per document.

    Columns key, n_bytes, spans (array of start, end: maximal runs to remove, in bytes),
    kept (the remaining bytes; NULL where nothing goes) and sha256 (of the remaining bytes).
    """
    spark = docs.sparkSession
    ship_package(spark)
    if spark.conf.get(_SETTING, None) is not None:
        spark.conf.set(_SETTING, str(_MOST_BATCH))
    packed = pages(docs, key, text)
    size = packed.select(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))
                         ).first()[0] or 0
    buckets = min(1 + size // BUCKET_BYTES, 1 << 30)

    def asked(df: DataFrame, deal, columns: str, sort) -> DataFrame:
        dealt = df.mapInArrow(deal(buckets), f"bucket int, page long, {columns}")
        return _by_page(dealt.groupBy("bucket").applyInArrow(sort, _ANSWER))

    def answered(df: DataFrame, answers: DataFrame) -> DataFrame:
        return df.join(answers.hint("merge"), "page", "left")

    kind = docs.schema[key].dataType
    done = T.StructType([T.StructField("key", kind), T.StructField("n_bytes", T.LongType()),
                         T.StructField("sha256", T.StringType())])
    names = asked(packed, _deal_names, "keys binary, many binary", _sort_names)
    sifted = T.StructType([
        *packed.schema.fields, T.StructField("samples", T.BinaryType()),
        T.StructField("done", T.ArrayType(done))])
    left = stored(answered(packed, names).mapInArrow(
        _sift(to_arrow_schema(sifted)), sifted), "suffix_samples")

    ranks = asked(left.select("page", "lengths", "text", "samples"), _deal_long_names,
                  "keys binary, longs binary, many binary", _sort_long_names)
    ranked = stored(answered(left, ranks), "suffix_ranks")
    strings = asked(ranked.select("page", "lengths", "text", "samples", "bits"), _deal_strings,
                    "keys binary, more binary, many binary", _sort_strings)
    result = T.StructType([
        T.StructField("key", kind), T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.BinaryType()), T.StructField("sha256", T.StringType())])
    return answered(ranked, strings.withColumnRenamed("bits", "string_bits")).mapInArrow(
        _cut(to_arrow_schema(result)), result)


def span_bytes(spans: Column) -> Column:
    """Bytes in all spans of a document."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
