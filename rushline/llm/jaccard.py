"""Jaccard join on word shingles by token-combination prefixes.

Tokens are hashed shingles, ordered by frequency class, rare ones first. Two sets
as similar as asked for share at least two tokens of their prefixes, which are one
token longer than a plain prefix filter's. A shared rare token is indexed alone;
frequent tokens are indexed in combinations of two, so what thousands of texts
share (a common line, a passage) makes no bucket of its own. Candidates pass exact
bounds on size and on a parity bitmap, and are verified on the whole sets.

Sets that are equal are one class from the start. A bucket never emits all its
pairs: its members are held against a pivot first, and after the links found so
far are joined to components, only members of different components are compared,
in blocks of bounded size. Every link joins two members of some bucket, so either
its ends are in one component already or the second step compares them.

Defined results: NULL and empty texts have no set, size 0 and only themselves as
component; a text of fewer words than a shingle is one shingle; equal rows are
equal sets; NULL ids never name a component unless it has no other; an empty table
gives an empty result. Only the named columns are read. Sets are identified by 64
bits: among 10^9 different ones, a clash has a probability of 3 percent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rushline.llm.common import SPACES, fresh, ship_package, stored

# Odd multipliers that mix the word hashes of a shingle.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
       0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)
#: Entries of a worker's cache of word hashes.
CACHE_ENTRIES = 150_000
#: Most ids that are broadcast, 16 bytes each; and what stands for a NULL id there.
MOST_BROADCAST_IDS, NO_ID = 500_000, -(1 << 62)


@dataclass(frozen=True)
class Join:
    """Linked: 100 * intersection >= percent * union."""

    words: int = 4
    percent: int = 85
    #: Tokens are counted by slots over all sets. A slot is frequent from min_frequent
    #: times sample_part sets, at least; that rises by factors of two until at most
    #: max_frequent slots are.
    sample_part: int = 16
    min_frequent: int = 4
    max_frequent: int = 1 << 19
    slot_bits: int = 22
    #: Sets with more frequent tokens in the prefix index them one by one.
    most_combined: int = 16
    #: Different pivots that the buckets of one cluster may choose.
    pivots: int = 3
    block: int = 512

    @property
    def slots(self) -> int:
        return 1 << self.slot_bits

    @property
    def slices(self) -> int:
        """Parts of the table of slots, each added up by itself."""
        return min(64, self.slots)

    def required(self, n):
        """Least number of tokens shared with any linked set."""
        return -(-self.percent * n // 100)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()


def token_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending.

    bytes.lower changes A-Z only; bytes.split takes runs of ASCII white space.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        import xxhash

        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed += hashes[k:k + n] * np.uint64(MIX[k])
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(MIX[0])
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def set_key(tokens: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def parity_bits(n: int) -> int:
    return min(8192, max(64, 1 << (n - 1).bit_length()))


def parity_bitmap(tokens: np.ndarray) -> bytes:
    """Bit i: whether the number of tokens that fall on i is odd. The bits in which
    two sets differ are never more than the tokens in which they differ."""
    bits = parity_bits(len(tokens))
    odd = np.bincount(((tokens >> np.uint64(20)) % np.uint64(bits)).astype(np.int64),
                      minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound on the tokens in which two sets differ, from their bitmaps."""
    if len(a) > len(b):
        a, b = b, a
    x, y, width = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * len(b)
    while width > 8 * len(a):  # the halves of a wider map add up to the narrower one
        width //= 2
        y = (y >> width) ^ (y & ((1 << width) - 1))
    return (x ^ y).bit_count()


def may_link(n: int, m: int, a: bytes, b: bytes, percent: int) -> bool:
    """Exact bounds: false only for sets that are not linked."""
    if 100 * min(n, m) < percent * max(n, m):
        return False
    return (100 + percent) * least_difference(a, b) <= (100 - percent) * (n + m)


def signed(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def slots_of(tokens: np.ndarray, rule: Join) -> np.ndarray:
    return (tokens & np.uint64(rule.slots - 1)).astype(np.int64)


# --------------------------------------------------------------------------
# Sets, frequency classes, index entries
# --------------------------------------------------------------------------

def sets_of(docs: DataFrame, rule: Join) -> DataFrame:
    """One stored row per input row: doc_id, content, n, key, bitmap. Beside them rows
    without a key, a few a task: slice, counts, what fell into each slice of the slots.

    The tokens of every set are counted where they are made, in a table of fixed size
    a task. Copies that a task meets near each other count once.
    """
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("content", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("key", T.LongType()),
        T.StructField("bitmap", T.BinaryType()), T.StructField("slice", T.IntegerType()),
        T.StructField("counts", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = np.zeros(rule.slots, np.int32), set()
        for batch in batches:
            rows = []
            for text in batch.column(2):
                tokens = token_set(text.as_py(), rule.words)
                key = set_key(tokens) if len(tokens) else 0
                rows.append((len(tokens), key, parity_bitmap(tokens) if len(tokens) else b""))
                if len(tokens) and key not in seen:
                    if len(seen) >= CACHE_ENTRIES:
                        seen.clear()
                    seen.add(key)
                    np.add.at(table, slots_of(tokens, rule), np.int32(1))
            n, key, bitmap = zip(*rows) if rows else ((), (), ())
            columns = [batch.column(0), batch.column(1), pa.array(n, pa.int64()),
                       pa.array(key, pa.int64()), pa.array(bitmap, pa.binary())]
            columns += [pa.nulls(len(rows), f.type) for f in list(arrow)[5:]]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)
        pack = zstandard.ZstdCompressor(level=1)
        for i, part in enumerate(table.reshape(rule.slices, -1)):
            if part.any():
                yield pa.RecordBatch.from_pylist(
                    [{"slice": i, "counts": pack.compress(part.tobytes())}], schema=arrow)

    text = F.col("text").cast("string")
    return stored(docs.select("doc_id", F.xxhash64(text).alias("content"), text.alias("text")).mapInArrow(
        built, schema), "jaccard_sets")


def frequency_levels(counts: DataFrame, rule: Join) -> np.ndarray:
    """A table of fixed size: the frequency level of the tokens of each slot.

    Added up from the tasks' tables (slice, counts) over all sets, by tasks that hold
    the sums of their slices; the driver gets one byte a slot. Any table gives the same
    links; a good one keeps widely shared tokens out of the prefixes.
    """
    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i, part in zip(*batch.to_pydict().values()):
                sums[i] = sums.get(i, 0) + np.frombuffer(
                    unpack.decompress(part), np.int32).astype(np.int64)
        pack = zstandard.ZstdCompressor(level=1)
        for i, total in sums.items():
            share = total / rule.sample_part
            # One more than the power of two, none for what is not frequent.
            power = np.where(share >= rule.min_frequent, np.log2(np.maximum(share, 1)) + 1, 0)
            yield pa.record_batch({"slice": pa.array([i], pa.int32()), "counts": pa.array(
                [pack.compress(power.astype(np.uint8).tobytes())], pa.binary())})

    powers = np.zeros((rule.slices, rule.slots // rule.slices), np.uint8)
    for row in counts.repartition(rule.slices, "slice").mapInArrow(
            merge, "slice int, counts binary").collect():
        powers[row["slice"]] = np.frombuffer(
            zstandard.ZstdDecompressor().decompress(row["counts"]), np.uint8)
    powers = powers.ravel()
    by_power = np.bincount(powers, minlength=2)
    least = len(by_power)
    while least > 1 and by_power[least - 1:].sum() <= rule.max_frequent:
        least -= 1
    return np.where(powers >= least, np.maximum((powers - (powers > 0)) // 2, 1), 0).astype(np.uint8)


def index_keys(tokens: np.ndarray, levels: np.ndarray, rule: Join) -> tuple[np.ndarray, np.ndarray]:
    """(keys, weak keys) under which a set is indexed.

    Keys are rare tokens, and pairs of frequent ones. Where a set has too many
    frequent tokens for pairs, they are keys one by one; to meet such sets, all
    others have theirs as weak keys, which do not count among themselves.
    """
    n = len(tokens)
    if n < 2:  # only equal sets are as similar
        return tokens[:0], tokens[:0]
    own = levels[slots_of(tokens, rule)]
    common = np.flatnonzero(own)
    length = min(n, n - rule.required(n) + 2)
    rare = tokens[own == 0][:length]
    left = length - len(rare)
    if left <= 0:
        return rare, tokens[:0]
    frequent = tokens[common[np.argsort(own[common], kind="stable")]][:left]
    single = frequent ^ np.uint64(MIX[4])
    if len(frequent) > rule.most_combined:
        return np.concatenate([rare, single]), tokens[:0]
    first, second = np.triu_indices(len(frequent), 1)
    pairs = frequent[first] * np.uint64(MIX[5]) + frequent[second] * np.uint64(MIX[6])
    return np.concatenate([rare, pairs]), single


def entries_of(docs: DataFrame, levels: np.ndarray, rule: Join) -> DataFrame:
    """(bucket, id, n, weak): the stored index entries of all rows' sets."""
    held = docs.sparkSession.sparkContext.broadcast(levels)

    @F.pandas_udf("id long, n long, keys array<long>, weak array<long>")
    def indexed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                tokens = token_set(text, rule.words)
                keys, weak = index_keys(tokens, held.value, rule)
                rows.append((set_key(tokens) if len(tokens) else 0, len(tokens),
                             signed(keys), signed(weak)))
            yield pd.DataFrame(rows, columns=["id", "n", "keys", "weak"]).astype(
                {"id": "int64", "n": "int64"})

    rows = docs.select(indexed.asNondeterministic()(F.col("text").cast("string")).alias("e"))
    marked = F.concat(
        F.transform("e.keys", lambda k: F.struct(k.alias("bucket"), F.lit(False).alias("weak"))),
        F.transform("e.weak", lambda k: F.struct(k.alias("bucket"), F.lit(True).alias("weak"))))
    return stored(rows.select("e.id", "e.n", F.explode(marked).alias("k")).select(
        "k.bucket", "id", "n", "k.weak"), "jaccard_entries")


def members_of(entries: DataFrame, rule: Join) -> DataFrame:
    """(bucket, id, n, pivot, pivot_n): members of buckets with two sets or more.

    Entries of equal sets fall together; minimum and maximum tell single sets
    apart without gathering a bucket.
    """
    shared = entries.groupBy("bucket").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.min("weak").alias("weak"),
    ).where((F.col("low") != F.col("high")) & ~F.col("weak")).select("bucket")
    members = stored(entries.join(shared, "bucket").groupBy("bucket", "id", "n").agg(
        F.min("weak").alias("weak")), "jaccard_members")
    # A third of the buckets choose the set that shares most of its keys: of copies
    # with changes of their own that is their common origin, which all are near to.
    turn = F.pmod("bucket", F.lit(rule.pivots))
    shared_keys = members.groupBy("id").agg(F.count(F.lit(1)).alias("n_shared"))
    central = F.when(turn == 0, -F.col("n_shared") / F.col("n")).otherwise(0.0)
    pivots = members.join(shared_keys, "id").groupBy("bucket").agg(F.min(F.struct(
        "weak", central.alias("central"), F.xxhash64("id", turn).alias("order"), "id", "n",
    )).alias("p")).select("bucket", F.col("p.id").alias("pivot"), F.col("p.n").alias("pivot_n"))
    return stored(members.join(pivots, "bucket").select(
        "bucket", "id", "n", "pivot", "pivot_n"), "jaccard_buckets")


# --------------------------------------------------------------------------
# Candidates, verification, components
# --------------------------------------------------------------------------

def pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def pivot_pairs(members: DataFrame, maps: DataFrame, rule: Join) -> DataFrame:
    """(a, b): members that may be linked to the pivot of one of their buckets."""
    close = (F.col("id") != F.col("pivot")) & (
        100 * F.least("n", "pivot_n") >= rule.percent * F.greatest("n", "pivot_n"))
    pairs = members.where(close).select(*pair("id", "pivot")).distinct()
    first = maps.select(F.col("key").alias("a"), F.col("n").alias("n"), F.col("bitmap").alias("x"))
    second = maps.select(F.col("key").alias("b"), F.col("n").alias("m"), F.col("bitmap").alias("y"))

    @F.pandas_udf("boolean")
    def possible(n: pd.Series, m: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([may_link(*row, rule.percent) for row in zip(n, m, x, y)], dtype=bool)

    return pairs.join(first, "a").join(second, "b").where(possible("n", "m", "x", "y")).select("a", "b")


def cross_pairs(
    members: DataFrame, components: DataFrame, maps: DataFrame, rule: Join,
) -> DataFrame:
    """(a, b): members of one bucket and different components that may be linked.

    Pairs with the pivot are settled, so buckets whose other members are in one
    component are done. Of buckets with equal members one is enough. Large buckets
    are cut into blocks: each block of members outside the bucket's largest
    component meets every block, those of the largest one do not meet each other.
    """
    placed = stored(members.where(F.col("id") != F.col("pivot")).join(
        components.select(F.col("id"), F.col("component")), "id", "left").select(
        "bucket", "id", "n", F.coalesce("component", "id").alias("component")), "jaccard_placed")
    per_component = placed.groupBy("bucket", "component").agg(
        F.count(F.lit(1)).alias("n_own"), F.bit_xor(F.xxhash64("id")).alias("signature"))
    open_buckets = per_component.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_components"), F.sum("n_own").alias("n_all"),
        F.bit_xor("signature").alias("signature"),
        F.max(F.struct("n_own", "component")).alias("largest"),
    ).where(F.col("n_components") > 1)
    kept = open_buckets.groupBy("n_components", "n_all", "signature", "largest").agg(
        F.min("bucket").alias("bucket")).select(
        "bucket", F.col("largest.component").alias("largest"),
        F.ceil(F.col("largest.n_own") / rule.block).alias("main_blocks"),
        F.ceil((F.col("n_all") - F.col("largest.n_own")) / rule.block).alias("rest_blocks"))
    rows = placed.join(kept, "bucket").withColumn("main", F.col("component") == F.col("largest"))
    # A group is a block of the rest and one block of all, the main ones first.
    block = F.pmod(F.xxhash64("id", F.lit("block")), F.when(
        F.col("main"), F.col("main_blocks")).otherwise(F.col("rest_blocks"))).cast("int")

    def numbers(n):
        return F.sequence(F.lit(0), (n - 1).cast("int"))

    def group_of(rest, other):
        return F.struct(rest.cast("int").alias("rest"), other.cast("int").alias("other"))

    as_other = F.when(F.col("main"), block).otherwise(block + F.col("main_blocks"))
    meets_rest = F.transform(numbers(F.col("rest_blocks")), lambda r: group_of(r, as_other))
    meets_all = F.transform(numbers(F.col("main_blocks") + F.col("rest_blocks")),
                            lambda o: group_of(block, o))
    one = (F.col("main_blocks") <= 1) & (F.col("rest_blocks") <= 1)
    dealt = rows.withColumn("meet", F.explode(
        F.when(one, F.array(group_of(F.lit(0), F.lit(0))))
        .when(F.col("main"), meets_rest)
        .otherwise(F.array_union(meets_all, meets_rest)))).select(
        "bucket", "meet.rest", "meet.other", "id", "n", "component")
    carried = dealt.join(maps.select(F.col("key").alias("id"), "bitmap"), "id")
    group = ["bucket", "rest", "other"]
    sorted_rows = carried.repartition(*group).sortWithinPartitions(*group)

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_rows = None
        for batch in batches:
            if kept_rows is not None:
                batch = pd.concat([kept_rows, batch], ignore_index=True)
            keys = batch[group].to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            # The last group may go on in the next batch.
            yield compare_groups(batch, starts, starts[-1], rule)
            kept_rows = batch.iloc[starts[-1]:]
        if kept_rows is not None:
            yield compare_groups(kept_rows, np.array([0]), len(kept_rows), rule)

    return sorted_rows.mapInPandas(compared, "a long, b long").distinct()


def compare_groups(batch: pd.DataFrame, starts, end: int, rule: Join) -> pd.DataFrame:
    """Pairs of the groups before row ``end`` that may be linked."""
    ids, sizes = batch["id"].to_numpy(), batch["n"].to_numpy()
    own, maps = batch["component"].to_numpy(), batch["bitmap"].to_numpy()
    found = set()
    bounds = [*[s for s in starts if s < end], end]
    for low, high in zip(bounds[:-1], bounds[1:]):
        order = low + np.argsort(sizes[low:high], kind="stable")
        for at, i in enumerate(order):
            most = 100 * int(sizes[i]) // rule.percent
            for j in order[at + 1:]:
                if sizes[j] > most:
                    break
                if own[i] != own[j] and may_link(
                        int(sizes[i]), int(sizes[j]), maps[i], maps[j], rule.percent):
                    found.add((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return pd.DataFrame(sorted(found), columns=["a", "b"]).astype("int64")


def verified(
    docs: DataFrame, sets: DataFrame, pairs: DataFrame, rule: Join,
) -> DataFrame:
    """(a, b): the pairs that are linked, by their whole sets.

    Only texts that stand for a set in some pair are read into sets again. Their
    ids pick them before Python sees a text: broadcast up to a checked number,
    joined by a shuffle beyond it.
    """
    pairs = stored(pairs, "jaccard_pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    chosen = stored(sets.select("doc_id", "key").join(wanted, "key", "left_semi").groupBy("key").agg(
        F.min("doc_id").alias("doc_id")), "jaccard_chosen")
    ids = chosen.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("chosen_id")).distinct()
    if ids.count() <= MOST_BROADCAST_IDS:
        ids = F.broadcast(ids)

    @F.pandas_udf("key long, tokens binary")
    def built(texts: pd.Series) -> pd.DataFrame:
        rows = [token_set(t, rule.words) for t in texts]
        return pd.DataFrame({
            "key": pd.Series([set_key(r) if len(r) else 0 for r in rows], dtype="int64"),
            "tokens": [r.tobytes() for r in rows]})

    text = F.col("text").cast("string")
    picked = docs.join(
        ids, F.coalesce("doc_id", F.lit(NO_ID)) == F.col("chosen_id"), "left_semi").select(
        built.asNondeterministic()(text).alias("set")).select("set.*").join(
        wanted, "key", "left_semi")
    tokens = stored(picked.groupBy("key").agg(F.any_value("tokens").alias("tokens")), "jaccard_tokens")

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(x, y):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= rule.percent * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    first = tokens.select(F.col("key").alias("a"), F.col("tokens").alias("x"))
    second = tokens.select(F.col("key").alias("b"), F.col("tokens").alias("y"))
    return stored(pairs.join(first, "a").join(second, "b").where(linked("x", "y")).select("a", "b"),
                  "jaccard_links")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every linked id: the smallest id that links lead to.

    Each round takes the least label among the neighbours, then the label of the
    label. Labels are stored every round; a hub's edges meet its label in a join
    that Spark splits when skewed, and minima combine before the shuffle.
    """
    both = stored(links.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("id"), F.col("a").alias("other"))), "component_edges")
    labels = stored(both.groupBy("id").agg(F.least(
        F.col("id"), F.min("other")).alias("component")), "component_labels")
    while True:
        near = both.join(labels.withColumnsRenamed({"id": "other"}), "other").groupBy("id").agg(
            F.min("component").alias("near"))
        step = labels.join(near, "id").select(
            "id", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
        moved = stored(step.join(jump, "component", "left").select(
            "id", "before", F.least("component", F.coalesce("further", "component"))
            .alias("component")), "component_labels")
        labels = moved.select("id", "component")
        if not moved.where(F.col("before") != F.col("component")).limit(1).count():
            return labels


def linked_sets(docs: DataFrame, rule: Join = Join()) -> tuple[DataFrame, DataFrame]:
    """(sets, labels): the stored sets of all rows, and (id, component) of the sets
    that are linked to a different one."""
    ship_package(docs.sparkSession)
    made = sets_of(docs, rule)
    sets = made.where(F.col("n").isNotNull()).drop("slice", "counts")
    levels = frequency_levels(made.where(F.col("slice").isNotNull()).select("slice", "counts"), rule)
    members = members_of(entries_of(docs, levels, rule), rule)
    maps = sets.where(F.col("n") > 0).groupBy("key").agg(
        F.any_value("n").alias("n"), F.any_value("bitmap").alias("bitmap"))
    maps = stored(maps, "jaccard_bitmaps")
    star = verified(docs, sets, pivot_pairs(members, maps, rule), rule)
    labels = components(star)
    cross = verified(docs, sets, cross_pairs(members, labels, maps, rule), rule)
    if cross.limit(1).count():
        labels = components(star.unionByName(cross))
    return sets, labels


def classes(docs: DataFrame, rule: Join = Join()) -> DataFrame:
    """(doc_id, content, n_shingles, component_key, component_id) of every row."""
    sets, labels = linked_sets(docs, rule)
    placed = sets.select("doc_id", "content", "n", "key").join(
        labels.withColumnRenamed("id", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key"))
    least = placed.where(F.col("n") > 0).groupBy("component").agg(
        F.min("doc_id").alias("component_id"))
    joined = placed.join(
        least.withColumnRenamed("component", "component_"),
        (F.col("n") > 0) & (F.col("component") == F.col("component_")), "left")
    return joined.select(
        "doc_id", "content", F.col("n").alias("n_shingles"),
        F.col("component").alias("component_key"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_per_component(docs: DataFrame, rule: Join = Join()) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, the one with the least
    id and then text hash; of equal rows one; all rows without words."""
    placed = classes(docs, rule)
    named = placed.where(F.col("n_shingles") > 0).groupBy(
        "component_id", "component_key", "doc_id", "content").agg(F.count(F.lit(1)).alias("times"))
    chosen = named.groupBy("component_key").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", "content", "times")).alias("c"))
    kept = chosen.select(F.col("c.doc_id").alias("doc_id"), F.col("c.content").alias("content"),
                         F.col("c.times").alias("times"))
    name = fresh(docs, "kept")
    keep = kept.select(F.struct("doc_id", "content", "times").alias(name))
    same = F.xxhash64(docs["text"].cast("string")) == F.col(f"{name}.content")
    joined = docs.join(
        keep, docs["doc_id"].eqNullSafe(F.col(f"{name}.doc_id")) & same, "left")
    empty = F.length(F.btrim(F.coalesce(docs["text"].cast("string"), F.lit("")), F.lit(SPACES))) == 0
    times = F.col(f"{name}.times")
    single = joined.where(empty | (times == 1)).select(docs["*"])
    # Equal rows: which of them stays makes no difference but for extra columns.
    repeated = joined.where(~empty & (times > 1)).select(docs["*"]).dropDuplicates(["doc_id", "text"])
    return single.unionByName(repeated)
