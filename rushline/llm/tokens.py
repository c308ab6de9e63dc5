"""Token counts by a two-tier lookup on the map side.

A text falls into pre-tokens no merge of the model can cross. Their lengths are
looked up in a compact broadcast table of frequent pre-tokens, then in a cache of
the Python worker; what neither has is encoded by the library and cached. Nothing
of the corpus is shuffled. The broadcast table comes from a hash sample of rows of
all partitions; it only saves work: any table gives equal counts.

Defined results: NULL and empty texts have no tokens; repeated rows are counted
one by one; an empty table gives an empty result; other columns are kept as they
are by the caller's select and never read here. Text runs without any space are
one pre-token and are encoded, but not cached, above ``LONGEST_KEY`` characters.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rushline.llm.common import ship_package

#: Bounds of the first tier: expected rows of the sample, keys, characters of a key.
SAMPLE_ROWS, MOST_KEYS, LONGEST_KEY = 10_000, 20_480, 48
#: Entries of a worker's cache; it starts anew when full.
CACHE_ENTRIES = 200_000
#: The model writes a space as this sign, and reads the sign as a space.
SPACE_SIGN = "▁"
PRE_TOKEN = re.compile(r"\n| +[^ \n]*|[^ \n]+")


def is_additive(pieces: list[str], encode) -> bool:
    """Whether token counts of pre-tokens add up to that of the text.

    No piece may hold a space after another character, or a line end; a text must
    get exactly one space in front, and its own spaces must be kept.
    """
    crossing = any("\n" in p or re.search(f"[^{SPACE_SIGN}]{SPACE_SIGN}", p) for p in pieces)
    spaces = len(encode("a  b")) > len(encode("a b")) and len(encode("a ")) > len(encode("a"))
    return not crossing and spaces and len(encode("\na")) == len(encode("\n")) + len(
        encode("\na\n")) - len(encode("\n\n")) and encode(SPACE_SIGN + "a") == encode(" a")


class PieceLengths(dict):
    """Token counts of pre-tokens; encodes and remembers what it does not hold."""

    def __init__(self, model_file: str, frequent: dict[str, int]):
        import sentencepiece

        super().__init__(frequent)
        self.frequent = frequent
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.additive = is_additive(
            [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())],
            self.model.encode)

    def length(self, token: str) -> int:
        if token == "\n" or token == " ":
            return 1
        if token[0] == " ":  # the library puts the first space in front itself
            return len(self.model.encode(token[1:]))
        return len(self.model.encode("\n" + token)) - 2  # without the space and the line end

    def __missing__(self, token: str) -> int:
        n = self.length(token)
        if len(token) <= LONGEST_KEY:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
                self.update(self.frequent)
            self[token] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.additive:
            return len(self.model.encode(text))
        return sum(map(self.__getitem__, pre_tokens(text)))


def pre_tokens(text: str) -> list[str]:
    return PRE_TOKEN.findall(" " + text.replace(SPACE_SIGN, " "))


#: The lookup of a worker process, kept between the tasks of one query only: it is
#: named by the query's own broadcast table, and the next query's takes its place.
_WORKER: dict[str, PieceLengths] = {}


def _lookup(name: str, model_file: str, frequent: dict[str, int]) -> PieceLengths:
    if name not in _WORKER:
        _WORKER.clear()
        _WORKER[name] = PieceLengths(model_file, frequent)
    return _WORKER[name]


def frequent_lengths(docs: DataFrame, model_file: str) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of a hash sample over all partitions.

    At most MOST_KEYS keys of LONGEST_KEY characters each. The counts that are added
    up come from the sample, so their number does not grow with the corpus.
    """
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("string").alias("of"))
    share = min(1.0, SAMPLE_ROWS / max(docs.select(F.lit(1)).count(), 1))
    picked = rows.where(F.pmod(F.xxhash64("of", "text"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = Counter()
            for text in batch["text"]:
                seen.update(pre_tokens(text) if text else ())
            keys = [k for k in seen if len(k) <= LONGEST_KEY]
            yield pd.DataFrame({"key": keys, "n": [seen[k] for k in keys]})

    def with_lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lengths = PieceLengths(model_file, {})
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "n": [lengths.length(k) for k in batch["key"]]})

    top = picked.mapInPandas(counted, "key string, n long").groupBy("key").agg(
        F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "key").limit(MOST_KEYS)
    return {r["key"]: r["n"] for r in top.mapInPandas(with_lengths, "key string, n long").collect()}


def token_count(docs: DataFrame, model_file: str) -> Column:
    """A column expression: the number of tokens of ``text`` of these rows."""
    ship_package(docs.sparkSession)
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, model_file))
    name = uuid.uuid4().hex

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths = _lookup(name, model_file, frequent.value)
        for texts in batches:
            yield pd.Series([lengths.count(t) if t else 0 for t in texts], dtype="int64")

    return count(F.col("text").cast("string"))


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    return docs.select(
        "doc_id", F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0))
        .cast("long").alias("n_bytes"), token_count(docs, model_file).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
