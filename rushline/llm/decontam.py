"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts become windows of thirteen normalised words (a shorter item is
one window). The automaton over them, words as its letters, reads every document
once; the words inside any match are hit, and hits map to code points of the
original text, for normalising keeps every character's place.

Defined results: NULL and empty texts have no words and hit nothing; an item
without words has no window; a NULL item id counts as the empty id; items with
the same id are one item; repeated documents are judged one by one; empty tables
give no rows, or no hits. Only the named columns are read, others pass unread.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rushline.llm.common import ship_package, stored

WINDOW = 13
#: A word in lower-cased UTF-8: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Most bytes of items in one automaton; more items are taken in several blocks.
BLOCK_BYTES = 32_000_000
HIT_SCHEMA = ("n_words long, n_hit long, items array<string>, "
              "runs array<array<long>>, spans array<array<long>>")


@dataclass(frozen=True)
class Rule:
    """Contaminated: some word is hit, and at least one in ``parts`` words."""

    parts: int = 20

    def holds(self, found: Column) -> Column:
        return (found["n_hit"] > 0) & (self.parts * found["n_hit"] >= found["n_words"])


def normalised_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then the words; bytes.lower changes ASCII letters only."""
    return WORD_BYTES.findall(text.encode().lower()) if text else []


class Automaton:
    """Matches of all windows of some items, with words as letters."""

    def __init__(self, items: list[tuple[str, str]]):
        import ahocorasick

        self.ids: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.ids.setdefault(w, len(self.ids) + 1) for w in normalised_words(text)]
            size = min(WINDOW, len(words))
            for i in range(len(words) - size + 1 if words else 0):
                windows.setdefault(tuple(words[i:i + size]), set()).add(item)
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, holders in windows.items():
            self.trie.add_word(window, (len(window), sorted(holders)))
        self.any = bool(windows)
        if self.any:
            self.trie.make_automaton()

    def scan(self, text: str | None, runs=(), items=()):
        """(number of words, runs of hit words, item ids), joined with earlier ones."""
        words = normalised_words(text)
        if not words or not self.any:
            return len(words), [list(r) for r in runs], sorted(items)
        get, holders_of = self.ids.get, set(items)
        found = []
        for end, (size, holders) in self.trie.iter(tuple([get(w, 0) for w in words])):
            holders_of.update(holders)
            found.append([end - size + 1, end])
        return len(words), merged_runs(found + [list(r) for r in runs]), sorted(holders_of)


def merged_runs(runs: list[list[int]]) -> list[list[int]]:
    """Overlapping and touching runs put together."""
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def original_spans(text: str, runs: list[list[int]]) -> list[tuple[int, int]]:
    """Runs of word numbers as code point spans of the original text."""
    data = text.encode().lower()
    places = [m.span() for m in WORD_BYTES.finditer(data)]
    spans, at, chars = [], 0, 0
    for first, last in runs:
        start, end = places[first][0], places[last][1]
        chars += len(data[at:start].decode())
        length = len(data[start:end].decode())
        spans.append((chars, chars + length))
        chars, at = chars + length, end
    return spans


#: The automaton of a worker, by the name of the scan it belongs to.
_WORKER: dict[str, Automaton] = {}


def _automaton(number: str, items) -> Automaton:
    if number not in _WORKER:
        _WORKER.clear()
        _WORKER[number] = Automaton(items.value)
    return _WORKER[number]


def hits_of(docs: DataFrame, items: list[tuple[str, str]], earlier: str | None = None) -> Column:
    """A struct column: what the items' automaton finds in ``text``, together with
    what the column ``earlier`` holds of other blocks."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(items)
    number = uuid.uuid4().hex

    def framed(rows, texts) -> pd.DataFrame:
        return pd.DataFrame({
            "n_words": pd.Series([r[0] for r in rows], dtype="int64"),
            "n_hit": pd.Series([sum(b - a + 1 for a, b in r[1]) for r in rows], dtype="int64"),
            "items": [r[2] for r in rows],
            "runs": [r[1] for r in rows],
            "spans": [original_spans(t, r[1]) if r[1] else [] for t, r in zip(texts, rows)]})

    @F.pandas_udf(HIT_SCHEMA)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(number, held)
        for texts in batches:
            yield framed([automaton.scan(t) for t in texts], texts)

    @F.pandas_udf(HIT_SCHEMA)
    def joined(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        automaton = _automaton(number, held)
        for texts, runs, names in batches:
            yield framed([automaton.scan(*row) for row in zip(texts, runs, names)], texts)

    text = F.col("text").cast("string")
    if earlier is None:
        return found.asNondeterministic()(text)
    return joined.asNondeterministic()(text, F.col(f"{earlier}.runs"), F.col(f"{earlier}.items"))


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list]:
    """The items in blocks of bounded size, one at a time on the driver."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = size // block_bytes + 1
    for block in range(blocks):
        part = items if blocks == 1 else items.where(
            F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield [(r["item"], r["text"]) for r in part.collect()]


def find(
    docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule(), block_bytes: int = BLOCK_BYTES,
    into: str = "found",
) -> DataFrame:
    """All columns of ``docs`` and the struct ``into``: n_words, n_hit, items, runs (of
    words), spans (code points, end exclusive) and contaminated.

    One pass over the texts. A benchmark of several blocks takes a pass for each,
    over stored rows that carry what the blocks before have found.
    """
    scanned, earlier = docs, None
    for items in item_blocks(benchmark, block_bytes):
        if earlier:
            scanned = stored(scanned, "decontam_block")
        scanned = scanned.withColumn(into, hits_of(docs, items, earlier))
        earlier = into
    return scanned.withColumn(into, F.col(into).withField("contaminated", rule.holds(F.col(into))))


def digest(found: Column) -> list[Column]:
    """The result columns of one row, with the item ids as a hash."""
    return [
        found["n_words"].alias("n_words"), found["n_hit"].alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", found["items"]), 256).alias("items_sha256"),
        found["contaminated"].alias("contaminated")]
