"""Benchmark decontamination through a distributed positional inverted index.

The index is sharded by document: a task turns its documents, up to a bounded number of
postings, into one row that holds for each term the list of its places (document, position),
packed in bytes that only Python opens. It is stored and knows nothing of the test items.
These come in blocks of bounded size, which bounds what is sent to the tasks; a block's terms
are counted over all shards, and within a shard each phrase starts from the list of its rarest
term and is intersected, rarest first, with the lists of the others shifted by their offsets.
What is left are exact occurrences; with a slack, all terms need only be near the rarest one.

Null and empty texts have no words and match nothing. Rows with equal ids are separate
documents and are told apart by their place in the index. A phrase that several items share
counts for each of them; items with one id count as one, and an item without an id marks
words but is not among a document's items.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.llm.byte_bpe import Numbering, places_in_runs
from trailmart.llm.common import ready, stored, stored_side

WINDOW_WORDS, CONTAMINATED_PERCENT = 13, 5
#: Postings and documents of a shard, and words of a block of test items.
SHARD_POSTINGS, SHARD_DOCUMENTS, BLOCK_WORDS = 150_000, 20_000, 500_000
#: A scan holds a whole row group at once, so those of the index are small, and so are pages.
#: Sizes are looked at after each shard; by default, only after a hundred rows.
INDEX_FILES = {
    "parquet.block.size": 2 << 20,
    "parquet.page.size": 256 << 10,
    "parquet.page.size.row.check.min": 1,
    "parquet.enable.dictionary": False,
}
#: Most contaminated documents whose names are broadcast; 16 bytes each.
BROADCAST_ROWS = 1_000_000
#: Lower-cases ASCII letters and turns what separates words into spaces.
FOLD = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b > 0x7F or chr(b).isalnum() else 0x20
    for b in range(256)
)
INDEX = """
    shard string, doc_ids array<bigint>, n_words array<int>, terms array<binary>,
    counts array<int>, documents binary, positions binary
"""
MATCHES = """
    shard string, document int, item_id bigint, first int, after int
"""


def _names(ddl: str) -> list[str]:
    return [column.split()[0] for column in ddl.split(",")]


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all that is beyond ASCII, lower-cased."""
    return (text or "").encode().translate(FOLD).split()


@dataclass
class Phrases:
    """A block of test items as phrases of term numbers."""

    terms: dict[bytes, int] = field(default_factory=dict)
    items: dict[tuple[int, ...], set[int | None]] = field(default_factory=dict)
    size: int = 0

    def add(self, item_id: int | None, words: list[bytes]) -> None:
        if not words:
            return
        numbers = [self.terms.setdefault(word, len(self.terms)) for word in words]
        width = min(WINDOW_WORDS, len(numbers))
        for at in range(len(numbers) - width + 1):
            self.items.setdefault(tuple(numbers[at : at + width]), set()).add(item_id)
        self.size += len(words)


def phrase_blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Phrases]:
    """The test items in blocks; one block at a time is in the driver."""
    block = Phrases()
    for row in items.selectExpr("CAST(item_id AS BIGINT) AS item_id", "text").toLocalIterator():
        block.add(row["item_id"], words_of(row["text"]))
        if block.size >= block_words:
            yield block
            block = Phrases()
    yield block


def build_index(documents: DataFrame) -> DataFrame:
    """Shards of postings over (doc_id, text) rows, stored."""
    ready(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            for doc_id, text in zip(*(batch[n].to_pylist() for n in ("doc_id", "text"))):
                shard.add(doc_id, words_of(text))
                if shard.postings >= SHARD_POSTINGS or len(shard.doc_ids) >= SHARD_DOCUMENTS:
                    yield shard.row()
                    shard = _Shard()
        if shard.doc_ids:
            yield shard.row()

    return stored(rows.mapInArrow(shards, INDEX), "postings", INDEX_FILES)


class _Shard:
    """Postings of the documents that were added, in their order."""

    def __init__(self) -> None:
        self.terms = Numbering()
        self.doc_ids: list[int | None] = []
        self.found: list[np.ndarray] = []
        self.postings = 0

    def add(self, doc_id: int | None, words: list[bytes]) -> None:
        self.found.append(self.terms.of(words).astype(np.int32))
        self.postings += len(words)
        self.doc_ids.append(doc_id)

    def row(self) -> pa.RecordBatch:
        n_words = np.array([len(terms) for terms in self.found], dtype=np.int64)
        found, places = np.concatenate(self.found), places_in_runs(n_words)
        documents = np.repeat(np.arange(len(n_words)), n_words)
        order = np.argsort(found, kind="stable")
        counts = np.bincount(found, minlength=len(self.terms))
        values = (
            uuid.uuid4().hex, self.doc_ids, n_words, list(self.terms), counts,
            _packed(documents[order]), _packed(places[order]),
        )
        kinds = (
            pa.string(), *map(pa.list_, (pa.int64(), pa.int32(), pa.binary())),
            pa.list_(pa.int32()), pa.binary(), pa.binary(),
        )
        names = _names(INDEX)
        columns = [pa.array([value], kind) for value, kind in zip(values, kinds)]
        return pa.RecordBatch.from_arrays(columns, names)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 in two bytes each where that holds the largest, else in four."""
    width = 2 if numbers.max(initial=0) < 1 << 16 else 4
    return numbers.astype(f"<u{width}").tobytes()


def _unpacked(packed: pa.Array, total: int) -> np.ndarray:
    """``total`` numbers of the only row."""
    data = packed[0].as_buffer()
    return np.frombuffer(data, dtype=f"<u{data.size // total if total else 2}").astype(np.int64)


def term_counts(index: DataFrame) -> DataFrame:
    """(term, postings) over all shards."""
    lists = index.selectExpr("inline(arrays_zip(terms, counts))").toDF("term", "postings")
    return lists.groupBy("term").agg(F.sum("postings").alias("postings"))


def matches(index: DataFrame, block: Phrases, slack: int | None = None) -> DataFrame:
    """(shard, document, item_id, first, after) of the block's phrases in the index.

    Without ``slack`` exact occurrences, with overlapping ones of one item merged. With it,
    the reach of proximity matches: each other term of the phrase lies at most ``slack``
    words from an occurrence of the rarest.
    """
    spark = index.sparkSession
    counts = {bytes(row["term"]): row["postings"] for row in _counted(index, block).collect()}
    known = [counts.get(term, 0) for term in block.terms]
    rarity = np.array([*known, 0], dtype=np.int64)
    sent = spark.sparkContext.broadcast((block.terms, _by_width(block, rarity), rarity))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, phrases, rarity = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                shard = _Postings(batch.slice(row, 1), terms)
                found = []
                for matrix, rarest, items in phrases:
                    found += shard.search(matrix, rarest, items, rarity, slack)
                yield _spans(shard.name, found)

    columns = ["shard", "terms", "counts", "documents", "positions"]
    return index.select(*columns).mapInArrow(search, MATCHES)


def _counted(index: DataFrame, block: Phrases) -> DataFrame:
    """Counts of the block's terms, which are at most the words of a block."""
    # As an Arrow table, they reach the executors without Python workers of another kind.
    terms = pa.table({"term": pa.array(list(block.terms), pa.binary())})
    wanted = index.sparkSession.createDataFrame(terms)
    return term_counts(index).join(F.broadcast(wanted), "term", "left_semi")


def _by_width(
    block: Phrases, rarity: np.ndarray
) -> list[tuple[np.ndarray, np.ndarray, list[list[int]]]]:
    """Phrases of one width as rows of a matrix, the rarest term of each, and their items."""
    grouped: dict[int, list] = {}
    for phrase, items in block.items.items():
        grouped.setdefault(len(phrase), []).append((phrase, list(items)))
    widths = []
    for rows in grouped.values():
        matrix = np.array([p for p, _ in rows], dtype=np.int64)
        rarest = matrix[np.arange(len(matrix)), rarity[matrix].argmin(axis=1)]
        widths.append((matrix, rarest, [i for _, i in rows]))
    return widths


class _Postings:
    """One shard's lists, by the term numbers of a block."""

    def __init__(self, row: pa.RecordBatch, terms: dict[bytes, int]) -> None:
        self.name = row["shard"][0].as_py()
        ends = np.cumsum(row["counts"].flatten().to_numpy(), dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        place = _unpacked(row["documents"], total) << 32
        place += _unpacked(row["positions"], total)
        self.lists = [place[:0]] * len(terms)
        for term, start, end in zip(row["terms"].flatten().to_pylist(), [0, *ends[:-1]], ends):
            if term in terms:
                self.lists[terms[term]] = place[start:end]
        self.sizes = np.array([len(found) for found in self.lists], dtype=np.int64)

    def search(self, matrix, rarest, items, rarity, slack) -> list[tuple[int, int, int, int]]:
        """(document, item, first, after) of each match of the phrases in the matrix."""
        found = []
        # Most shards lack most phrases' rarest term, so the others are looked up for few.
        likely = np.flatnonzero(self.sizes[rarest] > 0)
        likely = likely[(self.sizes[matrix[likely]] > 0).all(axis=1)]
        for number in likely.tolist():
            phrase = matrix[number]
            order = np.argsort(rarity[phrase], kind="stable")
            exact = slack is None
            spans = self._exact(phrase, order) if exact else self._near(phrase, order, slack)
            for first, after in zip(*(span.tolist() for span in spans)):
                document = first >> 32
                low = first & 0xFFFFFFFF
                found += [(document, item, low, low + after - first) for item in items[number]]
        return found

    def _exact(self, phrase, order):
        starts = self.lists[phrase[order[0]]] - order[0]
        for offset in order[1:]:
            if not len(starts):
                break
            starts = starts[_held(self.lists[phrase[offset]], starts + offset)]
        return starts, starts + len(phrase)

    def _near(self, phrase, order, slack):
        anchors = self.lists[phrase[order[0]]]
        for term in dict.fromkeys(phrase[order[1:]].tolist()):
            there = self.lists[term]
            at = np.searchsorted(there, anchors - slack)
            close = at < len(there)
            close[close] = there[at[close]] <= anchors[close] + slack
            close[close] &= there[at[close]] >> 32 == anchors[close] >> 32
            anchors = anchors[close]
        return anchors, anchors + 1


def _held(sortedplaces_in_runs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sortedplaces_in_runs, wanted), len(sortedplaces_in_runs) - 1)
    return sortedplaces_in_runs[at] == wanted


def _spans(shard: str, found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    """Matches as rows, those of one document and item merged where they overlap or touch."""
    merged: list[list[int]] = []
    # An item without an id comes after those with one.
    found.sort(key=lambda f: (f[0], f[1] is None, f[1] or 0, *f[2:]))
    for document, item, first, after in found:
        if merged and merged[-1][:2] == [document, item] and first <= merged[-1][3]:
            merged[-1][3] = max(merged[-1][3], after)
        else:
            merged.append([document, item, first, after])
    columns = list(zip(*merged)) or [[]] * 4
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32())
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
    names = _names(MATCHES)
    return pa.RecordBatch.from_arrays([pa.array([shard] * len(merged), pa.string()), *arrays], names)


#: Words that any of the sorted spans covers: each adds what lies beyond those before it.
COVERED = """
    aggregate(
        array_sort(spans),
        struct(0 AS hit, 0 AS upto),
        (a, s) -> struct(a.hit + greatest(s.after - greatest(s.first, a.upto), 0) AS hit,
                         greatest(a.upto, s.after) AS upto),
        a -> a.hit)
"""


def contamination(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) of each document; items is sorted."""
    index = build_index(documents)
    found = [matches(index, block) for block in phrase_blocks(items)]
    return _summed(index, functools.reduce(DataFrame.unionByName, found))


def _summed(index: DataFrame, found: DataFrame) -> DataFrame:
    listed = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "n_words")))
    listed = listed.select(
        "shard", F.col("pos").alias("document"), "col.doc_ids", "col.n_words"
    )
    hits = found.groupBy("shard", "document").agg(
        F.collect_list(F.struct("first", "after")).alias("spans"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )
    hits = hits.select("shard", "document", F.expr(COVERED).alias("n_hit"), "items")
    joined = listed.join(hits, ["shard", "document"], "left")
    rows = joined.select(
        F.col("doc_ids").alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
    )
    bad = (F.col("n_hit") > 0) & (
        F.col("n_hit") * 100 >= F.col("n_words") * CONTAMINATED_PERCENT
    )
    return rows.withColumn("contaminated", bad)


def clean(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns.

    A row is named by the hash of its id and text; no column may have this name. The
    documents are shuffled only if too many of them are contaminated for a broadcast.
    """
    name = "_contamination_row"
    named = documents.withColumn(name, F.xxhash64("doc_id", "text"))
    judged = contamination(named.select(F.col(name).alias("doc_id"), "text"), items)
    bad = judged.filter("contaminated").select(F.col("doc_id").alias(name)).distinct()
    bad = stored_side(bad, "contaminated", BROADCAST_ROWS)
    return named.join(bad, name, "left_anti").drop(name)
