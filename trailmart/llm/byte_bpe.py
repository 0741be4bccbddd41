"""Byte-level BPE, encoded by a recursive DuckDB query in each Spark task and decoded again.

Spark deals the documents out; a task gathers its texts in buffers of bounded size. A text
falls into pieces that the pattern never crosses (white space and the run after it), pieces
into words by the pattern, and only words that the task's worker has not met lately are
encoded: DuckDB holds one row per token position of each word, joins neighbouring tokens
with the merge table, and contracts each word's leftmost pair of least rank until no pair is
left. Decoding joins the ids with the vocabulary and sorts the tokens' bytes by place, so that
they lie one after the other, once per distinct stretch of a buffer.

Null texts are empty; empty texts give no ids. Repeated rows stay. Other columns, whatever
their names, are not sent to Python; those named in ``keys`` come back unchanged.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
from collections.abc import Callable, Iterable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from trailmart.llm.common import buffered, ready

#: Texts encoded by one query, in bytes, and words a worker remembers.
BUFFER_BYTES = 1 << 20
REMEMBERED = 320_000
#: Bytes of words that one query merges; what exceeds DuckDB's memory spills beside the worker.
QUERY_BYTES = 1 << 20
#: Bytes of a word from which pairs of equal rank are contracted together.
LONG_WORD = 64
DUCKDB_MEMORY = "200MB"
HASH_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: White space as the tiktoken library's pattern engine has it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE = [c.encode() for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c)]
#: White space of one byte, the first bytes of longer ones, and those, packed in three bytes.
SHORT_SPACE, LONG_SPACE_LEAD = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
SHORT_SPACE[[c[0] for c in WHITE if len(c) == 1]] = True
LONG_SPACE_LEAD[[c[0] for c in WHITE if len(c) > 1]] = True
LONG_SPACES = [int.from_bytes(c.ljust(3, b"\0")) for c in WHITE if len(c) > 1]

#: A row per token position; k packs the word's number and the position, so that one order
#: by k serves all words. A word without a pair in the merge table leaves the recursion.
ENCODE = """
WITH RECURSIVE piece(k, token, live) AS (
    SELECT k, token, true FROM positions
  UNION ALL
    (WITH paired AS (
        SELECT k, token, lead(token) OVER o AS following, lead(k) OVER o AS following_k
        FROM piece WHERE live WINDOW o AS (ORDER BY k)
     ), chosen AS (
        SELECT paired.k >> 32 AS word,
               min(merged << 32 | (paired.k & 4294967295)) AS best,
               arg_min(following_k, merged << 32 | (paired.k & 4294967295)) AS gone
        FROM paired JOIN merges ON pair = (token << 32 | following)
        WHERE following_k >> 32 = paired.k >> 32
        GROUP BY ALL
     )
     SELECT k,
            CASE WHEN k & 4294967295 = best & 4294967295 THEN best >> 32 ELSE token END,
            best IS NOT NULL
     FROM piece LEFT JOIN chosen ON word = k >> 32
     WHERE live AND (best IS NULL OR k <> gone))
)
SELECT k >> 32 AS word, token FROM piece WHERE NOT live ORDER BY k
"""
#: The same for long words, in fewer rounds: all pairs of a word's least rank are contracted
#: at once, every other one where they overlap. Where that could make a pair of a still lower
#: rank, which would have to come first, only the leftmost pair of the word is contracted.
ENCODE_LONG = """
WITH RECURSIVE piece(k, token, live) AS (
    SELECT k, token, true FROM positions
  UNION ALL
    (WITH paired AS (
        SELECT k, token, row_number() OVER o AS place, lag(token) OVER o AS before,
               lead(token) OVER o AS following, lead(k) OVER o AS following_k,
               lead(token, 2) OVER o AS after
        FROM piece WHERE live WINDOW o AS (ORDER BY k)
     ), ranked AS (
        SELECT paired.*, merged, min(merged) OVER (PARTITION BY paired.k >> 32) AS least
        FROM paired JOIN merges ON pair = (token << 32 | following)
        WHERE following_k >> 32 = paired.k >> 32
     ), hits AS (
        SELECT *, place - row_number() OVER (ORDER BY k) AS island
        FROM ranked WHERE merged = least
     ), numbered AS (
        SELECT hits.k, following_k, hits.merged,
               row_number() OVER (PARTITION BY island ORDER BY hits.k) AS nth,
               hits.k = min(hits.k) OVER word AS leftmost,
               min(least(l.merged, r.merged, b.merged)) OVER word AS next_rank
        FROM hits
        LEFT JOIN merges l ON l.pair = (before << 32 | hits.merged)
        LEFT JOIN merges r ON r.pair = (hits.merged << 32 | after)
        LEFT JOIN merges b ON b.pair = (hits.merged << 32 | hits.merged)
        WINDOW word AS (PARTITION BY hits.k >> 32)
     ), chosen AS (
        SELECT k AS chosen_k, following_k, merged FROM numbered
        WHERE CASE WHEN next_rank < merged THEN leftmost ELSE nth % 2 = 1 END
     )
     SELECT k, coalesce(merged, token), k >> 32 IN (SELECT chosen_k >> 32 FROM chosen)
     FROM piece LEFT JOIN chosen ON chosen_k = k
     WHERE live AND k NOT IN (SELECT following_k FROM chosen))
)
SELECT k >> 32 AS word, token FROM piece WHERE NOT live ORDER BY k
"""
#: The bytes of all tokens in order; k packs the stretch's number and the position.
DECODE = "SELECT bytes FROM tokens JOIN vocabulary USING (token) ORDER BY k"


class Numbering(dict):
    """Numbers keys in the order in which they are met."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number

    def of(self, keys: Iterable[str]) -> np.ndarray:
        return np.array(list(map(self.__getitem__, keys)), dtype=np.int64)


class Codec:
    """One vocabulary in DuckDB, with the words that were met lately."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(_explicit_space(pattern))
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.opens = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.opens[[rank for token, rank in ranks.items() if token[:1].isspace()]] = True
        pairs = [
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        self.db = duckdb.connect(
            config={"threads": "1", "memory_limit": DUCKDB_MEMORY, "temp_directory": ".tmp"}
        )
        merges = pa.table(
            {"pair": [pair for pair, _ in pairs], "merged": [rank for _, rank in pairs]}
        )
        vocabulary = pa.table(
            {"token": list(ranks.values()), "bytes": pa.array(list(ranks), pa.binary())}
        )
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("loaded", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM loaded")
            self.db.unregister("loaded")
        self._forget()

    def _forget(self) -> None:
        self.words = Numbering()
        self.word_ids = np.zeros(0, dtype=np.uint32)
        self.word_ends = np.zeros(0, dtype=np.int64)

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        numbers, bounds, distinct = pieces(texts)
        ids, ends = self._spell(distinct)
        starts = _starts(ends)
        return [
            _gather(ids, starts[found], ends[found]).astype("<u4", copy=False).tobytes()
            for found in (numbers[a:b] for a, b in itertools.pairwise(bounds))
        ]

    def _spell(self, pieces: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """All pieces' ids one after the other, and where each piece's end."""
        if len(self.words) > REMEMBERED:
            self._forget()
        met = len(self.words)
        spelled = [self.pattern.findall(piece) for piece in pieces]
        words = self.words.of(itertools.chain.from_iterable(spelled))
        if len(self.words) > met:
            ids, ends = self._merge([w.encode() for w in itertools.islice(self.words, met, None)])
            self.word_ends = np.concatenate((self.word_ends, len(self.word_ids) + ends))
            self.word_ids = np.concatenate((self.word_ids, ids))
        starts, ends = _starts(self.word_ends)[words], self.word_ends[words]
        before = np.concatenate(([0], np.cumsum(ends - starts)))
        last_words = np.cumsum([len(s) for s in spelled], dtype=np.int64)
        return _gather(self.word_ids, starts, ends), before[last_words]

    def _merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids one after the other, and where each word's end.

        A query gets at most ``QUERY_BYTES``, or one longer word.
        """
        upto = np.cumsum([len(word) for word in words], dtype=np.int64)
        cuts = np.flatnonzero(np.diff(upto // QUERY_BYTES, prepend=0, append=-1)).tolist()
        parts = [self._merge_part(words[a:b]) for a, b in itertools.pairwise([0, *cuts]) if a < b]
        shifts = np.cumsum([0, *(len(ids) for ids, _ in parts)])
        ends = [shift + ends for shift, (_, ends) in zip(shifts, parts)]
        return np.concatenate([ids for ids, _ in parts]), np.concatenate(ends)

    def _merge_part(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(word) for word in words], dtype=np.int64)
        letters = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        of_word, place = np.repeat(np.arange(len(words)), lengths), places_in_runs(lengths)
        long = np.repeat(lengths > LONG_WORD, lengths)
        parts = []
        for query, own in ((ENCODE, ~long), (ENCODE_LONG, long)):
            if own.any():
                rows = {"k": of_word[own] << 32 | place[own], "token": letters[own]}
                parts.append(self._run(query, positions=rows))
        found = pa.concat_tables(parts)
        word = found["word"].to_numpy()
        ids = found["token"].to_numpy().astype(np.uint32)
        return ids[np.argsort(word, kind="stable")], np.cumsum(np.bincount(word))

    def decode(self, coded: Iterable[bytes]) -> list[bytes]:
        """The bytes that each id sequence stands for.

        Sequences are cut before each token that opens with white space, and each distinct
        stretch is aggregated once.
        """
        coded = list(coded)
        ids = np.frombuffer(b"".join(coded), dtype="<u4").astype(np.int64)
        text_ends = np.cumsum([len(blob) // 4 for blob in coded], dtype=np.int64)
        cut = self.opens[ids]
        cut[_starts(text_ends)[np.diff(text_ends, prepend=0) > 0]] = True
        starts = np.flatnonzero(cut)
        number, first = _distinct(ids, starts, np.append(starts[1:], len(ids)))
        lengths = (np.append(starts[1:], len(ids)) - starts)[first]
        of_stretch = np.repeat(np.arange(len(first)), lengths)
        rows = self._run(
            DECODE,
            tokens={
                "k": of_stretch << 32 | places_in_runs(lengths),
                "token": _gather(ids, starts[first], starts[first] + lengths),
            },
        )
        tokens = rows["bytes"].combine_chunks().cast(pa.large_binary())
        # Tokens of a stretch lie side by side, so its bytes end where its last token's do.
        ends = np.concatenate(([0], np.cumsum(lengths)))
        stretches = _sliced(pa.large_binary(), tokens.buffers()[2], _offsets(tokens)[ends])
        spelled = stretches.take(pa.array(number))
        bounds = np.searchsorted(starts, np.concatenate(([0], text_ends)))
        of_text = _sliced(pa.large_binary(), spelled.buffers()[2], _offsets(spelled)[bounds])
        return of_text.to_pylist()

    def _run(self, query: str, **tables: dict[str, np.ndarray]) -> pa.Table:
        for name, columns in tables.items():
            self.db.register(name, pa.table(columns))
        rows = self.db.sql(query).to_arrow_table()
        for name in tables:
            self.db.unregister(name)
        return rows


def pieces(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The numbers of all texts' pieces, the bounds of each text's, and the distinct pieces.

    A piece begins with a text and where white space follows something else.
    """
    coded = [text.encode() for text in texts]
    text_ends = np.cumsum([0, *map(len, coded)], dtype=np.int64)
    data = b"".join(coded)
    letters = np.frombuffer(data, dtype=np.uint8)
    space = SHORT_SPACE[letters]
    leads = np.flatnonzero(LONG_SPACE_LEAD[letters])
    if len(leads):
        second, third = letters[leads + 1].astype(int), np.zeros(len(leads), dtype=int)
        of_three = letters[leads] >= 0xE0
        third[of_three] = letters[leads[of_three] + 2]
        packed = letters[leads].astype(int) << 16 | second << 8 | third
        white = np.isin(packed, LONG_SPACES)
        space[leads[white]] = space[leads[white] + 1] = True
        space[leads[white & of_three] + 2] = True
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[text_ends[:-1][np.diff(text_ends) > 0]] = True
    starts = np.flatnonzero(begins)
    found = _sliced(pa.large_string(), pa.py_buffer(data), np.append(starts, len(data)))
    found = found.dictionary_encode()
    numbers = found.indices.to_numpy().astype(np.int64)
    distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
    return numbers, np.searchsorted(starts, text_ends), distinct


def _sliced(kind: pa.DataType, data: pa.Buffer, offsets: np.ndarray) -> pa.Array:
    """The stretches of ``data`` between neighbouring offsets."""
    bounds = pa.py_buffer(offsets.astype(np.int64))
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, bounds, data])


def _offsets(values: pa.Array) -> np.ndarray:
    """Where each value of a large binary array without nulls begins and the last one ends."""
    return np.frombuffer(values.buffers()[1], dtype=np.int64)[
        values.offset : values.offset + len(values) + 1
    ]


def _explicit_space(pattern: str) -> str:
    """The pattern with white space spelled out, as engines differ on control characters."""
    inside = re.sub(r"(\[[^\]]*)\\s", lambda m: m[1] + SPACE, pattern)
    return inside.replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")


def _starts(ends: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], ends[:-1])).astype(np.int64)


def places_in_runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the runs that lie one after the other."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _distinct(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The number of each slice among the distinct slices, and one slice of each number.

    Slices are told apart by a hash first; slices that share one by chance are seen by
    comparison, and then each slice counts as distinct.
    """
    lengths = ends - starts
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    places = places_in_runs(lengths)
    powers = np.cumprod(np.full(int(lengths.max()), HASH_FACTOR))
    mixed = (values.astype(np.uint64) + np.uint64(1)) * powers[places]
    mixed = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), starts)
    _, first, number = np.unique(mixed, return_index=True, return_inverse=True)
    same = np.array_equal(lengths, lengths[first[number]])
    if same:
        there = np.repeat(starts[first[number]], lengths) + places
        same = np.array_equal(values[starts[0] : ends[-1]], values[there])
    return (number, first) if same else (np.arange(len(starts)),) * 2


def _gather(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The slices from ``starts`` to ``ends``, one after the other."""
    lengths = ends - starts
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return values[np.arange(total) + shift]


@functools.lru_cache(maxsize=1)
def _codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(
    df: DataFrame, keys: list[str], vocabulary: str, pattern: str, text: str = "text"
) -> DataFrame:
    """(*keys, ids, n_tokens): ids is binary, little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in buffered(batches, "text", BUFFER_BYTES):
            ids = _codec(vocabulary, pattern).encode(rows["text"].to_pylist())
            kept = rows.drop_columns(["text"])
            kept = kept.append_column("ids", pa.array(ids, pa.binary()))
            lengths = pa.array([len(blob) // 4 for blob in ids], pa.int64())
            yield from kept.append_column("n_tokens", lengths).to_batches()

    added = [StructField("ids", BinaryType()), StructField("n_tokens", LongType())]
    return _through(df, keys, F.coalesce(F.col(text), F.lit("")).alias("text"), run, added)


def decode(df: DataFrame, keys: list[str], vocabulary: str, pattern: str) -> DataFrame:
    """(*keys, ids, decoded) of rows from ``encode``; decoded is binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in buffered(batches, "ids", BUFFER_BYTES):
            decoded = _codec(vocabulary, pattern).decode(rows["ids"].to_pylist())
            yield from rows.append_column("decoded", pa.array(decoded, pa.binary())).to_batches()

    added = [StructField("ids", BinaryType()), StructField("decoded", BinaryType())]
    return _through(df, keys, F.col("ids"), run, added)


def round_trip(
    df: DataFrame, keys: list[str], vocabulary: str, pattern: str, text: str = "text"
) -> DataFrame:
    """(*keys, ids, n_tokens, decoded): both ways in one worker, which holds one vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for rows in buffered(batches, "text", BUFFER_BYTES):
            ids = codec.encode(rows["text"].to_pylist())
            done = rows.drop_columns(["text"])
            done = done.append_column("ids", pa.array(ids, pa.binary()))
            lengths = pa.array([len(blob) // 4 for blob in ids], pa.int64())
            done = done.append_column("n_tokens", lengths)
            done = done.append_column("decoded", pa.array(codec.decode(ids), pa.binary()))
            yield from done.to_batches()

    added = [
        StructField("ids", BinaryType()),
        StructField("n_tokens", LongType()),
        StructField("decoded", BinaryType()),
    ]
    return _through(df, keys, F.coalesce(F.col(text), F.lit("")).alias("text"), run, added)


def _through(df: DataFrame, keys: list[str], sent, run: Callable, added: list[StructField]):
    ready(df.sparkSession)
    fields = [df.schema[name] for name in keys]
    return df.select(*keys, sent).mapInArrow(run, StructType(fields + added))


def round_trip_digests(df: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Per document: its number of tokens and the digests of its ids and of their decoding."""
    return round_trip(df, ["doc_id"], vocabulary, pattern).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
