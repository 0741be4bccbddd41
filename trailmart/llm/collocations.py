"""Phrase collocation mining: the best phrases of each language by branch and bound.

Phrases of two to four words form a tree in which a phrase is the parent of those that go on
after it. A phrase that begins with ``p`` occurs at most f(p) times, and the cut after its
first word leaves a rest of at least as many occurrences, so that no phrase below ``p`` scores
more than 2,000,000 f(p) / (f(first word) + f(p)). Growth is best first, in batches: a floor is
taken from the best pairs of each language, every node whose bound reaches it is expanded, and
a language is settled when as many phrases as are asked for survive at or above the floor, as
nothing unexpanded can reach their scores. Otherwise its floor is lowered, in the end to
nothing. Whether a phrase survives depends on the phrases that are longer by one word, so the
ones to its left are counted as well.

Expanding a batch of nodes reads the texts twice: tasks count 64-bit hashes of the longer
phrases, and only what is frequent is then counted by its words. A hash that two phrases share
merely lets a rare phrase through to the second count. What is to be expanded is sent to the
tasks up to ``SENT`` hashes; a larger set is not sent, and all phrases of the length are counted.

Null texts are empty; a null language is ``und``. Languages without candidates have no rows.
Repeated rows count each. Ties are in the order of the result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from trailmart.llm.common import ready, stored

#: Phrases returned of a language, the count from which they are candidates, and the percentage
#: of its count at which a longer phrase replaces one.
TOP, LEAST, REPLACED = 2_000, 30, 80
LONGEST, SCALE = 4, 2_000_000
#: Pairs of a language that the first floor is taken from, as a multiple of what is asked for,
#: and the factor by which that grows until the language is settled.
FIRST, GROWTH = 2, 8
#: Most hashes that are sent to the tasks, and bits of the table that is looked up first.
SENT, TABLE_BITS = 1 << 20, 24
#: Bytes of text cut into words at once, and hashes that a task holds before it passes them on.
CHUNK, HELD = 4 << 20, 2 << 20
FACTOR = np.uint64(0x9E3779B97F4A7C15)
BREAK = b"."
#: A-Z in lower case, a tab as a space, and every end of a piece as a full stop.
PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz ........."
)


def words_of(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """(distinct words, numbers of the words in order) of stretches of texts; the word
    ``BREAK`` stands between pieces, and no piece is divided between stretches."""
    data = BREAK.join(texts).translate(PLAIN).replace(BREAK, b" . ")
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > CHUNK:
            end = data.rfind(BREAK, at, at + CHUNK) + 1 or data.find(BREAK, at + CHUNK) + 1 or end
        parts = pc.split_pattern(pa.array([data[at:end]], pa.binary()), b" ").flatten()
        tokens = parts.filter(pc.greater(pc.binary_length(parts), 0)).dictionary_encode()
        at = end
        if len(tokens):
            words = tokens.dictionary.to_numpy(zero_copy_only=False).tolist()
            yield words, tokens.indices.to_numpy().astype(np.int64)


def seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode()))


def hashed(start: np.uint64, words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words, given the words' own hashes."""
    total = max(0, len(words) - size + 1)
    mixed = np.full(total, start, dtype=np.uint64)
    for n in range(size):
        mixed = (mixed ^ words[n : n + total]) * FACTOR
        mixed ^= mixed >> np.uint64(29)
    return mixed


@F.pandas_udf(LongType())
def _phrase_hash(langs: pd.Series, phrases: pd.Series) -> pd.Series:
    values = np.empty(len(phrases), dtype=np.uint64)
    for n, (lang, phrase) in enumerate(zip(langs, phrases)):
        words = [xxhash.xxh64_intdigest(word) for word in phrase.encode().split(b" ")]
        values[n] = hashed(seed(lang), np.array(words, dtype=np.uint64), len(words))[0]
    return pd.Series(values.view(np.int64))


class Members:
    """A set of hashes, looked up by a table of bits before the search."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        self.shift = np.uint64(64 - TABLE_BITS)
        self.seen = np.zeros(1 << TABLE_BITS, dtype=bool)
        self.seen[values >> self.shift] = True

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = self.seen[hashes >> self.shift]
        at = np.flatnonzero(found)
        if len(at):
            place = np.searchsorted(self.values, hashes[at])
            place[place == len(self.values)] = 0
            found[at] = self.values[place] == hashes[at]
        return found


def sent(phrases: DataFrame) -> Broadcast | None:
    """The hashes of (lang, phrase) rows for the tasks, None if they are too many."""
    hashes = phrases.select(_phrase_hash("lang", "phrase").alias("hash")).distinct()
    return _sent(hashes)


def _sent(hashes: DataFrame) -> Broadcast | None:
    values = hashes.limit(SENT + 1).toArrow()["hash"].to_numpy()
    if len(values) > SENT:
        return None
    return hashes.sparkSession.sparkContext.broadcast(np.sort(values.view(np.uint64)))


def _occurrences(batches, size, either):
    """(lang, distinct words, word numbers, hashes, places) of the phrases of each stretch.

    ``either`` holds (offset, length, set) conditions, of which a phrase has to meet one: the
    phrase's words from the offset on are in the set.
    """
    tests = [(offset, length, Members(held.value)) for offset, length, held in either]
    for batch in batches:
        texts, langs = batch["text"].to_pylist(), batch["lang"].to_pylist()
        for lang in sorted(set(langs)):
            own = [text.encode() for text, spoken in zip(texts, langs) if spoken == lang]
            for words, numbers in words_of(own):
                hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
                row = hashes[numbers]
                total = max(0, len(row) - size + 1)
                whole = np.ones(total, dtype=bool)
                if BREAK in words:
                    stop = numbers == words.index(BREAK)
                    for n in range(size):
                        whole &= ~stop[n : n + total]
                if tests:
                    met = np.zeros(total, dtype=bool)
                    for offset, length, members in tests:
                        part = hashed(seed(lang), row, length)
                        met |= members.has(part[offset : offset + total])
                    whole &= met
                yield lang, words, numbers, hashed(seed(lang), row, size), np.flatnonzero(whole)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.concatenate([part[0] for part in parts])
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], np.concatenate([part[1] for part in parts])[order]
    first = np.flatnonzero(np.diff(hashes, prepend=hashes[:1] ^ np.uint64(1)))
    return hashes[first], np.add.reduceat(counts, first)


def hash_counts(documents: DataFrame, size: int, either: list) -> DataFrame:
    """(hash, f) of the phrases of ``size`` words, summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(parts):
            hashes, counts = _merged(parts)
            columns = [pa.array(hashes.view(np.int64)), pa.array(counts)]
            return pa.RecordBatch.from_arrays(columns, names=["hash", "f"])

        parts, held = [], 0
        for *_, hashes, places in _occurrences(batches, size, either):
            if len(places):
                parts.append(np.unique(hashes[places], return_counts=True))
                held += len(parts[-1][0])
            if held > HELD:
                parts = [_merged(parts)]
                held = len(parts[0][0])
                if 2 * held > HELD:
                    yield rows(parts)
                    parts, held = [], 0
        if parts:
            yield rows(parts)

    counted = documents.mapInArrow(run, "hash bigint, f bigint")
    return counted.groupBy("hash").agg(F.sum("f").alias("f"))


def phrase_counts(documents: DataFrame, size: int, either: list) -> DataFrame:
    """(lang, phrase, f) of the phrases of ``size`` words, told apart by their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, numbers, _, places in _occurrences(batches, size, either):
            found, most = numbers[places], len(words)
            for n in range(1, size):
                if most * len(words) >= 1 << 63:
                    distinct, found = np.unique(found, return_inverse=True)
                    most = len(distinct)
                found, most = found * len(words) + numbers[places + n], most * len(words)
            _, first, counts = np.unique(found, return_index=True, return_counts=True)
            at = places[first]
            spelled = zip(*[numbers[at + n].tolist() for n in range(size)])
            phrases = [b" ".join([words[n] for n in one]) for one in spelled]
            columns = [
                pa.array([lang] * len(phrases), pa.string()),
                pa.array(phrases, pa.binary()).cast(pa.string()),
                pa.array(counts, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "f"])

    counted = documents.mapInArrow(run, "lang string, phrase string, f bigint")
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent(documents: DataFrame, size: int, least: int, either: list | None) -> DataFrame:
    """(lang, phrase, f) of phrases with f >= ``least``, at least those that meet a condition.

    Without conditions, or where one is too large to be sent, all phrases are counted.
    """
    if either is None or any(held is None for *_, held in either):
        either = []
    common = stored(hash_counts(documents, size, either).filter(F.col("f") >= least), "hashes")
    held = _sent(common.select("hash"))
    counted = phrase_counts(documents, size, [(0, size, held)] if held else [])
    return stored(counted.filter(F.col("f") >= least), "phrases")


def _share(f: str, one: str, other: str) -> Column:
    """floor(SCALE * f / (one + other)), beyond 64 bits where need be."""
    f, one, other = (f"CAST({name} AS DECIMAL(20,0))" for name in (f, one, other))
    return F.expr(f"(CAST({SCALE} AS DECIMAL(7,0)) * {f}) DIV ({one} + {other})")


def bounded(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """With ``bound``: the score that no phrase with this beginning exceeds."""
    first = words.select("lang", F.col("phrase").alias("head"), F.col("f").alias("head_f"))
    headed = phrases.withColumn("head", F.substring_index("phrase", " ", 1))
    return headed.join(first, ["lang", "head"]).select(
        *phrases.columns, _share("f", "head_f", "f").alias("bound")
    )


def scored(phrases: DataFrame, size: int, parts: dict[int, DataFrame]) -> DataFrame:
    """(lang, phrase, a, l, r, score): the cut of the lowest score, the shortest first part.

    Phrases whose parts are not all among the counted ``parts`` are left out.
    """
    cut = phrases.select("lang", "phrase", F.col("f").alias("a"))
    for k in range(1, size):
        for name, words, text in (("l", k, k), ("r", size - k, k - size)):
            held = parts[words].select(
                "lang", F.col("phrase").alias(f"{name}_part"), F.col("f").alias(f"{name}{k}")
            )
            part = F.substring_index("phrase", " ", text).alias(f"{name}_part")
            cut = cut.withColumn(f"{name}_part", part).join(held, ["lang", f"{name}_part"])
            cut = cut.drop(f"{name}_part")
    best = F.array_min(
        F.array(
            *[
                F.struct(
                    _share("a", f"l{k}", f"r{k}").alias("score"),
                    F.lit(k).alias("k"),
                    F.col(f"l{k}").alias("l"),
                    F.col(f"r{k}").alias("r"),
                )
                for k in range(1, size)
            ]
        )
    )
    cut = cut.withColumn("best", best)
    return cut.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def _above(rows: DataFrame, floors: DataFrame, value: str) -> DataFrame:
    """The rows of unsettled languages whose value reaches the floor."""
    return rows.join(floors, "lang").filter(F.col(value) >= F.col("floor")).drop("floor")


def _parents(rows: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """The rows whose beginning, all but the last word, is one of the nodes."""
    parents = nodes.select("lang", F.col("phrase").alias("parent"))
    begun = rows.withColumn("parent", F.substring_index("phrase", " ", size - 1))
    return begun.join(parents, ["lang", "parent"], "left_semi").drop("parent")


def _missing_rests(rows: DataFrame, size: int, known: DataFrame) -> DataFrame:
    rests = rows.select("lang", F.substring_index("phrase", " ", 1 - size).alias("phrase"))
    return rests.distinct().join(known, ["lang", "phrase"], "left_anti")


def surviving(
    candidates: DataFrame, longer: DataFrame, size: int, replaced: int = REPLACED
) -> DataFrame:
    """The candidates of ``size`` words that no phrase longer by one word replaces."""
    inside = [F.substring_index("phrase", " ", n).alias("phrase") for n in (size, -size)]
    held = [longer.select("lang", part, F.col("f").alias("longer_f")) for part in inside]
    most = held[0].union(held[1]).groupBy("lang", "phrase").agg(F.max("longer_f").alias("longer_f"))
    gone = F.expr(f"CAST(longer_f AS DECIMAL(20,0)) * 100 >= CAST(a AS DECIMAL(20,0)) * {replaced}")
    joined = candidates.join(most, ["lang", "phrase"], "left")
    return joined.filter(~F.coalesce(gone, F.lit(False))).drop("longer_f")


def floors_of(pairs: DataFrame, unsettled: DataFrame, count: int) -> DataFrame:
    """(lang, floor): the score of the ``count``-th best pair, 0 where there are fewer."""
    best = Window.partitionBy("lang").orderBy(F.desc("score"))
    ranked = pairs.select("lang", "score", F.row_number().over(best).alias("place"))
    last = ranked.filter(F.col("place") <= count).filter(F.col("place") == count)
    joined = unsettled.join(last, "lang", "left")
    return joined.select("lang", F.coalesce("score", F.lit(0)).alias("floor"))


def grown(
    documents: DataFrame, levels: dict[int, DataFrame], pairs: DataFrame, floors: DataFrame, least: int
) -> DataFrame:
    """(lang, phrase, a, l, r, score) of all surviving phrases at or above the floors."""
    words, known = levels[1], dict(levels)
    nodes = stored(_above(bounded(levels[2], words), floors, "bound"), "nodes")
    above = stored(_above(pairs, floors, "score"), "above")
    found = []
    for size in range(3, LONGEST + 1):
        either = [(0, size - 1, sent(nodes)), (1, size - 1, sent(above))]
        known[size] = longer = frequent(documents, size, least, either)
        found.append(surviving(above, longer, size - 1))
        below = stored(_above(bounded(_parents(longer, nodes, size), words), floors, "bound"), "nodes")
        parts = dict(known)
        if size > 3:
            wanted = stored(_missing_rests(below, size, known[size - 1]), "wanted")
            held = sent(wanted)
            either = [(0, size - 1, held)] if held else []
            if not held or len(held.value):
                extra = phrase_counts(documents, size - 1, either)
                extra = stored(extra.join(wanted, ["lang", "phrase"], "left_semi"), "rests")
                parts[size - 1] = known[size - 1].unionByName(extra)
        above = stored(_above(scored(below, size, parts), floors, "score"), "above")
        nodes = below
    found.append(above)
    result = found[0]
    for rows in found[1:]:
        result = result.unionByName(rows)
    return stored(result, "survivors")


def collocations(documents: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases.

    By score, then ``a``, both descending, then the phrase by its bytes. ``n`` counts all
    words of the language.
    """
    ready(documents.sparkSession)
    read = documents.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    every = stored(phrase_counts(read, 1, []), "words")
    totals = stored(every.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    levels = {1: stored(every.filter(F.col("f") >= least), "frequent_words")}
    levels[2] = frequent(read, 2, least, None)
    pairs = stored(scored(levels[2], 2, levels), "pairs")
    unsettled, count, settled = pairs.select("lang").distinct(), FIRST * top, []
    while True:
        floors = stored(floors_of(pairs, unsettled, count), "floors")
        texts = read.join(floors.select("lang"), "lang", "left_semi").select("lang", "text")
        survivors = grown(texts, levels, pairs, floors, least)
        settled.append(survivors)
        held = survivors.groupBy("lang").agg(F.count("*").alias("found"))
        state = floors.join(held, "lang", "left").withColumn("found", F.coalesce("found", F.lit(0)))
        open_still = (F.col("floor") > 0) & (F.col("found") < top)
        unsettled = stored(state.filter(open_still).select("lang"), "unsettled")
        if unsettled.isEmpty():
            break
        settled[-1] = survivors.join(unsettled, "lang", "left_anti")
        count *= GROWTH
    result = settled[0]
    for rows in settled[1:]:
        result = result.unionByName(rows)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = result.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    columns = ["lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n"]
    return ranked.join(totals, "lang").select(*columns, "score")


def oracle(top: int = TOP, least: int = LEAST) -> str:
    """The same as DuckDB SQL, by counting all phrases."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), spelled AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), runs AS (
    SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM spelled, range(1, {LONGEST + 1}) sizes(size) WHERE len(w) >= size
), counted AS (
    SELECT lang, size, w[i:i + size - 1] AS words, count(*) AS f FROM runs GROUP BY ALL
), candidates AS (SELECT * FROM counted WHERE size > 1 AND f >= {least}
), cuts AS (
    SELECT c.lang, c.size, c.words, c.f AS a, x.f AS l, y.f AS r, k,
           2000000::HUGEINT * c.f // (x.f + y.f) AS score
    FROM candidates c, range(1, {LONGEST}) ks(k), counted x, counted y
    WHERE k < c.size AND x.lang = c.lang AND x.words = c.words[1:k]
      AND y.lang = c.lang AND y.words = c.words[k + 1:]
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), gone AS (
    SELECT DISTINCT c.lang, c.words FROM candidates c JOIN candidates d
    ON d.lang = c.lang AND d.size > c.size AND 100 * d.f >= {REPLACED} * c.f
    AND (d.words[1:c.size] = c.words OR d.words[2:c.size + 1] = c.words
         OR d.words[3:c.size + 2] = c.words)
), kept AS (
    SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score
    FROM lowest ANTI JOIN gone USING (lang, words)
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang
           ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= {top}
"""
