"""Phrase collocations from a weighted de Bruijn graph of word grams.

Texts are lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces
and those into words ``[^\\x20\\x09]+``.  For each language the graph has an
edge for every 4 contiguous words of a piece, between the nodes of its first
and its last 3 words, weighted by its occurrences.  Where a piece ends there
is no edge, so its last 3, 2 and 1 words are stubs, counted likewise.  That
one aggregation of a row a word is all that reads the texts:

* ``flow``: a node of 3 words occurs as often as the edges leave it plus its
  stubs, a pair as often as the nodes that it begins plus its stubs, a word
  as often as the pairs that it begins plus its stubs;
* ``compact``: a node that one edge enters and one leaves, each with all of
  the node's flow, is inside a unary path; such edges are ranked along their
  path by pointer doubling and become one row with all its words (a path that
  is a closed circle can't be, as every piece begins somewhere);
* phrases of 4 words are the windows of the paths, and a shorter phrase
  inside a path is covered by a longer one with the path's weight.

Before the graph is built, three passes over the texts fill a table of
``SLOTS`` saturating counters each: by the hashes of all words and pairs, then
of the triples whose pairs may be frequent, then of the 4 words whose triples
may be.  What shares a counter below ``least`` is no candidate and no part of
one, so flow ends before it in a stub, as at the end of a piece.  That changes
no count of a phrase that occurs ``least`` times or is part of one that does;
the tables have a fixed size, and where they fill up the graph is only larger.

Defined results: a null text is empty; a null language is ``und``; repeated
rows count as often as they are there; other columns are ignored; an empty
table gives no phrases.  Phrases are compared as text, not by hashes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propval.llm import textbytes as tb
from propval.llm.store import written

WORDS = 4                                  # of the longest gram
LEAST = 30                                 # occurrences of a candidate
TOP = 2000                                 # phrases returned for a language
TABLE_OF = {1: 0, 2: 0, 3: 1, 4: 2}        # the table that counts grams of each length
TABLES = 3
SLOT_BITS = 24
SLOTS = 1 << SLOT_BITS
PART = 1 << 16                             # counters in a row of the table
SLICE = 1 << 20                            # bytes of text that one numpy pass takes

IS_BREAK = np.zeros(256, bool)
IS_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
IS_GAP = IS_BREAK.copy()
IS_GAP[[9, 32]] = True


class Words:
    """The words of many texts, with the hash of each in its language, and
    whether each is followed by another one in its piece."""

    def __init__(self, part: pa.RecordBatch):
        self.data, offsets = tb.text_bytes(part.column("text"))
        inside = ~IS_GAP[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[offsets] = True
        before = np.zeros(len(self.data), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(self.data), bool)
        after[:-1] = inside[1:]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.owner = np.searchsorted(offsets, self.start, "right") - 1
        breaks = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(IS_BREAK[self.data], out=breaks[1:])
        self.followed = np.zeros(len(self.start), bool)
        self.followed[:-1] = (self.owner[1:] == self.owner[:-1]) & (breaks[self.start[1:]] == breaks[self.end[:-1]])
        lang, at = tb.text_bytes(part.column("lang"))
        lang = tb.SpanHash(lang)(at[:-1], at[1:])
        self.key = self.word = tb.mix(lang[self.owner] * tb.BASE + tb.SpanHash(self.data, lower=True)(self.start, self.end)) if len(self.start) else np.zeros(0, tb.U)

    def grams(self, frequent: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1 to 4 words: (number of the first word, hash) of those that may
        be frequent by the tables so far, up to the first length that the next
        table has to count."""
        at, key = np.arange(len(self.word)), self.word
        fits = np.ones(len(self.word), bool)               # a gram one word shorter begins here
        for k in range(1, WORDS + 1):
            if k > 1:
                at = np.flatnonzero(fits[:-1] & fits[1:] & (self.followed[:-1] | (k > 2)))
                key = tb.mix(self.key[at] * tb.BASE + self.word[at + k - 1])
            if TABLE_OF[k] < len(frequent):
                keep = _marked(frequent[TABLE_OF[k]], _slot(key))
                at, key = at[keep], key[keep]
            yield at, key
            if TABLE_OF[k] == len(frequent) and (k == WORDS or TABLE_OF[k + 1] > len(frequent)):
                return
            fits = np.zeros(len(self.word), bool)
            fits[at] = True
            self.key = np.zeros(len(self.word), tb.U)
            self.key[at] = key


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> tb.U(64 - SLOT_BITS)).astype(np.int64)


def _marked(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Which slots' bits are set (the first bit of a byte is the highest)."""
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def _tables(frequent: list[Broadcast]):
    def run(batches):
        """One table of counters for all rows of a task, in parts; a part that
        is mostly empty as positions and counters."""
        table, before = np.zeros(SLOTS, np.uint8), [b.value for b in frequent]
        for part in tb.slices(batches, "text", SLICE):
            for k, (_, key) in enumerate(Words(part).grams(before), 1):
                if TABLE_OF[k] == len(before):
                    at, n = np.unique(_slot(key), return_counts=True)
                    table[at] = np.minimum(table[at] + n, 255)
        for k, counters in enumerate(table.reshape(-1, PART)):
            at = np.flatnonzero(counters)
            if len(at):
                few = 3 * len(at) < PART
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([at.astype(np.uint16).tobytes() if few else None], pa.binary()),
                                                  pa.array([(counters[at] if few else counters).tobytes()], pa.binary())], names=["part", "at", "n"])
    return run


def _filled(least: int):
    def run(batches):
        """Parts of all tasks added up; which counters reach least, as bits."""
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, at, n in zip(*(batch.column(c).to_pylist() for c in ("part", "at", "n")), strict=True):
                have = parts.setdefault(k, np.zeros(PART, np.uint8))
                where = slice(None) if at is None else np.frombuffer(at, np.uint16)
                have[where] = np.minimum(have[where].astype(np.uint16) + np.frombuffer(n, np.uint8), 255)
        for k, have in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(have >= least).tobytes()], pa.binary())], names=["part", "bits"])
    return run


def maybe_frequent(texts: DataFrame, least: int, frequent: list[Broadcast]) -> np.ndarray:
    """The next table: a bit for each counter, whether the grams that share it
    occur ``least`` times together (255 at most)."""
    bits = np.zeros((SLOTS // PART, PART // 8), np.uint8)
    parts = texts.mapInArrow(_tables(frequent), "part int, at binary, n binary").repartition(16, "part")
    for k, b in parts.mapInArrow(_filled(min(least, 255)), "part int, bits binary").collect():    # SLOTS / 8 bytes
        bits[k] = np.frombuffer(b, np.uint8)
    return bits.ravel()


def _phrases(w: Words, first: np.ndarray, k: int) -> pa.Array:
    """The k words from each first one on, joined by a space."""
    word = (first[:, None] + np.arange(k)).ravel()
    n = w.end[word] - w.start[word] + 1
    n[k - 1::k] -= 1                                       # no space after the last word
    to = np.cumsum(n)
    body = tb.LOWER[w.data[np.minimum(np.repeat(w.start[word] - (to - n), n) + np.arange(int(n.sum())), len(w.data) - 1)]]
    space = np.ones(len(word), bool)
    space[k - 1::k] = False
    body[to[space] - 1] = 32
    offsets = np.concatenate([[0], to[k - 1::k]]).astype(np.int32)
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(body))


GRAMS = "lang string, k int, phrase string, n long"


def grams(texts: DataFrame, least: int) -> DataFrame:
    """(lang, k, phrase, n): the edges (k = 4) and stubs (k < 4) of the graph,
    and the number of all words of the language (k = 0)."""
    tables: list[Broadcast] = []
    for _ in range(TABLES):
        tables.append(texts.sparkSession.sparkContext.broadcast(maybe_frequent(texts, least, tables)))

    def run(batches):
        frequent = [b.value for b in tables]
        for part in tb.slices(batches, "text", SLICE):
            w = Words(part)
            lang = part.column("lang")
            docs = np.flatnonzero(n := np.bincount(w.owner, minlength=part.num_rows))
            yield pa.RecordBatch.from_arrays([lang.take(pa.array(docs)), pa.array(np.zeros(len(docs), np.int32)), pa.array([""] * len(docs), pa.string()),
                                              pa.array(n[docs])], names=["lang", "k", "phrase", "n"])
            found = [*w.grams(frequent), (np.zeros(0, np.int64), None)]
            for k, ((at, key), (longer, _)) in enumerate(itertools.pairwise(found), 1):
                goes_on = np.zeros(len(w.word), bool)
                goes_on[longer] = True
                _, i, n = np.unique(key[~goes_on[at]], return_index=True, return_counts=True)
                ends = at[~goes_on[at]][i]
                if len(ends):
                    yield pa.RecordBatch.from_arrays([lang.take(pa.array(w.owner[ends])), pa.array(np.full(len(ends), k, np.int32)), _phrases(w, ends, k), pa.array(n)],
                                                     names=["lang", "k", "phrase", "n"])
    return texts.mapInArrow(run, GRAMS).groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def _first(phrase: str, k: int) -> Column:
    return F.substring_index(phrase, " ", k)


def flow(graph: DataFrame, least: int) -> DataFrame:
    """(lang, k, phrase, n) of all phrases of 1 to 4 words that occur least
    times or more: what leaves a node plus its stubs."""
    level = graph.where(F.col("k") == WORDS).select("lang", "phrase", "n")
    out = level.withColumn("k", F.lit(WORDS))
    for k in range(WORDS - 1, 0, -1):
        stubs = graph.where(F.col("k") == k).select("lang", "phrase", "n")
        level = written(level.select("lang", _first("phrase", k).alias("phrase"), "n").unionAll(stubs).groupBy("lang", "phrase").agg(F.sum("n").alias("n")))
        out = out.unionByName(level.withColumn("k", F.lit(k)))
    return out.where(F.col("n") >= least).select("lang", "k", "phrase", "n")


def compact(counts: DataFrame) -> DataFrame:
    """(lang, words, n): the maximal unary paths over the edges of counts, each
    with all its words and the weight that all its edges have."""
    edges = counts.where(F.col("k") == WORDS).select("lang", "phrase", "n")
    nodes = counts.where(F.col("k") == WORDS - 1).select("lang", F.col("phrase").alias("node"), "n")
    into = edges.select("lang", F.substring_index("phrase", " ", 1 - WORDS).alias("node"), "n", F.col("phrase").alias("ptr"))
    out = edges.select("lang", _first("phrase", WORDS - 1).alias("node"), "n", "phrase")
    back = into.join(nodes, ["lang", "node", "n"]).join(out, ["lang", "node", "n"]).select("lang", "phrase", "ptr")
    rank = written(edges.join(back, ["lang", "phrase"], "left").select(
        "lang", "phrase", "n", F.coalesce("ptr", "phrase").alias("ptr"), F.col("ptr").isNotNull().cast("long").alias("steps")))
    while True:                                            # each round doubles what a pointer spans
        jump = rank.where("steps > 0").select("lang", F.col("phrase").alias("ptr"), F.col("ptr").alias("to"), F.col("steps").alias("more"))
        after = written(rank.join(jump, ["lang", "ptr"], "left").select(
            "lang", "phrase", "n", F.coalesce("to", "ptr").alias("ptr"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.col("to").isNotNull().alias("moved")))
        rank = after.drop("moved")
        if after.where("moved").isEmpty():
            break
    along = F.sort_array(F.collect_list(F.struct("steps", F.substring_index("phrase", " ", -1).alias("word"))))
    return rank.groupBy("lang", F.col("ptr").alias("head"), "n").agg(along.alias("along")).select(
        "lang", F.concat(F.slice(F.split("head", " "), 1, WORDS - 1), F.col("along.word")).alias("words"), "n")


def _windows(words: str, k: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.array_join(F.slice(words, i, k), " "))


def covered(counts: DataFrame, paths: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the most occurrences of a longer phrase that
    holds each phrase of 2 or 3 words."""
    inside = [paths.select("lang", F.explode(F.array_distinct(_windows("words", k))).alias("phrase"), "n") for k in (2, 3)]
    triples = counts.where("k = 3").select("lang", F.explode(F.array(_first("phrase", 2), F.substring_index("phrase", " ", -2))).alias("phrase"), "n")
    return inside[0].unionAll(inside[1]).unionAll(triples).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))


def _wide(column: str) -> str:
    return f"cast({column} as decimal(20, 0))"


def scored(counts: DataFrame, paths: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer phrase
    covers, each with its lowest cut."""
    own = counts.where("k in (2, 3)").select("lang", "k", "phrase", F.col("n").alias("a"))
    own = own.join(covered(counts, paths), ["lang", "phrase"], "left").where(
        F.expr(f"longer is null or {_wide('longer')} * 100 < {_wide('a')} * 80")).select("lang", "k", "phrase", "a")
    longest = paths.select("lang", F.lit(WORDS).alias("k"), F.explode(_windows("words", WORDS)).alias("phrase"), F.col("n").alias("a"))
    cuts = own.unionAll(longest).withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', cut)"), "right": F.expr("substring_index(phrase, ' ', cut - k)")})
    shorter = counts.where(F.col("k") < WORDS)
    cuts = cuts.join(shorter.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]).join(
        shorter.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr(f"{_wide('a')} * 2000000 div ({_wide('l')} + {_wide('r')})"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("c"))
    return best.select("lang", "phrase", "a", "c.l", "c.r", "c.score")


def first_of_each(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language with their rank: first of each
    of as many shares of a language as there are shuffle partitions, so no task
    orders a whole language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = phrases.withColumn("share", F.pmod(F.hash("phrase"), F.lit(shares)))
    for keys in (["lang", "share"], ["lang"]):
        shared = shared.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return shared.drop("share")


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first ``top`` phrases of
    each language."""
    texts = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    graph = written(grams(texts, least))
    counts = written(flow(graph, least))
    words = graph.where("k = 0").select("lang", "n")
    best = first_of_each(scored(counts, written(compact(counts))), top)
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words),
sized AS (SELECT lang, ws, i, unnest([1, 2, 3, 4]) AS k FROM starts),
counts AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM sized WHERE i + k - 1 <= len(ws) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE k >= 2 AND f >= 30),
inner_at AS (SELECT lang, k, a, ws, unnest(range(2, k)) AS m FROM cand WHERE k > 2),
inner_of AS (SELECT lang, a, ws, k, m, unnest(range(1, k - m + 2)) AS i FROM inner_at),
longer AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM inner_of GROUP BY ALL),
kept AS (
  SELECT c.* FROM cand c LEFT JOIN longer g ON c.lang = g.lang AND c.phrase = g.phrase
  WHERE g.longer IS NULL OR 100 * g.longer::HUGEINT < 80 * c.a::HUGEINT),
cuts AS (SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS cut FROM kept),
scores AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
  FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals ON ranked.lang = totals.lang WHERE rank <= 2000
"""
