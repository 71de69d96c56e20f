"""Suffix-array deduplication of byte strings that repeat across a corpus.

A byte goes if it lies in a 100-byte string that also starts earlier
(smaller document, or same document and smaller position).  A suffix per
byte, with 100 bytes each, would be a hundred times the corpus, so:

1. *Parse.*  Anchors are chosen by content: the leftmost smallest hash of
   the ``TOKEN`` bytes at any place of a 100-byte window.  Equal windows have
   their anchor at the same place.  The window starts that share an anchor
   are a phrase; a phrase and its anchor's leading token are known by 64-bit
   hashes.  Copies of a phrase after the first lose all their window starts
   at once, and a phrase whose leading token no other phrase has repeats
   nowhere: neither needs a suffix of its own.
2. *Suffix array.*  The suffixes that begin at the remaining phrases'
   anchors are dealt out by range, with sampled splitters over their leading
   tokens (over all their bytes where one token would fill a bucket), and
   each bucket is sorted by multikey quicksort.  Neighbours'
   common prefixes give, at every depth, the runs of equal suffixes; the
   text before the anchors is sorted likewise.  A window that reaches j
   bytes back is equal to those that share the run at depth 100 - j and the
   j bytes before; all but the first go.
3. *Across boundaries.*  Runs of a token that was split and that touch the
   edge of a bucket may go on in the next one.  For these every bucket sends the first of each window,
   with its bytes, and the earliest of all buckets stays.

A hot passage so meets as one row per task, and its ragged ends are split
by the splitters, which order by all the bytes on both sides.

Defined results: a null text is empty; a null doc_id is smaller than any
other; rows with equal doc_id and equal text are one document (each row gets
its result), rows with equal doc_id and other text are documents of their own, told
apart and ordered by a 64-bit hash of the text; texts shorter than 100 bytes stay; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propval.llm import textbytes as tb
from propval.llm.store import written

MATCH = 100          # bytes of a repeated string
TOKEN = 40           # bytes of a leading token
REACH = MATCH - TOKEN + 1
FLUSH_ROWS = 1 << 20     # phrases of one task that are compared before the shuffle
BUCKET_ROWS = 100_000    # suffixes of a bucket, about

_LEN_BITS = 6        # a phrase's place: its start, and 6 bits of its length - 1


def _pack(start, length):
    return start << _LEN_BITS | (length - 1)


def _unpack(where):
    return where >> _LEN_BITS, (where & ((1 << _LEN_BITS) - 1)) + 1


def _smallest(h: np.ndarray, w: int) -> np.ndarray:
    """For every window of w hashes, the place of the leftmost smallest."""
    n, span, at, value = len(h) - w + 1, 1, np.arange(len(h), dtype=np.int32), h
    while span * 2 <= w:
        m = len(value) - span
        later = value[span:] < value[:m]
        at, value = np.where(later, at[span:], at[:m]), np.where(later, value[span:], value[:m])
        span *= 2
    r = w - span
    return np.where(value[r:r + n] < value[:n], at[r:r + n], at[:n])


def phrases(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text number, start, length, anchor, token hash, phrase hash) of all
    phrases: runs of window starts with the same anchor."""
    if len(data) < MATCH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, tb.U, tb.U))
    hashed, n = tb.SpanHash(data), len(data) - TOKEN + 1
    token = tb.mix((hashed.prefix[TOKEN:] - hashed.prefix[:-TOKEN]) * hashed.inverse[:n])
    anchor = _smallest(token, REACH)
    inside = np.ones(len(anchor), bool)
    for o in offsets[1:-1]:
        inside[max(0, o - MATCH + 1):o] = False           # windows that leave their text
    start = np.flatnonzero(inside)
    anchor = anchor[start].astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    if not len(first):
        last = first
    p, length, a = start[first], start[last] - start[first] + 1, anchor[first]
    return np.searchsorted(offsets, p, "right") - 1, p, length, a, token[a], hashed(p, start[last] + MATCH)


PHRASE = T.StructType([T.StructField(n, T.LongType()) for n in ("token", "phrase", "doc", "text_hash", "place")])
#: token of rows that only say that a phrase goes; spread by doc
_GONE = np.int64(-1)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of the texts.  Of those that this task sees more than once
    only the first goes on with its hashes; the others are gone (place < 0)."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0

    def flush():
        token, phrase, doc, text_hash, place = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((place, text_hash, doc, phrase, token))
        token, phrase, doc, text_hash, place = token[order], phrase[order], doc[order], text_hash[order], place[order]
        same = np.zeros(len(token), bool)
        same[1:] = (token[1:] == token[:-1]) & (phrase[1:] == phrase[:-1])
        twin = same.copy()
        twin[1:] &= (doc[1:] == doc[:-1]) & (text_hash[1:] == text_hash[:-1]) & (place[1:] == place[:-1])
        place = np.where(same, ~place, place)
        token = np.where(same, tb.mix((doc + place).view(tb.U)).view(np.int64), token)
        for at in range(0, len(token), 50_000):
            keep = np.flatnonzero(~twin[at:at + 50_000]) + at
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (token, phrase, doc, text_hash, place)], names=PHRASE.names)

    for part in tb.slices(batches, "text"):
        data, offsets = tb.text_bytes(part.column("text"))
        text, start, length, _, token, phrase = phrases(data, offsets)
        doc, text_hash = (part.column(c).to_numpy(zero_copy_only=False)[text] for c in ("doc", "text_hash"))
        held.append((token.view(np.int64), phrase.view(np.int64), doc, text_hash, _pack(start - offsets[text], length)))
        rows += len(start)
        if rows >= FLUSH_ROWS:
            yield from flush()
            held, rows = [], 0
    if rows:
        yield from flush()


MARK = T.StructType([*(T.StructField(n, T.LongType()) for n in ("doc", "text_hash", "place")), T.StructField("asks", T.BooleanType())])


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From phrases sorted by (token, phrase, doc, text_hash, place): those
    that go, and those that ask for a suffix, the first of each phrase whose
    token has more than one.  Holds one row from batch to batch."""
    last = None                          # the row before
    open_row, open_shared = None, False  # the last first-of-its-phrase, and whether its token had one before
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy() for n in PHRASE.names]
        token, phrase, doc, text_hash, place = columns
        prev = [np.concatenate([[x[0] ^ 1 if last is None else last[i]], x[:-1]]) for i, x in enumerate(columns)]
        last = tuple(x[-1] for x in columns)
        gone_already = place < 0
        same = (token == prev[0]) & (phrase == prev[1])
        twin = same & (doc == prev[2]) & (text_hash == prev[3]) & (place == prev[4])
        first, goes = ~same & ~gone_already, same & ~twin & ~gone_already
        of_row = (token, doc, text_hash, place)
        asks = [x[first] for x in of_row]
        if len(asks[0]):
            if open_row is not None:
                asks = [np.concatenate([[o], x]) for o, x in zip(open_row, asks, strict=True)]
            shared = np.zeros(len(asks[0]), bool)
            pair = asks[0][1:] == asks[0][:-1]
            shared[1:] |= pair
            shared[:-1] |= pair
            shared[0] |= open_row is not None and open_shared
            open_row, open_shared = tuple(x[-1] for x in asks), bool(shared[-1])
            asks = [x[:-1][shared[:-1]] for x in asks]
        parts = [(doc[gone_already], text_hash[gone_already], ~place[gone_already], False), (doc[goes], text_hash[goes], place[goes], False), (*asks[1:], True)]
        yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate([x[i] for x in parts])) for i in range(3)),
                                          pa.array(np.concatenate([np.full(len(x[0]), x[3]) for x in parts]))], names=MARK.names)
    if open_row is not None and open_shared:
        yield pa.RecordBatch.from_arrays([*(pa.array([x]) for x in open_row[1:]), pa.array([True])], names=MARK.names)


SUFFIX = T.StructType([T.StructField("suffix", T.BinaryType()), T.StructField("before", T.BinaryType()),
                       *(T.StructField(n, T.LongType()) for n in ("doc", "text_hash", "place"))])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffix at the anchor of every asked phrase, as far as its windows
    reach, and the phrase's bytes before the anchor, backwards."""
    for part in tb.slices(batches, "text"):
        data, offsets = tb.text_bytes(part.column("text"))
        _, start, _, anchor, _, _ = phrases(data, offsets)
        anchor_of = np.zeros(len(data) + 1, np.int64)
        anchor_of[start] = anchor
        asked = part.column("places")
        owner = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(asked.offsets)))
        place = asked.flatten().to_numpy(zero_copy_only=False)
        start, length = _unpack(place)
        start = start + offsets[owner]
        doc, text_hash, body = part.column("doc").to_numpy()[owner], part.column("text_hash").to_numpy()[owner], data.tobytes()
        rows = [(body[a:s + n - 1 + MATCH], body[s:a][::-1]) for a, s, n in zip(anchor_of[start], start, length, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()),
                                          pa.array(doc), pa.array(text_hash), pa.array(place)], names=SUFFIX.names)


def _columns(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts as rows of big-endian 8-byte characters, zeros behind, and their lengths."""
    data, offsets = tb.text_bytes(texts)
    length = np.diff(offsets)
    out = np.zeros((len(length), width), np.uint8)
    row = np.repeat(np.arange(len(length)), length)
    out[row, np.arange(len(data)) - offsets[row]] = data
    return out.view(">u8").astype(tb.U), length


def multikey_quicksort(key: np.ndarray) -> np.ndarray:
    """Order of the rows of key (columns of 8-byte characters).  Level by
    level, every range that is still equal is parted by its next character
    into less, equal and greater; ranges of one row are done.  All ranges of
    a level are parted in one numpy pass."""
    order, fresh = np.arange(len(key)), np.zeros(len(key), bool)
    fresh[:1] = True                                      # begins a range of rows that are equal so far
    for character in key.T:
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        where = np.flatnonzero(tied)
        if not len(where):
            break
        order[where] = order[where][np.lexsort((character[order[where]], np.cumsum(fresh)[where]))]
        fresh[1:] |= character[order[1:]] != character[order[:-1]]
    return order


def _common(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Bytes that rows of a and b share at the front."""
    if not len(a):
        return np.zeros(0, np.int64)
    differ = (a.astype(">u8").view(np.uint8) != b.astype(">u8").view(np.uint8)).reshape(len(a), -1)[:, :width]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), width)


RUN = T.StructType([T.StructField("doc", T.LongType()), T.StructField("text_hash", T.LongType()), T.StructField("start", T.LongType()),
                    T.StructField("length", T.LongType()), T.StructField("window", T.BinaryType())])


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: runs of window starts that go (window null), and of the
    windows whose run touches the bucket's edge the first of each (window set)."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    part = pa.Table.from_batches(got).combine_chunks()
    split = part["split"].to_numpy()
    doc = part["doc"].to_numpy()
    text_hash = part["text_hash"].to_numpy()
    start, length = _unpack(part["place"].to_numpy())
    suffix, _ = _columns(part["suffix"], 104)
    before, b_len = _columns(part["before"], 64)
    anchor = start + b_len
    by_place = np.lexsort((anchor, text_hash, doc))       # earlier first, for all that follows
    doc, text_hash, start, length, suffix, before, b_len, split = (
        x[by_place] for x in (doc, text_hash, start, length, suffix, before, b_len, split))
    once = np.ones(len(doc), bool)                        # a document that is listed twice comes twice
    once[1:] = (doc[1:] != doc[:-1]) | (text_hash[1:] != text_hash[:-1]) | (start[1:] != start[:-1])
    doc, text_hash, start, length, suffix, before, b_len, split = (x[once] for x in (doc, text_hash, start, length, suffix, before, b_len, split))
    m = len(doc)
    order, back = multikey_quicksort(suffix), multikey_quicksort(before)
    common, common_back = _common(suffix[order[:-1]], suffix[order[1:]], MATCH), _common(before[back[:-1]], before[back[1:]], 64)
    reach_min = b_len - length + 1                        # windows reach from this many bytes back ...
    gone, touches = np.zeros((m, REACH), bool), np.zeros((m, REACH), bool)
    for j in range(REACH):                                # ... to b_len
        valid = np.flatnonzero((reach_min <= j) & (j <= b_len))
        if not len(valid):
            continue
        run, run_back = np.empty(m, np.int64), np.empty(m, np.int64)
        run[order] = np.concatenate([[0], np.cumsum(common < MATCH - j)])
        run_back[back] = np.concatenate([[0], np.cumsum(common_back < j)])
        key = run[valid] * m + run_back[valid]
        by = np.argsort(key, kind="stable")
        again = np.zeros(len(valid), bool)
        again[by[1:]] = key[by[1:]] == key[by[:-1]]
        gone[valid, j] = again
        edge = (run[valid] == 0) | (run[valid] == run[order[-1]])
        touches[valid, j] = edge & ~again & split[valid]
    # runs of window starts: start = anchor - j, so j counts backwards
    flat = np.zeros((m, REACH + 1), np.int8)
    flat[:, :-1] = gone[:, ::-1]
    edge = np.diff(np.concatenate([[0], flat.ravel()]))
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    row, offset = lo // (REACH + 1), lo % (REACH + 1)
    anchor = start + b_len
    out = [doc[row], text_hash[row], anchor[row] - (REACH - 1 - offset), hi - lo]
    yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in out), pa.nulls(len(row), pa.binary())], names=RUN.names)
    left, right = before.astype(">u8").view(np.uint8).reshape(m, -1), suffix.astype(">u8").view(np.uint8).reshape(m, -1)
    i, j = np.nonzero(touches)
    for at in range(0, len(i), 20_000):
        ii, jj = i[at:at + 20_000], j[at:at + 20_000]
        window = [left[x, :y][::-1].tobytes() + right[x, :MATCH - y].tobytes() for x, y in zip(ii, jj, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(doc[ii]), pa.array(text_hash[ii]), pa.array(anchor[ii] - jj),
                                          pa.array(np.ones(len(ii), np.int64)), pa.array(window, pa.binary())], names=RUN.names)


def _key(doc_id: str, text: str) -> tuple[Column, Column]:
    """What tells documents apart: the id, and 64 bits of the text's hash."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))), F.xxhash64(F.coalesce(text, F.lit("")))


def _keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    doc, text_hash = _key(doc_id, text)
    return df.select(doc.alias("doc"), text_hash.alias("text_hash"), F.coalesce(text, F.lit("")).alias("text"))


def repeated_runs(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, text_hash, start, length): runs of starts of 100-byte strings
    that also start earlier."""
    keyed = _keyed(df, doc_id, text)
    marks = written(keyed.mapInArrow(_parse, PHRASE).repartition("token")
                    .sortWithinPartitions(*PHRASE.names).mapInArrow(_classes, MARK))
    gone = marks.where("not asks").select("doc", "text_hash", F.shiftright("place", _LEN_BITS).alias("start"),
                                          (F.col("place").bitwiseAND((1 << _LEN_BITS) - 1) + 1).alias("length"))
    asked = marks.where("asks").groupBy("doc", "text_hash").agg(F.sort_array(F.collect_list("place")).alias("places"))
    suffixes = written(keyed.join(asked, ["doc", "text_hash"]).mapInArrow(_suffixes, SUFFIX))
    suffixes = suffixes.withColumn("token", F.substring("suffix", 1, TOKEN))
    buckets = max(1, -(-suffixes.count() // BUCKET_ROWS))
    hot = suffixes.groupBy("token").count().where(F.col("count") > BUCKET_ROWS // 2).select("token", F.lit(True).alias("hot"))
    within = lambda c: F.when(F.col("split"), F.col(c))
    found = written(suffixes.join(hot, "token", "left").withColumn("split", F.col("hot").isNotNull())
                    .repartitionByRange(buckets, "token", within("suffix"), within("before"), within("doc"), within("text_hash"), within("place"))
                    .select("suffix", "before", "doc", "text_hash", "place", "split").mapInArrow(_bucket, RUN))
    at = F.struct("doc", "text_hash", "start")
    edges = found.where("window is not null")
    first = edges.groupBy("window").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = edges.join(first, "window").where(at > F.col("first")).select("doc", "text_hash", "start", "length")
    return gone.unionByName(found.where("window is null").drop("window")).unionByName(later)


CUT = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [
    T.StructField("kept_sha256", T.StringType()), T.StructField("kept_text", T.StringType())]


def _cut(text: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[int, int, int, str, str]:
    if not len(starts):
        return len(text), 0, 0, hashlib.sha256(text).hexdigest(), text.decode()
    order = np.argsort(starts)
    begin, end = starts[order], np.maximum.accumulate((starts + lengths - 1 + MATCH)[order])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    begin, end = begin[new], end[np.append(np.flatnonzero(new)[1:], len(new)) - 1]
    kept = b"".join(text[a:b] for a, b in zip([0, *end], [*begin, len(text)], strict=True))
    return len(text), int((end - begin).sum()), len(begin), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df with n_bytes, n_removed, n_spans, kept_sha256 (of the bytes that
    stay) and kept_text (without characters of which only a part stays).
    Input columns with these names go."""
    df = tb.without(df, [f.name for f in CUT])
    runs = repeated_runs(df, doc_id, text).groupBy("doc", "text_hash").agg(F.collect_set(F.struct("start", "length")).alias("_runs"))
    runs = runs.select(F.col("doc").alias("_doc"), F.col("text_hash").alias("_text_hash"), "_runs")
    doc, text_hash = _key(doc_id, text)
    joined = df.join(runs, (doc == F.col("_doc")) & (text_hash == F.col("_text_hash")), "left").drop("_doc", "_text_hash")
    schema = T.StructType(df.schema.fields + CUT)

    def run(batches):
        for part in tb.slices(batches, text):
            data, offsets = tb.text_bytes(part.column(text))
            body, listed = data.tobytes(), part.column("_runs")
            at, flat = np.asarray(listed.offsets), listed.flatten()
            valid, at = listed.is_valid().to_numpy(zero_copy_only=False), at - at[0]
            starts, lengths = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            rows = [_cut(body[offsets[i]:offsets[i + 1]], *((starts[at[i]:at[i + 1]], lengths[at[i]:at[i + 1]]) if valid[i] else (starts[:0], lengths[:0])))
                    for i in range(part.num_rows)]
            new = [pa.array([r[k] for r in rows], pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for k, f in enumerate(CUT)]
            kept = [c for n, c in zip(part.schema.names, part.columns, strict=True) if n != "_runs"]
            yield pa.RecordBatch.from_arrays([*kept, *new], names=[f.name for f in schema.fields])
    return joined.mapInArrow(run, schema)


def without_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """df in its own columns, texts cut to what stays (and n_chars, if df has
    it, counted anew); rows that keep no word go."""
    aside, names, back = tb.set_aside(df)
    cut = deduplicate(aside, names[doc_id], names[text]).where(F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    new = {text: F.col("kept_text")} | ({n_chars: F.length("kept_text").cast(df.schema[n_chars].dataType)} if n_chars in names else {})
    return cut.select(*[new[c].alias(c) if c in new else old for c, old in zip(df.columns, back, strict=True)])
