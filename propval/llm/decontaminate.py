"""Benchmark decontamination by templates.

A text becomes a template: its words without outer punctuation, lower-cased,
with numbers, names (capitalised words inside a sentence) and units (after a
number) replaced by typed placeholders.  Windows of ``WINDOW`` template words
are hash-joined between documents and benchmark items, so a question meets
its copies with other numbers or names.  Matches on one diagonal (document
place - item place) are one run; a run counts if the slots agree: an item's
value always stands for the same value in the document.

A document contains an item if a run covers ``MIN_COVERED`` of its words, or
all of a shorter item, and at least ``MIN_AGREEING`` of its slots agree.
Windows match by their template if ``LITERALS`` of their words are no
placeholders.  Windows with placeholders also match by their words as they
stand (lower-cased), however many are placeholders, so a verbatim copy always
joins.  A window is dense if fewer than ``MIN_LITERAL`` of its words are
literal and a slot changed; dense windows alone prove little, so a run that
needs them must cover ``DENSE_COVERED`` of its item, with ``DENSE_LITERALS``
literal words.  Ids are integers.  The opening word of an item matches as a literal and as a name,
since a copy may stand inside a sentence.  Items of fewer than ``SHORTEST`` words are too short to be told
from common prose and match nothing.

The benchmark's windows reach the documents as a Bloom filter of 2^FILTER_BITS
to 2^MOST_BITS bits by the number of windows; what passes is written once.  A
window that many items and documents share, as a common opening, doesn't join
all of their pairs: a run that counts covers ``MIN_COVERED`` words, so it holds
two windows 5 to 12 places apart (the first, and the next one that ends 13
words behind its start); an item of 9 to 12 words is covered by its first and
last window, a shorter one is a window.  Documents and items join on both
windows and their distance; the diagonals found this way fetch all their
windows.

Defined results: null and empty texts have no window; null ids are kept and
reported; rows with equal id and text are one document; repeated items are
reported each under their id (equal ids with other texts as one item, by the
best run); empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propval.llm import textbytes as tb
from propval.llm.store import written

WINDOW = 8
SHORTEST = 5
MIN_COVERED = 13
MIN_LITERAL = 0.6
LITERALS = 3
DENSE_COVERED = 0.8
DENSE_LITERALS = 5
MIN_AGREEING = 0.8
FILTER_BITS = 24
MOST_BITS = 28
LEAST_GAP = MIN_COVERED - WINDOW
MOST_GAP = LEAST_GAP + WINDOW - 1
#: Words that are units after a number.
UNITS = ("%", "percent", "mm", "cm", "m", "km", "meter", "meters", "metre", "metres", "kilometers", "inch", "inches", "feet", "foot", "ft",
         "yards", "mile", "miles", "mg", "g", "kg", "gram", "grams", "kilograms", "pound", "pounds", "lb", "lbs", "oz", "ounces", "ml", "l",
         "liter", "liters", "litre", "litres", "gallons", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours",
         "day", "days", "week", "weeks", "month", "months", "year", "years", "dollars", "dollar", "cents", "euros", "euro", "usd", "eur", "mph", "degrees")

NUMBER, NAME, UNIT = (tb.mix(np.array([i], tb.U))[0] for i in (1001, 1002, 1003))
_byte = np.arange(256)
IS_DIGIT = (_byte >= 48) & (_byte <= 57)
IS_UPPER = (_byte >= 65) & (_byte <= 90)
IS_LOWER = (_byte >= 97) & (_byte <= 122)
IS_INNER = IS_DIGIT | IS_UPPER | IS_LOWER | (_byte >= 128)
IS_STOP = np.isin(_byte, list(b".!?:"))


def _unit_hashes() -> np.ndarray:
    data, offsets = tb.text_bytes(pa.array(UNITS))
    return np.unique(tb.SpanHash(data, lower=True)(offsets[:-1], offsets[1:]))


_units = _unit_hashes()


def templates(texts: pa.Array, inside: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Of every word: text number, template hash, value hash, and whether it
    is a placeholder; and the number of texts.  inside: a text's first word
    is taken as one inside a sentence."""
    data, offsets = tb.text_bytes(texts)
    start, end, owner = tb.words(data, offsets)
    n = len(data)
    place = np.arange(n)
    inner = IS_INNER[data]
    after = np.minimum.accumulate(np.where(inner, place, n)[::-1])[::-1] if n else place      # the next inner byte
    before = np.maximum.accumulate(np.where(inner, place, -1)) if n else place                # the last inner byte
    unit_sign = (end - start == 1) & (data[start] == 37) if len(start) else np.zeros(0, bool)
    first, last = after[start] if len(start) else start, before[end - 1] + 1 if len(start) else end
    first, last = np.where(unit_sign, start, first), np.where(unit_sign, end, last)
    full = first < last
    digits = np.concatenate([[0], np.cumsum(IS_DIGIT[data])])
    lowers = np.concatenate([[0], np.cumsum(IS_LOWER[data] | (data >= 128))])
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    stops = np.concatenate([[0], np.cumsum(IS_STOP[data])])
    ends_sentence = stops[end] > stops[np.maximum(last, start)]
    opens = np.ones(len(start), bool)                        # the first word of a sentence, a line or a text
    opens[1:] = (owner[1:] != owner[:-1]) | ends_sentence[:-1] | (breaks[start[1:]] > breaks[end[:-1]])
    first, last, owner, opens = first[full], last[full], owner[full], opens[full]
    if inside:
        opens[1:] &= owner[1:] == owner[:-1]
        opens[:1] = False
    value = tb.SpanHash(data, lower=True)(first, last)
    is_number = digits[last] > digits[first]
    wide = (data[first] == 0xC3) & (data[np.minimum(first + 1, max(n - 1, 0))] <= 0x9E) if len(first) else np.zeros(0, bool)
    head = (IS_UPPER[data[first]] if len(first) else np.zeros(0, bool)) | wide
    is_name = head & ~is_number & ~opens & (lowers[last] > lowers[np.minimum(first + 1 + wide, last)])
    is_unit = np.zeros(len(first), bool)
    is_unit[1:] = np.isin(value[1:], _units) & is_number[:-1] & (owner[1:] == owner[:-1]) & ~is_number[1:]
    template = np.select([is_number, is_unit, is_name], [NUMBER, UNIT, NAME], value).astype(tb.U)
    return owner, template, value, is_number | is_name | is_unit, len(offsets) - 1


def template_windows(texts: pa.Array, lengths: list[int]) -> tuple[np.ndarray, ...]:
    """(text number, place, length, hash) of the windows with enough literal
    words and, by their words, of all with placeholders; and every word's
    place, value and placeholder mark."""
    owner, template, value, slot, docs = templates(texts)
    nth = np.arange(len(owner)) - np.searchsorted(owner, owner, "left")
    slots = np.concatenate([[0], np.cumsum(slot)])
    out = []
    for n in lengths:
        at, key = tb.windows(template, owner, n)
        n_slots = slots[at + n] - slots[at]
        ok = n - n_slots >= LITERALS
        out.append((at[ok], np.full(ok.sum(), n), key[ok]))
        some = n_slots > 0                                   # without a placeholder the template is the words
        at, key = tb.windows(value, owner, n)
        out.append((at[some], np.full(some.sum(), n), key[some]))
    at, length, key = (np.concatenate(x) for x in zip(*out, strict=True))
    return owner, nth, value, slot, at, length, key, np.bincount(owner, minlength=docs)


def _slots(at: np.ndarray, length: np.ndarray, value: np.ndarray, slot: np.ndarray) -> list[bytes]:
    """The values of each window's words, 0 for literal words."""
    shown = np.where(slot, value | tb.U(1), tb.U(0))
    return [shown[a:a + n].tobytes() for a, n in zip(at, length, strict=True)]


WINDOWS = "key long, id long, text_hash long, place long, size long, words long, slots binary, next array<struct<gap:long,next_key:long>>"


def _next(at: np.ndarray, size: np.ndarray, key: np.ndarray, owner: np.ndarray) -> pa.ListArray:
    """Of every window: itself (gap 0) and the windows of the same text that
    begin 1 to MOST_GAP places later, both of WINDOW words."""
    whole = np.flatnonzero(size == WINDOW)
    whole = whole[np.argsort(at[whole], kind="stable")]
    places = at[whole]
    of, gap, to = [np.arange(len(at))], [np.zeros(len(at), np.int64)], [np.arange(len(at))]
    for g in range(1, MOST_GAP + 1):
        then = np.minimum(at + g, max(len(owner) - 1, 0))
        ok = (size == WINDOW) & (then == at + g) & (owner[then] == owner[at])
        low, high = np.searchsorted(places, at + g, "left"), np.searchsorted(places, at + g, "right")
        n = np.where(ok, high - low, 0)
        i = np.repeat(np.arange(len(at)), n)
        of.append(i)
        gap.append(np.full(len(i), g))
        to.append(whole[low[i] + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)])
    of, gap, to = np.concatenate(of), np.concatenate(gap), np.concatenate(to)
    order = np.argsort(of, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(at)))])
    pairs = pa.StructArray.from_arrays([pa.array(gap[order], pa.int64()), pa.array(key[to[order]].view(np.int64))], names=["gap", "next_key"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)


def _benchmark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in tb.slices(batches, "text"):
        owner, nth, value, slot, at, length, key, words = template_windows(part.column("text"), list(range(SHORTEST, WINDOW + 1)))
        use = (length == WINDOW) | (words[owner[at]] == length)          # a short item is one window
        found = [(at[use], length[use], key[use], _slots(at[use], length[use], value, slot))]
        _, template, _, slot, _ = templates(part.column("text"), inside=True)
        for n in range(SHORTEST, WINDOW + 1):                            # the first windows, should a name open them
            at, key = tb.windows(template, owner, n)
            slots = np.concatenate([[0], np.cumsum(slot)])
            use = (nth[at] == 0) & (template[at] == NAME) & (n - slots[at + n] + slots[at] >= LITERALS) & ((words[owner[at]] == n) | (n == WINDOW))
            size = np.full(use.sum(), n)
            found.append((at[use], size, key[use], _slots(at[use], size, value, slot)))
        at, size, key, shown = zip(*found, strict=True)
        yield _rows(part, owner, nth, np.concatenate(at), np.concatenate(size), np.concatenate(key), sum(shown, []), words)


def _rows(part, owner, nth, at, length, key, slots, words) -> pa.RecordBatch:
    own = pa.array(owner[at])
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), part.column("id").take(own), part.column("text_hash").take(own), pa.array(nth[at]),
                                       pa.array(length), pa.array(words[owner[at]]), pa.array(slots, pa.binary()), _next(at, length, key, owner)],
                                      names=["key", "id", "text_hash", "place", "size", "words", "slots", "next"])


def _bits(windows: DataFrame) -> np.ndarray:
    """A Bloom filter of the keys, as words of 64 bits: at least 16 bits a
    window, within its bounds."""
    n = windows.count()
    size = min(max(FILTER_BITS, int(16 * n).bit_length()), MOST_BITS)
    bit = F.col("key").bitwiseAND((1 << size) - 1)
    words = (windows.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("bits")).toPandas())
    out = np.zeros(1 << (size - 6), np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.view(tb.U)


def _keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), F.col(text).alias("text"))


RUN = "doc_id long, text_hash long, item_id long, covered long, item_words long, n_slots long, n_changed long, agreeing double"


def _run(windows: list[tuple[int, int, np.ndarray, np.ndarray]]) -> tuple[int, int, int, float, int]:
    """Of a diagonal's windows: words that they cover in one piece, slots, slots
    that changed, share that agrees, and literal words."""
    best, seen, begin, total, pairs = 0, -1, 0, 0, {}
    for place, size, item, doc in windows:
        if place > seen:
            begin = place
        total += place + size - max(seen, place)
        seen = place + size
        best = max(best, seen - begin)
        for k in np.flatnonzero(item | doc):                 # a slot on one side: matched by the word itself
            a, b = int(item[k]), int(doc[k])
            pairs[place + int(k)] = (a or b, b or a)
    stands: dict[int, dict[int, int]] = {}
    for a, b in pairs.values():
        stands.setdefault(a, {}).setdefault(b, 0)
        stands[a][b] += 1
    agree = sum(max(v.values()) for v in stands.values())
    return best, len(pairs), sum(a != b for a, b in pairs.values()), agree / len(pairs) if pairs else 1.0, total - len(pairs)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The run of a diagonal's windows, of all if those that aren't dense don't
    suffice and it holds enough of the item."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            windows = [(w["place"], w["size"], np.frombuffer(w["item_slots"], tb.U), np.frombuffer(w["doc_slots"], tb.U)) for w in r["windows"]]
            firm = [w for w in windows if np.count_nonzero(w[2]) <= (1 - MIN_LITERAL) * w[1] or not np.any((w[2] != w[3]) & (w[2] > 0) & (w[3] > 0))]
            run = _run(firm)
            if len(firm) < len(windows) and not (run[0] >= min(MIN_COVERED, r["words"]) and run[3] >= MIN_AGREEING):
                whole = _run(windows)
                if whole[0] >= DENSE_COVERED * r["words"] and whole[4] >= DENSE_LITERALS:
                    run = whole
            rows.append((r["doc_id"], r["text_hash"], r["item_id"], run[0], r["words"], *run[1:4]))
        names = [c.split()[0] for c in RUN.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], pa.float64() if k == 7 else pa.int64()) for k in range(8)], names=names)


def _seeds(found: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, i_hash, diagonal: the diagonals on which a
    document has two windows of an item that a counting run must have."""
    words, gap = F.col("words"), F.col("gap")
    far = F.when(words <= WINDOW, gap == 0).when(words < MIN_COVERED, (F.col("i_place") == 0) & (gap == words - WINDOW)).otherwise(gap >= LEAST_GAP)
    own = (items.select("key", F.inline("next"), F.col("id").alias("item_id"), F.col("text_hash").alias("i_hash"), F.col("place").alias("i_place"), "words")
           .where(far).drop("words"))
    theirs = found.select("key", F.inline("next"), F.col("id").alias("doc_id"), "text_hash", "place")
    return (theirs.join(own, ["key", "next_key", "gap"])
            .select("doc_id", "text_hash", "item_id", "i_hash", (F.col("place") - F.col("i_place")).alias("diagonal")).distinct())


def _matched(found: DataFrame, items: DataFrame) -> DataFrame:
    """All common windows of the diagonals of :func:`_seeds`."""
    item = items.select(F.col("key").alias("i_key"), F.col("id").alias("own_id"), F.col("text_hash").alias("own_hash"), F.col("place").alias("i_place"),
                        F.col("words").alias("item_words"), F.col("slots").alias("item_slots"))
    wanted = (_seeds(found, items).join(item, F.col("item_id").eqNullSafe(F.col("own_id")) & (F.col("i_hash") == F.col("own_hash")))
              .withColumn("at", F.col("i_place") + F.col("diagonal")).drop("own_id", "own_hash"))
    theirs = found.select(F.col("key").alias("d_key"), F.col("id").alias("d_id"), F.col("text_hash").alias("d_hash"), F.col("place").alias("d_place"), "size", "slots")
    same = (F.col("i_key") == F.col("d_key")) & (F.col("text_hash") == F.col("d_hash")) & (F.col("at") == F.col("d_place")) & F.col("doc_id").eqNullSafe(F.col("d_id"))
    return wanted.join(theirs, same)


def contained(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, covered, item_words, n_slots, n_changed,
    agreeing, kind): a row for each document and item that it contains; kind
    is exact if no slot changed."""
    items = written(_keyed(benchmark, item_id, "text").mapInArrow(_benchmark, WINDOWS))
    shared = docs.sparkSession.sparkContext.broadcast((_bits(items), sorted(r[0] for r in items.select("size").distinct().collect())))

    def run(batches):
        bits, lengths = shared.value
        mask = tb.U(64 * len(bits) - 1)
        if not lengths:
            return
        for part in tb.slices(batches, "text"):
            owner, nth, value, slot, at, length, key, words = template_windows(part.column("text"), lengths)
            low = key & mask
            use = (bits[(low >> tb.U(6)).astype(np.int64)] >> (key & tb.U(63))) & tb.U(1) == 1
            at, length, key = at[use], length[use], key[use]
            yield _rows(part, owner, nth, at, length, key, _slots(at, length, value, slot), words)
    found = written(_keyed(docs, doc_id, text).mapInArrow(run, WINDOWS))
    diagonals = (_matched(found, items).groupBy("doc_id", "text_hash", "item_id", "i_hash", "diagonal")
                 .agg(F.sort_array(F.collect_set(F.struct(F.col("i_place").alias("place"), "size", "item_slots", F.col("slots").alias("doc_slots")))).alias("windows"),
                      F.first("item_words").alias("words")))
    best = F.struct("agreeing_enough", "covered", "agreeing", "item_words", "n_slots", "n_changed")
    return (diagonals.mapInArrow(_runs, RUN)
            .withColumn("agreeing_enough", F.col("agreeing") >= MIN_AGREEING)
            .where((F.col("covered") >= F.least(F.lit(MIN_COVERED), F.col("item_words"))) & F.col("agreeing_enough"))
            .groupBy("doc_id", "text_hash", "item_id").agg(F.max(best).alias("b"))
            .select("doc_id", "text_hash", "item_id", "b.covered", "b.item_words", "b.n_slots", "b.n_changed", "b.agreeing",
                    F.when(F.col("b.n_changed") == 0, "exact").otherwise("template").alias("kind")))


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The best row of :func:`contained` for each doc_id and item_id."""
    rows = contained(docs, benchmark, doc_id, item_id, text)
    rest = [c for c in rows.columns if c not in ("doc_id", "item_id", "text_hash")]
    return rows.groupBy("doc_id", "item_id").agg(F.max(F.struct(*rest)).alias("b")).select("doc_id", "item_id", "b.*")


def clean_rows(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, in its own columns, without the rows that contain an item."""
    hit = contained(docs, benchmark, doc_id, text=text).select(F.col("doc_id").alias("_hit_id"), F.col("text_hash").alias("_hit_hash")).distinct()
    same = F.col(doc_id).eqNullSafe(F.col("_hit_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_hit_hash"))
    return docs.join(hit, same, "left_anti")
