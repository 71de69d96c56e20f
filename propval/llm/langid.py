"""Language identification with a byte convolutional network.

Bytes are embedded; filters of several widths slide over fixed-length
windows of the text, each keeps its largest response (max pooling), and a
softmax over the pooled responses gives the language.  The network is
trained in numpy with Adam on a bounded, documented sample of labelled
rows and applied to all windows of every whole text, in batches; a text's
prediction is the mean over its windows, by their length.

Defined results: a text that is null or has no letter is ``und`` with score
0, as is every text when no labelled row is there to learn from; rows are
predicted one by one, so repeated rows agree and null ids change nothing; an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propval.llm import textbytes as tb

WINDOW = 256             # bytes of a window
WIDTHS = (2, 3, 4, 5)    # bytes that a filter sees
FILTERS = 8              # filters of each width
EMBED = 8
EPOCHS, RATE, BATCH = 4, 0.01, 64
DOCS_PER_LANG = 300      # bound of the training sample
WINDOWS_PER_DOC = 4
MAX_LANGS = 500          # languages, by number of labelled rows, that are learned
UNKNOWN = "und"


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray                      # (256, EMBED)
    filters: list[np.ndarray]              # by width: (width, EMBED, FILTERS)
    bias: np.ndarray                       # (all filters,)
    out: np.ndarray                        # (all filters, languages)
    out_bias: np.ndarray

    def tables(self) -> list[np.ndarray]:
        """By place in the filter: what each byte value adds to the responses
        of all filters that are as wide, the widest first."""
        return [np.concatenate([self.embed @ w[o] for w in self.filters[::-1] if len(w) > o], axis=1).astype(np.float32)
                for o in range(max(WIDTHS))]


def responses(windows: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """(rows, places, filters, the widest first) of windows of bytes."""
    r = np.take(tables[0], windows, axis=0)
    for o, t in enumerate(tables[1:], 1):
        r[:, :-o, :t.shape[1]] += np.take(t, windows[:, o:], axis=0)
    return r


def pooled(windows: np.ndarray, lengths: np.ndarray, tables: list[np.ndarray], where: bool = False):
    """Largest responses (rows, all filters by width) of windows, and where
    they are, if asked for.  A place counts if its filter is inside the
    window's length; the first place counts anyway."""
    r, best, at = responses(windows, tables), [], []
    short = np.flatnonzero(lengths < windows.shape[1])
    for k, width in enumerate(WIDTHS):
        c = (len(WIDTHS) - 1 - k) * FILTERS
        own = r[:, :windows.shape[1] - width + 1, c:c + FILTERS]
        for i in short:
            own[i, max(1, lengths[i] - width + 1):] = -np.inf
        if where:
            at.append(own.argmax(axis=1))
        best.append(own.max(axis=1))
    best = np.concatenate(best, axis=1)
    return (best, at) if where else best


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts: (text number, bytes padded with 0, length)."""
    n = np.diff(offsets)
    count = -(-n // WINDOW)
    owner = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[owner] + k * WINDOW
    length = np.minimum(WINDOW, offsets[owner + 1] - start)
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start] if len(start) else np.zeros((0, WINDOW), np.uint8)
    return owner, np.where(np.arange(WINDOW) < length[:, None], windows, 0), length


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, langs: list[str], seed: int = 42) -> Network:
    """Adam on the cross entropy.  Max pooling passes each filter's gradient
    to one place, so only the bytes there are touched."""
    rng = np.random.default_rng(seed)
    every = len(WIDTHS) * FILTERS
    net = Network(langs, rng.normal(0, 0.5, (256, EMBED)), [rng.normal(0, (w * EMBED) ** -0.5, (w, EMBED, FILTERS)) for w in WIDTHS],
                  np.zeros(every), rng.normal(0, every ** -0.5, (every, len(langs))), np.zeros(len(langs)))
    values = [net.embed, *net.filters, net.bias, net.out, net.out_bias]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    weight = 1 / np.maximum(np.bincount(labels, minlength=len(langs)), 1)
    weight = weight / weight[labels].mean()
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for i in range(0, len(order), BATCH):
            b = order[i:i + BATCH]
            size = np.where(rng.random(len(b)) < 0.5, rng.integers(8, WINDOW + 1, len(b)), WINDOW).clip(max=lengths[b])   # short texts come too
            part = np.where(np.arange(WINDOW) < size[:, None], windows[b], 0)
            best, at = pooled(part, size, net.tables(), where=True)
            hidden = np.maximum(best + net.bias, 0)
            share = _softmax(hidden @ net.out + net.out_bias)
            share[np.arange(len(b)), labels[b]] -= 1
            share *= weight[labels[b]][:, None] / len(b)
            grads = [np.zeros_like(v) for v in values]
            grads[-2], grads[-1] = hidden.T @ share, share.sum(axis=0)
            back = (share @ net.out.T) * (hidden > 0)
            grads[-3] = back.sum(axis=0)
            for k, (w, place) in enumerate(zip(WIDTHS, at, strict=True)):
                g = back[:, k * FILTERS:(k + 1) * FILTERS]
                for o in range(w):
                    byte = np.take_along_axis(part, place + o, 1)                # (rows, FILTERS)
                    grads[1 + k][o] = np.einsum("rfe,rf->ef", net.embed[byte], g)
                    np.add.at(grads[0], byte, g[:, :, None] * net.filters[k][o].T[None])
            step += 1
            for v, g, m, s in zip(values, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return net


def predict(net: Network, texts: pa.Array) -> np.ndarray:
    """Mean share of each language over the windows of each text."""
    data, offsets = tb.text_bytes(texts)
    owner, windows, lengths = cut(data, offsets)
    total = np.zeros((len(offsets) - 1, len(net.langs)))
    tables = net.tables()
    for i in range(0, len(owner), 16):                # responses that stay in the cache
        s = slice(i, i + 16)
        hidden = np.maximum(pooled(windows[s], lengths[s], tables) + net.bias, 0)
        np.add.at(total, owner[s], _softmax(hidden @ net.out + net.out_bias) * lengths[s][:, None])
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def _sample(labelled: DataFrame, label: str, text: str) -> list[tuple[str, str]]:
    """About DOCS_PER_LANG rows of each label, at most that many, chosen by a
    hash of the text: a threshold for each label first, so that no task gets
    more than about the bound, then the smallest hashes."""
    counts = [(r[0], r[1]) for r in labelled.groupBy(label).count().orderBy(F.desc("count"), label).limit(MAX_LANGS).collect()]
    if not counts:
        return []
    share = F.create_map(*[x for lang, n in counts for x in (F.lit(lang), F.lit(min(1.0, 2 * DOCS_PER_LANG / n)))])[F.col(label)]
    place = F.pmod(F.xxhash64(F.lit(42), text), F.lit(1 << 20)) / float(1 << 20)
    rows = (labelled.withColumn("_place", place).where(F.col("_place") < share)
            .groupBy(label).applyInArrow(lambda t: t.sort_by("_place").slice(0, DOCS_PER_LANG).select([label, text]).cast(
                pa.schema([(label, pa.string()), (text, pa.string())])), f"`{label}` string, `{text}` string"))
    return [(r[0], r[1]) for r in rows.collect()]


def fit(labelled: DataFrame, label: str = "lang", text: str = "text", seed: int = 42) -> Network | None:
    """A network from rows with a label and a letter in the text."""
    rows = _sample(labelled.select(label, text).where(F.col(label).isNotNull() & _has_letter(F.col(text))), label, text)
    if not rows:
        return None
    rows.sort()
    langs = sorted({r[0] for r in rows})
    data, offsets = tb.text_bytes(pa.array([r[1] for r in rows]))
    owner, windows, lengths = cut(data, offsets)
    rng = np.random.default_rng(seed)
    order = np.lexsort((rng.random(len(owner)), owner))
    nth = np.arange(len(order)) - np.searchsorted(owner[order], owner[order], "left")
    use = order[nth < WINDOWS_PER_DOC]
    labels = np.searchsorted(langs, [rows[i][0] for i in owner[use]])
    return train(windows[use], lengths[use], labels, langs, seed)


def _has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


def identify(df: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """df with lang_pred and score (input columns of these names go)."""
    df = tb.without(df, [f.name for f in FIELDS])
    if net is None:
        return df.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = df.sparkSession.sparkContext.broadcast(net)       # a few thousand numbers

    def of(texts):
        share = predict(shared.value, texts)
        best = share.argmax(axis=1) if len(share) else np.zeros(0, np.int64)
        return [pa.array(np.array(shared.value.langs, object)[best], pa.string()), pa.array(np.clip(share.max(axis=1, initial=0), 0, 1))]
    letter = _has_letter(F.col(text))
    return tb.append_columns(df, text, FIELDS, of).withColumns({
        "lang_pred": F.when(letter, F.col("lang_pred")).otherwise(F.lit(UNKNOWN)), "score": F.when(letter, F.col("score")).otherwise(F.lit(0.0))})


def held_out(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text is 1 modulo ``parts``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == 1, F.lit(False))
