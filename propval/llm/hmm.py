"""Hidden Markov language model over the words of a corpus.

Tokens are the lower-cased (A-Z) words of a text and one end.  Latent states
emit emission classes: each of the ``TOP_WORDS`` most frequent training words
and the end is a class, every other word belongs to one of ``BUCKETS``
classes by its hash and has, in its class, the share (c + 0.5) / (T + 0.5 (V
+ 1)) of its training count c (T, V: tokens and distinct words of the class),
so the model covers every word with a bounded table of emissions.

Training is Baum-Welch: every task runs scaled forward and backward
recursions over its documents, in segments of ``SEGMENT`` tokens (those after
a document's first begin in the chain's stationary distribution), and the
expected counts are summed over all partitions; every iteration covers all
training documents, and they go on until one raises the log-likelihood by
less than ``SETTLED`` of it.  They start from all training documents dealt to
the states by a random projection of their words, so documents with like words
begin in one state, however many there are.

Scoring is exact for whole texts: the scaled forward recursions of all texts
of a batch advance together in numpy, token by token.  A long text advances in
pieces of ``STEP`` tokens at once: each piece's recursion is a matrix, and the
product of the text's matrices is its scaled forward recursion.

The counts of rare words stay distributed: tokens outside the bounded table
meet their counts in a join.

Defined results: a null or empty text is one end; a null id is not held out;
rows with equal id and text get equal results; without training documents
every count is 0; an empty table gives an empty result.  Words are told apart
by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propval.llm import textbytes as tb
from propval.llm.store import written

TOP_WORDS = 60_000
BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
STATES = 8
SETTLED = 1e-4
SEGMENT = 128
STEP = 64
LONG = 2048              # tokens of a text that is scored in pieces
PRIOR = 3.0              # tokens, spread over the states, that each class begins with
FLUSH_WORDS = 1 << 20


@dataclass
class Vocabulary:
    words: np.ndarray        # hashes of the top words, ascending
    counts: np.ndarray       # their training counts
    bucket_tokens: np.ndarray
    bucket_words: np.ndarray
    docs: int                # training documents, so ends
    tokens: int              # N, ends included
    distinct: int            # V, the end included

    @property
    def end(self) -> int:
        return len(self.words) + BUCKETS

    @property
    def share(self) -> np.ndarray:
        """Share of each class among the training tokens, smoothed."""
        n = np.concatenate([self.counts, self.bucket_tokens, [self.docs]]) + 0.5
        return n / n.sum()


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(hash, text number) of every word, and the number of texts."""
    data, offsets = tb.text_bytes(texts)
    start, end, owner = tb.words(data, offsets)
    return tb.SpanHash(data, lower=True)(start, end), owner, len(offsets) - 1


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0

    def flush():
        word, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])
    for part in tb.slices(batches, "text"):
        word, _, _ = _tokens(part.column("text"))
        held.append(word)
        rows += len(word)
        if rows >= FLUSH_WORDS:
            yield flush()
            held, rows = [], 0
    if rows:
        yield flush()


def vocabulary(training: DataFrame, text: str = "text") -> tuple[DataFrame, Vocabulary]:
    """(word, n) of all training words, and the bounded tables."""
    counts = written(training.select(F.col(text).alias("text")).mapInArrow(_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    level = F.floor(F.log2("n") * 16)
    by_level = sorted(((r[0], r[1]) for r in counts.groupBy(level).count().collect()), reverse=True)
    total, least = 0, float("inf")
    for at, n in by_level:                                 # whole levels of frequency, as many as fit
        total += n
        if total > TOP_WORDS:
            break
        least = at
    is_top = level >= F.lit(least)
    top = counts.where(is_top).toPandas()
    words = top["word"].to_numpy(np.int64).view(tb.U)
    order = np.argsort(words)
    bucket_tokens, bucket_words = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for b, t, w in counts.where(~is_top).groupBy(F.shiftrightunsigned("word", 64 - BUCKET_BITS)).agg(F.sum("n"), F.count("*")).collect():
        bucket_tokens[b], bucket_words[b] = t, w
    docs = training.count()
    n = top["n"].to_numpy(np.int64)[order]
    return counts, Vocabulary(words[order], n, bucket_tokens, bucket_words, docs, int(n.sum() + bucket_tokens.sum()) + docs,
                              len(words) + int(bucket_words.sum()) + (docs > 0))


def _classes(word: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Class of every word, and whether it is a top word."""
    if not len(v.words):
        return (word >> tb.U(64 - BUCKET_BITS)).astype(np.int64), np.zeros(len(word), bool)
    at = np.minimum(np.searchsorted(v.words, word), len(v.words) - 1)
    top = v.words[at] == word
    return np.where(top, at, len(v.words) + (word >> tb.U(64 - BUCKET_BITS)).astype(np.int64)), top


ENCODED = ("doc_id long, held_out boolean, text_hash long, classes binary, n_tokens long, n_top long, n_rare long, "
           "top_log double, rare_log double")


def encode(keyed: DataFrame, v: Vocabulary) -> DataFrame:
    """A row for each text: its classes (uint16, the end last) and the sums
    over its tokens that need no join."""
    shared = keyed.sparkSession.sparkContext.broadcast(v)

    def run(batches):
        v = shared.value
        log_top = np.log10(v.counts + 0.5)
        log_bucket = np.log10(v.bucket_tokens + 0.5 * (v.bucket_words + 1))
        for part in tb.slices(batches, "text"):
            word, owner, docs = _tokens(part.column("text"))
            cls, top = _classes(word, v)
            n, n_top = np.bincount(owner, minlength=docs), np.bincount(owner[top], minlength=docs)
            top_log = np.bincount(owner[top], log_top[cls[top]], docs) + np.log10(v.docs + 0.5)
            rare_log = np.bincount(owner[~top], log_bucket[cls[~top] - len(v.words)], docs).astype(float)   # of nothing: long
            body = np.insert(cls, np.cumsum(n), v.end).astype(np.uint16)
            to = np.cumsum(n + 1)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("held_out"), part.column("text_hash"),
                pa.array([body[e - k - 1:e].tobytes() for e, k in zip(to, n, strict=True)], pa.binary()),
                pa.array(n + 1), pa.array(n_top), pa.array(n - n_top), pa.array(top_log), pa.array(rare_log)],
                names=[c.split()[0] for c in ENCODED.split(", ")])
    return keyed.mapInArrow(run, ENCODED)


def _rare(keyed: DataFrame, v: Vocabulary) -> DataFrame:
    """(doc_id, text_hash, word, n) of the words outside the bounded table."""
    shared = keyed.sparkSession.sparkContext.broadcast(v)

    def run(batches):
        for part in tb.slices(batches, "text"):
            word, owner, _ = _tokens(part.column("text"))
            rare = ~_classes(word, shared.value)[1]
            word, owner = word[rare], owner[rare]
            order = np.lexsort((word, owner))
            word, owner = word[order], owner[order]
            first = np.ones(len(word), bool)
            first[1:] = (word[1:] != word[:-1]) | (owner[1:] != owner[:-1])
            at = np.flatnonzero(first)
            own = pa.array(owner[at])
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(own), part.column("text_hash").take(own), pa.array(word[at].view(np.int64)),
                                              pa.array(np.diff(np.append(at, len(word))))], names=["doc_id", "text_hash", "word", "n"])
    return keyed.mapInArrow(run, "doc_id long, text_hash long, word long, n long")


@dataclass
class Model:
    start: np.ndarray        # (states,)
    move: np.ndarray         # (states, states)
    emit: np.ndarray         # (classes, states): probability of the class in the state

    @property
    def stationary(self) -> np.ndarray:
        p = np.full(len(self.start), 1 / len(self.start))
        for _ in range(200):
            p = p @ self.move
        return p / p.sum()


def _unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = tb.text_bytes(column)
    return data.view(np.uint16), offsets // 2


def _pieces(offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, length) of the texts cut into pieces, the longest first."""
    n = np.diff(offsets)
    count = -(-n // size)
    owner = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[owner] + k * size
    return owner, start, np.minimum(size, offsets[owner + 1] - start)


def expected(model: Model, tokens: np.ndarray, offsets: np.ndarray, emit: np.ndarray, move: np.ndarray, start: np.ndarray) -> float:
    """Adds the expected counts of the texts to emit, move and start; returns
    the log-likelihood of the segments.  Each segment's recursion is scaled at
    every token and runs in single precision, its sums in double."""
    stationary, model = model.stationary.astype(np.float32), Model(*(x.astype(np.float32, copy=False) for x in (model.start, model.move, model.emit)))
    owner, at, length = _pieces(offsets, SEGMENT)
    first = np.zeros(len(owner), bool)
    first[np.unique(owner, return_index=True)[1]] = True
    order, log = np.argsort(-length, kind="stable"), 0.0
    k = len(model.start)
    for i in range(0, len(order), 2048):
        piece = order[i:i + 2048]
        n, begin, is_first = length[piece], at[piece], first[piece]
        steps = int(n.max())
        live = [int(np.searchsorted(-n, -t, "left")) for t in range(steps)]         # pieces longer than t come first
        cls = [tokens[begin[:m] + t] for t, m in enumerate(live)]
        b = [model.emit[c] for c in cls]
        alpha, scale = [], []
        x = np.where(is_first[:, None], model.start, stationary)
        for t, m in enumerate(live):
            x = (x[:m] if t == 0 else x[:m] @ model.move) * b[t]
            s = x.sum(axis=1, keepdims=True)
            x = x / s
            alpha.append(x)
            scale.append(s)
        beta = np.ones((live[-1], k), np.float32)
        gammas = [None] * steps
        for t in range(steps - 1, -1, -1):
            m = live[t]
            if len(beta) < m:
                beta = np.concatenate([beta, np.ones((m - len(beta), k), np.float32)])
            gammas[t] = alpha[t] * beta
            if t:
                back = b[t] * beta / scale[t]
                move += model.move * (alpha[t - 1][:m].T @ back)
                beta = back @ model.move.T
        start += gammas[0][is_first].sum(axis=0)
        gamma, c = np.concatenate(gammas), np.concatenate(cls)
        for state in range(k):
            emit[:, state] += np.bincount(c, gamma[:, state], len(emit))
        log += sum(float(np.log(s).sum(dtype=float)) for s in scale)
    return log


def maximised(v: Vocabulary, emit: np.ndarray, move: np.ndarray, start: np.ndarray) -> Model:
    """Emissions from the states' shares of each class, held towards the
    states' shares of all tokens, and the corpus' share of the class."""
    state = (emit.sum(axis=0) + 1) / (emit.sum() + emit.shape[1])
    emit = (emit + PRIOR * state) / (emit.sum(axis=1, keepdims=True) + PRIOR) * v.share[:, None]
    move, start = move + 1.0, start + 1.0
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _summed(encoded: DataFrame, v: Vocabulary, value, add) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Sums over all rows of encoded of what add(value, tokens, offsets, emit,
    move, start) adds to the counts, and of what it returns.  Row -1 - k has the
    moves from state k, row -1 - STATES the starts, the one below the returned
    sum, others the emissions of a class."""
    shared = encoded.sparkSession.sparkContext.broadcast(value)
    sums = [f"s{k}" for k in range(STATES)]

    def run(batches):
        emit, move, start = np.zeros((v_end + 1, STATES)), np.zeros((STATES, STATES)), np.zeros(STATES)
        log = np.zeros(STATES)
        for batch in tb.slices(batches, "classes"):
            log[0] += add(shared.value, *_unpack(batch.column("classes")), emit, move, start)
        some = np.flatnonzero(emit.any(axis=1))
        rows = np.concatenate([-1 - np.arange(STATES + 2), some])
        values = np.concatenate([move, start[None], log[None], emit[some]])
        for i in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(rows[i:i + 10_000]), *(pa.array(values[i:i + 10_000, k]) for k in range(STATES))], names=["row", *sums])
    v_end = v.end
    got = (encoded.select("classes").mapInArrow(run, "row long, " + ", ".join(f"{s} double" for s in sums))
           .groupBy("row").agg(*[F.sum(s).alias(s) for s in sums]).toPandas().sort_values("row"))
    row, values = got["row"].to_numpy(), got[sums].to_numpy()
    emit, move, start = np.zeros((v.end + 1, STATES)), np.zeros((STATES, STATES)), np.zeros(STATES)
    log = 0.0
    emit[row[row >= 0]] = values[row >= 0]
    for r, x in zip(row[row < 0], values[row < 0], strict=True):
        if r == -2 - STATES:
            log = float(x[0])
        elif r == -1 - STATES:
            start = x
        else:
            move[-1 - r] = x
    return emit, move, start, log


def dealt(weight: np.ndarray, tokens: np.ndarray, offsets: np.ndarray, emit: np.ndarray, move: np.ndarray, start: np.ndarray) -> float:
    """Adds the texts' tokens to emit, each text in the state of its largest projection."""
    n = np.diff(offsets)
    owner = np.repeat(np.arange(len(n)), n)
    state = np.stack([np.bincount(owner, weight[tokens, k], len(n)) for k in range(STATES)], axis=1).argmax(axis=1)[owner]
    for k in range(STATES):
        emit[:, k] += np.bincount(tokens[state == k], minlength=len(emit))
    return 0.0


def first_states(encoded: DataFrame, v: Vocabulary, seed: int = 42) -> Model:
    """A model of all documents dealt to the states."""
    weight = np.random.default_rng(seed).standard_normal((v.end + 1, STATES))
    emit, _, _, _ = _summed(encoded, v, weight - v.share @ weight, dealt)
    return maximised(v, emit, 50.0 * np.eye(STATES), np.zeros(STATES))


def baum_welch(encoded: DataFrame, v: Vocabulary, model: Model) -> tuple[Model, float]:
    """One iteration over all rows of encoded, and the log-likelihood before it."""
    emit, move, start, log = _summed(encoded, v, model, expected)
    return maximised(v, emit, move, start), log


def train(encoded: DataFrame, v: Vocabulary) -> Model:
    """encoded: rows of training documents."""
    model, last = first_states(encoded, v), -np.inf
    while True:
        model, log = baum_welch(encoded, v, model)
        if not np.isfinite(log):
            raise FloatingPointError(f"the log-likelihood of the training documents is {log}")
        if log - last <= SETTLED * abs(log):
            return model
        last = log


def log10_likelihood(model: Model, tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """log10 of the probability of each text's classes: exact scaled forward
    recursion, token by token for all texts at once; a text of more than
    ``LONG`` tokens as the product of its pieces' matrices."""
    n = np.diff(offsets)
    out, short = np.zeros(len(n)), np.flatnonzero(n <= LONG)
    out[short] = _forward(model, tokens, offsets[:-1][short], n[short])
    for i in np.flatnonzero(n > LONG):
        out[i] = _by_pieces(model, tokens[offsets[i]:offsets[i + 1]], np.array([0, n[i]]))[0]
    return out


def _forward(model: Model, tokens: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    out, order = np.zeros(len(n)), np.argsort(-n, kind="stable")
    for i in range(0, len(order), 4096):
        some = order[i:i + 4096]
        at, lengths = begin[some], n[some]
        x, log = model.start * model.emit[tokens[at]], np.zeros(len(some))
        for t in range(1, int(lengths.max())):
            m = int(np.searchsorted(-lengths, -t, "left"))            # texts longer than t come first
            x[:m] = (x[:m] @ model.move) * model.emit[tokens[at[:m] + t]]
            if t % 8 == 0:
                s = x[:m].sum(axis=1)
                x[:m] /= s[:, None]
                log[:m] += np.log10(s)
        out[some] = log + np.log10(x.sum(axis=1))
    return out


def _by_pieces(model: Model, tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The pieces of all texts as matrices, advanced together."""
    owner, at, length = _pieces(offsets, STEP)
    k = len(model.start)
    matrix, log = np.tile(np.eye(k), (len(owner), 1, 1)), np.zeros(len(owner))
    order = np.argsort(-length, kind="stable")
    for i in range(0, len(order), 4096):
        piece = order[i:i + 4096]
        n, begin = length[piece], at[piece]
        x, scale = matrix[piece], np.zeros(len(piece))
        first = begin == offsets[owner[piece]]
        for t in range(int(n.max())):
            m = int(np.searchsorted(-n, -t, "left"))
            y = x[:m] if t else x
            y = (y.reshape(-1, k) @ model.move).reshape(-1, k, k)
            if t == 0 and first.any():
                y[first] = x[first]                        # the first token of a text comes from start, not from a move
            x[:m] = y[:m] * model.emit[tokens[begin[:m] + t]][:, None, :]
            if t % 8 == 7 or t == int(n.max()) - 1:
                s = x.max(axis=(1, 2))
                x /= s[:, None, None]
                scale += np.log10(s)
        matrix[piece], log[piece] = x, scale
    out = np.bincount(owner, log, len(offsets) - 1).astype(float)
    nth = np.arange(len(owner)) - np.searchsorted(owner, owner, "left")
    state = np.tile(model.start, (len(offsets) - 1, 1))
    by_nth = np.argsort(nth, kind="stable")                # piece by piece, all texts at once
    edges = np.searchsorted(nth[by_nth], np.arange(nth.max(initial=-1) + 2))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        p = by_nth[a:b]
        y = np.einsum("pi,pij->pj", state[owner[p]], matrix[p])
        s = y.sum(axis=1)
        state[owner[p]] = y / s[:, None]
        out[owner[p]] += np.log10(s)
    return out


def score(df: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score of every row; learns from the rows where the column ``held_out``
    is false."""
    keyed = df.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.coalesce(text, F.lit("")).alias("text")).withColumn(
        "text_hash", F.xxhash64("text"))
    counts, v = vocabulary(keyed.where("not held_out"))
    encoded = written(encode(keyed, v))
    model = encoded.sparkSession.sparkContext.broadcast(train(encoded.where("not held_out"), v))

    def run(batches):
        names = [c.split()[0] for c in ENCODED.split(", ") if not c.startswith("classes")]
        for part in tb.slices(batches, "classes"):
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(log10_likelihood(model.value, *_unpack(part.column("classes"))))],
                                             names=[*names, "states_log"])
    own = encoded.mapInArrow(run, ENCODED.replace("classes binary, ", "") + ", states_log double")
    rare = (_rare(keyed, v).join(counts.withColumnRenamed("n", "c"), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
            .groupBy("doc_id", "text_hash").agg(F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("log"), F.sum("n").alias("rows_n"),
                                                F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"))
            .withColumnsRenamed({"doc_id": "r_id", "text_hash": "r_hash"}))
    both = own.join(rare, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")), "left")
    copies = F.coalesce(F.col("rows_n") / F.col("n_rare"), F.lit(1.0))              # rows with equal id and text sum up
    rare_log = F.coalesce(F.col("log") / copies, F.lit(0.0))
    known = F.coalesce(F.col("known") / copies, F.lit(0.0)).cast("long")
    return both.select("doc_id", "held_out", "n_tokens", (F.col("n_top") + known + F.lit(int(v.docs > 0))).alias("n_known"),
                       F.lit(v.tokens).cast("long").alias("train_tokens"),
                       (F.col("top_log") + rare_log - F.col("n_tokens") * F.lit(float(np.log10(v.tokens + 0.5 * (v.distinct + 1))))).alias("base_score"),
                       (F.col("states_log") + rare_log - F.col("rare_log")).alias("score"))
