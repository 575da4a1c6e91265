"""LM scoring: a gated recurrent language model with a class-factored softmax, in numpy.

Texts are lower-cased (A-Z) words and one end token for each document.  Counts are taken over all training documents
(crc32 of the id's text, modulo 7, is not 2): ``base_score`` is the add-one unigram log10 probability from them.

The recurrent model reads and predicts ``CLASSES * CLASS_WORDS`` symbols: the most frequent words, the end, and one
symbol for every other word, whose probability is then shared out by the unigram counts, so that a text's score is a
proper log10 probability.  A symbol's probability is that of its class times that inside its class.  Weights start
at the unigram model and are learned by truncated backpropagation through time, from every token of every training
document once: the documents fall into ``ROUNDS`` parts by a hash, in each round every task trains a copy of the model
on its documents of that round's part, block by block, and the copies are averaged, weighted by their tokens, in a tree
of tasks, so that one copy comes to the driver.  Scoring carries the state through each whole document, window by
window.

Words are counted and looked up by their bytes; a 64-bit hash only deals them to buckets.  Texts are dealt to units
once; units ask for the counts of their distinct words, and buckets that hold the counts answer in the order asked.

Defined results: a null or empty text is its end token alone; a null id counts as training (never held out) and
keeps its row; repeated rows count and are scored each; other columns are ignored; without training documents every
word is unknown, N and V are 0, and the model is uniform over its symbols; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import units
from .shared import written
from .textbytes import LOWER, blocks, distinct_words, find_words, mix

CLASSES = 32
CLASS_WORDS = 64
STATE = 24
ROUNDS = 3
STREAMS = 256
WINDOW = 16
SCORE_WINDOW = 32
#: Documents and states that scoring takes at once.
SCORED, OUTPUT_ROWS = 512, 4096
RATES = (0.02, 0.012, 0.006)
SEED = 7

#: Symbols of the model beside words.
OTHER, END = 0, 1
#: The end as a token: no word has a space.
END_WORD = b" "
#: Words that are hashed at once, and the most bytes of one that is hashed with others.
_HASHED, _SHORT = 1 << 16, 64
#: Copies of the weights that meet in one task.
_MERGE = 16


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def tokens_of(column: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """(token numbers, distinct tokens, first token of each document and the end) of blocks of documents.

    The end is the last of the distinct tokens of a block.
    """
    for _, _, data, at in blocks(column):
        data = LOWER[data]
        words = find_words(data, at)
        which, distinct = distinct_words(data, words)
        which = np.insert(which, words.first[1:], len(distinct))
        yield which, pa.concat_arrays([distinct, pa.array([END_WORD], pa.large_binary())]), words.first + np.arange(len(words.first))


def _merged(parts: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    """Distinct words of several lists with the sums of their counts."""
    if not parts:
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    found = pa.concat_arrays([w for w, _ in parts]).dictionary_encode()
    counts = np.bincount(found.indices.to_numpy(), np.concatenate([c for _, c in parts]), len(found.dictionary))
    return found.dictionary, counts.astype(np.int64)


def _lists(cuts: np.ndarray, values: pa.Array) -> pa.Array:
    """A list column whose rows are the runs of ``values`` between cuts."""
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), values)


def _hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word: the mixed sum of its mixed (place, byte) pairs, or XXH3 of a long word."""
    words = words.cast(pa.large_binary())
    size = pc.binary_length(words).to_numpy()
    short = size <= _SHORT
    out = np.empty(len(words), np.uint64)
    if not short.all():
        out[~short] = [xxhash.xxh3_64_intdigest(w) for w in words.filter(pa.array(~short)).to_pylist()]
        words, size = words.filter(pa.array(short)), size[short]
    first, end = int(words.offset), np.cumsum(size)
    _, offsets, body = words.buffers()
    if not len(end) or not end[-1]:
        out[short] = 0
        return out
    begin = int(np.frombuffer(offsets, np.int64)[first])
    data = np.frombuffer(body, np.uint8)[begin : begin + int(end[-1])]
    place = np.arange(len(data)) - np.repeat(end - size, size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mix(data | place << 8), out=sums[1:])
    out[short] = mix(sums[end] - sums[end - size])
    return out


def _by_bucket(words: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets with words, order of the words by bucket, cuts between them); the hash deals and never decides."""
    bucket = (np.concatenate([np.zeros(0, np.uint64), *[_hashes(words[i : i + _HASHED]) for i in range(0, len(words), _HASHED)]]) >> np.uint64(33)) % np.uint64(buckets)
    order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
    size = np.bincount(bucket.astype(np.int64), minlength=buckets)
    some = np.flatnonzero(size)
    return some.astype(np.int32), order, np.append(0, np.cumsum(size[some]))


WORDS, LONGS = pa.list_(pa.field("element", pa.binary())), pa.list_(pa.field("element", pa.int64()))
COUNTS = "bucket int, words array<binary>, counts array<long>"
_COUNTS = pa.schema([("bucket", pa.int32()), ("words", WORDS), ("counts", LONGS)])


def _words(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """The words of all lists of a column, one after another."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().cast(pa.large_binary())


def _count_rows(words: pa.Array, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    some, order, cuts = _by_bucket(words, buckets)
    columns = [pa.array(some), _lists(cuts, words.take(pa.array(order)).cast(pa.binary())).cast(WORDS), _lists(cuts, pa.array(counts[order])).cast(LONGS)]
    return pa.RecordBatch.from_arrays(columns, schema=_COUNTS)


def count_words(texts: DataFrame, buckets: int) -> DataFrame:
    """Counts of all tokens of (text) rows, a row for each bucket of words."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        for batch in batches:
            for which, distinct, _ in tokens_of(batch.column(0)):
                parts.append((distinct, np.bincount(which, minlength=len(distinct))))
                size += len(distinct)
                if size > 500_000:
                    parts[:] = [_merged(parts)]
                    size = len(parts[0][0])
                    if size > 250_000:
                        yield _count_rows(*parts[0], buckets)
                        parts[:], size = [], 0
        if size:
            yield _count_rows(*_merged(parts), buckets)

    def total(table: pa.Table) -> pa.Table:
        words, counts = _merged([(_words(table.column("words")), table.column("counts").combine_chunks().flatten().to_numpy())])
        return pa.Table.from_batches([_count_rows(words, counts, 1)]).set_column(0, "bucket", pa.array([table.column("bucket")[0].as_py()], pa.int32()))

    return texts.mapInArrow(partial, COUNTS).groupBy("bucket").applyInArrow(total, COUNTS)


def summary(counts: DataFrame, most: int) -> tuple[int, int, list[tuple[bytes, int]]]:
    """All tokens, distinct tokens, and the ``most`` frequent (word, count), the end not among them."""
    schema = "part long, words array<binary>, counts array<long>, tokens long, distinct long"
    names = pa.schema([("part", pa.int64()), ("words", WORDS), ("counts", LONGS), ("tokens", pa.int64()), ("distinct", pa.int64())])

    def best(words: pa.Array, n: np.ndarray, *numbers: int) -> pa.RecordBatch:
        order = np.lexsort((np.arange(len(n)), -n))[: most + 1]
        cuts = np.array([0, len(order)])
        part, *rest = [pa.array([x], pa.int64()) for x in numbers]
        return pa.RecordBatch.from_arrays([part, _lists(cuts, words.take(pa.array(order)).cast(pa.binary())).cast(WORDS), _lists(cuts, pa.array(n[order])).cast(LONGS), *rest], schema=names)

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).flatten().to_numpy()
            yield best(_words(batch.column(1)), n, TaskContext.get().partitionId(), int(n.sum()), len(n))

    def merge(table: pa.Table) -> pa.Table:
        words = _words(table.column("words"))
        order = pc.sort_indices(words)  # equal counts by word, in whatever order the rows come
        n = table.column("counts").combine_chunks().flatten().to_numpy()[order.to_numpy()]
        sums = [sum(table.column(c).to_pylist()) for c in ("tokens", "distinct")]
        return pa.Table.from_batches([best(words.take(order), n, table.column("part")[0].as_py(), *sums)])

    found, tasks = counts.mapInArrow(top, schema), counts.rdd.getNumPartitions()
    while tasks > 1:
        found = found.withColumn("part", F.floor(F.col("part") / _MERGE)).groupBy("part").applyInArrow(merge, schema)
        tasks = -(-tasks // _MERGE)
    tokens = distinct = 0
    words: list[tuple[bytes, int]] = []
    for r in found.collect():  # bounded by the model's size: one row, or a few of one small task
        tokens, distinct = tokens + r.tokens, distinct + r.distinct
        words += [(bytes(w), n) for w, n in zip(r.words, r.counts) if bytes(w) != END_WORD]
    return tokens, distinct, sorted(words, key=lambda x: (-x[1], x[0]))[:most]


class Model:
    """Weights, forward pass, truncated backpropagation."""

    def __init__(self, words: list[bytes], prior: np.ndarray):
        """words: those of symbols 2.. ; prior: a probability for each symbol."""
        rng = np.random.default_rng(SEED)
        self.words = words
        n = CLASSES * CLASS_WORDS
        self.size = len(prior)
        full = np.zeros(n)
        full[: self.size] = np.maximum(prior, 1e-12)
        full = full.reshape(CLASSES, CLASS_WORDS)
        share = full.sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            by_class = np.where(share > 0, np.log(share), -30.0)
            inside = np.where(full > 0, np.log(full) - np.log(share)[:, None], -30.0)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.w = {
            "gates": normal(n, 3 * STATE, scale=0.3),
            "state": normal(STATE, 3 * STATE, scale=STATE**-0.5),
            "class": normal(STATE, CLASSES, scale=0.02),
            "class_bias": by_class.astype(np.float32),
            "word": normal(CLASSES, STATE, CLASS_WORDS, scale=0.02),
            "word_bias": inside.astype(np.float32),
        }

    def symbols(self, distinct: pa.Array) -> np.ndarray:
        """The symbol of each of a block's distinct tokens, the last of which is the end."""
        at = pc.index_in(distinct, pa.array(self.words, pa.large_binary())).fill_null(OTHER - 2)
        out = at.to_numpy().astype(np.int64) + 2
        out[-1] = END
        return out

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.w.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k, v in self.w.items():
            self.w[k] = flat[at : at + v.size].reshape(v.shape).astype(np.float32, copy=False)
            at += v.size

    def step(self, h: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, tuple]:
        """The next state, and what the way back needs."""
        x, u = self.w["gates"].take(symbols, 0), h @ self.w["state"]
        zr, un = x[:, : 2 * STATE] + u[:, : 2 * STATE], u[:, 2 * STATE :]
        zr *= 0.5
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        z, r = zr[:, :STATE], zr[:, STATE:]
        n = r * un
        n += x[:, 2 * STATE :]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        return new, (z, r, n, un)

    def output(self, h: np.ndarray, symbols: np.ndarray, back: bool = False):
        """Natural log probabilities of symbols given the states before them; with ``back`` the gradients too.

        The biases are one more row of the weights, for a component of the states that is always one.
        """
        dtype = h.dtype
        kind, inside = np.divmod(symbols, CLASS_WORDS)
        order = np.argsort(kind.astype(np.uint8), kind="stable")
        kind, inside, row = kind[order], inside[order], np.arange(len(h))
        own = np.ones((len(h), STATE + 1), dtype)
        own[:, :STATE] = h.take(order, 0)
        cuts = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
        by_class = np.concatenate([self.w["class"], self.w["class_bias"][None]])
        by_word = np.concatenate([self.w["word"], self.w["word_bias"][:, None]], axis=1)
        a = own @ by_class
        b = np.empty((len(h), CLASS_WORDS), dtype)
        for c in range(CLASSES):
            i, j = cuts[c], cuts[c + 1]
            if j > i:
                np.matmul(own[i:j], by_word[c], out=b[i:j])
        # no value is beyond the sum of its absolute weights, so exponentials need no shift where that is small
        most = max(1.0, float(np.abs(h).max())) if len(h) else 1.0
        if most * max(float(np.abs(by_class).sum(0).max()), float(np.abs(by_word).sum(1).max())) > 80:
            a -= a.max(1, keepdims=True)
            b -= b.max(1, keepdims=True)
        picked = a[row, kind] + b[row, inside]
        np.exp(a, out=a)
        np.exp(b, out=b)
        total, sums = a @ np.ones(CLASSES, dtype), b @ np.ones(CLASS_WORDS, dtype)
        out = np.empty(len(h), dtype)
        out[order] = picked - np.log(total) - np.log(sums)
        if not back:
            return out
        a *= (1 / total)[:, None]
        a[row, kind] -= 1
        b *= (1 / sums)[:, None]
        b[row, inside] -= 1
        d_own = a @ self.w["class"].T
        d_class, d_word = own.T @ a, np.zeros_like(by_word)
        for c in range(CLASSES):
            i, j = cuts[c], cuts[c + 1]
            if j > i:
                d_own[i:j] += b[i:j] @ self.w["word"][c].T
                np.matmul(own[i:j].T, b[i:j], out=d_word[c])
        d_h = np.empty_like(d_own)
        d_h[order] = d_own
        return out, d_h, {"class": d_class[:STATE], "class_bias": d_class[STATE], "word": d_word[:, :STATE], "word_bias": d_word[:, STATE]}

    def gradients(self, symbols: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> tuple[float, dict, np.ndarray]:
        """Loss, gradients and last state of a window (time, streams); fresh: a document starts there."""
        (t_max, streams), dtype = symbols.shape, h.dtype
        keep = (~fresh[:, :, None]).astype(dtype)
        before, z, r, n, un = np.empty((5, t_max, streams, STATE), dtype=dtype)
        for t in range(t_max):
            before[t] = h * keep[t]
            h, (z[t], r[t], n[t], un[t]) = self.step(before[t], symbols[t])
        logp, d_out, found = self.output(before.reshape(-1, STATE), symbols.ravel(), back=True)
        d_out = d_out.reshape(before.shape)
        by_n, by_z, by_r = (1 - z) * (1 - n * n), (before - n) * z * (1 - z), un * r * (1 - r)
        d_gates, d_u = np.empty((2, t_max, streams, 3 * STATE), dtype=dtype)
        back, d_h = self.w["state"].T.copy(), np.zeros_like(h)
        for t in range(t_max - 1, -1, -1):
            d = d_gates[t]
            d[:, 2 * STATE :] = d_h * by_n[t]
            d[:, :STATE] = d_h * by_z[t]
            d[:, STATE : 2 * STATE] = d[:, 2 * STATE :] * by_r[t]
            d_u[t] = d
            d_u[t, :, 2 * STATE :] *= r[t]
            d_h *= z[t]
            d_h += d_u[t] @ back
            d_h += d_out[t]
            d_h *= keep[t]
        ids = symbols.ravel()
        order = np.argsort(ids.astype(np.uint16), kind="stable")
        ids = ids[order]
        starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        d_table = np.zeros_like(self.w["gates"])
        d_table[ids[starts]] = np.add.reduceat(d_gates.reshape(-1, 3 * STATE)[order], starts)
        found |= {"gates": d_table, "state": before.reshape(-1, STATE).T @ d_u.reshape(-1, 3 * STATE)}
        return -float(logp.sum()), found, h

    def train(self, symbols: np.ndarray, fresh: np.ndarray, rate: float, adam: dict) -> int:
        """One pass of Adam over a token sequence, cut into parallel streams; ``adam`` (empty at first) carries its
        state to the next sequence.  Returns how many tokens of the sequence the streams took."""
        streams = max(1, min(STREAMS, len(symbols) // (4 * WINDOW)))
        length = len(symbols) // streams
        x, f = (v[: streams * length].reshape(streams, length).T for v in (symbols, fresh))
        h, flat = np.zeros((streams, STATE), np.float32), self.flat()
        if not adam:
            adam |= {"steps": 0, "mean": np.zeros_like(flat), "square": np.zeros_like(flat)}
        mean, square, done = adam["mean"], adam["square"], adam["steps"]
        for i, t in enumerate(range(0, length, WINDOW), done + 1):
            adam["steps"] = i
            window = x[t : t + WINDOW]
            _, found, h = self.gradients(window, f[t : t + WINDOW], h)
            g = np.concatenate([found[k].ravel() for k in self.w])
            g /= window.size
            mean *= 0.9
            mean += 0.1 * g
            g *= g
            square *= 0.99
            square += 0.01 * g
            np.sqrt(square / (1 - 0.99**i), out=g)
            g += 1e-6
            flat -= (rate / (1 - 0.9**i)) * mean / g
            self.load(flat)
        return streams * length

    def score(self, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Natural log probability of each whole document, its state carried from window to window.

        Documents of about equal length are scored side by side, so many that their states stay in the processor's cache.
        """
        length = np.diff(first)
        order = np.argsort(-length, kind="stable")
        out = np.zeros(len(length))
        for i in range(0, len(order), SCORED):
            some = order[i : i + SCORED]
            out[some] = self._score(symbols, first[:-1][some], length[some])
        return out

    def _score(self, symbols: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Scores of documents in descending order of length."""
        total = np.zeros(len(length))
        h = np.zeros((len(length), STATE), np.float32)
        for t0 in range(0, int(length[0]), SCORE_WINDOW):
            t1 = min(t0 + SCORE_WINDOW, int(length[0]))
            active = np.searchsorted(-length, -np.arange(t0, t1)).tolist()  # documents longer than t
            states, ids = np.empty((sum(active), STATE), np.float32), np.empty(sum(active), np.int64)
            at = 0
            for t, a in zip(range(t0, t1), active):
                h = h[:a]
                states[at : at + a], ids[at : at + a] = h, symbols[begin[:a] + t]
                h, _ = self.step(h, ids[at : at + a])
                at += a
            logp = [self.output(states[i : i + OUTPUT_ROWS], ids[i : i + OUTPUT_ROWS]) for i in range(0, len(ids), OUTPUT_ROWS)]
            logp, at = np.concatenate(logp).astype(np.float64), 0
            for a in active:
                total[:a] += logp[at : at + a]
                at += a
        return total


def learn(texts: DataFrame, model: Model) -> int:
    """Rounds of training in the tasks, averaged; ``texts`` has the column text.  Returns the tokens learned from."""
    tokens = 0
    for number in range(ROUNDS):
        share = texts.select("text").filter(F.pmod(F.xxhash64(F.col("text"), F.lit("round")), F.lit(ROUNDS)) == number)
        flat, rate, words = model.flat(), RATES[number], model.words

        def run(batches: Iterator[pa.RecordBatch], flat=flat, rate=rate) -> Iterator[pa.RecordBatch]:
            own, adam, learned = Model(words, np.ones(1)), {}, 0
            own.load(flat)
            symbols, fresh = np.zeros(0, np.int64), np.zeros(0, dtype=bool)
            for batch in batches:
                for which, distinct, first in tokens_of(batch.column(0)):
                    begins = np.zeros(len(which), dtype=bool)
                    begins[first[:-1]] = True
                    symbols, fresh = np.concatenate([symbols, own.symbols(distinct)[which]]), np.concatenate([fresh, begins])
                    if len(symbols) >= 4 * STREAMS * WINDOW:
                        taken = own.train(symbols, fresh, rate, adam)
                        symbols, fresh, learned = symbols[taken:], fresh[taken:], learned + taken
            while len(symbols):
                taken = own.train(symbols, fresh, rate, adam)
                symbols, fresh, learned = symbols[taken:], fresh[taken:], learned + taken
            if learned:
                weights = (own.flat().astype(np.float64) * learned).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([learned], pa.int64()), pa.array([weights], pa.binary())], ["part", "tokens", "weights"])

        def add(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(w, np.float64) for w in table.column("weights").to_pylist())
            return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int64()), "tokens": [sum(table.column("tokens").to_pylist())], "weights": [total.tobytes()]})

        schema, tasks = "part long, tokens long, weights binary", share.rdd.getNumPartitions()
        found = share.mapInArrow(run, schema)
        while tasks > 1:
            found = found.withColumn("part", F.floor(F.col("part") / _MERGE)).groupBy("part").applyInArrow(add, schema)
            tasks = -(-tasks // _MERGE)
        for r in found.collect():  # one row
            model.load(np.frombuffer(r.weights, np.float64) / r.tokens)
            tokens += r.tokens
    return tokens


ASK = "bucket int, unit int, words array<binary>"
ANSWER = "unit int, bucket int, counts array<long>"
_ASK = pa.schema([("bucket", pa.int32()), ("unit", pa.int32()), ("words", WORDS)])
_ANSWER = pa.schema([("unit", pa.int32()), ("bucket", pa.int32()), ("counts", LONGS)])


def _unit_words(table: pa.Table) -> tuple[list, pa.Array]:
    """The blocks of a unit, with places of their distinct tokens among those of the unit, in one order at every visit."""
    here = list(tokens_of(table.column("__text")))
    if not here:
        return [], pa.array([], pa.large_binary())
    found = pa.concat_arrays([d for _, d, _ in here]).dictionary_encode()
    places = np.split(found.indices.to_numpy(), np.cumsum([len(d) for _, d, _ in here])[:-1])
    return [(*x, at) for x, at in zip(here, places)], found.dictionary


def _reply(asks: pa.Table, counts: pa.Table) -> pa.Table:
    """The count of every word in the order asked, 0 for unknown ones."""
    asked = asks.column("words").combine_chunks()
    held, n = pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    if counts.num_rows:
        held, n = _words(counts.column("words")), counts.column("counts").combine_chunks().flatten().to_numpy()
    n = np.append(n, 0)
    at = pc.index_in(_words(asked), held).fill_null(len(n) - 1).to_numpy()
    cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(asked).to_numpy())])
    found = [asks.column("unit").combine_chunks(), asks.column("bucket").combine_chunks(), _lists(cuts, pa.array(n[at])).cast(LONGS)]
    return pa.Table.from_arrays(found, schema=_ANSWER)


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    buckets = units.bucket_count(docs)
    training = docs.filter(~held_out(key)).select(F.col(text).cast("string").alias("text"))
    counts = written(count_words(training.select("text"), buckets), "counts")
    n, v, words = summary(counts, CLASSES * CLASS_WORDS - 2)
    ends = training.count() if n else 0
    room = n + v + 1
    prior = np.array([0.0, ends + 1.0, *[c + 1.0 for _, c in words]]) / room
    prior[OTHER] = max(1 - prior.sum(), 1e-9)
    if not n:
        prior[:] = 1 / len(prior)
    model = Model([w for w, _ in words], prior)
    learn(training, model)
    log_other = math.log(prior[OTHER])
    dealt = units.deal(docs, key, text)

    def ask(table: pa.Table) -> pa.Table:
        unit, distinct = table.column("__unit")[0].as_py(), _unit_words(units.in_order(table))[1]
        some, order, cuts = _by_bucket(distinct, buckets)
        words = _lists(cuts, distinct.take(pa.array(order)).cast(pa.binary())).cast(WORDS)
        return pa.Table.from_arrays([pa.array(some), pa.array([unit] * len(some), pa.int32()), words], schema=_ASK)

    asks = dealt.groupBy("__unit").applyInArrow(ask, ASK)
    replies = asks.groupBy("bucket").cogroup(counts.groupBy("bucket")).applyInArrow(_reply, ANSWER)

    def work(table: pa.Table, found: pa.Table) -> pa.Table:
        here, every = _unit_words(table)
        some, order, cuts = _by_bucket(every, buckets)
        answers = found.combine_chunks().sort_by("bucket")
        if answers.column("bucket").to_pylist() != some.tolist():
            raise ValueError("answers that do not fit the words asked for")
        count = np.zeros(len(every), np.int64)
        count[order] = answers.column("counts").combine_chunks().flatten().to_numpy()
        tokens, known, base, symbols, rest = [], [], [], [], []
        for which, distinct, first, places in here:
            c = count[places]
            value, own = np.log((c + 1) / room), model.symbols(distinct)
            tokens.append(np.diff(first))
            known.append(np.add.reduceat(c[which] > 0, first[:-1], dtype=np.int64))
            base.append(np.add.reduceat(value[which], first[:-1]))
            # a word outside the model shares its symbol's probability by the unigram counts, if there are any
            rest.append(np.add.reduceat(np.where(own == OTHER, (value - log_other) * bool(n), 0)[which], first[:-1]))
            symbols.append(own[which].astype(np.int32))
        size = np.concatenate([np.zeros(0, np.int64), *tokens])
        starts = np.concatenate([[0], np.cumsum(size)])
        recurrent = model.score(np.concatenate([np.zeros(0, np.int32), *symbols]), starts)
        join = lambda x, t: np.concatenate([np.zeros(0, t), *x])
        return pa.table(
            {
                "doc_id": table.column("__id"),
                "n_tokens": pa.array(size),
                "n_known": pa.array(join(known, np.int64)),
                "train_tokens": pa.array(np.full(len(size), n, np.int64)),
                "base_score": pa.array(join(base, float) / math.log(10)),
                "score": pa.array((recurrent + join(rest, float)) / math.log(10)),
            }
        )

    rows = units.finish(dealt, replies, work, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
