"""A gated recurrent language model: training by truncated backpropagation, scores of whole documents.

Three things are gathered from the corpus: counts of all training words; the model's parameters, each training round's
being the token-weighted mean of what all tasks learned from its part of the training documents; and nothing else. The
rounds' parts are disjoint and together hold every training document, at every size of corpus.

The softmax is factored: first a class, then a word of the class. The model knows the most frequent words and the end
mark; every other word is "unknown" to it, and gets the unknown word's probability times its share of the unknown
words' counts, so that the whole is a distribution over words. Its output biases start at the counts' log-probabilities.
Scoring resets the state at a document's start and carries it over all its windows, however many.

Words are known by 64-bit hashes. The most frequent `HEAD_WORDS` are sent to all tasks; counts of rarer ones are joined.
Texts are read twice: for the counts, and to be stored as model ids of two bytes a token, which rounds and scores read.
A task cuts the texts of `ENCODED` documents at once and hashes and looks up each different word of theirs once.

Defined results: null and empty texts consist of the end alone; a null id counts as the empty text in the split;
repeated rows count and score each for itself; with no training documents all counts are 0 and the model is the base;
an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditmill.llm.common import BLANKS, remainder, saved, text_or_empty, words_of

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEAD_WORDS = 200_000
CLASSES = 32
WORDS = CLASSES * CLASSES  # of the model, with the end (1) and the unknown word (0)
EMBED = HIDDEN = 16
ROUNDS, LANES, WINDOW, RATE = 2, 192, 24, 0.02
#: Updates that a task makes at least, while it has the text for as many windows.
UPDATES = 100
#: Tokens that a task learns from or scores together: enough to fill the lanes, few enough to bound its memory.
CHUNK = 2_000_000
#: Positions whose softmax is taken at once.
SLICE = 8192
#: Tokens of a scoring window over all running documents, and documents encoded at once: they bound a task's memory.
SCORED, ENCODED = 131_072, 1024
LN10 = np.log(10.0)


# --- Words and their hashes ------------------------------------------------------------------------------------------

def token_hashes(text: Column) -> Column:
    return F.transform(words_of(F.translate(text, CAPITALS, SMALL)), lambda w: F.xxhash64(w))


#: Bytes of UTF-8 with A-Z in lower case; which of them part words.
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_BLANK = np.isin(np.arange(256), list(BLANKS.encode()))
_PRIMES = np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxhash64(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Spark's `xxhash64` of each of the byte strings that lie one after the other in `data`."""
    p1, p2, p3, p4, p5 = _PRIMES
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight, four = (np.ndarray(len(data) + 1, kind, padded, strides=(1,)) for kind in ("<u8", "<u4"))  # at any byte
    at, left = offsets[:-1].copy(), np.diff(offsets)
    with np.errstate(over="ignore"):
        seed = np.uint64(42)
        mixed = lambda x: _rotated(x * p2, 31) * p1
        h = np.full(len(left), seed + p5)
        long = np.flatnonzero(left >= 32)
        if len(long):  # stripes of four blocks, the longest strings in front
            long = long[np.argsort(-left[long], kind="stable")]
            stripes = left[long] // 32
            lanes = [np.full(len(long), first) for first in (seed + p1 + p2, seed + p2, seed, seed - p1)]
            for stripe in range(int(stripes[0])):
                n = int(np.searchsorted(-stripes, -stripe, "left"))
                for k, lane in enumerate(lanes):
                    lane[:n] = _rotated(lane[:n] + eight[at[long[:n]] + (32 * stripe + 8 * k)] * p2, 31) * p1
            own = sum(_rotated(lane, by) for lane, by in zip(lanes, (1, 7, 12, 18)))
            for lane in lanes:
                own = (own ^ mixed(lane)) * p1 + p4
            h[long] = own
            at[long] += 32 * stripes
            left[long] -= 32 * stripes
        h += np.diff(offsets).astype(np.uint64)
        while len(some := np.flatnonzero(left >= 8)):
            h[some] = _rotated(h[some] ^ mixed(eight[at[some]]), 27) * p1 + p4
            at[some] += 8
            left[some] -= 8
        some = np.flatnonzero(left >= 4)
        h[some] = _rotated(h[some] ^ (four[at[some]].astype(np.uint64) * p1), 23) * p2 + p3
        at[some] += 4
        left[some] -= 4
        while len(some := np.flatnonzero(left > 0)):
            h[some] = _rotated(h[some] ^ (padded[at[some]].astype(np.uint64) * p5), 11) * p1
            at[some] += 1
            left[some] -= 1
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the different words of texts, which of them stands at each place, and where each text's words begin."""
    offsets = _offsets(texts)
    held = texts.buffers()[2]
    data = _LOWER[np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]]] if held and held.size else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = ~_BLANK[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]  # a text's end parts words too
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    first = np.flatnonzero(opens)
    bounds = np.concatenate([[0], np.cumsum(np.flatnonzero(closes) + 1 - first)])
    spelled = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[inside])]
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), spelled).dictionary_encode()
    words = coded.dictionary
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    letters = np.frombuffer(words.buffers()[2], np.uint8)[at[0] : at[-1]] if len(words) else np.empty(0, np.uint8)
    return xxhash64(letters, at - at[0]), coded.indices.to_numpy(), np.searchsorted(first, offsets)


def _offsets(texts: pa.StringArray) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(1, np.int64)
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


# --- The network -----------------------------------------------------------------------------------------------------

SHAPES = {
    "embed": (WORDS, EMBED), "w": (EMBED, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,),
    "class_w": (HIDDEN, CLASSES), "class_b": (CLASSES,),
    "word_w": (CLASSES, HIDDEN, CLASSES), "word_b": (CLASSES, CLASSES),
}
SIZES = {k: int(np.prod(s)) for k, s in SHAPES.items()}
Params = dict[str, np.ndarray]


def unpacked(flat: np.ndarray) -> Params:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        out[name] = flat[at : at + SIZES[name]].reshape(shape).astype(np.float32)
        at += SIZES[name]
    return out


def packed(params: Params) -> np.ndarray:
    return np.concatenate([params[name].ravel() for name in SHAPES])


def initial(counts: np.ndarray) -> Params:
    """Small random weights, output biases from the counts of the model's words."""
    rng = np.random.default_rng(11)
    out = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in SHAPES.items()}
    by_class = counts.reshape(CLASSES, CLASSES)
    sums = by_class.sum(1)
    out["class_b"] = np.log(sums / sums.sum()).astype(np.float32)
    out["word_b"] = np.log(by_class / sums[:, None]).astype(np.float32)
    out["class_w"] *= 0
    out["word_w"] *= 0
    out["b"] *= 0
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def gates(p: Params, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of the recurrent unit; x is the input's share, W e + b."""
    hu = h @ p["u"]
    rz = _sigmoid(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
    r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
    n = np.tanh(x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
    return n + z * (h - n), r, z, n, hu[:, 2 * HIDDEN :]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    e /= e.sum(1, keepdims=True)
    return e


def _log_prob_of(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """ln softmax(x) at one place of each row."""
    most = x.max(1)
    return x[np.arange(len(x)), chosen] - most - np.log(np.exp(x - most[:, None]).sum(1))


def _summed(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Per row number the sum of its values."""
    rows = rows.astype(np.uint16)  # short numbers sort by radix
    order = np.argsort(rows, kind="stable")
    ranked = rows[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    out = np.zeros((size, values.shape[1]), values.dtype)
    out[ranked[starts]] = np.add.reduceat(values[order], starts, axis=0)
    return out


def _by_class(targets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    classes = (targets // CLASSES).astype(np.uint16)
    order = np.argsort(classes, kind="stable")
    bounds = np.searchsorted(classes[order], np.arange(CLASSES + 1))
    for c in range(CLASSES):
        if bounds[c] < bounds[c + 1]:
            yield c, order[bounds[c] : bounds[c + 1]]


def log_probs(p: Params, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """ln P(target | state), class first."""
    out = np.empty(len(targets), states.dtype)
    for start in range(0, len(targets), SLICE):
        part = slice(start, start + SLICE)
        out[part] = _log_prob_of(states[part] @ p["class_w"] + p["class_b"], targets[part] // CLASSES)
    for c, at in _by_class(targets):
        out[at] += _log_prob_of(states[at] @ p["word_w"][c] + p["word_b"][c], targets[at] % CLASSES)
    return out


class Trainer:
    """Truncated backpropagation with Adam over lanes of running text."""

    def __init__(self, params: Params):
        self.p = params
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}
        self.steps, self.tokens, self.full = 0, 0, LANES * WINDOW

    def learn(self, tokens: np.ndarray, first: np.ndarray) -> None:
        """tokens: documents one after the other, each with its end; first: True where a document starts."""
        # Few tokens make fewer lanes rather than fewer updates.
        lanes = min(LANES, max(1, len(tokens) // (UPDATES * WINDOW)))
        self.full = lanes * WINDOW
        steps = len(tokens) // lanes
        cut = steps * lanes
        self._learn_lanes(tokens[:cut].reshape(lanes, steps), first[:cut].reshape(lanes, steps))
        if cut < len(tokens):
            self._learn_lanes(tokens[None, cut:], first[None, cut:])

    def _learn_lanes(self, tokens: np.ndarray, first: np.ndarray) -> None:
        h = np.zeros((len(tokens), HIDDEN), np.float32)
        previous = np.ones(len(tokens), np.int64)
        for at in range(0, tokens.shape[1], WINDOW):
            y, start = tokens[:, at : at + WINDOW].astype(np.int64), first[:, at : at + WINDOW]
            x = np.concatenate([previous[:, None], y[:, :-1]], 1)
            x = np.where(start, 1, x)  # a document starts as if after an end
            previous = y[:, -1]
            h = self._window(x, y, ~start, h)

    def _window(self, x: np.ndarray, y: np.ndarray, keep: np.ndarray, h: np.ndarray) -> np.ndarray:
        p, (lanes, steps) = self.p, y.shape
        e = p["embed"][x.T]  # step by step from here on
        wx = e @ p["w"] + p["b"]
        keep = keep.T[:, :, None].astype(wx.dtype)
        befores, states, r, z, n, un = (np.empty((steps, lanes, HIDDEN), wx.dtype) for _ in range(6))
        for t in range(steps):
            befores[t] = h * keep[t]
            h, r[t], z[t], n[t], un[t] = gates(p, wx[t], befores[t])
            states[t] = h
        g, d_states = self._output_grads(states.reshape(-1, HIDDEN), y.T.ravel())
        d_states = d_states.reshape(steps, lanes, HIDDEN)
        # What each gate passes on of the state's gradient, for all steps at once.
        to_n = (1 - z) * (1 - n * n)
        to_r, to_z = un * r * (1 - r), (befores - n) * z * (1 - z)
        d_wx, d_hu, dh, back = np.empty_like(wx), np.empty_like(wx), np.zeros_like(h), p["u"].T.copy()
        for t in reversed(range(steps)):
            dh += d_states[t]
            dn = dh * to_n[t]
            step = d_hu[t]
            step[:, :HIDDEN] = dn * to_r[t]
            step[:, HIDDEN : 2 * HIDDEN] = dh * to_z[t]
            step[:, 2 * HIDDEN :] = dn * r[t]
            d_wx[t, :, 2 * HIDDEN :] = dn
            dh = (dh * z[t] + step @ back) * keep[t]
        d_wx[:, :, : 2 * HIDDEN] = d_hu[:, :, : 2 * HIDDEN]
        d_u = befores.reshape(-1, HIDDEN).T @ d_hu.reshape(-1, 3 * HIDDEN)
        flat = d_wx.reshape(-1, 3 * HIDDEN)
        g["u"], g["w"], g["b"] = d_u, e.reshape(-1, EMBED).T @ flat, flat.sum(0)
        g["embed"] = _summed(x.T.ravel(), flat @ p["w"].T, len(p["embed"]))
        self._update(g, lanes * steps)
        return h

    def _output_grads(self, states: np.ndarray, targets: np.ndarray) -> tuple[Params, np.ndarray]:
        p = self.p
        d = _softmax(states @ p["class_w"] + p["class_b"])
        d[np.arange(len(targets)), targets // CLASSES] -= 1
        g: Params = {"class_w": states.T @ d, "class_b": d.sum(0), "word_w": np.zeros_like(p["word_w"]), "word_b": np.zeros_like(p["word_b"])}
        d_states = d @ p["class_w"].T
        for c, at in _by_class(targets):
            own = states[at]
            d = _softmax(own @ p["word_w"][c] + p["word_b"][c])
            d[np.arange(len(at)), targets[at] % CLASSES] -= 1
            g["word_w"][c], g["word_b"][c] = own.T @ d, d.sum(0)
            d_states[at] += d @ p["word_w"][c].T
        return g, d_states

    def _update(self, grads: Params, tokens: int) -> None:
        self.steps += 1
        self.tokens += tokens
        scale = min(1.0, tokens / self.full)  # short windows, at a task's end, move less
        first, second = 1 - 0.9**self.steps, 1 - 0.99**self.steps
        for k, g in grads.items():
            g = np.clip(g / tokens, -0.1, 0.1)
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            self.p[k] -= (scale * RATE / first) * self.m[k] / (np.sqrt(self.v[k] / second) + 1e-6)


def scored_documents(p: Params, documents: list[np.ndarray]) -> np.ndarray:
    """ln P of each document (model ids, the end included), with the state carried from its start to its end."""
    out = np.zeros(len(documents))
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    lengths = np.array([len(documents[i]) for i in order])
    wx = p["embed"] @ p["w"] + p["b"]  # a row per word
    h, previous = np.zeros((len(order), HIDDEN), np.float32), np.ones(len(order), np.int64)
    # Windows of all documents at once, longest first, so those still running stay in front; the fewer, the wider.
    at, longest = 0, int(lengths[0]) if len(order) else 0
    while at < longest:
        running = int(np.searchsorted(-lengths, -at, "left"))
        width = min(max(8, SCORED // running), 1024, longest - at)
        y = np.full((running, width), -1, np.int64)
        for i in range(running):
            part = documents[order[i]][at : at + width]
            y[i, : len(part)] = part
        live = (y >= 0).sum(0)
        states, targets, owners = [], [], []
        for t in range(width):
            n = int(live[t])
            h[:n] = gates(p, wx[previous[:n]], h[:n])[0]
            previous[:n] = y[:n, t]
            states.append(h[:n].copy())
            targets.append(y[:n, t])
            owners.append(n)
        logs = log_probs(p, np.concatenate(states), np.concatenate(targets))
        ids = np.concatenate([np.arange(n) for n in owners])
        out[np.array(order)[:running]] += np.bincount(ids, logs, running)
        at += width
    return out


# --- Counts, rounds and scores on Spark ------------------------------------------------------------------------------


@dataclass
class Counts:
    """Totals, and the frequent words: hash (sorted), count, id in the model."""

    tokens: int
    distinct: int
    ends: int
    keys: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    model_counts: np.ndarray
    rest_tokens: int
    rest_distinct: int

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position in the table and whether the word is in it."""
        if not len(self.keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return at, self.keys[at] == hashes

    def model_ids(self, hashes: np.ndarray) -> np.ndarray:
        at, known = self.find(hashes)
        return np.where(known, self.ids[at], 0) if len(self.keys) else np.zeros(len(hashes), np.int64)


def split(docs: DataFrame) -> DataFrame:
    """Documents with their part; `hashes` are the words as expressions see them, and cost nothing where nobody reads them."""
    text = text_or_empty()
    held_out = (remainder(F.col("doc_id"), 5) == 1).alias("held_out")
    return docs.select("doc_id", held_out, text.alias("text"), token_hashes(text).alias("hashes"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (whole.slice(at, ENCODED) for whole in batches for at in range(0, whole.num_rows, ENCODED))


def _count_worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        hashes, codes, _ = word_hashes(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(np.bincount(codes, minlength=len(hashes)))], ["h", "n"])


def word_counts(tokens: DataFrame) -> DataFrame:
    """Stored (h, c) of all words of the training documents."""
    words = tokens.where("NOT held_out").select("text").mapInArrow(_count_worker, "h bigint, n bigint")
    return saved(words.groupBy("h").agg(F.sum("n").alias("c")), "lm_counts")


def totals(counts: DataFrame, ends: int) -> Counts:
    words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    head = counts.orderBy(F.desc("c"), "h").limit(HEAD_WORDS).toArrow()  # bounded
    h, c = head["h"].to_numpy(), head["c"].to_numpy()
    ids = np.zeros(len(h), np.int64)
    ids[: WORDS - 2] = np.arange(2, min(len(h), WORDS - 2) + 2)
    model_counts = np.full(WORDS, 1e-3)  # words that a small corpus lacks
    known = c[: WORDS - 2]
    model_counts[2 : 2 + len(known)] = known
    model_counts[1] = ends + 0.5
    rest_tokens, rest_distinct = int(words - known.sum()), int(distinct - len(known))
    model_counts[0] = rest_tokens + 0.5 * (rest_distinct + 1)
    order = np.argsort(h)
    return Counts(
        int(words) + ends, int(distinct) + (ends > 0), ends, h[order], c[order], ids[order], model_counts, rest_tokens, rest_distinct
    )


_ENCODED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("logs", pa.float64()),
     ("unknown_logs", pa.float64()), ("n_unknown", pa.int64()), ("ids", pa.binary()), ("rare", pa.list_(pa.int64()))]
)
_ENCODED_SQL = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, unknown_logs double, n_unknown bigint, "
    "ids binary, rare array<bigint>"
)


def _encode_worker(counts) -> Callable:
    """Model ids of each document, its end included, and all that its score takes from the counts of frequent words; rare
    words come back as hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Counts(**counts.value)
        logs = np.log10(known.counts + 0.5)
        end_log = np.log10(known.ends + 0.5)
        for batch in _slices(batches):
            hashes, codes, offsets = word_hashes(batch.column(2))
            at, found = known.find(hashes)
            there = found[codes]
            ids = np.where(found, known.ids[at], 0)[codes] if len(known.ids) else np.zeros(len(codes), np.int64)
            own = np.where(found, logs[at], 0.0)[codes] if len(logs) else np.zeros(len(codes))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            per = lambda weights: np.bincount(owner, weights, batch.num_rows)  # noqa: B023, E731
            tokens = np.insert(ids, offsets[1:], 1).astype("<u2")  # every document gets its end behind it
            ends = 2 * (offsets + np.arange(batch.num_rows + 1))
            rare = ~there
            rare_bounds = np.concatenate([[0], np.cumsum(rare)])[offsets].astype(np.int32)
            columns = [
                batch.column(0), batch.column(1), pa.array(np.diff(offsets).astype(np.int64) + 1),
                pa.array(per(there).astype(np.int64) + (known.ends > 0)),
                pa.array(per(own) + end_log), pa.array(per(own * (ids == 0))), pa.array(per(ids == 0).astype(np.int64)),
                pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(tokens)]),
                pa.ListArray.from_arrays(pa.array(rare_bounds), pa.array(hashes[codes[rare]])),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=_ENCODED)

    return work


def encode(tokens: DataFrame, shared) -> DataFrame:
    """Stored documents as model ids: what `_encode_worker` gives, and a row number."""
    rows = tokens.select("doc_id", "held_out", "text").mapInArrow(_encode_worker(shared), _ENCODED_SQL)
    return saved(rows.withColumn("row", F.monotonically_increasing_id()), "lm_ids")


def _documents(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), "<u2") for v in column]


def _chunks(batches: Iterator[pa.RecordBatch], ids: str = "ids") -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold about `CHUNK` tokens; one that holds more stays as it is."""
    held, size = [], 0
    for batch in batches:
        own = sum(map(len, (v.as_buffer() for v in batch.column(ids)))) // 2
        if held and size + own > CHUNK:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        if batch.num_rows:
            held.append(batch)
            size += own
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _train_worker(flat) -> Callable:
    schema = pa.schema([("at", pa.int32()), ("sum", pa.float64()), ("weight", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(unpacked(flat.value))
        for batch in _chunks(batches):
            documents = _documents(batch.column(0))
            first = np.zeros(sum(map(len, documents)), bool)
            first[np.cumsum([0, *map(len, documents)])[:-1]] = True
            trainer.learn(np.concatenate(documents), first)
        if trainer.tokens:
            values = packed(trainer.p).astype(np.float64)
            rows = [np.arange(len(values), dtype=np.int32), values * trainer.tokens, np.full(len(values), float(trainer.tokens))]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, rows)), schema=schema)

    return work


def train(tokens: DataFrame, counts: Counts, shared) -> np.ndarray:
    """The model's parameters after all rounds over documents (doc_id, held_out, text)."""
    return train_encoded(encode(tokens, shared), counts)


def train_encoded(documents: DataFrame, counts: Counts) -> np.ndarray:
    """Each task learns on its own documents, Spark averages after every round. The more tasks there are, the less text each
    round's parameters see between two averages."""
    context = documents.sparkSession.sparkContext
    flat = packed(initial(counts.model_counts))
    documents = documents.where("NOT held_out")
    for number in range(ROUNDS):
        part = documents.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("lm")), F.lit(ROUNDS)) == number).select("ids")
        learned = part.mapInArrow(_train_worker(context.broadcast(flat)), "at int, sum double, weight double")
        means = learned.groupBy("at").agg((F.sum("sum") / F.sum("weight")).alias("mean")).toArrow()  # a row per parameter
        if means.num_rows:
            flat = flat.copy()
            flat[means["at"].to_numpy()] = means["mean"].to_numpy()
    return flat


def _score_worker(flat) -> Callable:
    """The ids, which come last, replaced by the model's score."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params = unpacked(flat.value)
        for batch in _chunks(batches):
            scores = scored_documents(params, _documents(batch.column("ids"))) / LN10
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], [*batch.schema.names[:-1], "model"])

    return work


def language_model_scores(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    context = docs.sparkSession.sparkContext
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    tokens = split(docs)
    counted = word_counts(tokens)
    ends = docs.where(remainder(F.col("doc_id"), 5) != 1).count()
    counts = totals(counted, ends)
    rows = encode(tokens, context.broadcast(vars(counts)))  # HEAD_WORDS bounds it
    flat = context.broadcast(train_encoded(rows, counts))
    # Counts of rare words: one row per document and word, joined by hash; a hot word would be split by adaptive execution.
    rare = rows.select("row", F.explode("rare").alias("h")).groupBy("row", "h").agg(F.count("*").alias("n"))
    found = rare.join(counted, "h", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_logs"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
    )
    kept = ("row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "unknown_logs", "n_unknown")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
    scored = rows.select(*kept, "ids").mapInArrow(_score_worker(flat), f"{schema}, model double")
    joined = scored.join(found, "row", "left").fillna({"rare_logs": 0.0, "rare_known": 0})
    all_log = float(np.log10(counts.tokens + 0.5 * (counts.distinct + 1)))
    rest_log = float(np.log10(counts.rest_tokens + 0.5 * (counts.rest_distinct + 1)))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(counts.tokens).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.col("rare_logs") - F.col("n_tokens") * F.lit(all_log)).alias("base_score"),
        (F.col("model") + F.col("unknown_logs") + F.col("rare_logs") - F.col("n_unknown") * F.lit(rest_log)).alias("score"),
    )
