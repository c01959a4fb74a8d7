"""Toxicity by a bidirectional gated recurrent network with attention pooling over characters and words (operator 12).

A word is a run of letters and digits in lower case (A-Z), longer ones in pieces of LETTERS bytes. Its input is the vector of the word, if it is in the vocabulary, and the last
states of a bidirectional recurrent network over its characters (UTF-8 bytes). A second such network reads the words of a window; attention over
its states gives one vector, and a logistic unit its logit. Windows of WINDOW words overlap by half; a text is as toxic as its most toxic window.

The network is trained in NumPy by gradient descent (Adam) on a bounded sample of labelled texts. A label belongs to a whole text, so each round learns from
the most toxic window of each text as the network sees it then. Texts kept apart decide which round is kept and turn logits into
probabilities, at the share of toxic texts among all labels.

Scoring is one pass over the texts, in slices; each distinct word of a slice goes through the character network once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.words import ALNUM, mix, slices, text_bytes
from skyledger.workspace import Workspace

#: words in a window and from one window to the next
WINDOW, STEP = 64, 32
#: bytes of a word that are read at once
LETTERS = 24
#: sizes: word and character vectors, states of the two networks, attention
WORD, CHAR, STATE_CHARS, STATE, ATTENTION = 16, 8, 12, 16, 16
#: bound of the sample: labelled texts of each kind, and bytes of text of each kind
TRAINED_ON, TRAINED_BYTES = 2000, 6 << 20
#: words with a vector of their own, each in LEAST_TEXTS texts of the sample or more
VOCABULARY, LEAST_TEXTS = 1 << 12, 8
ROUNDS, BATCH, RATE, DECAY, HIDDEN_WORDS = 6, 64, 6e-3, 1e-4, 0.3
#: one text in so many is kept apart
APART = 6
#: windows and words that go through a network at once, bytes of text in a slice
TOGETHER, SLICE = 2048, 1 << 20
THRESHOLD = 0.3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


# -- words and windows -----------------------------------------------------------------------------------------------------


def cut_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of every word (rows of LETTERS, padded with 0), their number, and for each text the number of words before it, with the total at the end."""
    data, offsets = text_bytes(texts)
    solid = ALNUM[data]
    edge = solid.copy()
    edge[1:] &= ~solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    edge[inner] |= solid[inner]
    starts = np.flatnonzero(edge)
    ends = np.flatnonzero(solid & np.append(~solid[1:] | edge[1:], True)[: len(data)]) + 1
    pieces = -(-(ends - starts) // LETTERS)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts, ends = np.repeat(starts, pieces) + nth * LETTERS, np.repeat(ends, pieces)
    sizes = np.minimum(ends - starts, LETTERS)
    words = np.zeros((len(starts), LETTERS), np.uint8)
    for k in range(LETTERS):
        has = np.flatnonzero(sizes > k)
        words[has, k] = _LOWER[data[starts[has] + k]]
    return words, sizes, np.searchsorted(starts, offsets)


def word_keys(words: np.ndarray) -> np.ndarray:
    """64-bit hash of each word."""
    return mix((words.view(np.uint64) * _FACTORS).sum(axis=1) + mix(words.view(np.uint64)[:, 1] ^ _FACTORS[0]))


def windows_of(bounds: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and text of every window. The last window of a text ends with it."""
    n = np.diff(bounds)
    count = np.where(n > 0, 1 + -(-np.maximum(n - WINDOW, 0) // step), 0)
    text = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = bounds[:-1][text] + nth * step
    return first, np.minimum(WINDOW, bounds[1:][text] - first), text


# -- the network -------------------------------------------------------------------------------------------------------------


def new_network(vocabulary: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Parameters before training; ``vocabulary`` are the keys of known words in order."""
    def around(*shape, by):
        return (rng.standard_normal(shape) * by).astype(np.float32)

    net = {"words": around(len(vocabulary) + 1, WORD, by=0.1), "chars": around(256, CHAR, by=0.3)}
    for level, size, state in (("c", CHAR, STATE_CHARS), ("w", WORD + 2 * STATE_CHARS, STATE)):
        for way in "fb":
            net[f"{level}{way}_in"] = around(size, 3 * state, by=size**-0.5)
            net[f"{level}{way}_bias"] = np.zeros(3 * state, np.float32)
            net[f"{level}{way}_back"] = around(state, 3 * state, by=state**-0.5)
    return net | {"look": around(2 * STATE, ATTENTION, by=(2 * STATE) ** -0.5), "at": around(ATTENTION, by=0.3), "out": around(2 * STATE, by=0.3), "out_bias": np.zeros(1, np.float32)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    # by exp, which NumPy has twice as fast as tanh; beyond its range the limit is right
    with np.errstate(over="ignore"):
        out = np.exp(-x)
    out += 1
    return np.reciprocal(out, out=out) if isinstance(out, np.ndarray) else 1 / out


def _tanh(x: np.ndarray) -> np.ndarray:
    out = _sigmoid(2 * x)
    out *= 2
    out -= 1
    return out


def _sum_rows(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values of each of n rows."""
    order = np.argsort(rows, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(rows[order]) != 0))
    out = np.zeros((n, values.shape[1]), np.float32)
    out[rows[order][first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def _run(given: np.ndarray, index: np.ndarray, active: np.ndarray, back: np.ndarray, keep: bool):
    """States of a gated recurrent layer. ``given`` has the inputs' share of the gates by row, ``index`` (step, sequence) the row; sequences come longest
    first, ``active`` of them have a step. Returns the states (step, sequence, state) and, if kept, what the way back needs."""
    size = back.shape[0]
    states = np.zeros((len(index) + 1, index.shape[1], size), np.float32)
    held = []
    for t, n in enumerate(active):
        h = states[t, :n]
        x, u = given.take(index[t, :n], axis=0), h @ back
        gates = _sigmoid(x[:, : 2 * size] + u[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        new = _tanh(x[:, 2 * size :] + r * u[:, 2 * size :])
        states[t + 1, :n] = new + z * (h - new)
        states[t + 1, n:] = states[t, n:]
        if keep:
            held.append((gates, new, u[:, 2 * size :]))
    return states, held


def _run_back(grads: np.ndarray, states: np.ndarray, held: list, active: np.ndarray, back: np.ndarray):
    """Gradients of the inputs' share (by step) and of the recurrent weights, from those of the states (step + 1, sequence, state)."""
    size = back.shape[0]
    d_back = np.zeros_like(back)
    d_given: list = [None] * len(active)
    d_h = np.zeros_like(grads[0])
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        d_h += grads[t + 1]
        gates, new, u_new = held[t]
        h, d = states[t, :n], d_h[:n]
        z, r = gates[:, :size], gates[:, size:]
        d_pre = d * (1 - z) * (1 - new * new)
        d_gates = np.concatenate([d * (h - new), d_pre * u_new], axis=1) * gates * (1 - gates)
        d_u = np.concatenate([d_gates, d_pre * r], axis=1)
        d_given[t] = np.concatenate([d_gates, d_pre], axis=1)
        d_back += h.T @ d_u
        d_h = d_h.copy()
        d_h[:n] = d * z + d_u @ back.T
    return d_given, d_back


def _steps(sizes: np.ndarray, width: int) -> np.ndarray:
    """How many sequences, longest first, have each step."""
    return np.searchsorted(-sizes, -np.arange(int(sizes.max(initial=0))), "left")[:width]


def spell(net: dict, words: np.ndarray, sizes: np.ndarray, keep: bool = False):
    """Vectors of words from their characters."""
    order = np.argsort(-sizes, kind="stable")
    active = _steps(sizes[order], LETTERS)
    forward = words[order].T.astype(np.int64)[: len(active)]
    place = sizes[order][None, :] - 1 - np.arange(len(active))[:, None]
    ways = {"f": forward, "b": np.take_along_axis(forward, np.maximum(place, 0), axis=0)}
    out, held = np.empty((len(words), 2 * STATE_CHARS), np.float32), {}
    for k, (way, index) in enumerate(ways.items()):
        given = net["chars"] @ net[f"c{way}_in"] + net[f"c{way}_bias"]
        states, kept = _run(given, index, active, net[f"c{way}_back"], keep)
        out[order, k * STATE_CHARS : (k + 1) * STATE_CHARS] = states[-1]
        held[way] = (index, states, kept)
    return out, (order, active, held)


def read(net: dict, inputs: np.ndarray, index: np.ndarray, sizes: np.ndarray, keep: bool = False):
    """Logit of each window, longest first: ``index`` (step, window) are rows of ``inputs``."""
    active = _steps(sizes, WINDOW)
    steps = np.arange(len(active))[:, None]
    valid = steps < sizes
    index = index[: len(active)]
    turned = np.take_along_axis(index, np.maximum(sizes - 1 - steps, 0), axis=0)
    held, both = {}, []
    for way, at in (("f", index), ("b", turned)):
        states, kept = _run(inputs @ net[f"w{way}_in"] + net[f"w{way}_bias"], at, active, net[f"w{way}_back"], keep)
        held[way] = (at, states, kept)
        both.append(states[1:])
    # the way back is read from the end: put its states at their words
    place = np.maximum(sizes - 1 - steps, 0)
    both[1] = both[1][place, np.arange(len(sizes))]
    states = np.concatenate(both, axis=2)
    looked = _tanh(states @ net["look"])
    weight = np.where(valid, looked @ net["at"], -np.inf)
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tb,tbs->bs", weight, states)
    return pooled @ net["out"] + net["out_bias"][0], (active, place, valid, held, states, looked, weight, pooled)


def gradients(net: dict, known: np.ndarray, words: np.ndarray, letters: np.ndarray, index: np.ndarray, sizes: np.ndarray, label: np.ndarray, share: np.ndarray) -> tuple[dict, float]:
    """Gradients and the loss (log loss, each window by its share): ``known`` are rows of the word vectors."""
    spelled, (order, c_active, c_held) = spell(net, words, letters, True)
    inputs = np.concatenate([net["words"][known], spelled], axis=1)
    logit, (active, place, valid, held, states, looked, weight, pooled) = read(net, inputs, index, sizes, True)
    p = _sigmoid(logit)
    grad = {k: np.zeros_like(v) for k, v in net.items()}
    d_logit = ((p - label) * share).astype(np.float32)
    grad["out_bias"][0] = d_logit.sum()
    grad["out"] = pooled.T @ d_logit
    d_pooled = d_logit[:, None] * net["out"]
    d_states = weight[:, :, None] * d_pooled
    d_weight = np.einsum("tbs,bs->tb", states, d_pooled)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    grad["at"] = np.einsum("tb,tba->a", d_score, looked)
    d_look = d_score[:, :, None] * net["at"] * (1 - looked * looked)
    grad["look"] = np.einsum("tbs,tba->sa", states, d_look)
    d_states = (d_states + d_look @ net["look"].T) * valid[:, :, None]
    d_inputs = np.zeros_like(inputs)
    for k, way in enumerate("fb"):
        at, seen, kept = held[way]
        part = d_states[:, :, k * STATE : (k + 1) * STATE]
        if way == "b":
            turned = np.zeros_like(part)
            turned[place[valid], np.nonzero(valid)[1]] = part[valid]
            part = turned
        d_given, grad[f"w{way}_back"] = _run_back(np.concatenate([np.zeros_like(part[:1]), part]), seen, kept, active, net[f"w{way}_back"])
        rows, d_rows = np.concatenate([at[t, :n] for t, n in enumerate(active)]), np.concatenate(d_given)
        by_input = _sum_rows(rows, d_rows, len(inputs))
        grad[f"w{way}_in"], grad[f"w{way}_bias"] = inputs.T @ by_input, by_input.sum(axis=0)
        d_inputs += by_input @ net[f"w{way}_in"].T
    grad["words"] = _sum_rows(known, d_inputs[:, :WORD], len(net["words"]))
    for k, way in enumerate("fb"):
        at, seen, kept = c_held[way]
        last = np.zeros_like(seen)
        last[-1] = d_inputs[order, WORD + k * STATE_CHARS : WORD + (k + 1) * STATE_CHARS]
        d_given, grad[f"c{way}_back"] = _run_back(last, seen, kept, c_active, net[f"c{way}_back"])
        rows, d_rows = np.concatenate([at[t, :n] for t, n in enumerate(c_active)]), np.concatenate(d_given)
        by_char = _sum_rows(rows, d_rows, 256)
        grad[f"c{way}_in"], grad[f"c{way}_bias"] = net["chars"].T @ by_char, by_char.sum(axis=0)
        grad["chars"] += by_char @ net[f"c{way}_in"].T
    loss = np.logaddexp(0, np.where(label > 0, -logit, logit)) * share
    return grad, float(loss.sum())


class Texts:
    """The words of some texts: the distinct ones, and which of them stand where."""

    def __init__(self, texts: pa.Array, step: int = STEP):
        words, sizes, self.bounds = cut_words(texts)
        keys = word_keys(words)
        self.keys, first, self.word = np.unique(keys, return_index=True, return_inverse=True)
        self.words, self.letters = words[first], sizes[first]
        self.first, self.sizes, self.text = windows_of(self.bounds, step)

    def index(self, windows: np.ndarray) -> np.ndarray:
        """Distinct word at each (step, window); beyond a window's end the last word of all."""
        at = self.first[windows] + np.arange(WINDOW)[:, None]
        return self.word[np.minimum(at, len(self.word) - 1)]

    def logits(self, net: dict, vocabulary: np.ndarray) -> np.ndarray:
        """Logit of every window."""
        known = _known(self.keys, vocabulary)
        inputs = np.empty((len(self.keys), WORD + 2 * STATE_CHARS), np.float32)
        for at in range(0, len(self.keys), 4 * TOGETHER):
            part = slice(at, at + 4 * TOGETHER)
            inputs[part] = np.concatenate([net["words"][known[part]], spell(net, self.words[part], self.letters[part])[0]], axis=1)
        out = np.empty(len(self.first), np.float32)
        order = np.argsort(-self.sizes, kind="stable")
        for at in range(0, len(order), TOGETHER):
            some = order[at : at + TOGETHER]
            out[some] = read(net, inputs, self.index(some), self.sizes[some])[0]
        return out


def _known(keys: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Row of the word vectors; 0 for words outside the vocabulary."""
    if not len(vocabulary):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, keys), len(vocabulary) - 1)
    return np.where(vocabulary[at] == keys, at + 1, 0)


def greatest(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Greatest value of each of n texts; -inf for one without windows."""
    out = np.full(n, -np.inf)
    np.maximum.at(out, text, values)
    return out


# -- training ----------------------------------------------------------------------------------------------------------------


def _fit_line(logit: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (above 0) and offset by which logits become log odds, by Newton steps with a little ridge towards (1, 0)."""
    x = np.stack([logit, np.ones_like(logit)], axis=1)
    line = np.array([1.0, 0.0])
    for _ in range(25):
        p = _sigmoid(x @ line)
        slope = x.T @ (weight * (p - label)) + 1.0 * (line - [1, 0])
        line = line - np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.eye(2), slope)
    return max(float(line[0]), 0.05), float(line[1])


def train(texts: list[str | None], labels: list[int], share: float, seed: int = 0) -> dict | None:
    """A network trained on the texts; ``share`` is the share of toxic texts among all. None unless both kinds have words."""
    label = np.asarray(labels, np.float32)
    seen = Texts(pa.array(texts, pa.string()), WINDOW)
    n = len(texts)
    has = np.diff(seen.bounds) > 0
    if not (has & (label == 1)).any() or not (has & (label == 0)).any():
        return None
    rng = np.random.default_rng(seed)
    # a word counts once for each text it is in
    owner = np.repeat(np.arange(n), np.diff(seen.bounds))
    in_texts = np.bincount(np.unique(seen.word * n + owner) // n, minlength=len(seen.keys))
    often = np.flatnonzero(in_texts >= LEAST_TEXTS)
    often = often[np.argsort(-in_texts[often], kind="stable")[:VOCABULARY]]
    vocabulary = np.sort(seen.keys[often])
    known = _known(seen.keys, vocabulary)
    net = new_network(vocabulary, rng)
    apart = np.arange(n) % APART == 0 if n >= 20 * APART else np.zeros(n, bool)
    learn = np.flatnonzero(has & ~apart)
    # each kind counts half
    weight = np.where(label == 1, 0.5 / max(1, (label[learn] == 1).sum()), 0.5 / max(1, (label[learn] == 0).sum())) * len(learn)
    first, second = {k: np.zeros_like(v) for k, v in net.items()}, {k: np.zeros_like(v) for k, v in net.items()}
    order = np.argsort(seen.text, kind="stable")
    counts = np.bincount(seen.text, minlength=n)
    begins = np.cumsum(counts) - counts
    held = np.flatnonzero(has & (apart if apart.any() else True))
    true_weight = np.where(label == 1, share / max(1, (label[held] == 1).sum()), (1 - share) / max(1, (label[held] == 0).sum())) * len(held)
    best, best_loss, tick = None, np.inf, 0
    logits = rng.standard_normal(len(seen.first))
    for _ in range(ROUNDS):
        # the most toxic window of each text so far
        by_logit = order[np.lexsort((logits[order], seen.text[order]))]
        chosen = by_logit[begins[learn] + counts[learn] - 1]
        queue = rng.permutation(len(learn))
        for at in range(0, len(queue), BATCH):
            some = queue[at : at + BATCH]
            some = some[np.argsort(-seen.sizes[chosen[some]], kind="stable")]
            index, sizes = seen.index(chosen[some]), seen.sizes[chosen[some]]
            distinct, index = np.unique(index, return_inverse=True)
            index = index.reshape(WINDOW, -1)
            rows = np.where(rng.random(len(distinct)) < HIDDEN_WORDS, 0, known[distinct])
            grad, _ = gradients(net, rows, seen.words[distinct], seen.letters[distinct], index, sizes, label[learn[some]], weight[learn[some]] / len(some))
            tick += 1
            scale = min(1.0, 5.0 / (1e-9 + np.sqrt(sum(float((g * g).sum()) for g in grad.values()))))
            for k in net:
                first[k] += 0.1 * (grad[k] * scale - first[k])
                second[k] += 0.001 * ((grad[k] * scale) ** 2 - second[k])
                net[k] -= RATE * (first[k] / (1 - 0.9**tick) / (np.sqrt(second[k] / (1 - 0.999**tick)) + 1e-8) + DECAY * net[k])
        logits = seen.logits(net, vocabulary)
        logit = greatest(logits, seen.text, n)[held]
        line = _fit_line(logit, label[held], true_weight[held])
        odds = line[0] * logit + line[1]
        loss = float((true_weight[held] * np.logaddexp(0, np.where(label[held] > 0, -odds, odds))).sum())
        if loss < best_loss:
            best, best_loss = {"net": {k: v.copy() for k, v in net.items()}, "vocabulary": vocabulary, "line": line}, loss
    return best


def sample_labels(docs: DataFrame, labels: DataFrame, learn: Column | None = None, text_column: str = "text", id_column: str = "doc_id", label_column: str = "toxic") -> tuple[list[str], list[int], float]:
    """A bounded sample of labelled texts for ``train``: texts, labels and the share of toxic ones among all labels.

    Of each kind the TRAINED_ON documents whose ids have the least hashes, and of these as many as TRAINED_BYTES of text allow (one at least), whole. Labels with a
    null id or value, or for which ``learn`` is false, are left out; an id with several labels is toxic if one says so; null texts teach nothing.
    """
    key, label = F.col(f"`{id_column}`"), F.col(f"`{label_column}`")
    rows = labels.where(learn) if learn is not None else labels
    rows = rows.where(key.isNotNull() & label.isNotNull()).groupBy(key.alias("id")).agg((F.max(label) > 0).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    rows = rows.withColumn("hash", F.xxhash64(F.lit(0), "id"))
    chosen = [rows.where(F.col("label") == k).orderBy("hash", "id").limit(TRAINED_ON) for k in (0, 1)]
    # at most 2 x TRAINED_ON rows
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.select(key.alias("id"), F.col(f"`{text_column}`").cast("string").alias("text")).where("text IS NOT NULL").join(chosen, "id")
    texts, _ = Workspace(docs.sparkSession).materialize(texts.withColumn("size", F.octet_length("text")), "labelled")
    out: list = []
    for k in (0, 1):
        mine = texts.where(F.col("label") == k).orderBy("hash", "id", "text")
        sizes = [r["size"] for r in mine.select("size", "hash", "id", "text").limit(TRAINED_ON).select("size").collect()]
        fits = max(1, int(np.searchsorted(np.cumsum(sizes), TRAINED_BYTES, "right")))
        out += [(r["hash"], k, r["text"]) for r in mine.limit(fits).collect()]
    out.sort()
    total = sum(counts.values())
    return [t for _, _, t in out], [k for _, k, _ in out], counts.get(1, 0) / total if total else 0.0


def score_texts(docs: DataFrame, model: dict | None, text_column: str = "text", into: str = "toxicity") -> DataFrame:
    """Every row with a double column ``into``, the probability that its text is toxic, from all windows of the whole text.

    A text that is null, empty or without a letter or digit has 0, so has any text without a model. Equal texts have equal scores but for rounding in
    the last digits, which is cut off at six. A column of the name ``into`` is replaced, all others are kept.
    """
    kept = [c for c in docs.columns if c != into]
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    rows = docs.select(row.alias("row"), F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                odds = np.full(len(part), -np.inf)
                if model is not None:
                    seen = Texts(part.column(1))
                    if len(seen.first):
                        odds = model["line"][0] * greatest(seen.logits(model["net"], model["vocabulary"]), seen.text, len(part)) + model["line"][1]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.round(_sigmoid(odds), 6))], ["row", "score"])

    schema = rows.select("row", F.lit(0.0).cast("double").alias("score")).schema
    out = rows.mapInArrow(score, schema)
    return out.select(*[F.col("row")[c].alias(c) for c in kept], F.col("score").alias(into))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document by a network that has learnt from three quarters of the labels."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = train(*sample_labels(docs, labels, ~held_out))
    scored = score_texts(docs, model, into="score")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
