"""Language model scores by a probabilistic suffix tree (operator 4).

A text is its words in lower case (A-Z), parted by one blank and ended by an end mark, symbol by symbol (UTF-8 bytes). The tree holds contexts of up to
DEPTH symbols. A context stays only if its next-symbol distribution diverges from that of the context one symbol shorter: the code length that it
saves over all its occurrences must exceed what its parameters cost, whatever the size of the corpus. Distributions are smoothed into those of the shorter context
(Witten-Bell), the shortest into the uniform one. The state that predicts a symbol is the longest context of the tree that the history ends with.

Counts cover the whole training corpus and are summed by Spark; tests of contexts are joins and sums. The tree is a written table that grows with the corpus. Its most frequent
contexts, as many as CELLS has room for, go to every task. Where a walk would go on to a context that is in the table only, the symbol and the DEPTH before it meet the table in joins.

The baseline needs the count of every word. The FREQUENT most frequent words go to every task; documents meet the counts of all others in a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.language import fold
from skyledger.llm.words import _LOWER, SOLID, hashed_words, signed, slices, text_bytes
from skyledger.llm.workers import give_back
from skyledger.workspace import Workspace

#: symbols in the longest context; a context and its next symbol fit one key of eight bytes
DEPTH = 5
#: contexts times symbols of the part of the tree that goes to every task, 12 bytes each
CELLS = 1 << 23
#: share of the logarithm of its count that a context must save for each of its next symbols
COST = 0.1
#: words whose counts go to every task, 16 bytes each
FREQUENT = 1 << 18
#: keys that a task sums up before it merges them
MERGE_AT = 1 << 21
#: bytes of text and symbols that are looked at together: each takes some 60 bytes of a worker's memory
SLICE, PIECE = 1 << 20, 1 << 19

# Fixed symbols: the blank between words, the end of a text (also what comes before it), and the key of the end as a word.
BLANK, END = 32, 10
END_WORD = np.int64(0x454E44)
_BYTES = (_LOWER - np.uint64(1)).astype(np.uint8)


def stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of texts one after the other, and where each begins, with the end."""
    solid = SOLID[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    first[inner] |= solid[inner]
    starts = np.flatnonzero(first)
    n_words = np.searchsorted(starts, offsets)
    empty = np.diff(n_words) == 0
    held_before = np.append(0, np.cumsum(solid, dtype=np.int64))[offsets]
    begins = held_before + n_words + np.append(0, np.cumsum(empty))
    out = np.full(begins[-1], BLANK, np.uint8)
    word = np.cumsum(first[solid], dtype=np.int64) - 1
    shift = np.repeat(np.append(0, np.cumsum(empty))[:-1], np.diff(held_before))
    out[np.arange(len(word)) + word + shift] = _BYTES[data[solid]]
    out[begins[1:] - 1] = END
    return out, begins


def runs(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Symbols of texts in runs of bounded length: the run with DEPTH symbols before it, for each symbol how many of its text came before (DEPTH at most), where texts begin in the run, and which they are.

    A text longer than a slice is cut between two words; its later runs begin with what came before.
    """
    data, offsets = text_bytes(texts)
    lead = np.full(DEPTH, END, np.uint8)
    if len(data) <= SLICE + PIECE or len(texts) > 1:
        out, begins = stream(data, offsets)
        place = np.arange(len(out)) - np.repeat(begins[:-1], np.diff(begins))
        yield np.concatenate([lead, out]), np.minimum(place, DEPTH), begins[:-1], np.arange(len(texts))
        return
    at, blank, place = 0, np.flatnonzero(~SOLID[data]), 0
    while at < len(data):
        later = np.searchsorted(blank, at + SLICE)
        upto = int(blank[later]) + 1 if later < len(blank) else len(data)
        if not SOLID[data[upto:]].any():
            upto = len(data)
        if SOLID[data[at:upto]].any():
            out, _ = stream(data[at:upto], np.array([0, upto - at]))
            if upto < len(data):
                out[-1] = BLANK
            yield np.concatenate([lead, out]), np.minimum(np.arange(len(out)) + place, DEPTH), np.zeros(1, np.int64), np.zeros(1, np.int64)
            lead, place = np.concatenate([lead, out])[-DEPTH:], DEPTH
        elif upto == len(data):
            yield np.concatenate([lead, [END]]).astype(np.uint8), np.array([place]), np.zeros(1, np.int64), np.zeros(1, np.int64)
        at = upto


def _before(run: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """The symbol k places before each symbol of a run; END before a text."""
    return np.where(place >= k, run[DEPTH - k : len(run) - k], END)


def _keys(run: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Each symbol of a run and the DEPTH symbols before it."""
    key = run[DEPTH:].astype(np.int64)
    for k in range(1, DEPTH + 1):
        key |= _before(run, place, k).astype(np.int64) << (8 * k)
    return key


def _times(text: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, key) and how often each comes."""
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1])))
    return text[first], key[first], np.diff(np.append(first, len(key)))


class _Sums:
    """Counts by key, merged now and then."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.held += len(keys)
        if self.held > MERGE_AT and len(self.parts) > 1:
            self.parts = [self.merged()]
            self.held = len(self.parts[0][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate([p[k] for p in self.parts]) for k in (0, 1))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[first], np.add.reduceat(counts, first)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (kind 0) and symbols after DEPTH symbols (kind 1) with their counts in a task."""
    sums = (_Sums(), _Sums())
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            words, _ = hashed_words(part.column(0))
            own, n = np.unique(words, return_counts=True)
            sums[0].add(np.append(signed(own), END_WORD), np.append(n, len(part)))
            for run, place, _, _ in runs(part.column(0)):
                sums[1].add(*np.unique(_keys(run, place), return_counts=True))
    for kind, own in enumerate(sums):
        if own.parts:
            keys, n = own.merged()
            for at in range(0, len(keys), 1 << 18):
                m = len(keys[at : at + (1 << 18)])
                yield pa.RecordBatch.from_pydict({"kind": pa.array(np.full(m, kind, np.int8)), "key": keys[at : at + m], "n": n[at : at + m].astype(np.int64)})
    del sums
    give_back()


class Tree:
    """The contexts that stay, or the most frequent of them, as tables for walks from the latest symbol back."""

    def __init__(self, depth: np.ndarray, context: np.ndarray, symbol: np.ndarray, count: np.ndarray, beyond: tuple[np.ndarray, np.ndarray] | None = None):
        """A row for each next symbol of each context; all that a context ends with are there too. ``beyond``: (depth, context) of those that stay, aren't here, and end with one that is."""
        symbols = np.union1d(symbol, [BLANK, END])
        self.index = np.zeros(256, np.int64)  # 0: never seen
        self.index[symbols] = np.arange(1, len(symbols) + 1)
        width = self.width = len(symbols) + 1
        by_depth = [np.unique(context[depth == d]) for d in range(DEPTH + 1)]
        by_depth[0] = np.zeros(1, np.int64)
        begins = np.cumsum([0, *[len(c) for c in by_depth]])
        n = self.size = int(begins[-1])
        # a second copy of each context stands for a walk that has ended there, and one more for walks that lead out
        child = np.repeat(np.append(np.tile(np.arange(n, 2 * n, dtype=np.int32), 2), np.int32(2 * n))[:, None], width, axis=1)
        chance = np.ones((n + 1, width), np.float32)
        for d, contexts in enumerate(by_depth):
            own = depth == d
            counts = np.zeros((len(contexts), width), np.float32)
            counts[np.searchsorted(contexts, context[own]), self.index[symbol[own]]] = count[own]
            if d:
                parent = begins[d - 1] + np.searchsorted(by_depth[d - 1], contexts & ((1 << (8 * (d - 1))) - 1))
                child[parent, self.index[contexts >> (8 * (d - 1))]] = np.arange(begins[d], begins[d + 1])
                shorter = chance[parent]
            else:
                shorter = np.full((1, width), 1 / 256, np.float32)
            kinds = np.count_nonzero(counts, axis=1)[:, None]
            total = np.maximum(counts.sum(axis=1, dtype=np.float64)[:, None] + kinds, 1)
            chance[begins[d] : begins[d + 1]] = np.where(kinds > 0, (counts + kinds * shorter) / total, shorter)
        for d in range(1, DEPTH + 1) if beyond else ():
            contexts = beyond[1][beyond[0] == d]
            parent = begins[d - 1] + np.searchsorted(by_depth[d - 1], contexts & ((1 << (8 * (d - 1))) - 1))
            child[parent, self.index[contexts >> (8 * (d - 1))]] = 2 * n
        self.child, self.log = child.ravel(), np.log10(chance, out=chance).ravel()

    def score(self, texts: pa.Array) -> np.ndarray:
        """log10 of the probability of each text, but for the symbols whose walks lead out."""
        return self.walk(texts)[0]

    def walk(self, texts: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """log10 of the probability of each text but for the symbols whose walks lead out; and of those (text, key, times), the key being the symbol and the DEPTH before it."""
        out, led = np.zeros(len(texts)), []
        for run, place, begins, which in runs(texts):
            logs = np.empty(len(place), np.float64)
            for at in range(0, len(place), PIECE):
                upto = min(len(place), at + PIECE)
                own, near = run[at : upto + DEPTH], place[at:upto]
                node = np.zeros(upto - at, np.int64)
                for k in range(1, DEPTH + 1):
                    node = self.child[node * self.width + self.index[_before(own, near, k)]]
                away = np.flatnonzero(node == 2 * self.size)
                if len(away):
                    text = which[np.searchsorted(begins, at + away, side="right") - 1]
                    led.append(_times(text, _keys(own, near)[away]))
                node = np.where(node >= self.size, node - self.size, node)
                logs[at:upto] = self.log[node * self.width + self.index[own[DEPTH:]]]
            out[which] += np.add.reduceat(logs, begins)
        return out, led


class Model:
    """The tree's part for every task and all of it as a table, ``contexts`` (depth, context, symbol, n, total, kinds), or None where the part is all; and the words' counts as a table: ``words`` (key, n) of all training tokens, ``total`` and ``distinct`` of them."""

    def __init__(self, tree: Tree, contexts: DataFrame | None, words: DataFrame, total: int, distinct: int, frequent: tuple[np.ndarray, np.ndarray], end: int):
        self.tree, self.contexts, self.words, self.total, self.distinct, self.frequent, self.end = tree, contexts, words, total, distinct, frequent, end


#: what a context ends with, one symbol shorter
_TAIL = "context & (shiftleft(1L, 8 * (depth - 1)) - 1L)"


def learn(docs: DataFrame, taught: Column | None = None, text_column: str = "text", least_gain: float = 0.0) -> Model:
    """Learn from all texts of a table, or from those for which ``taught`` is true. A null text is empty: an end and nothing else.

    ``least_gain`` asks for a smaller tree: contexts that save at least so many nats for each symbol of the corpus.
    Without any text the model is uniform. Equal rows count as often as they come.
    """
    work = Workspace(docs.sparkSession)
    rows = docs if taught is None else docs.where(taught)
    texts = rows.select(F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))
    counts = texts.mapInArrow(_count, "kind tinyint, key bigint, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counts, _ = work.materialize(counts, "counts")
    words = counts.where("kind = 0").select("key", "n")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.max(F.when(F.col("key") == int(END_WORD), F.col("n")))).first()
    top = words.orderBy(F.col("n").desc(), "key").limit(FREQUENT).toArrow()
    keys, n = (top.column(c).to_numpy() for c in ("key", "n"))
    order = np.argsort(keys)

    depths = F.explode(F.sequence(F.lit(0), F.lit(DEPTH)))
    grams = counts.where("kind = 1").select(F.col("key").alias("gram"), "n", depths.alias("depth"))
    # the context of a depth is that many bytes above the symbol's
    cut = F.expr(f"if(depth = {DEPTH}, gram, gram & (shiftleft(1L, 8 * (depth + 1)) - 1L))")
    level = grams.select("depth", F.shiftright(cut, 8).alias("context"), cut.bitwiseAND(F.lit(255)).alias("symbol"), "n").groupBy("depth", "context", "symbol").agg(F.sum("n").alias("n"))
    level, _ = work.materialize(level, "contexts")
    sums = level.groupBy("depth", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    corpus = sums.where("depth = 0").agg(F.coalesce(F.max("total"), F.lit(0))).first()[0]
    known, _ = work.materialize(level.join(sums, ["depth", "context"]), "known")
    shorter = known.select((F.col("depth") + 1).alias("depth"), F.col("context").alias("tail"), "symbol", F.col("n").alias("n_shorter"), F.col("total").alias("total_shorter"))
    saved = F.col("n") * F.log(F.col("n") * F.col("total_shorter") / (F.col("total") * F.col("n_shorter")))
    gains = known.where("depth > 0").withColumn("tail", F.expr(_TAIL)).join(shorter, ["depth", "tail", "symbol"]).groupBy("depth", "context", "total", "kinds").agg(F.sum(saved).alias("gain"))
    stay = gains.where((F.col("gain") > COST * F.col("kinds") * F.log(F.col("total") + 1.0)) & (F.col("gain") >= least_gain * corpus))
    parts = stay.select(F.explode(F.sequence(F.lit(1), F.col("depth"))).alias("depth"), "context").withColumn("context", F.expr(f"if(depth = {DEPTH}, context, context & (shiftleft(1L, 8 * depth) - 1L))"))
    kept, _ = work.materialize(known.where("depth = 0").unionByName(known.join(parts.distinct(), ["depth", "context"], "left_semi")), "kept")
    contexts = kept.groupBy("depth", "context").agg(F.max("total").alias("total"))
    n_contexts, n_symbols = contexts.count(), kept.where("depth = 0").count()
    room = max(1, CELLS // (n_symbols + 3))
    sent, beyond = kept, None
    if n_contexts > room:
        # what a context ends with comes at least as often and is shorter, so it is sent before it
        most, _ = work.materialize(contexts.orderBy(F.col("total").desc(), "depth", "context").limit(room).select("depth", "context"), "sent")
        sent = kept.join(most, ["depth", "context"], "left_semi")
        ends = most.select((F.col("depth") + 1).alias("depth"), F.col("context").alias("tail"))
        edge = contexts.where("depth > 0").join(most, ["depth", "context"], "left_anti").withColumn("tail", F.expr(_TAIL)).join(ends, ["depth", "tail"], "left_semi").select("depth", "context").toArrow()
        beyond = (edge.column("depth").to_numpy(), edge.column("context").to_numpy())
    found = sent.select("depth", "context", "symbol", "n").toArrow()
    tree = Tree(*[found.column(c).to_numpy() for c in ("depth", "context", "symbol", "n")], beyond)
    return Model(tree, None if beyond is None else kept, words, int(total[0]), int(total[1]), (keys[order], n[order]), int(total[2] or 0))


def _chances(grams: DataFrame, contexts: DataFrame, work: Workspace) -> DataFrame:
    """(gram, chance) of distinct symbols with the DEPTH before them, from the table of contexts.

    One depth after the other. A context has at most 256 next symbols and as many that are one longer, so no key of a join has more rows.
    """
    levels = [grams.select("gram")]
    for d in range(DEPTH - 1, -1, -1):
        cut, _ = work.materialize(levels[0].select(F.col("gram").bitwiseAND(F.lit((1 << (8 * (d + 1))) - 1)).alias("gram")).distinct(), f"grams-{d}")
        levels.insert(0, cut)
    made = None
    for d, level in enumerate(levels):
        own = contexts.where(F.col("depth") == d)
        n = own.select(F.shiftleft("context", 8).bitwiseOR(F.col("symbol")).alias("gram"), "n")
        rows = level.join(n, "gram", "left").withColumn("context", F.shiftright("gram", 8)).join(own.select("context", "total", "kinds").distinct(), "context", "left")
        if made is None:
            rows = rows.withColumn("shorter", F.lit(1 / 256))
        else:
            rows = rows.withColumn("tail", F.col("gram").bitwiseAND(F.lit((1 << (8 * d)) - 1))).join(made.withColumnsRenamed({"gram": "tail", "chance": "shorter"}), "tail")
        chance = (F.coalesce("n", F.lit(0)) + F.col("kinds") * F.col("shorter")) / (F.col("total") + F.col("kinds"))
        made, _ = work.materialize(rows.select("gram", F.coalesce(chance, F.col("shorter")).alias("chance")), f"chances-{d}")
    return made


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row.

    n_tokens counts words and the end, n_known those that the training texts have. base_score is the unigram log10 probability with 0.1 added to each count and one unseen
    word; score is the tree's. A null text is empty. Repeated ids and rows are scored each; other columns are not read.
    """
    spark, work = docs.sparkSession, Workspace(docs.sparkSession)
    sent = spark.sparkContext.broadcast((model.tree, *model.frequent, model.end))
    rows = docs.select(F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"), F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("row"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with all that the task knows, and one for each of its words that the task doesn't know."""
        tree, keys, counts, end = sent.value
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                words, bounds = hashed_words(part.column(0))
                words, doc, m = signed(words), np.repeat(np.arange(len(part)), np.diff(bounds)), len(part)
                at = np.minimum(np.searchsorted(keys, words), max(0, len(keys) - 1))
                here = keys[at] == words if len(keys) else np.zeros(len(words), bool)
                logs = np.log10(counts[at[here]] + 0.1)
                scores, led = tree.walk(part.column(0))
                base = np.bincount(doc[here], logs, m) + np.log10(end + 0.1)
                known = np.bincount(doc[here], minlength=m) + (end > 0)
                nothing = pa.nulls(m, pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "row": part.column(2), "doc_id": part.column(1), "n_tokens": np.diff(bounds) + 1, "known": known.astype(np.int64), "base": base, "score": scores, "word": nothing, "gram": nothing, "n": nothing,
                })
                order = np.lexsort((words[~here], doc[~here]))
                w, d = words[~here][order], doc[~here][order]
                first = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (d[1:] != d[:-1]))) if len(w) else np.zeros(0, np.int64)
                ids = part.column(2).to_numpy()
                for kind, which, key, n in [("word", d[first], w[first], np.diff(np.append(first, len(w)))), *[("gram", *x) for x in led]]:
                    r = len(key)
                    nothing = pa.nulls(r, pa.int64())
                    yield pa.RecordBatch.from_pydict({
                        "row": ids[which], "doc_id": nothing, "n_tokens": nothing, "known": nothing, "base": pa.nulls(r, pa.float64()), "score": pa.nulls(r, pa.float64()),
                        "word": pa.array(key) if kind == "word" else nothing, "gram": pa.array(key) if kind == "gram" else nothing, "n": n,
                    })
        give_back()

    found, _ = work.materialize(rows.mapInArrow(scan, "row bigint, doc_id bigint, n_tokens bigint, known bigint, base double, score double, word bigint, gram bigint, n bigint"), "scanned")
    rare = found.where("word IS NOT NULL").select("row", F.col("word").alias("key"), F.col("n").alias("times")).join(model.words, "key", "left")
    rare = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.1))).alias("rare_base"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known")
    )
    whole = found.where("word IS NULL AND gram IS NULL").select("row", "doc_id", "n_tokens", "known", "base", "score").join(rare, "row", "left")
    if model.contexts is not None:
        led = found.where("gram IS NOT NULL").select("row", "gram", F.col("n").alias("times"))
        away = led.join(_chances(led.select("gram").distinct(), model.contexts, work), "gram").groupBy("row").agg(F.sum(F.col("times") * F.log10("chance")).alias("away"))
        whole = whole.join(away, "row", "left").withColumn("score", F.col("score") + F.coalesce("away", F.lit(0.0)))
    scale = float(np.log10(model.total + 0.1 * (model.distinct + 1)))
    return whole.select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(scale)).alias("base_score"), "score",
    )


def op4_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a tree learnt from nine tenths of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = fold(F.col("doc_id"), 10) == 0
    scored = score(docs, learn(docs, ~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
