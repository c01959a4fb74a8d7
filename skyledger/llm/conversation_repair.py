"""Repair of conversation structure with the cheapest edits, ties by the least audit (operator 11).

A conversation is good if the first letters of its roles give ``(s?(ua)+)?``. Edits of a row are Keep, Rerole and Delete, and rows can be Inserted
anywhere. The graph of edits has a node for each place between two rows and each state of that grammar. An edit's letter fixes where it leads,
so an audit (the letters of all edits in order) fixes its path.

Rows are told by one symbol, the role's letter and the fault. A conversation of any length is cut into fragments of at most BLOCK rows, so no task
and no group holds a whole one:

1. **Costs.** Least costs across a fragment are a 4 x 4 matrix. Matrices of consecutive fragments are multiplied (min, +) by doubling, a join for
   each power of two, which gives the costs that are left at the end of each fragment. Inside it a dynamic program runs over its places.
2. **Ranks.** Nodes with the arcs of least cost are ranked by the least audit of one letter, then of two, four, ... letters: the rank of a node by 2^(k+1) letters is that of the
   pair of its own rank and the rank of the node that its pointer of 2^k letters reaches. Pointers are doubled along.
3. **Paths.** Where a node has several arcs of least cost, ranks of the letter and of what follows choose. Letter t of a path is read at the node
   reached by the pointers of the powers of two in t, all letters of all paths at once. Fragments pass on their state by doubling too.

A path is read for each state in which a fragment may be entered; which of them counts is known when the states have been passed on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.words import slices
from skyledger.operators.order import number_rows
from skyledger.workspace import Workspace

#: rows in a fragment; what goes through one step of NumPy is bounded in rows, too
BLOCK, ROWS_AT_ONCE = 4096, 1 << 17
#: bytes of text in a batch of repaired rows, at least one row
PASSED = 1 << 22
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1

# States of the grammar: nothing yet, after s, after u, after a. Whole conversations end in the first or the last.
STATES, START, AFTER_S, AFTER_U, AFTER_A = 4, 0, 1, 2, 3
#: state after a letter; -1 where it may not stand
_AFTER = {"s": [AFTER_S, -1, -1, -1], "u": [AFTER_U, AFTER_U, -1, AFTER_U], "a": [-1, -1, AFTER_A, -1]}
#: state after the row that may be put next, and its role
_NEXT = np.array([AFTER_U, AFTER_U, AFTER_A, AFTER_U])
_NEXT_ROLE = ["user", "user", "assistant", "user"]
#: what is left to pay at the end, and how
_END_COST, _END_AUDIT = [0, 2 * INSERT, INSERT, 0], ["", "II", "I", ""]
_FAR = 1 << 40

# A symbol: place of the letter in LETTERS (another letter: 3), plus 4 if the row is truncated, 8 if it must go.
LETTERS = "sua"
_KEPT = np.array([_AFTER["s"], _AFTER["u"], _AFTER["a"], [-1] * 4])

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


# -- faults ------------------------------------------------------------------------------------------------------------


def _letter(role: Column) -> Column:
    place = F.instr(F.lit(LETTERS), F.substring(role, 1, 1))
    return F.when(F.length(role) == 0, 3).when(place > 0, place - 1).otherwise(3)


def ordered(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text; other columns go) with the columns that put them in order: turn, nulls first, then role, then text by
    hash. Rows that are equal in all of these are the same."""
    clean = rows.select(*[F.col(c).cast("bigint").alias(c) for c in ("conv_id", "turn")], *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    return clean.withColumn("hash_1", F.xxhash64("text")).withColumn("hash_2", F.xxhash64(F.lit(1), "text"))


ORDER = ("turn", "role", "hash_1", "hash_2")


def find_faults(rows: DataFrame) -> DataFrame:
    """One narrow row for each row of ``ordered``: row_no (order over all conversations), conv_id, turn, letter and its first fault.

    blank: no character but U+0020 and U+0009 to U+000D; duplicate: role and text came earlier in the conversation; truncated: the last
    character that is not one of those six is none of ``.!?``; else NULL.
    """
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    narrow = rows.select("conv_id", *ORDER, _letter(F.col("role")).cast("int").alias("letter"), blank.alias("blank"), whole.alias("whole"))
    numbered = number_rows(narrow, ["conv_id", *ORDER], "row_no")
    # the first row of each role and text; row numbers are unique, so one text that a third of all rows have is one row here
    firsts = numbered.groupBy("conv_id", "role", "hash_1", "hash_2").agg(F.min("row_no").alias("row_no")).select("row_no", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("whole"), "truncated")
    return numbered.join(firsts, "row_no", "left").select("row_no", "conv_id", "turn", "letter", fault.alias("fault"))


# -- costs, ranks and paths inside fragments -------------------------------------------------------------------------------


def costs_left(symbols: list[np.ndarray], ends: np.ndarray) -> list[np.ndarray]:
    """For each fragment the least cost from each place and state to its end, where ``ends`` (fragment, state) is still to pay: arrays (rows + 1, state)."""
    out = [np.empty((len(s) + 1, STATES), np.int64) for s in symbols]
    by_size = np.argsort([-len(s) for s in symbols], kind="stable")
    sizes = np.array([len(symbols[k]) for k in by_size], np.int64)
    longest = int(sizes.max(initial=0))
    table = np.full((len(symbols), longest + 1), 11, np.int64)
    left = np.full((longest + 1, len(symbols), STATES), _FAR, np.int64)
    for row, k in enumerate(by_size):
        table[row, : sizes[row]] = symbols[k]
        left[sizes[row], row] = ends[k]
    for at in range(longest - 1, -1, -1):
        n = int(np.searchsorted(-sizes, -at, "left"))
        here = _arcs(table[:n, at], left[at + 1, :n])[..., :3].min(axis=-1)
        left[at, :n] = _with_inserts(here)
    for row, k in enumerate(by_size):
        out[k] = left[: sizes[row] + 1, row]
    return out


def _with_inserts(cost: np.ndarray) -> np.ndarray:
    """Costs when rows may be put in before."""
    out = cost.copy()
    out[..., AFTER_U] = np.minimum(cost[..., AFTER_U], INSERT + cost[..., AFTER_A])
    out[..., AFTER_A] = np.minimum(cost[..., AFTER_A], INSERT + cost[..., AFTER_U])
    for state in (START, AFTER_S):
        out[..., state] = np.minimum(cost[..., state], INSERT + out[..., AFTER_U])
    return out


def _arcs(symbol: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Cost by way of Delete, Keep and Rerole of a row, for (row, state, edit); ``after`` is what is left behind the row."""
    letter, late, gone = symbol % 4, (symbol // 4 == 1) * TRUNCATED, symbol // 4 == 2
    kept = _KEPT[letter]
    rows = np.arange(len(symbol))[:, None]
    keep = np.where((kept < 0) | gone[:, None], _FAR, after[rows, kept] + (KEEP + late)[:, None])
    rerole = np.where(gone[:, None], _FAR, after[:, _NEXT] + (REROLE + late)[:, None])
    return np.stack([after + DELETE, keep, rerole], axis=-1)


#: letters of edits in ASCII order, and where they are among the arcs: Delete, Keep and Rerole of a row, Insert
_IN_ORDER, _AUDIT = [0, 3, 1, 2], np.frombuffer(b"DIKR", np.uint8)


def least_paths(symbols: list[np.ndarray], ends: np.ndarray) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """For each fragment and each state in which it is entered: the least audit of least cost, the state at its end, and that cost."""
    left = costs_left(symbols, ends)
    if not symbols:
        return [], np.zeros((0, STATES), np.int64), np.zeros((0, STATES), np.int64)
    sizes = np.array([len(s) for s in symbols])
    first = np.cumsum((sizes + 1) * STATES) - (sizes + 1) * STATES
    cost = np.concatenate([x.reshape(-1) for x in left])
    node = np.arange(len(cost))
    # every node but those at an end: its symbol, its state and the first node of the next place
    inner = np.concatenate([f + np.arange(n * STATES) for f, n in zip(first, sizes)])
    symbol = np.repeat(np.concatenate(symbols), STATES)
    state, behind = inner % STATES, inner - inner % STATES + STATES
    by_row = _arcs(symbol[::STATES], cost[behind[::STATES, None] + np.arange(STATES)]).reshape(-1, 3)
    inserted = INSERT + cost[inner - state + _NEXT[state]]
    arc = np.concatenate([by_row, inserted[:, None]], axis=1)[:, _IN_ORDER] == cost[inner, None]
    kept = np.maximum(_KEPT[symbol % 4, state], 0)
    target = np.stack([behind + state, inner - state + _NEXT[state], behind + kept, behind + _NEXT[state]], axis=1)

    # ranks by audits of 1, 2, 4, ... letters; a path that has ended comes first and stays where it is
    rank, pointer = np.zeros(len(cost), np.int64), node.copy()
    choice = arc.argmax(axis=1)
    rank[inner], pointer[inner] = 1 + choice, target[np.arange(len(inner)), choice]
    doublings = 0
    while (pointer[pointer] != pointer).any():
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)[1]
        pointer = pointer[pointer]
        doublings += 1
    # ranks of whole audits: of several arcs the least letter, then the least rank of what follows
    ranked = np.where(arc, np.arange(1, 5)[None, :] * (int(rank.max(initial=0)) + 1) + rank[target], np.iinfo(np.int64).max)
    choice = ranked.argmin(axis=1)
    letter, pointer = np.zeros(len(cost), np.uint8), node.copy()
    letter[inner], pointer[inner] = _AUDIT[choice], target[np.arange(len(inner)), choice]
    pointers = [pointer]
    for _ in range(doublings):
        pointers.append(pointers[-1][pointers[-1]])

    # all letters of all paths by doubled pointers
    entry = (first[:, None] + np.arange(STATES)).reshape(-1)
    steps = np.zeros(len(entry), np.int64)
    at = entry.copy()
    for k in range(len(pointers) - 1, -1, -1):
        # the longest walk that has not ended: greatest powers first
        ahead = pointers[k][at]
        go = letter[ahead] != 0
        steps, at = steps + (go << k), np.where(go, ahead, at)
    steps += letter[at] != 0
    path = np.repeat(np.arange(len(entry)), steps)
    nth = np.arange(len(path)) - np.repeat(np.cumsum(steps) - steps, steps)
    where = entry[path]
    for k, jump in enumerate(pointers):
        where = np.where(nth >> k & 1, jump[where], where)
    text = letter[where].tobytes().decode("ascii")
    bounds = np.concatenate([[0], np.cumsum(steps)])
    audits = [[text[bounds[k] : bounds[k + 1]] for k in range(n * STATES, (n + 1) * STATES)] for n in range(len(symbols))]
    return audits, (pointers[-1][entry] % STATES).reshape(-1, STATES), cost[entry].reshape(-1, STATES)


def _legal(left, right):
    """Letters that may be neighbours, as their places in LETTERS: su, ua, au."""
    s, u, a = range(3)
    return ((left == s) & (right == u)) | ((left == u) & (right == a)) | ((left == a) & (right == u))


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of fragments with at most ROWS_AT_ONCE rows, the longest as if all were as long."""
    start, longest = 0, 0
    sizes = np.array([len(s) for s in batch.column("symbols").to_pylist()], np.int64)
    for k, size in enumerate(sizes):
        if k > start and max(longest, size) * (k + 1 - start) > ROWS_AT_ONCE:
            yield batch.slice(start, k - start)
            start, longest = k, 0
        longest = max(longest, size)
    if len(sizes) > start:
        yield batch.slice(start)


def _symbols(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(s.encode(), np.uint8).astype(np.int64) - 97 for s in batch.column("symbols").to_pylist()]


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _groups(batch):
            symbols = _symbols(part)
            ways = []
            for state in range(STATES):
                ends = np.full((len(symbols), STATES), _FAR, np.int64)
                ends[:, state] = 0
                ways.append(np.stack([x[0] for x in costs_left(symbols, ends)]))
            matrix = np.minimum(np.stack(ways, axis=2), _FAR).reshape(len(symbols), -1)
            yield pa.RecordBatch.from_pydict({"conv_id": part.column("conv_id"), "block": part.column("block"), "costs": list(matrix)}, _schema("costs"))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _groups(batch):
            ends = np.array(part.column("ends").to_pylist(), np.int64).reshape(-1, STATES)
            symbols = _symbols(part)
            audits, states, costs = least_paths(symbols, ends)
            letters = [s % 4 for s in symbols]
            columns = {
                "conv_id": part.column("conv_id"), "block": part.column("block"), "audits": audits, "states": list(states.astype(np.int32)), "costs": list(costs),
                "illegal": [int(np.count_nonzero(~_legal(x[:-1], x[1:]))) for x in letters], "outer": [[x[0], x[-1]] for x in letters],
            }
            yield pa.RecordBatch.from_pydict(columns, _schema("audits", "states", "costs", "illegal", "outer"))


def _schema(*names: str) -> pa.Schema:
    kinds = {"costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string()), "states": pa.list_(pa.int32()), "illegal": pa.int64(), "outer": pa.list_(pa.int32())}
    return pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), *[(n, kinds[n]) for n in names]])


# -- fragments of one conversation -----------------------------------------------------------------------------------------


def _ahead(left: DataFrame, right: DataFrame, by: int) -> DataFrame:
    """Each fragment (l) with the one ``by`` blocks further on (r), if its conversation has it."""
    return left.alias("l").join(right.alias("r"), F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("r.block") == F.col("l.block") + by), "left")


def _product(a: Column, b: Column) -> Column:
    """Product (min, +) of two matrices written row by row."""
    cells = [F.least(*[F.get(a, F.lit(STATES * i + k)) + F.get(b, F.lit(STATES * k + j)) for k in range(STATES)], F.lit(_FAR)) for i in range(STATES) for j in range(STATES)]
    return F.array(*cells)


def _ends(work: Workspace, shared: DataFrame, most: int) -> DataFrame:
    """(conv_id, block, ends): what is left to pay at the end of each fragment of conversations that have several."""
    end = F.array(*[F.lit(x).cast("bigint") for x in _END_COST])
    products, _ = work.materialize(shared.mapInArrow(_matrices, "conv_id bigint, block bigint, costs array<bigint>"), "costs-0")
    step = 1
    while step < most:
        further = F.when(F.col("r.block").isNull(), F.col("l.costs")).otherwise(_product(F.col("l.costs"), F.col("r.costs")))
        products, _ = work.materialize(_ahead(products, products, step).select("l.conv_id", "l.block", further.alias("costs")), f"costs-{step}")
        step *= 2
    rest = F.array(*[F.least(*[F.get("r.costs", F.lit(STATES * i + k)) + _END_COST[k] for k in range(STATES)]) for i in range(STATES)])
    return _ahead(products, products, 1).select("l.conv_id", "l.block", F.when(F.col("r.block").isNull(), end).otherwise(rest).alias("ends"))


def _entries(work: Workspace, paths: DataFrame, most: int) -> DataFrame:
    """(conv_id, block, entry): the state in which each fragment is entered."""
    # states at the end of the 1, 2, 4, ... fragments that end with this one, by the state in which the first is entered
    passed, _ = work.materialize(paths.select("conv_id", "block", "states"), "states-0")
    step = 1
    while step < most:
        # l comes before r
        both = _ahead(passed, passed, step).where(F.col("r.block").isNotNull()).select("r.conv_id", "r.block", F.transform("l.states", lambda s: F.get("r.states", s)).alias("longer"))
        longer = passed.alias("p").join(both.alias("b"), F.col("p.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("p.block") == F.col("b.block")), "left")
        passed, _ = work.materialize(longer.select("p.conv_id", "p.block", F.coalesce("b.longer", "p.states").alias("states")), f"states-{step}")
        step *= 2
    return passed.select("conv_id", (F.col("block") + 1).alias("block"), F.get("states", F.lit(START)).alias("entry"))


def plan_repairs(rows: DataFrame) -> DataFrame:
    """The cheapest repair of each conversation of ``rows`` (conv_id, turn, role, text): conv_id, the numbers of COUNTS, and audit.

    gaps: numbers that are missing between the least and the greatest turn (nulls don't count; 0 without a turn); blank, duplicate, truncated: rows by their first fault (``find_faults``);
    illegal: neighbours whose letters are none of su, ua and au; cost and audit of the cheapest edits. Rows come in order of turn, nulls
    first, then role, then the hash of the text. A null role or text counts as one blank, a null conv_id is a conversation of its own. A role whose letter is none of s, u and a,
    or that is empty, can't be kept. Equal rows are duplicates. A conversation of any number of rows goes through in fragments.
    """
    work = Workspace(rows.sparkSession)
    faults, _ = work.materialize(find_faults(ordered(rows)), "faults")
    turns = faults.groupBy("conv_id", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    first, last = F.min("turn"), F.max("turn")
    counts = turns.groupBy("conv_id").agg(
        F.coalesce(last - first + 1 - F.count("turn"), F.lit(0)).alias("gaps"), *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )

    kind = F.when(F.col("fault") == "truncated", 4).when(F.col("fault").isNotNull(), 8).otherwise(0)
    symbol = F.char(97 + F.col("letter") + kind)
    block = F.floor(F.col("row_no") / BLOCK)
    # a block has BLOCK rows at most, of all conversations together
    fragments = faults.groupBy("conv_id", block.alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row_no", symbol.alias("symbol")))), lambda r: r["symbol"]), "").alias("symbols")
    )
    fragments, _ = work.materialize(fragments, "fragments")
    several = fragments.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several, seen = work.materialize(several, "several", most=F.max("n"))
    most = seen["most"] or 1

    end = F.array(*[F.lit(x).cast("bigint") for x in _END_COST])
    chosen = fragments.withColumn("ends", end)
    if most > 1:
        shared = fragments.alias("f").join(several.alias("s"), F.col("f.conv_id").eqNullSafe(F.col("s.conv_id")), "left_semi")
        left = _ends(work, shared, most)
        meet = F.col("f.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("f.block") == F.col("e.block"))
        chosen = fragments.alias("f").join(left.alias("e"), meet, "left").select("f.*", F.coalesce("e.ends", end).alias("ends"))
    paths, _ = work.materialize(chosen.mapInArrow(_paths, "conv_id bigint, block bigint, audits array<string>, states array<int>, costs array<bigint>, illegal bigint, outer array<int>"), "paths")
    entered = paths.withColumn("entry", F.lit(START))
    if most > 1:
        of_several = paths.alias("f").join(several.alias("s"), F.col("f.conv_id").eqNullSafe(F.col("s.conv_id")), "left_semi")
        entries = _entries(work, of_several, most)
        meet = F.col("f.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("f.block") == F.col("e.block"))
        entered = paths.alias("f").join(entries.alias("e"), meet, "left").select("f.*", F.coalesce("e.entry", F.lit(START)).alias("entry"))

    # one audit a fragment is collected: together they are the text of the conversation's audit
    piece = F.struct("block", F.get("audits", F.col("entry")).alias("audit"), "outer")
    whole = entered.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(piece)).alias("pieces"), F.sum("illegal").alias("illegal"), F.min_by(F.get("costs", F.lit(START)), "block").alias("cost"),
        F.max_by(F.get("states", F.col("entry")), "block").alias("state"),
    )

    def meet_next(seen: Column, piece: Column) -> Column:
        illegal = (seen["last"] >= 0) & ~_legal(seen["last"], F.get(piece["outer"], F.lit(0)))
        return F.struct(F.get(piece["outer"], F.lit(1)).alias("last"), (seen["n"] + illegal.cast("bigint")).alias("n"))

    between = F.aggregate("pieces", F.struct(F.lit(-1).alias("last"), F.lit(0).cast("bigint").alias("n")), meet_next)["n"]
    audit = F.concat(F.array_join(F.transform("pieces", lambda p: p["audit"]), ""), F.get(F.array(*[F.lit(x) for x in _END_AUDIT]), F.col("state")))
    whole = whole.select("conv_id", (F.col("illegal") + between).alias("illegal"), "cost", audit.alias("audit"))
    plan = counts.alias("c").join(whole.alias("w"), F.col("c.conv_id").eqNullSafe(F.col("w.conv_id")))
    plan = plan.select("c.*", "w.illegal", "w.cost", "w.audit")
    return work.materialize(plan, "plan")[0]


# -- the repaired rows ----------------------------------------------------------------------------------------------------


REPAIRED = "conv_id bigint, place bigint, turn bigint, role string, text string, edit string"
_EDITS = {"I": "insert", "D": "delete", "K": "keep", "R": "rerole"}


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a conversation, its audit before them, as repaired rows."""
    conv_id, audit, at, state, place = None, "", 0, START, 0
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
    out: list[tuple] = []

    def put(turn, role, text, edit):
        nonlocal place, state
        out.append((conv_id, place, turn, role, text, _EDITS[edit]))
        place += 1
        state = _AFTER[role[0]][state]

    def insert():
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            put(None, _NEXT_ROLE[state], "", "I")
            at += 1

    def rows():
        columns = list(zip(*out)) or [()] * len(schema)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        for part in slices(batch, "text", PASSED):
            for owner, begins, turn, role, text in zip(*[part.column(c).to_pylist() for c in ("conv_id", "audit", "turn", "role", "text")]):
                if begins is not None:
                    insert()
                    conv_id, audit, at, state, place = owner, begins, 0, START, 0
                    continue
                insert()
                edit = audit[at]
                at += 1
                if edit != "D":
                    put(turn, _NEXT_ROLE[state] if edit == "R" else role, text, edit)
            yield rows()
    insert()
    yield rows()


def apply_repairs(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The repaired rows of each conversation, from the rows and their ``plan_repairs``: conv_id, place from 0, turn (NULL where inserted), role, text, and the edit.

    Rows of a conversation come in order in one partition; they stream through it, so memory is that of a batch and of one audit.
    """
    given = ordered(rows).select("conv_id", F.lit(None).cast("string").alias("audit"), *ORDER, "text")
    head = plan.select("conv_id", "audit", *[F.lit(None).cast(k).alias(c) for c, k in (("turn", "bigint"), ("role", "string"), ("hash_1", "bigint"), ("hash_2", "bigint"), ("text", "string"))])
    both = head.unionByName(given).repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *ORDER)
    return both.select("conv_id", "audit", "turn", "role", "text").mapInArrow(_walk, REPAIRED)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation; its rows follow one another."""
    held, digest = None, None
    for batch in batches:
        done = []
        for conv_id, place, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")]):
            if place == 0:
                if digest:
                    done.append((held, digest.hexdigest()))
                held, digest = conv_id, hashlib.sha256()
            digest.update(f"{chr(10) * (place > 0)}{role}:{text}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], ["conv_id", "repaired_sha256"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([held], pa.int64()), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by the CRC-32 of conversation and turn: rows dropped, emptied, without ends of sentences, repeated, or of role user."""
    conv, turn = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    text, role = [F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role")]
    kind = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    rows = rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), kind.alias("kind"),
    )
    copies = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return rows.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("kind", "copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every conversation after damage, as an audit and a digest of the repaired rows."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = damage(given)
    plan = plan_repairs(rows)
    digests = apply_repairs(rows, plan).mapInArrow(_digest, "conv_id bigint, repaired_sha256 string")
    every = given.select("conv_id").distinct().alias("g").join(plan.alias("p"), F.col("g.conv_id").eqNullSafe(F.col("p.conv_id")), "left")
    every = every.select(F.col("g.conv_id").alias("conv_id"), *[F.coalesce(f"p.{c}", F.lit(0)).alias(c) for c in COUNTS], F.coalesce("p.audit", F.lit("")).alias("audit"))
    digest = F.coalesce("d.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return every.alias("e").join(digests.alias("d"), F.col("e.conv_id").eqNullSafe(F.col("d.conv_id")), "left").select("e.*", digest)
