r"""Repair of damaged conversations by Hirschberg's divide and conquer.

A repaired conversation is empty, or an optional system message and then pairs of user and assistant messages. Each
message is kept (cost 0), given the role user or assistant (1) or deleted (2, and required where it is blank or
repeats an earlier one); messages without text may be put in anywhere (5); a message that ends without ``.``, ``!``
or ``?`` and is not deleted adds 5. Of all cheapest series of edits the one counts whose initials (D, I, K, R) come first in ASCII order.

What was written so far is in one of four states: nothing, system, user, assistant. A vector holds, for every state,
the least cost of reaching it and the rank of the least audit among the four. The vector from the front and the
costs from the back meet in the middle; of the cheapest crossings the one with the least rank is taken, and
both halves are solved alike. Nothing but the vectors is held, so space is linear in the messages.

The same meeting works on whole blocks, since a block of messages is a four by four table of costs and ranks. Messages
are ordered by range partitions of all order columns and cut into blocks of at most ``BLOCK``. A conversation within one
block is solved there. A longer one is folded block by block, partition by partition and then by ``FAN`` partitions,
its crossings are handed down the same way, and its blocks are solved in parallel: no task holds a long
conversation. Only the digest of a conversation reads its messages in one task, as a stream, because a hash has an order.

Defined results: null roles and texts are one blank; messages are ordered by turn (nulls first), then role, then MD5 of the
text; messages that repeat are told apart and all but the first deleted; a null conversation id is a
conversation of its own; columns beside the named ones are dropped; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from millrace.llm.common import keep

# Costs of the edits.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEVER = 1 << 40
BLOCK = 4096
FAN = 64
# Faults of a message, and its role by initial: together one letter from A to P.
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
INITIALS = "sua"
WHITE = " \t\n\x0b\x0c\r"

Table = tuple[int, ...]  # 16 costs and 16 ranks, by state before and state after
Vector = tuple[int, ...]  # 4 costs and 4 ranks


def _inserted(state: int) -> tuple[int, str]:
    return (ASSISTANT, "a") if state == USER else (USER, "u")


@lru_cache
def letter_steps(letter: str) -> tuple[list[list[tuple[int, str, str] | None]], Table]:
    """Best edits of a message by states before and after: (cost, audit, steps); and the same as a table.

    Steps say what is written: ``u`` and ``a`` are put in, then K, D, or a new role U or A.
    """
    fault, initial = divmod(ord(letter) - 65, 4)
    best: list[list[tuple[int, str, str] | None]] = [[None] * 4 for _ in STATES]

    def offer(before: int, after: int, cost: int, audit: str, steps: str) -> None:
        held = best[before][after]
        if held is None or (cost, audit) < held[:2]:
            best[before][after] = (cost, audit, steps)

    for before in STATES:
        state, put = before, ""
        for n in range(3):
            cost, mark = n * INSERT, "I" * n
            offer(before, state, cost + DELETE, mark + "D", put + "D")
            if fault in (SOUND, TRUNCATED):
                extra = cost + (CUT_OFF if fault == TRUNCATED else 0)
                follows, role = _inserted(state)
                if initial < 3 and (follows == initial + 1 or (initial == 0 and state == NOTHING)):
                    offer(before, initial + 1, extra + KEEP, mark + "K", put + "K")
                offer(before, follows, extra + REROLE, mark + "R", put + role.upper())
            state, role = _inserted(state)
            put += role
    costs, ranks = [], []
    for row in best:
        costs += [x[0] if x else NEVER for x in row]
        order = sorted(x[1] for x in row if x)
        ranks += [order.index(x[1]) if x else 4 for x in row]
    return best, (*costs, *ranks)


def unit(state: int) -> Vector:
    return (*(0 if s == state else NEVER for s in STATES), *(0 if s == state else 4 for s in STATES))


def forward(vector: Vector, table: Table) -> Vector:
    """The vector after a message or block."""
    found = []
    for after in STATES:
        found.append(min(
            ((vector[s] + table[4 * s + after], vector[4 + s], table[16 + 4 * s + after]) for s in STATES
             if vector[s] < NEVER and table[4 * s + after] < NEVER), default=(NEVER, 4, 4)))
    order = sorted({x[1:] for x in found})
    return (*(x[0] for x in found), *(order.index(x[1:]) for x in found))


def backward(costs: tuple[int, ...], table: Table) -> tuple[int, ...]:
    """Least costs to the end from each state before a message or block."""
    return tuple(min(NEVER, *(table[4 * s + after] + costs[after] for after in STATES)) for s in STATES)


@lru_cache(1 << 16)
def _forward_letter(vector: Vector, letter: str) -> tuple[int, Vector]:
    after = forward(vector, letter_steps(letter)[1])
    least = min(after[:4])
    return least, (*(c - least if c < NEVER else NEVER for c in after[:4]), *after[4:])


@lru_cache(1 << 16)
def _backward_letter(costs: tuple[int, ...], letter: str) -> tuple[int, tuple[int, ...]]:
    before = backward(costs, letter_steps(letter)[1])
    least = min(before)
    return least, tuple(c - least if c < NEVER else NEVER for c in before)


def _sweep(vector: Vector, parts: Sequence[Table | str]) -> Vector:
    # Letters repeat, so their steps are looked up from vectors without their common cost.
    total = 0
    for part in parts:
        if isinstance(part, str):
            least, vector = _forward_letter(vector, part)
            total += least
        else:
            vector = forward(vector, part)
    return (*(c + total if c < NEVER else NEVER for c in vector[:4]), *vector[4:])


def _sweep_back(costs: tuple[int, ...], parts: Sequence[Table | str]) -> tuple[int, ...]:
    total = 0
    for part in reversed(parts):
        if isinstance(part, str):
            least, costs = _backward_letter(costs, part)
            total += least
        else:
            costs = backward(costs, part)
    return tuple(c + total if c < NEVER else NEVER for c in costs)


def crossing(front: Vector, back: tuple[int, ...]) -> int:
    """The state in which the cheapest, then audit-least, way passes."""
    return min((front[s] + back[s], front[4 + s], s) for s in STATES)[2]


def fold(parts: Sequence[Table | str]) -> Table:
    """One table for a row of messages or blocks."""
    vectors = [_sweep(unit(s), parts) for s in STATES]
    return (*(c for v in vectors for c in v[:4]), *(r for v in vectors for r in v[4:]))


def crossings(parts: Sequence[Table | str], first: int, last: int) -> list[int]:
    """States between the parts, from ``first`` to ``last``, by divide and conquer."""
    if len(parts) <= 1:
        return [first, last]
    middle = len(parts) // 2
    left, right = parts[:middle], parts[middle:]
    met = crossing(_sweep(unit(first), left), _sweep_back(unit(last)[:4], right))
    return crossings(left, first, met)[:-1] + crossings(right, met, last)


# What has to be put in at the end, by state, and its cost.
TAIL = ("", "ua", "a", "")
TAIL_COSTS = tuple(INSERT * len(t) for t in TAIL)


def final_state(front: Vector) -> int:
    return crossing(front, TAIL_COSTS)


def solve(letters: str, first: int = NOTHING, last: int | None = None) -> list[str]:
    """Steps of each message; without ``last`` the messages are all there are, and what closes them is in the last steps."""
    end = final_state(_sweep(unit(first), letters)) if last is None else last
    states = crossings(letters, first, end)
    steps = [letter_steps(x)[0][a][b][2] for x, a, b in zip(letters, states, states[1:], strict=False)]
    if last is None and steps:
        steps[-1] += TAIL[end]
    return steps


AUDIT = str.maketrans("uaKDUA", "IIKDRR")
STEP_COSTS = {"u": INSERT, "a": INSERT, "K": KEEP, "D": DELETE, "U": REROLE, "A": REROLE}
ROLES = {"u": "user", "a": "assistant", "U": "user", "A": "assistant"}

BLOCK_KEYS = ("conversation", "pid", "block")


def _place(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Messages in order: partitions hold ranges of all order columns, and ``pos`` counts inside one."""
    blank = F.lit(" ")
    named = rows.select(
        F.col(f"`{conversation}`").alias("conversation"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), blank).alias("role"), F.coalesce(F.col(f"`{text}`").cast("string"), blank).alias("text"))
    # The row number last: copies of one message may fill many partitions, and bounds hold no texts.
    order = ("conversation", "turn", "role", "digest", "row")
    ranged = named.withColumns({"digest": F.md5("text"), "row": F.monotonically_increasing_id()}).repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).select(
        "conversation", "turn", "role", "text", F.spark_partition_id().alias("pid"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("pos"))
    return keep(placed.withColumn("block", F.floor(F.col("pos") / BLOCK)), "messages")


def _letters(placed: DataFrame) -> DataFrame:
    """Blocks of at most ``BLOCK`` messages of one conversation, each message one letter."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    at = F.struct("pid", "pos")
    seen = placed.select(
        *BLOCK_KEYS, "pos", F.sha2(F.concat_ws("\n", F.length("role"), "role", "text"), 256).alias("same"),
        (F.length(F.ltrim(bare, F.lit(WHITE))) == 0).alias("blank"), F.right(bare, F.lit(1)).isin(".", "!", "?").alias("closed"),
        F.when(F.length("role") > 0, F.instr(F.lit(INITIALS), F.substring("role", 1, 1))).otherwise(0).alias("initial"))
    # Only what repeats is joined back; counting folds in every task first.
    repeated = seen.filter("NOT blank").groupBy("conversation", "same").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    other = repeated.select(F.col("conversation").alias("_c"), F.col("same").alias("_same"), "first")
    joined = seen.join(other, seen["conversation"].eqNullSafe(other["_c"]) & (seen["same"] == other["_same"]), "left")
    fault = F.when(F.col("blank"), BLANK).when(at > F.col("first"), DUPLICATE).when(~F.col("closed"), TRUNCATED).otherwise(SOUND)
    initial = F.when(F.col("initial") > 0, F.col("initial") - 1).otherwise(3)
    coded = joined.select(*BLOCK_KEYS, "pos", F.char(F.lit(65) + fault * 4 + initial).alias("letter"))
    return coded.groupBy(*BLOCK_KEYS).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("pos", "letter"))), lambda x: x["letter"]), "").alias("letters"))


def _tables(blocks: DataFrame) -> DataFrame:
    """The table of each block."""
    @F.pandas_udf(ArrayType(LongType()))
    def table(letters: pd.Series) -> pd.Series:
        return letters.map(lambda x: list(fold(x)))

    return blocks.select(*BLOCK_KEYS, table("letters").alias("table"))


def _node(level: int) -> Column:
    """Number of a node: its partition, then ranges of ``FAN`` to the power of the level."""
    return F.floor(F.col("pid") / FAN ** level)


def _fold_up(nodes: DataFrame, level: int) -> DataFrame:
    """Parents of nodes (conversation, node, part, table): one table for all parts of a node."""
    schema = StructType([nodes.schema["conversation"], StructField("node", LongType()), StructField("table", ArrayType(LongType()))])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        parts = [tuple(t) for t in group.sort_values("part")["table"]]
        return pd.DataFrame({"conversation": group["conversation"].iloc[:1], "node": group["node"].iloc[:1], "table": [list(fold(parts))]})

    return keep(nodes.groupBy("conversation", "node").applyInPandas(run, schema), f"fold-{level}")


def _hand_down(nodes: DataFrame, ends: DataFrame, level: int) -> DataFrame:
    """States before and after each part, from those of its node."""
    node = ends.select(F.col("conversation").alias("_c"), F.col("node").alias("_n"), "first", "last")
    joined = nodes.join(node, nodes["conversation"].eqNullSafe(node["_c"]) & (nodes["node"] == node["_n"])).drop("_c", "_n")
    schema = StructType([nodes.schema["conversation"], *[StructField(n, LongType()) for n in ("node", "part", "first", "last")]])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        states = crossings([tuple(t) for t in group["table"]], int(group["first"].iloc[0]), int(group["last"].iloc[0]))
        return group[["conversation", "node", "part"]].assign(first=states[:-1], last=states[1:])

    return keep(joined.groupBy("conversation", "node").applyInPandas(run, schema), f"states-{level}")


def _block_ends(blocks: DataFrame) -> DataFrame | None:
    """States before and after each block of the conversations with several blocks, and whether it is the last; none without such."""
    several = blocks.groupBy("conversation").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("pid", "block")).alias("end")).filter("n > 1")
    of = several.select(F.col("conversation").alias("_c"), "end")
    chosen = blocks.join(of, blocks["conversation"].eqNullSafe(of["_c"])).drop("_c")
    tables = keep(_tables(chosen), "tables")
    most = tables.agg(F.max("pid")).first()[0]
    if most is None:
        return None
    # Level 0 folds the blocks of a partition, level k the nodes of level k - 1 by FAN.
    levels = [tables.select("conversation", F.col("pid").cast("long").alias("node"), F.col("block").alias("part"), "table")]
    while True:
        folded = _fold_up(levels[-1], len(levels))
        reach = FAN ** (len(levels) - 1)
        if most < reach:
            break
        levels.append(folded.select("conversation", F.floor(F.col("node") / FAN).alias("node"), F.col("node").alias("part"), "table"))

    @F.pandas_udf(LongType())
    def last_state(folded_tables: pd.Series) -> pd.Series:
        return folded_tables.map(lambda t: final_state((*(int(x) for x in t[:4]), *(int(x) for x in t[16:20]))))

    ends = folded.select("conversation", "node", F.lit(NOTHING).cast("long").alias("first"), last_state("table").alias("last"))
    for i, nodes in reversed(list(enumerate(levels))):
        ends = _hand_down(nodes, ends, i)
        if i:
            ends = ends.select("conversation", F.col("part").alias("node"), "first", "last")
    found = ends.select("conversation", F.col("node").alias("pid"), F.col("part").alias("block"), "first", "last")
    return found.join(of, found["conversation"].eqNullSafe(of["_c"])).select(
        "conversation", "pid", "block", "first", "last", (F.struct(F.col("pid").cast("int"), "block") == F.col("end")).alias("closing"))


def _solved(blocks: DataFrame) -> DataFrame:
    """Every block with the steps of its messages."""
    @F.pandas_udf(ArrayType(StringType()))
    def whole_steps(letters: pd.Series) -> pd.Series:
        return letters.map(solve)

    ends = _block_ends(blocks)
    if ends is None:
        return blocks.select(*BLOCK_KEYS, "letters", whole_steps("letters").alias("steps"))
    other = ends.select(*[F.col(k).alias(f"_{k}") for k in BLOCK_KEYS], "first", "last", "closing")
    joined = blocks.join(
        other, blocks["conversation"].eqNullSafe(other["_conversation"]) & (blocks["pid"] == other["_pid"]) & (blocks["block"] == other["_block"]), "left")

    @F.pandas_udf(ArrayType(StringType()))
    def steps(letters: pd.Series, first: pd.Series, last: pd.Series, closing: pd.Series) -> pd.Series:
        def one(x: str, a: float, b: float, closes: object) -> list[str]:
            if pd.isna(a):
                return solve(x)
            found = solve(x, int(a), int(b))
            if closes:
                found[-1] += TAIL[int(b)]
            return found

        return pd.Series([one(*row) for row in zip(letters, first, last, closing, strict=True)])

    return joined.select(*BLOCK_KEYS, "letters", steps("letters", "first", "last", "closing").alias("steps"))


@dataclass(frozen=True)
class Repair:
    """Ordered messages and their solved blocks, from which messages or digests are read."""

    placed: DataFrame
    blocks: DataFrame

    def messages(self) -> DataFrame:
        """Repaired messages: ``conversation, place`` (an array that orders them), ``edit`` and ``turn, role, text``.

        Deleted messages are not among them; those put in have a null turn and an empty text. Blocks are read side by
        side, so a long conversation is spread over tasks.
        """
        block = self.blocks.select(*[F.col(k).alias(f"_{k}") for k in BLOCK_KEYS], "steps")
        joined = self.placed.join(block, self.placed["conversation"].eqNullSafe(block["_conversation"]) & (
            self.placed["pid"] == block["_pid"]) & (self.placed["block"] == block["_block"]))
        # Positions of a block follow one another, so the place of a message in it is known from the first.
        first = self.placed.groupBy(*BLOCK_KEYS).agg(F.min("pos").alias("_first")).select(
            *[F.col(k).alias(f"_f_{k}") for k in BLOCK_KEYS], "_first")
        joined = joined.join(first, joined["conversation"].eqNullSafe(first["_f_conversation"]) & (
            joined["pid"] == first["_f_pid"]) & (joined["block"] == first["_f_block"]))
        steps = F.element_at("steps", (F.col("pos") - F.col("_first") + 1).cast("int"))
        each = joined.select("conversation", "pid", "pos", "turn", "role", "text", F.posexplode(F.split(steps, "")).alias("sub", "step"))
        own = F.col("step").isin("K", "U", "A")
        names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
        return each.filter("step NOT IN ('D', '')").select(
            "conversation", F.array(F.col("pid").cast("long"), "pos", F.col("sub").cast("long")).alias("place"),
            F.translate("step", "uaKUA", "IIKRR").alias("edit"), F.when(own, F.col("turn")).alias("turn"),
            F.coalesce(names[F.col("step")], F.col("role")).alias("role"), F.when(own, F.col("text")).otherwise("").alias("text"))

    def audits(self, conversations: DataFrame | None = None) -> DataFrame:
        """One row per conversation: ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

        ``conversations`` (one column) names conversations that may have no message left. Messages of a
        conversation are hashed in order as they stream through one task.
        """
        nothing = F.lit(None)
        rows = self.placed.select(
            *BLOCK_KEYS, F.lit(1).alias("kind"), "pos", F.col("turn").cast("long").alias("turn"), "role", "text",
            nothing.cast("string").alias("letters"), nothing.cast("array<string>").alias("steps"))
        heads = self.blocks.select(
            *BLOCK_KEYS, F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("pos"), nothing.cast("long").alias("turn"),
            nothing.cast("string").alias("role"), nothing.cast("string").alias("text"), "letters", "steps")
        both = rows.unionByName(heads)
        if conversations is not None:
            names = conversations.select(F.col(f"`{conversations.columns[0]}`").alias("conversation")).distinct()
            both = both.unionByName(names.select("conversation", F.lit(-1).alias("pid"), F.lit(0).cast("long").alias("block"), F.lit(0).alias("kind")),
                                    allowMissingColumns=True)
        sorted_ = both.repartition("conversation").sortWithinPartitions("conversation", "pid", "block", "kind", "pos")
        counts = [StructField(n, LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        schema = StructType([rows.schema["conversation"], *counts, StructField("audit", StringType()), StructField("repaired_sha256", StringType())])
        arrow = {f.name: pa.int64() if isinstance(f.dataType, LongType) else pa.string() for f in schema.fields[1:]}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            told: list[tuple] = []
            digest: _Digest | None = None
            kind = None

            def send() -> pa.RecordBatch:
                columns = list(zip(*told, strict=True))
                made = [pa.array(columns[0], kind), *[pa.array(c, t) for c, t in zip(columns[1:], arrow.values(), strict=True)]]
                told.clear()
                return pa.RecordBatch.from_arrays(made, names=[f.name for f in schema.fields])

            for batch in batches:
                kind = batch.schema.field("conversation").type
                names = batch.schema.names
                for row in zip(*(batch.column(c).to_pylist() for c in range(len(names))), strict=True):
                    name, _, _, mark, _, turn_, role_, text_, letters, steps = row
                    if digest is None or name != digest.name:
                        if digest is not None:
                            told.append(digest.row())
                        digest = _Digest(name)
                    if mark == 1:
                        digest.message(turn_, role_, text_)
                    elif letters is not None:
                        digest.block(letters, steps)
                if len(told) >= 4096:
                    yield send()
            if digest is not None:
                told.append(digest.row())
                yield send()

        return sorted_.mapInArrow(run, schema)


class _Digest:
    """What is known of a conversation after the messages read so far."""

    def __init__(self, name: object) -> None:
        self.name, self.steps, self.counts = name, iter(()), [0] * 4
        self.illegal = self.cost = self.turns = 0
        self.least: int | None = None
        self.turn: int | None = None
        self.before: str | None = None
        self.audit: list[str] = []
        self.sha, self.written = hashlib.sha256(), False

    def block(self, letters: str, steps: list[str]) -> None:
        self.steps = iter(zip(letters, steps, strict=True))

    def _write(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.written else "") + role + ":" + text).encode())
        self.written = True

    def message(self, turn: int | None, role: str, text: str) -> None:
        letter, steps = next(self.steps)
        fault = (ord(letter) - 65) // 4
        self.counts[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.turn, self.turns = turn, self.turns + 1
        self.audit.append(steps.translate(AUDIT))
        for step in steps:
            self.cost += STEP_COSTS[step] + (CUT_OFF if fault == TRUNCATED and step in "KUA" else 0)
            if step in "KUA":
                self._write(ROLES.get(step, role), text)
            elif step in "ua":
                self._write(ROLES[step], "")

    def row(self) -> tuple:
        gaps = self.turn - self.least + 1 - self.turns if self.least is not None else 0
        return (self.name, gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[TRUNCATED], self.illegal, self.cost,
                "".join(self.audit), self.sha.hexdigest())


def repair_conversations(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Order, judge and solve all conversations. Jobs run when called: ordered messages and folded blocks are kept."""
    placed = _place(rows, conversation, turn, role, text)
    return Repair(placed, keep(_solved(keep(_letters(placed), "letters")), "steps"))
