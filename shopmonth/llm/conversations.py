"""Conversation repair: cheapest edits that make turns alternate, found by auctions on a lattice.

Rows are ordered by turn (null first), then role, then text. Faults and role initials
are columns; a conversation is then one byte per row, and ``lattice`` finds the
cheapest edits. Conversations of up to ``long_rows`` rows are sorted together and
solved one after the other as they stream by. Longer ones never meet in one task
before they are solved: their rows are sorted by range, cut into blocks, the cost of
crossing each block is found for all states, costs are added up from the last block
back (one short row per block), and blocks are traced with the prices behind them.
Only the digest of the repaired text needs the rows one after the other, and they
stream by in bounded memory.

Defined results: a null role or text is one blank, as in the damage; conversations
without an id are one conversation; rows with equal turns are ordered by role and text,
so repeated rows are neighbours and all but the first are duplicates. A conversation
all of whose rows are gone has zeros and no edits. An empty table gives no rows, and
columns that are not named are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import join_facts
from ..sources.workdir import stage
from . import lattice

LONG_ROWS = 20_000
BLOCK = 4096
BLANKS = " \t\n\x0b\x0c\r"
REMEMBERED = 64  # solutions of conversations up to this many rows are kept per process

FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
INITIALS = {"s": lattice.SYSTEM, "u": lattice.USER, "a": lattice.ASSISTANT}
LEGAL = {(lattice.SYSTEM, lattice.USER), (lattice.USER, lattice.ASSISTANT), (lattice.ASSISTANT, lattice.USER)}


def prepared(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """``key, conv, turn, role, text`` and how often the row stands there (``copies``)."""
    conv = F.col(conv_col)
    return rows.select(
        F.when(conv.isNull(), "null").otherwise(F.concat(F.lit("="), conv.cast("string"))).alias("key"),
        conv.alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        F.lit(1).alias("copies"))


def damaged(rows: DataFrame) -> DataFrame:
    """The test damage on prepared rows, by the checksum of conversation and turn; dropped rows have no copies."""
    name = F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), F.lit(" ")),
                       F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(F.encode(name, "UTF-8")) % 20
    text = (F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    return rows.select("key", "conv", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(F.col("copies")).alias("copies"))


def _marked(rows: DataFrame) -> DataFrame:
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", lattice.SYSTEM).when(initial == "u", lattice.USER).when(initial == "a", lattice.ASSISTANT)
    return rows.select("*", (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
                       F.coalesce(number, F.lit(0)).alias("initial"))


ORDER = ("key", "turn", "role", "text")  # ascending, null first


# What a conversation is told about a row.
ROW = ("turn", "role", "text", "blank", "cut", "initial", "again", "letters")
TURNS = {lattice.USER: "user", lattice.ASSISTANT: "assistant"}


def code_of(blank: bool, again: bool, cut: bool, initial: int) -> int:
    return initial + (lattice.MUST_GO if blank or again else lattice.TRUNCATED if cut else 0)


@lru_cache(maxsize=1 << 16)
def _solved_short(codes: bytes) -> str:
    return lattice.trace(codes, lattice.settle(codes))[0]


def solved(codes: bytes) -> str:
    """Letters of the cheapest edits."""
    return (_solved_short if len(codes) <= REMEMBERED else _solved_short.__wrapped__)(codes)


def behind_last(state: int) -> str:
    """Insertions behind the last row."""
    return lattice.trace(b"", lattice.settle(b"", origins=range(lattice.STATES)), state)[0]


class _Conversation:
    """One conversation as its rows stream by; rows wait only where their edits are not known yet."""

    def __init__(self, conv, known: bool):
        self.conv, self.known = conv, known
        self.first_turn, self.last_turn, self.turns = None, None, 0
        self.counts = dict.fromkeys(FIGURES, 0)
        self.last_initial: int | None = None
        self.seen: set[tuple[str, str]] = set()
        self.waiting: list[tuple[str, str, int]] = []
        self.audit: list[str] = []
        self.letters, self.at, self.state = "", 0, lattice.START
        self.sha, self.position = hashlib.sha256(), 0
        self.turns_out: list[tuple] = []

    def add(self, turn, role: str, text: str, blank: bool, cut: bool, initial: int, again: bool, letters: str | None) -> None:
        if turn is not None and (self.turns == 0 or turn != self.last_turn):
            self.first_turn = turn if self.turns == 0 else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        self.counts["illegal"] += self.last_initial is not None and (self.last_initial, initial) not in LEGAL
        self.last_initial = initial
        if not self.known:
            again = (role, text) in self.seen
            self.seen.add((role, text))
        if blank or again or cut:
            self.counts["blank" if blank else "duplicate" if again else "truncated"] += 1
        code = code_of(blank, again, cut, initial)
        if self.known:
            if letters is not None:
                self.give(letters)
            self.take(role, text, code)
        else:
            self.waiting.append((role, text, code))

    def give(self, letters: str) -> None:
        """The letters of the rows that come now."""
        self.audit.append(letters)
        self.letters, self.at = letters, 0

    def take(self, role: str, text: str, code: int) -> None:
        """Apply the letters up to that of one row."""
        self.insert()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "D":
            self.counts["cost"] += lattice.DELETE
            return
        self.counts["cost"] += lattice.TRUNCATED_STAYS if code & lattice.TRUNCATED else 0
        if letter == "K":
            self.state = code & 3
        else:
            self.counts["cost"] += lattice.RENAME
            self.state = lattice.NEXT_TURN[self.state]
            role = TURNS[self.state]
        self.put(role, text)

    def insert(self) -> None:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            self.counts["cost"] += lattice.INSERT
            self.state = lattice.NEXT_TURN[self.state]
            self.put(TURNS[self.state], "")

    def put(self, role: str, text: str) -> None:
        line = f"{role}:{text}".encode()
        self.sha.update(b"\n" + line if self.position else line)
        self.turns_out.append((self.conv, self.position, role, text))
        self.position += 1

    def figures(self) -> tuple:
        """Ends the conversation."""
        if self.known:
            self.give(behind_last(self.state))
        else:
            self.give(solved(bytes(code for _, _, code in self.waiting)))
            for row in self.waiting:
                self.take(*row)
        self.insert()
        self.counts["gaps"] = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (self.conv, *self.counts.values(), "".join(self.audit), self.sha.hexdigest())


def _streamed(rows: DataFrame, turns: bool, known: bool) -> DataFrame:
    """Rows in order, conversations together: their figures, or the turns that their edits leave."""
    conv_type = rows.schema["conv"].dataType
    schema = T.StructType([T.StructField("conv", conv_type)] + (
        [T.StructField("position", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
        if turns else [*[T.StructField(name, T.LongType()) for name in FIGURES],
                       T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, figures = None, None, []
        conv_arrow = pa.null()

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            columns = [list(c) for c in zip(*found)] or [[] for _ in schema.fields]
            kinds = [conv_arrow] + ([pa.int64(), pa.string(), pa.string()] if turns else [pa.int64()] * len(FIGURES) + [pa.string()] * 2)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

        for batch in batches:
            conv_arrow = batch.schema.field("conv").type
            columns = batch.to_pydict()
            out: list[tuple] = []
            for k, name, conv, copies, *row in zip(range(batch.num_rows), *(columns[c] for c in ("key", "conv", "copies", *ROW))):
                if name != key:
                    if now is not None:
                        figures.append(now.figures())
                        out += now.turns_out
                    key, now = name, _Conversation(conv, known)
                for _ in range(copies):
                    now.add(*row)
                if now.turns_out:
                    out, now.turns_out = (out + now.turns_out if turns else []), []
            yield batch_of(out if turns else figures)
            figures = []
        if now is not None:
            figures.append(now.figures())
            yield batch_of(now.turns_out if turns else figures)

    return rows.select("key", "conv", "copies", *ROW).mapInArrow(stream, schema)


def _sorted_short(rows: DataFrame) -> DataFrame:
    marked = _marked(rows).select("*", F.lit(False).alias("again"), F.lit(None).cast("string").alias("letters"))
    return marked.repartition("key").sortWithinPartitions(*ORDER)


def _blocks_of_long(rows: DataFrame, block: int) -> DataFrame:
    """Rows of long conversations in order, with their place, block and whether role and text were seen earlier; staged."""
    single = _marked(rows.where("copies > 0")).select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    single = single.drop("copies").withColumn("same", F.unhex(F.sha2(F.to_json(F.struct("key", "role", "text")), 256)))
    when = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    first = (single.groupBy("same").agg(F.min(when).alias("first"), F.max(when).alias("last")).where("first <> last")
             .select("same", F.col("first.has").alias("first_has"), F.col("first.turn").alias("first_turn")))
    joined = join_facts(single, stage(first, "first"), "same", "left")
    # A struct of nulls is smaller than any other, so rows without a partner are told apart first.
    is_later = F.col("first_has").isNotNull() & (when > F.struct(F.col("first_has").alias("has"), F.col("first_turn").alias("turn")))
    later = joined.select(*single.columns, is_later.alias("again"))
    size = max(1, -(-later.count() // block))
    ordered = later.repartitionByRange(size, *ORDER).sortWithinPartitions(*ORDER)
    schema = T.StructType([*ordered.schema.fields, T.StructField("block", T.LongType()), T.StructField("place", T.LongType()),
                           T.StructField("code", T.IntegerType()), T.StructField("copies", T.IntegerType())])
    names = ordered.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, before, at, place = None, None, (TaskContext.get().partitionId() << 32) - 1, 0
        for batch in batches:
            columns = batch.to_pydict()
            blocks, places, codes, again = [], [], [], []
            for name, turn, same, seen, blank, cut, initial in zip(
                    *(columns[c] for c in ("key", "turn", "same", "again", "blank", "cut", "initial"))):
                if name != key or place == block:
                    key, at, place = name, at + 1, 0
                # Equal rows are neighbours, and a range never ends between them.
                again.append(seen or (turn, same) == before)
                before = (turn, same)
                blocks.append(at)
                places.append(place)
                codes.append(code_of(blank, again[-1], cut, initial))
                place += 1
            arrays = [pa.array(again) if name == "again" else batch.column(k) for k, name in enumerate(names)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(blocks, pa.int64()), pa.array(places, pa.int64()),
                                              pa.array(codes, pa.int32()), pa.array([1] * len(codes), pa.int32())], names=schema.names)

    return stage(ordered.mapInArrow(number, schema), "long")


def _letters_of_blocks(rows: DataFrame) -> DataFrame:
    """``block, letters`` of the staged rows of long conversations."""
    codes = stage(rows.groupBy("key", "block").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("place", "code"))), lambda p: p["code"]).alias("codes")), "codes")

    def cross(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [sum(lattice.crossing(bytes(c.tolist())), []) for c in frame["codes"]]
            yield pd.DataFrame({"key": frame["key"], "block": frame["block"], "costs": found})

    def prices_behind(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block", ascending=False)
        behind, out = lattice.END_PRICES, []
        for costs in frame["costs"]:
            out.append(list(behind))
            behind = [min(lattice.NEVER, *(costs[lattice.STATES * a + b] + behind[b] for b in range(lattice.STATES))) for a in range(lattice.STATES)]
        return pd.DataFrame({"block": frame["block"], "behind": out})

    def follow(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            letters, states = [], []
            for code, behind in zip(frame["codes"], frame["behind"]):
                mine, behind = bytes(code.tolist()), behind.tolist()
                prices = lattice.settle(mine, behind, False, range(lattice.STATES))
                both = [lattice.trace(mine, prices, s, behind, False) for s in range(lattice.STATES)]
                letters.append([text for text, _ in both])
                states.append([state for _, state in both])
            yield pd.DataFrame({"key": frame["key"], "block": frame["block"], "letters": letters, "states": states})

    def enter(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        state, out = lattice.START, []
        for states in frame["states"]:
            out.append(state)
            state = int(states[state])
        return pd.DataFrame({"block": frame["block"], "state": out})

    crossed = codes.mapInPandas(cross, "key string, block long, costs array<long>")
    behind = stage(crossed.groupBy("key").applyInPandas(prices_behind, "block long, behind array<long>"), "behind")
    traced = stage(codes.join(behind, "block").mapInPandas(
        follow, "key string, block long, letters array<string>, states array<int>"), "traced")
    entered = traced.select("key", "block", "states").groupBy("key").applyInPandas(enter, "block long, state int")
    return traced.join(entered, "block").select("block", F.col("letters")[F.col("state")].alias("letters"))


def _sorted_long(rows: DataFrame, block: int) -> DataFrame:
    cut = _blocks_of_long(rows, block)
    letters = _letters_of_blocks(cut).withColumn("place", F.lit(0).cast("long"))
    given = cut.join(letters, ["block", "place"], "left")
    return given.repartition("key").sortWithinPartitions("key", "block", "place")


def _solved(rows: DataFrame, turns: bool, long_rows: int, block: int) -> DataFrame:
    sizes = rows.groupBy("key").agg(F.sum("copies").alias("n"))
    long = stage(sizes.where(F.col("n") > long_rows).select("key"), "long-names")
    if long.isEmpty():
        return _streamed(_sorted_short(rows), turns, False)
    short = _streamed(_sorted_short(join_facts(rows, long, "key", "left_anti")), turns, False)
    return short.unionByName(_streamed(_sorted_long(join_facts(rows, long, "key", "left_semi"), block), turns, True))


def judged(rows: DataFrame, long_rows: int = LONG_ROWS, block: int = BLOCK) -> DataFrame:
    """Per conversation of ``prepared`` rows: faults, cost, edits and the digest of the repaired text."""
    return _solved(rows, False, long_rows, block)


def repaired(rows: DataFrame, long_rows: int = LONG_ROWS, block: int = BLOCK) -> DataFrame:
    """The repaired conversations of ``prepared`` rows: ``conv, position, role, text``."""
    return _solved(rows, True, long_rows, block)
