"""Conversation structure repair by a backward cost-to-go and a greedy forward walk (operator 11).

The turns of a conversation shall have the roles ``(s?(ua)+)?`` by their first letters. A turn is kept (0), gets the role user or assistant (2)
or is deleted (3); an empty user or assistant turn is inserted anywhere (2). Blank turns and those that repeat an
earlier one have to go; a truncated one that stays costs 1 more.

The grammar has four states (start, after s, u, a). Backward over the turns, the cheapest cost of all that follows is
computed for each state; forward, the edit with the least letter (D, I, K, R) is taken among those that lie on a cheapest way. As every
letter leads to one state, that gives the least string of letters. Costs-to-go differ by little between states, so only
few sets of them occur: steps of both passes are looked up.

Turns are grouped in blocks of ``block`` turns. Conversations of one block, nearly all, are done in one pass after that one shuffle.
Of longer ones, each block gives its costs from any state to any other; a scan over these small rows from the end gives each block's
costs-to-go, with them each block says which state it leaves from which, a second scan gives the state each block is entered
in, and every block is walked by its own task. Turns that repeat one of an earlier block are found by their digests. No
task holds more of a conversation than a block, except for its digest, which streams through one task.

Defined results: turns come in the order of turn (nulls first), role, text. Null roles and texts count as one space; a
role without a first letter of s, u, a can't be kept. Rows with a null conversation id form one conversation. Repeated rows are duplicates. An empty table gives an empty
one. Texts have any length; other columns aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import ship, written

_SPACES = " \t\n\v\f\r"
_FAR = 1 << 30
_START, _USER = 0, 2
_GO = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})  # state by letter, of each state
_NEXT = ("u", "u", "a", "u")  # the letter of an inserted or renamed turn, by state
_ROLE = {"u": "user", "a": "assistant"}
_DELETE, _RENAME, _INSERT = 3, 2, 2
_GONE, _OTHER = 0, 3
_LETTERS = {"s": 0, "u": 1, "a": 2}
TURN = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Settings:
    block: int = 1_024  # turns that are repaired in one group


def _inserted(costs: list[int]) -> list[int]:
    """Costs-to-go, where turns may be inserted first."""
    for _ in range(3):
        costs = [min(c, _INSERT + costs[_GO[q][_NEXT[q]]]) for q, c in enumerate(costs)]
    return costs


class Walker:
    """Steps of both passes by row code (see ``code``), remembered."""

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.backs: dict[tuple[int, int], tuple[int, int]] = {}
        self.walks: dict[tuple[int, int, int], tuple[str, int, int]] = {}
        self.end, _ = self.number(_inserted([0, _FAR, _FAR, 0]))

    @staticmethod
    def code(letter: str, truncated: bool) -> int:
        """1 to 8 by first letter and truncation; 0 is a row that has to go."""
        return 1 + 2 * _LETTERS.get(letter, _OTHER) + truncated

    def number(self, costs) -> tuple[int, int]:
        """The number of a set of costs-to-go less their least, and this."""
        least = min(costs)
        key = tuple(_FAR if c >= _FAR else c - least for c in costs)
        if key not in self.numbers:
            self.numbers[key] = len(self.vectors)
            self.vectors.append(key)
        return self.numbers[key], least

    @staticmethod
    def options(q: int, code: int) -> Iterator[tuple[str, int, int]]:
        """Edits of a row, their cost and the state after, by letter."""
        yield "D", _DELETE, q
        if code != _GONE:
            letter, truncated = "sua?"[(code - 1) // 2], (code - 1) % 2
            if letter in _GO[q]:
                yield "K", truncated, _GO[q][letter]
            yield "R", _RENAME + truncated, _GO[q][_NEXT[q]]

    def _before(self, after: tuple[int, ...], code: int) -> list[int]:
        return _inserted([min(min(cost + after[to], _FAR) for _, cost, to in self.options(q, code)) for q in range(4)])

    def back(self, after: int, code: int) -> tuple[int, int]:
        key = (after, code)
        if key not in self.backs:
            self.backs[key] = self.number(self._before(self.vectors[after], code))
        return self.backs[key]

    def step(self, after: int, q: int, code: int) -> tuple[str, int, int]:
        """The least letters on a cheapest way over a row (insertions, then its edit), the state after, and their cost."""
        key = (after, q, code)
        if key not in self.walks:
            ahead = self.vectors[after]
            here, letters, spent = self._before(ahead, code), "", 0
            while not letters or letters[-1] == "I":
                ways = [(e, c, to) for e, c, to in self.options(q, code) if c + ahead[to] == here[q]]
                to = _GO[q][_NEXT[q]]
                if _INSERT + here[to] == here[q]:
                    ways.append(("I", _INSERT, to))
                edit, cost, q = min(ways)
                letters, spent = letters + edit, spent + cost
            self.walks[key] = letters, q, spent
        return self.walks[key]

    def trail(self, codes: bytes, end: int) -> list[int]:
        """The number of the costs-to-go after each row."""
        out = [end] * len(codes)
        for i in range(len(codes) - 1, 0, -1):
            out[i - 1], _ = self.back(out[i], codes[i])
        return out

    def through(self, codes: bytes, q: int, end: int) -> tuple[list[str], int, int]:
        """Letters of each row, the state after the last one, and the cost."""
        letters, cost = [], 0
        for after, code in zip(self.trail(codes, end), codes, strict=True):
            e, q, c = self.step(after, q, code)
            letters.append(e)
            cost += c
        return letters, q, cost

    def costs(self, codes: bytes) -> list[int]:
        """The cheapest cost from each state before the rows (first index) to each after them."""
        out = [[0] * 4 for _ in range(4)]
        for j in range(4):
            at, _ = self.number([0 if q == j else _FAR for q in range(4)])
            total = 0
            for code in reversed(codes):
                at, more = self.back(at, code)
                total += more
            for q in range(4):
                out[q][j] = min(self.vectors[at][q] + total, _FAR)
        return [c for row in out for c in row]


def _digest(role: str, text: str) -> str:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


class _Facts:
    """What a block's turns are: their codes and the counts of faults."""

    def __init__(self, turns: list[dict], seen: list[str] | None) -> None:
        known, earlier, codes = set(seen or ()), set(), bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.rows: list[tuple[str, str]] = []
        last = turn = None
        for t in turns:
            role, text = t["role"], t["text"]
            if t["known"] and t["turn"] != turn:
                turn, self.distinct = t["turn"], self.distinct + 1
            for _ in range(t["n"]):
                self.rows.append((role, text))
                letter, bare = role[:1], text.rstrip(_SPACES)
                truncated = bool(bare) and bare[-1] not in ".!?"
                repeated = bool(bare) and ((role, text) in earlier or bool(known) and _digest(role, text) in known)
                self.blank += not bare
                self.duplicate += repeated
                self.truncated += truncated and not repeated
                codes.append(_GONE if not bare or repeated else Walker.code(letter, truncated))
                if last is not None and last + letter not in ("su", "ua", "au"):
                    self.illegal += 1
                last = letter
                earlier.add((role, text))
        self.codes = bytes(codes)
        numbers = [t["turn"] for t in turns if t["known"]]
        self.fields = {
            "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "first": self.rows[0][0][:1], "last": last,
            "low": numbers[0] if numbers else None, "high": numbers[-1] if numbers else None, "n_turns": self.distinct,
        }


_FACTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, n_turns bigint"


def _apply(rows: list[tuple[str, str]], letters: list[str], q: int, more: str) -> list[dict]:
    """The turns after the edits, from state ``q`` on; ``more`` are insertions after the last row."""
    out = []
    for row, edits in zip([*rows, None], [*letters, more], strict=True):
        for e in edits:
            if e == "D":
                continue
            letter = row[0][:1] if e == "K" else _NEXT[q]
            out.append({"role": row[0] if e == "K" else _ROLE[letter], "text": "" if e == "I" else row[1]})
            q = _GO[q][letter]
    return out


def _mapped(df: DataFrame, fields: str, compute) -> DataFrame:
    """``compute()`` gives a function from one row (a dict) to one; rows of Arrow batches are handled one by one."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    schema = to_arrow_schema(StructType.fromDDL(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = compute()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield pa.RecordBatch.from_pylist([f(r) for r in batch.slice(at, 256).to_pylist()], schema)

    return df.mapInArrow(run, fields)


def _blocks(turns: DataFrame, s: Settings) -> DataFrame:
    """``cid, block, conv_id, turns``: each block's turns in order, equal ones counted. One shuffle, by block."""
    known, space = F.col("turn").isNotNull(), F.lit(" ")
    rows = turns.select("conv_id", known.alias("known"), F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    lone = lambda c: F.when(~F.col("known"), c).otherwise("")
    block = F.struct(F.col("known").alias("known"), F.floor(F.col("turn") / s.block).alias("number"), lone(F.col("role")).alias("role"), lone(F.substring("text", 1, 8)).alias("front"))
    key = ["cid", "block"]
    rows = rows.withColumns({"cid": F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")), "block": block})  # joins by a value without nulls
    alike = rows.repartition(*key).groupBy(*key, "conv_id", "known", "turn", "role", "text").agg(F.count("*").alias("n"))
    return alike.groupBy(*key, "conv_id").agg(F.array_sort(F.collect_list(F.struct("known", "turn", "role", "text", "n"))).alias("turns"))


def _seen(blocks: DataFrame) -> DataFrame:
    """``cid, block, seen``: digests of a block's turns that an earlier block has too."""
    t = F.explode("turns").alias("t")
    digest = F.sha2(F.concat(F.length("t.role").cast("string"), F.lit(":"), F.col("t.role"), F.col("t.text")).cast("binary"), 256)
    keys = blocks.select("cid", "block", t).select("cid", "block", digest.alias("d")).distinct()
    later = F.row_number().over(Window.partitionBy("cid", "d").orderBy("block"))
    return keys.withColumn("nth", later).where("nth > 1").groupBy("cid", "block").agg(F.collect_list("d").alias("seen"))


def _scan(df: DataFrame, fields: str, descending: bool, start, step) -> DataFrame:
    """Small rows of blocks, those of a conversation one after the other: ``step(state, row)`` gives the next state and the row to emit."""
    order = F.col("block").desc() if descending else F.col("block").asc()

    def compute():
        at: list = [None, None]

        def one(row):
            if row["cid"] != at[0]:
                at[:] = row["cid"], start
            at[1], out = step(at[1], row)
            return {"cid": row["cid"], "block": row["block"]} | out

        return one

    return _mapped(df.repartition("cid").sortWithinPartitions("cid", order), fields, compute)


def _entered(many: DataFrame, block_type: str) -> DataFrame:
    """``cid, block, entry, ahead, final`` of the blocks of long conversations: the state each is entered in and the costs-to-go after it."""
    key = f"cid string, block {block_type}"

    def facts():
        walker = Walker()

        def one(row):
            codes = _Facts(row["turns"], row["seen"]).codes
            return {"cid": row["cid"], "block": row["block"], "codes": codes, "costs": walker.costs(codes)}

        return one

    def behind(ahead, row):
        final = ahead is None
        ahead = _inserted([0, _FAR, _FAR, 0]) if final else ahead
        here = [min(row["costs"][4 * q + j] + ahead[j] for j in range(4)) for q in range(4)]
        least = min(here)
        return [c - least for c in here], {"codes": row["codes"], "ahead": ahead, "final": final}

    def exits():
        walker = Walker()

        def one(row):
            end, _ = walker.number(row["ahead"])
            out = {k: row[k] for k in ("cid", "block", "ahead", "final")}
            return out | {"exits": [walker.through(row["codes"], q, end)[1] for q in range(4)]}

        return one

    def along(q, row):
        return row["exits"][q], {"entry": q, "ahead": row["ahead"], "final": row["final"]}

    costs = written(_mapped(many, f"{key}, codes binary, costs array<bigint>", facts), "block-costs")
    ahead = _scan(costs, f"{key}, codes binary, ahead array<bigint>, final boolean", True, None, behind)
    left = _mapped(ahead, f"{key}, ahead array<bigint>, final boolean, exits array<int>", exits)
    return _scan(written(left, "block-exits"), f"{key}, entry int, ahead array<bigint>, final boolean", False, _START, along)


def repair(turns: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row a conversation and block: ``conv_id, cid, block, alone`` (the conversation's only block), counts of faults, ``cost``, ``audit`` and the repaired ``turns``.

    ``first`` and ``last`` are the first letters of the outer roles, ``low`` and ``high`` the outer turn numbers, ``n_turns`` the number of different ones.
    """
    blocks = written(_blocks(turns, settings), "turn-blocks", wide=True)
    block_type = blocks.schema["block"].dataType.simpleString()
    conv_type = blocks.schema["conv_id"].dataType.simpleString()
    counts = blocks.groupBy("cid").agg(F.count("*").alias("n")).where("n > 1").select("cid")
    long = counts if counts.isEmpty() else written(counts, "long-conversations")
    fields = f"conv_id {conv_type}, cid string, block {block_type}, {_FACTS}, cost bigint, audit string, turns {TURN}"

    def walk():
        walker = Walker()

        def one(row):
            facts = _Facts(row["turns"], row["seen"])
            end = walker.end if row["ahead"] is None else walker.number(row["ahead"])[0]
            letters, q, cost = walker.through(facts.codes, row["entry"], end)
            more = ("", "II", "I", "")[q] if row["final"] else ""
            done = _apply(facts.rows, letters, row["entry"], more)
            return {k: row[k] for k in ("conv_id", "cid", "block")} | facts.fields | {"cost": cost + _INSERT * len(more), "audit": "".join(letters) + more, "turns": done}

        return one

    def walked(rows: DataFrame, alone: bool) -> DataFrame:
        out = _mapped(rows.select("conv_id", "cid", "block", "turns", "seen", "entry", "ahead", "final"), fields, walk)
        return out.withColumn("alone", F.lit(alone))  # not by the function, so that a filter by it leaves out a whole branch

    none = {"seen": F.lit(None).cast("array<string>"), "entry": F.lit(_START), "ahead": F.lit(None).cast("array<bigint>"), "final": F.lit(True)}
    if long.isEmpty():
        return walked(blocks.withColumns(none), True)
    many = blocks.join(long, "cid", "left_semi")
    many = written(many.join(_seen(many), ["cid", "block"], "left"), "long-blocks", wide=True)
    few = walked(blocks.join(long, "cid", "left_anti").withColumns(none), True)
    return few.unionByName(walked(many.join(_entered(many, block_type), ["cid", "block"]), False))


def _said(turns: Column | str) -> Column:
    return F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"]))


def _streamed_hashes(repaired: DataFrame) -> DataFrame:
    """``cid, repaired_sha256``: digests of the repaired turns of long conversations, which stream through a task block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cid = state = None
        empty = True
        for batch in batches:
            for row in batch.to_pylist():
                if row["cid"] != cid:
                    if state is not None:
                        yield pa.RecordBatch.from_pylist([{"cid": cid, "repaired_sha256": state.hexdigest()}])
                    cid, state, empty = row["cid"], hashlib.sha256(), True
                for line in row["said"]:
                    state.update(b"" if empty else b"\n")
                    state.update(line.encode())
                    empty = False
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"cid": cid, "repaired_sha256": state.hexdigest()}])

    rows = repaired.select("cid", "block", _said("turns").alias("said")).repartition("cid").sortWithinPartitions("cid", "block")
    return rows.select("cid", "said").mapInArrow(run, "cid string, repaired_sha256 string")


def digests(repaired: DataFrame, conversations: DataFrame) -> DataFrame:
    """Per conversation of ``conversations (conv_id)`` the counts, the cost, the audit and a digest of the repaired turns; zeros and an empty audit for those without turns."""
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    gaps = lambda low, high, n: F.coalesce(high - low + 1 - n, F.lit(0)).alias("gaps")
    one = repaired.where("alone").select(
        "conv_id", gaps(F.col("low"), F.col("high"), F.col("n_turns")), *counts, "audit", F.sha2(F.array_join(_said("turns"), "\n").cast("binary"), 256).alias("repaired_sha256")
    )
    long = repaired.where("not alone")
    before = Window.partitionBy("cid").orderBy("block")
    pair = F.concat(F.lag("last").over(before), F.col("first"))
    parts = long.select("conv_id", "cid", "block", *counts, "audit", "low", "high", "n_turns", (~pair.isin("su", "ua", "au")).alias("broken"))
    whole = parts.groupBy("conv_id", "cid").agg(
        *[F.sum(c).alias(c) for c in counts],
        F.count_if("broken").alias("broken"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n_turns").alias("n_turns"),  # no turn number is in two blocks
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    whole = whole.withColumn("illegal", F.col("illegal") + F.col("broken")).join(_streamed_hashes(long), "cid")
    whole = whole.select("conv_id", gaps(F.col("low"), F.col("high"), F.col("n_turns")), *counts, "audit", "repaired_sha256")
    found = one.unionByName(whole).withColumnRenamed("conv_id", "of")
    ids = conversations.select("conv_id").distinct()
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("gaps", *counts)}
    out = ids.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    return out.select(
        "conv_id", *[zero[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    )
