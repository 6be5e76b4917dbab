"""Repair of the turn structure of conversations by a grammar-compressed dynamic programme.

Every row has a symbol: the initial of its role (system, user, assistant, other) and its
fault (none, truncated, to be deleted). What repairs cost is a product of min-plus matrices,
one for each row, over the states of the grammar ``(s?(ua)+)?``: nothing yet, after system,
after user, after assistant. A matrix entry is the least cost and the rope of the edits'
initials, ties to the ASCII-least text. Re-Pair replaces the most frequent pair of symbols of
a block of conversations by a new symbol as long as a pair stands often enough, so that a rule
has one matrix, computed once from the matrices of its two parts, for all conversations of the
block that hold it.

Matrices compose, so a conversation needs no task of its own: rows are dealt by range of
(conversation, turn), each task turns what it has of a conversation into pieces of at most
``PIECE`` symbols, and the matrices of the pieces are multiplied in order. Rows travel there
as digests of their texts. Only the last step has to see a conversation's texts one after
the other, as a SHA-256 digest is sequential by its definition; it streams them sorted and
holds one text and the audit at a time.

Edits: Keep (0), Rerole to user or assistant (1), Delete (2, required for blank rows and
duplicates), Insert a user or assistant row without text (5); a truncated row that is not
deleted adds 5.

Rules for odd input: NULL role and text count as one space; NULL turns come first; rows of
one turn stand by role, then by the MD5 digest of their text, so equal rows are neighbours;
a repeated row is a duplicate of the first one; a NULL conversation is a conversation like
any other; texts may be of any length; extra columns are not looked at; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tablecheck.llm.common import SPACES, staged

#: Symbols of one piece of a conversation.
PIECE = 4096
#: Symbols that share a grammar.
BLOCK = 400_000
#: A pair becomes a rule while it stands at least so often in its block.
LEAST_USES = 8

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: Next state by state and initial.
NEXT = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
LEGAL = {"su", "ua", "au"}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Initials of rows without and with a truncated text; a row to be deleted.
SYMBOLS = "suaoSUAOx"


class Rope:
    """A text that is joined when it is first read."""

    __slots__ = ("left", "right", "joined")

    def __init__(self, left: Rope | str, right: Rope | str):
        self.left, self.right, self.joined = left, right, None


def text_of(rope: Rope | str) -> str:
    if isinstance(rope, str):
        return rope
    if rope.joined is None:
        parts, stack = [], [rope]
        while stack:
            part = stack.pop()
            if isinstance(part, str):
                parts.append(part)
            elif part.joined is not None:
                parts.append(part.joined)
            else:
                stack += (part.right, part.left)
        rope.joined = "".join(parts)
        rope.left = rope.right = ""
    return rope.joined


Entry = tuple[int, Rope | str] | None
Matrix = list[list[Entry]]


def better(one: Entry, other: Entry) -> Entry:
    """The cheaper of two entries, of equally cheap ones the ASCII-least."""
    if one is None or other is None:
        return other if one is None else one
    if one[0] != other[0]:
        return min(one, other, key=lambda e: e[0])
    return one if text_of(one[1]) <= text_of(other[1]) else other


def chained(one: Entry, other: Entry) -> Entry:
    if one is None or other is None:
        return None
    if not one[1] or not other[1]:
        return one[0] + other[0], one[1] or other[1]
    return one[0] + other[0], Rope(one[1], other[1])


def row_times(row: list[Entry], matrix: Matrix) -> list[Entry]:
    out = []
    for j in STATES:
        best = None
        for k in STATES:
            if row[k] is not None and matrix[k][j] is not None:
                best = better(best, chained(row[k], matrix[k][j]))
        out.append(best)
    return out


def times(one: Matrix, other: Matrix) -> Matrix:
    return [row_times(row, other) for row in one]


def unit() -> Matrix:
    return [[(0, "") if i == j else None for j in STATES] for i in STATES]


def _inserts() -> Matrix:
    """Any number of inserted rows; more than two never pay, a state is not seen twice."""
    step: Matrix = [[None] * 4 for _ in STATES]
    for (state, initial), after in NEXT.items():
        if initial in "ua":
            step[state][after] = (INSERT, "I")
    total = power = unit()
    for _ in STATES:
        power = times(power, step)
        total = [[better(a, b) for a, b in zip(x, y)] for x, y in zip(total, power)]
    return total


INSERTS = _inserts()


def symbol_matrix(symbol: str) -> Matrix:
    """Inserts before a row, then one edit of it."""
    matrix: Matrix = [[None] * 4 for _ in STATES]
    for state in STATES:
        matrix[state][state] = (DELETE, "D")
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        for (state, initial), after in NEXT.items():
            if initial == symbol.lower():
                edit = (KEEP + extra, "K")
            elif initial in "ua":
                edit = (REROLE + extra, "R")
            else:
                continue
            matrix[state][after] = better(matrix[state][after], edit)
    return times(INSERTS, matrix)


def re_pair(sequences: list[np.ndarray], symbols: int) -> tuple[list[np.ndarray], list[tuple]]:
    """Sequences over a grammar, and its rules; rule ``k`` has the symbol ``symbols + k``."""
    if not sequences:
        return [], []
    ends = np.cumsum([len(s) + 1 for s in sequences])
    line = np.full(ends[-1], -1, np.int64)
    for end, sequence in zip(ends, sequences):
        line[end - 1 - len(sequence) : end - 1] = sequence
    rules: list[tuple] = []
    while len(line) > 1:
        width = symbols + len(rules)
        inside = np.flatnonzero((line[:-1] >= 0) & (line[1:] >= 0))
        if not len(inside):
            break
        codes, counts = np.unique(line[inside] * width + line[inside + 1], return_counts=True)
        top = int(counts.argmax())
        if counts[top] < LEAST_USES:
            break
        pair = divmod(int(codes[top]), width)
        at = np.flatnonzero((line[:-1] == pair[0]) & (line[1:] == pair[1]))
        if pair[0] == pair[1]:
            # of a run of equal symbols every second place
            new = np.r_[True, np.diff(at) > 1]
            begin = at[np.flatnonzero(new)][np.cumsum(new) - 1]
            at = at[(at - begin) % 2 == 0]
        line[at] = width
        rules.append(pair)
        line = np.delete(line, at + 1)
    pieces = np.split(line, np.flatnonzero(line < 0) + 1)[:-1]
    return [piece[:-1] for piece in pieces], rules


def matrices(sequences: list[str]) -> list[Matrix]:
    """The matrix of every sequence of symbols."""
    codes = {ord(symbol): k for k, symbol in enumerate(SYMBOLS)}
    lookup = np.zeros(128, np.int64)
    lookup[list(codes)] = list(codes.values())
    coded = [lookup[np.frombuffer(s.encode("ascii"), np.uint8)] for s in sequences]
    shrunk, rules = re_pair(coded, len(SYMBOLS))
    known = [symbol_matrix(symbol) for symbol in SYMBOLS]
    for first, second in rules:
        known.append(times(known[first], known[second]))
    seen: dict[bytes, Matrix] = {}
    found = []
    for sequence in shrunk:
        key = sequence.tobytes()
        if key not in seen:
            total = None
            for symbol in sequence.tolist():
                total = known[symbol] if total is None else times(total, known[symbol])
            seen[key] = unit() if total is None else total
        found.append(seen[key])
    return found


def finished(row: list[Entry]) -> tuple[int, str]:
    """Least cost and audit of a whole conversation, from the entries of its start state."""
    row = row_times(row, INSERTS)
    cost, audit = better(row[START], row[ASSISTANT])
    return cost, text_of(audit)


def breaks(initials: str) -> int:
    """Neighbours that may not follow each other."""
    return sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))


# Rows


def damaged(df: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) with faults put in by the checksum of their place."""
    place = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    )
    fault = F.crc32(place.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    rows = df.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("_fault"))
    rows = rows.where("_fault <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_fault") == 1, "")
        .when(F.col("_fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(
            F.array(F.lit(1))
        )).alias("_copy"),
    )
    return rows.drop("_copy")


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.col(text).cast("binary")))


ORDER = ["conv", "has_turn", "turn", "role", "digest"]


def _facts(rows: DataFrame) -> DataFrame:
    """One row for each set of equal rows: what a repair has to know of them, and how many.

    ``fault`` is that of the first of them; the others are duplicates, unless blank.
    """
    core = F.trim(F.col("text"), F.lit(SPACES))
    ended = core.endswith(".") | core.endswith("!") | core.endswith("?")
    known = rows.select(
        "conv",
        F.col("turn").isNotNull().alias("has_turn"),
        "turn",
        "role",
        _digest("text").alias("digest"),
        F.when(core == "", "blank").when(~ended, "truncated").alias("fault"),
    )
    counted = known.groupBy(*known.columns).agg(F.count("*").alias("copies"))
    first = counted.where("fault IS NULL OR fault <> 'blank'").groupBy(
        F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")
    ).agg(F.min(F.struct("has_turn", "turn")).alias("first"))
    met = counted.join(
        first.hint("merge"),
        F.col("conv").eqNullSafe(F.col("c"))
        & (F.col("role") == F.col("r"))
        & (F.col("digest") == F.col("d")),
        "left",
    )
    later = F.col("first").isNotNull() & (F.col("first") < F.struct("has_turn", "turn"))
    initial = F.substring("role", 1, 1)
    return met.select(
        *ORDER,
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        F.when(later, "duplicate").otherwise(F.col("fault")).alias("fault"),
        "copies",
    )


def _figures(facts: DataFrame) -> DataFrame:
    """Gaps and faults of every conversation that has rows."""
    again = F.when(F.coalesce("fault", F.lit("")) == "blank", 0).otherwise(F.col("copies") - 1)
    every = F.when(F.col("fault").isin("blank", "duplicate"), F.col("copies")).otherwise(F.lit(1))

    def of(fault: str) -> Column:
        return F.sum(F.when(F.col("fault") == fault, every).otherwise(0))

    duplicates = F.when(F.col("fault") == "duplicate", F.col("copies")).otherwise(again)
    turns = facts.groupBy("conv", "turn").agg(
        of("blank").alias("blank"),
        F.sum(duplicates).alias("duplicate"),
        of("truncated").alias("truncated"),
    )
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")],
    )


def _pieces(facts: DataFrame) -> DataFrame:
    """Matrices of the pieces of every conversation, in order of (part, piece)."""
    kind = to_arrow_type(facts.schema["conv"].dataType)
    names = ["conv", "part", "piece", "first", "last", "illegal", "costs", "audits"]
    types = [
        kind, pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(),
        pa.list_(pa.int64()), pa.list_(pa.string()),
    ]
    schema = pa.schema(list(zip(names, types)))

    def flush(block: list[tuple]) -> pa.RecordBatch:
        out: list[list] = [[] for _ in names]
        for (conv, part, piece, symbols, initials), matrix in zip(
            block, matrices([b[3] for b in block])
        ):
            entries = [entry for row in matrix for entry in row]
            values = (
                conv, part, piece, initials[0], initials[-1], breaks(initials),
                [None if e is None else e[0] for e in entries],
                [None if e is None else text_of(e[1]) for e in entries],
            )
            for column, value in zip(out, values):
                column.append(value)
        arrays = [pa.array(column, type) for column, type in zip(out, types)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def symbol_runs(batch: pa.RecordBatch) -> Iterator[tuple]:
        for conv, initial, fault, copies in zip(*(c.to_pylist() for c in batch.columns)):
            if fault in ("blank", "duplicate"):
                yield conv, initial, "x", copies
            else:
                yield conv, initial, initial.upper() if fault else initial, 1
                if copies > 1:
                    yield conv, initial, "x", copies - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        block: list[tuple] = []
        held, now, piece, size, begun = 0, None, 0, 0, False
        symbols: list[str] = []
        initials: list[str] = []

        def close() -> None:
            nonlocal held, size, piece
            if size:
                block.append((now, part, piece, "".join(symbols), "".join(initials)))
                held, size, piece = held + size, 0, piece + 1
                symbols.clear()
                initials.clear()

        for batch in batches:
            for conv, initial, symbol, count in symbol_runs(batch):
                if not begun or conv != now:
                    close()
                    now, piece, begun = conv, 0, True
                while count:
                    some = min(count, PIECE - size)
                    symbols.append(symbol * some)
                    initials.append(initial * some)
                    size, count = size + some, count - some
                    if size == PIECE:
                        close()
                if held >= BLOCK:
                    yield flush(block)
                    block.clear()
                    held = 0
        close()
        if block:
            yield flush(block)

    name = facts.schema["conv"].dataType.simpleString()
    dealt = facts.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    return dealt.select("conv", "initial", "fault", "copies").mapInArrow(
        run,
        f"conv {name}, part int, piece long, first string, last string, illegal long, "
        "costs array<long>, audits array<string>",
    )


def _solved(pieces: DataFrame) -> DataFrame:
    """(conv, illegal, cost, audit): the pieces of each conversation multiplied in order."""
    kind = to_arrow_type(pieces.schema["conv"].dataType)
    schema = pa.schema(
        [("conv", kind), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, now = False, None
        done: list[tuple] = []

        def close() -> None:
            cost, audit = finished(row)
            done.append((now, illegal, cost, audit))

        def packed() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*done), schema)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for conv, first, last, inside, costs, audits in zip(*columns):
                if not begun or conv != now:
                    if begun:
                        close()
                    begun, now, row = True, conv, unit()[START]
                    illegal, before = 0, ""
                matrix = [
                    [None if costs[4 * i + j] is None else (costs[4 * i + j], audits[4 * i + j]) for j in STATES]
                    for i in STATES
                ]
                row = row_times(row, matrix)
                illegal += inside + (bool(before) and before + first not in LEGAL)
                before = last
            if done:
                yield packed()
        if begun:
            close()
            yield packed()

    name = pieces.schema["conv"].dataType.simpleString()
    dealt = pieces.repartition("conv").sortWithinPartitions("conv", "part", "piece")
    return dealt.select("conv", "first", "last", "illegal", "costs", "audits").mapInArrow(
        run, f"conv {name}, illegal long, cost long, audit string"
    )


def edited(audit: Iterable[str], rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired rows (role, text) of a conversation."""
    state = START
    for edit in audit:
        if edit == "I":
            role, text = None, ""
        else:
            role, text = next(rows)
            if edit == "D":
                continue
        if edit == "K":
            state = NEXT[state, role[0]]
        else:
            state = USER if state != USER else ASSISTANT
            role = ROLES[state]
        yield role, text


def repair(df: DataFrame) -> DataFrame:
    """Figures, least cost, audit and digest of the repaired rows of every conversation.

    ``df`` has conv_id, turn, role and text. Result: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256.
    """
    rows = df.select(
        F.col("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    facts = staged(_facts(rows))
    solved = _solved(_pieces(facts))
    figures = _figures(facts).withColumnRenamed("conv", "own")
    headers = solved.join(figures.hint("merge"), F.col("conv").eqNullSafe(F.col("own"))).drop("own")
    return _digested(headers, rows).withColumnRenamed("conv", "conv_id")


LONGS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _digested(headers: DataFrame, rows: DataFrame) -> DataFrame:
    """The headers with the digest of the repaired rows: one sorted stream of headers, each
    followed by the rows of its conversation."""
    kind = to_arrow_type(headers.schema["conv"].dataType)
    names = ["conv", *LONGS, "audit", "repaired_sha256"]
    types = [kind, *[pa.int64()] * len(LONGS), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []

        def packed() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*done), types)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        def stream() -> Iterator[dict]:
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                yield from zip(*columns)

        given = stream()

        def texts() -> Iterator[tuple[str, str]]:
            for values in given:
                yield values[2], values[3]

        for conv, audit, role, text, *figures in given:
            digest = hashlib.sha256()
            for k, (role, text) in enumerate(edited(audit, texts())):
                digest.update(("\n" if k else "").encode() + f"{role}:{text}".encode())
            done.append((conv, *figures, audit, digest.hexdigest()))
            if len(done) >= 1000:
                yield packed()
        if done:
            yield packed()

    empty = {"role": "string", "text": "string", "has_turn": "boolean", "turn": "long", "digest": "binary"}
    first = headers.select(
        "conv", "audit", *LONGS, *[F.lit(None).cast(t).alias(c) for c, t in empty.items()]
    )
    others = rows.select(
        "conv",
        F.lit(None).cast("string").alias("audit"),
        *[F.lit(None).cast("long").alias(c) for c in LONGS],
        "role",
        "text",
        F.col("turn").isNotNull().alias("has_turn"),
        "turn",
        _digest("text").alias("digest"),
    )
    both = first.unionByName(others).withColumn("is_row", F.col("audit").isNull())
    dealt = both.repartition("conv").sortWithinPartitions("conv", "is_row", *ORDER[1:])
    name = headers.schema["conv"].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in LONGS)
    return dealt.select("conv", "audit", "role", "text", *LONGS).mapInArrow(
        run, f"conv {name}, {longs}, audit string, repaired_sha256 string"
    )


def repair_all(original: DataFrame, rows: DataFrame) -> DataFrame:
    """``repair`` of ``rows``, with one result for every conversation of ``original``; one
    without rows has no faults, nothing to repair and the digest of an empty text."""
    repaired = repair(rows).withColumnRenamed("conv_id", "own")
    every = original.groupBy("conv_id").agg(F.lit(0).cast("long").alias("none"))
    met = every.join(repaired.hint("merge"), F.col("conv_id").eqNullSafe(F.col("own")), "left")
    return met.select(
        "conv_id",
        *[F.coalesce(c, "none").alias(c) for c in LONGS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
