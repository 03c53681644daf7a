"""Repair of the turn structure of conversations by weighted CYK parsing.

The roles of a repaired conversation read ``(s?(ua)+)?`` (initials of system, user, assistant). The grammar is in Chomsky normal form: a
nonterminal ``(p, q)`` derives the rows that lead an automaton from state ``p`` to ``q``, with the rules ``(p, r) -> (p, q) (q, r)``; a
row derives every ``(p, q)`` that keeping, re-roling or deleting it allows; and each cell is closed under insertions before and behind. A cell
of a span holds, for each nonterminal, the least (cost, audit). Because nonterminals name both ends, every split of a span has the same
derivations, so one split is enough, and spans of 1, 2, 4, ... rows are combined bottom-up: time in proportion to the rows, not
to their cube. Two audits of one span and nonterminal that cost the same are never prefixes of one another (they have a letter for each
row, more insertions cost more), so least audits of parts give the least audit of the whole.

Spark sorts all rows by conversation and turn over all tasks and cuts them into blocks of at most ``2**BLOCK_BITS`` rows; blocks are parsed
side by side, also those of one conversation, and only their cells (a few letters a row) meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import durable

BLOCK_BITS = 16
#: White space of texts: 0x20 and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5, "truncated": 5}
FAULTS = ["", "blank", "duplicate", "truncated"]

#: Automaton: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES, ENDS = range(4), (0, 3)
ROLES = {"u": "user", "a": "assistant"}

Cell = dict[tuple[int, int], tuple[int, str]]


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = {}
    for (p, q), (cost, audit) in left.items():
        for r in STATES:
            after = right.get((q, r))
            if after is not None:
                total, held = cost + after[0], out.get((p, r))
                if held is None or total < held[0]:
                    out[p, r] = (total, audit + after[1])
                elif total == held[0] and (text := audit + after[1]) < held[1]:
                    out[p, r] = (total, text)
    return out


@cache
def inserted() -> Cell:
    """The cell of an empty span: nothing, or insertions of user and assistant, closed."""
    cell: Cell = {(p, p): (0, "") for p in STATES} | {(p, q): (COST[INSERT], INSERT) for (p, c), q in STEPS.items() if c in ROLES}
    while (more := combine(cell, cell)) != cell:
        cell = more
    return cell


@cache
def single(initial: str, fault: str) -> Cell:
    """The cell of one row: blank and duplicate rows can only be deleted, truncated ones cost more unless deleted."""
    cell: Cell = {(p, p): (COST[DELETE], DELETE) for p in STATES}
    if fault not in ("blank", "duplicate"):
        extra = COST["truncated"] if fault == "truncated" else 0
        for (p, c), q in STEPS.items():
            edit = KEEP if c == initial else REROLE if c in ROLES else None
            if edit:
                cell[p, q] = min(cell.get((p, q), (1 << 62, "")), (COST[edit] + extra, edit))
    return combine(combine(inserted(), cell), inserted())


def parse(cells: list[Cell]) -> Cell:
    """The cell of a run of rows, bottom-up by span length."""
    while len(cells) > 1:
        pairs = [combine(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(cells) - len(cells) % 2 :]
    return cells[0] if cells else inserted()


class Tree:
    """Combines cells as they come, neighbours of about equal size with one another."""

    def __init__(self):
        self.spans: list[tuple[int, Cell]] = []

    def add(self, cell: Cell) -> None:
        size = 1
        while self.spans and self.spans[-1][0] <= size:
            before, left = self.spans.pop()
            cell, size = combine(left, cell), size + before
        self.spans.append((size, cell))

    def whole(self) -> Cell:
        cell = inserted()
        for _, left in reversed(self.spans):
            cell = combine(left, cell)
        return cell


# --- Spark


def order_rows(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text, pos``, written: ``pos`` ascends by conversation, turn (nulls first), role and text over all rows.

    Null roles and texts become one space. Equal rows may be dealt over tasks: their order does not matter.
    """
    plain = rows.select(
        F.col(conversation).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv", "turn", "role", "text", "row"]
    ordered = plain.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    return durable(ordered.withColumn("pos", F.monotonically_increasing_id()), "conversations-rows")


def find_faults(ordered: DataFrame) -> DataFrame:
    """``conv, pos, turn, initial, fault`` for rows of ``order_rows``.

    The first fault counts: blank (only white space), duplicate (role and text seen before in the conversation), truncated (last
    visible character not one of ``.!?``), or the empty string.
    """
    visible = F.rtrim(F.col("text"), F.lit(BLANKS))
    name = F.coalesce(F.concat(F.length(F.col("conv").cast("string")), F.lit(":"), F.col("conv").cast("string")), F.lit(""))
    told = ordered.select(
        "conv",
        "pos",
        "turn",
        F.substring("role", 1, 1).alias("initial"),
        (visible == "").alias("blank"),
        (~F.right(visible, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.md5(F.concat(name, F.lit("|"), F.length("role"), F.lit(":"), F.col("role"), F.col("text"))).alias("same"),
    )
    told = durable(told, "conversations-told")
    seen = told.where(~F.col("blank")).groupBy("same").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    # Written before it is joined, so that a text with very many repeats can be split.
    seen = durable(seen.drop("n"), "conversations-repeats")
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    )
    return told.join(seen, "same", "left").select("conv", "pos", "turn", "initial", fault.alias("fault"))


def _grouped(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, tuple, bool]]:
    """(group, row, first of its group?) for rows sorted by their first ``width`` columns."""
    current = None
    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns]):
            fresh = current is None or row[:width] != current
            current = row[:width]
            yield current, row[width:], fresh


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096, letters: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= size or weight >= letters:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _mapped(df: DataFrame, function: Callable[[Iterable[pa.RecordBatch]], Iterator[tuple]], columns: str) -> DataFrame:
    """``mapInArrow`` for a function from batches to rows; ``columns`` in DDL behind ``conv``, whose type stays."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = T.StructType([df.schema["conv"], *T._parse_datatype_string(columns).fields])
    schema = to_arrow_schema(kind)
    return df.mapInArrow(lambda batches: _batches(function(batches), schema), kind)


def parse_blocks(faults: DataFrame) -> DataFrame:
    """``conv, block, rows, illegal, first, last`` and the cell of every block of a conversation."""
    block = F.shiftright("pos", BLOCK_BITS).alias("block")
    slim = faults.select("conv", block, "pos", "initial", "fault")
    slim = slim.repartition("conv", "block").sortWithinPartitions("conv", "block", "pos")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        group, cells, initials = None, [], []

        def done() -> tuple:
            cell = parse(cells)
            keys = [10 * p + q for p, q in cell]
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            return (*group, len(cells), illegal, initials[0], initials[-1], keys, [c for c, _ in cell.values()], [a for _, a in cell.values()])

        for own, (_, initial, fault), fresh in _grouped(batches, 2):
            if fresh:
                if group:
                    yield done()
                group, cells, initials = own, [], []
            cells.append(single(initial, fault))
            initials.append(initial)
        if group:
            yield done()

    return _mapped(
        slim, run, "block bigint, rows bigint, illegal bigint, first string, last string, states array<int>, costs array<bigint>, audits array<string>"
    )


#: Pairs of neighbouring initials that a conversation may have.
LEGAL = {"su", "ua", "au"}


def audits(blocks: DataFrame) -> DataFrame:
    """For each conversation one row with null ``block`` (``cost, illegal, audit``), and for each of its blocks the part of the audit for its
    rows (``audit``) with the state before it (``state``).

    The cells of one conversation, eleven letters a row, come together in one task; its audit is one value.
    """
    cells = blocks.repartition("conv").sortWithinPartitions("conv", "block")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        group, tree, parts = None, None, []
        for (conv,), row, fresh in _grouped(batches, 1):
            if fresh:
                if group:
                    yield from _settle(*group, tree, parts)
                group, tree, parts = (conv,), Tree(), []
            block, rows, illegal, first, last, states, costs, texts = row
            tree.add({(s // 10, s % 10): (c, a) for s, c, a in zip(states, costs, texts)})
            parts.append((block, rows, illegal, first, last))
        if group:
            yield from _settle(*group, tree, parts)

    return _mapped(cells, run, "block bigint, state int, cost bigint, illegal bigint, audit string")


def _settle(conv, tree: Tree, parts: list[tuple]) -> Iterator[tuple]:
    cell = tree.whole()
    cost, audit = min(cell[0, q] for q in ENDS)
    illegal = sum(p[2] for p in parts) + sum(a[4] + b[3] not in LEGAL for a, b in zip(parts, parts[1:]))
    yield conv, None, None, cost, illegal, audit
    at = 0
    for nth, (block, rows, *_) in enumerate(parts):
        start, left = at, rows
        while at < len(audit) and (left or audit[at] == INSERT or nth == len(parts) - 1):
            left -= audit[at] != INSERT
            at += 1
        yield conv, block, None, None, None, audit[start:at]


def apply_edits(ordered: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired rows: ``conv, place, turn, role, text, edit``; inserted rows have an empty text and no turn, deleted ones are left out.

    The rows of a conversation come out in order in one task, which reads them as a stream: what follows may need them so.
    """
    letters = edits.where(F.col("block").isNotNull()).select("conv", "block", F.lit(-1).cast("bigint").alias("pos"), F.col("audit").alias("text"))
    rows = ordered.select("conv", F.shiftright("pos", BLOCK_BITS).alias("block"), "pos", "turn", "role", "text")
    both = rows.unionByName(letters, allowMissingColumns=True).select("conv", "block", "pos", "turn", "role", "text")
    both = both.repartition("conv").sortWithinPartitions("conv", "block", "pos")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        letters, state, place = iter(""), 0, 0
        last = None
        for (conv,), (_, pos, turn, role, text), fresh in _grouped(batches, 1):
            if fresh:
                if last is not None:
                    yield from _rest(*last, letters, state, place)
                letters, state, place = iter(""), 0, 0
            last = (conv,)
            if pos < 0:
                for edit in letters:  # insertions behind the last row of the block before
                    state, role_in = _insert(state)
                    yield conv, place, None, role_in, "", edit
                    place += 1
                letters = iter(text)
                continue
            for edit in letters:
                if edit == INSERT:
                    state, role_in = _insert(state)
                    yield conv, place, None, role_in, "", edit
                    place += 1
                    continue
                if edit == KEEP:
                    state = STEPS[state, role[:1]]
                elif edit == REROLE:
                    state, role = _insert(state)
                if edit != DELETE:
                    yield conv, place, turn, role, text, edit
                    place += 1
                break
        if last is not None:
            yield from _rest(*last, letters, state, place)

    turn_type = ordered.schema["turn"].dataType.simpleString()
    return _mapped(both, run, f"place bigint, turn {turn_type}, role string, text string, edit string")


def _insert(state: int) -> tuple[int, str]:
    initial = "a" if state == 2 else "u"
    return STEPS[state, initial], ROLES[initial]


def _rest(conv, letters: Iterator[str], state: int, place: int) -> Iterator[tuple]:
    for edit in letters:
        state, role = _insert(state)
        yield conv, place, None, role, "", edit
        place += 1


def hashes(repaired: DataFrame) -> DataFrame:
    """``conv, sha256`` of ``role:text``, joined by newlines, of rows as ``apply_edits`` gives them; their order in the tasks is used."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        group, hashed = None, None
        for (conv,), (role, text), fresh in _grouped(batches, 1):
            if fresh:
                if group:
                    yield *group, hashed.hexdigest()
                group, hashed = (conv,), hashlib.sha256()
            else:
                hashed.update(b"\n")
            hashed.update(f"{role}:{text}".encode())
        if group:
            yield *group, hashed.hexdigest()

    return _mapped(repaired.select("conv", "role", "text"), run, "sha256 string")


def repair(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(faults, edits, repaired rows), as ``find_faults``, ``audits`` and ``apply_edits`` give them.

    Null conversations are one conversation, null turns come first, null roles and texts are one space. Rows of a conversation with
    the same turn are taken by role and text. Repeated rows are duplicates; blank and duplicate rows are always deleted. Texts may be of any length.
    An empty table has no rows. Other columns, whatever their names, are not read.
    """
    ordered = order_rows(rows, conversation, turn, role, text)
    faults = durable(find_faults(ordered), "conversations-faults")
    edits = durable(audits(durable(parse_blocks(faults), "conversations-cells")), "conversations-audits")
    return faults, edits, apply_edits(ordered, edits)


def damage(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The test damage: by the checksum of ``conversation:turn`` modulo 20 a row is dropped (0), emptied (1), loses its sentence ends (2), is
    repeated (3) or gets the role user (4). Null roles and texts, and nulls in the checksum, are one space."""
    spaced: Callable[[str], Column] = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced(conversation), F.lit(":"), spaced(turn))) % 20
    told = rows.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), spaced(role).alias("role"), spaced(text).alias("text"), kind.alias("kind"))
    copies = F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return told.where(F.col("kind") != 0).select(
        F.col("conv").alias(conversation),
        F.col("turn").alias(turn),
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias(role),
        changed.alias(text),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def report(rows: DataFrame, faults: DataFrame, edits: DataFrame, repaired: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row for every conversation of ``rows``: counts of faults, cost, audit and the hash of the repaired rows."""
    empty = hashlib.sha256().hexdigest()
    turns = faults.groupBy("conv", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in FAULTS[1:]])
    per_conv = turns.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + F.lit(1) - F.count("turn")).cast("bigint").alias("gaps"), *[F.sum(f).alias(f) for f in FAULTS[1:]]
    )
    whole = edits.where(F.col("block").isNull()).select("conv", "illegal", "cost", "audit")
    parts = [per_conv, whole, hashes(repaired).withColumnRenamed("sha256", "repaired_sha256")]
    found = rows.select(F.col(conversation).alias("conv")).distinct()
    for part in parts:
        found = found.unionByName(part, allowMissingColumns=True)
    numbers = ["gaps", *FAULTS[1:], "illegal", "cost"]
    return found.groupBy("conv").agg(
        *[F.coalesce(F.max(n), F.lit(0)).cast("bigint").alias(n) for n in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(empty)).alias("repaired_sha256"),
    ).withColumnRenamed("conv", conversation)
