"""Conversations with faults: what is wrong with them, the cheapest repair, and the repaired turns.

1.  Equal rows are folded into one with a count before anything is moved, and the first turn of each text is found by aggregates.
2.  Rows without their texts are range-partitioned by (conversation, order), which cuts a long conversation into pieces of even size.
    A piece collapses equal consecutive symbols to runs and multiplies them to one 4 x 4 matrix (``run_paths``).
3.  The matrices of a conversation's pieces say what remains to pay behind each piece; every piece then unrolls its own edits, for
    each state it can be entered in, and the pieces are strung together.
4.  Repaired turns come from one sorted pass over the texts with the edits beside them; texts stream, none is gathered.

A conversation's letters are one value of the result, and a SHA-256 can't be taken in parts, so the last pass reads a conversation in
one task, as a stream; all else is cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglathe.llm import run_paths as paths
from loglathe.llm.common import query, small_batches, stored, table

#: so many characters of a text decide between rows of one turn and role before its digest does
ORDER_CHARS = 64
_BLANKS = " \t\n\x0b\x0c\r"
_ORDER = ("turn", "role", "start", "key")
_BLANK, _CUT = 1, 2
_PIECE = (
    "piece int, matrix array<long>, symbols string, counts array<long>, blank long, duplicate long, truncated long, illegal long,"
    " first_role string, last_role string, first_turn long, last_turn long, least_turn long, turns long"
)
_NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, n`` after the damage that crc32(``conv_id:turn``) modulo 20 chooses.

    0 drops the row, 1 empties its text, 2 removes ``[.!?]``, 3 repeats it (n = 2), 4 makes the role ``user``.  Null ids, turns, roles and
    texts are one space where they are read as text; the columns ``conv_id`` and ``turn`` keep their nulls.
    """
    kind = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(_spaced("text"), r"[.!?]", "")).otherwise(_spaced("text"))
    return rows.where(kind != 0).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(_spaced("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def folded(rows: DataFrame) -> DataFrame:
    """One row for all equal ones, ``n`` added up, with its place in the order and its own faults."""
    last = F.substring(F.rtrim("text", F.lit(_BLANKS)), -1, 1)
    own = F.when(last == "", _BLANK).when(~last.isin(".", "!", "?"), _CUT).otherwise(0)
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    return once.select(
        "*",
        F.substring("text", 1, ORDER_CHARS).alias("start"),
        F.unhex(F.md5(F.concat_ws(":", "role", "text").cast("binary"))).alias("key"),
        own.cast("int").alias("own"),
    )


def marked(rows: DataFrame) -> DataFrame:
    """Folded rows without texts; ``first`` is 1 where role and text were not seen in an earlier turn.

    Least turns come from an aggregate and are tied to their rows by another one over the full key, so that a text that stands in
    very many turns never meets in one task.
    """
    light = rows.select("conv_id", *_ORDER, "own", "n", F.lit(0).alias("first"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    least = rows.groupBy("conv_id", "role", "start", "key").agg(F.min(turn).alias("t"))
    firsts = least.select("conv_id", F.col("t.turn").alias("turn"), "role", "start", "key", F.lit(0).alias("own"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("first"))
    both = light.unionByName(firsts)
    return both.groupBy("conv_id", *_ORDER).agg(F.max("own").alias("own"), F.sum("n").alias("n"), F.max("first").alias("first"))


class _Piece:
    """What one piece of a conversation adds up to; rows come in order."""

    def __init__(self, conversation) -> None:
        self.conversation = conversation
        self.symbols: list[str] = []
        self.counts: list[int] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_role = self.last_role = self.first_turn = self.last_turn = self.least_turn = None

    def _add(self, symbol: str, n: int) -> None:
        if not n:
            return
        if self.symbols and self.symbols[-1] == symbol:
            self.counts[-1] += n
        else:
            self.symbols.append(symbol)
            self.counts.append(n)

    def row(self, turn: int | None, role: str, own: int, n: int, first: bool) -> None:
        initial = role[:1]
        if self.last_role is None:
            self.first_role, self.first_turn = initial, turn
        else:
            self.illegal += self.last_role + initial not in ("su", "ua", "au")
        self.illegal += n - 1  # a role behind itself is never right
        if turn is not None and (turn != self.last_turn or not self.turns):
            self.turns += 1
            self.least_turn = turn if self.least_turn is None else self.least_turn
        self.last_role, self.last_turn = initial, turn
        if own == _BLANK:
            self.blank += n
            self._add(paths.GONE, n)
            return
        self.duplicate += n - first
        if first:
            self.truncated += own == _CUT
            self._add(paths.symbol(initial, False, own == _CUT), 1)
        self._add(paths.GONE, n - first)

    def value(self, piece: int) -> tuple:
        m = paths.matrix(list(zip(self.symbols, self.counts, strict=True)))
        return (
            self.conversation, piece, [c for line in m for c in line], "".join(self.symbols), self.counts, self.blank, self.duplicate,
            self.truncated, self.illegal, self.first_role, self.last_role, self.first_turn, self.last_turn, self.least_turn, self.turns,
        )


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches; long values make smaller ones."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 1 + sum(len(v) for v in row if isinstance(v, str | list)) // 1000
        if weight >= size:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _mapped(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """``fn`` over the rows of each partition, in their order."""
    from pyspark.sql.pandas.types import to_arrow_schema

    empty = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(empty)
    return df.mapInArrow(lambda batches: _batches(fn(_rows(batches)), arrow), schema)


def _typed(rows: DataFrame, rest: str) -> str:
    return f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {rest}"


def pieces(rows: DataFrame) -> DataFrame:
    """``conv_id, piece`` and what the piece adds up to; pieces of a conversation are numbered in its order."""
    ordered = rows.repartitionByRange("conv_id", *_ORDER).sortWithinPartitions("conv_id", *_ORDER)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        number, now = TaskContext.get().partitionId(), None
        for conversation, turn, role, own, n, first in rows:
            if now is None or now.conversation != conversation:
                if now is not None:
                    yield now.value(number)
                now = _Piece(conversation)
            now.row(turn, role, own, n, bool(first))
        if now is not None:
            yield now.value(number)

    return _mapped(ordered.select("conv_id", "turn", "role", "own", "n", "first"), run, _typed(rows, _PIECE))


def _matrix(values: list[int]) -> paths.Matrix:
    return tuple(tuple(values[4 * i : 4 * i + 4]) for i in paths.STATES)


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["conv_id"].eqNullSafe(right["conv_id"])


def repairs(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` for each conversation of ``rows``.

    ``rows`` are folded rows.  They are taken by turn (nulls first), then role, then text: its first 64 characters, and the digest of
    all of it where those agree.  ``audit`` holds the letters of the cheapest edits, least in ASCII order.
    """
    parts = stored(pieces(marked(rows)), "pieces")
    gathered = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("piece", "matrix"))).alias("p"))

    def remaining(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conversation, ps in rows:
            end = paths.LAST
            for k, p in reversed(list(enumerate(ps))):
                yield conversation, p["piece"], list(end), k == 0, k + 1 == len(ps)
                end = paths.ahead(_matrix(p["matrix"]), end)

    # of a conversation, one small row a piece
    ends = _mapped(gathered, remaining, _typed(rows, "piece int, ahead array<long>, is_first boolean, is_last boolean"))
    joined = parts.join(ends, _same(parts, ends) & (parts["piece"] == ends["piece"])).select(
        parts["conv_id"], parts["piece"], "symbols", "counts", "ahead", "is_first", "is_last"
    )

    def unrolled(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conversation, piece, symbols, counts, end, is_first, is_last in rows:
            runs = list(zip(symbols, counts, strict=True))
            ways = [paths.unroll(runs, tuple(end), s, is_last) for s in ((0,) if is_first else paths.STATES)]
            yield conversation, piece, [w[0] for w in ways], [w[1] for w in ways], paths.borders(runs, tuple(end))[0][0] if is_first else None

    edits = _mapped(joined, unrolled, _typed(rows, "piece int, letters array<string>, leads array<int>, cost long"))
    figures = ["blank", "duplicate", "truncated", "illegal", "first_role", "last_role", "first_turn", "last_turn", "least_turn", "turns"]
    all_parts = edits.join(parts, _same(edits, parts) & (edits["piece"] == parts["piece"])).select(
        edits["conv_id"], F.struct(edits["piece"].alias("piece"), "letters", "leads", "cost", *figures).alias("p")
    )

    def strung(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conversation, ps in rows:
            state, letters, before = 0, [], None
            illegal, turns, least, most = 0, 0, None, None
            for k, p in enumerate(ps):
                at = state if k else 0
                letters.append(p["letters"][at])
                state = p["leads"][at]
                illegal += p["illegal"]
                turns += p["turns"]
                if before is not None:
                    illegal += before["last_role"] + p["first_role"] not in ("su", "ua", "au")
                    turns -= before["last_turn"] is not None and before["last_turn"] == p["first_turn"]
                before = p
                most = p["last_turn"]  # nulls come first
                if least is None:
                    least = p["least_turn"]
            gaps = most - least + 1 - turns if most is not None else 0
            sums = [sum(p[c] for p in ps) for c in ("blank", "duplicate", "truncated")]
            yield conversation, gaps, *sums, illegal, ps[0]["cost"], "".join(letters)

    whole = all_parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    return _mapped(whole, strung, _typed(rows, ", ".join(f"{c} long" for c in _NUMBERS) + ", audit string"))


def _walk(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``conversation, letter, role, text`` of every edit and, when a conversation is done, the same with letter None.

    Rows are, per conversation, first its audit and then its folded rows in order.  Deleted rows have role and text too.
    """
    for conversation, group in groupby(rows, key=lambda r: r[0]):
        _, _, audit, *_ = next(group)
        at, state = 0, 0

        def made(conversation=conversation):
            nonlocal at, state
            while audit[at : at + 1] == paths.INSERT:
                role, state = paths.due(state)
                at += 1
                yield conversation, paths.INSERT, role, ""

        for _, _, _, role, text, n in group:
            for _ in range(n):
                yield from made()
                letter = audit[at]
                at += 1
                if letter == paths.KEEP:
                    state = paths.kept(role[:1], state)
                    yield conversation, letter, role, text
                elif letter == paths.REROLE:
                    due, state = paths.due(state)
                    yield conversation, letter, due, text
                else:
                    yield conversation, letter, role, text
        yield from made()
        yield conversation, None, None, None


def _beside(rows: DataFrame, fixed: DataFrame) -> DataFrame:
    """Folded rows of each conversation behind its audit, sorted, in one partition."""
    audits = fixed.select("conv_id", F.lit(0).alias("kind"), "audit")
    both = audits.unionByName(rows.select("conv_id", F.lit(1).alias("kind"), *_ORDER, "text", "n"), allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER)
    return ordered.select("conv_id", "kind", "audit", "role", "text", "n")


def repaired_turns(rows: DataFrame, fixed: DataFrame) -> DataFrame:
    """``conv_id, turn, edit, role, text``: the turns after the repair, numbered from 0; ``edit`` is K, R or I."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        place = 0
        for conversation, letter, role, text in _walk(rows):
            if letter is None:
                place = 0
            elif letter != paths.DELETE:
                yield conversation, place, letter, role, text
                place += 1

    return _mapped(_beside(rows, fixed), run, _typed(rows, "turn long, edit string, role string, text string"))


def repaired_digests(rows: DataFrame, fixed: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: digest of the repaired ``role:text``, joined by newlines."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        digest, started = hashlib.sha256(), False
        for conversation, letter, role, text in _walk(rows):
            if letter is None:
                yield conversation, digest.hexdigest()
                digest, started = hashlib.sha256(), False
            elif letter != paths.DELETE:
                digest.update(("\n" if started else "").encode() + f"{role}:{text}".encode())
                started = True

    return _mapped(_beside(rows, fixed), run, _typed(rows, "repaired_sha256 string"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Folded rows and their ``repairs``, both written; for ``rows`` with ``conv_id, turn, role, text, n``."""
    small_batches(rows.sparkSession)
    kept = stored(folded(rows), "turns")
    return kept, stored(repairs(kept), "repairs")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Damage ``conversations`` (conv_id, turn, role, text), repair them, and report one row for each original ``conv_id``.

    Null ids are one conversation.  Null turns come first and have no gaps.  Null roles and texts are one space, so they are blank or of an
    unknown role.  Empty texts are blank.  Equal rows are duplicates of the first.  Rows of one turn go by role, then text.  Texts of any
    length are read whole, each as one value.  A conversation without rows after the damage has zeros, an empty audit and the digest of
    the empty string.  An empty table gives none.  Other columns are left out, whatever their names.
    """
    rows, fixed = repair(damaged(conversations))
    digests = repaired_digests(rows, fixed)
    ids = conversations.select("conv_id").distinct()
    found = fixed.join(digests, _same(fixed, digests)).select(fixed["conv_id"], *_NUMBERS, "audit", "repaired_sha256")
    nothing = hashlib.sha256().hexdigest()
    return ids.join(found, _same(ids, found), "left").select(
        ids["conv_id"],
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _NUMBERS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


@query("op11_conversation_repair")
def op11(spark, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"))
