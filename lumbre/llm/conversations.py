"""Repair of conversations: faults of every message, and the cheapest edits that restore the order of roles.

A conversation's rows are taken by turn, nulls first; rows of one turn by role, by the first characters of the text and
then by a hash. Role initials must come out as ``(s?(ua)+)?``. A message is blank, a duplicate of an earlier one of its
conversation (role and text), truncated (no closing mark at its end) or sound; blank ones and duplicates must go.

Rows are dealt into ranges of bounded size by conversation and turn. A conversation inside one range is repaired where
it lies. The first and the last of a range may go on in another, and one conversation may fill many ranges: for these
first occurrences are found by a grouping, each range gives one min-plus matrix per conversation, the few matrices of
a conversation are multiplied up, and every range then unrolls its own part of the audit. Only the hash of the repaired
text, which SHA-256 allows in one order alone, reads a long conversation in one task: as a stream, without holding it.

A null role or text is one space, a null turn comes first and counts for no gap, null ids are one conversation.
Repeated rows are duplicates. A conversation of no rows (``copies`` 0) has zeros, an empty audit and the hash of no text.
Other columns are not read; an empty table gives no rows. Gaps beyond 64 bits are cut to the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.llm import roles as R
from lumbre.sources.tables import save_scratch

#: White space that does not count as text, and marks that close a message: fixed values.
SPACE = " \t\n\x0b\f\r"
CLOSING = (".", "!", "?")
#: Bytes of text in a range of rows; a range is what one task holds of unfinished conversations.
RANGE_BYTES = 16 << 20
#: Characters of role and text that rows of one turn are ordered by before their hash.
TIE_CHARS = 16
_LARGEST = (1 << 63) - 1
SOUND, CUT, BLANK = 0, 1, 2

REPORT = T.StructType(
    [
        *[T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        T.StructField("audit", T.StringType()),
        T.StructField("repaired_sha256", T.StringType()),
    ]
)
MESSAGE = T.StructType(
    [
        T.StructField("place", T.LongType()),
        T.StructField("edit", T.StringType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
_LONG = T.LongType()
ROW = T.StructType(
    [
        T.StructField("part", _LONG),
        T.StructField("idx", _LONG),
        T.StructField("turn", _LONG),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("copies", _LONG),
        T.StructField("mark", _LONG),
    ]
)


def mark(text: Column) -> Column:
    """Fault that a text has by itself: blank, truncated or none."""
    tail = F.rtrim(text, F.lit(SPACE))
    return F.when(tail == "", BLANK).when(F.right(tail, F.lit(1)).isin(*CLOSING), SOUND).otherwise(CUT).cast("bigint")


def _ranges(rows: DataFrame, range_bytes: int) -> DataFrame:
    """Rows in ranges by conversation and order, sorted, with their range and their fault.

    Equal rows are told apart by where they were read, so that a range never has to hold all of them.
    """
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    keyed = rows.withColumns(
        {
            "r": F.left("role", F.lit(TIE_CHARS)),
            "t": F.left("text", F.lit(TIE_CHARS)),
            "h": F.xxhash64("role", "text"),
            "mark": mark(F.col("text")),
            "at": F.monotonically_increasing_id(),
        }
    )
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "r", "t", "h", "at")]
    dealt = keyed.repartitionByRange(size // range_bytes + 1, *order).sortWithinPartitions(*order)
    return dealt.select("conv", F.spark_partition_id().cast("bigint").alias("part"), "turn", "role", "text", "copies", "mark")


class _Runs:
    """Symbols of messages as they come, equal ones counted together, and what else a report counts."""

    def __init__(self) -> None:
        self.runs: list[list[int]] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None
        self.least = self.most = None

    def _add(self, sym: int, n: int) -> None:
        if n and self.runs and self.runs[-1][0] == sym:
            self.runs[-1][1] += n
        elif n:
            self.runs.append([sym, n])

    def add(self, turn: int | None, initial: str, fault: int, copies: int, seen: bool) -> None:
        if not copies:
            return
        if turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn
        if self.first is None:
            self.first = initial
        else:
            self.illegal += not legal(self.last, initial)
        self.last = initial
        self.illegal += copies - 1
        if fault == BLANK or seen:
            self.blank += copies * (fault == BLANK)
            self.duplicate += copies * (fault != BLANK)
            self._add(R.GONE, copies)
            return
        self.truncated += fault == CUT
        self.duplicate += copies - 1
        self._add(R.symbol(initial, False, fault == CUT), 1)
        self._add(R.GONE, copies - 1)

    def pairs(self) -> list[tuple[int, int]]:
        return [(s, n) for s, n in self.runs]

    def gaps(self) -> int:
        return 0 if self.least is None else min(self.most - self.least + 1 - self.turns, _LARGEST)


def legal(one: str, two: str) -> bool:
    """Whether messages with these role initials may follow one another."""
    return (one, two) in (("s", "u"), ("u", "a"), ("a", "u"))


class _Writer:
    """Messages of a repaired conversation one by one, and the running hash of them."""

    def __init__(self) -> None:
        self.hash, self.place, self.state = hashlib.sha256(), 0, 0
        self.audit: list[str] = []

    def _put(self, role: str, text: str) -> tuple[str, str]:
        if self.place:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        self.place += 1
        return role, text

    def edits(self, letters: str, rows: Iterator[tuple]) -> Iterator[tuple]:
        """Apply letters to rows (turn, role, text); gives the messages of ``MESSAGE``, deleted ones with a null place."""
        self.audit.append(letters)
        for letter in letters:
            if letter == "I":
                role, text = self._put(R.DUE_ROLE[self.state], "")
                self.state = R.DUE[self.state]
                yield self.place, letter, None, role, text
                continue
            turn, role, text = next(rows)
            if letter == "D":
                yield None, letter, turn, role, text
                continue
            if letter == "R":
                role = R.DUE_ROLE[self.state]
                self.state = R.DUE[self.state]
            else:
                self.state = R.KEEP[role[:1]][self.state]
            self._put(role, text)
            yield self.place, letter, turn, role, text


def _expanded(rows: list[tuple]) -> Iterator[tuple]:
    for turn, role, text, copies in rows:
        for _ in range(copies):
            yield turn, role, text


def _whole(rows: list[tuple]) -> tuple[_Runs, int, _Writer, list[tuple]]:
    """All of a conversation that lies in one range: rows are (turn, role, text, copies, fault)."""
    runs, seen = _Runs(), set()
    for turn, role, text, copies, fault in rows:
        key = (role, text)
        runs.add(turn, role[:1], fault, copies, key in seen)
        if copies:
            seen.add(key)
    pairs = runs.pairs()
    if not pairs:
        return runs, 0, _Writer(), []
    cost, audit = R.cheapest(pairs)
    writer = _Writer()
    return runs, cost, writer, list(writer.edits(audit, _expanded([r[:4] for r in rows])))


def _report(runs: _Runs, cost: int, writer: _Writer) -> tuple:
    return (runs.gaps(), runs.blank, runs.duplicate, runs.truncated, runs.illegal, cost, "".join(writer.audit),
            writer.hash.hexdigest())


def _batches(schema: pa.Schema, rows: Iterator[tuple], most: int = 2000, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of bounded length and text."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if len(out) >= most or size >= most_bytes:
            yield _batch(schema, out)
            out, size = [], 0
    if out:
        yield _batch(schema, out)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _values(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _local(rows: DataFrame, messages: bool) -> DataFrame:
    """Inner conversations of every range, done, and the rows of the first and the last one as they are."""
    result = T.StructField("result", MESSAGE if messages else REPORT)
    schema = T.StructType([rows.schema["conv"], result, T.StructField("row", ROW)])
    arrow = _arrow(schema)

    def one(conv: object, own: list[tuple]) -> Iterator[tuple]:
        runs, cost, writer, edited = _whole([r[2:] for r in own])
        if messages:
            yield from ((conv, message, None) for message in edited)
        else:
            yield conv, _report(runs, cost, writer), None

    def tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        first, current, held, idx = True, None, None, 0
        for batch in batches:
            for conv, part, turn, role, text, copies, fault in _values(batch):
                row = (part, idx, turn, role, text, copies, fault)
                idx += 1
                if held is None:
                    current, held = conv, []
                elif conv != current:
                    if not first:
                        yield from one(current, held)
                    first, current, held = False, conv, []
                if first:
                    yield conv, None, row
                else:
                    held.append(row)
        for row in held or ():
            yield current, None, row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(arrow, tuples(batches))

    return rows.mapInArrow(run, schema)


PIECE = T.StructType(
    [
        T.StructField("part", _LONG),
        T.StructField("place", _LONG),
        *[T.StructField(n, _LONG) for n in ("blank", "duplicate", "truncated", "illegal", "turns", "least", "most")],
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
    ]
)
_RUNS = [T.StructField(n, T.ArrayType(_LONG)) for n in ("symbols", "lengths", "costs")]


def _pieces(edge: DataFrame) -> DataFrame:
    """Runs and min-plus matrix of each range's share of an unfinished conversation.

    A row is a duplicate unless it is the first of its role and text in the conversation. The first ones are joined by
    their place, which no two rows share, so a message that is repeated all over does not meet in one task.
    """
    key = F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))
    first = edge.where("copies > 0").groupBy("conv", key.alias("key")).agg(F.min(F.struct("part", "idx")).alias("at"))
    first = first.select(F.col("at.part").alias("part"), F.col("at.idx").alias("idx"), F.lit(True).alias("is_first"))
    slim = edge.select("conv", "part", "idx", "turn", F.left("role", F.lit(1)).alias("initial"), "mark", "copies")
    marked = slim.join(first, ["part", "idx"], "left").select(
        "conv", "part", "idx", "turn", "initial", "mark", "copies", F.col("is_first").isNull().alias("seen")
    )
    schema = T.StructType([edge.schema["conv"], *PIECE.fields, *_RUNS])
    arrow = _arrow(schema)

    def close(key: tuple, place: int, runs: _Runs) -> tuple:
        pairs = runs.pairs()
        flat = [x for row in R.matrix(pairs) for x in row]
        counts = (runs.blank, runs.duplicate, runs.truncated, runs.illegal, runs.turns, runs.least, runs.most)
        return (*key, place, *counts, runs.first, runs.last, [s for s, _ in pairs], [n for _, n in pairs], flat)

    def tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, place, runs = None, 0, None
        for batch in batches:
            for conv, part, idx, turn, initial, fault, copies, seen in _values(batch):
                if key != (conv, part):
                    if key:
                        yield close(key, place, runs)
                    key, place, runs = (conv, part), idx, _Runs()
                runs.add(turn, initial, fault, copies, seen)
        if key:
            yield close(key, place, runs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(arrow, tuples(batches), most=20)

    return marked.repartition("part").sortWithinPartitions("part", "idx").mapInArrow(run, schema)


def _after(pieces: DataFrame) -> DataFrame:
    """Costs to the end after each piece and before it: the matrices of a conversation, one per range, from the last."""
    schema = T.StructType(
        [T.StructField("part", _LONG), T.StructField("place", _LONG), T.StructField("after", T.ArrayType(_LONG)), T.StructField("cost", _LONG)]
    )
    arrow = _arrow(schema)

    def tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        current, costs = None, R.END
        for batch in batches:
            for conv, part, place, flat in _values(batch):
                if (conv,) != current:
                    current, costs = (conv,), R.END
                after = costs
                costs = R.apply(tuple(tuple(flat[4 * k : 4 * k + 4]) for k in R.STATES), after)
                yield part, place, list(after), costs[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(arrow, tuples(batches))

    slim = pieces.select("conv", "part", "place", "costs").repartition("conv")
    return slim.sortWithinPartitions(F.asc("conv"), F.desc("part")).mapInArrow(run, schema)


def _ways(pieces: DataFrame, after: DataFrame) -> DataFrame:
    """The audit of each piece for every state it may be entered in."""
    schema = T.StructType([*(f for f in pieces.schema.fields if f not in _RUNS), T.StructField("cost", _LONG), T.StructField("ways", T.ArrayType(T.StringType()))])
    arrow = _arrow(schema)

    def tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for *own, symbols, lengths, after in _values(batch):
                runs, after = list(zip(symbols, lengths, strict=True)), tuple(after)
                before = R.apply(R.matrix(runs), after)
                yield (*own, [R.unroll(runs, s, after)[0] if before[s] < R.FAR else "" for s in R.STATES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(arrow, tuples(batches), most=20)

    own = [f.name for f in schema.fields[:-1]]
    return pieces.join(after, ["part", "place"]).select(*own, "symbols", "lengths", "after").mapInArrow(run, schema)


def _finished(edge: DataFrame, ways: DataFrame, messages: bool) -> DataFrame:
    """Pieces and rows of unfinished conversations in order, as a stream that holds one piece's audit at a time."""
    heads = ways.select("conv", "part", F.lit(-1).cast("bigint").alias("idx"), F.struct(*ways.columns[2:]).alias("head"))
    rows = F.struct("turn", "role", "text", "copies")
    tails = edge.where("copies > 0").select("conv", "part", "idx", rows.alias("row"))
    stream = heads.unionByName(tails, allowMissingColumns=True)
    schema = T.StructType([edge.schema["conv"], T.StructField("result", MESSAGE if messages else REPORT)])
    arrow = _arrow(schema)

    def tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        source = (v for batch in batches for v in _values(batch))
        following = next(source, None)

        def pending() -> Iterator[tuple]:
            nonlocal following
            for following in source:
                if following[3] is not None:
                    return
                row = following[4]
                for _ in range(row["copies"]):
                    yield row["turn"], row["role"], row["text"]
            following = None

        while following is not None:
            conv, writer, total = following[0], _Writer(), _Total(following[3]["cost"])
            while following is not None and following[0] == conv:
                total.add(following[3])
                feed = pending()
                for message in writer.edits(following[3]["ways"][writer.state], feed):
                    if messages:
                        yield conv, message
                if next(feed, None) is not None:
                    raise ValueError("more rows than edits")
            for message in writer.edits(R.ending(writer.state), iter(())):
                if messages:
                    yield conv, message
            if not messages:
                yield conv, _report(total, total.cost, writer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(arrow, tuples(batches))

    return stream.repartition("conv").sortWithinPartitions("conv", "part", "idx").mapInArrow(run, schema)


class _Total:
    """Counts of a conversation from those of its pieces in order."""

    def __init__(self, cost: int) -> None:
        self.cost, self.blank, self.duplicate, self.truncated, self.illegal, self.turns = cost, 0, 0, 0, 0, 0
        self.last = self.least = self.most = None

    def add(self, piece: dict) -> None:
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + piece[name])
        if piece["first"] is not None:
            if self.last is not None:
                self.illegal += not legal(self.last, piece["first"])
            self.last = piece["last"]
        if piece["least"] is not None:
            self.turns -= piece["least"] == self.most
            self.least = piece["least"] if self.least is None else self.least
            self.most = piece["most"]

    gaps = _Runs.gaps


def _run(df: DataFrame, conv_col, turn_col, role_col, text_col, copies_col, range_bytes, messages) -> DataFrame:
    rows = df.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        (F.col(copies_col) if copies_col else F.lit(1)).cast("bigint").alias("copies"),
    )
    local = save_scratch(_local(_ranges(rows, range_bytes), messages), "conversations")
    edge = local.where("row is not null").select("conv", "row.*")
    pieces = save_scratch(_pieces(edge), "pieces")
    ways = save_scratch(_ways(pieces, _after(pieces)), "ways")
    done = local.where("result is not null").select("conv", "result")
    out = done.unionByName(_finished(edge, ways, messages))
    return out.select(F.col("conv").alias(conv_col), "result.*")


def repair(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies_col: str | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """One row per conversation: gaps in its turns, faults, cost and letters of the cheapest repair, and its hash.

    ``copies_col`` says how often a row stands at its place (0: it does not, but its conversation is reported).
    """
    return _run(df, conv_col, turn_col, role_col, text_col, copies_col, range_bytes, messages=False)


def repaired_messages(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies_col: str | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """One row per edit: place in the repaired conversation (null where deleted), letter, turn, role and text."""
    return _run(df, conv_col, turn_col, role_col, text_col, copies_col, range_bytes, messages=True)
