"""Structure of conversations: faults, and the cheapest repair.

Each row's first fault counts: blank (no word), duplicate (role and text were
there before in the conversation), truncated (does not end in a sentence mark).
The repair keeps, re-roles, deletes and inserts rows until the roles read
``(s?(ua)+)?``, at least cost; :mod:`.block_tables` finds it by tables over
blocks of rows.

Conversations are gathered by id and streamed through one sorted pass; a task
holds the rows of one conversation at a time. Those with more than ``hot_rows``
rows are cut into stretches over range partitions instead: each stretch gives
the costs between its two ends, which are put together per conversation; then
each stretch is traced from all states, and the chosen edits are read off. Only
the digest of the repaired text, which is defined front to back, is one stream.

Nulls: a null id is a conversation of its own; null turns come first; null role
or text is one blank. Empty texts are blank rows. Equal turns are ordered by
role, then by a hash of the text, then by the text, so repeated rows are equal
neighbours. Long texts are whole. An empty table gives an empty result. Further
columns are ignored, so their names can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .block_tables import END, UNITS, closing, repaired, symbol, tables
from .common import written

#: Rows from which a conversation is cut into stretches, and rows of a stretch.
HOT_ROWS = 50_000

# What is no part of a word, and marks that end a sentence.
_BLANKS = " \t\n\x0b\x0c\r"
_MARKS = ".!?"
_LEGAL = ("su", "ua", "au")

REPORT = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long,"
    " cost long, audit string, repaired_sha256 string"
)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after damage by checksum of id and turn; ``present`` is false for dropped ones."""
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    )
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    text = F.coalesce("text", F.lit(" "))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, _MARKS, "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    copies = F.explode(F.array_repeat((kind != 0), F.when(kind == 3, 2).otherwise(1))).alias("present")
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies)


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows with what is asked of each text worked out, and their order."""
    body = F.rtrim("text", F.lit(_BLANKS))
    return rows.select(
        F.col("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        "present",
    ).select(
        "conv_id",
        "turn",
        "role",
        F.xxhash64("text").alias("text_hash"),
        "text",
        "present",
        (body == "").alias("is_blank"),
        (~F.right(body, F.lit(1)).isin(*_MARKS)).alias("is_cut"),
    )


_ORDER = ["conv_id", "turn", "role", "text_hash", "text"]


class _Group:
    """Counts over the rows of one conversation, in order."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns: list[int] = []
        self.symbols: list[int] = []
        self.rows: list[tuple[str, str]] = []
        self.seen: set[tuple[str, str]] = set()

    def add(self, turn: int | None, role: str, text: str, is_blank: bool, is_cut: bool) -> None:
        if self.rows and self.rows[-1][0][:1] + role[:1] not in _LEGAL:
            self.illegal += 1
        row = (role, text)
        again = not is_blank and row in self.seen
        truncated = is_cut and not (is_blank or again)
        self.blank += is_blank
        self.duplicate += again
        self.truncated += truncated
        self.seen.add(row)
        self.rows.append(row)
        self.symbols.append(symbol(role[:1], truncated, is_blank or again))
        if turn is not None:
            self.turns.append(turn)

    def gaps(self) -> int:
        if not self.turns:
            return 0
        return max(self.turns) - min(self.turns) + 1 - len(set(self.turns))

    def repair(self) -> tuple[int, str, list[tuple[str, str]]]:
        made = tables()
        codes = made.blocks(self.symbols)
        numbers, costs = made.behind(codes, END)
        audit, state = made.edits(codes, numbers, 0)
        audit += closing(state)
        return costs[0], audit, repaired(self.rows, audit)

    def report(self) -> tuple:
        cost, audit, rows = self.repair()
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows).encode()).hexdigest()
        counts = (self.gaps(), self.blank, self.duplicate, self.truncated, self.illegal)
        return (*counts, cost, audit, digest)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, _Group]]:
    """The conversations of a sorted stream, whatever batches they lie in."""
    key, group = None, None
    for batch in batches:
        names = ("conv_id", "turn", "role", "text", "present", "is_blank", "is_cut")
        for conv, turn, role, text, present, blank, cut in zip(
            *[batch.column(n).to_pylist() for n in names]
        ):
            if group is None or conv != key:
                if group is not None:
                    yield key, group
                key, group = conv, _Group()
            if present:
                group.add(turn, role, text, blank, cut)
    if group is not None:
        yield key, group


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
    )


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def _arrow(ddl: str, first: pa.DataType) -> pa.Schema:
    names = [p.split(" ") for p in ddl.split(", ")]
    return pa.schema([(n, first if i == 0 else _TYPES[t]) for i, (n, t) in enumerate(names)])


def _streamed(df: DataFrame, rows_of, ddl: str, rows: int = 5_000) -> DataFrame:
    """``mapInArrow`` of a function from batches to tuples, ``rows`` of them in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list[pa.DataType] = []

        def noted():
            for batch in batches:
                kind[:] = [batch.schema.field("conv_id").type]
                yield batch

        out: list[tuple] = []
        for row in rows_of(noted()):
            out.append(row)
            if len(out) == rows:
                yield _columns(out, _arrow(ddl, kind[0]))
                out = []
        if out:
            yield _columns(out, _arrow(ddl, kind[0]))

    kind = df.schema["conv_id"].dataType.simpleString()
    return df.mapInArrow(run, ddl.format(id=kind))


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["conv_id"].eqNullSafe(right["conv_id"])


def _split(rows: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary and, if there are any, of hot conversations."""
    sizes = rows.groupBy("conv_id").agg(F.count_if("present").alias("n"))
    # At most one row for every hot_rows of the input.
    hot = written(sizes.where(F.col("n") > hot_rows).select("conv_id"), "hot-conversations")
    if hot.isEmpty():
        return rows, None
    return rows.join(hot, _same(rows, hot), "left_anti"), rows.join(hot, _same(rows, hot), "left_semi")


def _in_turn(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions(*_ORDER)


def repair(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per conversation: faults, cost, edits and digest of what is left.

    ``rows`` has conv_id, turn, role, text and ``present``: a conversation of which
    no row is present has a report too.
    """
    ordinary, hot = _split(_ordered(rows), hot_rows)

    def reports(batches):
        for key, group in _groups(batches):
            yield (key, *group.report())

    result = _streamed(_in_turn(ordinary), reports, REPORT)
    return result if hot is None else result.unionByName(_repair_hot(hot, hot_rows))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv_id, place, role, text: the conversations after repair, a row per turn."""

    def turns(batches):
        for key, group in _groups(batches):
            for place, (role, text) in enumerate(group.repair()[2]):
                yield key, place, role, text

    ddl = "conv_id {id}, place int, role string, text string"
    return _streamed(_in_turn(_ordered(rows)), turns, ddl)


# --- conversations that are too long for one task ----------------------------------


def _stretches(hot: DataFrame, hot_rows: int) -> DataFrame:
    """The rows of hot conversations with their part and their place in it, written once."""
    total = hot.count()
    parts = max(2, -(-total // max(1, hot_rows // 2)))
    # Rows that are equal in all else may be many: their arrival parts them.
    arrived = hot.where("present").withColumn("arrival", F.monotonically_increasing_id())
    keys = [k for k in _ORDER if k != "text"]
    ranged = arrived.repartitionByRange(parts, *keys, "arrival").sortWithinPartitions(*_ORDER, "arrival")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = ranged.withColumn("part", F.spark_partition_id()).withColumn("at", place)
    return written(ranged, "stretches")


def _repair_hot(hot: DataFrame, hot_rows: int) -> DataFrame:
    rows = _stretches(hot, hot_rows)

    # Of equal rows the first one stays; only rows that have an equal are looked up.
    what = rows.select(
        "conv_id",
        F.md5(F.concat_ws(":", F.length("role"), "role", "text")).alias("what"),
        *("role", "part", "at", "turn", "is_blank", "is_cut"),
    )
    firsts = what.groupBy("conv_id", "what").agg(
        F.min(F.struct("part", "at")).alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").select(F.col("conv_id").alias("c"), F.col("what").alias("w"), "first")
    marked = what.join(
        firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("what") == F.col("w")), "left"
    )
    again = F.coalesce(F.struct("part", "at") > F.col("first"), F.lit(False)) & ~F.col("is_blank")
    marked = marked.withColumn("again", again).withColumn(
        "truncated", F.col("is_cut") & ~F.col("is_blank") & ~F.col("again")
    )
    marked = written(
        marked.select("conv_id", "part", "at", "turn", "role", "is_blank", "again", "truncated"), "symbols"
    )
    counts = marked.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
        F.count_if("is_blank").alias("blank"),
        F.count_if("again").alias("duplicate"),
        F.count_if("truncated").alias("truncated"),
    )

    def by_part(df: DataFrame, *order: str) -> DataFrame:
        return df.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", *order)

    def stretch_rows(batches, names):
        """(conv_id, part), rows of the named columns, for each stretch; bounded by its part."""
        key, held = None, []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "part", *names)]
            for conv, part, *rest in zip(*columns):
                if held and (conv, part) != key:
                    yield key, held
                    held = []
                key = (conv, part)
                held.append(rest)
        if held:
            yield key, held

    symbol_names = ("role", "is_blank", "again", "truncated")

    def symbols_of(held):
        return [symbol(r[0][:1], r[3], r[1] or r[2]) for r in held]

    # Costs from each state at the start of a stretch to each state at its end.
    def ends(batches):
        for (conv, part), held in stretch_rows(batches, symbol_names):
            codes = tables().blocks(symbols_of(held))
            costs = [c for q in range(4) for c in tables().behind(codes, UNITS[q])[1]]
            initials = [r[0][:1] for r in held]
            illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
            yield (conv, part, illegal, initials[0], initials[-1], *costs)

    names = [f"c{i}" for i in range(16)]
    ddl = "conv_id {id}, part int, illegal long, initial string, final string, " + ", ".join(
        f"{n} long" for n in names
    )
    between = written(_streamed(by_part(marked, "at"), ends, ddl), "between")

    # One row per stretch: per conversation no more than there are parts.
    def join_costs(batches):
        for (conv, _), held in _by_conversation(batches, ("part", "illegal", "initial", "final", *names)):
            after, joined, illegal, follows = END, [], 0, None
            for part, inside, first, last, *costs in reversed(held):
                joined.append((part, after))
                illegal += inside + (follows is not None and last + follows not in _LEGAL)
                follows = first
                after = tuple(min(costs[4 * q + p] + after[q] for q in range(4)) for p in range(4))
            for part, vector in joined:
                yield (conv, part, *vector, after[0], illegal)

    ddl = "conv_id {id}, part int, v0 long, v1 long, v2 long, v3 long, cost long, illegal long"
    behind = written(_streamed(_whole(between), join_costs, ddl), "behind")

    def with_stretch(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({"conv_id": "c", "part": "p"})
        on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
        return left.join(right, on).drop("c", "p")

    # Edits of each stretch from every state it may be entered in.
    def trace(batches):
        wanted = (*symbol_names, "v0", "v1", "v2", "v3")
        for (conv, part), held in stretch_rows(batches, wanted):
            codes = tables().blocks(symbols_of(held))
            numbers, _ = tables().behind(codes, tuple(held[0][4:]))
            for state in range(4):
                audit, left = tables().edits(codes, numbers, state)
                yield conv, part, state, left, audit

    ddl = "conv_id {id}, part int, entered int, left int, audit string"
    traced = _streamed(by_part(with_stretch(marked, behind), "at"), trace, ddl, rows=8)
    traced = written(traced, "traced")

    def chain(batches):
        for (conv, _), held in _by_conversation(batches, ("part", "entered", "left")):
            ways = {(part, entered): left for part, entered, left in held}
            state = 0
            for part in sorted({part for part, _, _ in held}):
                yield conv, part, state
                state = ways[part, state]
            yield conv, -1, state

    path = written(
        _streamed(_whole(traced.select("conv_id", "part", "entered", "left")), chain, "conv_id {id}, part int, entered int"),
        "path",
    )
    entered = path.withColumnRenamed("entered", "state")
    chosen = with_stretch(traced, entered).where("entered = state").select("conv_id", "part", "entered", "audit")

    # The text of each stretch after its edits; rows that stand behind the last come at the end.
    def write_out(batches):
        for (conv, part), held in stretch_rows(batches, ("role", "text", "entered", "audit")):
            turns = repaired([tuple(r[:2]) for r in held], held[0][3], held[0][2])
            yield conv, part, held[0][3], "\n".join(f"{r}:{t}" for r, t in turns), bool(turns)

    ddl = "conv_id {id}, part int, audit string, piece string, any boolean"
    pieces = _streamed(
        by_part(with_stretch(rows.select("conv_id", "part", "at", "role", "text"), chosen), "at"), write_out, ddl, rows=8
    )
    rest = path.where("part < 0").select("conv_id", "entered")

    def close(batches):
        for batch in batches:
            for conv, state in zip(batch.column("conv_id").to_pylist(), batch.column("entered").to_pylist()):
                turns = repaired([], closing(state), state)
                text = "\n".join(f"{r}:{t}" for r, t in turns)
                yield conv, (1 << 31) - 1, closing(state), text, bool(turns)

    pieces = pieces.unionByName(_streamed(rest, close, ddl))

    # The digest runs over the text front to back: one stream, a piece at a time.
    def digest(batches):
        key, audit, running, begun = None, [], None, False
        for batch in batches:
            for conv, piece, some, edits in zip(
                *[batch.column(n).to_pylist() for n in ("conv_id", "piece", "any", "audit")]
            ):
                if running is not None and conv != key:
                    yield key, "".join(audit), running.hexdigest()
                    running = None
                if running is None:
                    key, audit, running, begun = conv, [], hashlib.sha256(), False
                audit.append(edits)
                if some:
                    running.update(("\n" if begun else "").encode() + piece.encode())
                    begun = True
        if running is not None:
            yield key, "".join(audit), running.hexdigest()

    digests = _streamed(
        pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part"), digest,
        "conv_id {id}, audit string, repaired_sha256 string",
    )
    costs = behind.groupBy("conv_id").agg(F.max("cost").alias("cost"), F.max("illegal").alias("illegal"))
    found = digests
    for more in (counts, costs):
        more = more.withColumnRenamed("conv_id", "c")
        found = found.join(more, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    return found.select(*[p.split(" ")[0] for p in REPORT.split(", ")])


def _whole(stretches: DataFrame) -> DataFrame:
    """Rows of one conversation together, by part: as many as it has stretches."""
    return stretches.repartition("conv_id").sortWithinPartitions("conv_id", "part")


def _by_conversation(batches, names):
    key, held, some = None, [], False
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", *names)]
        for conv, *rest in zip(*columns):
            if some and conv != key:
                yield (key, None), held
                held = []
            key, some = conv, True
            held.append(rest)
    if some:
        yield (key, None), held


def op12_repair(conversations: DataFrame) -> DataFrame:
    """All conversations after damage, with faults and cheapest repair."""
    return repair(damage(conversations.select("conv_id", "turn", "role", "text")))
