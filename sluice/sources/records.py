"""Records that span lines (S8): an escaped terminator, or a raw one inside quotes, without reading a file whole.

The text source splits a file at every terminator, also at those inside a cell.  Whether a line goes on with the
record of the line before it depends on what stands before, so each line is a function of how it is entered: bare
or inside an open quote (after a line that ends in an escape, "bare" means within a bare field).  A quote that opens
a field stays open over lines without a quote of its own; the first line with one decides: a separator or the
line's end after it closes the cell, anything else shows that the opening quote was a character of a bare field, and
the lines since then are records of their own, as they are at the end of the file.

Functions of two states are constants, the identity or the swap, so running counts and last values compose them.
Lines come in the order of their file, a split of it after another (``in_order``), or are dealt and sorted so:
1. every line's function is found by patterns, in place; its task composes those of a split, for each way to enter it,
   and gives one row for a split, with the number of records that start there and the last of them (``_Summary``);
2. windows over a file's splits give every split its entry state, and the next decision after it;
3. the lines are read again with their split's row and joined to records where they stand (``_Joiner``); the records
   are staged, and only the pieces of those that cross a split's end are shuffled and put together.
No task holds more of a file than a split (a ``.gz`` is one split), or one record; of texts, it holds the lines since
the last decision inside an open quote.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import scratch_dir, track_staged

_SPLIT = ["_file", "_block"]


def _quote_patterns(sep: str, q: str, esc: str) -> dict[str, str]:
    """What a line's patterns are made of, from literals of separator, encloser and escape (may be empty)."""
    pair = f"{esc}(?:.|\\z)|" if esc else ""
    not_esc = f"(?!{esc})" if esc else ""
    body = f"(?:{pair}{q}{q}|(?!{q}){not_esc}.)*+"
    bare = f"(?:{pair}(?!{sep}){not_esc}.)*+"
    opened = f"{q}{body}\\z"
    whole = f"{q}{body}{q}"
    cells = f"(?:(?:{whole}(?={sep})|(?!{opened}|{whole}\\z){bare}){sep})*+"
    return {"open_start": f"(?s)\\A{cells}{opened}",
            "open_mid": f"(?s)\\A{bare}{sep}{cells}{opened}",
            "unquoted": f"(?s)\\A{body}\\z",
            "closes": f"(?s)\\A{body}{q}(?:{sep}|\\z)",
            "open_after": f"(?s)\\A{body}{q}{sep}{cells}{opened}"}


def _marked(lines: DataFrame, sep: str, q: str, esc: str, escape: str, encloser: str) -> DataFrame:
    """The lines with the parts of their functions; a line that stands for an error changes nothing."""
    value = F.coalesce(F.col("value"), F.lit(""))
    ends = value.endswith(escape) if escape else F.lit(False)
    if not encloser:
        none = F.lit(False)
        return lines.withColumns({"_esc": ends, "_open_start": none, "_open_mid": none, "_open_after": none,
                                  "_closes": F.lit(None).cast("boolean")})
    has, p = F.instr(value, encloser) > 0, _quote_patterns(sep, q, esc)
    return lines.withColumns({
        "_esc": ends, "_open_start": has & value.rlike(p["open_start"]), "_open_mid": has & value.rlike(p["open_mid"]),
        "_closes": F.when(has & ~value.rlike(p["unquoted"]), value.rlike(p["closes"])),
        "_open_after": has & value.rlike(p["open_after"])})


def _through(df: DataFrame, w, bare: Column, quoted: Column) -> DataFrame:
    """Composes the functions up to each row: ``_state``, the state behind it if that is known whatever the entry, and
    ``_flip``, whether the entry is else swapped."""
    df = df.withColumns({"_t0": bare, "_t1": quoted})
    df = df.withColumn("_swaps", F.sum((F.col("_t0") & ~F.col("_t1")).cast("int")).over(w))
    fixed = F.when(F.col("_t0") == F.col("_t1"), F.struct(F.col("_t0").alias("state"), F.col("_swaps").alias("at")))
    df = df.withColumn("_fix", F.last(fixed, ignorenulls=True).over(w))
    odd = (F.col("_swaps") - F.coalesce("_fix.at", F.lit(0))) % 2 == 1
    return df.withColumns({"_state": F.col("_fix.state") != odd, "_flip": odd}).drop("_t0", "_t1", "_swaps", "_fix")


_FLAGS = ["_esc", "_open_start", "_open_mid", "_closes", "_open_after"]
_ENTRIES = [(quoted, esc) for quoted in (False, True) for esc in (False, True)]


class _Lines:
    """Lines of one split in their order, as columns: flags, and for ``_closes`` also whether it is set."""

    def __init__(self, batch: pa.RecordBatch):
        def flag(name):
            return batch.column(name).fill_null(False).to_numpy(zero_copy_only=False).astype(bool)

        self.n = batch.num_rows
        self.esc, self.start, self.mid, self.closes, self.after = (flag(c) for c in _FLAGS)
        self.decides = batch.column("_closes").is_valid().to_numpy(zero_copy_only=False).astype(bool)
        self.failed = batch.column("_script_error").is_valid().to_numpy(zero_copy_only=False).astype(bool)
        place = np.where(self.decides, np.arange(self.n), self.n)
        self.next = np.minimum.accumulate(place[::-1])[::-1]  # the first decision from the line on, or n
        self.known = int(self.n - np.argmax(self.decides[::-1])) if self.decides.any() else 0  # lines with one after them

    def escaped(self, before: bool) -> np.ndarray:
        """Whether the line before ends in an escape."""
        return np.append(before, self.esc[:-1]) if self.n else self.esc

    def states(self, escaped: np.ndarray, entry: bool) -> np.ndarray:
        """Whether each line is entered inside a quote; then the state behind the last one."""
        bare = np.where(escaped, self.mid, self.start)
        quoted = np.where(self.decides, np.where(self.closes, self.after, bare), True)
        at = np.maximum.accumulate(np.where(bare == quoted, np.arange(self.n), -1))
        swaps = np.cumsum(bare & ~quoted)
        since = swaps - np.where(at >= 0, swaps[at], 0)
        return np.append(entry, np.where(at >= 0, bare[at], entry) ^ (since % 2 == 1))

    def linked(self, escaped: np.ndarray, states: np.ndarray, later: bool) -> np.ndarray:
        """Whether each line goes on with the record before it, given the first decision after these lines."""
        following = np.append(self.closes, later)[self.next]
        return ~self.failed & (escaped | (states[:-1] & following))


class _Summary:
    """What a split does to a file's records, for each way to enter it: (inside a quote, after an escape)."""

    def __init__(self, file: str, block: int):
        self.file, self.block, self.seen, self.first_decision, self.esc, self.last_mid = file, block, 0, None, False, None
        self.state = {e: e[0] for e in _ENTRIES}
        # (records that start, place of the last, first line goes on): of lines before a decision, and of those
        # since the last one if the next decision is False or True
        self.done = {e: (0, None, None) for e in _ENTRIES}
        self.open = {(e, later): (0, None, None) for e in _ENTRIES for later in (False, True)}

    def add(self, lines: _Lines, mids: np.ndarray) -> None:
        def more(total, linked, offset):
            starts = np.flatnonzero(~linked)
            n, last, first = total
            return (n + len(starts), offset + int(starts[-1]) if len(starts) else last,
                    bool(linked[0]) if first is None and len(linked) else first)

        decision = bool(lines.closes[lines.next[0]]) if lines.known else None
        if self.first_decision is None:
            self.first_decision = decision
        for e in _ENTRIES:
            escaped = lines.escaped(self.esc if self.seen else e[1])
            states = lines.states(escaped, self.state[e])
            self.state[e] = bool(states[-1])
            linked = {later: lines.linked(escaped, states, later) for later in (False, True)}
            if decision is not None:
                self.done[e] = more(self._sum(self.done[e], self.open[e, decision]), linked[False][:lines.known], self.seen)
            for later in (False, True):
                kept = self.open[e, later] if decision is None else (0, None, None)
                self.open[e, later] = more(kept, linked[later][lines.known:], self.seen + lines.known)
        self.seen += lines.n
        self.esc, self.last_mid = bool(lines.esc[-1]), int(mids[-1])

    @staticmethod
    def _sum(a, b):
        return a[0] + b[0], a[1] if b[1] is None else b[1], b[2] if a[2] is None else a[2]

    def row(self) -> dict:
        cases = [self._sum(self.done[e], self.open[e, later]) for e in _ENTRIES for later in (False, True)]
        return {"_file": self.file, "_block": self.block, "_next": self.first_decision, "_z_esc": self.esc,
                "_end": self.last_mid + 1, "_exits": [self.state[e] for e in _ENTRIES],
                "_n": [c[0] for c in cases], "_last": [c[1] for c in cases], "_goes": [bool(c[2]) for c in cases]}


_SUMMARY = pa.schema([("_file", pa.string()), ("_block", pa.int64()), ("_next", pa.bool_()), ("_z_esc", pa.bool_()),
                      ("_end", pa.int64()), ("_exits", pa.list_(pa.bool_())), ("_n", pa.list_(pa.int64())),
                      ("_last", pa.list_(pa.int64())), ("_goes", pa.list_(pa.bool_()))])


def _runs(batch: pa.RecordBatch):
    """The batch cut where a new split begins."""
    if not batch.num_rows:
        return
    files, blocks = batch.column("_file").dictionary_encode(), batch.column("_block").to_numpy(zero_copy_only=False)
    codes = files.indices.to_numpy(zero_copy_only=False)
    new = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    for start, end in zip([0, *new], [*new, batch.num_rows]):
        yield files.dictionary[int(codes[start])].as_py(), int(blocks[start]), batch.slice(start, end - start)


def _summaries(batches):
    now, rows = None, []
    for batch in batches:
        for file, block, part in _runs(batch):
            if now is None or (now.file, now.block) != (file, block):
                rows += [] if now is None else [now.row()]
                now = _Summary(file, block)
            now.add(_Lines(part), part.column("_mid").to_numpy(zero_copy_only=False))
        if len(rows) >= 1024:
            yield pa.RecordBatch.from_pylist(rows, _SUMMARY)
            rows = []
    yield pa.RecordBatch.from_pylist([*rows, *([] if now is None else [now.row()])], _SUMMARY)


def _splits(marked: DataFrame) -> DataFrame:
    """One row for a split: its entry (``_entry``, ``_entry_esc``), the decision after it (``_later``), whether the next
    split's first line goes on (``_goes_on``), the record open before it (``_open``), the number of records before it
    in the file (``_before``) and whether the file ends in an escape (``_cut``)."""
    rows = marked.select(*_SPLIT, "_mid", "_script_error", *_FLAGS).mapInArrow(
        _summaries, "_file string, _block long, _next boolean, _z_esc boolean, _end long, _exits array<boolean>, "
                    "_n array<long>, _last array<long>, _goes array<boolean>")
    w = Window.partitionBy("_file").orderBy("_block")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("_file").orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"_entry_esc": F.coalesce(F.lag("_z_esc").over(w), F.lit(False)),
                             "_later": F.coalesce(F.last("_next", ignorenulls=True).over(after), F.lit(False))})
    esc, later = F.col("_entry_esc").cast("int"), F.col("_later").cast("int")
    rows = _through(rows, w.rowsBetween(Window.unboundedPreceding, 0),
                    *(F.get("_exits", F.lit(2 * quoted) + esc) for quoted in (0, 1)))
    rows = rows.withColumn("_entry", F.coalesce(F.lag("_state").over(w), F.lag("_flip").over(w), F.lit(False)))
    case = 4 * F.col("_entry").cast("int") + 2 * esc + later  # as in ``_Summary.row``
    rows = rows.withColumns({"_last": F.get("_last", case), "_records": F.get("_n", case), "_first_linked": F.get("_goes", case)})
    rows = rows.withColumn("_last", F.when(F.col("_last").isNotNull(), F.struct("_block", F.col("_last").alias("at"))))
    return rows.select(
        *_SPLIT, "_entry", "_entry_esc", "_later",
        F.coalesce(F.lead("_first_linked").over(w), F.lit(False)).alias("_goes_on"),
        F.last("_last", ignorenulls=True).over(before).alias("_open"),
        F.coalesce(F.sum("_records").over(before), F.lit(0)).alias("_before"),
        (F.lead("_block").over(w).isNull() & F.col("_z_esc")).alias("_cut"), "_end")


class _Joiner:
    """The records of one split, from its lines in their order and its row of ``_splits``."""

    def __init__(self, file: str, block: int, first: dict, terminator: str, emit):
        self.file, self.block, self.split, self.terminator, self.emit = file, block, first, terminator, emit
        self.seen, self.placed, self.records = 0, 0, first["_before"]
        self.esc, self.state = first["_entry_esc"], first["_entry"]
        self.waiting: list = []  # lines whose next decision is not known yet
        # the record that the next lines may go on with: its texts, start and first line's columns
        owner = first["_open"]
        self.parts: list = []
        self.head = (owner and (owner["_block"], owner["at"]), None, None, self.records - 1)

    def add(self, batch: pa.RecordBatch) -> None:
        lines = _Lines(batch)
        escaped = lines.escaped(self.esc)
        states = lines.states(escaped, self.state)
        if lines.known:
            decision = bool(lines.closes[lines.next[0]])
            for held in self.waiting:
                self._place(held[0], held[1 + decision])
            self.waiting = []
            self._place(batch.slice(0, lines.known), lines.linked(escaped, states, False)[:lines.known])
        if lines.known < lines.n:
            false, true = (lines.linked(escaped, states, later)[lines.known:] for later in (False, True))
            rest, same = batch.slice(lines.known), false == true
            clear = lines.n - lines.known if same.all() else int(np.argmin(same))
            if clear and not self.waiting:  # nothing depends on the decision so far
                self._place(rest.slice(0, clear), false[:clear])
                rest, false, true = rest.slice(clear), false[clear:], true[clear:]
            if rest.num_rows:
                self.waiting.append((rest, false, true))
        self.esc, self.state = bool(lines.esc[-1]), bool(states[-1])

    def _place(self, batch: pa.RecordBatch, linked: np.ndarray) -> None:
        values, starts = batch.column("value"), np.flatnonzero(~linked)
        if not len(starts):
            self.parts.append(values)
        else:
            if starts[0]:
                self.parts.append(values.slice(0, int(starts[0])))
            self._close(False)
            first, last = int(starts[0]), int(starts[-1])
            if last > first:
                whole = starts[:-1]
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts - first, pa.int32()),
                                                                values.slice(first, last - first)), self.terminator)
                rows = batch.take(pa.array(whole))
                self.emit(texts, self.file, self.block, rows.column("_mid"), rows.column("_script_error"),
                          pa.array(np.arange(len(whole)) + self.records), None, self.placed + first)
            self.records += len(starts)
            self.parts = [values.slice(last)]
            self.head = ((self.block, self.placed + last), batch.column("_mid")[last], batch.column("_script_error")[last],
                         self.records - 1)
        self.placed += batch.num_rows

    def _close(self, goes_on: bool) -> None:
        """The open record ends here, or at least its piece of this split."""
        if not self.parts:
            return
        owner, mid, error, line = self.head
        values = pa.concat_arrays(self.parts)
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), self.terminator)
        begun = mid is not None
        self.emit(text, self.file, self.block, pa.array([mid.as_py() if begun else None], pa.int64()),
                  pa.array([error.as_py() if begun else None], pa.string()), pa.array([line], pa.int64()),
                  None if begun and not goes_on else owner, 0)
        self.parts = []

    def end(self) -> None:
        for held in self.waiting:
            self._place(held[0], held[1 + bool(self.split["_later"])])
        self._close(self.split["_goes_on"])


_RECORDS = pa.schema([("value", pa.string()), ("_file", pa.string()), ("_block", pa.int64()), ("_mid", pa.int64()),
                      ("_script_error", pa.string()), ("_line", pa.int64()), ("_start_block", pa.int64()), ("_start", pa.int64())])
_BATCH_ROWS = 4096


def _joined(terminator: str):
    def run(batches):
        out, held = [], [0]

        def emit(texts, file, block, mids, errors, lines, owner, at):
            n = len(texts)
            owner = owner or (None, None)
            out.append(pa.RecordBatch.from_arrays(
                [texts, pa.repeat(pa.scalar(file, pa.string()), n), pa.repeat(pa.scalar(block, pa.int64()), n), mids, errors,
                 lines, *(pa.repeat(pa.scalar(x, pa.int64()), n) for x in owner)], schema=_RECORDS))
            held[0] += n

        def ready():
            whole = pa.Table.from_batches(out, _RECORDS).combine_chunks().to_batches()
            out.clear()
            held[0] = 0
            return whole

        now = None
        for batch in batches:
            for file, block, part in _runs(batch):
                if now is None or (now.file, now.block) != (file, block):
                    if now is not None:
                        now.end()
                    now = _Joiner(file, block, part.column("_split")[0].as_py(), terminator, emit)
                now.add(part)
            if held[0] >= _BATCH_ROWS:
                yield from ready()
        if now is not None:
            now.end()
        yield from ready()

    return run


#: Splits whose rows are broadcast at most; of more, the lines are dealt to them.
BROADCAST_SPLITS = 200_000


def _dealt(lines: DataFrame) -> DataFrame:
    """Each split's lines in one task, in their order."""
    return lines.repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "_mid")


def join_lines(lines: DataFrame, sep: str, q: str, esc: str, escape: str, encloser: str, terminator: str,
               in_order: bool = False) -> DataFrame:
    """``value``, ``_file``, ``_block``, ``_mid``, ``_script_error`` and ``_line`` (place in the file) of the records
    of ``lines`` (``value`` protected).  ``sep``, ``q`` and ``esc`` are pattern literals.  With an encloser, a file
    whose last line ends in an escape has a row with ``_script_error``: no record ends there.  ``in_order``: a task has
    whole splits, each one's lines together and in their order, and the same when they are read again."""
    spark = lines.sparkSession
    if "_script_error" not in lines.columns:
        lines = lines.withColumn("_script_error", F.lit(None).cast("string"))

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = scratch_dir(spark, name)
        df.write.parquet(path)
        track_staged(path)
        return spark.read.parquet(path)

    marked = _marked(lines.select("value", *_SPLIT, "_mid", "_script_error"), sep, q, esc, escape, encloser)
    if not in_order:
        marked = stage(marked, "record-lines")
    flags = marked.drop("value")
    splits = stage(_splits(flags if in_order else _dealt(flags)), "record-splits")
    own = splits.select(*_SPLIT, F.struct("_entry", "_entry_esc", "_later", "_goes_on", "_open", "_before").alias("_split"))
    few = splits.count() <= BROADCAST_SPLITS
    df = marked.join(F.broadcast(own) if few else own, _SPLIT)
    df = (df if few and in_order else _dealt(df)).select("value", *_SPLIT, "_mid", "_script_error", *_FLAGS, "_split").mapInArrow(
        _joined(terminator), "value string, _file string, _block long, _mid long, _script_error string, _line long, "
                             "_start_block long, _start long")
    df = stage(df, "records")
    columns = ["value", *_SPLIT, "_mid", "_script_error", "_line"]
    parts = F.sort_array(F.collect_list(F.struct("_block", "_mid", "value")))
    several = df.where(F.col("_start").isNotNull()).groupBy("_file", "_start_block", "_start").agg(
        F.array_join(F.transform(parts, lambda x: x["value"]), terminator).alias("value"),
        F.min("_line").alias("_line"), F.max("_mid").alias("_mid")).select(
        "value", "_file", F.col("_start_block").alias("_block"), "_mid", F.lit(None).cast("string").alias("_script_error"), "_line")
    records = df.where(F.col("_start").isNull()).select(columns).unionByName(several)
    if not encloser:
        return records
    cut = splits.where("_cut").select(
        F.lit(None).cast("string").alias("value"), *_SPLIT, F.col("_end").alias("_mid"),
        F.lit("no record ends after the escape at the end of the file").alias("_script_error"), F.col("_end").alias("_line"))
    return records.unionByName(cut)
