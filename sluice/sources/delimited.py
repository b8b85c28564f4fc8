"""Delimited text in MySQL ``LOAD DATA`` style.

Options: field terminator (default tab), encloser (default none), escape
(default backslash), line terminator (default newline), line prefix, lines to
skip per file, column list and a file-id column.  Spark's CSV reader does not
implement these escapes (it keeps ``\\t`` and ``\\\\`` as two characters and
reads an empty field as NULL), so lines are read with the text source and
split with built-in string / regex functions — everything stays JVM-side and
the read stays splittable.

Decoding, per line:
1. every escaped escape (``\\\\``) becomes a placeholder (a Unicode
   non-character), so each remaining escape starts exactly one pair;
2. fields: unenclosed → ``split`` on the terminator not preceded by the
   escape; enclosed → ``regexp_extract_all`` with possessive patterns
   (quoted field, doubled / escaped quotes, or a bare field);
3. per field: unquoted ``\\N`` → NULL; escape + any other character → that
   character; then one ``translate`` restores the escape character and the
   control characters of ``\\0 \\b \\n \\r \\t \\Z`` (marked per line in step 1).
   Text that holds such a non-character itself is guarded in step 1 and restored
   here, so every text comes back as it was.

Row identity for "first / last row wins" and "earliest error":
``(_file, _block, _mid)`` — the split's start offset and a monotonically
increasing id, which is ordered within a split.  Callers checkpoint the
parsed rows before using ``_mid`` twice.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from sluice.sources.paths import decode_file_path
from sluice.sources.records import join_lines
from sluice.sources.streams import reachable, read_file_lines

# Fixed values that must equal the reference's option defaults.
DEFAULT_FIELDS_TERMINATED = "\t"
DEFAULT_FIELDS_ENCLOSED = ""
DEFAULT_FIELDS_ESCAPED = "\\"
DEFAULT_LINES_TERMINATED = "\n"

# MySQL escape letters and the characters they stand for.
ESCAPE_LETTERS = {"0": "\x00", "b": "\b", "n": "\n", "r": "\r", "t": "\t", "Z": "\x1a"}

_PLACEHOLDER = "﷐"
# one Unicode non-character per escape letter, assigned in ESCAPE_LETTERS order
_LETTER_MARKS = {letter: chr(0xFDD1 + i) for i, letter in enumerate(ESCAPE_LETTERS)}
# a mark that a text holds itself becomes two characters, the guard and one of its own
_GUARD = chr(0xFDD7)
_GUARDED = {mark: _GUARD + chr(0xFDD8 + i) for i, mark in enumerate([_PLACEHOLDER, *_LETTER_MARKS.values(), _GUARD])}
_HOLDS_MARK = f"[{_PLACEHOLDER}-{_GUARD}]"


@dataclass(frozen=True)
class TextOptions:
    fields_terminated: str = DEFAULT_FIELDS_TERMINATED
    fields_enclosed: str = DEFAULT_FIELDS_ENCLOSED
    fields_escaped: str = DEFAULT_FIELDS_ESCAPED
    lines_terminated: str = DEFAULT_LINES_TERMINATED
    lines_starting: str = ""
    ignore_lines: int = 0
    columns: tuple[str, ...] = field(default_factory=tuple)
    file_id_column: str | None = None
    # Allow raw line terminators inside a field: after an escape, or (with an
    # encloser) inside quotes — multi-line CSV cells (``records``).  Costs a
    # second read and a staged copy, so it is opt-in.
    escaped_terminators: bool = False

    def __post_init__(self):
        if not self.fields_terminated:
            raise ValueError("fields terminator must not be empty")
        if not self.lines_terminated:
            raise ValueError("lines terminator must not be empty")
        if len(self.fields_enclosed) > 1 or len(self.fields_escaped) > 1:
            raise ValueError("encloser and escape are single characters")
        if self.ignore_lines < 0:
            raise ValueError("ignore_lines must be >= 0")
        if self.file_id_column and self.file_id_column in self.columns:
            raise ValueError("the file id column is filled by the load and cannot be one of the columns read")

    @classmethod
    def from_text(cls, **texts) -> "TextOptions":
        """Options as a user types them: escapes in separators decoded (F17), ``columns`` as ``a, b, c``."""
        columns = split_columns(texts.pop("columns", None))
        return cls(columns=columns, **{k: unescape_option(v) if isinstance(v, str) else v for k, v in texts.items()})

    def with_(self, **kw) -> "TextOptions":
        return replace(self, **kw)


def unescape_option(text: str | None) -> str | None:
    """option text with escapes such as ``\\n``, ``\\t`` or ``\\u0001``
    decoded; text that does not decode (odd backslashes) is kept."""
    if not text:
        return text
    try:
        return text.encode("latin-1", "backslashreplace").decode("unicode_escape")
    except (UnicodeDecodeError, ValueError):
        return text


def split_columns(text: str | None) -> tuple[str, ...]:
    """``a, b ,c`` → ``('a', 'b', 'c')``."""
    return tuple(x.strip() for x in text.split(",")) if text else ()


def _q(text: str) -> str:
    """Java-regex literal of ``text``."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


# ---------------------------------------------------------------------------
# reading lines
# ---------------------------------------------------------------------------

def _plain_line(value: Column, esc: str) -> Column:
    """True when a line holds no escape and no mark — its fields need no decoding
    (the common case, taken without running the decoder)."""
    if not esc:
        return F.lit(True)
    return (F.instr(value, esc) == 0) & ~value.rlike(_HOLDS_MARK)


def _protect(value: Column, esc: str) -> Column:
    """Step 1 on a whole line: escaped escapes and escape letters become
    single non-characters, so they can neither split fields nor be misread,
    and each field later needs one ``translate`` to restore them."""
    if not esc:
        return value
    own = F.replace(value, F.lit(_GUARD), F.lit(_GUARDED[_GUARD]))
    for mark, pair in _GUARDED.items():
        if mark != _GUARD:
            own = F.replace(own, F.lit(mark), F.lit(pair))
    out = F.replace(F.when(value.rlike(_HOLDS_MARK), own).otherwise(value), F.lit(esc + esc), F.lit(_PLACEHOLDER))
    for letter, mark in _LETTER_MARKS.items():
        out = F.replace(out, F.lit(esc + letter), F.lit(mark))
    return out


#: Names that do not end in .gz, as a Hadoop glob.
_NOT_GZ = "{*[^z],*[^g]z,*[^.]gz,z,gz}"


def streamed_files(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """(path) of the ``.gz`` files below ``paths``: a gzip is one task's anyway, and read by ``streams`` a corrupt
    one fails alone.  None where there are none, or where tasks cannot open the store."""
    if not paths or not all(map(reachable, paths)):
        return None
    packed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.gz").load(paths).select("path"))
    return None if packed.isEmpty() else packed


def _terminator_stands_alone(opts: TextOptions) -> bool:
    """Whether lines can be cut at every terminator first and joined later: no other special character is in it, it
    does not overlap itself, and an escape before it is no escape letter's."""
    lt, esc = opts.lines_terminated, opts.fields_escaped
    others = set(opts.fields_terminated + opts.fields_enclosed + esc)
    overlaps = any(lt[:k] == lt[-k:] for k in range(1, len(lt)))
    return not (others & set(lt) or overlaps or (esc and lt[0] in ESCAPE_LETTERS))


def joined_records(lines: DataFrame, opts: TextOptions, in_order: bool = False) -> DataFrame:
    """Records of lines (``read_lines``) whose fields may hold raw terminators; ``in_order`` as of ``join_lines``."""
    literals = (_q(x) if x else "" for x in (opts.fields_terminated, opts.fields_enclosed, opts.fields_escaped))
    records = join_lines(lines, *literals, opts.fields_escaped, opts.fields_enclosed, opts.lines_terminated,
                         in_order)
    return records.withColumn("_plain", _plain_line(F.col("value"), opts.fields_escaped))


def _no_lines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "value STRING, _plain BOOLEAN, _file STRING, _block BIGINT, _mid BIGINT")


def read_lines(spark: SparkSession, paths: list[str], opts: TextOptions, streamed: DataFrame | None = None) -> DataFrame:
    """Lines of every file with ``_file`` (decoded URI), ``_block`` (split
    start) and ``_mid`` (ordered within a split); the value is protected
    (step 1).  Prefix and skip-lines are applied.  ``streamed`` (``path``)
    names files to read besides ``paths`` that Spark's text source would hide
    or, if corrupt, end the job at; by default the ``.gz`` files of ``paths``."""
    esc = opts.fields_escaped
    lt = opts.lines_terminated
    if opts.escaped_terminators and not _terminator_stands_alone(opts):
        whole = spark.read.text(paths, wholetext=True, recursiveFileLookup=True).select(
            _protect(F.col("value"), esc).alias("value"),
            decode_file_path(F.col("_metadata.file_path")).alias("_file"))
        if opts.fields_enclosed:
            # records end at a terminator outside quotes (raw terminators
            # inside an enclosed field belong to the field)
            value = F.when(F.col("value").endswith(lt), F.col("value")).otherwise(F.concat(F.col("value"), F.lit(lt)))
            texts = F.regexp_extract_all(value, F.lit(_record_pattern(opts)), 1)
            end = F.aggregate(texts, F.lit(0), lambda n, r: n + F.length(r) + F.lit(len(lt)))
            unread = F.when(end < F.length(value), F.format_string("no record ends after character %d", end))
        else:
            sep_re = (f"(?<!{_q(esc)})" if esc else "") + _q(lt)
            texts, unread = F.split(F.col("value"), sep_re, -1), F.lit(None).cast("string")
        # what the pattern could not read is a failure of the file, not a shorter file
        rest = F.filter(F.array(F.struct(F.lit("").alias("text"), unread.alias("error"))),
                        lambda r: r["error"].isNotNull())
        records = F.concat(F.transform(texts, lambda t: F.struct(
            t.alias("text"), F.lit(None).cast("string").alias("error"))), rest)
        exploded = whole.select("_file", F.posexplode(records).alias("_line", "_r"), F.size(records).alias("_n"))
        exploded = exploded.select("_file", "_line", "_n", F.col("_r.text").alias("value"),
                                   F.col("_r.error").alias("_script_error"))
        last = (F.col("_line") == F.col("_n") - 1) & (F.col("value") == "") & F.col("_script_error").isNull()
        lines = exploded.where(~last).select(
            "value", _plain_line(F.col("value"), esc).alias("_plain"), "_file", "_script_error",
            F.lit(0).cast("bigint").alias("_block"),
            F.col("_line").cast("bigint").alias("_mid"), F.col("_line").cast("bigint").alias("_line"))
    else:
        own = streamed_files(spark, paths) if streamed is None else streamed
        packed = {} if own is None else {"pathGlobFilter": _NOT_GZ}
        raw = _no_lines(spark) if not paths else spark.read.options(**packed).text(
            paths, lineSep=lt, recursiveFileLookup=True).select(
            _protect(F.col("value"), esc).alias("value"), _plain_line(F.col("value"), esc).alias("_plain"),
            decode_file_path(F.col("_metadata.file_path")).alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_mid"))
        numbered = opts.ignore_lines > 0 and not opts.escaped_terminators
        lines = with_line_numbers(raw) if numbered else raw
        if own is not None:
            # the same form of URI as the text source gives, so that files sort alike
            uri = F.regexp_replace("_file", "^file:/+", "file:///")
            more = read_file_lines(own, lt).select(
                _protect(F.col("value"), esc).alias("value"), _plain_line(F.col("value"), esc).alias("_plain"),
                uri.alias("_file"), "_block", "_mid", "_script_error", F.col("_mid").alias("_line"))
            lines = lines.unionByName(more if numbered else more.drop("_line"), allowMissingColumns=True)
        if opts.escaped_terminators:
            lines = joined_records(lines, opts, in_order=True)
    failed = F.col("_script_error").isNotNull() if "_script_error" in lines.columns else F.lit(False)
    if opts.ignore_lines > 0:
        lines = lines.where((F.col("_line") >= opts.ignore_lines) | failed)
    if opts.lines_starting:
        at = F.instr(F.col("value"), opts.lines_starting)
        lines = lines.where((at > 0) | failed).withColumn(
            "value", F.substring(F.col("value"), at + len(opts.lines_starting), F.length("value")))
    return lines


def lines_from_stream(batch: DataFrame, opts: TextOptions) -> DataFrame:
    """``read_lines`` for a micro-batch of the streaming text source (with
    ``value`` and ``_metadata`` selected).  Skip-lines is not available."""
    lines = batch.select(
        _protect(F.col("value"), opts.fields_escaped).alias("value"),
        _plain_line(F.col("value"), opts.fields_escaped).alias("_plain"),
        decode_file_path(F.col("_path")).alias("_file"),
        F.col("_block"), F.monotonically_increasing_id().alias("_mid"))
    if opts.lines_starting:
        at = F.instr(F.col("value"), opts.lines_starting)
        lines = lines.where(at > 0).withColumn(
            "value", F.substring(F.col("value"), at + len(opts.lines_starting), F.length("value")))
    return lines


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """0-based line number within each file, without reading files whole:
    count lines per split, prefix-sum the counts per file in split order, and
    add the row's offset inside its split.  One small aggregate (a row per
    split) joined back."""
    from sluice.session import scratch_dir, track_staged
    spark = lines.sparkSession
    per_split = lines.groupBy("_file", "_block").agg(F.min("_mid").alias("_first"),
                                                     F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_split.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    # staged (one row per split): the planner sees its true size and
    # broadcasts it instead of shuffling every line for the join.  The lines
    # are scanned again for the join; ``_mid`` is deterministic for an
    # unchanged file split (same split → same partition and row order), so
    # both scans agree — as they did when both branches sat in one plan.
    path = scratch_dir(spark, "line-offsets")
    offsets.select("_file", "_block", "_first", "_before").write.parquet(path)
    track_staged(path)
    j = lines.join(spark.read.parquet(path), ["_file", "_block"])
    return j.withColumn("_line", F.col("_mid") - F.col("_first") + F.col("_before")).drop("_first", "_before")


# ---------------------------------------------------------------------------
# fields
# ---------------------------------------------------------------------------

def _record_pattern(opts: TextOptions) -> str:
    """One record of a whole (protected) file: fields up to the terminator.  A
    quote encloses only where it opens the field and a separator or terminator
    follows its partner; any other quote is a character of a bare field."""
    sep = _q(opts.fields_terminated)
    lt, q, esc = _q(opts.lines_terminated), _q(opts.fields_enclosed), opts.fields_escaped
    e = _q(esc) if esc else None
    pair = f"{e}.|" if e else ""
    not_esc = f"(?!{e})" if e else ""
    quoted = f"{q}(?:{pair}{q}{q}|(?!{q}){not_esc}.)*+{q}"
    cell = f"(?:{quoted}(?={sep}|{lt})|(?:{pair}(?!{lt})(?!{sep}){not_esc}.)*+)"
    return f"(?s)\\G({cell}(?:{sep}{cell})*+){lt}"


def _field_patterns(opts: TextOptions) -> str:
    sep, q, esc = _q(opts.fields_terminated), _q(opts.fields_enclosed), opts.fields_escaped
    e = _q(esc) if esc else None
    not_esc = f"(?!{e})" if e else ""
    pair = f"{e}.|" if e else ""
    quoted = f"{q}(?:{pair}{q}{q}|(?!{q}){not_esc}.)*+{q}"
    bare = f"(?:{pair}(?!{sep}){not_esc}.)*+"
    return f"(?s)\\G({quoted}|{bare}){sep}"


def split_fields(value: Column, opts: TextOptions) -> Column:
    """Raw field texts of a protected line (step 2)."""
    esc = opts.fields_escaped
    if not opts.fields_enclosed:
        sep_re = (f"(?<!{_q(esc)})" if esc else "") + _q(opts.fields_terminated)
        return F.split(value, sep_re, -1)
    line = F.concat(value, F.lit(opts.fields_terminated))
    return F.regexp_extract_all(line, F.lit(_field_patterns(opts)), 1)


def decode_field(f: Column, opts: TextOptions) -> Column:
    """Step 3 on one raw field."""
    esc, q = opts.fields_escaped, opts.fields_enclosed
    text = f
    is_quoted = F.lit(False)
    if q:
        is_quoted = (F.length(f) >= 2) & f.startswith(q) & f.endswith(q)
        inner = F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit(q + q), F.lit(q))
        text = F.when(is_quoted, inner).otherwise(f)
    if esc:
        # remaining pairs are escape + any character → that character; then
        # the line-level marks turn into their characters in one translate
        text = F.when(F.instr(text, esc) > 0, F.regexp_replace(text, F.lit("(?s)" + _q(esc) + "(.)"), F.lit("$1"))) \
            .otherwise(text)
        # (translate cannot produce NUL — it is Spark's "delete" marker)
        marks = {_LETTER_MARKS[k]: v for k, v in ESCAPE_LETTERS.items() if v != "\x00"}
        text = F.translate(text, _PLACEHOLDER + "".join(marks), esc + "".join(marks.values()))
        text = F.replace(text, F.lit(_LETTER_MARKS["0"]), F.lit("\x00"))
        own = text
        for mark, pair in _GUARDED.items():  # the guard itself comes last
            own = F.replace(own, F.lit(pair), F.lit(mark))
        text = F.when(F.instr(text, _GUARD) > 0, own).otherwise(text)
        is_null = ~is_quoted & (f == F.lit(esc + "N"))
        if q:
            is_null = is_null | (~is_quoted & (f == "NULL"))
        return F.when(is_null, F.lit(None).cast("string")).otherwise(text)
    if q:
        return F.when(~is_quoted & (f == "NULL"), F.lit(None).cast("string")).otherwise(text)
    return text


def _schema(schema) -> StructType:
    return schema if isinstance(schema, StructType) else _parse_datatype_string(schema)


def parse_lines(lines: DataFrame, schema, opts: TextOptions) -> DataFrame:
    """Typed rows: file fields map by position onto ``opts.columns`` (all
    target columns when empty); absent columns are NULL; values that do not
    convert leave the row with an ``_error`` (earliest column first)."""
    st = _schema(schema)
    names = list(opts.columns) or [f.name for f in st.fields if f.name != opts.file_id_column]
    types = {f.name: f.dataType for f in st.fields}
    for n in names:
        if n not in types:
            raise ValueError(f"column {n!r} is not in the target schema")
    meta = [c for c in ("_file", "_block", "_mid", "_line", "_script_error") if c in lines.columns]
    arr = split_fields(F.col("value"), opts)
    decoded = F.transform(arr, lambda x: decode_field(x, opts))
    if not opts.fields_enclosed and "_plain" in lines.columns:
        # lines without any escape keep their fields as split; only the rest
        # run the (compact, interpreted) decoding lambda
        decoded = F.when(F.col("_plain"), arr).otherwise(decoded)
    fields = lines.select(*meta, decoded.alias("_fields"))
    dec = fields.select(*meta, *[F.get(F.col("_fields"), i).alias(f"_s{i}") for i in range(len(names))])
    src = {n: f"_s{i}" for i, n in enumerate(names)}
    typed_cols = []
    for f in st.fields:
        if f.name == opts.file_id_column:
            continue
        if f.name in src:
            typed_cols.append(F.col(src[f.name]).try_cast(f.dataType).alias(f.name))
        else:
            typed_cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    typed = dec.select(*meta, *[F.col(c) for c in src.values()], *typed_cols)
    errors = [F.col("_script_error")] if "_script_error" in meta else []
    for f in st.fields:
        if f.name in src:
            raw = F.col(src[f.name])
            errors.append(F.when(raw.isNotNull() & F.col(f.name).isNull(), F.format_string(
                "Incorrect %s value: '%s' for column '%s'", F.lit(f.dataType.simpleString()), raw, F.lit(f.name))))
    err = F.coalesce(*errors) if errors else F.lit(None).cast("string")
    out_names = [f.name for f in st.fields if f.name != opts.file_id_column]
    keep_meta = [c for c in meta if c != "_script_error"]
    # the file itself could not be read (not: one of its values could not be parsed)
    fatal = [F.col("_script_error").isNotNull().alias("_fatal")] if "_script_error" in meta else []
    return typed.select(*out_names, *keep_meta, err.alias("_error"), *fatal)


def read_delimited(spark: SparkSession, paths: list[str] | str, schema, opts: TextOptions | None = None,
                   streamed: DataFrame | None = None) -> DataFrame:
    """Parse delimited files into typed rows (plus ``_file``,
    ``_block``, ``_mid``, ``_error``).  ``.gz`` (and other Hadoop codecs) are
    decoded by suffix (S15); a ``.gz`` that cannot be unpacked gives a row
    with ``_error``."""
    opts = opts or TextOptions()
    if isinstance(paths, str):
        paths = [paths]
    return parse_lines(read_lines(spark, paths, opts, streamed), schema, opts)


# ---------------------------------------------------------------------------
# writing (the inverse; used to produce fixtures and exports)
# ---------------------------------------------------------------------------

def encode_field(c: Column, opts: TextOptions, quote: bool) -> Column:
    """One value as file text: NULL → ``\\N``; escape, encloser and the first
    characters of both terminators escaped; newline / CR / NUL as letters."""
    esc, q = opts.fields_escaped, opts.fields_enclosed
    s = c.cast("string")
    if esc:
        s = F.replace(s, F.lit(esc), F.lit(esc + esc))
        for ch, letter in (("\x00", "0"), ("\n", "n"), ("\r", "r")):
            s = F.replace(s, F.lit(ch), F.lit(esc + letter))
        specials = {opts.fields_terminated[0], opts.lines_terminated[0]}
        if q:
            specials.add(q)
        for ch in sorted(specials - {"\n", "\r", "\x00", esc}):
            s = F.replace(s, F.lit(ch), F.lit(esc + ch))
        null = F.lit(esc + "N")
    else:
        null = F.lit("NULL")
    if q and quote:
        s = F.concat(F.lit(q), s, F.lit(q))
    return F.coalesce(s, null)


def format_lines(df: DataFrame, opts: TextOptions, columns: list[str] | None = None) -> Column:
    cols = columns or df.columns
    types = dict(df.dtypes)
    parts = [encode_field(F.col(c), opts, quote=types[c] == "string") for c in cols]
    line = F.concat_ws(opts.fields_terminated, *parts)
    return F.concat(F.lit(opts.lines_starting), line) if opts.lines_starting else line


def _stretches(lines: DataFrame, terminator: str) -> DataFrame:
    """Sorted lines joined, in the tasks that hold them, to stretches of many lines of one ``key``; their order is that
    of ``_part`` and ``_place``.  A file's task then sorts a few stretches, not the file's rows."""
    def run(batches):
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys, values = batch.column("key").to_pylist(), batch.column("value").to_pylist()
            starts = [i for i, k in enumerate(keys) if not i or k != keys[i - 1]]
            joined = [terminator.join(values[a:b]) for a, b in zip(starts, [*starts[1:], len(keys)], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(joined, pa.string()), batch.column("key").take(pa.array(starts, pa.int64())),
                 pa.array([part] * len(starts), pa.int32()), pa.array(range(place, place + len(starts)), pa.int64())],
                names=["value", "key", "_part", "_place"])
            place += len(starts)

    kind = lines.schema["key"].dataType.simpleString()
    return lines.select("value", "key").mapInArrow(run, f"value string, key {kind}, _part int, _place long")


def write_delimited(df: DataFrame, path: str, opts: TextOptions, columns: list[str] | None = None,
                    file_key: str | None = None, files: int | None = None,
                    header_lines: int = 0, compression: str | None = None,
                    order_by: list[str] | None = None, stable_names: bool = False) -> None:
    """Write ``df`` as delimited text.  With ``file_key`` one file per key
    value (``key=<v>/``); ``header_lines`` junk lines open every file (for
    skip-lines); ``order_by`` fixes the row order inside files."""
    cols = [c for c in (columns or df.columns) if c != file_key]
    if header_lines and not file_key:
        # every file needs its own header lines: spread rows over ``files``
        # hash-keyed files instead of funnelling them through one task
        df = df.withColumn("_hk", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(files or 1)))
        file_key = "_hk"
    body = df.select(format_lines(df, opts, cols).alias("value"),
                     *([F.col(file_key).alias("key")] if file_key else []),
                     F.lit(1).alias("_hdr"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by or [])])
    if header_lines:
        keys = body.select("key").distinct()
        hdr = keys.select("key", F.explode(F.sequence(F.lit(1), F.lit(header_lines))).alias("_n"))
        hdr = hdr.select(F.concat(F.lit("header line "), F.col("_n").cast("string")).alias("value"),
                         "key", F.lit(0).alias("_hdr"),
                         *[F.lit(None).alias(f"_o{i}") for i, _ in enumerate(order_by or [])])
        body = body.unionByName(hdr, allowMissingColumns=True)
    n = files or 1
    sort = (["key"] if file_key else []) + ["_hdr", "value"] + [f"_o{i}" for i, _ in enumerate(order_by or [])]
    if order_by:
        sort = (["key"] if file_key else []) + ["_hdr"] + [f"_o{i}" for i, _ in enumerate(order_by)]
    if order_by and file_key:
        body, sort = _stretches(body.repartitionByRange(*sort).sortWithinPartitions(*sort), opts.lines_terminated), [
            "key", "_part", "_place"]
    body = body.repartition(n, "key") if file_key else body.repartition(n)
    body = body.sortWithinPartitions(*sort)
    w = body.select("value", *(["key"] if file_key else [])).write.mode("overwrite").option("lineSep", opts.lines_terminated)
    w = w.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")  # data files only
    if compression:
        w = w.option("compression", compression)
    if file_key:
        w = w.partitionBy("key")
    w.text(path)
    if stable_names:
        name_part_files(df.sparkSession, path)


__all__ = ["TextOptions", "unescape_option", "split_columns", "read_lines", "with_line_numbers",
           "split_fields", "decode_field", "lines_from_stream", "parse_lines", "read_delimited", "encode_field",
           "format_lines", "write_delimited", "name_part_files", "replace_files"]


# ---------------------------------------------------------------------------
# stable file names (fixtures / exports that are rewritten in place)
# ---------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def name_part_files(spark: SparkSession, root: str, stem: str = "data") -> list[str]:
    """Rename the ``part-*`` files Spark wrote below ``root`` to
    ``<stem>[-i]<ext>`` per directory (``ext`` kept, e.g. ``.txt.gz``), so a
    rewritten file keeps its name — and its file id.  Metadata only."""
    jvm, _, fs = _fs(spark, root)
    statuses = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root + "/**/part-*")) or []
    statuses = list(statuses) + list(fs.globStatus(jvm.org.apache.hadoop.fs.Path(root + "/part-*")) or [])
    by_dir: dict[str, list] = {}
    for st in statuses:
        by_dir.setdefault(st.getPath().getParent().toString(), []).append(st.getPath())
    out = []
    for parent, files in by_dir.items():
        files.sort(key=lambda p: p.getName())
        for i, p in enumerate(files):
            name = p.getName()
            ext = name[name.index(".c000") + 5:] if ".c000" in name else ""
            target = jvm.org.apache.hadoop.fs.Path(parent, f"{stem}{'' if len(files) == 1 else '-' + str(i)}{ext}")
            fs.rename(p, target)
            out.append(target.toString())
    return out


def replace_files(spark: SparkSession, src_root: str, dst_root: str) -> None:
    """Move every file below ``src_root`` to the same relative place below
    ``dst_root``, replacing what is there (a producer rewriting files)."""
    jvm, src, fs = _fs(spark, src_root)
    it = fs.listFiles(src, True)
    base = fs.makeQualified(src).toString().rstrip("/")
    dst_base = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(dst_root)).toString().rstrip("/")
    while it.hasNext():
        p = it.next().getPath()
        rel = p.toString()[len(base):]
        if p.getName().startswith((".", "_")):
            continue
        target = jvm.org.apache.hadoop.fs.Path(dst_base + rel)
        if fs.exists(target):
            fs.delete(target, False)
        fs.mkdirs(target.getParent())
        fs.rename(p, target)


def cut_file(spark: SparkSession, path: str, keep: int) -> None:
    """Leave the first ``keep`` bytes of ``path`` (an upload that broke off)."""
    jvm, p, fs = _fs(spark, path)
    cut = jvm.org.apache.hadoop.fs.Path(path + ".cut")
    source, out = fs.open(p), fs.create(cut, True)
    out.write(source.readNBytes(keep))
    source.close()
    out.close()
    fs.delete(p, False)
    fs.rename(cut, p)


def truncate_file(spark: SparkSession, path: str) -> None:
    """Make ``path`` an empty file (a producer emptying a file)."""
    jvm, p, fs = _fs(spark, path)
    fs.create(p, True).close()
