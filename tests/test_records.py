"""Records that span lines, read over many splits, against a parser that reads each file from its first character."""

import os
import random

import pytest
from pyspark.sql import functions as F

from sluice.session import local_path
from sluice.sources.delimited import TextOptions, _protect, joined_records, parse_lines, read_delimited, read_lines
from sluice.sources.script import transform_files


def _records(text: str, o: TextOptions) -> tuple[list[str], bool]:
    """(record texts, whether the file ends within a record)."""
    sep, lt, q, esc = o.fields_terminated, o.lines_terminated, o.fields_enclosed, o.fields_escaped
    if text and not text.endswith(lt):
        text += lt
    records, start, at = [], 0, 0
    while at < len(text):
        end = None
        if q and text[at] == q:
            i = at + 1
            while i < len(text):
                if esc and text[i] == esc:
                    i += 2
                elif text[i:i + 2] == q + q:
                    i += 2
                elif text[i] == q:
                    break
                else:
                    i += 1
            if i < len(text) and (text.startswith(sep, i + 1) or text.startswith(lt, i + 1)):
                end = i + 1
        if end is None:
            end = at
            while end < len(text) and not text.startswith(lt, end) and not text.startswith(sep, end):
                end += 2 if esc and text[end] == esc else 1
        if text.startswith(sep, end):
            at = end + len(sep)
            # a separator that ends the file ends no record
            if at >= len(text):
                return records, True
        elif text.startswith(lt, end):
            records.append(text[start:end])
            start = at = end + len(lt)
        else:
            return records, True
    return records, start < len(text)


@pytest.mark.parametrize("options", [
    TextOptions(fields_terminated=",", fields_enclosed='"'),
    TextOptions(fields_terminated=",", fields_enclosed='"', fields_escaped=""),
    TextOptions(fields_terminated="||", fields_enclosed="'", lines_terminated="\r\n"),
    TextOptions(fields_terminated=",")])
def test_records_over_splits(spark, options):
    options = options.with_(escaped_terminators=True)
    rng = random.Random(7)
    pieces = [options.fields_terminated, options.lines_terminated, options.lines_terminated, "a"]
    pieces += 2 * [options.fields_enclosed] * bool(options.fields_enclosed) + ["\\"]
    texts = {f"f{i}": "".join(rng.choices(pieces, k=rng.randint(1, 24))) for i in range(1500)}
    rows = []
    for name, text in texts.items():
        cut, block = text.split(options.lines_terminated), 0
        for mid, line in enumerate(cut[:-1] if not cut[-1] else cut):
            block += rng.choice((0, 0, 5))  # splits of one or more lines
            rows.append((line, name, block, mid))
    raw = spark.createDataFrame(rows, "value STRING, _file STRING, _block BIGINT, _mid BIGINT").repartition(4)
    lines = joined_records(raw.withColumn("value", _protect(F.col("value"), options.fields_escaped)), options)
    got = {name: ([], []) for name in texts}
    error = F.col("_script_error").isNotNull()
    for r in lines.orderBy("_file", "_block", "_mid").select("_file", "value", error.alias("e"), "_line").collect():
        values, places = got[r._file]
        if r.e:
            places.append(None)
        else:
            values.append(r.value.replace(chr(0xFDD0), "\\\\"))
            places.append(r._line)
    spanning = 0
    for name, text in texts.items():
        want, open_end = _records(text, options)
        values, places = got[name]
        if options.fields_enclosed:
            assert (None in places) == open_end, repr(text)
        if not open_end:
            assert values == want, repr(text)
            assert places == list(range(len(want))), repr(text)
            spanning += any(options.lines_terminated in r for r in want)
    assert spanning >= 100


def test_one_file_is_read_by_many_tasks(spark, scratch):
    """Cells of many lines, longer than a split some of them, in one file of many splits."""
    options = TextOptions(fields_terminated=",", fields_enclosed='"', escaped_terminators=True)
    root = local_path(scratch("large"))
    os.makedirs(root)
    cells = {i: "\n".join(f'line {j}, "{i}"' for j in range(900 if i % 100 == 7 else i % 4)) for i in range(400)}
    with open(os.path.join(root, "a.csv"), "w") as fh:
        fh.writelines('{},"{}"\n'.format(i, c.replace('"', '""')) for i, c in cells.items())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        lines = read_lines(spark, [root], options)
        assert lines.select("_block").distinct().count() > 3
        got = parse_lines(lines, "k INT, s STRING", options).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {r.k: r.s for r in got} == cells and len(got) == len(cells)


def test_skipped_records_gzip_and_scripts(spark, scratch):
    """Skip-lines counts records; a .gz that breaks fails alone; a script's output is joined too."""
    import gzip
    options = TextOptions(fields_terminated=",", fields_enclosed='"', escaped_terminators=True, ignore_lines=1)
    root = local_path(scratch("multi"))
    os.makedirs(root)
    text = 'k,"head\ner"\n1,"x\ny"\n2,z\n'
    packed = gzip.compress(text.encode())
    for name, content in (("a.csv", text.encode()), ("b.csv.gz", packed), ("c.csv.gz", packed[:-9])):
        with open(os.path.join(root, name), "wb") as fh:
            fh.write(content)
    rows = read_delimited(spark, root, "k INT, s STRING", options).collect()
    by = {n: sorted((r.k, r.s) for r in rows if r._file.endswith(n) and not r._error) for n in ("a.csv", "b.csv.gz")}
    assert by == {"a.csv": [(1, "x\ny"), (2, "z")], "b.csv.gz": [(1, "x\ny"), (2, "z")]}
    assert any(r._error and r._file.endswith("c.csv.gz") for r in rows)
    lines = transform_files(spark, [os.path.join(root, "a.csv")], "tr a-z A-Z", options)
    assert sorted((r.k, r.s) for r in parse_lines(lines, "k INT, s STRING", options).collect()) == [(1, "X\nY"), (2, "Z")]


def test_texts_are_shuffled_by_split_not_by_file(spark, scratch):
    options = TextOptions(fields_terminated=",", fields_enclosed='"', escaped_terminators=True)
    root = local_path(scratch("plan"))
    os.makedirs(root)
    with open(os.path.join(root, "a.csv"), "w") as fh:
        fh.write('1,"a\nb"\n')
    plan = read_lines(spark, [root], options)._jdf.queryExecution().executedPlan().toString()
    keys = {line.split("hashpartitioning(")[1].split(")")[0] for line in plan.splitlines() if "hashpartitioning(" in line}
    assert keys and all("_block" in k or "_start" in k for k in keys)


def test_lines_in_order_are_joined_without_a_shuffle(spark, scratch):
    """Only the pieces of records that cross a split's end are shuffled."""
    options = TextOptions(fields_terminated=",", fields_enclosed='"', escaped_terminators=True)
    root = local_path(scratch("in-order"))
    os.makedirs(root)
    with open(os.path.join(root, "a.csv"), "w") as fh:
        fh.write('1,"a\nb"\n2,"c"\n')
    lines = read_lines(spark, [root], options)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("hashpartitioning(")[1].split(")")[0] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert keys and all("_start" in k for k in keys)
    assert sorted(r.value for r in lines.collect()) == ['1,"a\nb"', '2,"c"']
