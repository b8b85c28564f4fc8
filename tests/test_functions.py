"""Scalar functions against direct Python formulations of the same rules."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sluice.functions.fileid import file_id, file_id_py
from sluice.functions.text import human_size, progress_bar, tasks_fraction, time_left_text
from sluice.sources.delimited import split_columns, unescape_option
from sluice.sources.paths import PathError, glob_to_regex, resolve_path


# Golden values (rules: 1,024 steps with one decimal and a thousands separator;
# halves to even in the number, Python-2 rounding in the plural; a 21-cell bar
# after a 26-character number block).
SIZES = [(0, "0.0 B"), (1, "1.0 B"), (512, "512.0 B"), (1023, "1,023.0 B"), (1024, "1.0 KB"),
         (1536, "1.5 KB"), (10 ** 6, "976.6 KB"), (123456789, "117.7 MB"), (2 ** 40, "1.0 TB"),
         (3 * 2 ** 50, "3.0 PB"), (7.25e18, "6,439.3 PB"), (0.05, "0.1 B"), (1048575.9, "1,024.0 KB")]
TIMES = [(-1, "estimating..."), (0, " 0 secs left"), (0.4, " 0 secs left"), (0.5, " 0 sec left"),
         (1, " 1 sec left"), (1.5, " 2 secs left"), (2.5, " 2 secs left"), (59.4, "59 secs left"),
         (59.6, "60 secs left"), (60, " 1 min left"), (89, " 1 min left"), (90, " 2 mins left"),
         (150, " 2 mins left"), (3599, "60 mins left"), (3600, " 1 hour left"), (5400, " 2 hours left"),
         (86399, "24 hours left"), (86400, " 1 day left"), (10 ** 6, "12 days left"), (1e9, "11574 days left")]
BARS = [((0, 0), "0%   [                     ]      0.0 B/0.0 B     "),
        ((0, 100), "0%   [                     ]      0.0 B/100.0 B   "),
        ((1, 100), "1%   [>                    ]      1.0 B/100.0 B   "),
        ((50, 100), "50%  [==========>          ]     50.0 B/100.0 B   "),
        ((99, 100), "99%  [====================>]     99.0 B/100.0 B   "),
        ((100, 100), "100% [=====================]    100.0 B/100.0 B   "),
        ((5 * 2 ** 30, 6 * 2 ** 30), "83%  [=================>   ]     5.0 GB/6.0 GB    ")]


def test_human_size(spark):
    df = spark.createDataFrame([(float(x),) for x, _ in SIZES], "x double")
    assert [r[0] for r in df.select(human_size("x")).collect()] == [e for _, e in SIZES]


def test_time_left_text(spark):
    df = spark.createDataFrame([(float(x),) for x, _ in TIMES], "x double")
    assert [r[0] for r in df.select(time_left_text("x")).collect()] == [e for _, e in TIMES]


def test_progress_bar(spark):
    df = spark.createDataFrame([p for p, _ in BARS], "c bigint, t bigint")
    got = [r[0] for r in df.select(progress_bar("c", "t")).collect()]
    assert got == [e for _, e in BARS]
    assert all(len(g) == 50 for g in got)


def test_tasks_fraction(spark):
    df = spark.createDataFrame([(3, 120)], "d bigint, t bigint")
    assert df.select(tasks_fraction("d", "t", 4)).first()[0] == "   3/120  finished"


@pytest.mark.parametrize("name", ["part/1.csv", "data/ünïcødé/文件.tsv", "", "a" * 5000])
def test_file_id_matches_python(spark, name):
    expected = int(hashlib.sha256(name.encode("utf-8")).hexdigest()[:16], 16)
    df = spark.createDataFrame([(name, "bkt")], "n string, b string")
    row = df.select(file_id("n").alias("a"), file_id("n", "b").alias("b")).first()
    assert int(row.a) == expected == int(file_id_py(name))
    assert int(row.b) == int(hashlib.sha256(("bkt" + name).encode("utf-8")).hexdigest()[:16], 16)


def test_glob_regex():
    import re
    cases = {"/d/*": (["/d/1", "/d/2"], ["/d/a/1"]), "/d/**": (["/d/1", "/d/a/1", "/d/a/b/c"], ["/e/1"]),
             "/d/**/x.gz": (["/d/x.gz", "/d/a/b/x.gz"], ["/d/ax.gz"]), "/d/?.txt": (["/d/a.txt"], ["/d/ab.txt"]),
             "/d/[ab]*": (["/d/a1", "/d/b"], ["/d/c"])}
    for pat, (yes, no) in cases.items():
        rx = re.compile("^" + glob_to_regex(pat) + "$")
        assert all(rx.match(p) for p in yes), pat
        assert not any(rx.match(p) for p in no), pat


def test_resolve_path_rules():
    assert resolve_path("s3://bkt/a/*.gz").bucket == "bkt"
    assert resolve_path("s3://bkt/a/*.gz").pattern == "a/*.gz"
    assert resolve_path("hdfs://nn:8020/x/**").pattern == "/x/**"
    assert resolve_path("/abs/*").scheme == "file"
    for bad in ["ftp://x/y", "/a|b", "s3://b*kt/x", "s3://bkt"]:
        with pytest.raises(PathError):
            resolve_path(bad)


def test_option_text():
    assert unescape_option("\\t") == "\t"
    assert unescape_option("\\u0001") == "\x01"
    assert unescape_option("\\") == "\\"
    assert split_columns(" a, b ,c") == ("a", "b", "c")
