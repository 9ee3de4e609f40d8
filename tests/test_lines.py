"""Reading, numbering and parsing of log lines."""

import random
import re

import pytest
from pyspark.sql import functions as F, types as T

from riftlog.config import LINE_FIELDS, LINE_PATTERN
from riftlog.functions.parsing import impute_request, parse_lines, rejected_lines, with_event_time
from riftlog.operators.lookups import MAX_ROWS
from riftlog.sources import tables, text_logs

HEAD = "nova.log 2017-05-16 00:00:00.008 25746 INFO nova.wsgi "
EDGES = [
    HEAD + "[req-1 u t - - -] GET /v2 status: 200",
    HEAD + "[-] hello",
    HEAD + "no bracket anywhere",
    HEAD + "text before [late] tail",
    HEAD + "[unclosed message",
    HEAD + "[] empty",
    HEAD + "[req-2]",
    HEAD + "[req-3] a   b \u0085 c",
    HEAD + "[req-4] marker \u0001 inside \u0001\u0001",
    "a\u0001b 2017-05-16 00:00:00.008 1 INFO c\u0001d [r\u0001] m\u0001",
    "\u0001" * 6,
    "nova.log 2017-05-16 00:00:00 25746 INFO c [-] no fraction",
    " nova.log 2017-05-16 00:00:00.1 25746 INFO c [-] leading blank",
    "nova.log 2017-05-16 00:00:00.1 25746 info c [-] lower",
    "",
]


def expected(line):
    found = re.match(LINE_PATTERN, line)
    return None if found is None else tuple(g or None for g in found.groups())


def test_parse_agrees_with_plain_regex(spark):
    rng = random.Random(1)
    parts = ["[", "]", "-", " ", "req-1", "INFO", "x\u0001y", "2017-05-16 00:00:00.5", "7", "\t", "é"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(300)]
    made += [HEAD + m for m in made]
    lines = EDGES + made
    df = spark.createDataFrame(list(enumerate(lines)), "line_no bigint, value string")
    got = {r["line_no"]: r for r in parse_lines(df).collect()}
    for i, line in enumerate(lines):
        want = expected(line)
        assert (i in got) == (want is not None), line
        if want:
            row = [got[i][f] for f in LINE_FIELDS]
            assert row[:2] + row[3:] == [*want[:2], *want[3:]], line
            assert row[2] == int(want[2])
    rejects = {r["line_no"] for r in rejected_lines(df).collect()}
    assert rejects == set(range(len(lines))) - set(got)


def test_pid_beyond_bigint_is_missing(spark):
    line = HEAD.replace("25746", "9" * 30) + "[-] m"
    row = parse_lines(spark.createDataFrame([(line,)], "value string")).first()
    assert row["pid"] is None and row["message"] == "m"


def test_fields_are_computed_once(spark):
    df = spark.range(5).select(F.concat(F.lit(HEAD), F.col("id").cast("string")).alias("value"), "id")
    plan = parse_lines(df).dropna(subset=["message", "request_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_impute_and_views(spark):
    df = spark.createDataFrame([(0, HEAD + "[-] a"), (1, HEAD + "[instance: x] b"), (2, HEAD + "only")], "line_no int, value string")
    parsed = parse_lines(df)
    assert [r[0] for r in impute_request(parsed).orderBy("line_no").select("request_id").collect()] == ["rca-system", "instance: x", None]
    view = with_event_time(parsed).orderBy("line_no").collect()
    assert [r["request_id_valid"] for r in view] == [True, False, None]
    assert view[0]["component"] == "nova.wsgi " and view[0]["component_trimmed"] == "nova.wsgi"
    assert str(view[0]["event_ts"]) == "2017-05-16 00:00:00.008000"


@pytest.mark.parametrize("split", ["134217728", "200"])
def test_numbering_over_files_and_splits(spark, tmp_path, split):
    files = {f"f{i}.log": [f"{i}-{j}" if j % 7 else "   " for j in range(n)] for i, n in enumerate((0, 5, 300, 41))}
    for name, rows in files.items():
        (tmp_path / name).write_text("".join(r + "\n" for r in rows))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = sorted((r["file"].rsplit("/", 1)[1], r["line_no"], r["value"]) for r in text_logs.read_log(spark, str(tmp_path)).collect())
        whole = sorted((r["line_no"], r["value"]) for r in text_logs.read_log(spark, str(tmp_path), one_log=True).collect())
        upload = sorted((r["file"].rsplit("/", 1)[1], r["line_no"], r["value"]) for r in text_logs.read_upload(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(n, i, v) for n, rows in sorted(files.items()) for i, v in enumerate(rows)]
    assert whole == list(enumerate(v for _, rows in sorted(files.items()) for v in rows))
    assert upload == [(n, i, v) for n, rows in sorted(files.items()) for i, v in enumerate(r for r in rows if r.strip())]


def test_csv_keeps_blanks_quotes_and_line_breaks(spark, tmp_path):
    rows = [(" a ", 'say "x", y', None), ("", "two\nlines", "NA"), ("null", "back\\slash", "None")]
    schema = "source string, level string, message string"
    df = spark.createDataFrame(rows, schema)
    path = tables.write_csv(df, str(tmp_path / "t"))
    # An empty text comes back as missing; words such as NA stay words.
    rows[1] = (None, *rows[1][1:])
    assert sorted(map(tuple, tables.read_csv(spark, path, df.schema).collect()), key=str) == sorted(rows, key=str)


def test_rewrite_from_itself_and_guards(spark, tmp_path):
    first = tables.write_version(spark.range(5).toDF("x"), str(tmp_path / "t"))
    second = tables.write_version(spark.read.parquet(first).withColumn("x", F.col("x") + 1), str(tmp_path / "t"))
    assert sorted(r[0] for r in spark.read.parquet(second).collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(tables.MissingColumnError):
        tables.require_columns(spark.range(1), "message")
    with pytest.raises(tables.EmptyInputError):
        tables.require_rows(spark.range(0))


def test_single_file_at_any_size(spark, tmp_path):
    rows = 2 * MAX_ROWS
    path = tables.write_version(spark.range(rows).toDF("x"), str(tmp_path / "t"), "csv", single_file=True)
    back = tables.read_csv(spark, path, T.StructType([T.StructField("x", T.LongType())]), multiline=False)
    assert len(back.inputFiles()) == 1
    assert back.agg(F.count("x"), F.sum("x")).first() == (rows, rows * (rows - 1) // 2)
