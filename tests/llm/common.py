"""Small tables and brute-force helpers of these tests."""

import re

import duckdb

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def read(name, sf=SF):
    return duckdb.sql(f"SELECT * FROM '{sf}/{name}.parquet'").df()


def documents(spark, texts, first=0, source="s", lang="en"):
    rows = [(first + i, t, lang, source, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


ODD_TEXTS = [None, "", " \n\t ", "...", "a", "é", "word " * 3000, "x" * 20000, "\U0001F600   ok", "same same", "same same"]


def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    rows = [(i, t, "en", "s", 1, "k", "r", 7) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id here", None, None, None, None, None, None), (3, None, None, "s", None, None, None, None)]
    rows += [rows[0], rows[9]]
    return spark.createDataFrame(rows, SCHEMA + ", size string, row string, copies int")
