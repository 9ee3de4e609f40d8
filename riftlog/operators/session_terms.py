"""Words of sessions as a long table, and sparse rows assembled from it.

A session may hold most of a log: every request without a name falls into one. Its text
would be one huge value, but what learns from it needs only its words and their numbers.
So words are counted per session straight from the events, weighed by a vocabulary that is
a table too, and put together to one sparse row per session, which holds each of its
different words once. The text of a session is built only where it is exported."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riftlog.functions.tokens import words
from riftlog.operators.features import TfIdf, smooth_idf
from riftlog.operators.lookups import is_small, lookup_join
from riftlog.operators.positions import with_positions
from riftlog.session import scratch_path, settle

_FEATURES = "struct<indices:array<int>,values:array<double>>"


@dataclass(frozen=True)
class SessionTerms:
    """``sessions``: session_id, row_no (their order, from 0) and n_events; ``terms``:
    row_no, term and tf, how often the word occurs in the session."""

    sessions: DataFrame
    terms: DataFrame

    def vocabulary(self) -> DataFrame:
        """``term, corpus_count, doc_count``."""
        return self.terms.groupBy("term").agg(F.sum("tf").alias("corpus_count"), F.count(F.lit(1)).alias("doc_count"))

    def fit(self, limit: int) -> TfIdf:
        """TF-IDF of the ``limit`` most frequent words, ties by word; only those reach
        the driver."""
        n = self.sessions.count()
        top = self.vocabulary().orderBy(F.desc("corpus_count"), "term").limit(limit)
        rows = sorted(top.select("term", smooth_idf(F.col("doc_count"), F.lit(n)).alias("idf")).collect())
        return TfIdf(tuple(r["term"] for r in rows), tuple(r["idf"] for r in rows))

    def fit_all(self) -> TermTable:
        """TF-IDF of all words, however many."""
        n = self.sessions.count()
        counted = settle(self.vocabulary(), "vocabulary")
        # Sorted over all tasks; a row's place among all comes from the sizes of the blocks.
        ordered = settle(counted.sort("term").withColumn("_id", F.monotonically_increasing_id()), "vocabulary")
        idf = smooth_idf(F.col("doc_count"), F.lit(n)).alias("idf")
        return TermTable.of(with_positions(ordered, "_id", name="idx").select(F.col("idx").cast("int").alias("idx"), "term", idf))

    def features(self, model: TfIdf | TermTable) -> DataFrame:
        """``row_no, features`` of all sessions, also those without a known word."""
        vocab = model.table(self.terms.sparkSession)
        return _assembled(self.terms, vocab, self.sessions.select("row_no"), "row_no")

    def weights(self, model: TfIdf | TermTable) -> DataFrame:
        """``session_id, term, weight``: the same in long form."""
        rows = self.features(model).select("row_no", F.explode(F.arrays_zip("features.indices", "features.values")).alias("p"))
        rows = rows.select("row_no", F.col("p.indices").alias("idx"), F.col("p.values").alias("weight"))
        named = lookup_join(rows, model.table(self.terms.sparkSession).select("idx", "term"), ["idx"], "inner", ["row_no"])
        return named.join(self.sessions.select("row_no", "session_id"), "row_no").select("session_id", "term", "weight")


def _assembled(terms: DataFrame, vocab: DataFrame, rows: DataFrame, row: str) -> DataFrame:
    """One sparse unit row per row of ``rows`` from (row, term, tf)."""
    weighted = lookup_join(terms, vocab, ["term"], "inner", [row]).select(
        row, F.struct("idx", (F.col("tf") * F.col("idf")).alias("w")).alias("p")
    )
    packed = weighted.groupBy(row).agg(F.array_sort(F.collect_list("p")).alias("p"))
    length = F.sqrt(F.aggregate("p.w", F.lit(0.0), lambda total, w: total + w * w))
    features = F.struct(F.col("p.idx").alias("indices"), F.transform("p.w", lambda w: w / length).alias("values"))
    none = F.struct(F.array().cast("array<int>").alias("indices"), F.array().cast("array<double>").alias("values"))
    found = rows.join(packed, row, "left")
    return found.select(*rows.columns, F.coalesce(F.when(F.col("p").isNotNull(), features), none).cast(_FEATURES).alias("features"))


@dataclass(frozen=True)
class TermTable:
    """A fitted TF-IDF of any number of words: ``vocab`` has idx, term and idf."""

    vocab: DataFrame
    dim: int

    @classmethod
    def of(cls, vocab: DataFrame) -> TermTable:
        vocab = settle(vocab, "terms")
        return cls(vocab, vocab.count())

    def table(self, spark: SparkSession) -> DataFrame:
        return self.vocab

    @classmethod
    def from_table(cls, table: DataFrame) -> TfIdf | TermTable:
        """A vocabulary that is proven small is held by the driver and applied row by row;
        both forms give the same features."""
        table = table.select("idx", "term", "idf")
        return TfIdf.from_table(table) if is_small(table) else cls.of(table)

    def features(self, df: DataFrame, text: str = "sequence", to: str = "features") -> DataFrame:
        """Add the unit TF-IDF row of ``text``, a text or an array of words."""
        is_text = df.schema[text].dataType.typeName() == "string"
        tokens = words(F.col(text)) if is_text else F.col(text)
        # Written first: the number of a row must be the same wherever it is read.
        rows = settle(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
        terms = rows.select("_row", F.explode(tokens).alias("term")).groupBy("_row", "term").agg(F.count(F.lit(1)).alias("tf"))
        found = _assembled(terms, self.vocab, rows.select("_row"), "_row").withColumnRenamed("features", to)
        return rows.join(found, "_row").select(*df.columns, to)


def session_terms(rows: DataFrame, key: str = "request_id", text: str = "template") -> SessionTerms:
    """Count the words of each session from its events. Rows without a session or a text
    are skipped, and so is a session whose text would be empty.

    Equal texts of a session are combined on the map side before they are cut into words,
    then equal words; no task ever holds a session. The words of a session are spread over
    all tasks by word."""
    kept = rows.select(F.col(key).alias("session_id"), F.col(text).alias("_text")).dropna()
    texts = settle(kept.groupBy("session_id", "_text").agg(F.count(F.lit(1)).alias("_n")), "session-texts")
    sessions = texts.groupBy("session_id").agg(F.sum("_n").alias("n_events"), F.max("_text").alias("_last"))
    sessions = sessions.filter((F.col("n_events") > 1) | (F.col("_last") != "")).drop("_last")
    pairs = texts.select("session_id", "_n", F.explode(words(F.col("_text"))).alias("term"))
    return _numbered(sessions, pairs.groupBy("session_id", "term").agg(F.sum("_n").alias("tf")))


def sequence_terms(sequences: DataFrame) -> SessionTerms:
    """The same from sequences that exist as text (``session_id, piece, n_events, sequence``);
    a piece is a row of its own."""
    kept = sequences.filter(F.col("sequence").isNotNull() & (F.col("sequence") != ""))
    kept = kept.withColumn("session_id", F.struct("session_id", "piece"))
    pairs = kept.select("session_id", F.explode(words(F.col("sequence"))).alias("term"))
    return _numbered(kept.select("session_id", "n_events"), pairs.groupBy("session_id", "term").agg(F.count(F.lit(1)).alias("tf")))


def _numbered(sessions: DataFrame, pairs: DataFrame) -> SessionTerms:
    ordered = settle(sessions.sort("session_id").withColumn("_id", F.monotonically_increasing_id()), "sessions")
    sessions = settle(with_positions(ordered, "_id", name="row_no").select("session_id", "row_no", "n_events"), "sessions")
    # A long session has many words: they are spread over the tasks of the join.
    terms = lookup_join(pairs, sessions.select("session_id", "row_no"), ["session_id"], "inner", ["term"])
    return SessionTerms(sessions, settle(terms.select("row_no", "term", "tf"), "session-terms"))


def with_vectors(rows: DataFrame, dim: int, features: str = "features", to: str = "vector") -> DataFrame:
    """``rows`` with the sparse ML vector of its features, without leaving the JVM: a
    written vector is the struct of its parts."""
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(dim).alias("size"),
        F.col(f"{features}.indices").alias("indices"), F.col(f"{features}.values").alias("values"),
    )
    path = scratch_path(rows.sparkSession, "vectors")
    rows.withColumn(to, parts).write.parquet(path)
    schema = T.StructType([*rows.schema, T.StructField(to, VectorUDT())])
    return rows.sparkSession.read.schema(schema).parquet(path)

