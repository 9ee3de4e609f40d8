"""Words to numbers: vocabulary, TF-IDF, padded token ids, splits."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, Window, functions as F

from riftlog.config import MAX_FEATURES, TOKEN_LENGTH
from riftlog.functions.parsing import computed_once
from riftlog.functions.tokens import words
from riftlog.functions.vectors import sparse_struct
from riftlog.operators.lookups import lookup_join
from riftlog.operators.positions import with_positions
from riftlog.session import settle

# Size of the token vocabulary and its reserved ids.
TOKEN_VOCABULARY = 30_522
PAD_ID, UNKNOWN_ID, FIRST_ID = 0, 1, 2


def vocabulary(docs: DataFrame, text: str = "sequence") -> DataFrame:
    """``term, corpus_count, doc_count``. One tokenising pass: all words of a
    document are sent, and its distinct words once more with a mark; both are
    counted on the map side, so only one row per term and task is shuffled."""
    tokenised = computed_once(docs.select(text), _words=words(F.col(text))).select("_words")
    both = F.array(
        F.struct(F.lit(0).alias("first"), F.col("_words").alias("terms")),
        F.struct(F.lit(1).alias("first"), F.array_distinct("_words").alias("terms")),
    )
    return (
        tokenised.select(F.inline(both))
        .select("first", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum(1 - F.col("first")).alias("corpus_count"), F.sum("first").alias("doc_count"))
    )


def top_vocabulary(docs: DataFrame, text: str = "sequence", limit: int = MAX_FEATURES) -> DataFrame:
    """The terms with the highest corpus count, ties by term."""
    return vocabulary(docs, text).orderBy(F.desc("corpus_count"), "term").limit(limit)


def smooth_idf(doc_count: Column, n_docs: Column) -> Column:
    return F.ln((1 + n_docs) / (1 + doc_count)) + 1


@dataclass(frozen=True)
class TfIdf:
    """A fitted, capped TF-IDF: terms in alphabetical order and their weights."""

    terms: tuple[str, ...]
    idf: tuple[float, ...]

    @property
    def dim(self) -> int:
        return len(self.terms)

    def transform(self, df: DataFrame, text: str = "sequence", to: str = "vector") -> DataFrame:
        """Add the unit-length TF-IDF vector of ``text``, a text or an array of words;
        words outside the vocabulary are ignored. Works row by row in the JVM, nothing
        is shuffled."""
        counts = CountVectorizerModel.from_vocabulary(
            list(self.terms), inputCol="_words", outputCol="_counts"
        )
        weigh = ElementwiseProduct(
            scalingVec=DenseVector(np.array(self.idf)), inputCol="_counts", outputCol="_weighted"
        )
        unit = Normalizer(p=2.0, inputCol="_weighted", outputCol=to)
        is_text = df.schema[text].dataType.typeName() == "string"
        tokens = words(F.col(text)) if is_text else F.col(text)
        tokenised = df.withColumn("_words", F.coalesce(tokens, F.array().cast("array<string>")))
        out = unit.transform(weigh.transform(counts.transform(tokenised)))
        return out.drop("_words", "_counts", "_weighted")

    def features(self, df: DataFrame, text: str = "sequence", to: str = "features") -> DataFrame:
        """The same as a plain struct of indices and values."""
        out = self.transform(df, text, "_vector")
        return out.withColumn(to, sparse_struct(F.col("_vector"))).drop("_vector")

    def long_form(self, df: DataFrame, doc: str, text: str = "sequence") -> DataFrame:
        """``doc, term, weight``, one row per word of the vocabulary in a document."""
        pairs = self.features(df.select(doc, text), text).select(
            doc, F.explode(F.arrays_zip("features.indices", "features.values")).alias("p")
        )
        terms = F.array(*[F.lit(t) for t in self.terms])
        return pairs.select(
            doc,
            F.get(terms, F.col("p.indices")).alias("term"),
            F.col("p.values").alias("weight"),
        )

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(i, t, w) for i, (t, w) in enumerate(zip(self.terms, self.idf))],
            "idx int, term string, idf double",
        )

    @classmethod
    def from_table(cls, table: DataFrame) -> TfIdf:
        rows = table.orderBy("idx").collect()
        return cls(tuple(r["term"] for r in rows), tuple(r["idf"] for r in rows))


def fit_tfidf(docs: DataFrame, text: str = "sequence", limit: int = MAX_FEATURES) -> TfIdf:
    """Fit on the ``limit`` most frequent words; only those reach the driver."""
    n_docs = docs.count()
    rows = (
        top_vocabulary(docs, text, limit)
        .select("term", smooth_idf(F.col("doc_count"), F.lit(n_docs)).alias("idf"))
        .collect()
    )
    rows.sort(key=lambda r: r["term"])
    return TfIdf(tuple(r["term"] for r in rows), tuple(r["idf"] for r in rows))


def tfidf_full(docs: DataFrame, doc: str, text: str = "sequence") -> DataFrame:
    """TF-IDF over all words, however many: ``doc, term, weight``.

    Documents move once, by id, before they are cut into words; counting a word
    per document and the length of a document then need no further move. Word
    weights come from a checked lookup that spreads frequent words."""
    placed = docs.select(doc, text).repartition(doc)
    tf = (
        placed.select(doc, F.explode(words(F.col(text))).alias("term"))
        .groupBy(doc, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    idf = settle(
        vocabulary(docs, text).select("term", smooth_idf(F.col("doc_count"), n_docs).alias("idf")),
        "idf",
    )
    weighted = lookup_join(tf, idf, ["term"], "inner", [doc]).select(
        doc, "term", (F.col("tf") * F.col("idf")).alias("w")
    )
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc)))
    return weighted.select(doc, "term", (F.col("w") / norm).alias("weight"))


def token_vocabulary(docs: DataFrame, text: str = "text", size: int = TOKEN_VOCABULARY) -> DataFrame:
    """``term, token_id``: the most frequent words, numbered by rank behind the
    reserved ids. Its size is fixed by ``size``."""
    top = top_vocabulary(docs, text, size - FIRST_ID)
    rank = F.row_number().over(Window.orderBy(F.desc("corpus_count"), "term"))
    return top.select("term", (rank + (FIRST_ID - 1)).alias("token_id"))


def padded_token_ids(
    docs: DataFrame, vocab: DataFrame, doc: str, text: str = "text", length: int = TOKEN_LENGTH
) -> DataFrame:
    """``doc, input_ids, attention_mask``: token ids of the first ``length`` words,
    filled up with the pad id. The vocabulary is broadcast if it is proven small, else words
    are dealt out over copies of it."""
    cut = docs.select(doc, F.slice(words(F.col(text)), 1, length).alias("_w"))
    known = F.struct("_at", F.coalesce("token_id", F.lit(UNKNOWN_ID)).alias("id"))
    ids = (
        lookup_join(cut.select(doc, F.posexplode_outer("_w").alias("_at", "term")), settle(vocab, "token-ids"), ["term"], "left", [doc])
        .groupBy(doc)
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("_at").isNotNull(), known)))["id"].alias("_ids")
        )
    )
    pad = F.lit(length) - F.size("_ids")
    return ids.select(
        doc,
        F.concat("_ids", F.array_repeat(F.lit(PAD_ID), pad)).alias("input_ids"),
        F.concat(
            F.array_repeat(F.lit(1), F.size("_ids")), F.array_repeat(F.lit(0), pad)
        ).alias("attention_mask"),
    )


def split_bucket(id_column: Column, seed: int = 42) -> Column:
    """A bucket 0..99 that depends on the id and the seed alone, so a split is the
    same however the rows are partitioned. Multiplicative hashing mod 2^32."""
    mixed = F.pmod(id_column + seed, F.lit(1 << 31)) * F.lit(2654435761)
    return F.floor(F.pmod(mixed, F.lit(1 << 32)) * 100 / F.lit(1 << 32)).cast("int")


def split_train(df: DataFrame, id_column: str, percent: int = 80, seed: int = 42) -> DataFrame:
    """Add ``is_train``, true for about ``percent`` of the rows."""
    return df.withColumn("is_train", split_bucket(F.col(id_column), seed) < percent)


def split_tail(df: DataFrame, order: str, share: float = 0.1) -> DataFrame:
    """Add ``is_validation``, true for the last ``share`` of the rows by ``order``,
    an integer column of unique values."""
    n = df.agg(F.count(F.lit(1))).scalar()
    return (
        with_positions(df, order)
        .withColumn("is_validation", F.col("pos") >= F.floor(n * F.lit(1.0 - share)))
        .drop("pos")
    )
