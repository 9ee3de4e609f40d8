"""The registered queries: each reads whole tables of one scale-factor folder."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riftlog.functions.parsing import (
    event_day, impute_request, parse_lines, rejected_lines, strip, with_event_time,
)
from riftlog.operators import (
    autoencoder, catalogue, features, iforest, kmeans, principal, profile, quality, quantiles, runs, scoring, search, sequences,
    session_terms, templates as tpl, training, windows,
)
from riftlog.operators.scoring import (
    EncoderModel, ForestModel, KMeansModel, score_encoder, score_forest, score_kmeans, scoring_windows, with_unit,
)
from riftlog.plans.batch import best_over_kinds as _best_over_kinds, store_report
from riftlog.session import scratch_path, settle
from riftlog.sources import messages, tables, text_logs
from riftlog.sources.event_lines import event_lines
from riftlog.sources.models import load_model, save_model
from riftlog.streaming import jobs as streaming_jobs, templates as streaming_templates


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return tables.read_spread(spark, f"{sf}/{name}.parquet")


def lines(spark, sf) -> DataFrame:
    return event_lines(spread(spark, sf, "events"))


def parsed(spark, sf) -> DataFrame:
    return parse_lines(lines(spark, sf))


def cleaned(spark, sf) -> DataFrame:
    return impute_request(parsed(spark, sf))


def stored(df: DataFrame) -> DataFrame:
    """A layer written once, for jobs that read it several times."""
    return settle(df, "layer")


def dec(column, digits: int = 6):
    """A double as a decimal of ``digits`` places, for comparison."""
    return F.round(column, digits).cast(T.DecimalType(18, digits))


# Sources and sinks


def raw_lines(spark, sf):
    path = scratch_path(spark, "raw")
    text_logs.write_log(lines(spark, sf), path, files=6)
    return text_logs.read_log(spark, path, one_log=True).select("line_no", "value")


def trim_nonblank_lines(spark, sf):
    docs = spread(spark, sf, "documents")
    text = F.split("text", "\n")
    kept = F.filter(F.transform(text, strip), lambda x: F.length(x) > 0)
    return docs.select("doc_id", F.posexplode(kept).alias("line_no", "line"))


_ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    structured = parsed(spark, sf).select(*tables.STRUCTURED.fieldNames())
    return tables.read_csv(spark, tables.write_csv(structured, path), tables.STRUCTURED, multiline=False)


def csv_headerless(spark, sf):
    path = scratch_path(spark, "csv")
    orders = table(spark, sf, "orders").select(*_ORDERS.fieldNames())
    tables.write_csv(orders, path, header=False)
    back = tables.read_csv(spark, path, _ORDERS, header=False, multiline=False)
    return back.withColumnsRenamed({"o_orderkey": "order_key", "o_totalprice": "price"})


def json_roundtrip(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value", "props")
    return tables.from_json(tables.as_json(events), events.schema)


def single_file_export(spark, sf):
    path = scratch_path(spark, "export")
    first = tables.write_version(tables.by_source(parsed(spark, sf)), path)
    old = spark.read.parquet(first)
    second = tables.write_version(
        profile.value_counts(impute_request(old), "request_id"), path, "csv", single_file=True
    )
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("n", T.LongType())])
    back = tables.read_csv(spark, second, schema, multiline=False)
    return back.withColumn("files", F.lit(len(back.inputFiles())))


def model_update_record(spark, sf):
    events = table(spark, sf, "events")
    extra = F.create_map(
        F.lit("user"), F.col("user_id").cast("string"), F.lit("kind"), F.col("event_type")
    )
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return events.select("event_id", messages.update_body(stamp, extra).alias("body"))


def _message_table(spark, sf):
    events = table(spark, sf, "events")
    kind = F.when(F.col("event_type") == "error", F.lit("retrain_model")).otherwise(
        F.lit("model_updated")
    )
    return events.select("event_id", F.to_json(F.struct(kind.alias("message"), "user_id")).alias("body"))


def retrain_requests(spark, sf):
    return messages.retrain_requests(_message_table(spark, sf))


def appended_updates(spark, sf):
    path = scratch_path(spark, "updates")
    sizes = table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n").alias("n"), F.count("*").alias("k")).first()
    for label in ("n", "k"):
        messages.append_update(
            spark, path, {label: str(total[label])}, "2024-01-01 00:00:00.000000"
        )
    return spark.read.text(path).select(F.col("value").alias("body"))


def profile_report(spark, sf):
    return profile.profile_report(parsed(spark, sf).drop("line_no"))


# Parsing and projections


def parse_log(spark, sf):
    return parsed(spark, sf)


def parse_rejects(spark, sf):
    return rejected_lines(lines(spark, sf))


def event_times(spark, sf):
    return with_event_time(parsed(spark, sf)).select(
        "line_no", "event_ts", "component_trimmed", "request_id_valid"
    )


def impute_request_id(spark, sf):
    return cleaned(spark, sf).select("line_no", "request_id")


def drop_missing_message(spark, sf):
    return parsed(spark, sf).dropna(subset=["message"]).select("line_no", "message")


def numeric_columns(spark, sf):
    return profile.select_numeric(parsed(spark, sf))


def sequence_text(spark, sf):
    """The texts a model trains on, in the order of their session."""
    turns = table(spark, sf, "conversations")
    return training.numbered_sequences(sequences.session_sequences(turns, "conv_id", "turn", "text"))


def log_scalars(spark, sf):
    p = cleaned(spark, sf)
    names = F.create_map(
        F.lit("ERROR"), F.lit("high"), F.lit("WARNING"), F.lit("medium"), F.lit("INFO"), F.lit("low")
    )
    return p.select(
        "line_no",
        F.concat_ws(", ", "source", "level").alias("joined"),
        F.format_string("LG_KEY_%d", "pid").alias("formatted"),
        F.date_format(F.expr("try_cast(timestamp as timestamp_ntz)"), "yyyyMMdd_HHmmss").alias("stamp"),
        F.element_at(names, F.col("level")).alias("severity"),
        F.contains("message", F.lit("instance")).alias("has_instance"),
        F.array_join(windows.context_slice(F.split("message", " "), 2, 2), " ").alias("part"),
    )


def preview_lines(spark, sf):
    return parsed(spark, sf).select("line_no", "message").orderBy("line_no").limit(10)


# Profile and quality


def request_id_top50(spark, sf):
    return profile.top_values(parsed(spark, sf), "request_id")


def request_id_top50_map(spark, sf):
    top = profile.top_values_map(parsed(spark, sf), "request_id")
    return top.select(F.explode("top").alias("value", "n"))


def request_id_profile(spark, sf):
    return profile.id_profile(parsed(spark, sf))


def column_summary(spark, sf):
    return profile.column_summary(parsed(spark, sf))


def _bins(df):
    return df.select("column", "bin", dec(F.col("low"), 4).alias("low"), dec(F.col("high"), 4).alias("high"), "n")


def histogram_lineitem(spark, sf):
    return _bins(profile.histogram(table(spark, sf, "lineitem")))


def histogram_pid(spark, sf):
    return _bins(profile.histogram(parsed(spark, sf).select("pid", "level")))


def mean_impute(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("event_id"),
        F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "click", F.col("user_id")).alias("user_id"),
    )
    out = quality.mean_impute(events, ["value", "user_id"])
    return out.select("event_id", dec(F.col("value")).alias("value"), dec(F.col("user_id")).alias("user_id"))


def _suite():
    return [
        *quality.schema_suite(
            {"timestamp": "timestamp_ntz", "pid": "bigint", "request_id": "bigint", "status": "int"}
        ),
        quality.Expectation("message", "exists"),
        quality.Expectation("pid", "type", "string"),
    ]


def validation_report(spark, sf):
    return quality.validate(parsed(spark, sf), _suite())


def stored_validation_report(spark, sf):
    return store_report(quality.validate(parsed(spark, sf), _suite()), scratch_path(spark, "reports"))


def validated_log(spark, sf):
    """Gate, then impute: rows come out only when the suite holds."""
    p = parsed(spark, sf)
    suite = quality.schema_suite({"timestamp": "timestamp_ntz", "pid": "bigint", "nowhere": "int"})
    quality.gate(quality.validate(p, suite))
    return quality.mean_impute(p.select("line_no", "pid"), ["pid"])


# Templates


def mask_shapes(spark, sf):
    return tpl.distinct_shapes(tpl.with_shape(parsed(spark, sf))).drop("first_token")


def mask_document_shapes(spark, sf):
    docs = spread(spark, sf, "documents").select(F.col("doc_id").alias("line_no"), F.col("text").alias("message"))
    shapes = tpl.distinct_shapes(tpl.with_shape(docs))
    return shapes.select(F.md5("shape").alias("shape_md5"), "n_rows", "first_line_no", "n_tokens", "first_token")


def template_keys(spark, sf):
    return tpl.shape_templates(tpl.with_shape(parsed(spark, sf)))


def _document_lines(spark, sf):
    """The lines of all documents as messages."""
    return trim_nonblank_lines(spark, sf).select(
        (F.col("doc_id") * 100_000 + F.col("line_no")).alias("line_no"), F.col("line").alias("message")
    )


def _brief(mined):
    return mined.select("log_key", F.md5("template").alias("template_md5"), "n_rows", "first_line_no", "n_tokens")


def mine_leaf_templates(spark, sf):
    """Similarity 0: one template per leaf, the tokens all its shapes agree on."""
    return _brief(tpl.mine_templates(_document_lines(spark, sf), similarity=0.0))


def mine_templates_in_pieces(spark, sf):
    """The usual similarity, a few shapes at a time: large leaves stream by in many
    chunks and give the templates they give at once."""
    return _brief(tpl.mine_templates(_document_lines(spark, sf), chunk=5))


def mine_templates(spark, sf):
    return tpl.mine_templates(parsed(spark, sf))


def mine_document_templates(spark, sf):
    return _brief(tpl.mine_templates(_document_lines(spark, sf)))


#: Two tokens deep, with so few branches that most of a node's tokens share one.
SMALL_TREE = tpl.Tree(depth=2, children=4)


def mine_templates_strict(spark, sf):
    """A leaf is a number of tokens."""
    return _brief(tpl.mine_templates(_document_lines(spark, sf), tree=tpl.Tree(depth=0)))


def mine_templates_tree(spark, sf):
    return _brief(tpl.mine_templates(_document_lines(spark, sf), tree=SMALL_TREE))


def tag_by_tree(spark, sf):
    """Templates of every other line of the documents; all lines tagged by their tree."""
    rows = stored(_document_lines(spark, sf))
    known = tpl.mine_templates(rows.filter("line_no % 2 = 0"), tree=SMALL_TREE)
    return tpl.tag_rows(rows, known, tree=SMALL_TREE).select("line_no", "log_key")


def template_versions(spark, sf):
    return tpl.mine_versions(tpl.distinct_shapes(tpl.with_shape(parsed(spark, sf))))


def _two_logs(spark, sf):
    """The event log, and behind it a second log that other templates wrote: the turns
    of all conversations."""
    log = parsed(spark, sf).select("line_no", "message")
    turns = table(spark, sf, "conversations").select(
        (F.lit(10**12) + F.col("conv_id") * 1000 + F.col("turn")).alias("line_no"), F.col("text").alias("message")
    )
    return stored(log), stored(log.unionByName(turns))


def match_templates(spark, sf):
    log, both = _two_logs(spark, sf)
    return tpl.match_shapes(tpl.distinct_shapes(tpl.with_shape(both)), tpl.mine_templates(log, similarity=0.0))


def tag_log_key(spark, sf):
    """Both logs under the templates of the first."""
    log, both = _two_logs(spark, sf)
    return tpl.tag_rows(both, tpl.mine_templates(log, similarity=0.0)).select("line_no", "log_key")


def template_usage(spark, sf):
    return tpl.template_usage(tag_log_key(spark, sf))


def unseen_templates(spark, sf):
    """Templates of both logs that the first has no line of."""
    log, both = _two_logs(spark, sf)
    known = tpl.mine_templates(both, similarity=0.0)
    return tpl.unseen_templates(tpl.tag_rows(log, known), known).select("log_key", "template")


def learn_templates(spark, sf):
    """Templates of the document lines go on learning from the second log: every
    leaf ends with what all its shapes agree on."""
    docs, turns = _document_lines(spark, sf), _turn_lines(spark, sf)
    known = tpl.mine_templates(docs, similarity=0.0)
    grown = tpl.learn_more(known, tpl.distinct_shapes(tpl.with_shape(turns)), similarity=0.0)
    return grown.select(F.md5("template").alias("template_md5"), "n_rows", "n_tokens", "log_key")


def _turn_lines(spark, sf):
    turns = table(spark, sf, "conversations")
    return turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("line_no"), F.col("text").alias("message"))


def match_catalogue(spark, sf):
    return catalogue.match_catalogue(parsed(spark, sf)).select("line_no", "event_id")


def document_template_versions(spark, sf):
    shapes = tpl.distinct_shapes(tpl.with_shape(_document_lines(spark, sf)))
    return tpl.mine_versions(shapes).withColumn("template", F.md5("template")).drop("first_token")


def template_state_roundtrip(spark, sf):
    p = stored(_document_lines(spark, sf))
    path = scratch_path(spark, "state")
    tpl.mine_templates(p).write.parquet(path)
    return tpl.tag_rows(p, spark.read.parquet(path)).select("line_no", "log_key")


# Sequences and windows


def _shape_texts(spark, sf):
    rows = stored(cleaned(spark, sf))
    keyed = tpl.shape_templates(tpl.with_shape(rows))
    tagged = stored(tpl.tag_rows(rows, keyed))
    return tpl.template_text(tagged, keyed)


def _shape_sequences(spark, sf, **options):
    return sequences.session_sequences(_shape_texts(spark, sf), **options)


def session_sequences(spark, sf):
    return _shape_sequences(spark, sf)


def session_sequences_from_parts(spark, sf):
    return _shape_sequences(spark, sf, build_events=256, block_rows=1000)


def session_pieces(spark, sf):
    return _shape_sequences(spark, sf, piece_events=256, block_rows=1000)


def conversation_sequences(spark, sf):
    return sequences.session_sequences(table(spark, sf, "conversations"), "conv_id", "turn", "text")


def sliding_windows(spark, sf):
    out = windows.sliding_windows(lines(spark, sf), (), block_lines=1 << 12)
    return out.select("line_no", windows.joined("value_window").alias("sequence"))


def user_windows(spark, sf):
    from riftlog.operators.positions import with_positions

    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    placed = with_positions(events, "event_id", ["user_id"], block_rows=3000)
    out = windows.sliding_windows(placed, ["user_id"], "pos", ["event_type"], ["event_id"], block_lines=64)
    return out.select("user_id", "event_id", windows.joined("event_type_window").alias("sequence"))


def conversation_windows(spark, sf):
    out = windows.sliding_windows(
        table(spark, sf, "conversations"), ["conv_id"], "turn", ["role"], size=4
    )
    return out.select("conv_id", "turn", windows.joined("role_window").alias("sequence"))


def short_files(spark, sf):
    return windows.short_files(table(spark, sf, "conversations"), ["conv_id"], 5)


def context_payload(spark, sf):
    out = windows.sliding_windows(lines(spark, sf), (), block_lines=1 << 12)
    suspicious = out.filter(F.element_at("value_window", 1).contains(" ERROR "))
    return windows.context_payload(suspicious).select("line_no", "payload")


# Features


def vocabulary_top1000(spark, sf):
    return features.top_vocabulary(spread(spark, sf, "documents"), "text")


def _weights(df):
    return df.select("doc_id", "term", dec(F.col("weight")).alias("weight"))


def tfidf_capped(spark, sf):
    docs = spread(spark, sf, "documents")
    return _weights(features.fit_tfidf(docs, "text").long_form(docs, "doc_id", "text"))


def tfidf_full(spark, sf):
    return _weights(features.tfidf_full(spread(spark, sf, "documents"), "doc_id", "text"))


def session_tfidf(spark, sf):
    """Training rows of sessions by all their words, from a long table."""
    sessions = session_terms.session_terms(_shape_texts(spark, sf))
    return sessions.weights(sessions.fit_all()).withColumn("weight", dec(F.col("weight")))


def session_tfidf_top20(spark, sf):
    sessions = session_terms.session_terms(_shape_texts(spark, sf))
    return sessions.weights(sessions.fit(20)).withColumn("weight", dec(F.col("weight")))


def tfidf_transform(spark, sf):
    turns = table(spark, sf, "conversations").withColumn(
        "doc_id", F.col("conv_id") * 1000 + F.col("turn")
    )
    model = features.fit_tfidf(spread(spark, sf, "documents"), "text")
    return _weights(model.long_form(turns, "doc_id", "text"))


def dense_vectors(spark, sf):
    from pyspark.ml.functions import vector_to_array

    turns = table(spark, sf, "conversations")
    model = features.fit_tfidf(turns, "text")
    dense = vector_to_array(F.col("vector"))
    return model.transform(turns, "text").select(
        "conv_id",
        "turn",
        F.size(dense).alias("dim"),
        dec(F.aggregate(dense, F.lit(0.0), lambda a, x: a + x)).alias("total"),
    )


def token_ids_padded(spark, sf):
    docs = spread(spark, sf, "documents")
    out = features.padded_token_ids(docs, features.token_vocabulary(docs), "doc_id")
    return out.select(
        "doc_id",
        F.array_join("input_ids", ",").alias("input_ids"),
        F.array_join("attention_mask", ",").alias("attention_mask"),
    )


def split_80_20(spark, sf):
    return features.split_train(spread(spark, sf, "documents").select("doc_id"), "doc_id")


def split_tail10(spark, sf):
    return features.split_tail(spread(spark, sf, "documents").select("doc_id"), "doc_id")


# Models


def _vectors(spark, sf):
    return table(spark, sf, "embeddings")


def _label_centers(spark, sf):
    return kmeans.label_means(_vectors(spark, sf), "embedding", "label")


def _assigned(spark, sf):
    model = kmeans.Centroids.from_table(_label_centers(spark, sf))
    return kmeans.assign_clusters(_vectors(spark, sf), model, "embedding")


def nearest_centroid(spark, sf):
    return kmeans.flag_far(_assigned(spark, sf)).select(
        "vec_id", "cluster", dec(F.col("anomaly_score")).alias("anomaly_score"), "is_anomaly"
    )


def centroid_distance(spark, sf):
    own = kmeans.own_center_distance(
        _vectors(spark, sf).withColumnRenamed("label", "cluster"), _label_centers(spark, sf), "embedding"
    )
    return own.select("vec_id", "cluster", dec(F.col("distance")).alias("distance"))


def cluster_sizes(spark, sf):
    return kmeans.cluster_sizes(_assigned(spark, sf))


def inertia(spark, sf):
    return kmeans.inertia(_assigned(spark, sf)).select(dec(F.col("inertia"), 4).alias("inertia"))


def silhouette_exact(spark, sf):
    out = kmeans.silhouette_exact(_vectors(spark, sf), "embedding", "label", block_rows=256)
    return out.select(dec(F.col("silhouette")).alias("silhouette"))


def silhouette_squared(spark, sf):
    out = kmeans.silhouette_squared(_vectors(spark, sf), "embedding", "label")
    return out.select(dec(F.col("silhouette")).alias("silhouette"))


def reconstruction_mse(spark, sf):
    from riftlog.functions.vectors import mean_squared_error
    from riftlog.operators.lookups import lookup_join

    both = lookup_join(
        _vectors(spark, sf).withColumnRenamed("label", "cluster"), _label_centers(spark, sf), ["cluster"]
    )
    return both.select(
        "vec_id", dec(mean_squared_error(F.col("embedding"), F.col("center")), 9).alias("mse")
    )


def contamination_cut(spark, sf):
    shares = [0.01, 0.05, 0.1]
    cuts = quantiles.exact_quantiles(table(spark, sf, "lineitem"), "l_extendedprice", shares)
    rows = spark.createDataFrame(list(zip(shares, cuts)), "p double, cut double")
    return rows.select(dec(F.col("p"), 2).alias("p"), dec(F.col("cut"), 4).alias("cut"))


def kmeans_best_seed(spark, sf):
    from pyspark.ml.functions import array_to_vector

    data = _vectors(spark, sf).select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("vector")
    )
    return kmeans.fit_best_kmeans(data)[1]


def iforest_scores(spark, sf):
    data = _vectors(spark, sf)
    forest = iforest.fit_forest(data, 64, "vec_id", "embedding", 100, 0.05)
    return iforest.decide(data, forest, "embedding").select("vec_id", "anomaly_score", "is_anomaly")


def _stumps():
    """A forest of fixed stumps: tree t cuts place 4 t at 0."""
    import pandas as pd

    nodes = [
        row
        for t in range(16)
        for row in ((t, 0, 4 * t, 0.0, 1, 2, 256, 0), (t, 1, -1, 0.0, -1, -1, 40 + t, 1),
                    (t, 2, -1, 0.0, -1, -1, 216 - t, 1))
    ]
    names = ["tree", "node", "feature", "threshold", "left", "right", "size", "depth"]
    return iforest.Forest(iforest._node_array(pd.DataFrame(nodes, columns=names)), 256, 64, -0.43)


def iforest_stump_scores(spark, sf):
    out = iforest.decide(_vectors(spark, sf), _stumps(), "embedding")
    return out.select("vec_id", dec(F.col("anomaly_score")).alias("anomaly_score"), "is_anomaly")


def iforest_stump_mean(spark, sf):
    out = iforest.mean_anomaly(iforest.decide(_vectors(spark, sf), _stumps(), "embedding"))
    return out.select(dec(F.col("mean_score")).alias("mean_score"))


def _fixed_network(dim):
    """Weights by a rule, ``dim`` to 2 to ``dim``."""
    import numpy as np

    first = (((np.arange(dim)[:, None] + 3 * np.arange(2)) % 5) - 2) / 8
    second = (((2 * np.arange(2)[:, None] + np.arange(dim)) % 7) - 3) / 8
    flat = np.concatenate([first.ravel(), [0.25, 0.125], second.ravel(), np.zeros(dim)])
    return autoencoder.Network((dim, 2, dim), flat.astype(np.float32))


def network_errors(spark, sf):
    """Encoding and reconstruction error under fixed weights, 64 to 2 to 64."""
    net = _fixed_network(64)
    out = autoencoder.with_latent(_vectors(spark, sf), net, "embedding")
    return out.select(
        "vec_id",
        dec(F.get("latent", F.lit(0))).alias("latent_0"),
        dec(F.get("latent", F.lit(1))).alias("latent_1"),
        dec(F.col("reconstruction_error")).alias("error"),
    )


def iforest_search(spark, sf):
    data = _vectors(spark, sf)
    return iforest.search_forest(data, 64, "vec_id", "embedding")[1]


def feature_covariance(spark, sf):
    """What the linear baseline of the autoencoder is made of."""
    found = principal.covariance(spread(spark, sf, "embeddings"), 64, "embedding")
    return found.withColumn("covariance", dec(F.col("covariance")))


def best_setting(spark, sf):
    """A study of a given objective: of which priority and status are orders dearest?"""
    orders = spread(spark, sf, "orders")
    means = stored(orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.avg("o_totalprice").alias("price")))
    values = lambda c: tuple(r[0] for r in means.select(c).distinct().orderBy(c).collect())
    space = {c: search.Choice(values(c)) for c in ("o_orderpriority", "o_orderstatus")}

    def price(t):
        row = means.filter((F.col("o_orderpriority") == t["o_orderpriority"]) & (F.col("o_orderstatus") == t["o_orderstatus"])).first()
        return row and row["price"]

    trials = search.study(price, space, n_trials=len(space["o_orderpriority"].options) * len(space["o_orderstatus"].options))
    table = search.trial_table(spark, trials, "o_orderpriority string, o_orderstatus string")
    best = runs.best_run(table, "run_no", "score", ("o_orderpriority", "o_orderstatus"))
    return best.drop("run_no").withColumn("score", dec(F.col("score"), 4)).withColumn("n_settings", F.lit(table.filter("score IS NOT NULL").count()))


def early_stop_epoch(spark, sf):
    return runs.early_stop(_monthly_loss(spark, sf)).select(
        "stop_epoch", "best_epoch", dec(F.col("best_loss"), 4).alias("best_loss")
    )


def _monthly_loss(spark, sf):
    """A loss per epoch made of line items: the mean tax and discount by month."""
    months = table(spark, sf, "lineitem").select(
        (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("m"), "l_discount", "l_tax"
    )
    first = months.agg(F.min("m")).scalar()
    return (
        months.withColumn("epoch", (F.col("m") - first).cast("int"))
        .groupBy("epoch")
        .agg(
            F.round(F.avg("l_discount"), 6).alias("val_loss"),
            F.round(F.avg("l_tax"), 6).alias("train_loss"),
        )
    )


def best_run(spark, sf):
    scores = (
        table(spark, sf, "orders")
        .groupBy((F.col("o_custkey") % 50).alias("run_no"))
        .agg(F.round(F.avg("o_totalprice"), 2).alias("score"), F.count("*").alias("n"))
    )
    return runs.best_run(scores, "run_no", "score", ("n",)).select(
        "run_no", dec(F.col("score"), 2).alias("score"), "n"
    )


def loss_curve(spark, sf):
    losses = _monthly_loss(spark, sf)
    long = losses.select(
        F.lit("run").alias("run_id"),
        F.lit("metric").alias("kind"),
        F.col("epoch").alias("step"),
        F.inline(
            F.array(
                F.struct(F.lit("train_loss").alias("key"), F.col("train_loss").cast("string").alias("value")),
                F.struct(F.lit("val_loss").alias("key"), F.col("val_loss").cast("string").alias("value")),
            )
        ),
    )
    return runs.loss_curve(long).select(
        "run_id", "step", dec(F.col("train_loss")).alias("train_loss"), dec(F.col("val_loss")).alias("val_loss")
    )


def _training(spark, sf):
    """Templates, sequences and upload lines of the event log. Messages are masked once, and
    the text of the sequences, which are built in several passes, is a layer of its own."""
    p = stored(tpl.with_shape(cleaned(spark, sf)))
    known = tpl.mine_templates(p, masked="shape")
    text = tpl.template_text(tpl.tag_rows(p, known, masked="shape"), known)
    seqs = settle(sequences.session_sequences(stored(text.select("request_id", "line_no", "template"))), "sequences")
    upload = p.select(
        F.col("source").alias("file"), F.col("line_no").alias("n"), F.col("message").alias("value"), "shape"
    ).filter(F.col("value").isNotNull())
    from riftlog.operators.positions import with_positions

    upload = stored(with_positions(upload, "n", ["file"], name="line_no").drop("n"))
    return seqs, scoring_windows(with_unit(upload, "template", known, masked="shape"))


def _round_score(df):
    return df.withColumn("anomaly_score", dec(F.col("anomaly_score")))


def score_kmeans_windows(spark, sf):
    seqs, wins = _training(spark, sf)
    return _round_score(score_kmeans(wins, training.train_kmeans(seqs)[0]))


def _score_given_centers(spark, sf):
    """Windows of conversations scored against given centres: the mean TF-IDF
    vector of the turns of each role."""
    from pyspark.ml.functions import vector_to_array

    turns = table(spark, sf, "conversations")
    tfidf = features.fit_tfidf(turns, "text")
    dense = tfidf.transform(turns, "text").withColumn("x", vector_to_array("vector"))
    roles = dense.withColumn("cluster", F.when(F.col("role") == "user", 0).otherwise(1))
    centers = kmeans.Centroids.from_table(kmeans.label_means(roles, "x", "cluster"))
    return score_kmeans(_turn_windows(turns), KMeansModel(tfidf, centers))


def _turn_windows(turns):
    unit = with_unit(turns.withColumnsRenamed({"turn": "line_no"}), "line", line="text")
    return scoring_windows(unit, 3, "text", ["conv_id"])


def score_forest_given_stumps(spark, sf):
    """The windows under a forest of fixed stumps: tree t asks whether the window has
    word 4 t of the vocabulary."""
    turns = table(spark, sf, "conversations")
    tfidf = features.fit_tfidf(turns, "text")
    forest = dataclasses.replace(_stumps(), dim=tfidf.dim)
    out = score_forest(_turn_windows(turns), ForestModel(tfidf, forest))
    return _round_score(out).withColumn("window_start_line", F.md5("window_start_line"))


def score_encoder_learning(spark, sf):
    """Templates of the document lines go on learning from the conversations that are
    scored; their windows are made of the learned templates, under fixed weights."""
    turns = table(spark, sf, "conversations")
    known = tpl.mine_templates(_document_lines(spark, sf), similarity=0.0)
    unit = with_unit(
        turns.withColumnsRenamed({"turn": "turn_no"}).withColumn("line_no", F.col("conv_id") * 1000 + F.col("turn_no")),
        "template", known, "text", learn=True, similarity=0.0,
    )
    wins = scoring_windows(unit, 3, "text", ["conv_id"])
    tfidf = features.fit_tfidf(turns, "text")
    centers = spark.createDataFrame([(0, [0.0, 0.0]), (1, [0.5, 0.5])], "cluster int, center array<double>")
    model = EncoderModel(tfidf, _fixed_network(tfidf.dim), kmeans.Centroids.from_table(centers))
    out = _round_score(score_encoder(wins, model))
    return out.withColumn("log_window_start", F.md5("log_window_start"))


def score_windows_given_centers(spark, sf):
    out = _score_given_centers(spark, sf)
    return _round_score(out).withColumn("window_start_line", F.md5("window_start_line"))


def anomaly_payload(spark, sf):
    """The lines of the windows that score as anomalies."""
    turns = table(spark, sf, "conversations").withColumnRenamed("turn", "line_no")
    found = scoring.anomaly_payload(stored(_score_given_centers(spark, sf)), turns, "text", ["conv_id"], 3)
    return found.withColumn("payload", F.md5("payload"))


def score_forest_windows(spark, sf):
    seqs, wins = _training(spark, sf)
    return _round_score(score_forest(wins, training.train_forest(seqs)[0]))


def iforest_normal_windows(spark, sf):
    seqs, wins = _training(spark, sf)
    return _round_score(score_forest(wins, training.train_forest(seqs)[0], "normal"))


def score_encoder_windows(spark, sf):
    seqs, wins = _training(spark, sf)
    return _round_score(score_encoder(wins, training.train_encoder(seqs)[0]))


def autoencoder_losses(spark, sf):
    seqs, _ = _training(spark, sf)
    log = training.train_encoder(seqs)[1]
    return runs.loss_curve(log)


def latent_clusters(spark, sf):
    from pyspark.ml.functions import array_to_vector

    docs = spread(spark, sf, "documents")
    tfidf = features.fit_tfidf(docs, "text")
    data = settle(
        features.split_tail(tfidf.features(docs, "text").select("doc_id", "features"), "doc_id"), "latent"
    )
    net, _ = autoencoder.fit_autoencoder(data, tfidf.dim)
    latent = autoencoder.with_latent(data, net).withColumn("vector", array_to_vector("latent"))
    model = kmeans.fit_kmeans(latent)
    return kmeans.assign_clusters(latent, model, "latent").select("doc_id", "cluster", "reconstruction_error")


def _same_scores(a, b, keys):
    """All windows of two scorings, and whether both say the same of each."""
    near = F.abs(F.col("x.anomaly_score") - F.col("y.anomaly_score")) < 1e-9
    on = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in (*keys, "window_start_line")]
    both = a.alias("x").join(b.alias("y"), on, "full")
    same = F.coalesce(near & (F.col("x.cluster") == F.col("y.cluster")), F.lit(False))
    return both.select(*[F.coalesce(f"x.{k}", f"y.{k}").alias(k) for k in (*keys, "window_start_line")], same.alias("same"))


def model_roundtrip(spark, sf):
    """Every window, and whether the stored and loaded model scores it as the model itself."""
    seqs, wins = _training(spark, sf)
    wins = stored(wins)
    model = training.train_kmeans(seqs)[0]
    path = save_model(spark, model, scratch_path(spark, "model"))
    return _same_scores(score_kmeans(wins, model), score_kmeans(wins, load_model(spark, type(model), path)), ["file", "line_no"])


def forest_roundtrip(spark, sf):
    """Windows under a stored and loaded forest."""
    turns = table(spark, sf, "conversations")
    tfidf = features.fit_tfidf(turns, "text")
    model = ForestModel(tfidf, dataclasses.replace(_stumps(), dim=tfidf.dim))
    back = load_model(spark, ForestModel, save_model(spark, model, scratch_path(spark, "model")))
    out = score_forest(_turn_windows(turns), back)
    return _round_score(out).withColumn("window_start_line", F.md5("window_start_line"))


#: Between the scores of windows with few and with many of the asked words.
NORMAL_OFFSET = -0.57


def normal_windows_given_stumps(spark, sf):
    """Only the windows that the forest of fixed stumps finds normal."""
    turns = table(spark, sf, "conversations")
    tfidf = features.fit_tfidf(turns, "text")
    forest = dataclasses.replace(_stumps(), dim=tfidf.dim, offset=NORMAL_OFFSET)
    out = score_forest(_turn_windows(turns), ForestModel(tfidf, forest), "normal")
    return _round_score(out).withColumn("window_start_line", F.md5("window_start_line"))


def _order_runs(spark, sf):
    """A run log made of orders: a run per status and clerk number, written and read."""
    means = table(spark, sf, "orders").groupBy("o_orderstatus", (F.col("o_custkey") % 7).alias("no")).agg(
        F.round(F.avg("o_totalprice"), 2).alias("price"), F.count("*").alias("n"))
    means = stored(means.withColumn("run_id", F.concat_ws("/", "o_orderstatus", "no")))
    row = lambda kind, key, value: means.select("run_id", F.lit(kind).alias("kind"), F.lit(key).alias("key"), F.lit(None).cast("int").alias("step"), F.col(value).cast("string").alias("value"))
    path = scratch_path(spark, "runs")
    for one in (row("param", "n_orders", "n"), row("metric", "mean_price", "price"), row("tag", "model_path", "run_id")):
        runs.append_run(one, path)
    return spark.read.parquet(path)


def run_log_written(spark, sf):
    return _order_runs(spark, sf).select("run_id", "kind", "key", "value")


def best_over_kinds(spark, sf):
    """One best run over three kinds of run."""
    found = _best_over_kinds(_order_runs(spark, sf), {s: "mean_price" for s in ("F", "O", "P")})
    return found.select("kind", "run_id", dec(F.col("score"), 2).alias("score"), dec(F.col("lead")).alias("lead"))


def one_day_of_log(spark, sf):
    """The structured log by date of event; the last date is written again without its
    errors, and read alone."""
    path = scratch_path(spark, "days")
    rows = stored(parsed(spark, sf).withColumn(tables.DAY, event_day()))
    tables.write_days(rows, path)
    last = rows.agg(F.max(tables.DAY)).first()[0]
    tables.write_days(rows.filter((F.col(tables.DAY) == last) & (F.col("level") != "ERROR")), path)
    n_all = tables.read_days(spark, path).agg(F.count(F.lit(1))).scalar()
    return tables.read_days(spark, path, last, last).select("line_no", "level", "message", F.col(tables.DAY).cast("string").alias("day"), n_all.alias("n_all"))


# Streams


def _write_arriving(spark, sf, path):
    """The log as three files that arrive one after the other."""
    log = stored(lines(spark, sf))
    n = log.count()
    for i in range(3):
        part = log.where((F.col("line_no") >= n * i // 3) & (F.col("line_no") < n * (i + 1) // 3))
        part.coalesce(1).sortWithinPartitions("line_no").select("value").write.mode("append").text(path)


def stream_templates(spark, sf):
    source, out, mark = (scratch_path(spark, x) for x in ("arriving", "updates", "mark"))
    _write_arriving(spark, sf, source)
    # Lines of a stream are numbered by their event time here.
    arriving = with_event_time(parse_lines(spark.readStream.option("maxFilesPerTrigger", 1).text(source)))
    numbered = arriving.select(
        "message", F.unix_micros(F.col("event_ts").cast("timestamp")).alias("line_no")
    )
    query = (
        streaming_templates.learn_templates(numbered)
        .writeStream.foreachBatch(
            lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        )
        .outputMode("update")
        .option("checkpointLocation", mark)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return streaming_templates.current(spark.read.parquet(out).drop("batch")).drop("place")


def stream_score(spark, sf):
    """Every window of the files that arrive, and whether it scores as it does in batch."""
    seqs, _ = _training(spark, sf)
    model = training.train_kmeans(seqs)[0]
    source, out, mark = (scratch_path(spark, x) for x in ("arriving", "scores", "mark"))
    _write_arriving(spark, sf, source)
    streaming_jobs.score_arrivals(
        spark, source, lambda wins: score_kmeans(wins, model), out, mark
    ).awaitTermination()
    batch = score_kmeans(scoring_windows(with_unit(text_logs.read_upload(spark, source))), model)
    return _same_scores(spark.read.parquet(out).drop("batch"), batch, ["file", "line_no"]).drop("file")


def stream_retrain(spark, sf):
    source, out, mark = (scratch_path(spark, x) for x in ("messages", "requests", "mark"))
    _message_table(spark, sf).select("body").repartition(3).write.text(source)
    streaming_jobs.watch_retrain(spark, source, out, mark).awaitTermination()
    return spark.read.parquet(out)


QUERIES = {
    f.__name__: f
    for f in (
        raw_lines, trim_nonblank_lines, csv_roundtrip, csv_headerless, json_roundtrip,
        single_file_export, model_update_record, retrain_requests, appended_updates, profile_report,
        parse_log, parse_rejects, event_times, impute_request_id, drop_missing_message,
        numeric_columns, sequence_text, log_scalars, preview_lines,
        request_id_top50, request_id_top50_map, request_id_profile, column_summary,
        histogram_lineitem, histogram_pid, mean_impute, validation_report, stored_validation_report, validated_log,
        mask_shapes, mask_document_shapes, template_keys, mine_leaf_templates, mine_templates,
        mine_templates_in_pieces, mine_document_templates, mine_templates_strict, mine_templates_tree, tag_by_tree,
        template_versions, match_templates,
        document_template_versions, tag_log_key, template_usage, unseen_templates, learn_templates, match_catalogue, template_state_roundtrip,
        session_sequences, session_sequences_from_parts, session_pieces, conversation_sequences, sliding_windows, user_windows,
        conversation_windows, short_files, context_payload,
        vocabulary_top1000, tfidf_capped, tfidf_full, session_tfidf, session_tfidf_top20, tfidf_transform, dense_vectors,
        token_ids_padded, split_80_20, split_tail10,
        nearest_centroid, centroid_distance, cluster_sizes, inertia, silhouette_exact,
        silhouette_squared, reconstruction_mse, contamination_cut, kmeans_best_seed,
        iforest_scores, iforest_stump_scores, iforest_stump_mean, network_errors, iforest_search, iforest_normal_windows, feature_covariance, best_setting, early_stop_epoch, best_run,
        loss_curve, autoencoder_losses, latent_clusters, model_roundtrip, forest_roundtrip, normal_windows_given_stumps, run_log_written, best_over_kinds, one_day_of_log,
        score_windows_given_centers, score_forest_given_stumps, score_encoder_learning, anomaly_payload, score_kmeans_windows, score_forest_windows, score_encoder_windows,
        stream_templates, stream_score, stream_retrain,
    )
}
