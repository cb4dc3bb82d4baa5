"""Registered queries: every operator run over the whole given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortfit.functions.boosting import FitSpec
from cohortfit.functions.hashing import row_hash
from cohortfit.operators import registry as R
from cohortfit.operators import tune as S
from cohortfit.operators.encode import encode, encoder_stats, impute, inject_missing
from cohortfit.operators.evaluate import (
    group_auc,
    group_weighted_prf,
    hard_class,
    metric_row,
    trial_loss,
)
from cohortfit.operators.fit import ROW_SEED, fit_groups
from cohortfit.operators.groups import attach, measure, meet
from cohortfit.operators.levelwise import (
    best_splits,
    bin_rows,
    candidate_splits,
    feature_cuts,
    fit_levelwise,
    histograms,
    with_gradients,
)
from cohortfit.operators.quantiles import quartile_bins
from cohortfit.operators.score import (
    class_probabilities,
    group_predictions,
    score,
    score_raw,
    unscored_groups,
    with_label_probability,
)
from cohortfit.operators.split import train_test_split
from cohortfit.plans.train import (
    TuneSpec,
    one_trial,
    prepare,
    score_production,
    train_groups,
    train_run,
    tune_groups,
)
from cohortfit.plans.views import DOC_ROLES, ORD_ROLES, documents_view, events_view, orders_view
from cohortfit.schemas import METRICS, Roles
from cohortfit.session import materialize, shared_dir
from cohortfit.sources import synthetic
from cohortfit.sources.store import Store
from cohortfit.sources.tables import metrics_long, model_stats, params_long, read_table

GROUP = "event_type"
SMALL_FIT = FitSpec(n_estimators=3, max_depth=2, max_bins=16, subsample=0.8, colsample_bytree=0.6, random_state=5)
RUN_FIT = FitSpec(n_estimators=30)
RUN_SPACE = S.Space(S.DEFAULT_SPACE.dimensions, (("n_estimators", 30.0), ("random_state", 1.0)))
RUN_TUNING = TuneSpec(max_evals=6, startup=4, batch=2)


# Sources, projection, filter


def group_list(spark, folder):
    return synthetic.name_groups(read_table(spark, folder, "events"), GROUP)


def feature_projection(spark, folder):
    return orders_view(spark, folder).select("segment", "label", "o_orderpriority", "o_totalprice", "c_acctbal")


def group_filter(spark, folder):
    return orders_view(spark, folder).where(F.col("segment") == "BUILDING").select("o_orderkey", "o_totalprice")


def synthetic_table(spark, folder) -> DataFrame:
    rows = orders_view(spark, folder, heavy=True).select(
        F.col("segment").alias("group_name"), F.col("o_orderkey").alias("id")
    )
    return synthetic.feature_table(rows)


def synth_features_profile(spark, folder):
    table = synthetic_table(spark, folder)
    true_class = synthetic.unflipped_class(11, F.col("group_name"), F.col("id"))
    return table.groupBy("group_name").agg(
        F.count("*").alias("n_rows"),
        F.sum("label").alias("n_positive"),
        F.count_if(F.col("label") != true_class).alias("n_flipped"),
        F.count_if(F.col("numeric_feature_02").isNull()).alias("n_missing_02"),
        F.count_if(F.col("categorical_feature_01").isNull()).alias("n_missing_cat"),
        F.count_if(F.col("categorical_feature_01") == 3).alias("n_top_quartile"),
        F.round(F.avg("numeric_feature_02"), 6).alias("mean_02"),
        F.round(F.avg("numeric_feature_20"), 6).alias("mean_20"),
    )


# Feature preparation


def quartile_codes(spark, folder):
    events = events_view(spark, folder)
    return quartile_bins(events, GROUP, "value", "quartile").select("event_id", GROUP, "quartile")


def events_with_nan(spark, folder):
    """Every seventh value is not a number, as files of other systems mark a missing one."""
    value = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return events_view(spark, folder).withColumn("value", value)


def quartile_codes_nan(spark, folder):
    return quartile_bins(events_with_nan(spark, folder), GROUP, "value", "quartile").select("event_id", GROUP, "quartile")


def masked_events(spark, folder):
    return inject_missing(events_view(spark, folder), ["value"], "event_id")


def missing_mask(spark, folder):
    return masked_events(spark, folder).select("event_id", GROUP, "value")


def median_impute(spark, folder):
    return _imputed(masked_events(spark, folder))


def median_impute_nan(spark, folder):
    return _imputed(events_with_nan(spark, folder))


def _imputed(events):
    """Medians of the train rows of each group fill the gaps of all its rows."""
    roles = Roles(group=GROUP, numeric=("value",))
    sizes = measure(events, GROUP)
    marked = train_test_split(events, GROUP, "event_id", sizes=sizes)
    stats = encoder_stats(marked.where(F.col("split") == "train"), roles, sizes=sizes)
    joined = attach(marked, stats.select(GROUP, "medians"), [GROUP], stats_rows=sizes.groups, row_bytes=64)
    filled = impute(joined, roles)
    return filled.select("event_id", GROUP, "split", F.round("value", 6).alias("value"))


def split_orders(spark, folder):
    return train_test_split(orders_view(spark, folder), "segment", "o_orderkey")


def train_test_rows(spark, folder):
    return split_orders(spark, folder).select("o_orderkey", "segment", "split")


def split_counts(spark, folder):
    return split_orders(spark, folder).groupBy("segment", "split").agg(F.count("*").alias("n_rows"))


def masked_orders(spark, folder):
    return inject_missing(orders_view(spark, folder, heavy=True), list(ORD_ROLES.features), "o_orderkey")


def marked_orders(spark, folder):
    """Masked orders with their split, written once for the several passes that fit encoders."""
    return materialize(train_test_split(masked_orders(spark, folder), "segment", "o_orderkey"), "marked-orders")


def onehot_train_categories(spark, folder):
    marked = marked_orders(spark, folder)
    stats = encoder_stats(marked.where(F.col("split") == "train"), ORD_ROLES)
    return stats.select("segment", F.array_join("cats_o_orderpriority", "|").alias("categories"))


def _flat(encoded: DataFrame, *keep: str) -> DataFrame:
    return encoded.select(*keep, *[F.round(F.get("features", F.lit(i)), 6).alias(f"f{i}") for i in range(8)])


def encoded_matrix(spark, folder):
    """Encoders fitted on train rows, applied to train and test rows."""
    marked = marked_orders(spark, folder)
    sizes = measure(marked, "segment")
    stats = encoder_stats(marked.where(F.col("split") == "train"), ORD_ROLES, sizes=sizes)
    encoded = encode(marked, stats, ORD_ROLES, groups=sizes.groups, keep=["o_orderkey", "label", "split"])
    return _flat(encoded, "segment", "o_orderkey", "label", "split")


def encoded_matrix_all_rows(spark, folder):
    """The final model's encoding: encoders fitted on the whole group."""
    rows = masked_orders(spark, folder)
    sizes = measure(rows, "segment")
    encoded = encode(rows, encoder_stats(rows, ORD_ROLES, sizes=sizes), ORD_ROLES, groups=sizes.groups)
    return _flat(encoded, "segment", "o_orderkey", "label")


# Evaluation


def auc_documents(spark, folder):
    found = group_auc(documents_view(spark, folder), "lang", "quality", "letter_share")
    return found.select("lang", F.round("auc", 9).alias("auc"))


def auc_orders(spark, folder):
    found = group_auc(orders_view(spark, folder), "segment", "label", "o_totalprice")
    return found.select("segment", F.round("auc", 9).alias("auc"))


def weighted_prf(spark, folder):
    docs = documents_view(spark, folder).withColumn("predicted", (F.col("letter_share") > 0.93).cast("int"))
    found = group_weighted_prf(docs, "lang", "quality", "predicted")
    return found.select("lang", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


def _doc_metrics(spark, folder):
    docs = train_test_split(documents_view(spark, folder), "lang", "doc_id")
    return metric_row(docs, "lang", "quality", "letter_share", "split")


def metric_rows(spark, folder):
    return _doc_metrics(spark, folder).withColumn("loss", F.round("loss", 9))


def trial_losses(spark, folder):
    found = group_auc(orders_view(spark, folder), "segment", "label", "c_acctbal")
    return found.select("segment", F.round(trial_loss(F.col("auc")), 9).alias("loss"))


# Boosting


def _doc_rows(spark, folder):
    """Documents encoded on train rows, in the shape tree growth reads."""
    ready = prepare(documents_view(spark, folder), DOC_ROLES.with_(categorical=()))
    return ready.encoded, ready.sizes


def _tree_rows(encoded):
    return encoded.select(
        "lang",
        F.col("quality").cast("int").alias("label"),
        (F.col("split") == "test").alias("is_test"),
        row_hash(ROW_SEED, F.col("doc_id")).alias("row_hash"),
        "features",
    )


def split_gain(spark, folder):
    """Best first split per group at the starting margin."""
    encoded, sizes = _doc_rows(spark, folder)
    rows = _tree_rows(encoded)
    binned = bin_rows(rows, feature_cuts(rows, "lang", 16, sizes), "lang", 16, sizes, 5)
    train = with_gradients(binned.where(~F.col("is_test")).withColumn("margin", F.lit(0.0)))
    found = best_splits(candidate_splits(histograms(train, ["lang"]), ["lang"]), ["lang"], F.lit(1.0))
    return found.select(
        "lang",
        F.col("feature").cast("int").alias("feature"),
        F.col("bin").cast("int").alias("bin"),
        *[F.round(c, 9).alias(c) for c in ("gain", "gl", "hl", "gt", "ht")],
    )


def _node_rows(fitted):
    arrays = [f"node_{n}" for n in ("feature", "threshold", "left", "right", "value")]
    nodes = fitted.where(F.col("status") == "ok").select(
        "lang", "best_iteration", "n_rounds", F.posexplode(F.arrays_zip(*arrays)).alias("position", "n")
    )
    return nodes.select(
        "lang",
        "best_iteration",
        "n_rounds",
        "position",
        "n.node_feature",
        F.round("n.node_threshold", 6).alias("node_threshold"),
        "n.node_left",
        "n.node_right",
        F.round("n.node_value", 8).alias("node_value"),
    )


def boosted_trees_grouped(spark, folder):
    """Trees fitted with one bounded task per group."""
    encoded, sizes = _doc_rows(spark, folder)
    trials = one_trial(encoded.select("lang").distinct(), "lang")
    fitted = fit_groups(encoded, trials, "lang", id_col="doc_id", label="quality", spec=SMALL_FIT, sizes=sizes)
    return _node_rows(fitted)


def boosted_trees_levelwise(spark, folder):
    """The same trees grown level by level over all groups together."""
    encoded, sizes = _doc_rows(spark, folder)
    trials = one_trial(encoded.select("lang").distinct(), "lang")
    return _node_rows(fit_levelwise(_tree_rows(encoded), trials, "lang", SMALL_FIT, sizes))


def _hourly(spark, folder):
    """A score per (event type, hour): the calendar bounds the length of a history."""
    return (
        events_view(spark, folder)
        .groupBy(
            GROUP,
            ((F.dayofmonth("ts") - 1) * 24 + F.hour("ts")).alias("trial_id"),
        )
        .agg(F.round(F.avg("value"), 6).alias("loss"))
    )


def early_stop_round(spark, folder):
    return S.early_stop(_hourly(spark, folder), GROUP, score="loss", round_col="trial_id").select(
        GROUP, "best_round", "best_score", "last_round"
    )


# Tuning


def search_stop(spark, folder):
    return S.search_progress(_hourly(spark, folder), GROUP)


def _drawn_trials(spark, folder):
    """Hourly losses with the parameters drawn for that trial number."""
    hourly = _hourly(spark, folder)
    salt = F.col(GROUP)
    values = {
        d.name: S.place(S.hash01(S.TUNING_SEED, salt, F.col("trial_id"), d.name), d)
        for d in S.DEFAULT_SPACE.dimensions
    }
    return hourly.withColumn("params", S.as_params(values, S.DEFAULT_SPACE))


def _param_columns(df, *keep):
    return df.select(
        *keep, *[F.round(F.element_at("params", F.lit(d.name)), 9).alias(d.name) for d in S.DEFAULT_SPACE.dimensions]
    )


def trial_draws(spark, folder):
    groups = read_table(spark, folder, "events").select(GROUP).distinct()
    return _param_columns(S.draw_trials(groups, GROUP, 0, 25), GROUP, "trial_id")


def trial_draws_shared(spark, folder):
    groups = read_table(spark, folder, "events").select(GROUP).distinct()
    return _param_columns(S.draw_trials(groups, GROUP, 0, 25, per_group_seed=False), GROUP, "trial_id")


def trial_types(spark, folder):
    typed = S.typed_params(_drawn_trials(spark, folder)).drop("params", "loss")
    return typed.withColumns({c: F.round(c, 9) for c in ("lambda", "subsample", "colsample_bytree")})


def best_trial(spark, folder):
    """Every event is a trial with its value as the loss; ties go to the first."""
    trials = events_view(spark, folder).select(GROUP, F.col("event_id").alias("trial_id"), F.col("value").alias("loss"))
    return S.best_trial(trials, GROUP)


def best_params_long(spark, folder):
    best = S.best_trial(_drawn_trials(spark, folder), GROUP, "params")
    return params_long(best, GROUP).withColumn("value", F.round("value", 9))


def metric_long_rows(spark, folder):
    return metrics_long(_doc_metrics(spark, folder).withColumn("best_iteration", F.lit(0)), "lang")


def model_stats_row(spark, folder):
    """Best trial joined with the group's metrics: the result row of a run."""
    best = S.best_trial(_drawn_trials(spark, folder), GROUP, "params")
    events = events_view(spark, folder).withColumn("label", (F.col("value") > 20).cast("int"))
    scored = train_test_split(events, GROUP, "event_id").withColumn("score", F.col("value") / 50.0)
    metrics = metric_row(scored, GROUP, "label", "score", "split")
    row = meet(best.drop("loss"), metrics, [GROUP], "inner").withColumn("run_id", F.md5(F.lit("run")))
    return _param_columns(row, GROUP, "run_id", "trial_id", *METRICS)


def guided_search(spark, folder):
    """Proposals of the next five trials from each group's hourly history."""
    proposed = S.propose(_drawn_trials(spark, folder), GROUP, 1000, 5)
    return proposed.select(
        GROUP,
        "trial_id",
        *[F.round(F.element_at("params", F.lit(d.name)), 6).alias(d.name) for d in S.DEFAULT_SPACE.dimensions],
    )


# Runs and registry; names, versions and promotions are derived from the tables


def experiment_upsert(spark, folder):
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    wanted = docs.select(F.col("source").alias("experiment"))
    existing = docs.join(labels.where(F.col("toxic") == 1), "doc_id", "left_semi").select(
        F.col("source").alias("experiment")
    )
    return R.get_or_create(wanted, existing.distinct(), "experiment")


def run_open(spark, folder):
    names = read_table(spark, folder, "documents").select(F.col("source").alias("experiment")).distinct()
    return R.open_runs(names, "one-model-a-group", "0")


def register_name(spark, folder):
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    name = F.concat_ws("/", "lang", "source").alias("name")
    existing = docs.join(labels.where(F.col("toxic") == 1), "doc_id", "left_semi").select(name)
    return R.missing_rows(docs.select(name), existing.distinct(), "name")


def _versions(spark, folder):
    """A user's first event of a type asks for a new version of that type's model."""
    events = read_table(spark, folder, "events")
    existing = events.select(F.col(GROUP).alias("name"), F.dayofmonth("ts").alias("version")).distinct()
    requests = events.groupBy(F.col(GROUP).alias("name"), "user_id").agg(F.min("event_id").alias("seq"))
    run = F.concat(F.lit("run-"), F.col("user_id").cast("string"))
    requests = requests.select(
        "seq", "name", run.alias("run_id"), F.concat(F.lit("runs/"), run, F.lit("/models")).alias("source")
    )
    return R.next_versions(existing, requests)


def new_version(spark, folder):
    return _versions(spark, folder)


def _stages(spark, folder):
    """Every later event of that user promotes the user's version."""
    versions = _versions(spark, folder)
    events = read_table(spark, folder, "events").select(
        F.col("event_id").alias("at"),
        F.col(GROUP).alias("name"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
    )
    moves = events.join(versions, ["name", "run_id"]).where(F.col("at") > F.col("seq"))
    moves = moves.select(F.col("at").alias("seq"), "name", "version", F.lit(R.PRODUCTION).alias("stage"))
    return R.current_stages(versions.drop("seq"), moves)


def promote_archive(spark, folder):
    return _stages(spark, folder)


def resolve_stage(spark, folder):
    return R.resolve(_stages(spark, folder))


def scaled_column(spark, folder):
    """A stored scalar model, found by its name, as a new column."""
    store = Store(spark, f"{shared_dir(spark)}/cohortfit/column-models-{uuid.uuid4().hex}")
    store.add_column_model("twice", "x + 1")
    store.add_column_model("twice", "x * 2")
    rows = orders_view(spark, folder).select("o_orderkey", "o_totalprice")
    return rows.withColumn("o_totalprice_scaled", store.column_model("twice")(F.col("o_totalprice")))


# Scoring


def stump_models(spark, folder):
    """Two small trees per segment with thresholds from the data; one segment has none."""
    orders = orders_view(spark, folder).where(F.col("segment") != "MACHINERY")
    facts = orders.groupBy("segment").agg(
        F.round(F.avg("o_totalprice"), 2).alias("price"),
        F.round(F.avg("c_acctbal"), 2).alias("balance"),
        F.round(F.avg("label"), 3).alias("rate"),
    )
    zero = F.lit(0.0)
    return facts.select(
        "segment",
        F.array(F.lit(0), F.lit(3)).alias("roots"),
        F.array(*[F.lit(v) for v in (0, -1, -1, 1, -1, 0, -1, -1)]).alias("node_feature"),
        F.array("price", zero, zero, "balance", zero, F.col("price") * 2, zero, zero).alias("node_threshold"),
        F.array(*[F.lit(v) for v in (1, -1, -1, 4, -1, 6, -1, -1)]).alias("node_left"),
        F.array(*[F.lit(v) for v in (2, -1, -1, 5, -1, 7, -1, -1)]).alias("node_right"),
        F.array(
            zero, -F.col("rate"), F.col("rate"), zero, F.lit(0.25), zero, F.lit(-0.5), F.col("rate") + 0.5
        ).alias("node_value"),
        F.lit(2).alias("tree_depth"),
    )


def _stump_scores(spark, folder):
    encoded = orders_view(spark, folder).withColumn("features", F.array("o_totalprice", "c_acctbal"))
    return score(encoded, stump_models(spark, folder), "segment", keep=["o_orderkey"])


def score_fixed_models(spark, folder):
    return _stump_scores(spark, folder).select("segment", "o_orderkey", F.round("probability", 9).alias("probability"))


def score_proba_array(spark, folder):
    pair = class_probabilities(F.col("probability"))
    return _stump_scores(spark, folder).select(
        "segment",
        "o_orderkey",
        F.round(pair[0], 9).alias("p0"),
        F.round(pair[1], 9).alias("p1"),
    )


def hard_classes(spark, folder):
    return _stump_scores(spark, folder).select("o_orderkey", hard_class(F.col("probability")).alias("predicted"))


def _raw_models(spark, folder):
    """Stumps over imputed prices only, next to the encoder fitted on all rows."""
    rows = masked_orders(spark, folder)
    roles = ORD_ROLES.with_(categorical=())
    stats = encoder_stats(rows, roles)
    return meet(stump_models(spark, folder), stats, ["segment"]), rows, roles


def score_raw_rows(spark, folder):
    models, rows, roles = _raw_models(spark, folder)
    scored = score_raw(rows, models, roles, keep=["o_orderkey", "label"])
    return scored.select("segment", "o_orderkey", "label", F.round("probability", 9).alias("probability"))


def score_missing_model(spark, folder):
    models, rows, roles = _raw_models(spark, folder)
    return unscored_groups(group_predictions(rows, models, roles), "segment")


def scored_row_projection(spark, folder):
    models, rows, roles = _raw_models(spark, folder)
    scored = score_raw(rows, models, roles, keep=["o_orderkey", "label", *roles.numeric])
    pairs = scored.withColumn("probabilities", class_probabilities(F.col("probability"))).drop("probability")
    return with_label_probability(pairs).withColumn("label_probability", F.round("label_probability", 9))


# Flows


def train_groups_stats(spark, folder):
    return model_stats(train_groups(documents_view(spark, folder), DOC_ROLES, RUN_FIT), "lang")


def train_groups_synthetic(spark, folder):
    """The full feature table generated over the orders, one model per segment."""
    table = materialize(synthetic_table(spark, folder), "features")
    return model_stats(train_groups(table, Roles.from_names(table), RUN_FIT), "group_name")


def tune_groups_history(spark, folder):
    ready = prepare(documents_view(spark, folder), DOC_ROLES)
    history = tune_groups(ready, RUN_SPACE, RUN_TUNING, RUN_FIT)
    return history.select(
        "lang", "trial_id", "round", "status", "loss", F.map_values("params").alias("params"), F.map_values("metrics").alias("metrics")
    )


def _project(spark, folder):
    store = Store(spark, f"{shared_dir(spark)}/cohortfit/project-{uuid.uuid4().hex}")
    # The feature table is written once; tuning, refit and scoring read it back.
    docs = materialize(documents_view(spark, folder), "features")
    run_id = train_run(docs, DOC_ROLES, store, experiment="documents", space=RUN_SPACE, tuning=RUN_TUNING, spec=RUN_FIT)
    return store, run_id, docs


def train_run_stats(spark, folder):
    store, run_id, _ = _project(spark, folder)
    stats = store.stats(run_id)
    return stats.withColumn("best_params", F.map_values("best_params"))


def train_register_score(spark: SparkSession, folder: str) -> DataFrame:
    """Tune and fit every group, register the run, promote it, score with Production."""
    store, run_id, docs = _project(spark, folder)
    version = store.register("documents", run_id)
    store.transition("documents", version)
    return score_production(docs, DOC_ROLES, store, "documents")


QUERIES = {
    "group_list": group_list,
    "feature_projection": feature_projection,
    "group_filter": group_filter,
    "synth_features_profile": synth_features_profile,
    "quartile_bins": quartile_codes,
    "missing_mask": missing_mask,
    "quartile_bins_nan": quartile_codes_nan,
    "median_impute": median_impute,
    "median_impute_nan": median_impute_nan,
    "train_test_split": train_test_rows,
    "split_counts": split_counts,
    "onehot_train_categories": onehot_train_categories,
    "encoded_matrix": encoded_matrix,
    "encoded_matrix_all_rows": encoded_matrix_all_rows,
    "group_auc": auc_documents,
    "group_auc_orders": auc_orders,
    "group_weighted_prf": weighted_prf,
    "metric_row": metric_rows,
    "trial_loss": trial_losses,
    "split_gain": split_gain,
    "boosted_trees_grouped": boosted_trees_grouped,
    "boosted_trees_levelwise": boosted_trees_levelwise,
    "early_stop_round": early_stop_round,
    "search_stop": search_stop,
    "trial_draws": trial_draws,
    "trial_draws_shared": trial_draws_shared,
    "trial_types": trial_types,
    "best_trial": best_trial,
    "best_params_long": best_params_long,
    "metrics_long": metric_long_rows,
    "model_stats_row": model_stats_row,
    "guided_search": guided_search,
    "experiment_upsert": experiment_upsert,
    "run_open": run_open,
    "register_name": register_name,
    "new_version": new_version,
    "promote_archive": promote_archive,
    "resolve_stage": resolve_stage,
    "scaled_column": scaled_column,
    "score_fixed_models": score_fixed_models,
    "score_proba_array": score_proba_array,
    "hard_class": hard_classes,
    "score_raw_rows": score_raw_rows,
    "score_missing_model": score_missing_model,
    "scored_row_projection": scored_row_projection,
    "train_groups": train_groups_stats,
    "train_groups_synthetic": train_groups_synthetic,
    "tune_groups": tune_groups_history,
    "train_run_stats": train_run_stats,
    "train_register_score": train_register_score,
}
