"""Lookups and recommendations as batch jobs over tables of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldspring.functions import buckets, text
from coldspring.operators import als, content, interactions, scorer, weights
from coldspring.operators.skew import first_per_group, lookup, with_position
from coldspring.plans.experiment import Experiment, assemble_users

# Request limits, model keys, genders, and the example levels.
MAX_K, MAX_RATINGS, HISTORY_ROWS, SEARCH_ROWS = 50, 200, 40, 8
RATING_LOW, RATING_HIGH = 0.5, 5.0
MODEL_KEYS = {"adaptive": scorer.ADAPTIVE, "fixed": scorer.FIXED, "switch": scorer.SWITCH, "cf": scorer.CF,
              "content": scorer.CONTENT, "popularity": scorer.DEMOGRAPHIC}
GENDERS = ("M", "F")
EXAMPLES = [("new sign-up", 0), ("1 rating", 1), ("3 ratings", 3), ("warm", 40), ("power user", 300)]


def chosen_models(experiment: Experiment, keys: list[str], diversify: bool = False) -> dict[str, dict]:
    models = scorer.registry(experiment.cfg, True)
    out = {key: dict(models[MODEL_KEYS[key]]) for key in keys}
    if diversify:
        out = {key: {**model, "mmr": True} for key, model in out.items()}
    return out


def _described(experiment: Experiment, lists: DataFrame) -> DataFrame:
    facts = experiment.dataset.items.select("item_id", "title", "year", "genres")
    return lookup(lists, facts, "item_id", "user_id", experiment.cfg.scale)


def recommend_users(experiment: Experiment, users: DataFrame, n_users: int, keys: list[str], k: int,
                    diversify: bool = False) -> DataFrame:
    """Top k for a table of known ``user_id``: item facts, contribution and weight of each signal,
    and whether the user liked the item in the test period (``hit``)."""
    state = experiment.user_state.join(users.select("user_id").distinct(), "user_id", "left_semi")
    lists = experiment.workspace.stage(scorer.rank_users(
        state, n_users, experiment.catalog, experiment.moments, chosen_models(experiment, keys, diversify), k,
        experiment.cfg, experiment.workspace, experiment.marks, parts=True), "recommended")
    return _described(experiment, lists)


def recommend_new_users(experiment: Experiment, requests: DataFrame, ratings: DataFrame, keys: list[str], k: int,
                        diversify: bool = False) -> DataFrame:
    """Top k for people outside the training data.

    ``requests``: request_id, gender, age (both may be NULL). ``ratings``: request_id, item_id,
    rating; repeated items of a request are summed, like in training. The factor vector is
    folded in against fixed item vectors and the profile is built from the given ratings.
    """
    cfg, stage = experiment.cfg, experiment.workspace.stage
    requests = stage(requests, "requests")
    pairs = stage(interactions.collapse(ratings.withColumnRenamed("request_id", "user_id")), "request-pairs")
    stats = stage(requests.select(F.col("request_id").alias("user_id")).distinct().join(
        pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_user")), "user_id", "left")
        .select("user_id", F.coalesce("n_user", F.lit(0)).cast("long").alias("n_user")), "request-stats")
    n_requests, n_pairs = stats.agg(F.count(F.lit(1)), F.sum("n_user")).first()
    by_request = als.rating_blocks(pairs, n_pairs or 0, cfg.scale, experiment.workspace, "user_id", "item_id", stats, "n_user")
    folded = als.fold_in(by_request, experiment.factors, cfg.als)
    profiles = content.user_profiles(by_request, experiment.features, cfg.scale)
    segments = requests.select(F.col("request_id").alias("user_id"),
                               buckets.segment(F.col("gender"), F.col("age")).alias("segment")).filter("segment IS NOT NULL")
    state = stage(assemble_users(stats, segments, experiment.segments, profiles, experiment.features.dims, folded,
                                 cfg.als.factors), "request-state")
    marks = pairs.select("user_id", "item_id", F.lit("seen").alias("kind"))
    lists = stage(scorer.rank_users(state, n_requests, experiment.catalog, experiment.moments,
                                    chosen_models(experiment, keys, diversify), k, cfg, experiment.workspace, marks,
                                    parts=True), "recommended-new")
    return _described(experiment, lists).withColumnsRenamed({"user_id": "request_id", "n_train": "history_size"})


def mean_weights(experiment: Experiment, mode: str = "adaptive") -> DataFrame:
    """(user_id, n_user, mean weight of each signal), items averaged by how often they are rated."""
    cfg = experiment.cfg
    shares = weights.watched_shares(experiment.item_stats, cfg.blend, cfg.split.cold_below)
    mean = weights.mean_weights(F.col("n_user"), shares, cfg.blend, mode, cfg.split.cold_below)
    return experiment.user_stats.select("user_id", "n_user", *[mean[s].alias(f"{s}_weight") for s in weights.SIGNALS])


def user_history(experiment: Experiment, rows: int = HISTORY_ROWS) -> DataFrame:
    """The ``rows`` highest rated training items of each user, lowest id first on ties."""
    top = first_per_group(experiment.train_pairs, ["user_id"], [F.col("rating").desc(), F.col("item_id")], rows)
    facts = (experiment.dataset.items.select("item_id", "title", "year")
             .join(experiment.item_stats, "item_id"))
    return lookup(experiment.workspace.stage(top, "history"), facts, "item_id", "user_id", experiment.cfg.scale)


def user_summary(experiment: Experiment) -> DataFrame:
    """(user_id, n_ratings, liked_later, gender, age label)."""
    liked = experiment.liked.groupBy("user_id").agg(F.count(F.lit(1)).alias("liked_later"))
    out = experiment.user_stats.join(liked, "user_id", "left").select(
        "user_id", F.col("n_user").alias("n_ratings"), F.coalesce("liked_later", F.lit(0)).alias("liked_later"))
    if experiment.dataset.users is None:
        return out
    profile = experiment.dataset.users.select("user_id", "gender", buckets.age_label(F.col("age")).alias("age"))
    return out.join(profile, "user_id", "left")


def _pieces(column: Column, width: int) -> Column:
    """The distinct pieces of ``width`` characters of a string (none if it is shorter)."""
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.length(column) - (width - 1), F.lit(1))), lambda i: i + (width - 1) <= F.length(column))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(column, i, F.lit(width))))


def search(experiment: Experiment, queries: DataFrame, rows: int = SEARCH_ROWS) -> DataFrame:
    """(query, rank, item_id, title, n_item): titles that contain the query, most rated first.

    ``queries``: distinct ``query`` strings; below two characters they find nothing. A title that
    contains a query contains all its pieces of three characters (two for a query of two), so titles and
    queries meet on the rarest piece of the query instead of every title meeting every query.
    """
    cfg, stage = experiment.cfg, experiment.workspace.stage
    titles = experiment.dataset.items.select("item_id", "title").filter(F.length("title") >= 2)
    lowered = F.lower("title")
    pieces = stage(titles.select("item_id", "title", F.explode(F.concat(_pieces(lowered, 2), _pieces(lowered, 3))).alias("piece")), "title-pieces")
    sizes = stage(pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("n")), "piece-sizes")
    needle = F.lower(F.trim("query"))
    asked = queries.filter(F.length(needle) >= 2)
    own = F.when(F.length(needle) >= 3, _pieces(needle, 3)).otherwise(_pieces(needle, 2))
    rarest = (asked.select("query", F.explode(own).alias("piece"))
              .join(sizes, "piece", "left").groupBy("query")
              .agg(F.min_by("piece", F.struct(F.coalesce("n", F.lit(0)), F.col("piece"))).alias("piece")))
    # Both sides may have many rows of a piece; adaptive execution splits such a join.
    met = (pieces.join(rarest, "piece").select("item_id", "title", "query")
           .filter(text.contains_text(F.col("title"), F.col("query"))))
    counted = lookup(stage(met, "matches"), experiment.item_stats, "item_id", "query", cfg.scale)
    return first_per_group(counted, ["query"], [F.col("n_item").desc(), F.col("item_id")], rows)


def example_users(experiment: Experiment) -> DataFrame:
    """For each history level the middle user (by id) among those with a liked test item."""
    n = F.col("n_user")
    levels = F.array(*[F.when(n == at if at < 5 else n >= at, F.lit(label)) for label, at in EXAMPLES])
    pool = (experiment.user_stats.join(experiment.liked.select("user_id").distinct(), "user_id", "left_semi")
            .select("user_id", "n_user", F.explode(F.array_compact(levels)).alias("label")))
    placed = with_position(experiment.workspace.stage(pool, "example-pool"), ["label"], ["user_id"], experiment.limit)
    return placed.filter(F.col("_pos") == F.floor(F.col("_size") / 2)).select(
        "label", "user_id", F.col("n_user").alias("ratings"))


def meta(experiment: Experiment) -> DataFrame:
    """One row of data-set facts: sizes, settings, the models a request may name, age groups (value, label) and example
    users (label, user_id, ratings; fewest ratings first)."""
    sizes, blend = experiment.sizes, experiment.cfg.blend
    examples = example_users(experiment).agg(F.sort_array(F.collect_list(F.struct("ratings", "label", "user_id"))).alias("examples"))
    ages = [F.struct(F.lit(value).alias("value"), F.lit(label).alias("label")) for value, label in sorted(buckets.AGE_LABELS.items())]
    # One row each, and at most five examples.
    return experiment.item_stats.agg(
        F.lit(experiment.cfg.dataset).alias("dataset"), F.lit(sizes["n_users"]).alias("users"),
        F.count(F.lit(1)).alias("items"), F.sum("n_item").alias("train_ratings"),
        F.lit(experiment.dataset.users is not None).alias("demographics"),
        F.lit(blend.k_user).alias("k_user"), F.lit(blend.k_item).alias("k_item"), F.lit(blend.k_content).alias("k_content"),
        F.lit(sorted(MODEL_KEYS)).alias("models"), F.array(*ages).alias("age_groups")).join(F.broadcast(examples), F.lit(True))


def validate_requests(experiment: Experiment, requests: DataFrame, ages=tuple(buckets.AGE_LABELS),
                      genders=GENDERS) -> DataFrame:
    """(request_id, valid, errors) for a table of requests.

    ``requests``: request_id, model, k, user_id STRING (NULL for a new user), ratings
    ARRAY<STRUCT<item_id LONG, rating DOUBLE>>, gender, age. Ratings, gender and age are
    checked for new users only.
    """
    cfg, stage = experiment.cfg, experiment.workspace.stage
    requests = stage(requests.withColumn("_user", F.expr("try_cast(trim(user_id) AS bigint)")),
                     "raw-requests")
    known_users = experiment.user_stats.select(F.col("user_id").alias("_user"), F.lit(True).alias("_known"))
    # Only requests with a user id take part in the join, so that no task gets all NULL keys.
    known = lookup(requests.filter(F.col("_user").isNotNull()).select("request_id", "_user"), known_users, "_user",
                   "request_id", cfg.scale).select("request_id", "_known")
    # The joins by request carry no ratings.
    narrow = requests.withColumn("_n_ratings", F.size("ratings")).drop("ratings")
    rows = narrow.join(known, "request_id", "left")
    given = stage(requests.filter("user_id IS NULL").select("request_id", F.explode("ratings").alias("r"))
                  .select("request_id", F.col("r.item_id").alias("item_id"), F.col("r.rating").alias("rating")), "given")
    known_items = experiment.item_stats.select("item_id", F.lit(True).alias("_in_catalog"))
    checked = (lookup(given, known_items, "item_id", "request_id", cfg.scale, "left")
               .groupBy("request_id").agg(F.bool_or(F.col("item_id").isNull() | F.col("rating").isNull()).alias("_bad_entry"),
                                          F.bool_or(F.col("item_id").isNotNull() & F.col("_in_catalog").isNull()).alias("_unknown_item"),
                                          F.bool_or(~F.col("rating").between(RATING_LOW, RATING_HIGH)).alias("_bad_range")))
    rows = rows.join(checked, "request_id", "left")
    new = F.col("user_id").isNull()
    wrong = [("unknown_model", ~F.col("model").isin(*MODEL_KEYS)),
             ("bad_k", ~F.col("k").between(1, MAX_K)),
             ("bad_user_id", ~new & F.col("_user").isNull()),
             ("unknown_user", F.col("_user").isNotNull() & F.col("_known").isNull()),
             ("too_many_ratings", new & (F.col("_n_ratings") > MAX_RATINGS)),
             ("bad_entry", F.col("_bad_entry")),
             ("unknown_item", F.col("_unknown_item")),
             ("rating_range", F.col("_bad_range")),
             ("bad_gender", new & F.col("gender").isNotNull() & ~F.col("gender").isin(*genders)),
             ("bad_age", new & F.col("age").isNotNull() & ~F.col("age").isin(*ages))]
    errors = F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in wrong]))
    return rows.select("request_id", (F.size(errors) == 0).alias("valid"), errors.alias("errors"))
