"""From raw visits to churn features, hybrid vectors, neighbour predictions and their report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import (
    CHURN_NAMES, FIELD_LABELS, OTHER_TIER, TEXT_SEPARATOR, TIER_NAMES, UNIFIED_TYPES, labelled, named_bin, pack_key,
)
from ..functions.vectors import as_doubles, fuse, unit
from ..operators.counts import StageCounts, counted
from ..operators.evaluate import classification_report, prediction_table, vote
from ..operators.features import churn_label, stratified_split, visit_features
from ..operators.intervals import visit_intervals
from ..operators.neighbours import nearest_neighbours
from ..operators.profile import customer_profile
from ..operators.retrieval import fit_vocabulary, vocabulary_vector
from ..operators.scaling import auto_scale
from ..operators.visits import INTERNAL_TYPES, PASSIVE_TYPES, active_entities, clean_visits, history, split_date
from ..session import materialize
from ..sources.schemas import NUMERIC_FEATURES

def churn_features(
    visits: DataFrame, vehicles: DataFrame, members: DataFrame, purchases: DataFrame, as_of: date,
    internal: str = INTERNAL_TYPES, passive: str = PASSIVE_TYPES,
    rules: Sequence[tuple[str, str]] = tuple(UNIFIED_TYPES), inactive: str = "drop", counts: StageCounts | None = None,
) -> DataFrame:
    """Labelled feature row per entity, as one lazy plan.

    Raw visits are shuffled once combined per day, then once by entity; every window, join and
    aggregation after that runs on the entity partitioning. The split date is a scalar subquery. ``counts`` counts
    the rows of the stages visits, intervals and features in the job that runs the plan.
    """
    profile = customer_profile(vehicles, members, purchases)
    split = split_date(active_entities(visits, profile, internal, passive))
    past = history(clean_visits(visits, profile, internal, passive, rules, ["purchase_date"]), split)
    intervals = counted(visit_intervals(counted(past, counts, "visits")), counts, "intervals")
    features = visit_features(intervals, profile, split, as_of, inactive)
    return counted(churn_label(features, split), counts, "features")


def labelled_dataset(features: DataFrame, valid_fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Features with a train/valid mark. The features are written once and read for every pass."""
    written = materialize(features, "features")
    return stratified_split(written, "churn_label", "entity_id", valid_fraction, seed)


def text_features(features: DataFrame) -> DataFrame:
    """Labelled display texts, the joined text feature, the label text and the packed key."""
    texts = {
        "last_repair_type": labelled(FIELD_LABELS["last_repair_type"], F.array_join("last_visit_types", ";")),
        "all_repair_types": labelled(FIELD_LABELS["all_repair_types"], F.array_join("all_visit_types", ";")),
        "owner_type": labelled(FIELD_LABELS["owner_type"], F.col("owner_type")),
        "car_mode": labelled(FIELD_LABELS["car_mode"], F.col("car_mode")),
        "car_level": named_bin(F.col("car_level"), TIER_NAMES, OTHER_TIER),
        "member_level": labelled(FIELD_LABELS["member_level"], F.col("member_level")),
    }
    return features.withColumns(texts).withColumns({
        "text_feature": F.concat_ws(TEXT_SEPARATOR, *texts),
        "label_txt": named_bin(F.col("churn_label"), CHURN_NAMES),
        "key_label": pack_key(F.col("entity_id"), F.col("churn_label")),
    })


def hybrid_vectors(
    features: DataFrame, text_vector: str | None = None, numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
    text_weight: float = 0.3, number_weight: float = 0.7,
) -> DataFrame:
    """Scale the numeric features, fuse them with the text vector and normalise: adds ``vector``.

    ``text_vector`` names an embedding column; without one the vector holds the numeric part only.
    """
    scaled = auto_scale(features, list(numeric))
    text = as_doubles(F.col(text_vector)) if text_vector else F.array().cast("array<double>")
    return scaled.withColumn("vector", unit(fuse(text, [F.col(c) for c in numeric], text_weight, number_weight)))


def knn_churn(
    vectors: DataFrame, k: int = 10, threshold: float = 0.4, key: str = "entity_id", label: str = "churn_label",
    min_similarity: float | None = None, **sizes: int,
) -> DataFrame:
    """Predictions for the ``valid`` rows from the votes of their nearest ``train`` rows."""
    train = vectors.where(F.col("dataset") == "train").select(F.col(key).alias("base_id"), "vector", F.col(label).alias("label"))
    valid = vectors.where(F.col("dataset") == "valid").select(F.col(key).alias("query_id"), "vector", F.col(label).alias("true_label"))
    neighbours = nearest_neighbours(valid.drop("true_label"), train, k, ["label"], min_similarity, **sizes)
    # a row without a neighbour (none similar enough, no vector, no train rows) still gets its zero vote
    truth = valid.select("query_id", "true_label")
    votes = truth.select("query_id").join(vote(neighbours, k=k, threshold=threshold), "query_id", "left").fillna(0, ["total_score", "pred_label"])
    return prediction_table(votes, truth)


def churn_report(predictions: DataFrame) -> DataFrame:
    return classification_report(predictions)


def text_vectors(features: DataFrame, text: str = "text_feature") -> DataFrame:
    """Add ``text_vector``: TF-IDF of the text feature over all its terms, for tables that bring no embedding."""
    return features.withColumn("text_vector", vocabulary_vector(F.col(text), fit_vocabulary(features, text)))
