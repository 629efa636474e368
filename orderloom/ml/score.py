"""Train on reviewed orders, score unreviewed ones."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import DataFrame, SparkSession

from orderloom.ml.encode import (
    STRONG_CATEGORIES,
    assemble,
    encode,
    encoder,
    raw_columns,
    select_columns,
    strong_columns,
    used_categoricals,
)
from orderloom.ml.models import fit_tree
from orderloom.ml.split import split_by_key
from orderloom.operators.basetable import fit_shared_stats, holdout_basetable, training_basetable, with_shared_items
from orderloom.operators.clean import quoted
from orderloom.operators.items import ItemStats
from orderloom.operators.orders import HOLDOUT_WINDOW, TRAINING_WINDOW
from orderloom.session import cut_lineage
from orderloom.sources.tables import OrderTables


@dataclass(frozen=True)
class Scorer:
    """Everything fitted on training data that evaluation and scoring need.

    Imputation, category columns, value indexes and the tree all come from the
    training tables, so a vector slot means the same in training, test and holdout,
    and the model that scores is the one that was evaluated.
    """

    stats: ItemStats
    encoding: PipelineModel
    tree: DecisionTreeClassificationModel
    categories: Sequence[str]

    def features(self, base: DataFrame) -> DataFrame:
        """(order_id, features, and label where the base table has one)."""
        names = strong_columns(self.categories, labelled="label" in base.columns)
        return assemble(select_columns(encode(base, self.encoding), names))

    def score(self, tables: OrderTables, window: tuple[str, str] = HOLDOUT_WINDOW) -> DataFrame:
        """(order_id, prediction) for every complete order of the window."""
        features = self.features(holdout_basetable(tables, self.stats, window))
        return self.tree.transform(features).select("order_id", "prediction")

    def save(self, path: str) -> None:
        """Write everything to a new folder: the statistics as text, encoder and tree as Spark stores models."""
        spark = SparkSession.active()
        told = json.dumps({"stats": asdict(self.stats), "categories": list(self.categories)})
        spark.createDataFrame([(told,)], "value string").coalesce(1).write.text(f"{path}/statistics")
        self.encoding.write().save(f"{path}/encoder")
        self.tree.write().save(f"{path}/tree")


def load_scorer(spark: SparkSession, path: str) -> Scorer:
    """A scorer as it was saved, in any later session."""
    told = json.loads(spark.read.text(f"{path}/statistics").first()["value"])
    stats = {name: tuple(value) if isinstance(value, list) else value for name, value in told["stats"].items()}
    return Scorer(
        ItemStats(**stats), PipelineModel.load(f"{path}/encoder"), DecisionTreeClassificationModel.load(f"{path}/tree"), tuple(told["categories"])
    )


def fit_with_test(
    tables: OrderTables,
    window: tuple[str, str] = TRAINING_WINDOW,
    categories: Sequence[str] = STRONG_CATEGORIES,
) -> tuple[Scorer, DataFrame]:
    """A scorer over the ten strongest features, and the test side it has not seen.

    Values are indexed over the whole base table, with a slot for others; the tree is
    fitted on the training side of the split by key.
    """
    tables = with_shared_items(tables)
    stats = fit_shared_stats(tables)
    names = strong_columns(categories)
    base = training_basetable(tables, stats, window)
    # indexing and growing the tree read the table again and again
    rows = cut_lineage(base.select(*[quoted(c) for c in raw_columns(base, names)]))
    encoding = encoder(used_categoricals(names), unseen="keep").fit(rows)
    train, test = split_by_key(assemble(select_columns(encode(rows, encoding), names)))
    return Scorer(stats, encoding, fit_tree(train), categories), test


def fit_scorer(
    tables: OrderTables,
    window: tuple[str, str] = TRAINING_WINDOW,
    categories: Sequence[str] = STRONG_CATEGORIES,
) -> Scorer:
    return fit_with_test(tables, window, categories)[0]
