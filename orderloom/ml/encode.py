"""Categories to indicator vectors, and the model table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, RFormula, RFormulaModel, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from orderloom.operators.clean import quoted
from orderloom.operators.items import AMOUNT_PREFIX, AVERAGED_MEASURES
from orderloom.operators.orders import TIMES

INDEX, DUMMY = "_Ind", "_dum"

# Categorical columns with the stem their encoded columns are named by.
ORDER_CATEGORICALS = {
    "order_status": "order_status",
    "DeliveryTimeStatus": "DeliveryTimeStatus",
    "order_time_of_day": "order_time_of_day",
    "order_purchase_weekend_or_weekday": "order_purchase_weekend_or_weekday",
    "delivery_time_of_day": "delivery_time_of_day",
    "order_delivered_weekend_or_weekday": "order_delivered_weekend_or_weekday",
}
PAYMENT_CATEGORICALS = {
    "payment_type": "payment_type",
    "max_payment_sequential": "payment_sequential",
    "max_payment_installments": "payment_installments",
}
CATEGORICALS = {**ORDER_CATEGORICALS, **PAYMENT_CATEGORICALS}

# Product categories of the original files that have a model column.
RETAIL_CATEGORIES = (
    "agro_industry_and_commerce", "air_conditioning", "art", "arts_and_craftmanship", "audio",
    "auto", "baby", "bed_bath_table", "books_general_interest", "books_imported",
    "books_technical", "cds_dvds_musicals", "christmas_supplies", "computers",
    "computers_accessories", "consoles_games", "construction_tools_construction",
    "construction_tools_lights", "construction_tools_safety", "cool_stuff",
    "costruction_tools_garden", "costruction_tools_tools", "diapers_and_hygiene", "drinks",
    "dvds_blu_ray", "electronics", "fashio_female_clothing", "fashion_bags_accessories",
    "fashion_childrens_clothes", "fashion_male_clothing", "fashion_shoes", "fashion_sport",
    "fashion_underwear_beach", "fixed_telephony", "flowers", "food", "food_drink", "furniture",
    "furniture_bedroom", "furniture_decor", "furniture_living_room",
    "furniture_mattress_and_upholstery", "garden_tools", "health_beauty", "home_appliances",
    "home_appliances_2", "home_comfort_2", "home_confort", "home_construction", "housewares",
    "industry_commerce_and_business", "kitchen", "luggage_accessories", "market_place", "music",
    "musical_instruments", "office_furniture", "party_supplies", "perfumery", "pet_shop", "print",
    "security_and_services", "signaling_and_security", "small_appliances",
    "small_appliances_home_oven_and_coffee", "sports_leisure", "stationery", "telephony", "toys",
    "watches_gifts",
)
# The two categories among the ten strongest features.
STRONG_CATEGORIES = ("fashion_male_clothing", "fixed_telephony")


def encoder(
    categoricals: Mapping[str, str] = CATEGORICALS, unseen: str = "error"
) -> Pipeline:
    """Frequency index, then indicators without the last category.

    Index 0 is the most frequent value; equal counts go in text order. With
    ``unseen="keep"`` there is one more category for values the fit did not see,
    so scoring data with new values gets vectors of the training size.
    """
    stems = list(categoricals.values())
    indexes = [stem + INDEX for stem in stems]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(categoricals), outputCols=indexes, handleInvalid=unseen),
        OneHotEncoder(inputCols=indexes, outputCols=[stem + DUMMY for stem in stems]),
    ])


def encode(basetable: DataFrame, fitted: PipelineModel) -> DataFrame:
    """Apply a fitted encoder and drop what the vectors replace, and the raw times."""
    indexer = fitted.stages[0]
    raw = indexer.getInputCols()
    return fitted.transform(basetable).drop(*raw, *indexer.getOutputCols(), *TIMES.values())


# The columns of the full model table, in order.
def model_columns(
    categories: Sequence[str] = RETAIL_CATEGORIES, labelled: bool = True
) -> list[str]:
    """Key, features and label of the full model table, in order."""
    return [
        "order_id",
        "estimated_delivery_days",
        "order_to_approval_days",
        "actual_delivered_days",
        *[stem + DUMMY for stem in CATEGORICALS.values()],
        "total_payment_value",
        "total_items",
        "total_price",
        "total_shipping_cost",
        "average_price",
        "average_shipping_cost",
        *[f"average_{name}" for name in AVERAGED_MEASURES],
        "total_amount",
        *[AMOUNT_PREFIX + name for name in categories],
        *(["label"] if labelled else []),
    ]


# The ten strongest features, in order.
def strong_columns(
    categories: Sequence[str] = STRONG_CATEGORIES, labelled: bool = True
) -> list[str]:
    """Key, the ten strongest features (two of them category amounts) and label."""
    first, second = [AMOUNT_PREFIX + name for name in categories]
    return [
        "order_id",
        "estimated_delivery_days",
        "total_items",
        "actual_delivered_days",
        "order_to_approval_days",
        "total_shipping_cost",
        first,
        "average_product_name_lenght",
        second,
        "payment_type_dum",
        "payment_installments_dum",
        *(["label"] if labelled else []),
    ]


def used_categoricals(names: Iterable[str]) -> dict[str, str]:
    """The categoricals whose indicators are among the model columns."""
    wanted = set(names)
    return {raw: stem for raw, stem in CATEGORICALS.items() if stem + DUMMY in wanted}


def raw_columns(basetable: DataFrame, names: Iterable[str]) -> list[str]:
    """The base-table columns that the model columns are made of."""
    names = list(names)
    return [name for name in names if name in basetable.columns] + list(used_categoricals(names))


def select_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*[F.col(quoted(name)) for name in names])


def fit_formula(train: DataFrame, formula: str = "label ~ . - order_id") -> RFormulaModel:
    """Fit on training rows only; the fitted formula serves every later table."""
    return RFormula(formula=formula).fit(train)


def assemble(df: DataFrame, key: str = "order_id", label: str = "label") -> DataFrame:
    """(key, features[, label]) with all other columns in one vector, in table order."""
    inputs = [name for name in df.columns if name not in (key, label)]
    kept = [name for name in (key, label) if name in df.columns]
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(df).select(*kept, "features")
