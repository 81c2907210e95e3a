"""Feature views: latest row per entity in a window, and lookup by entity key."""

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import money_sum
from tradewind.operators.dedupe import dedupe_latest
from tradewind.operators.joins import split_join

EVENT, CREATED = "event_timestamp", "created_timestamp"


@dataclass(frozen=True)
class FeatureView:
    """Entity key columns, feature columns and how far back features stay valid."""

    name: str
    keys: tuple
    features: tuple
    ttl: timedelta = timedelta(days=90)

    def select(self, df: DataFrame) -> DataFrame:
        return df.select(*self.keys, *self.features, EVENT, CREATED)


CUSTOMER_FEATURES = FeatureView(
    "customer_features",
    ("customer_id",),
    ("customer_email", "total_orders", "total_spend", "preferred_channel"),
)
PRODUCT_FEATURES = FeatureView(
    "product_features", ("sku",), ("product_title", "units_sold", "total_sales_amount")
)


def _time(t) -> Column:
    return t if isinstance(t, Column) else F.lit(t)


def feature_snapshot(gold: DataFrame, event_ts, created_ts) -> DataFrame:
    """A gold mart with the event and created time its feature source needs."""
    return gold.drop("_processed_at").withColumns(
        {EVENT: _time(event_ts), CREATED: _time(created_ts)}
    )


def customer_snapshot(customers: DataFrame, as_of) -> DataFrame:
    """Features of every customer as the mart has them at ``as_of``."""
    return CUSTOMER_FEATURES.select(feature_snapshot(customers, as_of, as_of))


def product_snapshot(inventory: DataFrame, created_ts, event_ts=None) -> DataFrame:
    """Features of every SKU, folded from the day x SKU mart, as of its last sales day.

    With ``event_ts`` all SKUs have that event time instead, as the state of the mart at that time.
    """
    per_sku = inventory.groupBy("sku").agg(
        F.max_by("product_title", F.struct("sales_date", "product_title")).alias("product_title"),
        F.sum("units_sold").alias("units_sold"),
        money_sum("total_sales_amount").alias("total_sales_amount"),
        F.max("sales_date").try_cast("timestamp").alias("last_sale"),
    )
    event = F.col("last_sale") if event_ts is None else event_ts
    return PRODUCT_FEATURES.select(feature_snapshot(per_sku, event, created_ts))


def materialize(source: DataFrame, view: FeatureView, end, start=None) -> DataFrame:
    """Latest row per entity with an event time in [start, end], then by created time.

    ``start`` defaults to ``end`` minus the view's time to live.
    """
    end_at = _time(end)
    start_at = end_at - F.lit(view.ttl) if start is None else _time(start)
    window = view.select(source).filter(F.col(EVENT).between(start_at, end_at))
    return dedupe_latest(window, view.keys, (EVENT, CREATED))


def lookup_features(
    requests: DataFrame, online: DataFrame, keys: Sequence[str], features: Sequence[str]
) -> DataFrame:
    """Chosen features for every requested entity, null where the entity is unknown.

    The requested keys first cut the online table down. That semi join only streams the online
    table and broadcasts the keys if Spark finds them small enough, so a short request list
    does not shuffle a large table.
    """
    wanted = requests.select(*keys).distinct()
    hits = online.select(*keys, *features).join(wanted, list(keys), "left_semi")
    return split_join(requests, hits, keys, "left")
