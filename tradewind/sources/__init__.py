from tradewind.sources.drops import (
    drop_documents,
    read_amazon,
    read_distributor,
    read_pos,
    read_shopify,
    split_recognised,
)
from tradewind.sources.lake import (
    feature_source,
    is_available,
    load_table,
    register_view,
)
from tradewind.sources.meta import stamp, with_ingest_meta

__all__ = [
    "drop_documents",
    "feature_source",
    "is_available",
    "load_table",
    "read_amazon",
    "read_distributor",
    "read_pos",
    "read_shopify",
    "register_view",
    "split_recognised",
    "stamp",
    "with_ingest_meta",
]
