from tradewind.streaming.ingest import (
    KAFKA_POS,
    stream_append,
    stream_documents,
    stream_pos,
    stream_rows,
)

__all__ = ["KAFKA_POS", "stream_append", "stream_documents", "stream_pos", "stream_rows"]
