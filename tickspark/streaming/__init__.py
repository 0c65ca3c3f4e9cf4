"""Structured Streaming: message ingest and running VaR."""

from tickspark.streaming.ingest import compact_store, ingest_messages, message_stream
from tickspark.streaming.running_var import running_var, stream_var_approx, stream_var_exact

__all__ = ["compact_store", "ingest_messages", "message_stream", "running_var", "stream_var_approx", "stream_var_exact"]
