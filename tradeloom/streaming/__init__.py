from tradeloom.streaming.refresh import refresh_stream

__all__ = ["refresh_stream"]
