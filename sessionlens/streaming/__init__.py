from sessionlens.streaming.ingest import ingest, prepare, stream_sessions

__all__ = ["ingest", "prepare", "stream_sessions"]
