from wattlane.streaming.jobs import (
    batch_sink, clean_stream, dedupe_stream, read_batches, run_available, run_batches, score_batches, score_stream, window_mean,
)

__all__ = ["batch_sink", "clean_stream", "dedupe_stream", "read_batches", "run_available", "run_batches", "score_batches",
           "score_stream", "window_mean"]
