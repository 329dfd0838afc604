"""Structured Streaming forms of the stateless operators."""

from hearth.streaming.stream import DISTRICT_SCHEMA, classify, district_stream, in_box, in_income_range, run_available, score_micro_batches, score_stream

__all__ = ["DISTRICT_SCHEMA", "classify", "district_stream", "in_box", "in_income_range", "run_available", "score_micro_batches", "score_stream"]
