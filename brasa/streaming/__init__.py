from brasa.streaming.incremental import FactStream, start_fact_stream  # noqa: F401
