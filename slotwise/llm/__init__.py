"""Operators for text and vector corpora: near duplicates, search, spans, packing, ids."""
