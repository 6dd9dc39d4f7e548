"""Operators for training-data pipelines (token counts, licences, deduplication, packing, filters, archives)."""
