"""Training-data operators: token counts, token files, packing, deduplication, filters, search, audits.

Nothing outside this subpackage imports it.
"""
