"""Training-data operators: deduplication, filtering, mixing, packing, search, archives.

Nothing outside this subpackage imports it.
"""
