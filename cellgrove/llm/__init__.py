"""Training-data operators: formatting, packing, joins, filters and dedup for text corpora.

One module per operator; ``queries`` binds them to the driver's tables. Nothing outside this
subpackage imports it, so it can be deleted without touching the rest of the library.
"""
