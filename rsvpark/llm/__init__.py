"""Training-data operators: near-duplicate joins, quality and toxicity models,
decontamination, archives, span removal, placement, mixing, page extraction.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames, reads only the columns it names (extra columns are ignored) and
keeps intermediate tables under the session's shared checkpoint folder.
"""
