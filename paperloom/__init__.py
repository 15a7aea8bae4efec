"""Document intelligence on Spark DataFrames.

Texts come in as tables, are decoded, rendered into prompts and payloads,
cut into chunks, embedded, searched, screened against a content policy,
and evaluated; every step takes and returns DataFrames or Columns.
"""
