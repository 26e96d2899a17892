"""Training-data operators (URL reputation, top-k search, language ID, source mixing,
substring dedup, quality rules, secret scan, near-dup, BPE, LM scoring).

Nothing outside this subpackage imports it. Shared conventions:

* operators read only the columns they name, so extra columns never clash;
* a null text is an empty text; an empty table gives an empty result of the same schema;
* intermediate tables that cut lineage are parquet under ``spark.checkpoint.dir``.
"""
