"""Every operator of this package as a query, next to its SQL where there is one."""

from lakepipe.llm import (
    byte_bpe,
    conversations,
    decontamination,
    exact_dedup,
    jaccard_join,
    language_id,
    line_dedup,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    token_files,
    toxicity,
)

MODULES = (
    line_dedup,
    substring_dedup,
    decontamination,
    toxicity,
    exact_dedup,
    jaccard_join,
    byte_bpe,
    sharding,
    token_files,
    language_id,
    simhash,
    conversations,
    spelling,
)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
