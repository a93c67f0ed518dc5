"""The corpus operators' queries and SQL."""

from . import exact_dedup, html_main_text, katz, mixing, packing, passages, quality, secrets, simhash, token_files

MODULES = (katz, secrets, mixing, packing, quality, html_main_text, passages, exact_dedup, simhash, token_files)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
