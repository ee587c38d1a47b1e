"""Training-data operators: licence and secret scans, language-model scoring,
set-similarity joins, decontamination, repeated-substring removal, exact
deduplication, quality classification, tokenisation and token counts.

Nothing outside this subpackage imports it.  Each operator module exposes a
general function over any frame with an id and a text column;
:mod:`zonage.llm.queries` registers one query per operator.
"""
