"""Training-data operators: scoring, filtering, de-duplication, redaction, tokens.

One module per operator; ``queries`` registers the thin queries over the given
tables. Nothing outside this subpackage imports it.
"""
