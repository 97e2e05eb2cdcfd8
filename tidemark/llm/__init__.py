"""Training-data operators: dedup, rules, packing, mixing, privacy, language, licences, similarity, scoring, tokens,
conversations, vector codes, archives.

Nothing else in the library imports this subpackage.
"""
