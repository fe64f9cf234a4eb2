"""Operators for preparing training text.

Thirteen operators (near-duplicate, licence, personal-data, repeated-passage, quality, URL,
mixing, packing, language-model, exact-duplicate, manifest, fingerprint and vector-code
operators). Nothing else in the library imports this package; its queries are listed in
``lakeward.llm.queries``.
"""
