"""Operators for preparing language-model training data.

One module per operator; `queries` registers them over the given tables and
`pipeline_stages` holds the functions the corpus pipeline strings together.
Nothing outside this package imports it.
"""
