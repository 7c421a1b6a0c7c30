"""Operators for building large language-model training corpora.

Nothing outside this subpackage imports it.  ``registry`` lists its queries and
their SQL; every other module holds one operator.
"""
