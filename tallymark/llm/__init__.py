"""Operators for preparing language-model training data.

Nothing outside of this folder imports it, apart from the driver contract and the
corpus pipeline at the repository's top.
"""
