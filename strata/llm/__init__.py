"""Operators for preparing language-model training data.

Thirteen operators, one module each, and the queries that apply them to the test
tables (``queries``).  Nothing outside this subpackage imports it.
"""
