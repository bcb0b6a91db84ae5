"""Operators for large-scale training-data preparation; nothing else in the library imports this package.

The functions that run inside tasks are pickled by value, so executors need numpy, pyarrow and
the tokenizer libraries, but not this package.
"""

from vecforge.shipping import by_value

by_value(__name__)
