"""Make Python code that runs inside tasks available to executors.

Functions handed to ``applyInArrow`` are pickled on the driver. Registering their modules
for pickling by value means executors need only numpy and pyarrow, not this package
(``--py-files`` or an installed wheel work as well, and take precedence when present).
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def by_value(module_name: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
