"""opinio — review analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function or a ``Column``
builder; composed plans live in :mod:`opinio.plans`.
"""

__version__ = "0.1.0"
