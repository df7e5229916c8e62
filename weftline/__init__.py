"""weftline: chat and text datasets to fixed-length training examples, on Spark.

Every operator is a ``DataFrame -> DataFrame`` function or a ``Column`` builder;
nothing runs until the caller writes or collects.
"""

__version__ = "0.1.0"
