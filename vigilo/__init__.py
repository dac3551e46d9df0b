"""vigilo — entity early-warning risk analytics on Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` function (or a Spark ML
estimator) so Catalyst can prune, push down and fuse the whole lineage.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value inside Spark closures.

    Python UDFs / applyInPandas functions defined here then run on executors
    that do not have the package installed (no --py-files needed).
    """
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: fall back to by-reference
        pass


_ship_by_value()
