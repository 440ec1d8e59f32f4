"""Operators for training-data pipelines. Nothing else in the package imports
them; worker functions travel by value, as in ``riskloom.models``."""

from pyspark import cloudpickle

import riskloom

cloudpickle.register_pickle_by_value(riskloom)
