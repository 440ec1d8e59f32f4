"""Models. Functions that run inside Python workers travel by value, so the
package needs to be installed on the driver only."""

from pyspark import cloudpickle

import riskloom

cloudpickle.register_pickle_by_value(riskloom)
