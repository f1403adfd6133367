"""Training-data operators (one module per operator). Nothing else in the
library imports this subpackage."""

from pyspark import cloudpickle

import estatelake

# Workers of a cluster may not have this package on their path: its functions
# and classes travel by value.
cloudpickle.register_pickle_by_value(estatelake)
