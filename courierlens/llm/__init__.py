"""Training-data operators: thirteen operators over documents, pages, embeddings and conversations, each in its own module.

Nothing else in the library imports this package. ``queries`` holds the
registered queries and their SQL.
"""

from pyspark import cloudpickle

import courierlens

# functions go to the executors with their code, so the package need not be installed there
cloudpickle.register_pickle_by_value(courierlens)
