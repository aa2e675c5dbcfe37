"""Operators for building training corpora: sharding, language labels, quality
rules, token counts, token files, web archives, decontamination, subword
encoding, near duplicates, language-model scores, byte-pair coding, whitening
and vector codes.

Nothing else in the library imports this subpackage. Python functions that
run in tasks are shipped by value, so workers need no installed package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
