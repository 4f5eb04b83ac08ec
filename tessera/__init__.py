"""tessera — matrix algebra on Spark tables.

A matrix is a DataFrame of ``(row INT, col INT, value DOUBLE|BIGINT)``
cells; every operator builds a lazy Spark plan and never collects data.
"""

from .matrix import (COO_BIGINT, COO_DOUBLE, Matrix, as_matrix, cell_count, compact, coo_schema,
                     transpose, validate, validation_report)
from .operators.elementwise import add, add_by_join, align, linear_combination, subtract
from .operators.multiply import find_hot_keys, gram, multiply
from .operators.quadrants import merge, split, split_tagged
from .operators.choose import choose_algorithm, product
from .operators.strassen import levels_for, operands, strassen

__all__ = [
    "COO_BIGINT", "COO_DOUBLE", "Matrix", "add", "add_by_join", "align", "as_matrix", "cell_count",
    "choose_algorithm", "compact", "coo_schema", "find_hot_keys", "gram", "levels_for", "linear_combination",
    "merge", "multiply", "operands", "product", "split", "split_tagged", "strassen", "subtract", "transpose",
    "validate", "validation_report",
]
