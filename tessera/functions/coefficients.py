"""Strassen's coefficient tables.

Quadrants are numbered ``q = 2·qi + qj`` (11 → 0, 12 → 1, 21 → 2, 22 → 3) and
the seven products ``p = 1..7``.  A product's left operand is
``Σ α[p][q]·A_q``, its right operand ``Σ β[p][q]·B_q``, and each result
quadrant is ``C_q = Σ γ[p][q]·M_p``.
"""

from __future__ import annotations

# Strassen's seven products, as (quadrant, weight) pairs.
#   M1 = (A11 + A22)(B11 + B22)      C11 = M1 + M4 - M5 + M7
#   M2 = (A21 + A22) B11             C12 = M3 + M5
#   M3 = A11 (B12 - B22)             C21 = M2 + M4
#   M4 = A22 (B21 - B11)             C22 = M1 - M2 + M3 + M6
#   M5 = (A11 + A12) B22
#   M6 = (A21 - A11)(B11 + B12)
#   M7 = (A12 - A22)(B21 + B22)
ALPHA = {
    1: ((11, 1), (22, 1)),
    2: ((21, 1), (22, 1)),
    3: ((11, 1),),
    4: ((22, 1),),
    5: ((11, 1), (12, 1)),
    6: ((21, 1), (11, -1)),
    7: ((12, 1), (22, -1)),
}
BETA = {
    1: ((11, 1), (22, 1)),
    2: ((11, 1),),
    3: ((12, 1), (22, -1)),
    4: ((21, 1), (11, -1)),
    5: ((22, 1),),
    6: ((11, 1), (12, 1)),
    7: ((21, 1), (22, 1)),
}
GAMMA = {
    1: ((11, 1), (22, 1)),
    2: ((21, 1), (22, -1)),
    3: ((12, 1), (22, 1)),
    4: ((11, 1), (21, 1)),
    5: ((11, -1), (12, 1)),
    6: ((22, 1),),
    7: ((11, 1),),
}

PATH_BASE = 8  # one octal digit per level; digits are 1..7


def quadrant_index(code: int) -> int:
    """11 → 0, 12 → 1, 21 → 2, 22 → 3."""
    return 2 * (code // 10 - 1) + (code % 10 - 1)


def by_quadrant(table: dict) -> list[list[tuple[int, int]]]:
    """Invert an operand table: for each quadrant index, the (product, weight) pairs using it."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(4)]
    for p, terms in sorted(table.items()):
        for code, w in terms:
            out[quadrant_index(code)].append((p, w))
    return out


def by_product(table: dict) -> list[list[tuple[int, int]]]:
    """For each product p (index p, slot 0 unused), the (quadrant index, weight) pairs."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(PATH_BASE)]
    for p, terms in sorted(table.items()):
        out[p] = [(quadrant_index(code), w) for code, w in terms]
    return out


def by_result() -> list[list[tuple[int, int]]]:
    """For each result quadrant index, the (product, weight) pairs that sum to it."""
    return by_quadrant(GAMMA)
