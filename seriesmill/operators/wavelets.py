"""Orthogonal wavelet filters by spectral factorisation.

A filter with p vanishing moments is (1 + z)^p times a factor whose squared size is a known polynomial.  Of each pair of
its roots z and 1 / z the filter takes one: the inner ones make the Daubechies wavelets, the choice whose phase is
nearest to a line makes the symlets.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from typing import NamedTuple

import numpy as np

# Families with their numbers of vanishing moments, and another name of the first one.
FAMILIES = {"db": range(1, 11), "sym": range(2, 9)}
OTHER_NAMES = {"haar": "db1"}
# Fixed value: of the two mirrored filters of a symlet, tables list the one with the later centre, but for these the earlier.
EARLY_SYMLETS = (7,)


class Wavelet(NamedTuple):
    """Filters as ``analyse`` applies them: the low one from its largest delay on."""

    low: np.ndarray
    high: np.ndarray

    @property
    def taps(self) -> int:
        return len(self.low)

    @property
    def halo(self) -> int:
        """Coefficients before the first one that a sample of the next level up needs."""
        return self.taps // 2 - 1


def names() -> list[str]:
    return [*OTHER_NAMES, *(f"{family}{p}" for family, moments in FAMILIES.items() for p in moments)]


def _inner_roots(moments: int) -> list[list[complex]]:
    """Roots of the factor inside the unit circle, conjugates together."""
    terms = np.array([math.comb(moments - 1 + k, k) for k in reversed(range(moments))], dtype="float64")
    y = np.roots(terms).astype(complex)
    for _ in range(4):  # polished by Newton's method
        y = y - np.polyval(terms, y) / np.polyval(np.polyder(terms), y)
    middle = 1 - 2 * y
    z = middle + np.sqrt(middle * middle - 1)
    z = np.where(np.abs(z) < 1, z, 1 / z)
    alone = [[complex(v.real)] for v in z if abs(v.imag) < 1e-9]
    return alone + [[v, v.conjugate()] for v in z if v.imag >= 1e-9]


def _product(roots: list[complex]) -> np.ndarray:
    return functools.reduce(np.convolve, [np.array([1, -z]) for z in roots], np.ones(1, dtype=complex)).real


def _bend(factor: np.ndarray) -> float:
    """Squared distance of the phase from its best line through zero."""
    turn = np.linspace(0, np.pi, 1025)[1:-1]
    values = np.exp(-1j * np.outer(turn, np.arange(len(factor)))) @ (factor * np.sign(factor.sum()))
    phase = np.unwrap(np.angle(values))
    return float(np.sum((phase - turn * (turn @ phase) / (turn @ turn)) ** 2))


def _centre(taps: np.ndarray) -> float:
    return float(np.arange(len(taps)) @ taps**2 / (taps @ taps))


@functools.cache
def wavelet(name: str) -> Wavelet:
    """Filters of haar, db1 to db10 and sym2 to sym8; any other name is an error."""
    found = re.fullmatch(r"(db|sym)(\d+)", OTHER_NAMES.get(name, name))
    if not found or int(found[2]) not in FAMILIES[found[1]]:
        raise ValueError(f"no wavelet {name!r}; there are {', '.join(names())}")
    moments = int(found[2])
    pairs = _inner_roots(moments)
    factor = _product(sum(pairs, []))
    if found[1] == "sym" and moments > 3:  # below, all choices are mirror images
        picks = itertools.product((False, True), repeat=len(pairs))
        choices = [_product([1 / z if out else z for out, pair in zip(pick, pairs) for z in pair]) for pick in picks]
        factor = min(choices, key=_bend)
    low = np.convolve(factor, _product([-1.0] * moments))
    if found[1] == "sym" and moments > 3 and (_centre(low) < _centre(low[::-1])) != (moments in EARLY_SYMLETS):
        low = low[::-1]
    low = low * (math.sqrt(2) / low.sum())
    return Wavelet(low, low[::-1] * (-1.0) ** np.arange(len(low)))
