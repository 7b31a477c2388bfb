"""Counting quotient filters over 64-bit fingerprints, as numpy arrays.

A fingerprint is cut into a quotient (its high bits) and a remainder. The filter keeps, in the order
of the fingerprints, each distinct remainder with its count; one bit per quotient says whether it
occurs, one bit per remainder whether it ends the run of its quotient. Nothing is lost: the
fingerprints can be listed again, and filters merge by their sorted remainders.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class QuotientFilter:
    quotient_bits: int
    occupied: np.ndarray  # bool per quotient
    run_end: np.ndarray  # bool per entry
    remainders: np.ndarray  # uint64 per entry, ascending within a run
    counts: np.ndarray  # int64 per entry

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray, value_bits: int) -> QuotientFilter:
        """From fingerprints of ``value_bits`` bits in any order; equal ones add their counts.
        There are about as many quotients as entries."""
        order = np.argsort(fingerprints, kind="stable")
        values, counts = fingerprints[order], counts[order]
        first = np.ones(len(values), bool)
        first[1:] = values[1:] != values[:-1]
        counts = np.add.reduceat(counts, np.flatnonzero(first)) if len(values) else counts
        values = values[first]
        quotient_bits = min(max(1, len(values).bit_length()), value_bits)
        shift = np.uint64(value_bits - quotient_bits)
        quotients = (values >> shift).astype(np.int64)
        occupied = np.zeros(1 << quotient_bits, bool)
        occupied[quotients] = True
        run_end = np.ones(len(values), bool)
        run_end[:-1] = quotients[1:] != quotients[:-1]
        return cls(quotient_bits, occupied, run_end, values & ((np.uint64(1) << shift) - np.uint64(1)),
                   counts.astype(np.int64))

    def fingerprints(self, value_bits: int) -> np.ndarray:
        """All distinct fingerprints, ascending."""
        run = np.cumsum(self.run_end) - self.run_end
        quotients = np.flatnonzero(self.occupied)[run].astype(np.uint64)
        return (quotients << np.uint64(value_bits - self.quotient_bits)) | self.remainders

    def packed(self) -> tuple[int, bytes, bytes, bytes, bytes]:
        return (self.quotient_bits, np.packbits(self.occupied).tobytes(), np.packbits(self.run_end).tobytes(),
                self.remainders.tobytes(), self.counts.tobytes())

    @classmethod
    def unpacked(cls, quotient_bits: int, occupied: bytes, run_end: bytes, remainders: bytes,
                 counts: bytes) -> QuotientFilter:
        rest = np.frombuffer(remainders, np.uint64)

        def bits(packed: bytes, n: int) -> np.ndarray:
            return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)

        return cls(quotient_bits, bits(occupied, 1 << quotient_bits), bits(run_end, len(rest)), rest,
                   np.frombuffer(counts, np.int64))


def merged(filters: list[QuotientFilter], value_bits: int) -> QuotientFilter:
    """One filter with the entries of all, their counts added."""
    return QuotientFilter.of(
        np.concatenate([f.fingerprints(value_bits) for f in filters]),
        np.concatenate([f.counts for f in filters]), value_bits)
