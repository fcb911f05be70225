"""Sequences, CIGAR strings and pileup texts as column expressions."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def linker_place(seq: Column, linker: str, mismatches: int) -> Column:
    """0-based place at which a read is cut: the first exact copy of the linker, only without one the first with mismatches."""
    exact = F.instr(seq, linker)
    found = F.when(exact > 0, exact - 1)
    return F.coalesce(found, first_match(seq, linker, mismatches)) if mismatches else found


def first_match(seq: Column, linker: str, mismatches: int) -> Column:
    """0-based place of the first substring with at most so many mismatches, null if there is none.

    One regular expression holds every way to leave bases out; the leftmost match is the first place."""
    ways = {"".join("." if k in free else c for k, c in enumerate(linker)) for free in combinations(range(len(linker)), mismatches)}
    at = F.regexp_instr(seq, F.lit("|".join(sorted(ways))))
    return F.when(at > 0, at - 1)


def reference_length(cigar: Column, operations: str = "MDN=X") -> Column:
    """Bases of the reference that an alignment takes."""
    parts = F.regexp_extract_all(cigar, F.lit(f"([0-9]+)[{operations}]"), F.lit(1))
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x.cast("int"))


def pileup_counts(bases: Column, ref: Column) -> Column:
    """A, C, G, T counted in a pileup text. Read starts (^ and the quality after it), ends ($), deletions (*) and indels of
    one-digit length are left out; `.` and `,` stand for the reference base."""
    plain = F.regexp_replace(F.regexp_replace(bases, r"\^.|\$|\*", ""), "", "")
    for n in range(1, 10):
        plain = F.regexp_replace(plain, rf"[+-]{n}.{{{n}}}", "")
    upper = F.upper(F.regexp_replace(plain, "[.,]", ref))
    count = lambda c: (F.length(upper) - F.length(F.replace(upper, F.lit(c)))).alias(c.lower())
    return F.struct(*(count(c) for c in "ACGT"))
