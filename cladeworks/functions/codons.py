"""Genetic codes and codon-pair counts as small dimension tables."""

from __future__ import annotations

from itertools import permutations, product

from pyspark.sql import DataFrame, SparkSession

BASES = "TCAG"
# Amino acids of the universal and the vertebrate mitochondrial code, codons in TCAG order.
CODES = {
    "universal": "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    "vertebrate_mt": "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSS**VVVVAAAADDEEGGGG",
}
CODONS = ["".join(c) for c in product(BASES, repeat=3)]


def code_of(name: str = "universal") -> dict[str, str]:
    return dict(zip(CODONS, CODES[name], strict=True))


def code_table(spark: SparkSession, name: str = "universal") -> DataFrame:
    """(codon, aa), 64 rows; stops are *."""
    return spark.createDataFrame(list(code_of(name).items()), "codon string, aa string")


def sites_of(codon: str, aa: dict[str, str]) -> tuple[float, float]:
    """Synonymous and nonsynonymous sites: a third for each other base at each position, stops left out."""
    s = n = 0.0
    for k in range(3):
        for base in BASES:
            other = codon[:k] + base + codon[k + 1 :]
            if other != codon and aa[other] != "*":
                s, n = (s + 1 / 3, n) if aa[other] == aa[codon] else (s, n + 1 / 3)
    return s, n


def changes_of(a: str, b: str, aa: dict[str, str]) -> tuple[float, float]:
    """Synonymous and nonsynonymous changes, averaged over the orders of the changes that pass no stop."""
    differ = [k for k in range(3) if a[k] != b[k]]
    found = []
    for order in permutations(differ):
        at, s, n = a, 0, 0
        for k in order:
            new = at[:k] + b[k] + at[k + 1 :]
            if aa[new] == "*":
                break
            s, n = (s + 1, n) if aa[new] == aa[at] else (s, n + 1)
            at = new
        else:
            found.append((s, n))
    return (sum(s for s, _ in found) / len(found), sum(n for _, n in found) / len(found)) if found else (0.0, 0.0)


def pair_table(spark: SparkSession, name: str = "universal") -> DataFrame:
    """(codon_a, codon_b, s_sites, n_sites, s_changes, n_changes) of all pairs of sense codons."""
    aa = code_of(name)
    sense = [c for c in CODONS if aa[c] != "*"]
    rows = []
    for a, b in product(sense, repeat=2):
        (sa, na), (sb, nb) = sites_of(a, aa), sites_of(b, aa)
        rows.append((a, b, (sa + sb) / 2, (na + nb) / 2, *changes_of(a, b, aa)))
    return spark.createDataFrame(rows, "codon_a string, codon_b string, s_sites double, n_sites double, s_changes double, n_changes double")


def degeneracy(codon: str, aa: dict[str, str]) -> list[int]:
    """0, 2 or 4 for each position: how many of its changes are synonymous (threefold counts as twofold)."""
    out = []
    for k in range(3):
        same = sum(aa[codon[:k] + b + codon[k + 1 :]] == aa[codon] for b in BASES if b != codon[k])
        out.append(0 if same == 0 else 4 if same == 3 else 2)
    return out


def degeneracy_table(spark: SparkSession, name: str = "universal") -> DataFrame:
    """(codon, d1, d2, d3) of the sense codons."""
    aa = code_of(name)
    return spark.createDataFrame([(c, *degeneracy(c, aa)) for c in CODONS if aa[c] != "*"], "codon string, d1 int, d2 int, d3 int")
