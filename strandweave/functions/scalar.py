"""Scalar functions over intervals, positions, ids and texts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# -- intervals (inclusive ends) ------------------------------------------------


def interval_length(s: Column, e: Column) -> Column:
    return e - s + 1


def overlap_length(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Shared positions; zero or negative where there are none."""
    return F.least(e1, e2) - F.greatest(s1, s2) + 1


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return (s1 <= e2) & (s2 <= e1)


def distance(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Steps between two intervals; 0 where they overlap."""
    return F.greatest(s2 - e1, s1 - e2, F.lit(0))


def contains(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return (s1 <= s2) & (e2 <= e1)


def overlap_fractions(s1: Column, e1: Column, s2: Column, e2: Column) -> tuple[Column, Column]:
    """The overlap as a part of either interval."""
    shared = overlap_length(s1, e1, s2, e2)
    return shared / interval_length(s1, e1), shared / interval_length(s2, e2)


def strands_fit(a: Column, b: Column) -> Column:
    """Strands agree, or one of them is open."""
    return (a == b) | (a == ".") | (b == ".")


# -- positions -----------------------------------------------------------------


def first_color_position(pos0: Column, aln_len: Column, strand: Column) -> Column:
    return F.when(strand == "-", pos0 + aln_len - 1).otherwise(pos0)


def last_color_position(pos0: Column, aln_len: Column, strand: Column) -> Column:
    return F.when(strand == "-", pos0).otherwise(pos0 + aln_len - 1)


def collapse_key(pos0: Column, aln_len: Column, read_start: Column, strand: Column) -> Column:
    """Where the read's first base would lie: equal for hits that place the read alike."""
    return F.when(strand == "-", pos0 + aln_len - 1 + read_start).otherwise(pos0 - read_start)


def junction_to_genome(pos0: Column, left_start0: Column, left_end0: Column, right_start0: Column, right_end0: Column, strand: Column) -> Column:
    """Genome position of a 0-based position in a junction sequence."""
    left, right = left_end0 - left_start0 + 1, right_end0 - right_start0 + 1
    at = F.when(strand == "-", left + right - 1 - pos0).otherwise(pos0)
    return F.when(at < left, left_start0 + at).otherwise(right_start0 + at - left)


def genome_to_junction(at0: Column, left_start0: Column, left_end0: Column, right_start0: Column, right_end0: Column, strand: Column) -> Column:
    """The 0-based position in a junction sequence of a genome position; null between and beyond the flanks."""
    left, right = left_end0 - left_start0 + 1, right_end0 - right_start0 + 1
    at = F.when(at0.between(left_start0, left_end0), at0 - left_start0).when(at0.between(right_start0, right_end0), left + at0 - right_start0)
    return F.when(strand == "-", left + right - 1 - at).otherwise(at)


def junction_sides(pos0: Column, aln_len: Column, left_len: Column, right_len: Column, strand: Column) -> tuple[Column, Column]:
    """Positions of an alignment on the left and on the right flank (genome order)."""
    first = F.when(strand == "-", left_len + right_len - pos0 - aln_len).otherwise(pos0)
    left = F.greatest(F.lit(0), F.least(first + aln_len, left_len) - first)
    return left, aln_len - left


def spans_junction(pos0: Column, aln_len: Column, left_len: Column, right_len: Column, strand: Column, least: int = 4) -> Column:
    a, b = junction_sides(pos0, aln_len, left_len, right_len, strand)
    return (a >= least) & (b >= least)


# -- scores --------------------------------------------------------------------


def local_score(length: Column, mm: Column, match: int = 1, mismatch: int = -1) -> Column:
    return length * match + mm * (mismatch - match)


def quality_weight(quality: Column, most: int = 10) -> Column:
    """Cost of a mismatch at a called colour of this quality: the rounded chance (in tenths) that the call is right."""
    return F.round(most * (1 - F.pow(F.lit(10.0), -F.greatest(quality, F.lit(0)) / 10))).cast("int")


# -- ids and texts -------------------------------------------------------------

REGION = re.compile(r"^(.+?)(?::(\d+)(?:-(\d+))?)?$")


def parse_regions(text: str) -> list[tuple[str, int | None, int | None]]:
    """``id[:start[-end]]``, a comma list; reversed bounds are swapped."""
    out = []
    for item in filter(None, (x.strip() for x in text.split(","))):
        name, a, b = REGION.match(item).groups()
        low, high = (int(a) if a else None), (int(b) if b else None)
        out.append((name, high, low) if low is not None and high is not None and high < low else (name, low, high))
    return out


def region(text: Column) -> Column:
    """(name, low, high) of ``id[:start[-end]]``; reversed bounds are swapped."""
    g = lambda i: F.regexp_extract(text, r"^(.+?)(?::([0-9]+)(?:-([0-9]+))?)?$", i)
    a, b = g(2).try_cast("bigint"), g(3).try_cast("bigint")
    swap = b < a
    return F.struct(g(1).alias("name"), F.when(swap, b).otherwise(a).alias("low"), F.when(swap, a).otherwise(b).alias("high"))


def attribute(attributes: Column, key: str) -> Column:
    """A GTF attribute; null where it is missing."""
    value = F.regexp_extract(attributes, rf'(?:^|;)\s*{re.escape(key)}\s+"?([^";]*)"?', 1)
    return F.when(value != "", value)


def read_parts(read_id: Column) -> Column:
    """(panel, x, y, tag) of an id ``panel_x_y_tag``."""
    p = F.split(F.regexp_replace(read_id, "_FILT$", ""), "_")
    return F.struct(p[0].try_cast("int").alias("panel"), F.try_element_at(p, F.lit(2)).try_cast("int").alias("x"), F.try_element_at(p, F.lit(3)).try_cast("int").alias("y"), F.try_element_at(p, F.lit(4)).alias("tag"))


def natural_key(text: Column) -> list[Column]:
    """Sort columns: the first number within, then the text; texts without a number come last."""
    return [F.coalesce(F.regexp_extract(text, r"(\d+)", 1).try_cast("bigint"), F.lit(2147483647).cast("bigint")), text]


_UNITS = {"": 0, "B": 0, "K": 1, "KB": 1, "M": 2, "MB": 2, "G": 3, "GB": 3, "T": 4, "TB": 4}


def byte_size(text: str) -> int:
    """``6.5GB`` and the like, in multiples of 1024."""
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([A-Za-z]*)\s*", text)
    if not m or m[2].upper() not in _UNITS:
        raise ValueError(f"not a size: {text!r}")
    return round(float(m[1]) * 1024 ** _UNITS[m[2].upper()])


def split_quoted(line: str, delimiter: str = ",", quote: str = '"', escape: str = "\\") -> list[str]:
    """Fields of a line; quotes protect delimiters, the escape sign protects any sign."""
    out, field, inside, at = [], [], False, 0
    while at < len(line):
        c = line[at]
        if c == escape and at + 1 < len(line):
            at += 1
            field.append(line[at])
        elif c == quote:
            inside = not inside
        elif c == delimiter and not inside:
            out.append("".join(field))
            field = []
        else:
            field.append(c)
        at += 1
    return [*out, "".join(field)]


def safe_name(text: str) -> str:
    return re.sub(r"[^A-Za-z0-9._-]+", "_", text)


def parse_flag(text: str) -> bool:
    value = text.strip().lower()
    if value in ("true", "t", "yes", "y", "1", "on"):
        return True
    if value in ("false", "f", "no", "n", "0", "off", ""):
        return False
    raise ValueError(f"not a flag: {text!r}")


#: The standard genetic code, bases in the order T, C, A, G.
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def amino_acid(codon: Column) -> Column:
    """One-letter amino acid of a codon; X where a base isn't known."""
    place = lambda i: F.instr(F.lit("TCAG"), F.substring(F.upper(codon), i, 1)) - 1
    a, b, c = place(1), place(2), place(3)
    known = (F.length(codon) == 3) & (a >= 0) & (b >= 0) & (c >= 0)
    return F.when(known, F.substring(F.lit(AMINO), (a * 16 + b * 4 + c + 1), F.lit(1))).otherwise(F.lit("X"))


def translate_orf(seq: Column) -> Column:
    """Amino acids of the whole codons of a sequence."""
    return F.array_join(F.transform(F.regexp_extract_all(seq, F.lit("(?s).{3}"), F.lit(0)), amino_acid), "")


# The memory models, in bytes.


def mapper_memory(bases: int) -> float:
    return 1.3e9 + 7 * bases


def most_bases(memory: float) -> float:
    return min(1e9, (memory - 1.3e9) / 7)


def extension_memory(bases: int) -> float:
    return 1.2 * bases
