"""Colour-space and sequence functions: Column expressions, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bases in code order (a colour is the exclusive or of two neighbouring codes), IUPAC codes and complements.
BASES = "ACGT"
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}
COMPLEMENT = ("ACGTRYSWKMBDHVNacgtryswkmbdhvn", "TGCAYRSWMKVHDBNtgcayrswmkvhdbn")


def _letters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def base_codes(seq: Column) -> Column:
    """Codes 0-3 of a sequence; null where the letter isn't a plain base."""
    return F.transform(_letters(F.upper(seq)), lambda c: F.when(c == "A", 0).when(c == "C", 1).when(c == "G", 2).when(c == "T", 3))


def encode_colors(seq: Column) -> Column:
    """Base sequence to colours, one shorter; ``.`` where a neighbour isn't a plain base."""
    codes = base_codes(seq)
    pairs = F.zip_with(codes, F.slice(codes, 2, F.greatest(F.size(codes), F.lit(1))), lambda a, b: F.coalesce(a.bitwiseXOR(b).cast("string"), F.lit(".")))
    return F.when(F.length(seq) < 2, F.lit("")).otherwise(F.array_join(F.slice(pairs, 1, F.greatest(F.size(codes) - 1, F.lit(0))), ""))


def decode_colors(first: Column, colors: Column) -> Column:
    """Colours to bases from a known first base (which is part of the result); from a ``.`` on all bases are N."""
    code = F.instr(F.lit(BASES), F.upper(first)) - 1
    step = lambda a, c: F.struct(
        F.when((a["code"] < 0) | ~c.isin("0", "1", "2", "3"), F.lit(-1)).otherwise(a["code"].bitwiseXOR(F.ascii(c) - 48)).alias("code"),
        F.concat(a["out"], F.when((a["code"] < 0) | ~c.isin("0", "1", "2", "3"), F.lit("N")).otherwise(F.element_at(F.array(*[F.lit(b) for b in BASES]), a["code"].bitwiseXOR(F.ascii(c) - 48) + 1))).alias("out"),
    )
    return F.aggregate(_letters(colors), F.struct(code.cast("int").alias("code"), F.when(code < 0, F.lit("N")).otherwise(F.upper(first)).alias("out")), step, lambda a: a["out"])


def decode_long(first: Column, colors: Column, size: int = 256) -> Column:
    """``decode_colors`` in pieces of ``size`` colours, which copies far less of a long text."""
    pieces = F.filter(F.split(colors, f"(?<=\\G[0-3.]{{{size}}})"), lambda p: p != "")
    start = F.when(F.upper(first).isin(*BASES), F.upper(first)).otherwise(F.lit("N"))
    # each piece starts from the base that the one before ended with; that base isn't repeated
    return F.aggregate(pieces, start, lambda a, p: F.concat(a, F.substring(decode_colors(F.right(a, F.lit(1)), p), 2, size)))


def decode_candidates(colors: Column) -> Column:
    """All four decodings where the first base isn't known."""
    return F.array(*[decode_colors(F.lit(b), colors) for b in BASES])


def complement(seq: Column) -> Column:
    return F.translate(seq, *COMPLEMENT)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(complement(seq))


def strand_substring(seq: Column, start0: Column, length: Column, strand: Column) -> Column:
    """A slice of a sequence, reverse-complemented on the minus strand."""
    part = F.substring(seq, start0 + 1, length)
    return F.when(strand == "-", reverse_complement(part)).otherwise(part)


def iupac_bases(code: Column) -> Column:
    """The bases that an IUPAC code stands for; an empty array for other letters."""
    table = F.create_map(*[F.lit(x) for k, v in IUPAC.items() for x in (k, v)])
    return F.coalesce(_letters(table[F.upper(code)]), F.array().cast("array<string>"))


def iupac_colors(first: Column, second: Column) -> Column:
    """The colours that two neighbouring IUPAC codes can make, sorted."""
    codes = lambda c: F.transform(iupac_bases(c), lambda b: F.instr(F.lit(BASES), b) - 1)
    return F.array_sort(F.array_distinct(F.flatten(F.transform(codes(first), lambda a: F.transform(codes(second), lambda b: a.bitwiseXOR(b))))))


def iupac_triple_colors(first: Column, middle: Column, last: Column) -> Column:
    """The colour pairs that three neighbouring IUPAC codes can make, as two-digit strings, sorted."""
    codes = lambda c: F.transform(iupac_bases(c), lambda b: F.instr(F.lit(BASES), b) - 1)
    pair = lambda a, b, c: F.concat(a.bitwiseXOR(b).cast("string"), b.bitwiseXOR(c).cast("string"))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(codes(first), lambda a: F.flatten(F.transform(codes(middle), lambda b: F.transform(codes(last), lambda c: pair(a, b, c))))))))


def color_matches(first: Column, second: Column, color: Column) -> Column:
    """Can two neighbouring IUPAC codes make this colour?"""
    return F.array_contains(iupac_colors(first, second), color.cast("int"))


def valid_adjacent(c1: Column, c2: Column, r1: Column, r2: Column) -> Column:
    """Do two neighbouring colour mismatches fit one base change?  Both colour pairs must join the same outer bases."""
    return c1.bitwiseXOR(c2) == r1.bitwiseXOR(r2)


def xor_sum(colors: Column) -> Column:
    """Exclusive or of all colours: equal sums mean that the outer bases agree (indel compatibility); null with a ``.``."""
    return F.aggregate(_letters(colors), F.lit(0), lambda a, c: a.bitwiseXOR(F.when(c.isin("0", "1", "2", "3"), F.ascii(c) - 48)))


def mismatches_paired(a: Column, b: Column) -> Column:
    """Hamming distance where any two neighbouring mismatches count once, pairs taken from the left."""
    marks = F.array_join(F.zip_with(_letters(a), _letters(b), lambda x, y: F.when((x != y) | (x == "."), "x").otherwise("=")), "")
    return F.length(F.replace(F.replace(marks, F.lit("xx"), F.lit("x")), F.lit("="), F.lit("")))


def mismatches(a: Column, b: Column) -> Column:
    """Hamming distance of two strings of one length; a ``.`` always differs."""
    return F.size(F.filter(F.zip_with(_letters(a), _letters(b), lambda x, y: (x != y) | (x == ".")), lambda d: d))
