"""Seeded read simulators; every read is a function of its number, so tasks and retries agree."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

CODES = {b: i for i, b in enumerate("ACGT")}


def colors_of(seq: str) -> str:
    codes = [CODES.get(b) for b in seq]
    return "".join("." if a is None or b is None else str(a ^ b) for a, b in zip(codes[:-1], codes[1:], strict=True))


def reverse_complement(seq: str) -> str:
    return seq[::-1].translate(str.maketrans("ACGT", "TGCA"))


def simulate_read(contigs: list[tuple[str, str]], number: int, length: int, error: float, insertion: float, deletion: float, seed: int) -> tuple:
    """(read_id, contig, pos0, strand, kind, primer, colors) of read ``number``."""
    draw = np.random.default_rng((seed, number))
    weights = np.array([max(0, len(s) - length - 4) for _, s in contigs], float)
    i = int(draw.choice(len(contigs), p=weights / weights.sum()))
    name, seq = contigs[i]
    at = int(draw.integers(0, len(seq) - length - 4))
    minus = bool(draw.integers(2))
    kind, size = "exact", int(draw.integers(1, 4))
    u = draw.random()
    cut = int(draw.integers(length // 4, 3 * length // 4))
    if u < insertion:
        kind = f"ins{size}"
        extra = "".join("ACGT"[k] for k in draw.integers(0, 4, size))
        piece = seq[at : at + cut] + extra + seq[at + cut : at + length - size]
    elif u < insertion + deletion:
        kind = f"del{size}"
        piece = seq[at : at + cut] + seq[at + cut + size : at + length + size]
    else:
        piece = seq[at : at + length]
    if minus:
        piece = reverse_complement(piece)
    colors = list(colors_of("T" + piece))
    for k in np.flatnonzero(draw.random(len(colors)) < error):
        colors[k] = str((int(colors[k]) + int(draw.integers(1, 4))) % 4) if colors[k] != "." else "."
    return (f"1_{number // 1000}_{number % 1000}_F3", name, at, "-" if minus else "+", kind, "T", "".join(colors))


def simulate(spark: SparkSession, contigs: list[tuple[str, str]], n: int, length: int = 25, error: float = 0.0, insertion: float = 0.0, deletion: float = 0.0, seed: int = 0) -> DataFrame:
    """``n`` reads of small contigs, with the truth in columns."""
    def run(frames):
        for frame in frames:
            rows = [simulate_read(contigs, int(i), length, error, insertion, deletion, seed) for i in frame["id"]]
            yield pd.DataFrame(rows, columns=["read_id", "contig", "pos0", "strand", "kind", "primer", "colors"])

    return spark.range(n).mapInPandas(run, "read_id string, contig string, pos0 bigint, strand string, kind string, primer string, colors string")


def simulate_pairs(spark: SparkSession, contigs: list[tuple[str, str]], n: int, length: int = 25, mean: int = 200, spread: int = 20, seed: int = 0) -> DataFrame:
    """Mates (bead_id, contig, strand, r_pos, f_pos, distance) whose distance is rounded normal."""
    def run(frames):
        for frame in frames:
            rows = []
            for i in frame["id"]:
                draw = np.random.default_rng((seed, int(i), 1))
                d = max(2 * length, round(draw.normal(mean, spread)))
                fit = [(name, s) for name, s in contigs if len(s) > d]
                name, seq = fit[int(draw.integers(len(fit)))]
                at = int(draw.integers(0, len(seq) - d))
                rows.append((int(i), name, "+" if draw.integers(2) else "-", at, at + d - length, d))
            yield pd.DataFrame(rows, columns=["bead_id", "contig", "strand", "r_pos", "f_pos", "distance"])

    return spark.range(n).mapInPandas(run, "bead_id bigint, contig string, strand string, r_pos bigint, f_pos bigint, distance bigint")


def simulate_expression(spark: SparkSession, transcripts: list[tuple[str, str, float]], n: int, length: int = 50, seed: int = 0) -> DataFrame:
    """Reads of transcripts (id, sequence, expression), drawn in proportion to expression times usable length."""
    usable = [(t, s, e * max(0, len(s) - length + 1)) for t, s, e in transcripts]
    share = np.array([u[2] for u in usable], float)
    share = share / share.sum()

    def run(frames):
        for frame in frames:
            rows = []
            for i in frame["id"]:
                draw = np.random.default_rng((seed, int(i), 2))
                name, seq, _ = usable[int(draw.choice(len(usable), p=share))]
                at = int(draw.integers(0, len(seq) - length + 1))
                rows.append((f"2_{int(i) // 1000}_{int(i) % 1000}_F3", name, at, "T", colors_of("T" + seq[at : at + length])))
            yield pd.DataFrame(rows, columns=["read_id", "transcript_id", "pos0", "primer", "colors"])

    return spark.range(n).mapInPandas(run, "read_id string, transcript_id string, pos0 bigint, primer string, colors string")
