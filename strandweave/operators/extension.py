"""Extension: the whole read scored from its seed, and the alignment kernels behind other options.

``extend`` walks all reads of an Arrow batch in step, one numpy operation a
position, so its cost is the read length, not a Python loop per read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

NO = 255


def color_array(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Colours as a padded matrix of codes (255: no call), and the lengths."""
    length = np.array([len(t) for t in texts], np.int64)
    wide = int(length.max()) if len(length) else 0
    out = np.full((len(texts), wide), NO, np.uint8)
    for i, t in enumerate(texts):
        out[i, : len(t)] = np.frombuffer(t.encode("ascii", "replace"), np.uint8) - 48
    out[out > 3] = NO
    return out, length


def extend(read: np.ndarray, ref: np.ndarray, length: np.ndarray, mask: np.ndarray, match: int = 1, mismatch: int = -1, adjacent: bool = True, backward: bool = False) -> dict[str, np.ndarray]:
    """Best-scoring prefix (``backward``: suffix) of each row of two colour matrices.

    A used position adds ``match`` or ``mismatch``; the second of two neighbouring
    mismatches that fit one base change takes the pair back to one match more
    (``adjacent``) and starts anew; a masked position adds nothing and ends a run of
    mismatches.  The shortest best prefix counts.  Returns score, aln_len, mm,
    n_pairs and read_start (0-based).
    """
    rows, wide = read.shape
    score, best = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    aln, mm, mm_best = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    run, pairs = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    every, last = np.arange(rows), np.full(rows, -1, np.int64)
    for step in range(wide):
        inside = step < length
        at = np.where(inside, length - 1 - step if backward else step, 0)
        a, b = read[every, at], ref[every, at]
        used = inside & mask[np.minimum(at, len(mask) - 1)] if len(mask) else inside
        same = used & (a == b) & (a != NO)
        wrong = used & ~same
        before = np.where(last >= 0, last, 0)
        p, q = read[every, before], ref[every, before]
        fits = wrong & (run > 0) & (a != NO) & (b != NO) & (p != NO) & (q != NO) & ((a ^ p) == (b ^ q))
        score += match * same + mismatch * wrong
        mm += wrong
        run = np.where(wrong, run + 1, 0)
        pairs += fits
        if adjacent:
            score += (match - mismatch) * fits
            mm -= fits
            run = np.where(fits, 0, run)
        better = inside & (score > best)
        best, aln, mm_best = np.where(better, score, best), np.where(better, step + 1, aln), np.where(better, mm, mm_best)
        last = np.where(inside, at, last)
    start = np.where(backward, length - aln, 0) if rows else aln
    return {"score": best, "aln_len": aln, "mm": mm_best, "n_pairs": pairs, "read_start": start}


def extend_hits(rows: DataFrame, mask: str = "", read: str = "read_colors", ref: str = "ref_colors", match: int = 1, mismatch: int = -1, adjacent: bool = True, backward: bool = False) -> DataFrame:
    """Appends score, aln_len, mm, n_pairs and read_start to rows with the read's and the reference's colours (a string of 0-3, equal lengths; ``mask``: 1 is used)."""
    used = np.array([c == "1" for c in mask], bool) if mask else np.zeros(0, bool)
    names = ("score", "aln_len", "mm", "n_pairs", "read_start")
    kept = [c for c in rows.columns if c not in names]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            a, n = color_array(frame[read].fillna("").tolist())
            b, m = color_array(frame[ref].fillna("").tolist())
            wide = min(a.shape[1], b.shape[1]) if len(frame) else 0
            bits = used if len(used) >= wide or not len(used) else np.r_[used, np.ones(wide - len(used), bool)]
            found = extend(a[:, :wide], b[:, :wide], np.minimum(n, m), bits, match, mismatch, adjacent, backward)
            yield frame[kept].assign(**found)

    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInPandas(run, ", ".join(filter(None, [types, *[f"{c} bigint" for c in names]])))


def banded(read: str, ref: str, band: int, match: int = 1, mismatch: int = -1, gap: int = -2) -> tuple[int, int, int]:
    """Global alignment of a read within ``band`` diagonals, free reference ends: (score, reference end, gaps on the best path)."""
    low, n, m = -10**9, len(read), len(ref)
    score = np.zeros(m + 1, np.int64)
    gaps = np.zeros(m + 1, np.int64)
    for i in range(1, n + 1):
        row, own = np.full(m + 1, low, np.int64), np.zeros(m + 1, np.int64)
        if i <= band:
            row[0], own[0] = i * gap, i
        for j in range(max(1, i - band), min(m, i + band + max(0, m - n)) + 1):
            same = read[i - 1] == ref[j - 1] and read[i - 1] != "."
            row[j], own[j] = max((score[j - 1] + (match if same else mismatch), -gaps[j - 1]), (score[j] + gap, -gaps[j] - 1), (row[j - 1] + gap, -own[j - 1] - 1))
            own[j] = -own[j]
        score, gaps = row, own
    end = int(np.argmax(score))
    return int(score[end]), end, int(gaps[end])


def one_indel(read: str, ref: str, longest: int) -> tuple[int, int, int] | None:
    """The split of a read into two exact halves on diagonals up to ``longest`` apart whose colours around the indel keep the exclusive-or sum: (matched in front, size, mismatches).

    Positive sizes are missing reference colours (a deletion in the read).
    """
    n = len(read)
    a, b = (np.frombuffer(t.encode(), np.uint8).astype(np.int16) for t in (read, ref))
    front = np.concatenate([[0], np.cumsum(a[: min(n, len(b))] != b[: min(n, len(b))])])
    best = None
    for size in [s for d in range(1, longest + 1) for s in (d, -d)]:
        shifted = np.arange(n) + size
        ok = (shifted >= 0) & (shifted < len(b))
        wrong = np.ones(n, np.int64)
        wrong[ok] = a[ok] != b[shifted[ok]]
        behind = np.r_[np.cumsum(wrong[::-1])[::-1], 0]
        for cut in range(1, n - max(0, -size)):
            skip = max(0, -size)
            if cut >= len(front) or cut + skip > n:
                continue
            total = int(front[cut] + behind[cut + skip])
            if size > 0:
                gone = b[cut : cut + size + 1]
                fits = cut + size < len(b) and cut < n and np.bitwise_xor.reduce(gone - 48) == a[cut] - 48
                total = int(front[cut] + behind[cut + 1]) if fits else total
            else:
                new = a[cut : cut + skip + 1]
                fits = cut < len(b) and np.bitwise_xor.reduce(new - 48) == b[cut] - 48
                total = int(front[cut] + (behind[cut + skip + 1] if cut + skip + 1 <= n else 0)) if fits else total
            if fits and (best is None or total < best[2]):
                best = (cut, size, total)
    return best


def indel_scan(read: np.ndarray, ref: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``one_indel`` of many reads at all places at once: (mismatches, size, matched in front) for each row and place, size 0 where nothing fits.

    ``read`` and ``ref`` are code matrices; place 0 is column ``longest`` of ``ref``, which
    ends ``longest`` columns behind the last place's read.
    """
    k, n = read.shape
    starts = ref.shape[1] - n + 1
    places = starts - 2 * longest
    wrong = np.zeros((n + 1, k, starts), np.int16)
    for i in range(n):
        wrong[i + 1] = wrong[i] + ((ref[:, i : i + starts] != read[:, i : i + 1]) | (read[:, i : i + 1] == NO))
    sums = lambda a, f: np.concatenate([np.zeros((k, 1), np.int32), f.accumulate(a.astype(np.int32), axis=1)], axis=1)
    ref_xor, ref_none = sums(np.where(ref == NO, 0, ref), np.bitwise_xor), sums(ref == NO, np.add)
    read_xor, read_none = sums(np.where(read == NO, 0, read), np.bitwise_xor), sums(read == NO, np.add)
    best, size, cut = np.full((k, places), n + 1, np.int32), np.zeros((k, places), np.int32), np.zeros((k, places), np.int32)
    at = lambda i: slice(i, i + places)
    for d in range(1, longest + 1):
        for step in (d, -d):
            for c in range(1, n if step > 0 else n - d):
                if step > 0:  # d + 1 reference colours became one
                    a, b, behind = at(longest + c), at(longest + c + d + 1), c + 1
                    fits = ((ref_xor[:, b] ^ ref_xor[:, a]) == read[:, c : c + 1]) & (ref_none[:, b] == ref_none[:, a])
                else:  # one reference colour became d + 1
                    behind = c + d + 1
                    whole = (read_none[:, behind] == read_none[:, c])[:, None]
                    fits = (ref[:, at(longest + c)] == (read_xor[:, behind] ^ read_xor[:, c])[:, None]) & whole
                there = at(longest + step)
                total = wrong[c][:, at(longest)] + wrong[n][:, there] - wrong[behind][:, there]
                better = fits & (total < best)
                best[better], size[better], cut[better] = total[better], step, c
    return best, size, cut


def align_banded(rows: DataFrame, band: int, read: str = "read_colors", ref: str = "ref_colors", match: int = 1, mismatch: int = -1, gap: int = -2) -> DataFrame:
    """Appends ``banded``'s gap_score, ref_end and n_gaps; rows of equal lengths go through the cells together."""
    names = ("gap_score", "ref_end", "n_gaps")
    kept = [c for c in rows.columns if c not in names]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            a, b = frame[read].fillna(""), frame[ref].fillna("")
            out = np.zeros((len(frame), 3), np.int64)
            for _, part in pd.DataFrame({"n": a.str.len().to_numpy(), "m": b.str.len().to_numpy()}).groupby(["n", "m"]):
                i = part.index.to_numpy()
                out[i] = _banded(*(np.array([list(t.encode("ascii", "replace")) for t in x.iloc[i]], np.int64).reshape(len(i), -1) for x in (a, b)), band, match, mismatch, gap)
            yield frame[kept].assign(**{c: out[:, j] for j, c in enumerate(names)})

    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInPandas(run, ", ".join(filter(None, [types, *[f"{c} bigint" for c in names]])))


def _banded(a: np.ndarray, b: np.ndarray, band: int, match: int, mismatch: int, gap: int) -> np.ndarray:
    # a cell is score * big - gaps, so that the greater one has the better score, then the fewer gaps
    (k, n), m, big = a.shape, b.shape[1], 1 << 20
    low = -(10**9) * big
    cell = np.zeros((k, m + 1), np.int64)
    for i in range(1, n + 1):
        row = np.full((k, m + 1), low, np.int64)
        if i <= band:
            row[:, 0] = i * (gap * big - 1)
        for j in range(max(1, i - band), min(m, i + band + max(0, m - n)) + 1):
            same = (a[:, i - 1] == b[:, j - 1]) & (a[:, i - 1] != ord("."))
            row[:, j] = np.maximum.reduce([cell[:, j - 1] + np.where(same, match, mismatch) * big, cell[:, j] + gap * big - 1, row[:, j - 1] + gap * big - 1])
        cell = row
    score = -(-cell // big)
    end = score.argmax(axis=1)
    top = cell[np.arange(k), end]
    return np.stack([-(-top // big), end, -(-top // big) * big - top], axis=1)


def rescore(rows: DataFrame, read: str = "read_colors", ref: str = "ref_colors", quality: str = "quality", most: int = 10) -> DataFrame:
    """Appends ``cost``: the summed quality weights of the mismatches (``quality``: array<int>)."""
    kept = [c for c in rows.columns if c != "cost"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cost = []
            for a, b, q in zip(frame[read], frame[ref], frame[quality], strict=True):
                x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
                w = np.round(most * (1 - 10.0 ** (-np.maximum(np.asarray(q, float), 0) / 10)))
                n = min(len(x), len(y), len(w))
                cost.append(int(w[:n][(x[:n] != y[:n]) | (x[:n] == ord("."))].sum()))
            yield frame[kept].assign(cost=cost)

    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInPandas(run, f"{types}, cost bigint")
