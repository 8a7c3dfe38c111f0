"""Read masks: which positions of a read are left out of scoring."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_ITEM = re.compile(r"(\d+)(?:\s*(\.\.|-)\s*(\d+)?)?$")


class ReadMask:
    """Masked positions, 1-based.

    Text forms: a string of 0 and 1 (0 masks; at least two digits), or a comma
    list of positions and ranges ``a..b``, ``a-b`` (either order) and ``a..``
    (open end).  An empty text masks nothing.
    """

    def __init__(self, text: str = ""):
        self.ranges: list[tuple[int, int | None]] = []
        text = (text or "").strip()
        if re.fullmatch(r"[01]{2,}", text):
            self.ranges = [(i, i) for i, c in enumerate(text, 1) if c == "0"]
            return
        for item in filter(None, (x.strip() for x in text.split(","))):
            m = _ITEM.match(item)
            if not m:
                raise ValueError(f"not a mask: {item!r}")
            low, high = int(m[1]), int(m[3]) if m[3] else (None if m[2] else int(m[1]))
            self.ranges.append((low, high) if high is None or low <= high else (high, low))

    def masked(self, position: int) -> bool:
        return any(a <= position and (b is None or position <= b) for a, b in self.ranges)

    def bits(self, length: int) -> str:
        """One digit a position: 1 is used, 0 is masked."""
        return "".join("0" if self.masked(i) else "1" for i in range(1, length + 1))

    def apply(self, colors: Column) -> Column:
        """The colours of a read, ``.`` at masked positions."""
        hidden = F.lit(False)

        def put(c: Column, i: Column) -> Column:
            gone = hidden
            for a, b in self.ranges:
                gone = gone | ((i + 1 >= a) & (F.lit(True) if b is None else i + 1 <= b))
            return F.when(gone, F.lit(".")).otherwise(c)

        return F.array_join(F.transform(F.regexp_extract_all(colors, F.lit("(?s)."), F.lit(0)), put), "")

    def part(self, start: int, length: int) -> ReadMask:
        """The mask of positions start to start + length - 1, renumbered from 1."""
        out = ReadMask()
        out.ranges = [(max(1, a - start + 1), None if b is None else min(length, b - start + 1)) for a, b in self.ranges if a - start + 1 <= length and (b is None or b >= start)]
        return out

    def used(self, length: int) -> int:
        return self.bits(length).count("1")
