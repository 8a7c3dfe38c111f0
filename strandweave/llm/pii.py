"""Personal data: candidate generators and gradient-boosted trees, by SQL functions only.

Base rules (email, ip, card, phone) always count.  High-recall generators propose
further, possibly overlapping spans: spelled-out addresses, phone numbers without
a country code, national insurance style numbers, account numbers and long digit
runs.  Boosted trees score them on format and context; thresholds are calibrated
for precision per generator; a candidate that overlaps a base span, or a better
candidate, is left out.

The trees learn from a generated set of labelled findings (a fixed seed, ``SIZE``
examples of each generator), whose features the same SQL computes; the fitted
trees are CASE expressions.  Null text counts as empty.  The patterns are
possessive forms of the rules: they match the same spans without backtracking, so
long runs cost linear time; no candidate has an upper length.  Candidates of one
text are compared with each other, which costs the square of their number.  Repeated rows and extra columns stay.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh
from .spans import quoted, with_matches
from .trees import boosting_sql, calibrate, fit_boosting, predict

BASE = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains({0}, '@')"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "contains({0}, '.')"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "{0} rlike '[0-9][\\\\x20-]?[0-9]'"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "contains({0}, '+')"),
}
VALID = {
    "email": "true",
    "ip": r"forall(split(x.m, '[.]'), p -> coalesce(try_cast(regexp_replace(p, '^0+(?=.)', '') AS int), 256) <= 255)",
    "card": "length(regexp_replace(x.m, '[^0-9]', '')) BETWEEN 13 AND 19 AND {luhn}",
    "phone": "length(regexp_replace(x.m, '[^0-9]', '')) BETWEEN 9 AND 15",
}
_DIGITS = "split(reverse(regexp_replace(x.m, '[^0-9]', '')), '')"
LUHN = f"(aggregate(transform(filter({_DIGITS}, d -> d <> ''), (d, i) -> CASE WHEN i % 2 = 0 THEN CAST(d AS int) WHEN CAST(d AS int) > 4 THEN 2 * CAST(d AS int) - 9 ELSE 2 * CAST(d AS int) END), 0, (a, d) -> a + d) % 10 = 0)"
#: Generators of further candidates: name, pattern, guard.
MORE = {
    "address": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,}\x20?[\[(]?\x20?(?i:at)\x20?[\])]?\x20?[A-Za-z0-9-]{2,}(?:\x20?[\[(]?\x20?(?i:dot)\x20?[\])]?\x20?[A-Za-z]{2,})++", "lower({0}) rlike '[a-z0-9][\\\\x20\\\\[(]+dot[\\\\x20\\\\])]+[a-z]'"),
    "local_phone": (r"(?<![0-9+.)-])\(?[0-9]{3}\)?[\x20.-]\x20?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", "{0} rlike '[0-9]{{3}}[\\\\x20.-][0-9]{{4}}'"),
    "national_id": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "{0} rlike '-[0-9]{{2}}-'"),
    "account": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}(?![a-z])){2,}+(?:\x20?[A-Z0-9]{1,4}(?![A-Za-z0-9]))?(?![A-Za-z0-9])", "{0} rlike '[A-Z]{{2}}[0-9]{{2}}'"),
    "number": (r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){10,}+", "{0} rlike '[0-9][\\\\x20-]?[0-9]'"),
}
#: Context cues, each a feature: fixed values.
CUES = (
    "call|phone|tel|mobile|cell|fax|dial|contact|reach",
    "account|acct|iban|card|visa|payment|bank",
    "ssn|social|insurance|tax|passport",
    "mail|write|address",
    "order|invoice|ticket|version|page|isbn|part|serial|tracking|ref|sku|build|commit|no",
)
FEATURES = (
    "length(regexp_replace({c}.m, '[^0-9]', ''))", "length({c}.m)", "length(regexp_replace({c}.m, '[^A-Za-z]', ''))", "length(regexp_replace({c}.m, '[^\\\\x20().-]', ''))",
    "size(array_distinct(split({c}.m, '')))", "CASE WHEN lower({c}.m) rlike '[\\\\[(] ?(at|dot) ?[\\\\])]' THEN 1 ELSE 0 END", "CASE WHEN {c}.r rlike '^[A-Za-z0-9]' THEN 1 ELSE 0 END", "CASE WHEN {c}.r rlike '^[.,-][0-9]' THEN 1 ELSE 0 END",
    *(f"CASE WHEN lower({{c}}.l) rlike '(^|[^a-z])({cue})[^a-z]*([a-z]+[^a-z]+)?$' THEN 1 ELSE 0 END" for cue in CUES),
)
SIZE = 120


def examples(seed: int = 11) -> list[tuple[str, str, str, str, int]]:
    """Labelled findings: (generator, left, match, right, label)."""
    draw, longer = random.Random(seed), random.Random(seed + 1)
    digits = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    word = lambda: "".join(draw.choice("abcdefghijklmnoprstuvw") for _ in range(draw.randint(2, 8)))
    plain = lambda: f"{word()} {word()} {word()} "
    cue = lambda i: f"{word()} {draw.choice(CUES[i].split('|'))}{draw.choice([' ', ': ', ' me on ', ' is ', ' number '])}"
    wrong = lambda: draw.choice([cue(4), cue(4), plain()])
    out = []
    for i in range(SIZE):
        good = i % 2
        a, b, c = ((" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "))[draw.randrange(3)] + (draw.choice(["com", "org", "net"]),)
        if good:
            out.append(("address", draw.choice([cue(3), cue(0), plain()]) if "(" in a or "[" in a else cue(3), f"{word()}{draw.choice(['', '.', '_'])}{word()}{a}{word()}{b}{c}", draw.choice(["", " ", ". "]), 1))
        else:
            out.append(("address", plain(), f"{word()} at {word()} dot {word()}", f" {word()}", 0))
        phone = f"{draw.choice(['(' + digits(3) + ') ', digits(3) + '-', digits(3) + '.'])}{digits(3)}{draw.choice('-. ')}{digits(4)}"
        out.append(("local_phone", cue(0) if good else wrong(), phone, "" if good else draw.choice(["", "-" + digits(2), "." + digits(3)]), good))
        out.append(("national_id", cue(2) if good else wrong(), f"{digits(3)}-{digits(2)}-{digits(4)}", draw.choice(["", " ", "."]), good))
        iban = "".join(draw.choice("ABCDEFGHIKLNPRST") for _ in range(2)) + digits(2)
        tail = "".join(f"{draw.choice(['', ' '])}{digits(4)}" for _ in range(4)) if good else "".join("".join(draw.choice("ABCDEF0123456789") for _ in range(4)) for _ in range(draw.randint(2, 6)))
        out.append(("account", cue(1) if good else wrong(), iban + tail, "", good))
        out.append(("number", cue(1) if good else draw.choice([wrong(), plain()]), digits(draw.randint(11, 19)), "", good))
        if i % 4 == 0:  # far longer than any account
            out[-1] = (*out[-1][:2], "".join(longer.choice("0123456789") for _ in range(longer.randint(24, 80))), "", 0)
    return out


def _features(c: str) -> list[str]:
    return [f.replace("{c}", c) for f in FEATURES]


@lru_cache(maxsize=1)
def _model(session_id: int, spark_ref) -> dict[str, tuple[list, float]]:
    spark = spark_ref.spark
    rows = examples()
    values = ", ".join(f"({i}, {quoted(k)}, {quoted(left)}, {quoted(m)}, {quoted(r)})" for i, (k, left, m, r, _) in enumerate(rows))
    found = spark.sql(f"SELECT i, {', '.join(f'CAST({f} AS double) AS f{j}' for j, f in enumerate(_features('x')))} FROM (SELECT i, named_struct('m', m, 'l', l, 'r', r) AS x FROM VALUES {values} AS t(i, k, l, m, r)) ORDER BY i").collect()
    x = np.array([list(r)[1:] for r in found])
    kind, y = np.array([r[0] for r in rows]), np.array([r[4] for r in rows])
    learn = np.arange(len(rows)) // (2 * len(MORE)) % 3 > 0  # every third block of examples calibrates
    out = {}
    for name in MORE:
        own = kind == name
        trees = fit_boosting(x[own & learn], y[own & learn])
        test = own & ~learn
        score = 1 / (1 + np.exp(-sum(predict(t, x[test]) for t in trees)))
        out[name] = trees, max(0.5, calibrate(score, y[test]))
    return out


class _Session:
    """Keeps the session out of the cache key."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __eq__(self, other):
        return isinstance(other, _Session)

    def __hash__(self):
        return 0


def model(spark: SparkSession) -> dict[str, tuple[list, float]]:
    """Trees and threshold of each generator; fitted once a process, the same everywhere."""
    return _model(0, _Session(spark))


def find_personal_data(df: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """Appends ``out``: an array of (kind, s, e, score, base), kinds in the order of BASE and MORE, then by start."""
    fitted = model(df.sparkSession)
    held, known, more_ = fresh(df, "matches_", "base_", "more_")
    rows = with_matches(df, F.col(text), {**BASE, **MORE}, held)
    base = [f"transform(filter({held}.{k}, x -> {VALID[k].replace('{luhn}', LUHN)}), x -> named_struct('kind', '{k}', 's', x.s, 'e', x.e, 'score', 1.0D, 'base', true))" for k in BASE]
    rows = rows.withColumn(known, F.expr(f"concat({', '.join(base)})"))
    scored = []
    for k, (trees, least) in fitted.items():
        fields = ", ".join(f"'f{j}', CAST({f} AS double)" for j, f in enumerate(_features("x")))
        score = boosting_sql(trees, "c.f{}")
        scored.append(f"filter(transform(transform({held}.{k}, x -> named_struct('s', x.s, 'e', x.e, {fields})), c -> named_struct('kind', '{k}', 's', c.s, 'e', c.e, 'score', {score}, 'base', false)), c -> c.score >= {least:.6f}D AND NOT exists({known}, b -> b.s < c.e AND c.s < b.e))")
    rows = rows.withColumn(more_, F.expr(f"concat({', '.join(scored)})"))
    better = "b.s < c.e AND c.s < b.e AND (b.score > c.score OR (b.score = c.score AND (b.s < c.s OR (b.s = c.s AND (b.e > c.e OR (b.e = c.e AND b.kind < c.kind))))))"
    rows = rows.withColumn(out, F.expr(f"concat({known}, filter({more_}, c -> NOT exists({more_}, b -> {better})))"))
    return rows.select(*[c for c in df.columns if c != out], out)


def redact(df: DataFrame, text: str = "text", pii: str = "pii", out: str = "redacted") -> DataFrame:
    """Appends the text with each found span replaced by its kind in brackets; overlapping spans are replaced as one, by the first's kind."""
    merged = f"aggregate(array_sort({pii}, (a, b) -> CASE WHEN a.s <> b.s THEN CAST(sign(a.s - b.s) AS int) ELSE CAST(sign(b.e - a.e) AS int) END), named_struct('at', 0L, 'out', ''), (a, x) -> CASE WHEN x.s < a.at THEN named_struct('at', greatest(a.at, x.e), 'out', a.out) ELSE named_struct('at', x.e, 'out', concat(a.out, substring(coalesce({text}, ''), CAST(a.at AS int) + 1, CAST(x.s - a.at AS int)), '[', x.kind, ']')) END, a -> concat(a.out, substring(coalesce({text}, ''), CAST(a.at AS int) + 1)))"
    return df.withColumn(out, F.expr(merged))
