"""Approximate string join of reads and reference: seeds, verification, repeats.

The result is defined by verification, so any complete set of seeds gives it.
Seeds are pigeonhole blocks: M mismatches can't touch all of M + 1 disjoint
blocks (2M + 1 where a valid-adjacent pair, which can touch two, counts as one).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.color import decode_colors, encode_colors, mismatches
from ..lineage import cut

#: Seeds up to this number of rows may be broadcast; a broadcast is built in the driver, in many times the size of its file.
MOST_SENT = 1 << 17
#: Colours in a word of a packed text, and lists to which the reads or windows of one text are dealt.
WORD, LISTS = 31, 64


def blocks(length: int, most: int, adjacent: bool = False) -> list[tuple[int, int]]:
    """(start, end) of the seed blocks of a read of ``length`` colours."""
    n = min(length, (2 * most if adjacent else most) + 1)
    cuts = [round(i * length / n) for i in range(n + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def pieces(text: Column, size: int, overlap: int) -> Column:
    """Array of the pieces of ``size`` letters of a text, each with ``overlap`` more of what follows; one pass over the text, however long."""
    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    out = parts
    for i in range(1, -(-overlap // size) + 1):
        behind = F.slice(parts, i + 1, F.greatest(F.size(parts), F.lit(1)))
        out = F.zip_with(out, behind, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.transform(out, lambda p: F.left(p, F.lit(size + overlap))) if overlap else out


def chunk_reference(contigs: DataFrame, size: int, overlap: int) -> DataFrame:
    """(contig, chunk_start, seq): pieces of ``size`` bases, each with ``overlap`` more of what follows."""
    rows = contigs.select("contig", F.posexplode(pieces(F.col("seq"), size, overlap)).alias("_i", "seq"))
    return rows.select("contig", (F.col("_i").cast("bigint") * size).alias("chunk_start"), "seq")


def slices(texts: DataFrame, column: str, k: int, out: str, at: str | None = None, piece: int = 64) -> DataFrame:
    """A row for every slice of ``k`` letters of a text, with the other columns, and its 0-based place in ``at``.

    Slices are cut from short pieces: a slice of a long text is found by counting
    letters from its head, which would cost the square of its length.
    """
    size = max(piece, k)
    others = [c for c in texts.columns if c != column]
    rows = texts.select(*others, F.posexplode(pieces(F.col(column), size, k - 1)).alias("_no", "_piece")).where(F.length("_piece") >= k)
    # the last piece of a text may be no longer than its head's overlap: then its slices are its own only
    own = F.least(F.lit(size), F.length("_piece") - k + 1)
    cut_ = F.transform(F.sequence(F.lit(1), own), lambda i: F.substring(F.col("_piece"), i, F.lit(k)))
    if at is None:
        return rows.select(*others, F.explode(cut_).alias(out))
    rows = rows.select(*others, "_no", F.posexplode(cut_).alias("_at", out))
    return rows.select(*others, (F.col("_no").cast("bigint") * size + F.col("_at")).alias(at), out)


def windows(chunks: DataFrame, size: int, length: int) -> DataFrame:
    """(contig, p, base, colors): every window of ``length`` bases of the reference, owned by the chunk of its first base; windows over a barrier (``.``) are left out."""
    usable = F.least(F.lit(size), F.length("seq") - length + 1)
    # colours are encoded once a chunk; windows are slices of them
    rows = chunks.where(usable >= 1).withColumn("_colors", encode_colors(F.col("seq"))).withColumn("_i", F.explode(F.sequence(F.lit(0), usable - 1)))
    part = rows.select("contig", (F.col("chunk_start") + F.col("_i")).alias("p"), F.substring(F.col("seq"), F.col("_i") + 1, F.lit(length)).alias("_s"), F.substring(F.col("_colors"), F.col("_i") + 1, F.lit(length - 1)).alias("ref"))
    return part.where(~F.col("_s").contains(".")).select("contig", "p", F.substring("_s", 1, 1).alias("base"), F.substring("_s", length, 1).alias("last"), "ref")


def _valid_pairs(read: Column, ref: Column) -> Column:
    """Non-overlapping neighbouring mismatch pairs that fit one base change, taken from the left."""
    letters = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    code = lambda c: F.when(c.isin("0", "1", "2", "3"), F.ascii(c) - 48)
    cells = F.zip_with(letters(read), letters(ref), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    step = lambda acc, x: F.when(
        (x["a"] == x["b"]) & (x["a"] != "."), F.struct(acc["n"].alias("n"), F.lit(None).cast("int").alias("d"))
    ).when(
        acc["d"].isNotNull() & (acc["d"] == code(x["a"]).bitwiseXOR(code(x["b"]))), F.struct((acc["n"] + 1).alias("n"), F.lit(None).cast("int").alias("d"))
    ).otherwise(F.struct(acc["n"].alias("n"), code(x["a"]).bitwiseXOR(code(x["b"])).alias("d")))
    return F.aggregate(cells, F.struct(F.lit(0).alias("n"), F.lit(None).cast("int").alias("d")), step, lambda a: a["n"])


def map_reads(reads: DataFrame, contigs: DataFrame, length: int, most: int, adjacent: bool = False, chunk: int = 1 << 8) -> DataFrame:
    """Hits (read_id, contig, pos0, strand, mm) of reads (read_id, primer, colors) with at most ``most`` mismatches.

    A read of ``length`` covers its first base, decoded from the primer and the
    first colour, and length - 1 further colours.  The first base costs one
    mismatch if it differs.  ``adjacent``: a valid-adjacent pair counts once.
    The reference is windowed once per position.  The reads are written first, so
    that their number is known: where their seeds are few, Spark may broadcast them and
    the reference isn't shuffled at all; more than ``MOST_SENT`` never go through the
    driver, and each different text is compared once (``_hits_by_text``).
    """
    ref = windows(chunk_reference(contigs, chunk, length), chunk, length)
    first = F.substring(decode_colors(F.col("primer"), F.substring("colors", 1, 1)), 2, 1)
    query = F.substring(F.col("colors"), 2, length - 1)
    rows = reads.where(F.length("colors") >= length).select("read_id", first.alias("first"), query.alias("query"))
    both = cut(rows.select("*", F.lit("+").alias("strand")).unionByName(rows.select("read_id", F.translate("first", "ACGT", "TGCA").alias("first"), F.reverse("query").alias("query"), F.lit("-").alias("strand"))))
    cuts = blocks(length - 1, most, adjacent)
    if both.count() * len(cuts) > MOST_SENT:
        hits = _hits_by_text(both, ref, length - 1, most, adjacent)
        # a place is met once for each read and contig of that name
        once = both.groupBy("read_id", "strand").count().where("count > 1").isEmpty() and contigs.groupBy("contig").count().where("count > 1").isEmpty()
        return hits if once else hits.dropDuplicates(["read_id", "contig", "pos0", "strand"])

    def keyed(df: DataFrame, column: str) -> DataFrame:
        seeds = F.array(*[F.struct(F.lit(i).alias("block"), F.substring(F.col(column), a + 1, b - a).alias("key")) for i, (a, b) in enumerate(cuts)])
        return df.withColumn("_seed", F.explode(seeds)).select("*", "_seed.block", "_seed.key").drop("_seed")

    seeds = cut(keyed(both, "query").where(~F.col("key").contains(".")))
    candidates = keyed(ref, "ref").join(seeds, ["block", "key"])
    apart = mismatches(F.col("query"), F.col("ref"))
    if adjacent:
        apart = apart - _valid_pairs(F.col("query"), F.col("ref"))
    hits = candidates.select("read_id", "contig", F.col("p").alias("pos0"), "strand", _with_first(apart).alias("mm")).where(F.col("mm") <= most)
    return hits.dropDuplicates(["read_id", "contig", "pos0", "strand"])


def _with_first(apart: Column) -> Column:
    # the read's first base lies at the window's start, or at its end on the minus strand
    return (apart + F.when(F.col("first") == F.when(F.col("strand") == "+", F.col("base")).otherwise(F.col("last")), 0).otherwise(1)).cast("int")


def _widths(n: int) -> list[int]:
    """Letters in each word of a packed text of ``n`` colours."""
    return [min(WORD, n - a) for a in range(0, n, WORD)]


def _packed(text: Column, n: int, out: str) -> list[Column]:
    """The words of a text, two bits a colour (``{out}0``, ...), and a bit for each letter that isn't a colour (``{out}_no0``, ...)."""
    found = []
    for i, wide in enumerate(_widths(n)):
        part = F.substring(text, i * WORD + 1, wide)
        word = lambda t: F.conv(t, 4, 10).cast("bigint")
        none = F.when(part.contains("."), word(F.translate(part, "0123.", "00001"))).otherwise(F.lit(0).cast("bigint"))
        found += [word(F.translate(part, ".", "0")).alias(f"{out}{i}"), none.alias(f"{out}_no{i}")]
    return found


def _unpacked(n: int, out: str) -> Column:
    """The text of ``_packed`` columns."""
    digits = lambda c, wide: F.split(F.lpad(F.conv(F.col(c).cast("string"), 10, 4), wide, "0"), "")
    return F.concat(*[F.array_join(F.zip_with(digits(f"{out}{i}", wide), digits(f"{out}_no{i}", wide), lambda a, b: F.when(b == "1", ".").otherwise(a)), "") for i, wide in enumerate(_widths(n))])


def seed_masks(n: int, most: int) -> list[list[int]]:
    """Masks by word of a complete set of seeds for texts of ``n`` colours: any two of most + 2 interleaved blocks, of which ``most`` mismatches leave two alone."""
    apart = min(n, most + 2)
    masks = []
    for chosen in combinations(range(apart), max(1, apart - most)):
        masks.append([sum(3 << 2 * (wide - 1 - j) for j in range(wide) if (i * WORD + j) % apart in chosen) for i, wide in enumerate(_widths(n))])
    return masks


def _hits_by_text(queries: DataFrame, ref: DataFrame, n: int, most: int, adjacent: bool) -> DataFrame:
    """The hits of ``map_reads`` where there are many reads: all (query, window) within ``most`` of ``n`` colours, and of the first base.

    Copies and common words would multiply the candidates, so each different query
    meets each different window only once, and a pair counts only under the first of its
    common seeds.  Reads and windows of the texts found come back in lists; those of a
    common text are dealt over ``LISTS`` lists, and pairs of lists over all tasks.
    """
    spark = queries.sparkSession
    words, raw = range(len(_widths(n))), 2 * most if adjacent else most
    masks = seed_masks(n, raw)
    text = lambda side: [f"{side}{i}" for i in words] + [f"{side}_no{i}" for i in words]
    q = queries.select("read_id", "strand", "first", *_packed(F.regexp_replace("query", "[^0-3]", "."), n, "q"))
    w = cut(ref.select("contig", "p", "base", "last", *_packed(F.col("ref"), n, "w")))

    def keyed(df: DataFrame, side: str) -> DataFrame:
        seeds = [F.when(_all([F.col(f"{side}_no{i}").bitwiseAND(F.lit(mask[i])) == 0 for i in words]), no) for no, mask in enumerate(masks)]
        rows = df.select(*text(side)).distinct().withColumn(f"{side}_seed", F.explode(F.array(*seeds)))
        return rows.where(F.col(f"{side}_seed").isNotNull())

    # a key is made of its text where it is compared, not sent; it sorts first, as its leading bits tell most rows apart
    key = lambda side, i: F.col(f"{side}{i}").bitwiseAND(F.element_at(F.array(*[F.lit(mask[i]).cast("bigint") for mask in masks]), F.col(f"{side}_seed") + 1))
    same = [key("w", i) == key("q", i) for i in words] + [F.col("w_seed") == F.col("q_seed")]
    found = keyed(w, "w").join(keyed(q, "q").hint("merge"), _all(same))
    for i, wide in enumerate(_widths(n)):
        differ = F.col(f"q{i}").bitwiseXOR(F.col(f"w{i}"))
        ones = differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(F.lit(sum(1 << 2 * j for j in range(wide))))
        found = found.withColumn(f"_apart{i}", ones.bitwiseOR(F.col(f"q_no{i}")).bitwiseOR(F.col(f"w_no{i}")))
    agree = [_all([F.col(f"_apart{i}").bitwiseAND(F.lit(mask[i])) == 0 for i in words]) for mask in masks]
    first_seed = F.coalesce(*[F.when(x, no) for no, x in enumerate(agree)])
    count = sum((F.bit_count(f"_apart{i}") for i in words), F.lit(0))
    found = found.where((count <= raw) & (first_seed == F.col("w_seed"))).select(*text("q"), *text("w"), count.cast("int").alias("apart"))
    if adjacent:
        a, b = _unpacked(n, "q"), _unpacked(n, "w")
        found = found.withColumn("apart", mismatches(a, b) - _valid_pairs(a, b)).where(F.col("apart") <= most)
    found = cut(found)

    lists = lambda df, side, item: df.groupBy(*text(side), F.pmod(F.xxhash64(*item), F.lit(LISTS)).alias("_list")).agg(F.collect_list(F.struct(*item)).alias(f"_{side}")).drop("_list")
    near = w.join(found.select(*text("w")).distinct().hint("merge"), text("w"), "left_semi")
    pairs = found.join(lists(q, "q", ["read_id", "strand", "first"]).hint("merge"), text("q"))
    pairs = pairs.join(lists(near, "w", ["contig", "p", "base", "last"]).hint("merge"), text("w")).select("apart", "_q", "_w")
    dealt = pairs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = dealt.select("apart", "_w", F.explode("_q").alias("_q")).select("apart", "_q.*", F.explode("_w").alias("_w")).select("apart", "read_id", "strand", "first", "_w.*")
    return rows.select("read_id", "contig", F.col("p").alias("pos0"), "strand", _with_first(F.col("apart")).alias("mm")).where(F.col("mm") <= most)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def signed_position(pos0: Column, strand: Column, length: int) -> Column:
    """The signed form of a position: minus-strand hits count from the other end of their colours."""
    return F.when(strand == "-", -(pos0 + length - 1)).otherwise(pos0)


def split_reads(reads: DataFrame, left: int, right: int, filler: str = "T0") -> DataFrame:
    """The two parts of each read: its first ``left`` colours, and its last ``right`` behind a filler."""
    a = reads.withColumn("split_no", F.lit(0)).withColumn("colors", F.substring("colors", 1, left))
    b = reads.withColumn("split_no", F.lit(1)).withColumn("colors", F.concat(F.lit(filler[1:]), F.right(F.col("colors"), F.lit(right)))).withColumn("primer", F.lit(filler[0]))
    return a.unionByName(b)


def resize(seq: Column, length: int, pad: str = ".") -> Column:
    """A sequence cut or padded to one length."""
    return F.rpad(seq, length, pad)


def kmer_counts(texts: DataFrame, k: int, column: str = "seq") -> DataFrame:
    """(kmer, n): occurrences of every k-mer; counted before the shuffle."""
    return slices(texts.select(column), column, k, "kmer").groupBy("kmer").agg(F.count(F.lit(1)).alias("n"))


def classify_repeats(reads: DataFrame, counts: DataFrame, k: int, most: int, column: str = "seq") -> DataFrame:
    """Appends ``is_repeat``: the first or the last k-mer of a read occurs more than ``most`` times."""
    ends = reads.withColumn("_a", F.left(F.col(column), F.lit(k))).withColumn("_b", F.right(F.col(column), F.lit(k)))
    often = counts.where(F.col("n") > most).select("kmer")
    a = ends.join(often.select(F.col("kmer").alias("_a"), F.lit(True).alias("_x")), "_a", "left").join(often.select(F.col("kmer").alias("_b"), F.lit(True).alias("_y")), "_b", "left")
    return a.withColumn("is_repeat", F.coalesce("_x", F.lit(False)) | F.coalesce("_y", F.lit(False))).drop("_a", "_b", "_x", "_y")


def mapability(hits_by_mm: Column, length: int) -> Column:
    """Sum of hits over 3^m C(L, m) for m mismatches (array index), less the read's own exact hit."""
    import math

    ways = F.array(*[F.lit(float(3**m * math.comb(length, m))) for m in range(8)])
    return F.aggregate(F.transform(hits_by_mm, lambda n, m: n / F.element_at(ways, m + 1)), F.lit(0.0), lambda a, x: a + x) - 1
