"""Line dedup (operator 7): a segment-partition edit join of lines, in DataFrame operations only.

A line of l bytes is cut into threshold + 1 even segments. Two lines within ``threshold`` byte edits share a segment: an
unedited segment of the shorter one occurs in the longer one, near the same place. So each distinct line is indexed by
its segments under (length, which segment, segment), and the longer line of a pair probes, for each length it may be
matched with, only the substrings whose place leaves enough edits on both sides. An edit changes the counts of letters
by two at most, so candidates whose counts of a few letters differ more never leave the join; the rest are verified with
the banded edit distance. Keys are plain slices of bytes and hashes, so they stay in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.cluster import cut, drop_cut, release


def segments(length: Column, threshold: int) -> list[tuple[Column, Column]]:
    """(start from 1, size) of the threshold + 1 even segments of a line; the longer ones come last."""
    parts = threshold + 1
    size, extra = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    out, start = [], F.lit(1)
    for i in range(1, parts + 1):
        n = size + F.when(extra > F.lit(parts - i), 1).otherwise(0)
        out.append((start, n))
        start = start + n
    return out


def key(line: Column, length: Column, i: int, start: Column, size: Column) -> Column:
    return F.xxhash64(length, F.lit(i), F.substring(line, start, size))


def index_keys(line: Column, length: Column, threshold: int) -> list[Column]:
    return [key(line, length, i, start, size) for i, (start, size) in enumerate(segments(length, threshold), 1)]


def probe_keys(line: Column, length: Column, threshold: int) -> list[Column]:
    """Keys of the substrings that can match a line shorter by 0 to threshold bytes."""
    out = []
    for d in range(threshold + 1):
        other = length - d
        for i, (start, size) in enumerate(segments(other, threshold), 1):
            first = max(-(i - 1), d - (threshold + 1 - i))
            last = min(i - 1, d + (threshold + 1 - i))
            out += [key(line, other, i, start + shift, size) for shift in range(first, last + 1)]
    return out


#: Letters counted by letter_counts; any would do.
COUNTED = "entira"


def letter_counts(line: Column) -> Column:
    """Counts of some letters modulo 256, a byte each."""
    out = F.lit(0).cast("long")
    for i, c in enumerate(COUNTED):
        n = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit("")))
        out = out.bitwiseOR(F.shiftleft((n % 256).cast("long"), 8 * i))
    return out


def counts_near(a: Column, b: Column, threshold: int) -> Column:
    """Whether letter counts differ by 2 * threshold at most, round the 256."""
    total = F.lit(0)
    for i in range(len(COUNTED)):
        byte = lambda x: F.shiftright(x, 8 * i).bitwiseAND(F.lit(255))  # noqa: B023, E731
        d = F.abs(byte(a) - byte(b))
        total = total + F.least(d, 256 - d)
    return total <= 2 * threshold


def text_hash(text: Column) -> Column:
    """Tells apart the texts of one id."""
    return F.xxhash64(F.lit(5), text.cast("string"))


def exploded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, t, ln, line): lines that aren't blank, numbered from 0 within their text, whose hash is t."""
    text = F.col(text_col).cast("string")
    lines = docs.select(F.col(id_col).cast("long").alias("id"), text_hash(text).alias("t"), F.posexplode(F.split(text, "\n", -1)).alias("ln", "line"))
    return lines.where("id is not null and trim(line) <> ''")


def hashed(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h"), F.xxhash64(F.lit(77), line).alias("g")]


def removed_lines(docs: DataFrame, *, threshold: int = 2, least_bytes: int = 40, bytes_per_edit: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t, ln, near) of the lines to remove: exact copies (near false) and near copies of an earlier line.

    Lines are ordered by (id, t, ln), where t tells the texts of one id apart. A line goes if the same line comes earlier,
    or if the first place of a line within ``threshold`` edits of UTF-8 bytes is earlier than its own first place (then
    all its copies go). The shorter line of a pair must have bytes_per_edit bytes for each edit between them. Lines of
    fewer than least_bytes bytes have exact copies only; blank lines stay. Lines are told apart by 128 bits of hash;
    candidates are verified on their text. A row with a null id keeps its lines; a repeated row is at the same place as
    itself, so both keep what the first keeps.
    """
    if least_bytes < 2 * (threshold + 1):
        raise ValueError("lines must be long enough for segments of two bytes")
    spark = docs.sparkSession
    every = exploded(docs, id_col, text_col)
    line, length = F.col("b"), F.col("size")
    raw = every.withColumn("b", F.col("line").cast("binary")).withColumn("size", F.octet_length("line"))
    keys = F.when(length >= least_bytes, F.array(*index_keys(line, length, threshold), *probe_keys(line, length, threshold)))
    here = F.struct("id", "t", "ln")
    placed = raw.select(*hashed(F.col("line")), here.alias("place"), keys.alias("keys"))
    found = cut(placed.groupBy("h", "g").agg(F.min("place").alias("place"), F.count("*").alias("n"), F.first("keys").alias("keys")))
    release(spark)
    n_index = threshold + 1
    long = found.where("keys is not null")
    indexed = long.select(F.explode(F.slice("keys", 1, n_index)).alias("key"), F.col("h").alias("xh"))
    probing = long.select(F.explode(F.array_distinct(F.slice("keys", n_index + 1, 1000))).alias("pkey"), "h")
    # both sides of the join shrink to what can meet, without a row for each pair; lines of one h are told apart by g later
    hits = cut(probing.join(indexed, (F.col("pkey") == F.col("key")) & (F.col("h") != F.col("xh")), "left_semi"))
    targets = cut(indexed.join(hits.select(F.col("pkey").alias("key")).distinct(), "key", "left_semi"))
    distinct = cut(found.select("h", "g", "place", "n"))
    drop_cut(found)
    release(spark)
    wanted = hits.select("h").unionByName(targets.select(F.col("xh").alias("h"))).distinct()
    texts = cut(every.select(*hashed(F.col("line")), "line").join(wanted.hint("merge"), "h", "left_semi").dropDuplicates(["h", "g"]))
    release(spark)
    known = texts.join(distinct.select("h", "g", "place"), ["h", "g"])
    known = cut(known.select("h", "g", "place", letter_counts(F.col("line")).alias("letters"), F.decode(F.col("line").cast("binary"), "ISO-8859-1").alias("chars")))
    probe = hits.join(known, "h")
    index = targets.join(known.select(*[F.col(c).alias(f"x{c}") for c in known.columns]), "xh")
    meet = (F.col("pkey") == F.col("key")) & (F.col("h") != F.col("xh")) & counts_near(F.col("letters"), F.col("xletters"), threshold)
    edits = F.levenshtein("chars", "xchars", threshold)
    linked = (edits >= 0) & (edits * bytes_per_edit <= F.least(F.length("chars"), F.length("xchars")))
    later = probe.join(index, meet & (F.col("place") > F.col("xplace")) & linked, "left_semi").select("h", "g")
    earlier = index.join(probe, meet & (F.col("xplace") > F.col("place")) & linked, "left_semi").select(F.col("xh").alias("h"), F.col("xg").alias("g"))
    later = later.unionByName(earlier).distinct().withColumn("near", F.lit(True))
    # only lines that occur again, or are near copies, meet their places once more
    doomed = distinct.join(later, ["h", "g"], "left").where("n > 1 or near").select("h", "g", "place", F.coalesce("near", F.lit(False)).alias("near"))
    places = every.select("id", "t", "ln", *hashed(F.col("line")))
    return places.join(doomed.hint("merge"), ["h", "g"]).where(F.col("near") | (here > F.col("place"))).select("id", "t", "ln", (F.col("near") & (here == F.col("place"))).alias("near")).distinct()


def dedup_lines(docs: DataFrame, *, threshold: int = 2, least_bytes: int = 40, bytes_per_edit: int = 20, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """The rows of docs with n_lines, n_removed, n_near and removed (line numbers from 0); text without those lines.

    Copies count as near only at their first place. A null text has no lines; nothing is removed from it or from rows
    with a null id. Rows of one id with several texts are told apart. Without with_text the result has id, n_lines,
    n_removed, n_near and removed only, and texts aren't shuffled. Columns of docs named like the new ones are replaced.
    """
    gone = removed_lines(docs, threshold=threshold, least_bytes=least_bytes, bytes_per_edit=bytes_per_edit, id_col=id_col, text_col=text_col)
    gone = gone.groupBy(F.col("id").alias("gone_id__"), F.col("t").alias("gone_t__")).agg(F.sort_array(F.collect_list("ln")).alias("removed"), F.sum(F.col("near").cast("long")).alias("n_near"))
    n_lines = F.coalesce(F.size(F.split(F.col(text_col).cast("string"), "\n", -1)), F.lit(0))
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(n_lines).cast("long")
    base = docs.drop("n_lines", "n_removed", "n_near", "removed", "gone_id__", "gone_t__", "own_t__", "lines__").withColumn("n_lines", n_lines).withColumn("own_t__", text_hash(F.col(text_col)))
    if not with_text:
        base = base.select(F.col(id_col).alias("id"), "own_t__", "n_lines")
        id_col = "id"
    out = base.join(gone, (F.col(id_col).cast("long") == F.col("gone_id__")) & (F.col("own_t__") == F.col("gone_t__")), "left").drop("gone_id__", "gone_t__", "own_t__")
    out = out.withColumn("removed", F.coalesce("removed", F.array().cast("array<int>"))).withColumn("n_removed", F.size("removed").cast("long")).withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))
    if not with_text:
        return out
    # lines__ is used twice, so it stays a column of its own and is cut once a row
    out = out.withColumn("lines__", F.split(F.col(text_col), "\n", -1))
    numbers = F.array_except(F.sequence(F.lit(0), F.size("lines__") - 1), F.col("removed"))
    kept = F.array_join(F.transform(numbers, lambda i: F.get("lines__", i)), "\n")
    return out.withColumn(text_col, F.when(F.col("n_removed") > 0, kept).otherwise(F.col(text_col))).drop("lines__")
