"""Document fingerprints by winnowing, in DataFrame functions only.

Words are lower-cased runs of ``[^\\x20\\x09-\\x0D]``; each word is hashed
once, and a k-gram's hash combines the hashes of its ``k`` words. In every
window of ``window`` neighbouring k-grams the one with the smallest hash is
chosen, the rightmost of equals. Whatever two texts share over at least
``window + k - 1`` words, they share a chosen k-gram.

A chosen k-gram is kept as one 64-bit number: 31 bits of hash above the
complement of its position, so that the smallest number is the smallest hash
and, among equals, the rightmost. A text of fewer than ``k`` words has one
k-gram, one of fewer k-grams than a window has one window; a text without
words (null, empty) has an empty fingerprint.

Likeness is the Jaccard similarity of the sets of chosen hashes (1 for two
empty ones).

Nulls: a null text is empty; rows with null ids come last by descending id.
Repeated rows follow one another (ties by text). A single row is its own
neighbour. An empty table gives an empty table. Extra columns are ignored. A long text is
winnowed whole, in the task that holds its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, WINDOW = 5, 16
RANGE_ROWS, MOST_RANGES = 512, 2_000
_POSITIONS = 0xFFFFFFFF


def with_winnowed(df: DataFrame, text_col: str, out: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """``df`` with ``out``, the chosen k-grams of ``text_col`` by position."""
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    hashed = df.withColumn("__words", F.transform(words, lambda w: F.xxhash64(w)))

    def gram(i: Column) -> Column:
        h = F.xxhash64(*[F.get("__words", i + j) for j in range(k)])
        return F.shiftleft(F.shiftrightunsigned(h, 33), 32).bitwiseOR(F.lit(_POSITIONS) - i)

    n = F.size("__words")
    grams = hashed.withColumn("__grams", F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))), gram))
                              .otherwise(F.array().cast("array<bigint>")))
    m = F.size("__grams")
    least = F.transform(F.sequence(F.lit(1), F.greatest(m - window + 1, F.lit(1))), lambda i: F.array_min(F.slice("__grams", i, window)))
    return (grams.withColumn(out, F.when(m > 0, F.array_distinct(least)).otherwise(F.array().cast("array<bigint>")))
            .drop("__words", "__grams"))


def chosen_hashes(chosen: Column) -> Column:
    return F.transform(chosen, lambda x: F.shiftright(x, 32))


def fingerprint_text(chosen: Column) -> Column:
    """``hash@position`` of each chosen k-gram, space-joined."""
    return F.array_join(F.transform(chosen, lambda x: F.concat(
        F.lower(F.hex(F.shiftright(x, 32))), F.lit("@"), (F.lit(_POSITIONS) - x.bitwiseAND(F.lit(_POSITIONS))).cast("string"))), " ")


def with_likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Jaccard similarity of two columns of chosen k-grams."""
    both = df.withColumn("__a", chosen_hashes(F.col(a))).withColumn("__b", chosen_hashes(F.col(b)))
    union = F.size(F.array_union("__a", "__b"))
    return (both.withColumn("__u", union)
            .withColumn(out, F.when(F.col("__u") == 0, 1.0).otherwise(F.size(F.array_intersect("__a", "__b")) / F.col("__u")))
            .drop("__a", "__b", "__u"))


def ring(docs: DataFrame) -> DataFrame:
    """Rows ``(id, text)`` dealt to ranges of ids, ready for a window that finds
    each row's next by descending id (nulls last, then by text).

    Ids are cut by approximate quantiles. The first row of each range also
    stands at the end (``extra``) of the range before it, that of the first
    range at the end of the last, so every neighbour is in the same range and
    no window spans the table.
    """
    ranges = max(1, min(MOST_RANGES, -(-docs.count() // RANGE_ROWS)))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx("id", shares, 10_000)).first()[0] if shares else None
    below = F.size(F.filter(F.array(*[F.lit(c) for c in sorted(set(cuts))]), lambda c: c < F.col("id"))) if cuts else F.lit(0)
    dealt = docs.withColumn("range", F.when(F.col("id").isNull(), -1).otherwise(below))
    heads = dealt.groupBy("range").agg(F.max("id").alias("head"))
    before = F.coalesce(F.lead("range").over(Window.orderBy("range")), F.min("range").over(Window.partitionBy()))
    heads = heads.select("head", F.col("range").alias("own"), before.alias("to"))  # at most MOST_RANGES + 1 rows
    first = Window.partitionBy("range").orderBy("text")
    extra = (dealt.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("head")))
             .withColumn("place", F.row_number().over(first)).where("place = 1")
             .select("id", "text", F.col("to").alias("range"), F.lit(True).alias("extra")))
    return dealt.withColumn("extra", F.lit(False)).unionByName(extra)


def fingerprints_and_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how alike they are.

    The edited text has the last third of the code points (rounded down)
    replaced by the first as many of the next document by descending id; the
    first follows the last. Returns ``id``, ``n_chars``, ``edited``, ``chosen``,
    ``edited_chosen``, ``near_edited``, ``near_next``.
    """
    rows = ring(docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")))
    rows = with_winnowed(rows, "text", "chosen", k, window)
    order = Window.partitionBy("range").orderBy("extra", F.col("id").desc_nulls_last(), "text")
    rows = (rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_chosen", F.lead("chosen").over(order))
            .where(~F.col("extra")).withColumn("n_chars", F.char_length("text").cast("bigint")))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next_text", F.lit(1), cut))
    rows = with_winnowed(rows.withColumn("edited", edited), "edited", "edited_chosen", k, window)
    rows = with_likeness(with_likeness(rows, "chosen", "edited_chosen", "near_edited"), "chosen", "next_chosen", "near_next")
    return rows.select("id", "n_chars", "edited", "chosen", "edited_chosen", "near_edited", "near_next")
