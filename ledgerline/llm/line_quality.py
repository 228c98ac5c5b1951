"""Line-first cleaning with DataFrame functions only.

Each line is judged by itself (punctuation, symbols, navigation, boilerplate); failing lines are removed, and a document
that loses more than ``max_loss`` of its words, or fails the base rules, is rejected. All work is inside one row: no
shuffle, no Python. Higher-order functions walk the words once; windows of three words are compared by a 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACE, let

SYMBOLS = r"[#*$%&|<>]"
#: Fixed values of the line rules (patterns are read alike by Java and RE2).
SEPARATORS = ["|", ">", "»", "•", "·", "::", "/", "-", "–", "—"]
TERMINAL = r"[.!?…:;\"'”»)\]。！？]\z"
NAVIGATION = (
    r"^(home|menu|about( us)?|contact( us)?|log ?in|sign ?(in|up|out)|register|search|next|previous|back to top"
    r"|read more|skip to content|share|subscribe|follow us|site ?map|faq|help)\b"
)
BOILERPLATE = (
    r"cookie|privacy policy|terms of (use|service)|all rights reserved|copyright|licensed under|spdx-license"
    r"|newsletter|enable javascript|lorem ipsum|powered by|click here"
)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null: none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def count_of(text: Column, pattern: str) -> Column:
    """Number of characters of a one-character class in ``text``; texts without any stop at the scan."""
    rest = "[^" + pattern[1:-1] + "]+"
    return F.when(text.rlike(pattern), F.length(F.regexp_replace(text, rest, ""))).otherwise(0)


def judged(line: Column, split: Column) -> Column:
    """Counts of one line and whether it fails. Lines without a word neither fail nor count."""
    n, trimmed = F.size(split), F.array_join(split, " ")
    chars = F.aggregate(split, F.lit(0).cast("long"), lambda a, w: a + F.length(w))
    symbols = count_of(line, SYMBOLS).cast("long")
    shouted = F.size(F.filter(split, lambda w: w.endswith("!!")))
    separators = F.size(F.filter(split, lambda w: w.isin(SEPARATORS)))
    low = F.lower(trimmed)
    fails = (
        ((n < 4) & ~trimmed.rlike(TERMINAL))  # a fragment without a closing mark
        | ((n >= 3) & (2 * shouted > n))  # most words end in "!!"
        | (10 * symbols > chars)
        | ((separators >= 2) & (4 * separators >= n))  # items between separators
        | ((n <= 6) & low.rlike(NAVIGATION))
        | ((n <= 40) & low.rlike(BOILERPLATE))
    )
    return F.struct(line.alias("line"), F.lit(n).cast("long").alias("n"), chars.alias("chars"), symbols.alias("symbols"), ((n > 0) & fails).alias("fails"))


def repeated_words(hashes: Column) -> Column:
    """Words inside three-word windows that occur at least twice, from the windows' hashes in order."""

    def covered(starts: Column) -> Column:
        # each start, in order, adds the words that the window before has not covered
        zero = F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n"))
        step = lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(3), p - a["at"])).alias("n"))
        return F.aggregate(starts, zero, step)["n"]

    def same(s: Column) -> Column:
        """Window numbers whose hash equals a neighbour's in hash order."""
        near = lambda k: F.coalesce(F.get(s, k)["h"], F.lit(None).cast("long"))
        hit = F.filter(s, lambda x, k: near(k - 1).eqNullSafe(x["h"]) | near(k + 1).eqNullSafe(x["h"]))
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = let(ordered, lambda s: let(same(s), covered))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(found)


def clean_lines(docs: DataFrame, max_loss: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines, n_removed_lines, n_removed_words, cleaned (the lines that stay), kept.

    Null and empty texts: no words, base_failed, not kept, cleaned empty. Null ids and repeated rows are kept as rows.
    A document is one row, however long; nothing is shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(
        F.col(id_col),
        F.transform(F.split(text, "\n"), lambda l: F.struct(l.alias("line"), words(l).alias("words"))).alias("lines"),
    )
    rows = split.select(
        id_col,
        F.flatten(F.col("lines.words")).alias("words"),
        F.transform("lines", lambda s: judged(s["line"], s["words"])).alias("lines"),
    )
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    rows = rows.select(
        id_col,
        "lines",
        F.size("words").cast("long").alias("n_words"),
        F.when(F.size("words") >= 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), window)).alias("windows"),
    )
    total = lambda f: F.aggregate("lines", F.lit(0).cast("long"), lambda a, s: a + f(s))
    texts = F.transform(F.filter("lines", lambda s: s["n"] > 0), lambda s: s["line"])
    counts = F.struct(
        F.col("n_words"),
        total(lambda s: s["chars"]).alias("word_chars"),
        total(lambda s: s["symbols"]).alias("n_symbols"),
        let(texts, lambda t: F.size(t) - F.size(F.array_distinct(t))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("windows").isNotNull(), repeated_words(F.col("windows"))), F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size(F.filter("lines", lambda s: s["n"] > 0)).cast("long").alias("n_lines"),
        F.size(F.filter("lines", lambda s: s["fails"])).cast("long").alias("n_removed_lines"),
        total(lambda s: F.when(s["fails"], s["n"]).otherwise(0)).alias("n_removed_words"),
        F.array_join(F.transform(F.filter("lines", lambda s: ~s["fails"]), lambda s: s["line"]), "\n").alias("cleaned"),
    )
    # inline(array(one row)): a later filter on the counts stays above them; pushed below, it would evaluate them per word
    counted = rows.select(id_col, F.inline(F.array(counts)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    lost = F.col("n_removed_words") > F.lit(max_loss) * F.col("n_words")
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~lost)
